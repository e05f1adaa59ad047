"""Licence scan: stretches of normalised text against licence texts and notices by Dice over word bigrams.

Templates are whole licence texts (the files of ``licence_texts``, by SPDX name) and usual short notices; "notice" below stands for either.

Text is normalised to lower-case words of letters and digits.  For a notice of m bigrams and a
stretch of L bigrams that holds k distinct ones of the notice, Dice = 2k / (L + m); in L, the notice's
own bigrams count once each.  A stretch has at most 2 * m * (2 - t) / t words.  The
threshold bounds both sizes: fewer than t * m / (2 - t) distinct bigrams anywhere in a document rule
the notice out, and a stretch longer than m * (2 - t) / t bigrams cannot reach it.  So a document is
read once against the bigrams of all notices, and only notices that pass the first bound have
their stretches compared, within the second.  Whole texts are scanned in a single pass over the
table, without a shuffle; the notices are a short fixed list (their number is the bound).

Of the stretches that begin at a bigram, the one with the highest Dice counts.  Where matches overlap, a whole text goes before a notice (which
may be a part of it), then the better one stays; variants of a licence are so told apart by the clauses in which they differ.

Edge cases: a null or empty text has no matches; equal scores go to the longer stretch, then the notice
first by id; repeated rows are scanned each; null ids are kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import math
import os
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import chunks, mix64, word_hashes

THRESHOLD = 0.8

# Usual short notices of common licences.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "MIT": ["Licensed under the MIT License.", "Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                 "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
                "https://www.eclipse.org/legal/epl-2.0/"],
    "EPL-1.0": ["All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
                "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"],
    "CC-BY-3.0": ["Licensed under CC BY 3.0.", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."],
    "CC-BY-SA-3.0": ["Licensed under CC BY-SA 3.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.",
                        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.",
                        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Proprietary": ["All rights reserved.", "All rights reserved. No part of this publication may be reproduced without permission."],
}
_K = np.random.default_rng(66).integers(1, 1 << 63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# letters, digits and bytes over 127 stay; all else parts words
_PLAIN = np.array([b if b > 127 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def bigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word bigrams in order, and every text's offsets into them."""
    h, _, _, at = word_hashes(_PLAIN[data], offs, lower=True)
    if len(h) < 2:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    g = mix64(h[:-1] * _K[0] + h[1:] * _K[1])[doc[:-1] == doc[1:]]
    return g, np.concatenate(([0], np.cumsum(np.maximum(n - 1, 0))))


def licence_texts() -> dict[str, str]:
    """The whole licence texts by name; read where the job is planned, not by its tasks."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licence_texts")
    out = {}
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out[name.removesuffix(".txt")] = f.read()
    return out


class Notices:
    """The distinct bigrams of all texts and notices, and the ones each belongs to."""

    def __init__(self, notices: dict[str, list[str]], threshold: float, texts: dict[str, str] | None = None):
        self.names, self.sets = [], []
        self.whole = len(texts or {})  # texts come first
        for name, text in [*sorted((texts or {}).items()), *((n, t) for n in sorted(notices) for t in notices[n])]:
            raw = np.frombuffer(text.encode(), np.uint8)
            self.names.append(name)
            self.sets.append(np.unique(bigrams(raw, np.array([0, len(raw)]))[0]))
        self.threshold = threshold
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.least = np.array([math.ceil(threshold * m / (2 - threshold) - 1e-9) for m in self.size], np.int64)
        self.most = np.array([math.floor(m * (2 - threshold) / threshold + 1e-9) for m in self.size], np.int64)
        self.all = np.unique(np.concatenate(self.sets))
        pairs = sorted((int(np.searchsorted(self.all, x)), k) for k, s in enumerate(self.sets) for x in s)
        self.of = np.array([k for _, k in pairs], np.int64)
        self.start = np.searchsorted([i for i, _ in pairs], np.arange(len(self.all) + 1))
        self.low_bits = np.zeros(1 << 20, bool)
        self.low_bits[(self.all & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def scan(self, g: np.ndarray, offs: np.ndarray) -> dict[int, list[tuple]]:
        """Matches of every text: (notice name, Dice, first bigram, end bigram), in text order."""
        at = np.flatnonzero(self.low_bits[(g & np.uint64(0xFFFFF)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.all, g[at]), len(self.all) - 1)
        hit = self.all[i] == g[at]
        at, i = at[hit], i[hit]
        many = self.start[i + 1] - self.start[i]
        row = np.repeat(np.arange(len(at)), many)
        notice = self.of[self.start[i][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
        doc = np.searchsorted(offs, at, "right")[row] - 1
        key = doc * len(self.sets) + notice
        enough = np.bincount(key, minlength=1)[key] >= self.least[notice]  # most notices have too few in a text
        key, row = key[enough], row[enough]
        order = np.lexsort((at[row], key))
        key, pos, gram = key[order], at[row][order], i[row][order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)])) if len(key) else np.zeros(1, np.int64)
        found: dict[int, list] = defaultdict(list)
        for s, e in zip(cuts[:-1], cuts[1:]):
            d, k = divmod(int(key[s]), len(self.sets))
            need, most = int(self.least[k]), int(self.most[k])
            p, x = pos[s:e], gram[s:e]
            if e - s < need or len(np.unique(x)) < need:
                continue
            first = np.flatnonzero(p[need - 1:] - p[:len(p) - need + 1] < most)  # enough hits within the size bound
            last = np.full(len(self.all), -1, np.int64)
            before = np.empty(len(x), np.int64)  # where the same bigram was last
            for b, y in enumerate(x.tolist()):
                before[b], last[y] = last[y], b
            for a in first.tolist():
                b = int(np.searchsorted(p, p[a] + 2 * most))
                distinct = np.cumsum(before[a:b] < a)
                length = p[a:b] - p[a] + 1 - np.arange(1, b - a + 1) + distinct  # repeats of the notice's bigrams count once
                dice = np.where(length <= most, 2 * distinct / (length + self.size[k]), 0.0)
                at_ = len(dice) - 1 - int(dice[::-1].argmax())  # the longest of the best
                if dice[at_] >= self.threshold:
                    found[d].append((k >= self.whole, -float(dice[at_]), -int(length[at_]), self.names[k], int(p[a] - offs[d]), int(p[a + at_] - offs[d]) + 1))
        return {d: self._best(m) for d, m in found.items()}

    @staticmethod
    def _best(matches: list[tuple]) -> list[tuple]:
        """Matches that do not overlap, the best first; only a match's neighbours are looked at."""
        starts: list[int] = []
        kept: dict[int, tuple] = {}
        for notice, dice, _, name, a, b in sorted(matches):
            i = bisect.bisect_left(starts, a)
            if (i == len(starts) or b <= starts[i]) and (i == 0 or kept[starts[i - 1]][3] <= a):
                starts.insert(i, a)
                kept[a] = (name, -dice, a, b, notice)
        return [kept[a] for a in starts]


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", notices: dict[str, list[str]] | None = None,
         threshold: float = THRESHOLD, texts: dict[str, str] | None = None) -> DataFrame:
    """One row a document: doc_id, license (of the best match, a whole text before a notice, or null), dice, ``matches`` (license, dice,
    first word and end word of the normalised text)."""
    kind = dict(df.dtypes)[key]
    known = Notices(NOTICES if notices is None else notices, threshold, licence_texts() if texts is None else texts)
    item = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part, data, offs in chunks(batch):
                found = known.scan(*bigrams(data, offs))
                rows = [[{"license": n, "dice": s, "first_word": a, "end_word": b + 1} for n, s, a, b, _ in found.get(d, ())] for d in range(len(part))]
                best = [max(zip(r, found[d]), key=lambda m: (not m[1][4], m[1][1], m[1][3] - m[1][2]))[0] if r else None for d, r in enumerate(rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b and b["license"] for b in best], pa.string()),
                                                  pa.array([b and b["dice"] for b in best], pa.float64()), pa.array(rows, item)],
                                                 [key, "license", "dice", "matches"])

    return df.select(key, F.col(text).alias("text")).mapInArrow(
        run, f"{key} {kind}, license string, dice double, matches array<struct<license:string,dice:double,first_word:bigint,end_word:bigint>>")
