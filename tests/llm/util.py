"""Small documents with every awkward case, shared by the tests."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
                       T.StructField("node", T.StringType()), T.StructField("component", T.StringType())])


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" + "abcdefgh"[: rng.randrange(1, 8)] for _ in range(n)]


def documents(seed=1, n=60):
    """Rows (doc_id, text, lang, source): prose in lines, copies, near copies, a hot source, and nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lines = [" ".join(words(rng, rng.randrange(4, 14))) for _ in range(rng.randrange(1, 6))]
        rows.append([i, "\n".join(lines), rng.choice(["en", "de"]), "hot" if i % 3 == 0 else f"s{i % 5}"])
    for i in range(12):  # near copies of one text, each with one changed word, and exact copies
        w = rows[3][1].split(" ")
        if i % 2:
            w[rng.randrange(len(w))] = "changed"
        rows.append([100 + i, " ".join(w), "en", "hot"])
    rows.append([200, " ".join(words(rng, 9000)), "en", None])  # very long
    rows.append([201, None, None, None])
    rows.append([202, "", "en", ""])
    rows.append([203, " \n\t\n", "en", "s1"])
    rows.append([204, "one", "en", "s1"])
    rows.append([205, "one two", "en", "s1"])
    rows.append([None, "no id here at all\nsecond line of it", "en", "s1"])
    rows.append(list(rows[7]))  # a repeated row
    rows.append([206, "émigré naïve " * 30 + "\U0001F600 end", "fr", "s2"])
    return [tuple(r) for r in rows]


def frame(spark, rows):
    """The rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "clash", "clash", "clash") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
