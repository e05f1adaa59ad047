"""JSON arrays read by as many tasks as a file has splits.

``multiLine`` gives a file to one task.  Here lines are read by Spark's text source, and the elements of the array are
cut where its depth is: at commas between them and at its brackets.  How deep a line stands is a sum over all
lines before it (strings do not go over a line's end in JSON, so brackets inside them are told apart line by line).  A first pass
sums the depths by split and notes at which depths, counted from the split's start, an element could end there; one row a split
is scanned in file order; a second pass cuts the elements.  An element that goes over a split's end is put together from
its parts, grouped by the split it starts in.  An array written on a single line is a single line's work.

The array is the file's, or the value of ``member`` of the object that the file is; other members are passed over.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkqa.session import ship_package
from sparkqa.sources.records import BOM, _by_split

_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[][{},:]')
_OPEN, _CLOSE = "[{", "]}"


def _lines(spark: SparkSession, path) -> DataFrame:
    d = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_fb"), "value")
    return d.withColumn("value", F.when((F.col("_fb") == 0) & F.col("value").startswith(BOM), F.substr("value", F.lit(2))).otherwise(F.col("value")))


def split_depths(lines: DataFrame) -> DataFrame:
    """One row a split: ``_fp, _fb, delta`` (its brackets), ``marks`` (depths, from its start, at which an element may end or an array begin) and
    ``names`` (the last member name at each depth)."""

    def run(batches):
        of, depth, marks, names, last = None, 0, set(), {}, ""

        def row():
            return pa.RecordBatch.from_pylist([{"_fp": of[0], "_fb": of[1], "delta": depth, "marks": sorted(marks), "names": list(names.items())}], schema)

        for b in batches:
            for own, part in _by_split(b):
                if own != of:
                    if of:
                        yield row()
                    of, depth, marks, names = own, 0, set(), {}
                for line in part.column(2).to_pylist():
                    for m in _TOKEN.finditer(line):
                        t = m.group()
                        if t[0] == '"':
                            last = t
                        elif t in _OPEN:
                            depth += 1
                            marks.add(depth)
                        elif t in _CLOSE:
                            marks.add(depth)
                            depth -= 1
                        elif t == ",":
                            marks.add(depth)
                        else:
                            names[depth] = last
        if of:
            yield row()

    schema = pa.schema([("_fp", pa.string()), ("_fb", pa.int64()), ("delta", pa.int64()), ("marks", pa.list_(pa.int64())), ("names", pa.map_(pa.int64(), pa.string()))])
    return lines.mapInArrow(run, "_fp string, _fb long, delta long, marks array<long>, names map<long,string>")


def split_starts(depths: DataFrame, level: int) -> DataFrame:
    """The prefix scan: the ``depth`` before each split, the ``name`` of the member it starts in (of the file's object), and where the
    element that goes on over its start and its end starts: ``head`` and ``tail``."""
    ordered = Window.partitionBy("_fp").orderBy("_fb")
    before, so_far = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.unboundedPreceding, 0)
    d = depths.withColumn("depth", F.coalesce(F.sum("delta").over(before), F.lit(0)))
    own = F.col("names")[F.lit(1) - F.col("depth")]
    d = d.withColumn("_own", own).withColumn("name", F.last("_own", ignorenulls=True).over(before))
    cuts = F.array_contains("marks", F.lit(level) - F.col("depth"))
    d = d.withColumn("tail", F.last(F.when(cuts, F.col("_fb")), ignorenulls=True).over(so_far))
    return d.select("_fp", "_fb", "depth", "name", "tail", F.lag("tail").over(ordered).alias("head"))


def _elements(lines: DataFrame, starts: dict, level: int, member: str | None, fragments: bool) -> DataFrame:
    """The elements that lie within a split (``_fp, _fb, record``, in file order), or, with ``fragments``, the parts of those that do
    not, with the place of the split where each starts as ``_fb`` and their own as ``at``."""
    names = ["_fp", "_fb", "record"] + ["at"] * fragments
    wanted = f'"{member}"' if member else None

    def run(batches):
        of, depth, name, held, head, last = None, 0, None, [], False, ""

        def rows(records, place):
            n = len(records)
            out = [pa.array([of[0]] * n, pa.string()), pa.array([place] * n, pa.int64()), pa.array(records, pa.string())]
            return pa.RecordBatch.from_arrays(out + [pa.array([of[1]] * n, pa.int64())] * fragments, names)

        def rest():
            text = "\n".join(held)
            return rows([text], starts[of][2 if head else 3]) if fragments and text.strip() else None

        for batch in batches:
            for own, part in _by_split(batch):
                if own != of:
                    if of and (r := rest()):
                        yield r
                    of, held = own, []
                    depth, name = starts[own][0], starts[own][1]
                    head = depth >= level  # what comes first belongs to an element that began before
                done = []
                for line in part.column(2).to_pylist():
                    begin = 0 if depth >= level and (wanted is None or name == wanted) else None
                    for m in _TOKEN.finditer(line):
                        t = m.group()
                        c = t[0]
                        if c == '"':
                            last = t
                            continue
                        ends = False
                        if c in _OPEN:
                            depth += 1
                            if depth == level and c == "[" and (wanted is None or name == wanted):
                                begin, held, head = m.end(), [], False
                            continue
                        if c in _CLOSE:
                            ends = depth == level
                            depth -= 1
                        elif c == ",":
                            ends = depth == level
                        elif depth == 1 and level == 2:
                            name = last
                        if ends and begin is not None:
                            held.append(line[begin:m.start()])
                            text = "\n".join(held)
                            if head and fragments:
                                yield rows([text], starts[of][2])
                            elif not head and text.strip():
                                done.append(text)
                            held, head = [], False
                            begin = m.end() if c == "," else None
                    if begin is not None and depth >= level:
                        held.append(line[begin:])
                if done and not fragments:
                    yield rows(done, own[1])
        if of and (r := rest()):
            yield r

    return lines.mapInArrow(run, "_fp string, _fb long, record string" + ", at long" * fragments)


def read_array(spark: SparkSession, path, schema: str, member: str | None = None) -> DataFrame:
    """The elements of the JSON arrays at ``path`` as columns of ``schema``, with ``_fp, _fb, _late`` for ``with_record_order``."""
    ship_package(spark)
    lines, level = _lines(spark, path), 2 if member else 1
    starts = {(r["_fp"], r["_fb"]): (r["depth"], r["name"], r["head"], r["tail"]) for r in split_starts(split_depths(lines), level).collect()}  # one row a split
    whole = _elements(lines, starts, level, member, False).withColumn("_late", F.lit(False))
    if len(starts) > len({f for f, _ in starts}):  # some file has several splits
        late = _elements(lines, starts, level, member, True).groupBy("_fp", "_fb").agg(F.array_sort(F.collect_list(F.struct("at", "record"))).alias("x"))
        late = late.select("_fp", "_fb", F.array_join(F.transform("x", lambda y: y["record"]), "\n").alias("record"), F.lit(True).alias("_late"))
        whole = whole.unionByName(late)
    d = whole.select(F.from_json("record", schema).alias("r"), "_fp", "_fb", "_late")
    return d.select("r.*", "_fp", "_fb", "_late")
