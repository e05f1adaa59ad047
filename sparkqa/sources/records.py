"""Delimited files whose quoted fields may hold line feeds, read by as many tasks as the file has splits.

``multiLine`` gives a file to one task, because whether a line starts a record depends on all lines before
it.  Here lines are read by Spark's text source, and each line is seen as a function of one bit: whether
a quoted field is open before it, to whether one is open after it.  Such functions compose, so the bit
at every split's start is a prefix scan: each task composes its own splits' lines, one row a split is
scanned in file order, and a second pass over the lines, knowing its first bit, joins the lines of
each record again.  Only a record that spans splits leaves its task: its fragments (the end of one split,
the heads of those after it) are grouped by the split it starts in.

Quoting is that of the CSV reader: a quote opens a field only at the field's start, two quotes inside are one,
after a closing quote the field goes on unquoted up to the separator.  Records end with a line feed, or a carriage
return and one (the lines inside a quoted field then too, which are read as line feeds); empty ones are skipped; a byte order mark at a file's start is dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkqa.session import ship_package

BOM = "﻿"
# where a line's reading stands: in an unquoted field past its start, at a field's start, in a quoted
# field, behind a quote of one (its end, or the first of two)
PLAIN, START, QUOTED, AFTER = 0, 1, 2, 3


def _text_part(state: Column, part: Column, sep: str) -> Column:
    """Past the text between two quotes."""
    moved = F.when(part.endswith(sep), F.lit(START)).otherwise(F.lit(PLAIN))
    return F.when((part != "") & (state != QUOTED), moved).otherwise(state)


def _quote(state: Column) -> Column:
    return F.when(state == START, F.lit(QUOTED)).when(state == QUOTED, F.lit(AFTER)).when(state == AFTER, F.lit(QUOTED)).otherwise(state)


def open_after(line: Column, open_before: bool, sep: str) -> Column:
    """Whether a quoted field is open at the end of ``line``.  A line without quotes changes nothing."""
    parts = F.split(line, '"', -1)
    first = _text_part(F.lit(QUOTED if open_before else START), parts[0], sep)
    last = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), first, lambda s, p: _text_part(_quote(s), p, sep))
    return F.when(F.instr(line, '"') == 0, F.lit(open_before)).otherwise(last == QUOTED)


def _lines(spark: SparkSession, path, sep: str) -> DataFrame:
    """``_fp, _fb`` (the split: file and place), ``value``, ``closed`` and ``opened``: the bit after the line by the bit before."""
    d = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_fb"), "value")
    d = d.withColumn("value", F.when((F.col("_fb") == 0) & F.col("value").startswith(BOM), F.substr("value", F.lit(2))).otherwise(F.col("value")))
    return d.select("_fp", "_fb", "value", open_after(F.col("value"), False, sep).alias("closed"), open_after(F.col("value"), True, sep).alias("opened"))


def split_functions(lines: DataFrame) -> DataFrame:
    """One row a split: ``_fp, _fb, closed, opened`` of the whole split, and ``starts``: whether a record starts
    in it although one is open at its start.  No text leaves the JVM and nothing is shuffled."""
    names = ["_fp", "_fb", "closed", "opened", "starts"]
    schema = pa.schema([("_fp", pa.string()), ("_fb", pa.int64()), *((n, pa.bool_()) for n in names[2:])])

    def run(batches):
        of, closed, opened, starts = None, False, True, False
        for b in batches:
            for own, part in _by_split(b):
                if own != of:
                    if of:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, (*of, closed, opened, starts)))], schema)
                    of, closed, opened, starts = own, False, True, False
                c, o = _bits(part.column(2)), _bits(part.column(3))
                for k in np.flatnonzero(c | ~o):  # the others change nothing
                    closed, opened = bool(o[k] if closed else c[k]), bool(o[k] if opened else c[k])
                    starts = starts or not opened
        if of:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*of, closed, opened, starts)))], schema)

    return lines.select("_fp", "_fb", "closed", "opened").mapInArrow(run, "_fp string, _fb long, closed boolean, opened boolean, starts boolean")


def _bits(column: pa.Array) -> np.ndarray:
    return np.asarray(column.cast(pa.int8())) > 0


def _by_split(batch: pa.RecordBatch):
    """The parts of a batch that are of one split: ((file, place), rows)."""
    if not batch.num_rows:
        return
    fp, fb = batch.column(0), np.asarray(batch.column(1))
    edges = np.flatnonzero(np.diff(fb)) + 1
    if fp[0] != fp[batch.num_rows - 1]:
        edges = np.union1d(edges, np.flatnonzero(np.diff(np.asarray(fp.dictionary_encode().indices))) + 1)
    for i, j in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        yield (fp[i].as_py(), int(fb[i])), batch.slice(i, j - i)


def open_splits(functions: DataFrame) -> DataFrame:
    """The prefix scan over ``split_functions``: the bits ``before`` and ``after`` each split, and where the record that is open
    there starts: ``head`` and ``tail`` (the place of a split)."""
    ordered = Window.partitionBy("_fp").orderBy("_fb")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    swap, fixed = F.col("closed") & ~F.col("opened"), F.col("closed") == F.col("opened")
    d = functions.withColumn("_swaps", F.sum(swap.cast("int")).over(so_far))
    # the last split that fixes the bit, and how many turn it since
    d = d.withColumn("_at", F.last(F.when(fixed, F.struct(F.col("_swaps").alias("n"), F.col("closed").alias("bit"))), ignorenulls=True).over(so_far))
    turned = (F.col("_swaps") - F.coalesce("_at.n", F.lit(0))) % 2 == 1
    d = d.withColumn("after", F.coalesce("_at.bit", F.lit(False)) != turned)
    d = d.withColumn("before", F.lag("after", 1, False).over(ordered))
    d = d.withColumn("tail", F.last(F.when(~F.col("before") | F.col("starts"), F.col("_fb")), ignorenulls=True).over(so_far))
    return d.select("_fp", "_fb", "before", "after", "tail", F.lag("tail").over(ordered).alias("head"))


def _before(closed: np.ndarray, opened: np.ndarray, bit: bool) -> tuple[np.ndarray, bool]:
    """The bit before each line, and the one after the last."""
    if (not bit and not closed.any()) or (bit and opened.all()):
        return np.full(len(closed), bit), bit
    before = np.empty(len(closed), bool)
    for i in range(len(closed)):
        before[i] = bit
        bit = bool(opened[i] if bit else closed[i])
    return before, bit


def _joined(lines: DataFrame, cut: dict, fragments: bool) -> DataFrame:
    """Records of ``lines``: ``_fp, _fb, record``, in file order inside a partition.

    ``cut``: (file, split) -> (before, head, tail) of ``open_splits`` where a record is open at either end.  Such a
    record is left out; with ``fragments`` its parts come instead, and only they, with the place of the split that
    each part's record starts in as ``_fb`` and its own as ``at``.
    """
    names = ["_fp", "_fb", "record"] + ["at"] * fragments

    def run(batches):
        of, bit, held, head = None, False, [], False  # head: what is held began in an earlier split

        def rows(records, place):
            n = len(records)
            out = [pa.array([of[0]] * n, pa.string()), pa.array([place] * n, pa.int64()),
                   records if isinstance(records, pa.Array) else pa.array(records, pa.string())]
            return pa.RecordBatch.from_arrays(out + [pa.array([of[1]] * n, pa.int64())] * fragments, names)

        def piece():
            return rows(["\n".join(held)], cut[of][1 if head else 2])

        for batch in batches:
            for own, part in _by_split(batch):
                if own != of:
                    if held and fragments:
                        yield piece()
                    of, held = own, []
                    bit = head = cut.get(own, (False,))[0]
                if fragments and own not in cut:
                    continue
                before, after = _before(_bits(part.column(3)), _bits(part.column(4)), bit)
                if not before.any() and not after and not held:
                    if not fragments:
                        yield rows(part.column(2), own[1])
                    continue
                done = []
                ends = np.append(before[1:], after)
                for line, goes_on in zip(part.column(2).to_pylist(), ends.tolist()):
                    held.append(line)
                    if not goes_on:  # a record ends here
                        if not head:
                            done.append("\n".join(held))
                        elif fragments:
                            yield piece()
                        held, head = [], False
                bit = after
                if done and not fragments:
                    yield rows(done, own[1])
        if held and fragments:
            yield piece()

    return lines.mapInArrow(run, "_fp string, _fb long, record string" + ", at long" * fragments)


def read_records(spark: SparkSession, path, columns: list[str], options: dict, sep: str = "\t") -> DataFrame:
    """``columns`` (strings) of every record, with ``_fp, _fb`` (the split it starts in) and ``_late`` (whether it goes on in the next one)."""
    ship_package(spark)
    lines = _lines(spark, path, sep)
    # the splits at whose ends a record is open: one row a split at most
    cut = {(r["_fp"], r["_fb"]): (r["before"], r["head"], r["tail"]) for r in open_splits(split_functions(lines)).filter("before or after").collect()}
    whole = _joined(lines, cut, False).withColumn("_late", F.lit(False))
    if cut:
        late = _joined(lines, cut, True).groupBy("_fp", "_fb").agg(F.array_sort(F.collect_list(F.struct("at", "record"))).alias("x")) \
            .select("_fp", "_fb", F.array_join(F.transform("x", lambda y: y["record"]), "\n").alias("record"), F.lit(True).alias("_late"))
        whole = whole.unionByName(late)
    # a record that ends with a carriage return is of a file whose lines all do
    record = F.when(F.col("record").endswith("\r"), F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    schema = ", ".join(f"`{c}` string" for c in columns)
    d = whole.select("_fp", "_fb", "_late", record.alias("record")).filter(F.col("record") != "")
    return d.select(F.from_csv("record", schema, options).alias("r"), "_fp", "_fb", "_late").select("r.*", "_fp", "_fb", "_late")


def with_record_order(df: DataFrame, name: str = "row_no") -> DataFrame:
    """0-based position of each row of ``read_records`` in file order; filters and projections that keep its last three columns may come between.

    Rows of a split come in order from one task; a record that goes on beyond its split is its last.  The offsets are one row a split.
    """
    tagged = df.withColumn("_fm", F.monotonically_increasing_id())
    splits = tagged.groupBy("_fp", "_fb").agg(F.min(F.when(~F.col("_late"), F.col("_fm"))).alias("_f0"),
                                              F.count_if(~F.col("_late")).alias("_n"), F.count_if("_late").alias("_l"))
    w = Window.orderBy("_fp", "_fb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_off", F.coalesce(F.sum(F.col("_n") + F.col("_l")).over(w), F.lit(0))).drop("_l")
    out = tagged.join(F.broadcast(offsets), ["_fp", "_fb"])
    local = F.when(F.col("_late"), F.col("_n")).otherwise(F.col("_fm") - F.col("_f0"))
    return out.withColumn(name, (F.col("_off") + local).cast("bigint")).drop("_fp", "_fb", "_late", "_fm", "_f0", "_n", "_off")
