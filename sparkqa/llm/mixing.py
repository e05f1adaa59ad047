"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule (its density over training time 0..1).  Targets come from
the weights, capped at a number of passes over the source.  The schedule is integrated, the
cumulative demand for words is inverted at each document's place in its source, and the documents
are range-sorted by the training position this gives.  Only DataFrame functions are used.

Edge cases: a null text has size 0 and is never taken; a null source is a source, ordered last; a
source without words has target 0; equal rows are interchangeable; an empty table gives an empty
result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize

WEIGHTS = (3.0, 1.0, 2.0)
# Knots (time, density) of the schedules, dealt to sources in turn.
SCHEDULES = (((0.0, 1.6), (1.0, 0.4)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.4), (0.5, 1.0), (1.0, 1.6)))
WORD = r"[^\x20\x09-\x0D]+"
PARTS = 512


def segments(knots: tuple) -> list[tuple[float, float, float, float, float]]:
    """Pieces (t0, t1, density at t0, density at t1, integral before t0), scaled to integral 1."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total, out, before = sum(areas), [], 0.0
    for (a, b), area in zip(zip(knots, knots[1:]), areas):
        out.append((a[0], b[0], a[1] / total, b[1] / total, before))
        before += area / total
    return out


def position(share: Column, kind: Column, schedules: tuple = SCHEDULES) -> Column:
    """The time at which a source has been asked for ``share`` of its target: the inverse of its
    integrated schedule, piece by piece (a root of a quadratic)."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        inner = F.lit(None).cast("double")
        for t0, t1, d0, d1, before in reversed(segments(knots)):
            slope, rest = (d1 - d0) / (t1 - t0), share - F.lit(before)
            step = rest / F.lit(d0) if slope == 0 else \
                F.lit(2.0) * rest / (F.lit(d0) + F.sqrt(F.greatest(F.lit(d0 * d0) + F.lit(2 * slope) * rest, F.lit(0.0))))
            inner = F.when(share >= F.lit(before), F.least(F.lit(t0) + step, F.lit(t1))).otherwise(inner) \
                if before else F.coalesce(inner, F.least(F.lit(t0) + step, F.lit(t1)))
        out = F.when(kind == k, inner).otherwise(out)
    return out


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, passes: int = 2) -> DataFrame:
    """``source, source_size, rank, target``: ``share`` of all words dealt by weight, a source at
    most ``passes`` times its words, the excess dealt again by weight.

    A source is capped when the final level (words per unit of weight) reaches its cap over its
    weight.  Sources sorted by that ratio are capped from the smallest on, so one running sum over
    the sources gives the level.  There is one row a source.
    """
    n = len(weights)
    by = Window.orderBy(F.col("source").isNull(), F.col("source"))
    s = sizes.withColumn("rank", (F.row_number().over(by) - 1).cast("int"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("rank", F.lit(n)) + 1)
    s = s.withColumn("weight", w).withColumn("cap", (F.col("source_size") * passes).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything) * F.lit(share)) \
         .withColumn("capped_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
         .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    s = s.withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    # The first open source fixes the level for itself and all after it.
    s = s.withColumn("final", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    return s.select("source", "source_size", "rank",
                    F.coalesce(F.least(F.col("final") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS,
        schedules: tuple = SCHEDULES, share: float = 1.5, passes: int = 2) -> DataFrame:
    """One row a document: size, source_size, target, taken words, and the training position of each
    pass that takes it (``positions``, empty if none).

    A source's documents stand in hash order.  Pass p takes the words from ``p * source_size``
    on until the target is reached; only the document at the target is taken in part.  Running sums
    are made in ``PARTS`` parts of a source, so a hot source is no single task.
    """
    d = df.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                  F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                  F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("h"))
    d = materialize(d.withColumn("part", F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint"), F.lit(PARTS)).cast("int")),
                    "mix-sizes")
    parts = d.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    plan = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, passes)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offs = parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(before), F.lit(0))) \
        .select(F.col("source").alias("_s"), F.col("part").alias("_p"), "part_start")
    offs = offs.join(plan, F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    inner = Window.partitionBy("source", "part").orderBy("h", "doc_id", "size")
    run = d.withColumn("_start", F.coalesce(F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = run.join(offs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p"))) \
        .withColumn("start", F.col("part_start") + F.col("_start"))
    budget = F.round("target").cast("bigint")
    words, places = [], []
    for p in range(passes):
        at = F.col("start") + F.lit(p) * F.col("source_size")
        got = F.greatest(F.lit(0), F.least(budget - at, F.col("size")))
        words.append(got)
        places.append(F.when(got > 0, position((at + got / 2) / F.col("target"), F.pmod("rank", F.lit(len(schedules))), schedules)))
    taken = words[0]
    for x in words[1:]:
        taken = taken + x
    return j.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"),
                    F.array_compact(F.array(*places)).alias("positions"))


def curriculum(mixed: DataFrame) -> DataFrame:
    """One row for each time a document is taken, range-sorted by training position."""
    d = mixed.select("doc_id", "source", F.posexplode("positions").alias("pass", "position"))
    return d.orderBy("position", "doc_id", "pass")
