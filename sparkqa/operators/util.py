"""Small distributed helpers shared by operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows under which a side is broadcast once a count (or a bound such as k x questions) proves
# it that small.  Callers pass a tighter bound when rows are wide.
DEFAULT_BROADCAST_ROWS = 2_000_000


def global_row_number(df: DataFrame, order_cols: list, name: str = "row_no", start: int = 0) -> DataFrame:
    """Dense global numbering in ``order_cols`` order without a single-partition window.

    Range-partition and sort, then number rows inside each partition and add the running
    count of the partitions before it.  The per-partition counts are one row per partition,
    so broadcasting them has a proven bound.  ``order_cols`` must be a unique key.

    The tagged rows are checkpointed (reliably, to ``spark.checkpoint.dir``) before they are
    counted: range bounds come from sampling, so a recomputation could place rows in other
    partitions and the counts would not fit the ids.
    """
    from sparkqa.session import checkpoint_root

    spark = df.sparkSession
    checkpoint_root(spark)
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), 33)) \
                   .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_local") + F.lit(start)).cast("bigint")) \
              .drop("_mid", "_pid", "_local", "_off")


def rank_in_groups(df: DataFrame, group: str, order_cols: list, name: str = "rank") -> DataFrame:
    """1-based ranks inside each ``group``, which may hold any share of the rows: a global numbering less the group's first
    number.  (group, ``order_cols``) must be a unique key."""
    numbered = global_row_number(df, [F.col(group), *order_cols], "_g")
    first = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_g").alias("_first"))
    out = numbered.join(first, F.col(group).eqNullSafe(F.col("_group")))
    return out.withColumn(name, (F.col("_g") - F.col("_first") + 1).cast("bigint")).drop("_g", "_group", "_first")


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used where several consumers read one expensive result (e.g. postings feed statistics,
    document frequencies and the query join): the tokenising scan runs once, lineage is cut,
    and readers still get column pruning and filter push-down, which a checkpoint would not.

    ``free``: what the job shuffled is deleted at its end, not when the driver happens to collect its garbage; for a ``df``
    that nothing else runs.
    """
    from sparkqa.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    for paths in _RECORDS:
        paths.append(path)
    conf = df.sparkSession.conf
    before = conf.get(_FREE, "false")
    conf.set(_FREE, "true" if free else before)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.set(_FREE, before)
    return df.sparkSession.read.parquet(path)


_RECORDS: list[list[str]] = []


@contextmanager
def recorded():
    """The paths that ``materialize`` writes inside the block, for ``discard`` once nothing reads them any more."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS.pop()


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``materialize`` wrote, wherever the shared folder is."""
    sc = spark.sparkContext
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()
