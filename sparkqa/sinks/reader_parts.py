"""K9 with reuse: reader samples prepared in parts, each with a fingerprint of what it was made from.

Questions are dealt to ``n_parts`` parts by the hash of their key.  A part's fingerprint is the row count and an order-free hash sum
of its rows of every input, with the parameters.  Parts are prepared a wave at a time: a wave's samples go to a folder of their own, and only
then is the manifest told, so a run that breaks loses one wave and the next one goes on from there.  Parts whose
fingerprint is that of the manifest are left as they are; when some questions change, only their parts are prepared anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _part(key: str, n_parts: int):
    return F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("int")


def part_fingerprints(inputs: dict[str, DataFrame], key: str, n_parts: int, identity: str) -> dict[int, str]:
    """One text a part: at most ``n_parts`` rows an input reach the driver."""
    prints = {p: [identity, str(n_parts)] for p in range(n_parts)}
    for name in sorted(inputs):
        d = inputs[name]
        rows = d.groupBy(_part(key, n_parts).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)")).alias("h")).collect()
        for r in rows:
            prints[r["p"]].append(f"{name}:{r['n']}:{r['h']}")
    return {p: "|".join(x) for p, x in prints.items()}


def manifest(spark: SparkSession, path: str) -> dict[int, dict]:
    """The newest entry of each part."""
    from pyspark.errors import AnalysisException
    try:
        rows = [json.loads(r[0]) for r in spark.read.schema("value string").text(f"{path}/manifest/*").collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["part"]: r for r in sorted(rows, key=lambda r: r["order"])}


def prepare_in_parts(inputs: dict[str, DataFrame], prepare: Callable[[dict[str, DataFrame]], DataFrame], path: str, key: str = "qid",
                     n_parts: int = 64, wave: int = 8, identity: str = "") -> dict:
    """Prepare the parts that are missing or out of date.  ``prepare`` makes samples (with ``key``) of inputs (with ``key``); ``identity``
    names its parameters and whatever else it reads.  Returns which parts were prepared and reused."""
    spark = next(iter(inputs.values())).sparkSession
    prints = part_fingerprints(inputs, key, n_parts, identity)
    there = manifest(spark, path)
    todo = [p for p, f in prints.items() if there.get(p, {}).get("fingerprint") != f]
    order = max([e["order"] for e in there.values()], default=-1) + 1
    for i in range(0, len(todo), wave):
        own = todo[i:i + wave]
        some = {name: d.filter(_part(key, n_parts).isin(own)) for name, d in inputs.items()}
        folder = uuid.uuid4().hex[:12]
        prepare(some).withColumn("part", _part(key, n_parts)).repartition(len(own), "part").write.partitionBy("part").parquet(f"{path}/parts/{folder}")
        rows = {r[0]: r[1] for r in spark.read.schema("part int").parquet(f"{path}/parts/{folder}").groupBy("part").count().collect()}
        entries = [json.dumps({"part": p, "fingerprint": prints[p], "folder": folder, "rows": rows.get(p, 0), "order": order}) for p in own]
        spark.createDataFrame([(e,) for e in entries], "value string").coalesce(1).write.text(f"{path}/manifest/{folder}")
        order += 1
    return {"prepared": todo, "reused": [p for p in prints if p not in todo]}


def read_parts(spark: SparkSession, path: str, schema) -> DataFrame:
    """The samples of all parts that the manifest lists (``schema``: of what ``prepare`` made)."""
    entries = [e for e in manifest(spark, path).values() if e["rows"]]
    if not entries:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/parts/{e['folder']}/part={e['part']}" for e in entries])
