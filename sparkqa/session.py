"""Spark session and shared-storage helpers.

Library code never creates its own session: every operator takes DataFrames (or a
SparkSession) from the caller.  ``get_spark`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sparkqa", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the web UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to storage every executor can reach.  Only
    when it is unset (local tests, the bench) do we choose a scratch folder ourselves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # the setting is fixed once the session runs; the context remembers the folder
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"sparkqa-ckpt-{uuid.uuid4().hex[:8]}")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local on a cluster)."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sparkqa`` importable in Python workers (Arrow UDFs and ``mapInPandas``).

    Zips the package once per driver and adds it with ``addPyFile``, the standard way to
    distribute Python code to executors (equivalent to ``--py-files``).
    """
    import tempfile
    import zipfile

    key = spark.sparkContext.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="sparkqa-pyfiles-"), "sparkqa.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(key)
