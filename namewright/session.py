"""Session helpers for tests, the benchmark and command-line runs.

Library functions never build a session; callers pass DataFrames.  On a
cluster the session comes from ``spark-submit`` and these settings are the
deployment's business.  Locally we pin the ones that matter for the plans:
AQE on (runtime broadcast conversion, partition coalescing, skew-join
splitting), a broadcast threshold that is an explicit size check, and no UI.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package is written against.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a side is broadcast only when its (estimated or, under AQE, measured)
    # size is below this bound; otherwise the join is shuffled
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "namewright", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, no ports beyond Spark's own).

    Post-shuffle work here is CPU-bound (windows, rule expressions, string
    building), so AQE may coalesce partitions only down to 256 KB instead of
    1 MB: small inputs still spread over all cores."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.driver.memory", os.environ.get("NAMEWRIGHT_DRIVER_MEMORY", "4g"))
    )
    for k, v in {**PLAN_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (``spark.checkpoint.dir``).  Only a local
    session may do without that setting: its temporary folder is then one for all."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/namewright/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: computed once, whatever reads it and whichever
    executors are lost.  The files may be deleted when the results are written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def uncoalesced(spark: SparkSession):
    """What is written here (``materialized``) keeps all its shuffle partitions.  AQE joins partitions by their compressed
    size, so texts that compress a hundredfold would end in one task per core, whatever their length."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
