"""Spark session settings shared by jobs, tests and the bench.

Library functions never create a session; they use the one their inputs belong to.
``get_session`` is for scripts and tests; ``apply_sql_conf`` pins the few SQL settings
whose values change answers (time zone for month buckets, map key policy for recs maps)
and turns on adaptive execution.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that affect results or plans. Safe to set at runtime on any session.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # rows of long texts go to Python workers in batches of bytes, not of 10,000 rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # a query may ask for another one by sized_by_rows; the next starts from this
    "spark.sql.sources.fileCompressionFactor": "1.0",
}
# Bytes that rows of few numbers take in a broadcast, a byte of their Parquet file (35 and more measured).
BYTES_PER_FILE_BYTE = 32


def apply_sql_conf(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def sized_by_rows(spark: SparkSession) -> None:
    """Until the next ``apply_sql_conf`` Spark takes tables for as large as their rows in memory, not as their
    files: else it sends the driver tables to broadcast that are small on disk alone. Adaptive execution still
    broadcasts what it has measured to be small."""
    spark.conf.set("spark.sql.sources.fileCompressionFactor", str(float(BYTES_PER_FILE_BYTE)))


def get_session(
    app: str = "shoprank",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; scripts pass ``local[N]``. ``BENCH_CPUS`` sizes the shuffle."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    if master:  # a master set here would win over that of spark-submit
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or int(cpus) * 2),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        **SQL_CONF,
    }
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_sql_conf(spark)


_LOCAL_CHECKPOINTS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster the operator names it in ``spark.checkpoint.dir`` (a static setting);
    we only read it. When it is unset on a local master (tests, local runs) a fresh
    temporary folder is used instead; on a cluster that is an error, since a
    machine-local folder is not visible to every executor.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        key = id(sc)
        if key not in _LOCAL_CHECKPOINTS:
            _LOCAL_CHECKPOINTS[key] = tempfile.mkdtemp(prefix="shoprank-ckpt-")
        path = _LOCAL_CHECKPOINTS[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def materialise(df, name: str = "tmp"):
    """Write an intermediate that several branches read as a Parquet table under the
    shared checkpoint folder and return a DataFrame over it.

    Each branch then reads the table instead of replaying the lineage (Catalyst pushes
    different filters into each branch, so exchanges are not reused), and a lost
    executor re-reads files instead of recomputing upstream stages. Parquet is used
    rather than ``DataFrame.checkpoint`` because it is columnar and compressed."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files and cached blocks of frames that nobody holds any more: its
    cleaner only sees them after a garbage collection of the driver, which may be far off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
