"""Tables of which only some partitions are written anew.

``replace_partitions`` writes the new rows to a ``.pending`` folder beside the table, and only when
that is complete moves them over the old partitions by dynamic partition overwrite. A driver
that dies on the way leaves either no complete pending folder (nothing has happened) or a
complete one, which ``recover_partitions`` applies again, with the same result. There is one
writer; a reader that listed a partition's files just before they were replaced has to read
again. Folder tests and deletes go through Hadoop's file system of the classic session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    own, fs = _file_system(spark, path)
    return fs.exists(own)


def delete_path(spark: SparkSession, path: str) -> None:
    own, fs = _file_system(spark, path)
    fs.delete(own, True)


def pending_path(path: str) -> str:
    return path.rstrip("/") + ".pending"


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace those partitions of the table at ``path`` that ``df`` has rows of; the files of
    all others stay as they are."""
    df.write.mode("overwrite").partitionBy(*by).parquet(pending_path(path))
    recover_partitions(df.sparkSession, path, by)


def recover_partitions(spark: SparkSession, path: str, by: list[str]) -> None:
    """Apply the pending partitions of the table if they are complete."""
    done = pending_path(path) + "/_SUCCESS"
    if path_exists(spark, done):
        (spark.read.parquet(pending_path(path)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))
        delete_path(spark, done)
