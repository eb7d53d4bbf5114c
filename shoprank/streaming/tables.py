"""State tables of the stream: a short log of batches over live rows in user buckets.

A batch appends its rows under ``log/epoch=E/batch_id=B`` and overwrites nothing else, so a
replayed batch writes the same rows again. An *epoch* is one streaming checkpoint: batch
numbers start again with a new checkpoint, epochs only grow (``epoch_of``), and (epoch,
batch_id) orders all rows ever written. ``rows`` reads the live rows and the log together,
strictly older than a given batch: in a ``replace`` table the newest batch of a user stands
for all its older rows, otherwise rows are a set.

``fold`` merges the log into the live table, which holds one set of rows per user in
``bucket`` partitions. Only the buckets that the log touches are read and written
(``sources.partitions.replace_partitions``), then the folded log partitions go. If the driver
dies on the way, ``recover`` applies merged buckets that are complete, and log partitions that
are folded twice give the same rows. So what a batch reads is the live rows of its users'
buckets and at most as many log partitions as there are batches between two folds, however
long the stream has run. There is one writer, the streaming query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank.sources.partitions import delete_path, path_exists, recover_partitions, replace_partitions

#: Buckets of a live table. Fixed for a base folder: rows are found by it.
BUCKETS = 64

At = tuple[int, int]  # (epoch, batch_id)


def bucket_of(user: str = "userId", buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def _older(at: At):
    return F.struct("epoch", "batch_id") < F.struct(F.lit(at[0]).cast("int"), F.lit(at[1]).cast("bigint"))


@dataclass(frozen=True)
class StateTable:
    """A table ``name`` under ``base`` with columns ``schema``, one of them ``userId``."""
    base: str
    name: str
    schema: str
    replace: bool = True
    buckets: int = BUCKETS

    def path(self, part: str) -> str:
        return f"{self.base.rstrip('/')}/{self.name}/{part}"

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(", ")]

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        full = f"{self.schema}, epoch int, batch_id bigint, bucket int"
        if not path_exists(spark, self.path(part)):
            return spark.createDataFrame([], full)
        rows = spark.read.schema(full).parquet(self.path(part))
        return rows.withColumn("bucket", bucket_of(buckets=self.buckets)) if part == "log" else rows

    def append(self, rows: DataFrame, at: At) -> None:
        """Write the rows of batch ``at``; again if it is replayed."""
        own = rows.select(*self.columns)
        own.write.mode("overwrite").parquet(self.path(f"log/epoch={at[0]}/batch_id={at[1]}"))

    def _merged(self, rows: DataFrame) -> DataFrame:
        if not self.replace:
            return rows.groupBy(*self.columns, "bucket").agg(
                F.min(F.struct("epoch", "batch_id")).alias("at")).select(
                *self.columns, "at.epoch", "at.batch_id", "bucket")
        newest = rows.groupBy("userId").agg(F.max(F.struct("epoch", "batch_id")).alias("at"))
        newest = newest.select("userId", "at.epoch", "at.batch_id")
        # live rows and log of one batch may hold the same rows twice, after a crash in a fold
        return rows.join(newest, ["userId", "epoch", "batch_id"], "left_semi").dropDuplicates()

    def rows(self, spark: SparkSession, before: At | None = None, users: DataFrame | None = None) -> DataFrame:
        """Current rows (columns of ``schema``), of batches older than ``before``, of ``users``."""
        log, live = self._read(spark, "log"), self._read(spark, "live")
        if before is not None:
            log = log.where(_older(before))
        if users is not None:
            ids = users.select("userId").distinct()
            if path_exists(spark, self.path("live")):
                found = ids.select(bucket_of(buckets=self.buckets).alias("b")).distinct().collect()  # at most ``buckets``
                live = live.where(F.col("bucket").isin([r["b"] for r in found]))
            log, live = log.join(ids, "userId", "left_semi"), live.join(ids, "userId", "left_semi")
        return self._merged(live.unionByName(log)).select(*self.columns)

    def fold(self, spark: SparkSession, before: At) -> None:
        """Merge the log of batches older than ``before`` into the live table."""
        self.recover(spark)
        log = self._read(spark, "log").where(_older(before))
        batches = log.select("epoch", "batch_id").distinct().collect()  # those since the last fold
        if not batches:
            return
        touched = [r["bucket"] for r in log.select("bucket").distinct().collect()]
        live = self._read(spark, "live").where(F.col("bucket").isin(touched))
        replace_partitions(self._merged(live.unionByName(log)).repartition("bucket"), self.path("live"), ["bucket"])
        for r in batches:
            delete_path(spark, self.path(f"log/epoch={r['epoch']}/batch_id={r['batch_id']}"))

    def recover(self, spark: SparkSession) -> None:
        """Finish a fold whose merged buckets are complete."""
        recover_partitions(spark, self.path("live"), ["bucket"])


def epoch_of(spark: SparkSession, base: str, query_id: str) -> int:
    """Number of the checkpoint whose streaming query has this id: the one it was given
    before, or one above all others."""
    path = f"{base.rstrip('/')}/Epochs"
    known = []
    if path_exists(spark, path):
        known = spark.read.schema("query_id string, epoch int").parquet(path).collect()  # one row per checkpoint
    for r in known:
        if r["query_id"] == query_id:
            return r["epoch"]
    epoch = max((r["epoch"] for r in known), default=0) + 1
    spark.createDataFrame([(query_id,)], "query_id string").coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return epoch
