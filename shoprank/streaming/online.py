"""Structured Streaming jobs: the log filter (log topic -> rating records) and the
online recommender (rating records -> StreamRecs).

Sources are files (``readStream.text`` or Parquet with a ``value`` column) or Kafka when its
connector is on the class path (``fmt='kafka'``). Every record carries ``seq``, its place in
the source, as text that sorts like it (``ordered_records``), so the last event of a user and
the order of the recent queue are the same however a batch is partitioned or replayed. Every
query is checkpointed under the shared ``spark.checkpoint.dir``, so a restarted driver
resumes from the last committed batch.

The recommender keeps the recent queue of each user in the state store (``streaming.state``)
and runs one set-based plan per micro-batch inside ``foreachBatch``
(``shoprank.operators.online.recommend_batch``). Its results live in tables under ``base``
(``streaming.tables``: a log of batches over live rows, in epochs):

* ``StreamRecs``: the recommendation row of every user, the newest batch's;
* ``RecentQueue``: the recent queue (<= 40) of every user, as the state store has it; a query
  on a new checkpoint starts from it;
* ``RatedPairs``: the (user, product) pairs of all events, which join the rated set;
* ``RatingEvents`` and ``RejectedEvents``: all decoded events and all records that do not
  decode, partitioned by epoch and batch_id. They are written only, the loop never reads them.

A batch reads state strictly older than itself and overwrites only its own partitions, so
replaying a batch after a failure writes the same rows again and a partially written batch
is never read. Every ``fold_every`` batches the logs are folded, so that what a batch reads
does not grow with the number of batches. The similarity table is read anew every batch, so
a refreshed table is picked up without a restart.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoprank.operators import maintenance, online
from shoprank.session import checkpoint_dir, materialise
from shoprank.sources.partitions import path_exists
from shoprank.streaming import state
from shoprank.streaming.logfilter import filter_rating_log, parse_rating_events, rejected_events, rejected_log_lines
from shoprank.streaming.tables import At, StateTable, epoch_of

EVENTS_LOG = "RatingEvents"
REJECTS_LOG = "RejectedEvents"
#: Batches between two folds of the state tables.
FOLD_EVERY = 32
_REJECT = "reject"


def recs_table(base: str) -> StateTable:
    return StateTable(base, "StreamRecs", "userId int, recs array<struct<productId:int,score:double>>")


def queue_table(base: str) -> StateTable:
    return StateTable(base, "RecentQueue", "userId int, pos int, productId int, score double")


def rated_table(base: str) -> StateTable:
    return StateTable(base, "RatedPairs", "userId int, productId int", replace=False)


# ------------------------------------------------------------------ sources

def _digits(col, width: int):
    return F.lpad(col.cast("string"), width, "0")


def ordered_records(records: DataFrame, fmt: str) -> DataFrame:
    """(value, seq) of a source's records; ``seq`` sorts as text like the places in the source.

    Kafka: partition, then offset, so the records of a user are in the order they were sent
    where the topic is keyed by user. Parquet files: time and name of the file, then the row in
    it. Text files: time and name of the file, start of its split, then the line's own text, as
    Spark numbers no lines of a text stream (equal lines are equal records)."""
    if fmt == "kafka":
        seq = F.concat(_digits(F.col("partition"), 10), _digits(F.col("offset"), 20))
        return records.select(F.col("value").cast("string").alias("value"), seq.alias("seq"))
    file = [_digits(F.unix_micros("_metadata.file_modification_time"), 20), F.col("_metadata.file_path")]
    place = _digits(F.col("_metadata.row_index"), 20) if fmt == "parquet" else \
        F.concat(_digits(F.col("_metadata.file_block_start"), 20), F.lit(" "), F.col("value"))
    return records.select("value", F.concat_ws(" ", *file, place).alias("seq"))


def read_text_stream(spark: SparkSession, path: str, fmt: str = "text",
                     options: dict[str, str] | None = None) -> DataFrame:
    """Streaming frame (value, seq), one row per record of a folder of files or, with
    ``fmt='kafka'``, of a topic (``options``: servers and topic; from the latest offsets on
    unless ``startingOffsets`` says otherwise)."""
    reader = spark.readStream.format(fmt)
    defaults = {"startingOffsets": "latest"} if fmt == "kafka" else {}
    reader = reader.options(**defaults | (options or {}))
    if fmt == "kafka":
        return ordered_records(reader.load(), fmt)
    return ordered_records(reader.schema("value string").load(path), fmt)


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or os.path.join(checkpoint_dir(spark), name)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_log_filter(lines: DataFrame, out_path: str, checkpoint: str | None = None,
                     trigger: str | None = "2 seconds", fmt: str = "parquet",
                     options: dict[str, str] | None = None) -> StreamingQuery:
    """Stateless log filter: lines -> (key, value) rating records, appended to a sink.
    ``options`` go to the sink (for Kafka its servers and topic)."""
    return _append(filter_rating_log(lines), "log_filter", out_path, checkpoint, trigger, fmt, options)


def start_log_rejects(lines: DataFrame, out_path: str, checkpoint: str | None = None,
                      trigger: str | None = "2 seconds", fmt: str = "parquet",
                      options: dict[str, str] | None = None) -> StreamingQuery:
    """The lines that ``start_log_filter`` cannot use though they hold the prefix."""
    return _append(rejected_log_lines(lines), "log_rejects", out_path, checkpoint, trigger, fmt, options)


def _append(frame: DataFrame, name: str, out_path: str, checkpoint: str | None, trigger: str | None,
            fmt: str, options: dict[str, str] | None) -> StreamingQuery:
    writer = (frame.writeStream.format(fmt).outputMode("append").options(**(options or {}))
              .option("checkpointLocation", _checkpoint(frame.sparkSession, name, checkpoint)))
    if fmt != "kafka":
        writer = writer.option("path", out_path)
    return _trigger(writer, trigger).start()


# ------------------------------------------------------------------ recommender

def _log_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _write_log(df: DataFrame, base: str, name: str, at: At) -> None:
    df.write.mode("overwrite").parquet(f"{_log_path(base, name)}/epoch={at[0]}/batch_id={at[1]}")


def current_stream_recs(spark: SparkSession, base: str, users: DataFrame | None = None) -> DataFrame:
    """StreamRecs as the serving layer sees it: one row per user (of ``users``, whose buckets
    alone are read)."""
    return recs_table(base).rows(spark, users=users)


def current_queue(spark: SparkSession, base: str, users: DataFrame | None = None) -> DataFrame:
    """RecentQueue (userId, pos, productId, score) after the last batch."""
    return queue_table(base).rows(spark, users=users)


def rejected_records(spark: SparkSession, base: str) -> DataFrame:
    """Records of all batches that did not decode."""
    path = _log_path(base, REJECTS_LOG)
    if not path_exists(spark, path):
        return spark.createDataFrame([], "value string, epoch int, batch_id bigint")
    return spark.read.schema("value string, epoch int, batch_id bigint").parquet(path)


def initial_queue(spark: SparkSession, base: str, ratings: DataFrame, before: At | None = None) -> DataFrame:
    """Queues from which a new checkpoint starts: those of the table (as older checkpoints left
    them), else the rating history."""
    stored = queue_table(base).rows(spark, before)
    history = maintenance.recent_from_ratings(ratings)
    return stored.unionByName(history.join(stored.select("userId").distinct(), "userId", "left_anti"))


def _seeds(spark: SparkSession, base: str, ratings: DataFrame, checkpoint: str) -> DataFrame:
    """Initial queues for a checkpoint that has not finished its first batch, else none: later
    batches have them in the state store. Written once, as the first batch folds the tables."""
    if path_exists(spark, f"{checkpoint}/commits/0"):
        return spark.createDataFrame([], queue_table(base).schema)
    before = None
    if path_exists(spark, f"{checkpoint}/metadata"):  # died in its first batch, whose rows are not older ones
        query_id = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
        before = (epoch_of(spark, base, query_id), 0)
    return materialise(initial_queue(spark, base, ratings, before), "recent-queue")


def _similarities(spark: SparkSession, path: str) -> DataFrame:
    sims = spark.read.parquet(path)
    return sims.select(*[c for c in ("productId", "rank", "recProductId", "score") if c in sims.columns])


def _write_batch(events: DataFrame, queue: DataFrame, at: At, base: str, ratings: DataFrame, sims_path: str,
                 penalty: str) -> None:
    """Score and write one batch: its events and its users' queues after them."""
    spark = events.sparkSession
    users = events.select("userId").distinct()
    rated = (ratings.select("userId", "productId").join(users, "userId", "left_semi")
             .unionByName(rated_table(base).rows(spark, at, users)))
    # the plan of a batch reads both several times: rows of the batch's users, persisted once
    rated, queue = rated.distinct().persist(), queue.persist()
    try:
        _write_log(events, base, EVENTS_LOG, at)
        rated_table(base).append(events.select("userId", "productId").distinct(), at)
        queue_table(base).append(queue, at)
        recs = online.recommend_batch(events, queue, rated, _similarities(spark, sims_path), penalty=penalty, pushed=True)
        recs_table(base).append(recs, at)
    finally:
        rated.unpersist()
        queue.unpersist()


def fold_tables(spark: SparkSession, base: str, before: At) -> None:
    """Fold the logs of all state tables, for batches older than ``before``."""
    for table in (rated_table(base), queue_table(base), recs_table(base)):
        table.fold(spark, before)


def process_batch(batch: DataFrame, batch_id: int, base: str, ratings: DataFrame, sims_path: str,
                  penalty: str = "as_written", epoch: int = 0) -> None:
    """One batch of records (value[, seq]) without a streaming query: the queue before it comes
    from the table or, for a user that has none, from the rating history."""
    spark, at = batch.sparkSession, (epoch, batch_id)
    _write_log(rejected_events(batch), base, REJECTS_LOG, at)
    events = _decoded(batch).persist()
    try:
        if events.isEmpty():
            return
        users = events.select("userId").distinct()
        stored = queue_table(base).rows(spark, at, users)
        history = (maintenance.recent_from_ratings(ratings.join(users, "userId", "left_semi"))
                   .join(stored.select("userId").distinct(), "userId", "left_anti"))
        queue = maintenance.push_recent(stored.unionByName(history), events)
        _write_batch(events, queue, at, base, ratings, sims_path, penalty)
    finally:
        events.unpersist()


def _decoded(records: DataFrame) -> DataFrame:
    if "seq" not in records.columns:
        records = records.withColumn("seq", F.col("value"))
    return parse_rating_events(records, mode="permissive", keep=["seq"])


def _process_queued(rows: DataFrame, at: At, base: str, ratings: DataFrame, sims_path: str, penalty: str) -> None:
    rows = rows.persist()
    try:
        _write_log(rows.where(F.col("kind") == _REJECT).select("value"), base, REJECTS_LOG, at)
        events = rows.where(F.col("kind") == state.EVENT).select("userId", "productId", "score", "timestamp", "seq")
        if not events.isEmpty():
            queue = rows.where(F.col("kind") == state.QUEUE).select("userId", "pos", "productId", "score")
            _write_batch(events, queue, at, base, ratings, sims_path, penalty)
    finally:
        rows.unpersist()


def start_recommender(records: DataFrame, base: str, ratings_path: str, sims_path: str,
                      checkpoint: str | None = None, trigger: str | None = "2 seconds",
                      penalty: str = "as_written", fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Online recommender over a stream of ``u|p|score|epoch`` records (``value``[, ``seq``])."""
    spark = records.sparkSession
    checkpoint = _checkpoint(spark, "recommender", checkpoint)
    seeds = _seeds(spark, base, spark.read.parquet(ratings_path), checkpoint)
    queued = state.recent_queue_stream(_decoded(records), initial=seeds)
    rejected = rejected_events(records).withColumn("kind", F.lit(_REJECT))
    epochs: list[int] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        if not epochs:  # the query's id is that of its checkpoint, whatever the session
            epochs.append(epoch_of(own, base, own.sparkContext.getLocalProperty("sql.streaming.queryId")))
        at = (epochs[0], batch_id)
        if batch_id % fold_every == 0:
            fold_tables(own, base, at)
        _process_queued(batch, at, base, own.read.parquet(ratings_path), sims_path, penalty)

    writer = (queued.unionByName(rejected, allowMissingColumns=True).writeStream.outputMode("update")
              .foreachBatch(run).option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()
