"""Per-user recent-rating queue as Structured Streaming state.

``RecentRatings`` keeps, for every user, the newest ``size`` (default 40) ratings as list
state (``transformWithStateInPandas``, RocksDB) and emits, for each user of a micro-batch, the
batch's events and the queue after them. Events are pushed in the order of ``seq``, their place
in the source, not of their timestamps: a late event is the newest one when it arrives, as in
``maintenance.push_recent``, and equal timestamps are no tie. State per user is bounded by
``size`` entries, and a user's events of one micro-batch pass frame by frame, the ``size``
latest being kept, so a user with a third of all events holds no more than others.

A query on a new checkpoint starts from ``initial`` (userId, pos, productId, score), read once:
``streaming.online`` gives it the queues that earlier checkpoints left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoprank import schemas as S

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: kind is EVENT (an event of the batch) or QUEUE (an entry of the queue after the batch).
EVENT, QUEUE = "event", "queue"
QUEUED = "kind string, userId int, productId int, score double, timestamp bigint, seq string, pos int"
_COLUMNS = [c.split()[0] for c in QUEUED.split(", ")]


class RecentRatings(StatefulProcessor):
    def __init__(self, size: int = S.RECENT_QUEUE_SIZE):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "productId int, score double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest = None
        for frame in rows:
            yield frame.assign(kind=EVENT, userId=key[0], pos=pd.array([pd.NA] * len(frame), "Int32"))[_COLUMNS]
            both = frame if latest is None else pd.concat([latest, frame])
            latest = both.sort_values("seq", kind="stable").tail(self.size)
        new = list(zip(latest["productId"].tolist(), latest["score"].tolist()))[::-1]
        old = [tuple(r) for r in self.recent.get()] if len(new) < self.size and self.recent.exists() else []
        entries = (new + old)[:self.size]
        self.recent.put(entries)
        n = len(entries)
        yield pd.DataFrame({"kind": QUEUE, "userId": key[0], "productId": [p for p, _ in entries],
                            "score": [float(s) for _, s in entries], "timestamp": pd.array([pd.NA] * n, "Int64"),
                            "seq": [None] * n, "pos": range(1, n + 1)})[_COLUMNS]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        first = initialState.sort_values("pos").head(self.size)
        self.recent.put(list(zip(first["productId"].tolist(), first["score"].tolist())))

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """List state needs the RocksDB store; it counts for queries started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def recent_queue_stream(events: DataFrame, size: int = S.RECENT_QUEUE_SIZE, initial: DataFrame | None = None) -> DataFrame:
    """events (userId, productId, score, timestamp, seq) -> rows of ``QUEUED`` for the users of
    each micro-batch."""
    use_state_store(events.sparkSession)
    keyed = events.select("userId", "productId", "score", "timestamp", F.col("seq").cast("string").alias("seq")).groupBy("userId")
    seed = initial.select("userId", "pos", "productId", "score").groupBy("userId") if initial is not None else None
    return keyed.transformWithStateInPandas(RecentRatings(size), QUEUED, "Update", "None", initialState=seed)
