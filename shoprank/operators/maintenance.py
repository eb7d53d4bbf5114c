"""Write paths as table maintenance: rating ingest, recent-rating queue, user registration
and preference updates. Each takes the current table and a batch and returns the new
table (or the rows to add), as joins; the caller writes it (``sources.tables``).

Semantics:
* ingest: per (user, product) the score of the last event of the batch wins (highest
  ``seq``); an existing pair keeps its timestamp; a new pair is inserted with the timestamp
  of its first event (milliseconds are brought to seconds).
* recent queue: newest first, at most 40 per user; re-rated products appear again.
* register: a name already stored is rejected, a name twice in the batch is taken
  once (first by ``seq``); userId is the 32-bit JVM string hash of the name.
* preferences: ``first`` and ``prefGenres`` replaced for the users in the change set; of
  several changes of a user the last counts (by ``seq`` where there is one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank import schemas as S
from shoprank.functions.columns import normalise_seconds, username_hash
from shoprank.operators.topk import rank_within


def _present(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of the batch that the stored table holds. The stored table is
    semi-joined to the batch's keys first (a broadcast of the batch when Spark measures
    it small), so only matched keys are de-duplicated, never the whole table."""
    batch_keys = incoming.select(*keys).distinct()
    return existing.select(*keys).join(batch_keys, keys, "left_semi").distinct()


def new_keys(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(_present(incoming, existing, keys), keys, "left_anti")


def latest_per_pair(events: DataFrame) -> DataFrame:
    """(userId, productId, score, timestamp) per pair: the score of the last event (by seq) and
    the timestamp of the first, which is the one that inserts a new pair."""
    return (events.groupBy("userId", "productId")
            .agg(F.max_by("score", "seq").alias("score"), F.min_by("timestamp", "seq").alias("timestamp"))
            .withColumn("timestamp", normalise_seconds("timestamp")))


def ingest_ratings(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """New ratings table. ``incoming`` has userId, productId, score, timestamp, seq. One full
    outer join: stored pairs keep their timestamp, so a batch gives the same table as its
    events one by one."""
    latest = latest_per_pair(incoming).withColumnsRenamed({"score": "new_score", "timestamp": "new_timestamp"})
    stored = existing.select("userId", "productId", "score", "timestamp").withColumn("stored", F.lit(True))
    return (stored.join(latest, ["userId", "productId"], "full")
            .select("userId", "productId", F.coalesce("new_score", "score").alias("score"),
                    F.when(F.col("stored"), F.col("timestamp")).otherwise(F.col("new_timestamp")).alias("timestamp")))


def push_recent(queue: DataFrame, events: DataFrame, size: int = S.RECENT_QUEUE_SIZE) -> DataFrame:
    """Recent queue (userId, pos, productId, score), pos 1 = newest, after pushing the
    batch ``events`` (userId, productId, score, seq) in the order of ``seq``, of any type."""
    old = queue.select("userId", "productId", "score", F.lit(0).alias("fresh"), F.col("pos").alias("was"))
    new = events.select("userId", "productId", "score", F.lit(1).alias("fresh"), "seq")
    ranked = rank_within(old.unionByName(new, allowMissingColumns=True), "userId",
                         [F.desc("fresh"), F.desc("seq"), F.asc("was")], size, rank_col="pos")
    return ranked.select("userId", "pos", "productId", "score")


def recent_from_ratings(ratings: DataFrame, size: int = S.RECENT_QUEUE_SIZE) -> DataFrame:
    """Queue as it stands after replaying a ratings table in time order:
    newest first by (timestamp desc, productId desc, score desc)."""
    ranked = rank_within(ratings, "userId", [F.desc("timestamp"), F.desc("productId"), F.desc("score")],
                         size, rank_col="pos")
    return ranked.select("userId", "pos", "productId", "score")


def register_users(existing: DataFrame, incoming: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Users to add: incoming (username, password, seq[, timestamp]) minus stored names,
    one per name. ``timestamp`` defaults to ``now_ms`` (registration time, ms)."""
    ts = F.col("timestamp") if "timestamp" in incoming.columns else F.lit(now_ms).cast("bigint")
    firsts = (incoming.select("username", "password", "seq", ts.cast("bigint").alias("timestamp"))
              .groupBy("username").agg(F.min_by(F.struct("password", "timestamp"), "seq").alias("f")))
    fresh = new_keys(firsts, existing, ["username"])
    return fresh.select(username_hash("username").alias("userId"), "username",
                        F.col("f.password").alias("password"), F.lit(True).alias("first"),
                        F.col("f.timestamp").alias("timestamp"),
                        F.array().cast("array<string>").alias("prefGenres"))


def id_collisions(users: DataFrame) -> DataFrame:
    """(userId, usernames): ids that more than one name hashes to, with the sorted names. Names
    of one id share its ratings and lists; registration keeps them, this reports them."""
    names = users.select("userId", "username").distinct().groupBy("userId")
    return (names.agg(F.count("*").alias("n"), F.sort_array(F.collect_list("username")).alias("usernames"))
            .where("n > 1").select("userId", "usernames"))


def update_preferences(users: DataFrame, changes: DataFrame) -> DataFrame:
    """users with ``first``/``prefGenres`` replaced from changes (userId, first, prefGenres[,
    seq]); without ``seq`` a user's changes are ordered by their values."""
    value = F.struct("first", "prefGenres")
    last = F.max_by(value, "seq") if "seq" in changes.columns else F.max(value)
    ch = (changes.groupBy("userId").agg(last.alias("c"))
          .select("userId", F.col("c.first").alias("c_first"), F.col("c.prefGenres").alias("c_pref")))
    return (users.join(ch, "userId", "left")
            .select("userId", "username", "password",
                    F.coalesce("c_first", "first").alias("first"), "timestamp",
                    F.coalesce("c_pref", "prefGenres").alias("prefGenres")))
