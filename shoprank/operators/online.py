"""Real-time re-ranking of a user's candidates, as one set-based plan per batch.

For every rating event (user u rates product p) the reference reads u's recent ratings
(21 entries: the queue read is inclusive), takes the 20 products most similar to p that
u has not rated, and scores each candidate c over the recent ratings r with
sim(c, r) > 0.4: priority = mean(sim * r.score) + log10(incr) - log10(incr), where
incr/decr count recent scores > 3 / <= 3. The log term as written is always 0 (the
second term repeats ``incr``); ``penalty='intended'`` uses log10(incr) - log10(decr)
with missing counts as 1. The user's StreamRecs row is replaced by the sorted list
(possibly empty).

Batch rules: several events of one user in a batch -> the last (timestamp, seq) wins,
so only that event is scored; the batch's own events are already in the recent queue
and in the rated set (they were written before the log line). A product missing from
the similarity table has no candidates (empty list) instead of failing.

Every join is keyed and bounded per user: at most 20 candidates x 21 recent entries.
The similarity table is joined, not collected: Spark broadcasts it when its measured
size is under the broadcast threshold and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank import schemas as S
from shoprank.operators.maintenance import push_recent
from shoprank.operators.topk import rank_within
from shoprank.session import materialise


def last_event_per_user(events: DataFrame) -> DataFrame:
    """(userId, productId, score, timestamp, seq) of each user's last event."""
    last = F.max_by(F.struct("productId", "score", "timestamp", "seq"), F.struct("timestamp", "seq"))
    return (events.groupBy("userId").agg(last.alias("e"))
            .select("userId", "e.productId", "e.score", "e.timestamp", "e.seq"))


def recent_ratings(queue: DataFrame, events: DataFrame, n: int = S.RECENT_RATINGS_USED) -> DataFrame:
    """Queue after pushing the batch, first n entries of the users in the batch."""
    users = events.select("userId").distinct()
    touched = queue.join(users, "userId", "left_semi")
    return push_recent(touched, events).where(F.col("pos") <= n)


def batch_ratings(ratings: DataFrame, events: DataFrame) -> DataFrame:
    """The stored ratings of the batch's users: all that a batch reads of the table. Filtered before
    any window, and by Spark below the joins that make the ratings."""
    return ratings.join(events.select("userId").distinct(), "userId", "left_semi")


# Partners of a product are read in bands of this many ranks.
RANK_BAND = 32


def rank_partners(sims: DataFrame) -> DataFrame:
    """(productId, recProductId, score, rank) with rank by score desc, partner id asc
    (the order of a stored recs list)."""
    return rank_within(sims.select("productId", "recProductId", "score"), "productId",
                       [F.desc("score"), F.asc("recProductId")])


def partners_needed(last_events: DataFrame, rated: DataFrame, n: int = S.MAX_SIM_PRODUCTS_NUM) -> DataFrame:
    """(productId, most): how many first partners of an event's product ``candidates`` can read."""
    per_user = rated.select("userId", "productId").distinct().groupBy("userId").agg(F.count(F.lit(1)).alias("r"))
    return (last_events.select("userId", "productId").join(per_user, "userId", "left")
            .groupBy("productId").agg((F.coalesce(F.max("r"), F.lit(0)) + n).alias("most")))


def candidate_pairs(cands: DataFrame, recent: DataFrame) -> DataFrame:
    """(productId, recProductId): the pairs whose similarity ``score_candidates`` looks up."""
    return (cands.select("userId", "candidate").join(recent.select("userId", F.col("productId").alias("recProductId")), "userId")
            .select(F.col("candidate").alias("productId"), "recProductId").distinct())


def candidates(last_events: DataFrame, sims: DataFrame, rated: DataFrame,
               n: int = S.MAX_SIM_PRODUCTS_NUM) -> DataFrame:
    """(userId, rank, candidate, sim): the n most similar unrated products per event.

    Exact without reading every partner of a popular product once per event: a user
    who rated r products finds its n best unrated partners within the product's first
    n + r ranked partners, so each event joins only the rank bands it needs,
    ``(productId, band)``. ``sims`` may carry ``rank`` (stored list order); otherwise it
    is computed."""
    ranked = sims if "rank" in sims.columns else rank_partners(sims)
    banded = ranked.select("productId", F.col("recProductId").alias("candidate"), F.col("score").alias("sim"),
                           F.floor((F.col("rank") - 1) / RANK_BAND).cast("int").alias("band"))
    rated_pairs = rated.select("userId", F.col("productId").alias("candidate")).distinct()
    per_user = rated_pairs.groupBy("userId").agg(F.count(F.lit(1)).alias("r"))
    need = (last_events.select("userId", "productId").join(per_user, "userId", "left")
            .select("userId", "productId",
                    F.explode(F.sequence(F.lit(0), F.floor((F.coalesce("r", F.lit(0)) + n - 1) / RANK_BAND)
                                         .cast("int"))).alias("band")))
    row = need.join(banded, ["productId", "band"])
    unrated = row.join(rated_pairs, ["userId", "candidate"], "left_anti")
    return rank_within(unrated, "userId", [F.desc("sim"), F.asc("candidate")], n).select(
        "userId", "rank", "candidate", "sim")


def score_candidates(cands: DataFrame, recent: DataFrame, sims: DataFrame,
                     threshold: float = S.SIMILARITY_THRESHOLD, penalty: str = "as_written") -> DataFrame:
    """(userId, candidate, priority, wsum, n, incr, decr) for candidates with any recent
    match; wsum = sum of sim * score over the n matching recent entries."""
    sims = sims.select("productId", "recProductId", "score")
    pairs = (cands.select("userId", "candidate")
             .join(recent.select("userId", F.col("productId").alias("recent"), F.col("score").alias("rscore")),
                   "userId")
             .join(sims.select(F.col("productId").alias("candidate"), F.col("recProductId").alias("recent"),
                               F.col("score").alias("s")), ["candidate", "recent"])
             .where(F.col("s") > threshold))
    agg = pairs.groupBy("userId", "candidate").agg(
        F.sum(F.col("s") * F.col("rscore")).alias("wsum"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("rscore") > S.HIGH_SCORE_ABOVE).alias("incr"),
        F.count_if(F.col("rscore") <= S.HIGH_SCORE_ABOVE).alias("decr"))
    return agg.select("userId", "candidate", priority("wsum", "n", "incr", "decr", penalty).alias("priority"),
                      "wsum", "n", "incr", "decr")


def priority(wsum, n, incr, decr, penalty: str = "as_written") -> F.Column:
    """mean(sim * score) + log term; see the module docstring for the two penalties."""
    if penalty not in ("as_written", "intended"):
        raise ValueError("penalty must be 'as_written' or 'intended'")
    col = lambda c: F.col(c) if isinstance(c, str) else c
    lg_incr = F.log10(F.greatest(col(incr), F.lit(1)).cast("double"))
    if penalty == "as_written":
        bonus = lg_incr - lg_incr
    else:
        bonus = lg_incr - F.log10(F.greatest(col(decr), F.lit(1)).cast("double"))
    return col(wsum) / col(n) + bonus


def recommend_batch_flat(events: DataFrame, queue: DataFrame, rated: DataFrame, sims: DataFrame,
                         threshold: float = S.SIMILARITY_THRESHOLD, penalty: str = "as_written",
                         n_candidates: int = S.MAX_SIM_PRODUCTS_NUM,
                         n_recent: int = S.RECENT_RATINGS_USED, pushed: bool = False,
                         scores: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Flat StreamRecs rows (userId, rank, productId, score) for the users of the batch;
    a user with no scored candidate has one row with NULL rank/product/score.

    events: (userId, productId, score, timestamp, seq); queue: recent queue before the
    batch (userId, pos, productId, score), or after it if ``pushed``; rated: (userId,
    productId) stored ratings; sims: (productId, recProductId, score). With ``scores`` the sims
    need only hold the partners of the events' products (``partners_needed``); it gives the
    similarity (productId, recProductId, score) of ``candidate_pairs``."""
    last = last_event_per_user(events)
    recent = queue.where(F.col("pos") <= n_recent) if pushed else recent_ratings(queue, events, n_recent)
    rated_all = rated.select("userId", "productId").unionByName(events.select("userId", "productId"))
    rated_users = rated_all.join(last.select("userId"), "userId", "left_semi")
    cands = candidates(last, sims, rated_users, n_candidates)
    if scores is not None:
        cands, recent = materialise(cands, "candidates"), materialise(recent, "recent")
        sims = scores(candidate_pairs(cands, recent))
    scored = score_candidates(cands, recent, sims, threshold, penalty)
    ranked = rank_within(scored, "userId", [F.desc("priority"), F.asc("candidate")])
    return (last.select("userId").join(ranked, "userId", "left")
            .select("userId", "rank", F.col("candidate").alias("productId"), F.col("priority").alias("score"),
                    "wsum", "n", "incr", "decr"))


def renumbered(flat: DataFrame, score) -> DataFrame:
    """StreamRecs rows (userId, rank, productId, score) of ``flat`` by another ``score``, in one pass;
    rows without a product keep their rank."""
    ranked = rank_within(flat.withColumn("score", score).withColumn("_empty", F.col("productId").isNull()),
                         ["userId", "_empty"], [F.desc("score"), F.asc("productId")], rank_col="_place")
    return ranked.select("userId", F.when(F.col("_empty"), F.col("rank")).otherwise(F.col("_place")).alias("rank"),
                         "productId", "score")


def recommend_batch(events: DataFrame, queue: DataFrame, rated: DataFrame, sims: DataFrame,
                    threshold: float = S.SIMILARITY_THRESHOLD, penalty: str = "as_written",
                    pushed: bool = False) -> DataFrame:
    """StreamRecs rows (userId, recs) for the users of the batch; recs may be empty."""
    flat = recommend_batch_flat(events, queue, rated, sims, threshold, penalty, pushed=pushed)
    nested = (flat.where(F.col("rank").isNotNull()).groupBy("userId")
              .agg(F.sort_array(F.collect_list(F.struct("rank", F.struct(
                  F.col("productId").cast("int").alias("productId"),
                  F.col("score").cast("double").alias("score")).alias("r")))).alias("ranked"))
              .select("userId", F.transform("ranked", lambda x: x["r"]).alias("recs")))
    users = events.select("userId").distinct()
    return users.join(nested, "userId", "left").select(
        "userId", F.coalesce("recs", F.array().cast(S.RECS)).alias("recs"))
