"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the given test tables (through ``shoprank.sources.testdata``) in
full and returns flat, typed rows whose column names match the SQL oracle
(``shoprank.plans.oracle``). Float columns are rounded to 6 places for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank import schemas
from shoprank.functions.columns import normalise_score, rating_log_line, recs_to_map, username_hash
from shoprank.operators import (als, content, cooccurrence, maintenance, online, serving, similarity,
                                stats, topk)
from shoprank.session import materialise, sized_by_rows
from shoprank.sources import testdata as td
from shoprank.streaming import logfilter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def r6(col) -> F.Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


@query("rate_more_products")
def q_rate_more_products(spark, sf):
    return stats.rate_more_products(td.ratings(spark, sf))


@query("rate_more_recently")
def q_rate_more_recently(spark, sf):
    return stats.rate_more_recently(td.ratings(spark, sf))


@query("average_products")
def q_average_products(spark, sf):
    return stats.average_products(td.ratings(spark, sf)).select("productId", r6("avg").alias("avg"))


@query("item_cooccurrence")
def q_item_cooccurrence(spark, sf):
    return cooccurrence.cooccurrence(td.ratings(spark, sf))


@query("itemcf_recs")
def q_itemcf_recs(spark, sf):
    return cooccurrence.itemcf_flat(td.ratings(spark, sf)).withColumn("score", r6("score"))


def ranked_pairs(pairs: DataFrame, key: str = "productId", item: str = "recProductId") -> DataFrame:
    """Flat similarity list with rank (score rounded first, ties on ascending item)."""
    rounded = pairs.withColumn("score", r6("score"))
    return topk.rank_within(rounded, key, [F.desc("score"), F.asc(item)]).select(key, "rank", item, "score")


@query("tag_tokens")
def q_tag_tokens(spark, sf):
    return content.tag_tokens(td.products(spark, sf))


@query("tf_idf_weights")
def q_tf_idf_weights(spark, sf):
    return content.tf_idf(td.products(spark, sf)).withColumn("weight", r6("weight"))


@query("content_similarity")
def q_content_similarity(spark, sf):
    return content.ranked_similarity(content.tf_idf(td.products(spark, sf)))


@query("content_similarity_hashed")
def q_content_similarity_hashed(spark, sf):
    return content.ranked_similarity(content.hashed_tf_idf(td.products(spark, sf)))


@query("vector_similarity")
def q_vector_similarity(spark, sf):
    vecs = td.table(spark, sf, "embeddings").select("vec_id", "embedding")
    pairs = similarity.dense_cosine(vecs, id_col="vec_id", vec_col="embedding")
    return ranked_pairs(pairs.select(F.col("id1").alias("vecId"), F.col("id2").alias("recVecId"), "score"),
                        "vecId", "recVecId")


# ------------------------------------------------------------------ serving reads

def _averages(ratings: DataFrame) -> DataFrame:
    return stats.average_products(ratings, ordered=False)


def _hydrated(df: DataFrame) -> DataFrame:
    return df.withColumn("score", r6("score"))


@query("hot_products")
def q_hot_products(spark, sf):
    r = td.ratings(spark, sf)
    return _hydrated(serving.hot_products(stats.rate_more_recently(r, ordered=False),
                                          td.products(spark, sf), _averages(r), 20))


@query("most_rated_products")
def q_most_rated_products(spark, sf):
    r = td.ratings(spark, sf)
    return _hydrated(serving.most_rated(stats.rate_more_products(r, ordered=False),
                                        td.products(spark, sf), _averages(r), 20))


@query("product_info")
def q_product_info(spark, sf):
    r = td.ratings(spark, sf)
    ids = td.rating_events(spark, sf).select("productId")
    return _hydrated(serving.product_info(ids, td.products(spark, sf), _averages(r)))


@query("product_search")
def q_product_search(spark, sf):
    r = td.ratings(spark, sf)
    return _hydrated(serving.search_products(td.products(spark, sf), _averages(r), "red|green"))


def _requests(spark, sf) -> DataFrame:
    """Products just bought (purchase events) are the lookup requests."""
    return td.rating_events(spark, sf).select(F.col("productId").alias("requestKey"))


@query("itemcf_lookup")
def q_itemcf_lookup(spark, sf):
    r = td.ratings(spark, sf)
    asked = _requests(spark, sf)
    flat = cooccurrence.itemcf_flat_of(r, asked.select(F.col("requestKey").alias("productId"))).withColumnRenamed(
        "productId", "requestKey")
    return _hydrated(serving.lookup_flat(_requests(spark, sf), flat, td.products(spark, sf), _averages(r),
                                         "requestKey", "recProductId"))


@query("content_lookup")
def q_content_lookup(spark, sf):
    r = td.ratings(spark, sf)
    asked = _requests(spark, sf)
    flat = content.ranked_similarity(content.tf_idf(td.products(spark, sf)),
                                     of=asked.select(F.col("requestKey").alias("productId"))).withColumnRenamed(
        "productId", "requestKey")
    return _hydrated(serving.lookup_flat(asked, flat, td.products(spark, sf), _averages(r),
                                         "requestKey", "recProductId"))


@query("recs_roundtrip")
def q_recs_roundtrip(spark, sf):
    nested = cooccurrence.item_cf(td.ratings(spark, sf))
    as_map = nested.select("productId", "recs", recs_to_map("recs").alias("m"))
    flat = as_map.select("productId", "m", F.posexplode("recs").alias("pos", "rec"))
    return flat.select("productId", (F.col("pos") + 1).alias("rank"),
                       F.col("rec.productId").alias("recProductId"), r6("rec.score").alias("score"),
                       r6(F.element_at("m", F.col("rec.productId"))).alias("mapScore"))


# ------------------------------------------------------------------ users and ratings

def _users(spark, sf, customers: DataFrame | None = None) -> DataFrame:
    cust = customers if customers is not None else td.customers(spark, sf)
    incoming = cust.select("username", F.lit("").alias("password"), F.col("custkey").alias("seq"))
    empty = spark.createDataFrame([], schemas.USER_SCHEMA)
    return maintenance.register_users(empty, incoming, now_ms=REGISTERED_AT_MS)


REGISTERED_AT_MS = 1_700_000_000_000


@query("resolve_users")
def q_resolve_users(spark, sf):
    cust = td.customers(spark, sf)
    active = td.table(spark, sf, "events").select(F.col("user_id").cast("int").alias("custkey"))
    requests = cust.join(active, "custkey", "left_semi").select("username")
    return serving.resolve_users(requests, _users(spark, sf))


@query("register_users")
def q_register_users(spark, sf):
    cust = td.customers(spark, sf)
    web = td.table(spark, sf, "events").select(F.col("user_id").cast("int").alias("custkey"))
    existing = _users(spark, sf, cust.join(web, "custkey", "left_semi"))
    incoming = cust.select("username", F.lit("").alias("password"), F.col("custkey").alias("seq"))
    return maintenance.register_users(existing, incoming, now_ms=REGISTERED_AT_MS).drop("prefGenres")


@query("update_user_preferences")
def q_update_user_preferences(spark, sf):
    cust = td.customers(spark, sf)
    ev = td.table(spark, sf, "events").select(F.col("user_id").cast("int").alias("custkey"), "event_type")
    changes = (ev.join(cust, "custkey").groupBy("username")
               .agg(F.sort_array(F.collect_set("event_type")).alias("prefGenres"))
               .select(username_hash("username").alias("userId"), F.lit(False).alias("first"), "prefGenres"))
    out = maintenance.update_preferences(_users(spark, sf, cust), changes)
    return out.select("userId", "username", "first", F.array_join("prefGenres", ",").alias("prefs"))


def _events(spark, sf) -> DataFrame:
    return td.rating_events(spark, sf).withColumnRenamed("event_id", "seq")


@query("ingest_ratings")
def q_ingest_ratings(spark, sf):
    return maintenance.ingest_ratings(td.ratings(spark, sf), _events(spark, sf))


# ------------------------------------------------------------------ online re-ranking

def _online_inputs(spark, sf):
    # candidates and recent products of a batch compress well, so their files say little about their rows
    sized_by_rows(spark)
    # the per-batch plan reads the events, and the ratings of their users, several times:
    # materialise them once
    events = materialise(_events(spark, sf), "events")
    r = materialise(online.batch_ratings(td.ratings(spark, sf), events), "ratings")
    # of the similarity table (content pairs with scores at 6 decimals) the batch reads the first
    # partners of the events' products, and the scores of its candidates with recent products
    vectors = content.collapsed(content.tf_idf(td.products(spark, sf)))
    rated_all = r.select("userId", "productId").unionByName(events.select("userId", "productId"))
    need = online.partners_needed(online.last_event_per_user(events), rated_all)
    partners = materialise(content.ranked_similarity(vectors, of=materialise(need, "partners-needed")), "similarity")

    def scores(pairs: DataFrame) -> DataFrame:
        return materialise(content.pair_similarity(vectors, pairs).withColumn("score", r6("score")), "similarity")
    return events, maintenance.recent_from_ratings(r), r, partners, scores


@query("recent_ratings")
def q_recent_ratings(spark, sf):
    queue = maintenance.recent_from_ratings(td.ratings(spark, sf))
    return online.recent_ratings(queue, _events(spark, sf))


@query("stream_candidates")
def q_stream_candidates(spark, sf):
    events, _, rated, sims, _ = _online_inputs(spark, sf)
    last = online.last_event_per_user(events)
    rated_all = rated.select("userId", "productId").unionByName(events.select("userId", "productId"))
    return online.candidates(last, sims, rated_all).select(
        "userId", "rank", F.col("candidate").alias("productId"), "sim")


@query("stream_scores")
def q_stream_scores(spark, sf):
    events, queue, rated, sims, scores = _online_inputs(spark, sf)
    last = online.last_event_per_user(events)
    rated_all = rated.select("userId", "productId").unionByName(events.select("userId", "productId"))
    cands = materialise(online.candidates(last, sims, rated_all), "candidates")
    recent = materialise(online.recent_ratings(queue, events), "recent")
    scored = online.score_candidates(cands, recent, scores(online.candidate_pairs(cands, recent)))
    # the sum of 6-decimal products is rounded back to 6 decimals (float noise only), so
    # both engines divide the same doubles; the priority itself is not re-rounded
    return scored.select("userId", F.col("candidate").alias("productId"),
                         online.priority(r6("wsum"), "n", "incr", "decr").alias("priority"),
                         "incr", "decr")


def _stream_recs(spark, sf, penalty):
    events, queue, rated, sims, scores = _online_inputs(spark, sf)
    flat = online.recommend_batch_flat(events, queue, rated, sims, penalty=penalty, scores=scores)
    return online.renumbered(flat, online.priority(r6("wsum"), "n", "incr", "decr", penalty))


@query("stream_recs")
def q_stream_recs(spark, sf):
    return _stream_recs(spark, sf, "as_written")


@query("stream_recs_intended")
def q_stream_recs_intended(spark, sf):
    return _stream_recs(spark, sf, "intended")


# ------------------------------------------------------------------ log lines

@query("log_filter")
def q_log_filter(spark, sf):
    return logfilter.filter_rating_log(td.log_lines(spark, sf))


@query("parse_rating_events")
def q_parse_rating_events(spark, sf):
    return logfilter.parse_rating_events(logfilter.filter_rating_log(td.log_lines(spark, sf)))


@query("rating_log_lines")
def q_rating_log_lines(spark, sf):
    r = td.ratings(spark, sf)
    return r.select(rating_log_line("userId", "productId", "score", "timestamp").alias("value"))


# ------------------------------------------------------------------ ALS (no SQL oracle)

@query("prediction_rmse")
def q_prediction_rmse(spark, sf):
    """Hold-out RMSE of a fixed predictor (train-set product mean); the split is by
    time (orders before 2000 train, the rest test), so SQL can check it."""
    r = td.ratings(spark, sf)
    train, test = r.where(F.col("timestamp") < 946684800), r.where(F.col("timestamp") >= 946684800)
    pred = stats.average_products(train, ordered=False).withColumnRenamed("avg", "prediction")
    out = als.rmse(test.join(pred, "productId"))
    return out.select(r6("rmse").alias("rmse"), "n")


@query("als_user_recs")
def q_als_user_recs(spark, sf):
    model = als.fit_als(td.ratings(spark, sf))
    return als.predict_top_n(model).select("userId", "rank", "productId", "score")


@query("als_product_recs")
def q_als_product_recs(spark, sf):
    """All item pairs with factor cosine > 0.4, both directions, as flat rows. On rank-5
    factors most pairs pass (92% at sf0.1), so the list order is left to ``to_recs``
    when the nested table is written; ranking 370M rows here would dominate the run."""
    model = als.fit_als(td.ratings(spark, sf))
    return als.product_recommendations(model).withColumn("score", r6("score"))


def _factors(spark, sf) -> DataFrame:
    """Embeddings as latent factors (id, features), so that SQL can check the scoring of
    factors without a fitted model."""
    return td.table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))


@query("factor_top_n")
def q_factor_top_n(spark, sf):
    """Each vector's 20 best others and itself by dot product, as ALS user recommendations are
    taken from user and item factors."""
    factors = _factors(spark, sf)
    return als.factor_top_n(factors, factors, 20, block_rows=512, decimals=6)


@query("factor_predictions")
def q_factor_predictions(spark, sf):
    """Dot product of factors for every web event's (user, product) pair; unknown ids give none."""
    ev = td.table(spark, sf, "events").select(F.col("event_id"), F.col("user_id").cast("int").alias("userId"),
                                              F.get_json_object("props", "$.k").cast("int").alias("productId"))
    factors = _factors(spark, sf)
    out = als.predict_pairs(ev, factors, factors)
    return out.withColumn("prediction", r6("prediction"))


@query("rejected_events")
def q_rejected_events(spark, sf):
    """Records of all events that do not decode (see ``testdata.raw_records``)."""
    return logfilter.rejected_events(td.raw_records(spark, sf))


@query("als_grid")
def q_als_grid(spark, sf):
    return als.tune_als(td.ratings(spark, sf))


@query("distinct_entities")
def q_distinct_entities(spark, sf):
    users, products = stats.distinct_entities(td.ratings(spark, sf))
    return (users.select(F.lit("user").alias("kind"), F.col("userId").alias("id"))
            .unionByName(products.select(F.lit("product").alias("kind"), F.col("productId").alias("id"))))


@query("normalised_ui_ratings")
def q_normalised_ui_ratings(spark, sf):
    """Purchases rated on the 1..10 UI scale (floor(value) % 10 + 1), halved to 0.5..5."""
    ev = td.table(spark, sf, "events").where(F.col("event_type") == "purchase")
    ui = ((F.floor("value").cast("bigint") % 10) + 1).cast("double")
    return ev.select(F.col("user_id").cast("int").alias("userId"),
                     F.get_json_object("props", "$.k").cast("int").alias("productId"),
                     normalise_score(ui).alias("score"))


def _web_users(spark, sf) -> DataFrame:
    """Users of the web events are the lookup requests of the per-user reads."""
    return td.table(spark, sf, "events").select(F.col("user_id").cast("int").alias("userId"))


@query("stream_recs_lookup")
def q_stream_recs_lookup(spark, sf):
    """SV7: StreamRecs of the web users, hydrated (list order as in ``stream_recs``)."""
    recs = _stream_recs(spark, sf, "as_written")
    r = td.ratings(spark, sf)
    return _hydrated(serving.lookup_flat(_web_users(spark, sf), recs, td.products(spark, sf), _averages(r),
                                         "userId", "productId"))


@query("user_recs_lookup")
def q_user_recs_lookup(spark, sf):
    """SV6: ALS UserRecs of the web users, hydrated (no SQL oracle: ALS)."""
    r = td.ratings(spark, sf)
    recs = als.predict_top_n(als.fit_als(r)).select("userId", "rank", "productId")
    return _hydrated(serving.lookup_flat(_web_users(spark, sf), recs, td.products(spark, sf), _averages(r),
                                         "userId", "productId"))
