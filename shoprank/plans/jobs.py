"""Batch jobs: each reads named tables under ``base``, runs one composition of
operators and overwrites its result tables (nested ``key, recs`` shape where the
reference has it). The same compositions are available as DataFrame functions in
``shoprank.operators``; these wrappers only add reading, caching and writing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank import schemas as S
from shoprank.operators import als, content, cooccurrence, stats
from shoprank.operators.maintenance import ingest_ratings
from shoprank.operators.topk import explode_recs, rank_within, to_recs
from shoprank.sources.files import (load_tables, merge_ratings, read_products, read_ratings, read_table, write_bucketed,
                                     write_table)


def load(spark: SparkSession, products_path: str, ratings_path: str, base: str, mode: str = "strict") -> None:
    """JB1: product and rating text files -> Product and Rating tables."""
    load_tables(read_products(spark, products_path, mode), read_ratings(spark, ratings_path, mode), base)


def statistics(spark: SparkSession, base: str) -> None:
    """JB2-JB4: RateMoreProducts, RateMoreRecentlyProducts, AverageProducts from one scan."""
    ratings = read_table(spark, base, S.RATING).select("productId", "score", "timestamp").persist()
    try:
        write_table(stats.rate_more_products(ratings, ordered=False), base, S.RATE_MORE_PRODUCTS)
        write_table(stats.rate_more_recently(ratings, ordered=False), base, S.RATE_MORE_RECENTLY_PRODUCTS,
                    partition_by=["yearmonth"])  # lets the hot-products read prune to recent months
        write_table(stats.average_products(ratings, ordered=False), base, S.AVERAGE_PRODUCTS)
    finally:
        ratings.unpersist()


def item_cf(spark: SparkSession, base: str, n: int = S.ITEMCF_MAX_RECOMMENDATION) -> None:
    """JB8: co-occurrence top-n lists -> ItemCFProductRecs."""
    write_table(cooccurrence.item_cf(read_table(spark, base, S.RATING), n), base, S.ITEMCF_PRODUCT_RECS)


def _write_similarity(ranked: DataFrame, base: str, name: str, nested: bool) -> None:
    """Similarity lists have no size cap (every partner above 0.4), so by default they
    are written flat, one row per (product, rank), in buckets by product; ``nested=True``
    writes the reference shape (one array per product) as table ``schemas.nested_name(name)``,
    whose rows grow with the catalogue."""
    if nested:
        write_table(to_recs(ranked, "productId", "recProductId", "score", ranked=True), base, S.nested_name(name))
    else:
        write_bucketed(ranked, base, name)


def ingest(spark: SparkSession, base: str, incoming: DataFrame) -> None:
    """WR1: rating events (userId, productId, score, timestamp, seq) into the Rating table; user
    ranges without an event are neither read nor written."""
    merge_ratings(spark, base, incoming, ingest_ratings)


def content_based(spark: SparkSession, base: str, vectoriser: str = "hashing", nested: bool = False) -> None:
    """JB9: TF-IDF cosine lists -> ContentBasedProductRecs (hashing = reference parity)."""
    products = read_table(spark, base, S.PRODUCT)
    weights = content.tf_idf(products) if vectoriser == "exact" else content.hashed_tf_idf(products)
    _write_similarity(content.ranked_similarity(weights, decimals=None), base, S.CONTENT_PRODUCT_RECS, nested)


def offline(spark: SparkSession, base: str, rank: int = S.ALS_RANK, iters: int = S.ALS_ITERATIONS,
            lam: float = S.ALS_LAMBDA, seed: int = 42, nested: bool = False) -> None:
    """JB5 + JB6: one ALS fit -> UserRecs (top 20, score > 0) and ProductRecs (factor cosine)."""
    model = als.fit_als(read_table(spark, base, S.RATING), rank, iters, lam, seed)
    write_table(als.user_recommendations(model), base, S.USER_RECS)
    ranked = rank_within(als.product_recommendations(model), "productId",
                         [F.desc("score"), F.asc("recProductId")])
    _write_similarity(ranked, base, S.PRODUCT_RECS, nested)


def tune(spark: SparkSession, base: str, seed: int = 42) -> DataFrame:
    """JB7: rank x lambda grid, best first (returned, not printed)."""
    return als.tune_als(read_table(spark, base, S.RATING), seed=seed)


def similarity_pairs(spark: SparkSession, base: str, table: str = S.CONTENT_PRODUCT_RECS) -> DataFrame:
    """Flat (productId, rank, recProductId, score) from a similarity table (flat, or
    nested, then rank is the list position), for the online recommender, which reads
    candidates by rank band without re-sorting."""
    recs = read_table(spark, base, table)
    if "recs" not in recs.columns:
        return recs
    flat = explode_recs(recs.withColumnRenamed("productId", "ofProduct"), "ofProduct")
    return flat.select(F.col("ofProduct").alias("productId"), "rank", F.col("productId").alias("recProductId"), "score")
