"""Table schemas and names of the recommender data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Table names used by the jobs and the serving layer.
PRODUCT = "Product"
RATING = "Rating"
USER = "User"
RATE_MORE_PRODUCTS = "RateMoreProducts"
RATE_MORE_RECENTLY_PRODUCTS = "RateMoreRecentlyProducts"
AVERAGE_PRODUCTS = "AverageProducts"
USER_RECS = "UserRecs"
PRODUCT_RECS = "ProductRecs"
ITEMCF_PRODUCT_RECS = "ItemCFProductRecs"
CONTENT_PRODUCT_RECS = "ContentBasedProductRecs"
STREAM_RECS = "StreamRecs"

# List sizes and thresholds of the reference jobs.
USER_MAX_RECOMMENDATION = 20
ITEMCF_MAX_RECOMMENDATION = 10
MAX_USER_RATINGS_NUM = 20  # the queue read is inclusive, so 21 entries are used
RECENT_RATINGS_USED = MAX_USER_RATINGS_NUM + 1
MAX_SIM_PRODUCTS_NUM = 20
RECENT_QUEUE_SIZE = 40
SIMILARITY_THRESHOLD = 0.4
HIGH_SCORE_ABOVE = 3.0
TFIDF_NUM_FEATURES = 800
ALS_RANK, ALS_ITERATIONS, ALS_LAMBDA = 5, 10, 0.1
ALS_GRID_RANKS = (5, 10, 20, 50)
ALS_GRID_LAMBDAS = (1.0, 0.1, 0.01)
RATING_LOG_PREFIX = "PRODUCT_RATING_PREFIX"
RATING_LOG_KEY = "logProcessor"

PRODUCT_SCHEMA = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("imageUrl", T.StringType(), True),
    T.StructField("categories", T.StringType(), True),
    T.StructField("tags", T.StringType(), True),
])

RATING_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType(), False),
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("timestamp", T.LongType(), False),
])

REC_STRUCT = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])
RECS = T.ArrayType(REC_STRUCT, False)

USER_RECS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType(), False),
    T.StructField("recs", RECS, False),
])

PRODUCT_RECS_SCHEMA = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("recs", RECS, False),
])

FLAT_RECS_SCHEMA = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("recProductId", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])

USER_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType(), False),
    T.StructField("username", T.StringType(), False),
    T.StructField("password", T.StringType(), True),
    T.StructField("first", T.BooleanType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("prefGenres", T.ArrayType(T.StringType(), False), False),
])

RATE_MORE_SCHEMA = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("count", T.LongType(), False),
])

RATE_MORE_RECENTLY_SCHEMA = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("count", T.LongType(), False),
    T.StructField("yearmonth", T.IntegerType(), False),
])

AVERAGE_SCHEMA = T.StructType([
    T.StructField("productId", T.IntegerType(), False),
    T.StructField("avg", T.DoubleType(), False),
])


def nested_name(table: str) -> str:
    """The table that holds the lists of ``table`` in one row per product."""
    return table + "Nested"


TABLE_SCHEMAS = {
    PRODUCT: PRODUCT_SCHEMA,
    RATING: RATING_SCHEMA,
    USER: USER_SCHEMA,
    RATE_MORE_PRODUCTS: RATE_MORE_SCHEMA,
    RATE_MORE_RECENTLY_PRODUCTS: RATE_MORE_RECENTLY_SCHEMA,
    AVERAGE_PRODUCTS: AVERAGE_SCHEMA,
    USER_RECS: USER_RECS_SCHEMA,
    PRODUCT_RECS: FLAT_RECS_SCHEMA,
    nested_name(PRODUCT_RECS): PRODUCT_RECS_SCHEMA,
    ITEMCF_PRODUCT_RECS: PRODUCT_RECS_SCHEMA,
    CONTENT_PRODUCT_RECS: FLAT_RECS_SCHEMA,
    nested_name(CONTENT_PRODUCT_RECS): PRODUCT_RECS_SCHEMA,
    STREAM_RECS: USER_RECS_SCHEMA,
}

# Flat similarity tables: product and rank of a row, in this many buckets by product.
FLAT_TABLES = (PRODUCT_RECS, CONTENT_PRODUCT_RECS)
RECS_BUCKETS = 64
# Users per partition of the Rating table.
USERS_PER_RANGE = 10_000
