import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoprank.functions import columns as C
from shoprank.operators.content import tokenize


def jvm_hash(s: str) -> int:
    h = 0
    units = s.encode("utf-16-be")
    for i in range(0, len(units), 2):
        h = (31 * h + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_jvm_trim(spark):
    assert one(spark, C.jvm_trim("v"), "\t a b \n\x01") == "a b"
    assert one(spark, C.jvm_trim("v"), "   ") == ""


def test_year_month_edges(spark):
    end = int(dt.datetime(2015, 12, 31, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp())
    assert one(spark, C.year_month("v"), end, "v bigint") == 201512
    assert one(spark, C.year_month("v"), end + 1, "v bigint") == 201601


def test_year_month_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, C.year_month("v"), 1451606400, "v bigint") == 201601
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normalise_seconds_and_score(spark):
    assert one(spark, C.normalise_seconds("v"), 1451606400123, "v bigint") == 1451606400
    assert one(spark, C.normalise_seconds("v"), 1451606400, "v bigint") == 1451606400
    assert one(spark, C.normalise_score("v"), 7.0, "v double") == 3.5
    assert one(spark, C.normalise_score("v"), 3.0, "v double") == 1.5


def test_username_hash_edges(spark):
    assert one(spark, C.username_hash("v"), "") == 0
    for name in ["alice", "Customer#000000001", "a much longer user name than usual", "ünïcødé"]:
        assert one(spark, C.username_hash("v"), name) == jvm_hash(name)
    # a name whose hash wraps negative
    neg = "polygenelubricants"
    assert jvm_hash(neg) < 0 and one(spark, C.username_hash("v"), neg) == jvm_hash(neg)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=8))
def test_username_hash_property(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = [r["h"] for r in df.select(C.username_hash("v").alias("h")).collect()]
    assert got == [jvm_hash(n) for n in names]


def test_tokenize_like_jvm_split(spark):
    assert one(spark, tokenize(C.tags_to_text(F.col("v"))), "A|b||C|") == ["a", "b", "", "c"]
    assert one(spark, tokenize(F.col("v")), "") == [""]
    assert one(spark, tokenize(F.col("v")), "   ") == []


def test_rating_payload(spark):
    p = C.rating_payload("v")
    assert one(spark, p, "INFO PRODUCT_RATING_PREFIX: 1|2|3.0|4 ") == "1|2|3.0|4"
    assert one(spark, p, "no prefix here") is None
    assert one(spark, p, "x PRODUCT_RATING_PREFIX:") is None
    assert one(spark, p, "PRODUCT_RATING_PREFIX:1|2|3.0|4 PRODUCT_RATING_PREFIX:9") == "1|2|3.0|4"


def test_rating_log_line(spark):
    df = spark.createDataFrame([(1, 2, 4.0, 99)], "u int, p int, s double, t bigint")
    assert df.select(C.rating_log_line("u", "p", "s", "t")).first()[0] == "PRODUCT_RATING_PREFIX:1|2|4.0|99"


def test_cosine_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(C.cosine("a", "b")).collect()]
    assert got[0] is None and abs(got[1] - 1.0) < 1e-12


def test_statistics_come_in_their_order(spark):
    """TK1-TK3: most rated, latest month and best average first, ties by product."""
    from shoprank.operators import stats

    day = 86_400
    rows = [(1, p, s, t * day) for p, s, t in [(5, 1.0, 0), (5, 5.0, 40), (3, 3.0, 0), (3, 3.0, 1), (9, 3.0, 40), (8, 3.0, 40), (8, 3.0, 41), (2, 5.0, 400)]]
    ratings = spark.createDataFrame(rows, "userId int, productId int, score double, timestamp bigint").repartition(5)
    assert [tuple(r) for r in stats.rate_more_products(ratings).collect()] == [(3, 2), (5, 2), (8, 2), (2, 1), (9, 1)]
    assert [tuple(r) for r in stats.rate_more_recently(ratings).collect()] == [
        (2, 1, 197102), (8, 2, 197002), (5, 1, 197002), (9, 1, 197002), (3, 2, 197001), (5, 1, 197001)]
    assert [tuple(r) for r in stats.average_products(ratings).collect()] == [(2, 5.0), (3, 3.0), (5, 3.0), (8, 3.0), (9, 3.0)]
