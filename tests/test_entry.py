import __spark_entry__ as E

from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["productId", "rank", "recProductId", "score"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed_rows_only():
    rows_only = {"content_similarity_hashed", "als_user_recs", "als_product_recs", "als_grid", "user_recs_lookup"}
    assert set(E.QUERIES) - set(E.oracle_sql()) == rows_only
    assert set(E.oracle_sql()) <= set(E.queries())


def test_fast_queries_run_on_smoke_data(spark):
    qs = E.queries()
    for name in ["rate_more_recently", "hot_products", "content_lookup", "stream_recs", "log_filter",
                 "ingest_ratings", "register_users"]:
        assert qs[name](spark, SF001).count() > 0, name
