import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shoprank import schemas as S
from shoprank.operators import serving
from shoprank.operators.maintenance import ingest_ratings
from shoprank.plans import jobs
from shoprank.sources import testdata as td
from shoprank.sources.files import load_tables, read_table, write_bucketed
from shoprank.streaming import online as stream


def test_batch_jobs_and_stream_end_to_end(spark, tmp_dir):
    base = os.path.join(tmp_dir, "tables")
    load_tables(td.products(spark, SF001), td.ratings(spark, SF001), base)
    jobs.statistics(spark, base)
    jobs.item_cf(spark, base)
    jobs.content_based(spark, base, vectoriser="exact")
    jobs.offline(spark, base, nested=True)
    n_products = read_table(spark, base, S.PRODUCT).count()
    assert read_table(spark, base, S.RATE_MORE_PRODUCTS).count() == n_products
    assert read_table(spark, base, S.ITEMCF_PRODUCT_RECS).where(F.size("recs") > 10).count() == 0
    recent = read_table(spark, base, S.RATE_MORE_RECENTLY_PRODUCTS)
    assert recent.select("yearmonth").distinct().count() > 1
    assert read_table(spark, base, S.CONTENT_PRODUCT_RECS).columns == ["productId", "rank", "recProductId", "score"]
    nested = S.nested_name(S.PRODUCT_RECS)
    assert "recs" in read_table(spark, base, nested).columns
    nested_sims = jobs.similarity_pairs(spark, base, nested)
    assert nested_sims.where("rank = 1").count() == read_table(spark, base, nested).where(F.size("recs") > 0).count()
    user_recs = read_table(spark, base, S.USER_RECS)
    assert user_recs.where((F.size("recs") > 20) | (F.size("recs") == 0)).count() == 0
    # the stored content lists feed the stream recommender with their list rank
    sims = jobs.similarity_pairs(spark, base)
    sims_path = os.path.join(tmp_dir, "sims")
    sims.write.parquet(sims_path)
    first = sims.where("rank = 1").select("productId", "recProductId").first()
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write(f"7|{first.productId}|5.0|1700000000\n")
    q = stream.start_recommender(stream.read_text_stream(spark, src), os.path.join(tmp_dir, "state"),
                                 os.path.join(base, S.RATING), sims_path,
                                 checkpoint=os.path.join(tmp_dir, "ck"), trigger="availableNow")
    q.awaitTermination()
    recs = stream.current_stream_recs(spark, os.path.join(tmp_dir, "state")).collect()
    assert [r.userId for r in recs] == [7]
    scores = [x.score for x in recs[0].recs]
    assert scores == sorted(scores, reverse=True)


PAIRS = [(1, 1, 2, 0.9), (1, 2, 3, 0.8), (2, 1, 1, 0.9), (3, 1, 1, 0.8), (9, 1, 404, 0.7)]


def _list_table(spark, base):
    flat = spark.createDataFrame(PAIRS, "productId int, rank int, recProductId int, score double")
    write_bucketed(flat.limit(1), base, S.PRODUCT_RECS)
    write_bucketed(flat, base, S.PRODUCT_RECS)  # replaced, not added to
    return read_table(spark, base, S.PRODUCT_RECS)


def _lookup(spark, requests, table):
    products = spark.createDataFrame([(k, f"p{k}", "", "", "") for k in (1, 2, 3)], S.PRODUCT_SCHEMA)
    averages = spark.createDataFrame([(1, 4.0), (3, 2.0)], "productId int, avg double")
    keyed = table.withColumnRenamed("productId", "requestKey")
    return serving.lookup_flat(requests, keyed, products, averages, "requestKey", "recProductId")


def test_stored_lists_are_read_back_and_looked_up(spark, tmp_dir):
    table = _list_table(spark, tmp_dir)
    assert sorted(map(tuple, table.collect())) == sorted(PAIRS)
    requests = spark.createDataFrame([(1,), (9,), (77,), (1,)], "requestKey int")
    assert sorted((r.requestKey, r.rank, r.productId, r.score) for r in _lookup(spark, requests, table).collect()) == [
        (1, 1, 2, 0.0), (1, 2, 3, 2.0)]
    other = spark.newSession()  # a session whose catalog has not seen the table
    assert sorted(map(tuple, read_table(other, tmp_dir, S.PRODUCT_RECS).collect())) == sorted(PAIRS)


def test_the_stored_side_of_a_lookup_is_not_shuffled(spark, tmp_dir):
    table = _list_table(spark, tmp_dir)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false")):
            spark.conf.set(k, v)
        requests = spark.range(5).select(F.col("id").cast("int").alias("productId"))
        joined = table.join(requests, "productId", "left_semi")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # that of the requests
        own = plan[:plan.index("Exchange")]
        assert "FileScan parquet" in own and "Bucketed: true" in own and f"SelectedBucketsCount: {S.RECS_BUCKETS}" in own
        assert sorted(r.productId for r in joined.collect()) == [1, 1, 2, 3]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_table_without_a_declared_column_fails(spark, tmp_dir):
    spark.createDataFrame([(1, 2)], "productId int, other int").write.parquet(os.path.join(tmp_dir, S.AVERAGE_PRODUCTS))
    with pytest.raises(ValueError, match="no column avg"):
        read_table(spark, tmp_dir, S.AVERAGE_PRODUCTS)


def _files(base):
    return {d: sorted(f for f in os.listdir(os.path.join(base, S.RATING, d)) if f.endswith(".parquet"))
            for d in os.listdir(os.path.join(base, S.RATING)) if d.startswith("userRange=")}


def test_ingest_rewrites_only_the_ranges_of_the_batch(spark, tmp_dir):
    step = S.USERS_PER_RANGE
    rows = [(u, p, 3.0, 100 + p) for u in (1, 2, step + 1, 2 * step + 1, 2 * step + 2) for p in (1, 2)]
    ratings = spark.createDataFrame(rows, S.RATING_SCHEMA)
    load_tables(td.products(spark, SF001), ratings, tmp_dir)
    before = _files(tmp_dir)
    assert len(before) == 3
    batch = spark.createDataFrame([(step + 1, 2, 5.0, 900, 1), (step + 1, 9, 1.0, 901, 2), (7 * step, 1, 2.0, 902, 3)],
                                  "userId int, productId int, score double, timestamp bigint, seq bigint")
    jobs.ingest(spark, tmp_dir, batch)
    after = _files(tmp_dir)
    assert len(after) == 4 and all((after[d] == files) == (d != "userRange=1") for d, files in before.items())
    want = sorted(map(tuple, ingest_ratings(ratings, batch).collect()))
    assert sorted(map(tuple, read_table(spark, tmp_dir, S.RATING).collect())) == want
    jobs.ingest(spark, tmp_dir, batch)  # again: the same table
    assert sorted(map(tuple, read_table(spark, tmp_dir, S.RATING).collect())) == want
    jobs.ingest(spark, tmp_dir, batch.limit(0))
    assert sorted(map(tuple, read_table(spark, tmp_dir, S.RATING).collect())) == want
