from pyspark.sql import functions as F

from shoprank.operators import maintenance, online
from shoprank.session import apply_sql_conf, materialise, sized_by_rows

EV = "userId int, productId int, score double, timestamp bigint, seq bigint"
Q = "userId int, pos int, productId int, score double"
SIM = "productId int, recProductId int, score double"
RT = "userId int, productId int"


def run(spark, events, queue, rated, sims, penalty="as_written"):
    e = spark.createDataFrame(events, EV)
    q = spark.createDataFrame(queue, Q)
    r = spark.createDataFrame(rated, RT)
    s = spark.createDataFrame(sims, SIM)
    return {x.userId: [(y.productId, round(y.score, 9)) for y in x.recs]
            for x in online.recommend_batch(e, q, r, s, penalty=penalty).collect()}


def test_product_missing_from_similarity_table(spark):
    got = run(spark, [(1, 99, 5.0, 10, 1)], [], [], [(1, 2, 0.9), (2, 1, 0.9)])
    assert got == {1: []}


def test_all_candidates_already_rated(spark):
    sims = [(1, 2, 0.9), (2, 1, 0.9)]
    got = run(spark, [(1, 1, 5.0, 10, 1)], [], [(1, 2)], sims)
    assert got == {1: []}


def test_scoring_and_low_score_of_three(spark):
    sims = [(1, 2, 0.9), (2, 1, 0.9), (2, 3, 0.5), (3, 2, 0.5), (1, 3, 0.3), (3, 1, 0.3)]
    # user rates product 1 with 5; queue already holds product 3 with score 3 (low)
    got = run(spark, [(1, 1, 5.0, 10, 1)], [(1, 1, 3, 3.0)], [(1, 3)], sims)
    # candidate 2: recent (1:5.0 sim .9), (3:3.0 sim .5) -> mean(4.5, 1.5) = 3.0
    assert got == {1: [(2, 3.0)]}
    intended = run(spark, [(1, 1, 5.0, 10, 1)], [(1, 1, 3, 3.0)], [(1, 3)], sims, "intended")
    assert intended == {1: [(2, 3.0)]}  # incr 1, decr 1 -> log terms cancel
    got2 = run(spark, [(1, 1, 5.0, 10, 1)], [], [], sims, "intended")
    assert got2 == {1: [(2, 4.5)]}


def test_only_21_recent_entries_are_used(spark):
    sims = [(1, 100 + i, 0.9) for i in range(22)] + [(100 + i, 1, 0.9) for i in range(22)]
    sims += [(50, 100 + i, 0.9) for i in range(22)] + [(100 + i, 50, 0.9) for i in range(22)]
    # 22 queued ratings of products 100..121 (pos 1 newest); the new event pushes one more
    queue = [(1, i + 1, 100 + i, 4.0) for i in range(22)]
    events = [(1, 1, 5.0, 10, 1)]
    e = spark.createDataFrame(events, EV)
    recent = online.recent_ratings(spark.createDataFrame(queue, Q), e).collect()
    assert len(recent) == 21 and sorted(r.pos for r in recent) == list(range(1, 22))
    assert {r.productId for r in recent} == {1} | {100 + i for i in range(20)}


def test_last_event_of_user_wins(spark):
    sims = [(1, 2, 0.9), (2, 1, 0.9), (5, 6, 0.8), (6, 5, 0.8)]
    events = [(1, 1, 5.0, 10, 1), (1, 5, 4.0, 20, 2)]
    got = run(spark, events, [], [], sims)
    # last event rates 5 -> candidate 6; 2 was candidate of the earlier event only
    assert [p for p, _ in got[1]] == [6]


def test_push_recent_caps_queue(spark):
    q = spark.createDataFrame([(1, i + 1, i, 1.0) for i in range(40)], Q)
    e = spark.createDataFrame([(1, 900, 5.0, 0, 1), (1, 901, 5.0, 0, 2)], EV)
    out = sorted((r.pos, r.productId) for r in maintenance.push_recent(q, e).collect())
    assert len(out) == 40 and out[0] == (1, 901) and out[1] == (2, 900) and out[-1] == (40, 37)


def test_candidates_deep_in_a_partner_list(spark):
    # product 1 has 100 partners with falling similarity; the user rated the best 50
    sims = spark.createDataFrame([(1, 100 + i, 0.99 - i * 0.005) for i in range(100)], SIM)
    last = spark.createDataFrame([(1, 1)], "userId int, productId int")
    rated = spark.createDataFrame([(1, 100 + i) for i in range(50)], RT)
    got = [r.candidate for r in online.candidates(last, sims, rated).orderBy("rank").collect()]
    assert got == [150 + i for i in range(20)]
    ranked = online.rank_partners(sims)
    assert [r.candidate for r in online.candidates(last, ranked, rated).orderBy("rank").collect()] == got


def test_a_batch_reads_the_ratings_of_its_users_only(spark):
    ratings = spark.createDataFrame([(u, p, 3.0, 10 + p) for u in (1, 2, None) for p in (1, 2, 2)],
                                    "userId int, productId int, score double, timestamp bigint")
    events = spark.createDataFrame([(1, 9, 5.0, 99, 1), (1, 8, 5.0, 99, 2), (None, 8, 5.0, 99, 3)], EV)
    mine = online.batch_ratings(ratings, events)
    assert sorted(r.productId for r in mine.collect()) == [1, 2, 2] and {r.userId for r in mine.collect()} == {1}
    queue = maintenance.recent_from_ratings
    assert (sorted(map(str, online.recent_ratings(queue(mine), events).collect()))
            == sorted(map(str, online.recent_ratings(queue(ratings), events).collect())))


def test_renumbered_keeps_users_without_a_product(spark):
    flat = spark.createDataFrame([(1, 1, 5, 0.9), (1, 2, 4, 0.1), (1, 3, 3, 0.9), (2, None, None, None), (None, None, None, None)],
                                 "userId int, rank int, productId int, old double")
    got = online.renumbered(flat, F.col("old"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 1, 3, 0.9), (1, 2, 5, 0.9), (1, 3, 4, 0.1), (2, None, None, None), (None, None, None, None)], key=str)
    scans = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in scans


def test_tables_small_on_disk_alone_are_not_broadcast(spark):
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
        apply_sql_conf(spark)
        big = materialise(spark.range(0, 1_000_000, 1, 4).select(F.floor(F.col("id") / 1000).alias("u"), F.lit(1).alias("c")), "big")
        few = materialise(spark.range(0, 100, 1, 1).select(F.col("id").alias("u")), "few")

        def plan():
            return big.join(few, "u").join(big.select("u", F.col("c").alias("d")), "u")._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan()
        sized_by_rows(spark)
        assert plan().count("SortMergeJoin") == 1 and plan().count("BroadcastHashJoin") == 1  # few rows still are
        apply_sql_conf(spark)
        assert "SortMergeJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        apply_sql_conf(spark)
