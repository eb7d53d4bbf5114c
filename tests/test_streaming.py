import json
import os

import pytest

from shoprank import schemas as S
from shoprank.operators import online
from shoprank.operators.maintenance import push_recent, recent_from_ratings
from shoprank.streaming import online as stream
from shoprank.streaming.logfilter import filter_rating_log, parse_rating_events
from shoprank.streaming.state import recent_queue_stream
from shoprank.streaming.tables import StateTable, epoch_of

EV = "userId int, productId int, score double, timestamp bigint, seq bigint"
Q = "userId int, pos int, productId int, score double"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_log_filter_stream_equals_static(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs")
    lines = ["INFO PRODUCT_RATING_PREFIX:1|2|4.0|10", "INFO click", "x PRODUCT_RATING_PREFIX:3|4|1.0|11",
             "PRODUCT_RATING_PREFIX:"]
    write_lines(src, "a.txt", lines[:2])
    write_lines(src, "b.txt", lines[2:])
    out = os.path.join(tmp_dir, "out")
    q = stream.start_log_filter(stream.read_text_stream(spark, src), out,
                                checkpoint=os.path.join(tmp_dir, "ck"), trigger="availableNow")
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    static = filter_rating_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert got == sorted(tuple(r) for r in static.collect()) == [("logProcessor", "1|2|4.0|10"),
                                                                  ("logProcessor", "3|4|1.0|11")]
    bad = os.path.join(tmp_dir, "bad")
    stream.start_log_rejects(stream.read_text_stream(spark, src), bad, checkpoint=os.path.join(tmp_dir, "ck-bad"),
                             trigger="availableNow").awaitTermination()
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["PRODUCT_RATING_PREFIX:"]


def _setup(spark, tmp_dir):
    ratings = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 2.0, 2), (2, 1, 4.0, 3)],
                                    "userId int, productId int, score double, timestamp bigint")
    rp = os.path.join(tmp_dir, "ratings")
    ratings.write.parquet(rp)
    sims = spark.createDataFrame(
        [(a, b, s) for a, b, s in [(1, 3, 0.9), (3, 1, 0.9), (3, 4, 0.8), (4, 3, 0.8), (1, 4, 0.5), (4, 1, 0.5),
                                   (2, 5, 0.7), (5, 2, 0.7), (5, 6, 0.6), (6, 5, 0.6), (1, 6, 0.45), (6, 1, 0.45)]],
        "productId int, recProductId int, score double")
    sp = os.path.join(tmp_dir, "sims")
    sims.write.parquet(sp)
    return ratings, rp, sims, sp


def _as_dict(df):
    return {r.userId: [(x.productId, round(x.score, 9)) for x in r.recs] for r in df.collect()}


def _run(spark, base, rp, sp, src, ck, fmt="text", **more):
    q = stream.start_recommender(stream.read_text_stream(spark, src, fmt), base, rp, sp, checkpoint=ck,
                                 trigger="availableNow", **more)
    q.awaitTermination()


def test_recommender_stream_two_batches(spark, tmp_dir):
    ratings, rp, sims, sp = _setup(spark, tmp_dir)
    src, base, ck = (os.path.join(tmp_dir, x) for x in ("in", "state", "ck"))
    write_lines(src, "1.txt", ["1|3|5.0|100", "2|5|4.0|101"])
    _run(spark, base, rp, sp, src, ck)
    first = _as_dict(stream.current_stream_recs(spark, base))
    ev1 = spark.createDataFrame([(1, 3, 5.0, 100, 0), (2, 5, 4.0, 101, 1)], EV)
    static1 = _as_dict(online.recommend_batch(ev1, recent_from_ratings(ratings), ratings, sims))
    assert first == static1 and first[1] != []

    # second batch: user 1 rates product 4; product 3 (rated in batch 1) must not come back
    write_lines(src, "2.txt", ["1|4|3.0|200", "garbage", "1|4", "1|4|NaN|5"])
    _run(spark, base, rp, sp, src, ck)
    assert sorted(r.value for r in stream.rejected_records(spark, base).collect()) == ["1|4", "1|4|NaN|5", "garbage"]
    second = _as_dict(stream.current_stream_recs(spark, base))
    assert second[2] == first[2]  # untouched user keeps the batch-1 row
    assert all(p not in (1, 2, 3, 4) for p, _ in second[1])
    assert [r.productId for r in stream.current_queue(spark, base).where("userId = 1").orderBy("pos").collect()] == [4, 3, 2, 1]
    one = spark.createDataFrame([(2,)], "userId int")
    assert _as_dict(stream.current_stream_recs(spark, base, one)) == {2: second[2]}


def test_a_new_checkpoint_goes_on_from_the_tables(spark, tmp_dir):
    """Batch numbers start again at 0: its rows replace those of the old checkpoint's batch 1,
    the queue goes on and products rated under the old checkpoint stay out."""
    ratings, rp, sims, sp = _setup(spark, tmp_dir)
    src, base = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")
    write_lines(src, "1.txt", ["1|3|5.0|100"])
    _run(spark, base, rp, sp, src, os.path.join(tmp_dir, "ck1"))
    write_lines(src, "2.txt", ["1|5|4.0|101", "2|2|1.0|1"])
    _run(spark, base, rp, sp, src, os.path.join(tmp_dir, "ck1"))
    other = os.path.join(tmp_dir, "in2")
    write_lines(other, "1.txt", ["1|4|3.0|50"])
    _run(spark, base, rp, sp, other, os.path.join(tmp_dir, "ck2"))
    assert {(r.userId, r.pos, r.productId) for r in stream.current_queue(spark, base).collect()} == {
        (1, 1, 4), (1, 2, 5), (1, 3, 3), (1, 4, 2), (1, 5, 1), (2, 1, 2), (2, 2, 1)}
    queue = spark.createDataFrame([(1, 1, 5, 4.0), (1, 2, 3, 5.0), (1, 3, 2, 2.0), (1, 4, 1, 5.0)], Q)
    rated = spark.createDataFrame([(1, p) for p in (1, 2, 3, 5)], "userId int, productId int")
    event = spark.createDataFrame([(1, 4, 3.0, 50, 0)], EV)
    assert _as_dict(stream.current_stream_recs(spark, base))[1] == _as_dict(online.recommend_batch(event, queue, rated, sims))[1]
    assert {(r.query_id, r.epoch) for r in spark.read.parquet(os.path.join(base, "Epochs")).collect()} == {
        (json.load(open(os.path.join(tmp_dir, ck, "metadata")))["id"], n) for ck, n in (("ck1", 1), ("ck2", 2))}
    # a restart of the first checkpoint finds its own epoch again
    assert epoch_of(spark, base, json.load(open(os.path.join(tmp_dir, "ck1", "metadata")))["id"]) == 1
    assert epoch_of(spark, base, "new") == 3


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    ratings, rp, sims, sp = _setup(spark, tmp_dir)
    base = os.path.join(tmp_dir, "state")
    batches = [spark.createDataFrame(rows, "value string") for rows in (
        [("1|3|5.0|100",), ("1|4|2.0|101",)], [("1|6|5.0|100",), ("2|5|2.0|101",), ("x",)])]

    def state():
        return [sorted(map(str, rows.collect())) for rows in (
            stream.current_stream_recs(spark, base), stream.current_queue(spark, base), stream.rejected_records(spark, base),
            stream.rated_table(base).rows(spark), spark.read.parquet(os.path.join(base, "RatingEvents")))]

    for number, batch in enumerate(batches):
        stream.process_batch(batch, number, base, ratings, sp)
        once = state()
        stream.process_batch(batch.repartition(3), number, base, ratings, sp)
        assert state() == once
        stream.fold_tables(spark, base, (0, number))
        assert state() == once


def test_rows_read_do_not_grow_with_batches(spark, tmp_dir):
    base = os.path.join(tmp_dir, "state")
    plain, folded = StateTable(base, "Plain", "userId int, v int"), StateTable(base, "Folded", "userId int, v int", buckets=4)
    pairs = StateTable(base, "Pairs", "userId int, productId int", replace=False, buckets=4)
    read = []
    for k in range(9):
        at = (1 + k // 5, k % 5)  # a new epoch after five batches
        rows = spark.createDataFrame([(u, 100 * k + u) for u in range(6) if (u + k) % 3], "userId int, v int")
        plain.append(rows, at)
        folded.append(rows, at)
        pairs.append(rows.selectExpr("userId", "v % 2 as productId"), at)
        if k % 2:
            folded.fold(spark, at)
            pairs.fold(spark, at)
        read.append(sum(folded._read(spark, part).count() for part in ("log", "live")))
        assert sorted(folded.rows(spark).collect()) == sorted(plain.rows(spark).collect())
        assert sorted(folded.rows(spark, at).collect()) == sorted(plain.rows(spark, at).collect())
    assert max(read) <= 6 + 3 * 4 and read[-1] <= read[3] + 4
    assert sorted(map(tuple, pairs.rows(spark).collect())) == [(u, v) for u in range(6) for v in (0, 1) if v == u % 2]
    some = spark.createDataFrame([(1,), (5,), (5,)], "userId int")
    assert sorted(folded.rows(spark, users=some).collect()) == [r for r in sorted(plain.rows(spark).collect()) if r.userId in (1, 5)]


def test_a_fold_that_died_is_applied_again(spark, tmp_dir):
    table = StateTable(os.path.join(tmp_dir, "state"), "T", "userId int, v int", buckets=2)
    table.append(spark.createDataFrame([(u, u) for u in range(8)], "userId int, v int"), (1, 0))
    table.fold(spark, (1, 1))
    table.append(spark.createDataFrame([(3, 30)], "userId int, v int"), (1, 1))
    expected = sorted(table.rows(spark).collect())
    touched = table._read(spark, "live").where("userId = 3").first().bucket
    merged = table._merged(table._read(spark, "live").where(f"bucket = {touched}").unionByName(table._read(spark, "log")))
    merged.write.mode("overwrite").partitionBy("bucket").parquet(table.path("live.pending"))
    os.rename(table.path(f"live/bucket={touched}"), os.path.join(tmp_dir, "lost"))  # dies between delete and move
    assert sorted(table.rows(spark).collect()) != expected
    table.recover(spark)
    assert sorted(table.rows(spark).collect()) == expected
    untouched = sorted(os.listdir(table.path(f"live/bucket={1 - touched}")))
    table.fold(spark, (2, 0))
    assert sorted(table.rows(spark).collect()) == expected
    assert sorted(os.listdir(table.path(f"live/bucket={1 - touched}"))) == untouched  # only touched buckets are written
    assert not [x for x in os.listdir(table.path("log/epoch=1")) if x.startswith("batch_id")]


def test_recent_queue_state_equals_recent_ratings(spark, tmp_dir):
    """Late events, equal timestamps and more events than the queue holds, over three batches."""
    src, out = os.path.join(tmp_dir, "q"), os.path.join(tmp_dir, "qout")
    history = spark.createDataFrame([(1, 900, 1.0, 5), (1, 901, 2.0, 6), (3, 902, 3.0, 7)],
                                    "userId int, productId int, score double, timestamp bigint")
    batches = [[f"1|{p}|4.0|{p % 4}" for p in range(30)] + ["2|7|1.0|5"],
               [f"1|{p}|5.0|{300 - p}" for p in range(100, 115)] + ["3|1|2.0|1", "3|2|2.0|1"],
               [f"2|{p}|{p % 5}.0|9" for p in range(200, 260)] + ["1|1|1.0|0"]]
    os.makedirs(src)
    events = parse_rating_events(stream.read_text_stream(spark, src, "parquet"), keep=["seq"])
    before = queue = recent_from_ratings(history)
    for number, lines in enumerate(batches):
        (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").parquet(src))
        q = (recent_queue_stream(events, initial=recent_from_ratings(history)).writeStream.outputMode("update")
             .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{out}/b={bid}"))
             .option("checkpointLocation", os.path.join(tmp_dir, "qck")).trigger(availableNow=True).start())
        q.awaitTermination()
        got = spark.read.parquet(out).where(f"b = {number}")
        pushed = spark.createDataFrame([(*map(int, x.split("|")[:2]), float(x.split("|")[2]), int(x.split("|")[3]), k)
                                        for k, x in enumerate(lines)], EV)
        assert got.where("kind = 'event'").count() == len(lines)
        entries = got.where("kind = 'queue'").select("userId", "pos", "productId", "score")
        touched = pushed.select("userId").distinct()
        queue = push_recent(queue, pushed)
        assert sorted(entries.collect()) == sorted(queue.join(touched, "userId", "left_semi").collect())
        assert sorted(entries.where(f"pos <= {S.RECENT_RATINGS_USED}").collect()) == sorted(online.recent_ratings(before, pushed).collect())
        before = queue = spark.createDataFrame(queue.collect(), Q)


def test_the_last_event_does_not_depend_on_partitions(spark):
    rows = [(f"{u}|{p}|{p % 5}.0|{t}".encode(), part, off) for u, p, t, part, off in [
        (1, 10, 5, 0, 9), (1, 11, 5, 0, 10), (1, 12, 4, 0, 100), (2, 13, 7, 1, 2), (2, 14, 7, 0, 3), (3, 15, 1, 2, 0)]]
    kafka = spark.createDataFrame(rows, "value binary, partition int, offset long")
    found = set()
    for given in (kafka, kafka.repartition(5), kafka.repartition(2, "offset"), kafka.orderBy("value")):
        events = stream._decoded(stream.ordered_records(given, "kafka"))
        last = online.last_event_per_user(events)
        queue = push_recent(spark.createDataFrame([], Q), events)
        found.add((tuple(sorted((r.userId, r.productId) for r in last.collect())),
                   tuple(r.productId for r in queue.where("userId = 1").orderBy("pos").collect())))
    assert found == {(((1, 11), (2, 13), (3, 15)), (12, 11, 10))}  # the queue goes by offsets, not by times


def test_processing_time_trigger(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "out")
    write_lines(src, "a.txt", ["PRODUCT_RATING_PREFIX:1|2|4.0|10"])
    q = stream.start_log_filter(stream.read_text_stream(spark, src), out, checkpoint=os.path.join(tmp_dir, "ck"), trigger="1 second")
    try:
        q.processAllAvailable()
        write_lines(src, "b.txt", ["PRODUCT_RATING_PREFIX:3|4|1.0|11", "click"])
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["1|2|4.0|10", "3|4|1.0|11"]
