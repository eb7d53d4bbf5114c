import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from shoprank.sources import files
from shoprank.streaming import logfilter


def write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_read_products(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "p.txt"), [
        "3982^ Mouse X \t^1,2^B00^http://img^Peripherals|Mouse^Fuller|Mouse|",
        "6797^Shaver^2^B01^http://img2^Home||Care^Philips||Shavers",
    ])
    got = {r.productId: r for r in files.read_products(spark, p).collect()}
    assert got[3982].name == "Mouse X" and got[3982].tags == "Fuller|Mouse|"
    assert got[6797].categories == "Home||Care" and got[3982].imageUrl == "http://img"


def test_product_bad_id_strict_and_permissive(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "bad.txt"), ["x12^n^c^v^i^c^t", "5^n^c^v^i^c^t"])
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_products(spark, p).collect()
    assert [r.productId for r in files.read_products(spark, p, mode="permissive").collect()] == [5]
    assert files.rejected_products(spark, p).count() == 1


def test_read_ratings(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "r.txt"), ["4867,457976,5,1395676800", "1,2,3.5,1395676800000", "7,8"])
    got = sorted(map(tuple, files.read_ratings(spark, p, mode="permissive").collect()))
    assert got == [(1, 2, 3.5, 1395676800), (4867, 457976, 5.0, 1395676800)]
    assert [r.value for r in files.rejected_ratings(spark, p).collect()] == ["7,8"]


@pytest.mark.parametrize("read, line", [(files.read_ratings, "7,8"), (files.read_products, "5^n^c^v")])
def test_short_lines_fail_in_strict_mode(spark, tmp_dir, read, line):
    p = write(os.path.join(tmp_dir, "short.txt"), [line])
    with pytest.raises((PySparkException, Py4JJavaError)):
        read(spark, p).collect()


def test_tables_roundtrip(spark, tmp_dir):
    from shoprank import schemas as S
    df = spark.createDataFrame([(1, 2, 3.0, 4), (1, 3, 1.0, 5)], S.RATING_SCHEMA)
    prods = spark.createDataFrame([(2, "n", "", "", "t")], S.PRODUCT_SCHEMA)
    files.load_tables(prods, df, tmp_dir)
    back = files.read_table(spark, tmp_dir, S.RATING)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in S.RATING_SCHEMA]
    assert back.count() == 2


def test_log_lines(spark):
    lines = spark.createDataFrame([("a PRODUCT_RATING_PREFIX:1|2|4.0|9",), ("plain",),
                                   ("PRODUCT_RATING_PREFIX:",), ("PRODUCT_RATING_PREFIX:x|2|4.0|9",)], "value string")
    recs = logfilter.filter_rating_log(lines)
    assert [tuple(r) for r in recs.collect()] == [("logProcessor", "1|2|4.0|9"), ("logProcessor", "x|2|4.0|9")]
    ok = logfilter.parse_rating_events(recs, mode="permissive").collect()
    assert [tuple(r) for r in ok] == [(1, 2, 4.0, 9)]
    assert logfilter.rejected_events(recs).count() == 1
    assert logfilter.rejected_log_lines(lines).count() == 1


def test_short_events_fail_in_strict_mode(spark):
    recs = spark.createDataFrame([("1|2|4.0",)], "value string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        logfilter.parse_rating_events(recs).collect()
