import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldlark.operators.references import orphan_references, url_key, whole_number


def day(n):
    return dt.datetime(2024, 1, n)


TARGETS = [("1", day(1), False, 1), ("1", day(5), True, 2), ("1", day(9), False, 3), ("2", day(4), None, 4), ("3", None, False, 5), (None, day(1), False, 6), ("4", day(2), False, 7), ("4", day(2), True, 8)]
REFS = [(1, "1", day(1)), (2, "1", day(6)), (3, "1", day(9)), (4, "2", day(3)), (5, "2", day(4)), (6, "9", day(9)), (7, None, day(9)), (8, "3", day(1)), (9, "1", None), (10, "4", day(2)), (6, "9", day(9))]


def frames(spark):
    t = spark.createDataFrame(TARGETS, "k string, t timestamp, gone boolean, n long").withColumn("orphan_reason", F.lit("clash"))
    return spark.createDataFrame(REFS, "id long, k string, t timestamp").withColumn("gone", F.lit("clash")), t


def test_newest_version_decides(spark):
    r, t = frames(spark)
    out = orphan_references(r, [F.col("k")], t, [F.col("k")], ref_time=F.col("t"), target_time=F.col("t"), target_deleted=F.col("gone"), target_tie=F.col("n"))
    assert sorted((x["id"], x["orphan_reason"]) for x in out.collect()) == [(2, "deleted"), (4, "absent"), (6, "absent"), (6, "absent"), (10, "deleted")]
    assert out.columns == ["id", "k", "t", "gone", "orphan_reason"]


def test_first_arrival_decides(spark):
    r, t = frames(spark)
    out = orphan_references(r, [F.col("k")], t, [F.col("k")], ref_time=F.col("t"), target_time=F.col("t"))
    assert sorted((x["id"], x["orphan_reason"]) for x in out.collect()) == [(4, "late"), (6, "absent"), (6, "absent")]


@pytest.mark.parametrize(
    ("semantics", "want"),
    [
        ("simple", [(3, "absent")]),
        ("full", [(2, "partial_key"), (3, "absent"), (4, "partial_key"), (5, "partial_key")]),
        ("partial", [(3, "absent"), (5, "absent")]),
    ],
)
def test_null_masks(spark, semantics, want):
    t = spark.createDataFrame([("a", "b"), ("c", None)], "x string, y string")
    r = spark.createDataFrame([(1, "a", "b"), (2, "a", None), (3, "a", "z"), (4, None, "b"), (5, None, "q"), (6, None, None)], "id long, x string, y string")
    out = orphan_references(r, [F.col("x"), F.col("y")], t, [F.col("x"), F.col("y")], semantics=semantics)
    assert sorted((x["id"], x["orphan_reason"]) for x in out.collect()) == want


def test_empty_sides(spark):
    r, t = frames(spark)
    assert orphan_references(r.limit(0), [F.col("k")], t, [F.col("k")]).count() == 0
    assert orphan_references(r, [F.col("k")], t.limit(0), [F.col("k")]).count() == 10


def test_keys(spark):
    df = spark.createDataFrame([(" 007 ", "HTTPS://Ex.Org/A?b#c"), ("+5", "x#y"), ("abc", "http://H"), ("000", None)], "a string, u string")
    got = df.select(whole_number(F.col("a")).alias("a"), url_key(F.col("u")).alias("u")).collect()
    assert [r["a"] for r in got] == ["7", "5", "abc", "0"]
    assert [r["u"] for r in got] == ["https://ex.org/A?b", "x", "http://h", None]


def test_many_references_of_one_moment(spark):
    r = spark.range(5000).select("id", F.lit("1").alias("k"), F.lit(day(6)).cast("timestamp").alias("t"))
    _, t = frames(spark)
    out = orphan_references(r, [F.col("k")], t, [F.col("k")], ref_time=F.col("t"), target_time=F.col("t"), target_deleted=F.col("gone"), target_tie=F.col("n"))
    assert out.count() == 5000
