import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldlark.operators.hot_keys import carried, combined, find_hot, key_totals, value_changes

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, k string, at timestamp, v long, previous string"


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}"
        out.append((i, k, T0 + dt.timedelta(seconds=rng.randrange(n // 2)), rng.randrange(3), "clash"))
    return out + [(n, None, T0, 1, ""), (n + 1, "hot", None, 1, ""), (n + 2, "hot", T0, None, "")]


def expected(data):
    groups = {}
    for i, k, at, v, _ in data:
        if k is not None and at is not None and v is not None:
            groups.setdefault(k, {}).setdefault(at, []).append((i, v))
    out = set()
    for per in groups.values():
        last = None
        for at in sorted(per):
            ident, v = min(per[at])
            if last is not None and v != last:
                out.add(ident)
            last = v
    return out


@pytest.mark.parametrize("per_chunk", [30, 10**6])
def test_changes(spark, per_chunk):
    data = rows(3000)
    df = spark.createDataFrame(data, SCHEMA)
    out = value_changes(df, F.col("k"), "at", "id", "v", rows_per_chunk=per_chunk)
    assert sorted(r["ident"] for r in out.collect()) == sorted(expected(data))


def lasts(df, **kw):
    at = F.unix_micros("at")
    hot = find_hot(df, "k", at, **kw)
    rows = combined(df, "k", "at", at, [F.max("v").alias("v")], hot)
    return hot, sorted(map(str, carried(rows, "k", "at", "v", "last", hot, include_current=True).collect()))


def test_hot_key_is_cut(spark):
    df = spark.createDataFrame(rows(3000), SCHEMA)
    hot, cut = lasts(df, rows_per_chunk=200)
    (key, edges), *others = hot.edges
    assert (key, others) == ("hot", []) and len(edges) >= 8 and edges == sorted(edges)
    whole, uncut = lasts(df, rows_per_chunk=10**6)
    assert not whole.edges and cut == uncut


def test_more_hot_keys_than_any_cap(spark):
    """700 keys of two chunks each and one key with half of all rows: every one is cut."""
    data = [(i, f"k{i % 1400}" if i % 2 else "half", T0 + dt.timedelta(seconds=i), i % 3, "") for i in range(42_000)]
    df = spark.createDataFrame(data, SCHEMA).cache()
    hot, cut = lasts(df, rows_per_chunk=15)
    per = dict(hot.edges)
    assert len(per) == 701 and len(per["half"]) > 1000 and all(per.values())
    assert cut == lasts(df, rows_per_chunk=10**6)[1]
    out = value_changes(df, F.col("k"), "at", "id", "v", rows_per_chunk=15)
    assert sorted(r["ident"] for r in out.collect()) == sorted(expected(data))


def test_defaults_cut_by_the_number_of_partitions(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    hot = find_hot(df, "k", F.col("id"))
    assert [(k, len(e)) for k, e in hot.edges] == [("hot", 5)] and not hot.burst


def test_burst_is_combined_before_the_shuffle(spark):
    """One moment of one key with half of all rows is one event."""
    df = spark.range(20_000).select(F.col("id"), F.lit("hot").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(T0)).otherwise(F.lit(T0) + F.make_dt_interval(secs=F.col("id").cast("double"))).alias("at"), (F.col("id") % 3).alias("v"))
    assert find_hot(df, "k", F.unix_micros("at"), 500).burst
    data = [(r["id"], r["k"], r["at"], r["v"], "") for r in df.collect()]
    out = value_changes(df, F.col("k"), "at", "id", "v", rows_per_chunk=500)
    assert sorted(r["ident"] for r in out.collect()) == sorted(expected(data))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" not in plan


def test_empty_ties_and_totals(spark):
    df = spark.createDataFrame(rows(10), SCHEMA)
    assert value_changes(df.limit(0), F.col("k"), "at", "id", "v").count() == 0
    same = spark.createDataFrame([(2, "a", T0, 5, ""), (1, "a", T0, 7, ""), (3, "a", T0 + dt.timedelta(1), 7, ""), (3, "a", T0 + dt.timedelta(1), 7, "")], SCHEMA)
    assert value_changes(same, F.col("k"), "at", "id", "v").count() == 0
    totals = {r["key"]: (r["n_rows"], r["n_values"]) for r in key_totals(df, F.col("k"), "v").collect()}
    assert totals[None] == (1, 1)
