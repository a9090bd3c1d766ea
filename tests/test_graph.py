import random

import pytest

from fieldlark.operators.graph import components, same_component


def roots(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize(("seed", "last"), [(1, 0), (2, 0), (1, 60), (2, 10**6)])
def test_against_union_find(spark, seed, last):
    """With rounds to the end, with a rest for one task, and with all links in one task."""
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(80)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(500, 500)]
    got = {r["node"]: r["component"] for r in same_component(spark.createDataFrame(edges, "a long, b long"), "a", "b", last).collect()}
    assert got == roots(edges)


def test_nulls_repeats_hot_and_empty(spark):
    links = [(i, "hub") for i in range(50)] * 2 + [(7, "x"), (90, "x"), (None, "x"), (91, None), (92, "alone")]
    df = spark.createDataFrame(links, "r long, e string")
    for last in (0, 10**6):
        got = {r["r"]: r["component"] for r in components(df, "r", "e", last=last).collect()}
        assert got == {**dict.fromkeys(range(50), 0), 90: 0, 92: 92}
    assert components(df.limit(0), "r", "e").count() == 0


def test_colliding_labels_change_nothing(spark):
    from pyspark.sql import functions as F

    from fieldlark.operators.graph import grouped_sets

    links = [(i, f"e{i // 3}") for i in range(60)] + [(i, f"f{i // 10}") for i in range(0, 60, 7)]
    df = spark.createDataFrame(links, "r long, e string")
    plain = {r["r"]: r["component"] for r in components(df, "r", "e").collect()}
    crowded = {r["r"]: r["component"] for r in components(df, "r", "e", label=lambda c: F.pmod(F.xxhash64(c), F.lit(5)), last=0).collect()}
    assert plain == crowded == {k: v for k, v in plain.items()}
    sets = spark.createDataFrame([(1, ["a", None]), (2, ["a", "b"]), (3, ["c"]), (4, []), (5, None), (None, ["a"]), (6, ["b"]), (6, ["b"])], "r long, s array<string>")
    groups = {}
    for r in grouped_sets(sets, "r", F.col("s")).collect():
        groups.setdefault((r["root"], r["round"]), []).append(r["r"])
    assert sorted(map(sorted, groups.values())) == [[1, 2, 6, 6], [3]]
