import pytest
from pyspark.sql import functions as F

from fieldlark.operators import aggregates, joins, registry, similarity
from fieldlark.sources import sinks


def test_parts_are_sealed_once_and_go_on(spark, tmp_path):
    df = spark.range(95).select(F.col("id").alias("o"), (F.col("id") * 3).alias("x"), F.lit(None).cast("string").alias("t"))
    at = str(tmp_path / "parts")
    assert sinks.seal_parts(df, at, "o", 10, only=[0, 3]).count() == 2
    with pytest.raises(ValueError, match="20 rows"):
        sinks.assemble_parts(spark, at, 95)
    # Sealed parts are not made again, even where the input would differ now.
    seals = sinks.seal_parts(df.withColumn("x", F.when(F.col("o") == 5, -1).otherwise(F.col("x"))), at, "o", 10)
    assert seals.count() == 10 and sorted(r["n_rows"] for r in seals.collect()) == [5] + [10] * 9
    assert {tuple(r) for r in sinks.assemble_parts(spark, at, 95).collect()} == {tuple(r) for r in df.collect()}
    assert sinks.seal_parts(df, at, "o", 10).count() == 10


def test_parts_that_overlap_are_refused(spark, tmp_path):
    at = str(tmp_path / "parts")
    sinks.seal_parts(spark.range(20).toDF("o"), at, "o", 10)
    spark.read.parquet(f"{at}/seals").limit(1).withColumn("part", F.lit(9).cast("bigint")).write.mode("append").parquet(f"{at}/seals")
    with pytest.raises(ValueError, match="overlapping"):
        sinks.assemble_parts(spark, at, 30)


def test_refresh_queue(spark):
    now = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-30"), (3, "c", "2024-01-30"), (4, None, "2024-01-30"), (5, "e", None)], "k int, d string, t string")
    old = spark.createDataFrame([(1, "a"), (2, "x"), (4, None), (5, "e")], "k int, d string")
    ask = lambda before: {r["k"]: (r["change_status"], r["due"]) for r in joins.refresh_queue(now, before, "k", "d", "t", "2024-01-31", {"due": 7}).collect()}
    assert ask(old) == {1: ("SAME", True), 2: ("CHANGED", False), 3: ("NEW", False), 5: ("SAME", None)}
    assert set(ask(now.select("k", "d"))) == {1, 5} and len(ask(old.limit(0))) == 5
    with pytest.raises(joins.CardinalityError):
        joins.refresh_queue(now, old.union(old), "k", "d", "t", "2024-01-31", {})


def test_schema_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    got = {r["field"]: (r["status"], r["n_rows"], r["n_missing"]) for r in aggregates.schema_audit(df, {"a": "bigint", "c": "int"}).collect()}
    assert got == {"a": ("TYPE_DIFFERS", 2, 1), "c": ("MISSING", 2, 2), "b": ("EXTRA", 2, 2)}


def test_labels_and_repairs(spark):
    df = spark.createDataFrame([("i", "x"), ("i", "x"), ("j", "x"), ("j", "y"), ("k", "z"), ("l", None), (None, "x")], "item string, label string")
    got = {r["item"]: (r["label"], r["label_status"], r["n_rows"]) for r in registry.resolved_labels(df, "item", "label").collect()}
    assert got == {"i": ("x", "REPEATED", 2), "j": (None, "CONFLICT", 2), "k": ("z", "SINGLE", 1)}
    names = spark.createDataFrame([("Aus bus L.", "1"), ("Aus sp.", "1"), ("aus bus", "1"), ("Aus", "1"), ("Élan vérus", " "), (None, "1"), ("Aus b-us", None)], "n string, k string")
    got = [tuple(r) for r in names.select(*registry.species_repair(F.col("n"), [F.col("k")])).collect()]
    assert got == [("Aus bus", "PASS"), (None, "UNKNOWN"), (None, "UNKNOWN"), (None, "UNKNOWN"), (None, "UNKNOWN"), (None, "UNKNOWN"), ("Aus b-us", "UNKNOWN")]


def test_neighbours_within_groups(spark):
    rows = [(i, [float(i % 7), 1.0], "a" if i % 3 else "b") for i in range(40)] + [(90, [1.0, 1.0], None), (91, None, "a"), (92, [1.0, 1.0], "alone")]
    df = spark.createDataFrame(rows, "id long, v array<double>, g string")
    got = similarity.nearest(df, df, "id", "v", 3, block=7, group="g").collect()
    of = {r[0]: r[2] for r in rows}
    assert {r["query_id"] for r in got} == set(range(40)) and all(of[r["query_id"]] == of[r["neighbour_id"]] for r in got)
    assert all(r["query_id"] != r["neighbour_id"] for r in got)
    vote = similarity.neighbour_vote(similarity.nearest(df, df.where("id < 5"), "id", "v", 3), df, "id", "g").collect()
    assert {r["query_id"] for r in vote} == set(range(5)) and all(0 < r["share"] <= 1 for r in vote)


def test_prototypes_count_an_observation_once(spark):
    rows = [("x", 1, [1.0, 0.0])] * 9 + [("x", 2, [0.0, 3.0]), ("x", 3, [0.0, 0.0]), ("y", None, [1.0, 1.0]), ("y", 4, None), ("z", 5, [1.0, 0.0]), ("z", 5, [-1.0, 0.0])]
    got = {r["l"]: r["mean"] for r in similarity.prototypes(spark.createDataFrame(rows, "l string, o int, v array<double>"), "l", "o", "v").collect()}
    assert set(got) == {"x"} and got["x"] == pytest.approx([0.5**0.5] * 2)


def test_leakage_groups_and_duplicate_statuses(spark):
    df = spark.createDataFrame([("1", "a", "b"), ("1", None, "b")], "k string, x string, y string")
    rows = df.select(*[c.alias(n) for n, c in aggregates.leakage_groups({"k": [F.col("k")], "xy": [F.col("x"), F.col("y")]}).items()]).collect()
    assert rows[0]["k"] == rows[1]["k"] and rows[0]["xy"] is not None and rows[1]["xy"] is None
    media = spark.createDataFrame([(1, "http://a/b", "t", "l"), (2, "http://A/b", "u", "l"), (3, None, "t", "m"), (4, "http://a/c", "t", "l")], "i int, u string, t string, l string")
    got = {r["i"]: (r["across_taxa"], r["across_licences"]) for r in aggregates.duplicate_membership(media, "i", "u", ["i"], F.col("t"), F.col("l")).collect()}
    assert got == {1: ("CONFLICT", "PASS"), 2: ("CONFLICT", "PASS"), 3: ("NOT_APPLICABLE", "NOT_APPLICABLE"), 4: ("PASS", "PASS")}


def test_an_index_finds_what_the_exact_search_finds(spark):
    """With all cells looked at nothing is missed, in one task a cell or in many; with some, most."""
    import numpy as np

    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(600, 5)))] + [(700, None), (None, [1.0] * 5), (701, [0.0] * 5)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    asked = df.where("id % 20 = 0")
    exact = similarity.nearest(df, asked, "id", "v", 4)
    for together, lot in ((100_000, 2_000), (30, 3)):
        all_ = similarity.nearest_indexed(df, asked, "id", "v", 4, cells=9, probes=9, together=together, asked_together=lot)
        assert sorted((r["query_id"], r["neighbour_id"], r["rank"]) for r in all_.collect()) == sorted((r["query_id"], r["neighbour_id"], r["rank"]) for r in exact.collect())
    some = similarity.recall(similarity.nearest_indexed(df, asked, "id", "v", 4, cells=16), exact).first()
    assert some["recall"] >= 0.9
    assert similarity.nearest_indexed(df.limit(0), asked, "id", "v", 4).count() == 0 == similarity.nearest_indexed(df, asked.limit(0), "id", "v", 4).count()


def test_lookup_table_and_page_images(spark, tmp_path):
    from fieldlark.sources import readers

    sinks.write_table(spark.range(100).withColumn("x", F.col("id") * 2), "looked_up", "id", 4)
    try:
        about = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended looked_up").collect()}
        assert about["Num Buckets"] == "4" and spark.table("looked_up").where("id = 7").first()["x"] == 14
    finally:
        spark.sql("drop table looked_up")
    pages = spark.createDataFrame([('<img src="a.png">', "http://h/p/"), (None, "http://h/")], "html string, base string")
    assert [r[0] for r in pages.select(readers.page_images("html", "base")).collect()] == [["http://h/p/a.png"], []]
