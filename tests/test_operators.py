import pytest
from pyspark.sql import functions as F

from fieldlark.functions import geo, names, scalars, vectors
from fieldlark.operators import aggregates, evaluation, joins, registry, sampling, similarity


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


# ---------------------------------------------------------------- functions


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (" HTTPS://Pix.Test/A/b?C=d#e#f ", "https://pix.test/A/b?C=d"),
        ("http://pix.test:80", "http://pix.test/"),
        ("http://pix.test:443?q", "http://pix.test:443?q"),
        ("https://pix.test:443/?q=http://x/y", "https://pix.test/?q=http://x/y"),
        ("https://pix.test:80/", "https://pix.test:80/"),
        ("mailto:a@pix.test", None),
        ("gopher://pix.test/1", None),
        ("http:///path", None),
        ("", None),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, scalars.canonical_url(F.lit(url).cast("string")).alias("v"))["v"] == want


@pytest.mark.parametrize(("url", "want"), [("https://a.b/c", "PASS"), ("https://u@a.b", "FAIL"), ("https://a.b:99999/", "FAIL"), ("https:///x", "FAIL"), (" ", "UNKNOWN"), (None, "UNKNOWN")])
def test_url_status(spark, url, want):
    assert one(spark, scalars.url_status(F.lit(url).cast("string")).alias("v"))["v"] == want


@pytest.mark.parametrize(
    ("event", "ymd", "status", "found"),
    [
        ("1999-12-31", (None, "12", None), "derived", (1999, None, 31)),
        (" 2001-02-03 / 2001-02-05 ", (None, None, None), "derived", (2001, 2, 3)),
        ("2001-02-03T04:05:06.789+01:00/2001-02-03T03:30Z", (None, None, None), "derived", (2001, 2, 3)),
        ("2001-02-03T04:05+01:00/2001-02-03T02:30Z", (None, None, None), "reversed_interval", (None, None, None)),
        ("2001-02-03T04:05/2001-02-03T06:30Z", (None, None, None), "unsupported_format", (None, None, None)),
        ("2001-02-03T24:05", (None, None, None), "invalid_calendar_date", (None, None, None)),
        ("2001-02-03T04:05:06.1234567", (None, None, None), "unsupported_format", (None, None, None)),
        ("2001-02-30", (None, None, None), "invalid_calendar_date", (None, None, None)),
        ("2001-02-03/2001-02-30", (None, None, None), "invalid_calendar_date", (None, None, None)),
        ("2001-02-04/2001-02-03", (None, None, None), "reversed_interval", (None, None, None)),
        ("2001-00", (None, None, None), "invalid_calendar_date", (None, None, None)),
        ("2001", (None, None, None), "insufficient_precision", (None, None, None)),
        ("2001-02-03", (None, "3", None), "existing_component_conflict", (None, None, None)),
        ("2001-02-03", (None, None, "third"), "existing_component_conflict", (None, None, None)),
        ("1900-06-07", (None, None, None), "excluded_pre_1960", (1900, 6, 7)),
        ("1900-06-07", ("1900", None, None), "derived", (None, 6, 7)),
        ("spring", (None, None, None), "unsupported_format", (None, None, None)),
        ("2001-02-03/2001-02-04/2001-02-05", (None, None, None), "unsupported_format", (None, None, None)),
        (" ", (None, None, None), "missing_event_date", (None, None, None)),
        ("2001-02-03", ("1", "2", "3"), "not_needed", (None, None, None)),
    ],
)
def test_temporal_components(spark, event, ymd, status, found):
    lits = [F.lit(x).cast("string") for x in (event, *ymd)]
    r = one(spark, scalars.derived_components(*lits).alias("t"))["t"]
    assert (r["status"], (r["derived_year"], r["derived_month"], r["derived_day"])) == (status, found)


@pytest.mark.parametrize(
    ("text", "family", "policy"),
    [
        ("Attribution CC BY-SA 2.5", "cc-by-sa", "ALLOWED"), ("cc-by-nc-nd", "cc-by-nc-nd", "DENIED"), ("https://creativecommons.org/licenses/by-nc-sa/3.0/legalcode", "cc-by-nc-sa", "RESEARCH_ONLY"), ("by 4.0", "cc-by", "ALLOWED"),
        ("CC-Zero 1.0", "cc0", "ALLOWED"), ("http://www.creativecommons.org/publicdomain/mark/1.0/", "pdm", "ALLOWED"), ("in the public domain", "pdm", "ALLOWED"), ("Copyright", "copyright", "DENIED"), ("(c) A. All rights reserved", "copyright", "DENIED"),
        ("CC BY-ND-SA", None, "QUARANTINED"), ("cc by, but ask first", None, "QUARANTINED"), ("stand by", None, "QUARANTINED"), ("", None, "QUARANTINED"), (None, None, "QUARANTINED"),
    ],
)
def test_licences(spark, text, family, policy):
    r = one(spark, names.licence(F.lit(text).cast("string")).alias("l"))["l"]
    assert (r["family"], r["policy"]) == (family, policy)


def test_names_and_fingerprints(spark):
    df = spark.createDataFrame([("  Ｐapilio   “Élan” ",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(names.name_key("t")).collect()] == ['papilio "élan"', None, None]
    tag = lambda t: tuple(one(spark, names.language_tag(F.lit(t).cast("string")).alias("v"))["v"])
    assert tag("DEU_AT-latn") == ("de", "Latn", "AT", "de-Latn-AT") and tag("es-419") == ("es", None, "419", "es-419")
    assert tag("x") == tag("") == tag(None) == tag("12") == (None,) * 4
    assert names.fold_name("Long ‑ tailed ( Blue )") == names.fold_name("long-tailed(blue)") == "long-tailed(blue)"
    assert names.fingerprint({"a": 1, "b": [1, 2]}) == names.fingerprint({"b": [1, 2], "a": 1}) != names.fingerprint({"a": 1, "b": [2, 1]})
    with pytest.raises(TypeError):
        names.fingerprint({"x": [{1: 2}]})
    assert names.fingerprint(1) != names.fingerprint("1") != names.fingerprint(1.0) and names.fingerprint(0.0) != names.fingerprint(-0.0)
    with pytest.raises(ValueError):
        names.fingerprint(float("nan"))
    ex = names.term_extractor({"larva": r"\blarvae?\b"})
    rows = spark.createDataFrame([("We saw no larva.",), ("Larvae here, no larva there",), (None,)], "t string").select(ex("t").alias("x")).select("x.*").collect()
    assert [(r["stated"], r["denied"]) for r in rows] == [([], ["larva"]), (["larva"], []), ([], [])]


def test_statuses_and_arrays(spark):
    w = lambda *s: one(spark, scalars.worst_status([F.lit(x) for x in s]).alias("v"))["v"]
    assert [w("PASS", "FAIL", "CONFLICT"), w("PASS", "FAIL", "UNKNOWN"), w("PASS", "NOT_TESTED"), w("PASS")] == ["CONFLICT", "FAIL", "UNKNOWN", "PASS"]
    assert one(spark, scalars.split_flags(F.lit(" b;a;;b ")).alias("v"))["v"] == ["a", "b"]
    assert one(spark, scalars.csv_safe(F.lit("=1+1")).alias("v"))["v"] == "'=1+1"
    assert one(spark, scalars.format_status(F.lit("Sound"), F.lit("image/png")).alias("v"))["v"] == "CONFLICT"


def test_vectors_and_geo(spark):
    a = F.array(*map(F.lit, (3.0, 4.0)))
    r = one(spark, vectors.norm(a).alias("n"), vectors.cosine(a, a).alias("c"), vectors.cosine(a, F.array(F.lit(0.0), F.lit(0.0))).alias("z"), vectors.top_k_mean(a, 3).alias("t"), vectors.argmax(a).alias("m"), vectors.margin(a).alias("g"))
    assert (r["n"], r["c"], r["z"], r["t"], r["m"], r["g"]) == (5.0, 1.0, None, None, 1, 1.0)
    box = [F.lit(x) for x in (0.0, 0.0, 2.0, 2.0)], [F.lit(x) for x in (1.0, 1.0, 3.0, 3.0)]
    assert one(spark, vectors.iou(*box).alias("v"))["v"] == pytest.approx(1 / 7)
    g = one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("d"), geo.wrapped_longitude(F.lit(190.0)).alias("w"), geo.cell(F.lit(90.0), F.lit(180.0), 3).alias("c"), geo.neighbours(geo.cell(F.lit(-90.0), F.lit(-180.0), 2)).alias("n"))
    assert g["d"] == pytest.approx(3.141592653589793 * geo.RADIUS_KM) and g["w"] == -170.0 and g["c"] == "3/15/0" and len(g["n"]) == 6


# ---------------------------------------------------------------- operators


def test_join_guards(spark):
    spine = spark.createDataFrame([(0, "a"), (1, None), (2, ""), (3, "b")], "o long, k string")
    dim = spark.createDataFrame([("a", 1), ("c", 2)], "k string, v int")
    assert [(r["o"], r["d"]["v"]) for r in joins.dimension(spine, dim, ["k"], pack="d").orderBy("o").collect()] == [(0, 1), (1, None), (2, None), (3, None)]
    with pytest.raises(joins.CardinalityError):
        joins.dimension(spine, dim.union(dim), ["k"])
    with pytest.raises(joins.CardinalityError):
        joins.dimension(spine, dim, ["k"], required=True)
    blank = spark.createDataFrame([(None, 9)], "q string, v int")
    assert [r["b"]["v"] if r["b"] else None for r in joins.blank_safe(spine, blank, [("k", "q")], "b").orderBy("o").collect()] == [None, 9, 9, None]
    with pytest.raises(joins.CardinalityError):
        joins.blank_safe(spine, blank.union(spark.createDataFrame([("", 1)], "q string, v int")), [("k", "q")], "b")


def test_ordinals(spark):
    df = spark.range(1000).withColumn("x", F.pmod(F.col("id") * 7919, F.lit(1000)))
    got = joins.with_ordinal(df, ["x"]).orderBy("x").collect()
    assert [r["ordinal"] for r in got] == list(range(1000))
    assert joins.with_ordinal(df.limit(0), ["x"]).count() == 0
    with pytest.raises(joins.CardinalityError):
        joins.ordinal_join(spark.range(3).withColumnRenamed("id", "ordinal"), spark.range(4).withColumnRenamed("id", "ordinal"))


def test_concentration(spark):
    """Seven rows of one kind from three sellers, 4 : 2 : 1, and one of another kind."""
    rows = [("tea", s, n) for n, s in enumerate("xxxxyyz")] + [("oats", "x", 9)]
    df = spark.createDataFrame(rows, "kind string, seller string, g long")
    r = aggregates.concentration(df, "kind", {"seller": F.col("seller")}, "g").where("kind = 'tea'").first()
    assert (r["n_rows"], r["n_values"], r["max_share"], r["hhi"]) == (7, 3, pytest.approx(4 / 7), pytest.approx(21 / 49))


def test_duplicate_membership(spark):
    """Rows 0 and 1 differ in spelling and taxon, 2 and 3 are one row twice, 5 has no address."""
    rows = [(0, "http://Pix.test:80/q", "m", "l"), (1, "http://pix.test/q#top", "n", "l"), (2, "ftp://pix.test/r", "m", "l"), (2, "ftp://pix.test/r", "m", "l"), (4, "http://pix.test/s", "m", None), (5, None, None, None)]
    df = spark.createDataFrame(rows, "id int, u string, t string, l string")
    got = {r["id"]: r for r in aggregates.duplicate_membership(df, "id", "u", ["id", "u"], F.col("t"), F.col("l")).collect()}
    assert got[0]["canonical_group_id"] == got[1]["canonical_group_id"] is not None and got[2]["canonical_group_id"] is None
    assert {k: r["duplicate_status"] for k, r in got.items()} == {0: "CONFLICT", 1: "CONFLICT", 2: "DUPLICATE", 4: "UNIQUE", 5: "UNIQUE"}
    assert [got[k]["url_group_size"] for k in (0, 2)] == [1, 2]


def test_order_does_not_matter(spark):
    df = spark.range(500).withColumn("s", F.col("id") % 5)
    a = {tuple(r) for r in sampling.stratified_sample(df, ["s"], "id", 4, "x").collect()}
    b = {tuple(r) for r in sampling.stratified_sample(df.repartition(7).orderBy(F.desc("id")), ["s"], "id", 4, "x").collect()}
    assert a == b and len(a) == 20


def test_nearest_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.integers(-2, 3, (200, 6)).astype(float)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (None, [1.0] * 6)], "id long, v array<double>").repartition(5)
    got = {}
    for r in similarity.nearest(df, df.where("id % 20 = 0"), "id", "v", 3, block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["neighbour_id"])
    u = similarity._unit(v)
    for q in range(0, 200, 20):
        s = np.round(u @ u[q], 12)
        assert got[q] == sorted((i for i in range(200) if i != q), key=lambda i: (-s[i], i))[:3]


def test_evaluation_values(spark):
    rows = [(True, 0.9, 1.0), (True, 0.4, 2.0), (False, 0.4, 1.0), (False, 0.1, 1.0)]
    df = spark.createDataFrame(rows, "y boolean, p double, w double").withColumn("g", F.lit("g"))
    assert evaluation.roc_auc(df, ["g"], F.col("y"), F.col("p"), F.col("w"), bands=3).first()["roc_auc"] == pytest.approx((1 * 2 + 2 * 1.5) / 6)
    c = evaluation.confusion(df, ["g"], F.col("y"), F.col("p") > 0.5, F.col("w")).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"], c["recall"]) == (1, 0, 2, 2, pytest.approx(1 / 3))
    assert evaluation.pr_auc(df, ["g"], F.col("y"), F.col("p"), F.col("w"), bands=3).first()["pr_auc"] == pytest.approx((1 * 1 + 2 * 3 / 4) / 3)
    assert evaluation.pr_auc(df.where("y").withColumn("g", F.lit(None).cast("string")), ["g"], F.col("y"), F.col("p"), F.col("w")).collect()[0]["pr_auc"] is None
    only = evaluation.roc_auc(df.where("y"), ["g"], F.col("y"), F.col("p"), F.col("w")).first()["roc_auc"]
    assert only is None
    low = spark.createDataFrame([(9.0, 10.0), (0.0, 5.0), (0.0, 0.0)], "h double, n double").select(evaluation.exact_low("h", "n").alias("v")).collect()
    assert low[0]["v"] == pytest.approx(0.6058, abs=1e-3) and low[1]["v"] == 0 and low[2]["v"] is None
    import pandas as pd

    assert evaluation.isotonic(pd.DataFrame({"y": [0.1, 0.5, 0.3, 0.9], "w": [1, 1, 1, 1]})).tolist() == [0.1, 0.4, 0.4, 0.9]
    boot = evaluation.bootstrap_interval(df.withColumn("c", F.monotonically_increasing_id()), "c", F.col("y"), 50).first()
    assert 0 <= boot["low"] <= boot["mean"] <= boot["high"] <= 1


def test_audited_thresholds_judge_every_score(spark):
    import math
    import random

    r = random.Random(5)
    rows = [(r.random() < 0.3 + 0.6 * s, s, r.choice([0.2, 1.0, 1.7]), f"c{r.randrange(90)}") for s in (r.choice([round(r.random(), 3), 0.5, 0.98, 1.0]) for _ in range(300))]
    rows += [(False, 0.99, 1.0, "late"), (True, 0.97, 1.0, "late"), (True, None, 1.0, "x"), (None, 0.5, 1.0, "x"), (True, 0.5, None, "x")]
    df = spark.createDataFrame(rows, "t boolean, s double, w double, c string").repartition(5)
    got = {x["threshold"]: x for x in evaluation.audited_thresholds(df, F.col("t"), F.col("s"), F.col("w"), F.col("c"), 0.3, bands=7).collect()}
    known = [x for x in rows if None not in x]
    assert set(got) == {x[1] for x in known} and len(got) > 60

    def exact(k, m):
        a, b = 0.0, 1.0
        for _ in range(60):
            x = (a + b) / 2
            tail = sum(math.comb(m, i) * x**i * (1 - x) ** (m - i) for i in range(k, m + 1))
            a, b = (a, x) if tail >= 0.05 else (x, b)
        return a if k else 0.0

    z, accepted = 1.6448536269514722, []
    for cut_off in sorted(got):
        sel, x = [y for y in known if y[1] >= cut_off], got[cut_off]
        w, hit = sum(y[2] for y in sel), sum(y[2] for y in sel if y[0])
        p, n = hit / w, w * w / sum(y[2] ** 2 for y in sel)
        wilson = max(0, ((p + z * z / 2 / n) - z * math.sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n))
        outcome = {}
        for t, _, _, c in sel:
            outcome[c] = outcome.get(c, True) and t
        k, m = sum(outcome.values()), len(outcome)
        assert (x["hits"], x["n"], x["component_hits"], x["components"]) == (sum(y[0] for y in sel), len(sel), k, m)
        assert (x["precision"], x["effective_n"], x["weighted_low"]) == (pytest.approx(p, abs=1e-8), pytest.approx(n, abs=1e-3), pytest.approx(wilson, abs=1e-8))
        assert x["component_low"] == pytest.approx(exact(k, m), abs=1e-8) and x["low"] == min(x["weighted_low"], x["component_low"])
        assert x["accepted"] == (len(sel) >= 30 and m >= 30 and x["low"] >= 0.3)
        accepted += [cut_off] * x["accepted"]
    assert accepted and [c for c in got if got[c]["selected"]] == [min(accepted)]


def test_audited_threshold_query_judges_validation_rows_only(spark, tiny):
    from fieldlark.plans import workflows
    from fieldlark.session import table

    c = table(spark, tiny, "calibration_prediction").where("lower(trim(dataset_split)) = 'model_selection' and true_class_label is not null and sample_weight is not null and decision_scores[0] is not null")
    got = workflows.QUERIES["w_audited_threshold"](spark, tiny)
    assert {r[0] for r in got.select("threshold").collect()} == {r[0] for r in c.selectExpr("decision_scores[0]").collect()}
    assert got.agg(F.max("n")).first()[0] == c.count()


def test_calibration_uses_every_score(spark):
    import math
    import random

    import pandas as pd

    r = random.Random(8)
    rows = [(r.random() < s, s, r.choice([0.5, 1.0, 2.0])) for s in (r.choice([round(r.random(), 4), 0.5, 1.25, -0.5]) for _ in range(600))]
    df = spark.createDataFrame(rows, "t boolean, s double, w double").repartition(4)
    got = {x["score"]: x["calibrated"] for x in evaluation.isotonic_calibration(df, F.col("t"), F.col("s"), F.col("w"), 20).collect()}
    per = pd.DataFrame([(s, w, w * t) for t, s, w in rows], columns=["s", "w", "h"]).groupby("s").sum().sort_index()
    want = evaluation.isotonic(pd.DataFrame({"y": per["h"] / per["w"], "w": per["w"]}))
    assert list(per.index) == sorted(got) and [got[s] for s in per.index] == pytest.approx(list(want))
    z = [(t, math.log(s / (1 - s)), w) for t, s, w in rows if 0 < s < 1]
    a, b, t = evaluation.logit_scaling(spark.createDataFrame(z, "t boolean, z double, w double"), F.col("t"), F.col("z"), F.col("w"))
    off = [(w * (1 / (1 + math.exp(-(a * x + b))) - y), w * (1 / (1 + math.exp(-t * x)) - y), x) for y, x, w in z]
    assert [sum(o[0] for o in off), sum(o[0] * o[2] for o in off), sum(o[1] * o[2] for o in off)] == pytest.approx([0, 0, 0], abs=1e-6)


def test_fair_schedule_keeps_every_row(spark):
    import random

    r = random.Random(2)
    rows = [(r.choice(["a", "a", "a", "a", "b", "c", None]), i % 17, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, t int, i int").repartition(5)
    got = [x["i"] for x in sampling.fair_schedule(df, "g", ["t", "i"], 3).orderBy("position").collect()]
    per = {g: sorted((t, i) for h, t, i in rows if h == g) for g in (None, "a", "b", "c")}
    want = []
    while any(len(v) >= 3 for v in per.values()):
        for g, v in per.items():
            if len(v) >= 3:
                want += [i for _, i in v[:3]]
                per[g] = v[3:]
    assert got == want + [i for v in per.values() for _, i in v]
    with pytest.raises(ValueError):
        sampling.fair_schedule(df, "g", ["t"], 0)


def test_cycled_pick_takes_turns_of_strata(spark):
    rows = [("big", "x", i) for i in range(30)] + [("big", "y", i) for i in range(30, 32)] + [("small", "x", i) for i in range(40, 43)]
    got = sampling.cycled_pick(spark.createDataFrame(rows, "g string, s string, i int"), "g", ["s"], ["i"], [(25, 6)]).orderBy("g", "place").collect()
    assert [(x["g"], x["i"]) for x in got] == [("big", i) for i in (0, 30, 1, 31, 2, 3)] + [("small", i) for i in (40, 41, 42)]


def test_hierarchies(spark):
    e = spark.createDataFrame([("s1", "g1"), ("s2", "g1"), ("g1", "f"), ("s3", "g2"), ("g2", "f")], "child string, parent string")
    up = registry.ancestors(e, "child", "parent")
    assert {tuple(r) for r in up.where("node = 's1'").collect()} == {("s1", "g1", 1), ("s1", "f", 2)}
    m = spark.createDataFrame([("x", "s1"), ("x", "s2"), ("y", "s1"), ("y", "s3"), ("z", "s1")], "grp string, node string")
    assert {r["grp"]: r["common"] for r in registry.lowest_common(m, "grp", "node", up).collect()} == {"x": "g1", "y": "f", "z": "s1"}
    deep = spark.createDataFrame([(i, i + 1) for i in range(35)], "child int, parent int")
    assert registry.ancestors(deep, "child", "parent").agg(F.max("distance")).first()[0] == 35
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")
    assert registry.ancestors(loop, "child", "parent").count() == 2
    hit = registry.invalidated(e.select(F.col("child").alias("source"), F.col("parent").alias("target")), spark.createDataFrame([("s1",)], "node string"))
    assert {tuple(r) for r in hit.collect()} == {("s1", 0), ("g1", 1), ("f", 2)}


def test_average_linkage():
    import numpy as np

    v = similarity._unit(np.array([[1.0, 0], [0.9, 0.1], [0, 1.0], [0.1, 0.9]]))
    assert similarity.average_linkage(v, 0.8).tolist() == [0, 0, 1, 1]
    assert similarity.average_linkage(v[:1], 0.8).tolist() == [0]


def test_selection(spark):
    from fieldlark.operators import selection

    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 3), ("a", 3, 9), ("a", 4, 1), ("b", 1, 99), ("b", 2, None)], "g string, o int, s int")
    got = {(r["g"], r["o"]): r["batch"] for r in selection.greedy_batches(df, "g", "o", "s", 6).collect()}
    assert got == {("a", 1): 0, ("a", 2): 0, ("a", 3): 1, ("a", 4): 2, ("b", 1): 0, ("b", 2): 1}
    plan = selection.reuse_plan(spark.createDataFrame([("x",), ("y",), ("z",)], "k string"), spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int"), "k", F.lit(1), "v")
    assert {r["k"]: r["action"] for r in plan.collect()} == {"x": "REUSE", "y": "REFRESH", "z": "COMPUTE"}
    scores = spark.createDataFrame([("t", ["p", "q"], 0.9), ("u", ["r"], 0.01), ("p", [], None)], "t string, c array<string>, m double")
    out = selection.rescore_plan(scores, spark.createDataFrame([("p",)], "i string"), "i", "t", "c", "m", 0.05)
    assert {r["t"]: r["rescore_reasons"] for r in out.collect()} == {"t": ["CANDIDATE_CHANGED"], "u": ["NARROW_MARGIN"], "p": ["TARGET_CHANGED"]}


def test_running_totals_of_hot_keys(spark):
    from fieldlark.operators import hot_keys

    rows = [("hot" if i % 3 else f"k{i % 7}", float((i * 37) % 101) - 50, 1.0 + i % 4) for i in range(3000)] + [(None, 1.0, 1.0), ("hot", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    want = {}
    for k, v, w in rows:
        if k is not None and v is not None:
            want.setdefault(k, {}).setdefault(v, 0.0)
            want[k][v] += w
    for per_chunk in (40, None):
        got = hot_keys.running_totals(df, "k", "v", hot_keys.monotone(F.col("v")), {"w": F.col("w")}, per_chunk).collect()
        assert {(r["k"], r["v"]): (r["w"], r["w_through"], r["w_all"]) for r in got} == {(k, v): (w, sum(x for u, x in per.items() if u <= v), sum(per.values())) for k, per in want.items() for v, w in per.items()}
        assert len(got) == sum(map(len, want.values()))


def test_monotone(spark):
    values = sorted([0.0, -0.0, 1e-9, 1e-6, 0.5, 1, 1 + 1e-7, 2, 1e9, 1e300, -1e-6, -3, -1e300, float("inf"), -float("inf")]) + [float("nan")]
    from fieldlark.operators.hot_keys import monotone

    got = [r["m"] for r in spark.createDataFrame([(float(v),) for v in values], "v double").select("v", monotone(F.col("v")).alias("m")).orderBy("v").collect()]
    assert got == sorted(got) and len(set(got)) > 10


def test_ranks_and_quantiles(spark):
    df = spark.createDataFrame([(None, 3, 1.0), (None, 3, 1.0), (None, 1, 8.0), ("a", None, 1.0), ("a", 5, None)], "k string, s int, w double")
    got = sorted((r["s"], r["average_rank"], r["utility"]) for r in sampling.average_rank(df.where("k is null"), "k", "s").collect())
    assert got == [(1, 3.0, 0.0), (3, 1.5, 0.75), (3, 1.5, 0.75)]
    assert {r["k"]: r["quantile"] for r in sampling.weighted_quantile(df, "k", "s", "w", 0.5).collect()} == {None: 1}
    assert [r["stratum"] for r in sampling.tail_strata(spark.range(4).withColumn("v", F.col("id")), "v").orderBy("id").collect()] == ["low", "middle", "high", "high"]
    assert sampling.tail_strata(df.limit(0), "s").count() == 0


@pytest.mark.parametrize("block", [1, 2, 100])
def test_class_scores(spark, block):
    """However many blocks the means take, a row comes out once with the same scores."""
    df = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0]), (3, None, [1.0, 1.0]), (4, "z", [0.0, -2.0]), (5, "a", None), (6, "c", [0.0, 0.0])], "id int, l string, v array<double>")
    means = spark.createDataFrame([("b", [0.0, 1.0]), ("a", [2.0, 0.0]), ("c", [-1.0, 0.0]), (None, [5.0, 5.0])], "l string, mean array<double>")
    got = {r["id"]: r for r in similarity.class_scores(df, means, "id", "v", "l", block).collect()}
    assert {i: r["predicted"] for i, r in got.items()} == {1: "a", 2: "b", 3: "a", 4: "a", 6: "a"}
    assert (got[1]["own_score"], got[1]["score"], got[1]["next"], got[1]["best_other"], got[1]["total"], got[1]["n"]) == (1.0, 1.0, 0.0, 0.0, 0.0, 3)
    assert got[4]["own_score"] is None and got[3]["next"] == pytest.approx(0.5**0.5) and got[4]["best_other"] == 0.0


def test_weighted_proportions(spark):
    df = spark.createDataFrame([("g", True, 2.0), ("g", False, 2.0), ("g", True, None), ("g", True, -1.0), ("h", True, None)], "k string, hit boolean, w double")
    got = {r["k"]: r for r in evaluation.weighted_proportions(df, ["k"], F.col("hit"), F.col("w")).collect()}
    assert (got["g"]["n"], got["g"]["share"], got["g"]["effective_n"]) == (2, 0.5, 2.0) and got["g"]["low"] == pytest.approx(0.0945, abs=1e-3)
    assert got["h"]["share"] is None and got["h"]["n"] == 0
