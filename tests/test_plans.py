"""What the plans must look like: pruned and filtered scans, no products, few shuffles."""

import random
import re

import pytest

from fieldlark.operators import hot_keys, parse_rows
from fieldlark.plans import composites, preparation, relational


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_is_one_pass(spark, tiny):
    p = plan(preparation.p1_found(spark, tiny))
    assert "Exchange" not in p and "ReadSchema: struct<raw_id:bigint,raw_line:string>" in p


def test_history_scan_is_pruned_and_filtered(spark, tiny):
    p = plan(preparation.p6_found(spark, tiny))
    assert "EqualTo(status,complete)" in p and "scientific_name" not in p


def test_history_rows_are_shuffled_once(spark, tiny):
    """The hot path: what needs the chunks' ends reads the same shuffle again."""
    rows = preparation._complete(spark, tiny)
    out = hot_keys.value_changes(rows, preparation._taxon_key(), "retrieved_at", "presence_id", "occurrence_count", rows_per_chunk=20)
    out.collect()
    p = plan(out).partition("== Initial Plan ==")[0]
    assert p.count("REPARTITION_BY_COL") == 2 and re.search(r"ReusedExchange .*REPARTITION_BY_COL", p)


def test_orphans_read_what_they_need(spark, tiny):
    p = plan(preparation.p5_found(spark, tiny))
    assert "media_creator" not in p and "scientificName" not in p and "EqualTo(source,GBIF)" in p


@pytest.mark.parametrize("name", ["q_duplicate_membership", "q_gate_breakdown", "q_concentration", "q_strongest_scope_match", "q_wide_dimension_struct"])
def test_no_products_in_relational_plans(spark, tiny, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan(relational.QUERIES[name](spark, tiny)))


@pytest.mark.parametrize("name", ["c_final_wide_join", "c_readiness_ladder", "v_nearest_centroid", "e_roc_auc", "e_threshold_grid"])
def test_no_products_in_composite_plans(spark, tiny, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan(composites.QUERIES[name](spark, tiny)))


def test_gates_read_their_table_once(spark, tiny):
    assert plan(relational.QUERIES["q_gate_breakdown"](spark, tiny)).count("FileScan") == 1


def test_quoting_round_trip(spark):
    """Any fields, written by the rules, come back as they were."""
    rng = random.Random(11)
    names = [f.name for f in parse_rows.OCCURRENCE.fields]

    def field():
        v = "".join(rng.choices('ab"\t\n é,', k=rng.randrange(0, 9))).strip(" ")
        return v if v not in parse_rows.MISSING else "x"

    def write(v):
        return '"' + v.replace('"', '""') + '"' if rng.random() < 0.3 or set(v) & set('"\t\n') else v

    rows = [[field() for _ in names] for _ in range(400)]
    df = spark.createDataFrame([(i, "\t".join(map(write, r))) for i, r in enumerate(rows)], "id int, raw string")
    got = {r["id"]: [r[n] for n in names] for r in parse_rows.check_lines(df, "raw").orderBy("id").collect()}
    assert got == {i: r for i, r in enumerate(rows)}
