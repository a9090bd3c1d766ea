import datetime as dt

from fieldlark.streaming import events as ev

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def write(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


BATCHES = [[(1, at(1), 7, "a", 1.0), (2, at(1, 5), 7, "b", 2.0)], [(1, at(1), 7, "a", 1.0), (3, at(2), 8, "a", 4.0)], [(4, at(3), 7, "a", None)]]


def source(spark, path):
    return ev.stream(spark, str(path), spark.read.parquet(str(path)).schema, files_per_batch=1)


def test_streams(spark, tmp_path):
    write(spark, tmp_path / "in", BATCHES)
    counts = ev.run_windowed_counts(source(spark, tmp_path / "in"), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert {(r["window_start"].day, r["event_type"]): (r["n"], r["total"]) for r in counts.collect()} == {(1, "a"): (2, 2.0), (1, "b"): (1, 2.0), (2, "a"): (1, 4.0), (3, "a"): (1, None)}
    once = ev.run_deduplicated(source(spark, tmp_path / "in"), "event_id", str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert sorted(r["event_id"] for r in once.collect()) == [1, 2, 3, 4]
    last = ev.run_upserts(source(spark, tmp_path / "in"), "user_id", ["ts", "event_id"], str(tmp_path / "o3"), str(tmp_path / "c3"))
    assert {r["user_id"]: r["event_id"] for r in last.collect()} == {7: 4, 8: 3}


def test_rerun_takes_only_what_is_new(spark, tmp_path):
    write(spark, tmp_path / "in", BATCHES[:1])
    args = ("event_id", str(tmp_path / "o"), str(tmp_path / "c"))
    assert ev.run_deduplicated(source(spark, tmp_path / "in"), *args).count() == 2
    write(spark, tmp_path / "in", BATCHES[1:])
    assert ev.run_deduplicated(source(spark, tmp_path / "in"), *args).count() == 4


def test_late_rows_are_dropped_and_state_ends(spark, tmp_path):
    """Day 20 moves the bound to day 10 for the batch after the next: there a row of day 2 comes too
    late, one of day 12 does not."""
    write(spark, tmp_path / "in", [[(1, at(2), 7, "a", 1.0)], [(2, at(20), 7, "a", 1.0)], [(8, at(19), 7, "b", 1.0)], [(3, at(2), 7, "a", 1.0), (4, at(12), 7, "a", 1.0), (5, None, 7, "a", 1.0)]])
    out = ev.run_windowed_counts(source(spark, tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "c"), late="10 days")
    assert {r["window_start"].day: r["n"] for r in out.collect()} == {2: 1, 20: 1, 19: 1, 12: 1}
    write(spark, tmp_path / "in", [[(6, at(3), 7, "a", 1.0), (7, at(20), 7, "a", 1.0)]])
    out = ev.run_windowed_counts(source(spark, tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "c"), late="10 days")
    assert {r["window_start"].day: r["n"] for r in out.collect()} == {2: 1, 20: 2, 19: 1, 12: 1}


def test_upserts_survive_reruns_and_compaction(spark, tmp_path):
    write(spark, tmp_path / "in", BATCHES)
    args = ("user_id", ["ts", "event_id"], str(tmp_path / "o"), str(tmp_path / "c"))
    state = lambda: {r["user_id"]: r["event_id"] for r in ev.run_upserts(source(spark, tmp_path / "in"), *args).collect()}
    assert state() == {7: 4, 8: 3} == state()
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    assert ev.compact(spark, str(tmp_path / "o"), schema, ["user_id"], ["ts", "event_id"]) == 2
    assert sorted(p.name for p in (tmp_path / "o").iterdir()) == ["base-2"] and state() == {7: 4, 8: 3}
    write(spark, tmp_path / "in", [[(9, at(1), 9, "a", 0.0), (10, at(9), 8, "a", 0.0)]])
    assert state() == {7: 4, 8: 10, 9: 9}
    ev.compact(spark, str(tmp_path / "o"), schema, ["user_id"], ["ts", "event_id"])
    assert sorted(p.name for p in (tmp_path / "o").iterdir()) == ["base-3"] and state() == {7: 4, 8: 10, 9: 9}


def test_a_batch_that_is_run_again_overwrites_itself(spark, tmp_path):
    df = spark.createDataFrame(BATCHES[0], SCHEMA)
    for _ in range(2):
        ev._append(df, str(tmp_path / "o"), 0)
    assert ev.read_log(spark, str(tmp_path / "o"), df.schema).count() == 2
    assert ev.read_log(spark, str(tmp_path / "none"), df.schema).count() == 0
