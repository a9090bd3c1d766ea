"""Queries that run as streams to their end, and their batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldlark.plans.register import Register
from fieldlark.session import cut, shared_dir, table
from fieldlark.streaming import events as ev

query = Register()
QUERIES, SQL = query.queries, query.sql


def _stream(spark, d):
    path = f"{d}/events.parquet"
    return ev.stream(spark, path, spark.read.parquet(path).schema)


def _finished(spark, run):
    """What ``run`` gives in a folder of its own, which is removed once the result is written."""
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    out = cut(run(f"{at}/out", f"{at}/state"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out


@query("""select time_bucket(interval '1 day', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2""")
def s_windowed_counts(spark, d):
    out = _finished(spark, lambda out, state: ev.run_windowed_counts(_stream(spark, d), out, state))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("total", F.round("total", 4))


@query("select distinct event_id, user_id, event_type from events")
def s_deduplicated(spark, d):
    return _finished(spark, lambda out, state: ev.run_deduplicated(_stream(spark, d), "event_id", out, state)).select("event_id", "user_id", "event_type")


@query("""select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def s_latest_by_key(spark, d):
    return _finished(spark, lambda out, state: ev.run_upserts(_stream(spark, d), "user_id", ["ts", "event_id"], out, state)).select("user_id", "event_id", "event_type")


@query("""select date_trunc('hour', ts) as hour, count(*) as n, case when count(*) > 18 then 'OVER' when count(*) > 14 then 'NEAR' else 'WITHIN' end as budget from events group by 1""")
def s_call_budget(spark, d):
    return ev.call_budget(table(spark, d, "events"), "ts", 14, 18).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("""select slice, count(*) as n from (select cast(floor(datediff('day', date '2024-01-01', ts::date) / 5) as bigint) as slice from events) group by 1""")
def s_date_slices(spark, d):
    return table(spark, d, "events").groupBy(F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 5).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
