"""Ordered and per-key results when a few keys hold most rows.

A key's rows must be seen in order, but a hot key must not become one task. With P shuffle
partitions and n rows, a key is hot from n / 2P rows on, so there are at most 2P hot keys, and
each is cut along its order column into chunks of about n / 4P rows, at most 4P for all rows
of one key and 6P in all. These numbers follow from P alone: no key beyond them is left whole,
and every other key is smaller than half an average partition. Row counts per key come from a
map-side combined aggregate; chunk edges from a sample of about ``SAMPLED`` rows per chunk,
which only places the cuts and never changes a result.

Rows are shuffled once, by (key, chunk). Equal (key, order) rows are combined and the running
value is taken inside a chunk; what passes from chunk to chunk is one row per chunk of a hot
key, which is broadcast (at most 6P rows). If the sample shows one moment of one key filling
a whole chunk, equal rows are combined on the map side before they are shuffled, so that a
burst is one row per task.

Defined results: rows whose key or order column is NULL are not part of any order and
are left out by the functions here; ties in the order column are settled by the
aggregates that combine them; repeated rows are separate rows; empty tables give empty
results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlark.session import cut, small_table

# Chunks are never made smaller than this.
LEAST_CHUNK = 1_000
SAMPLED = 200


@dataclass(frozen=True)
class Hot:
    """Hot keys with the rising edges of their chunks; ``burst`` tells that one moment of
    one key fills a chunk."""

    edges: list[tuple[object, list[int]]] = field(default_factory=list)
    burst: bool = False


def find_hot(df: DataFrame, key: str, place: Column, rows_per_chunk: int | None = None) -> Hot:
    """The hot values of ``key`` and chunk edges along ``place`` (a bigint expression).
    ``rows_per_chunk`` replaces n / 4P, for tests."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias("k"), place.alias("t")).where(F.col("k").isNotNull() & F.col("t").isNotNull())
    least = rows_per_chunk or LEAST_CHUNK
    # One row for each key of some size, and one (NULL) for all others together.
    sums = cut(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).groupBy(F.when(F.col("n") >= least, F.col("k")).alias("k")).agg(F.sum("n").alias("n")))
    total = sums.agg(F.sum("n")).first()[0] or 0
    chunk = rows_per_chunk or max(LEAST_CHUNK, -(-total // (4 * partitions)))
    top = sums.where(F.col("k").isNotNull() & (F.col("n") >= 2 * chunk)).select("k", F.ceil(F.col("n") / chunk).cast("int").alias("c")).collect()
    if not top:
        return Hot()
    hot = small_table(spark, top, sums.select("k", F.lit(0).alias("c")).schema)
    sample = rows.where(F.rand(7) < min(1.0, SAMPLED / chunk)).join(F.broadcast(hot), "k")
    w = Window.partitionBy("k")
    ranked = sample.select("k", "t", (F.floor((F.row_number().over(w.orderBy("t")) - 1) * F.col("c") / F.count(F.lit(1)).over(w))).alias("b"))
    starts = ranked.groupBy("k", "b").agg(F.min("t").alias("t")).collect()
    per: dict[object, list[int]] = {k: [] for k, _ in top}
    burst = False
    for k, _, t in sorted(starts, key=lambda r: r["t"]):
        burst = burst or (bool(per[k]) and per[k][-1] == t)
        per[k].append(t)
    # The first chunk has no edge: it begins before everything.
    return Hot([(k, sorted(set(v))[1:]) for k, v in per.items()], burst)


def chunked(df: DataFrame, key: str, place: Column, hot: Hot, name: str = "__chunk") -> DataFrame:
    """``df`` with the chunk of each row, from 0; -1 for keys that are not hot."""
    kind = T.StructType([T.StructField("__hot_key", df.schema[key].dataType), T.StructField("__first", T.ArrayType(T.LongType())), T.StructField("__edges", T.ArrayType(T.ArrayType(T.LongType())))])
    # Edges are looked up in two steps: among the first of each run of ``step``, then inside the run.
    step = max(4, math.isqrt(max(len(e) for _, e in hot.edges)))
    table = [(k, e[::step], [e[i : i + step] for i in range(0, len(e), step)]) for k, e in hot.edges]
    edges = F.broadcast(small_table(df.sparkSession, table, kind))
    before = lambda c: F.size(F.filter(c, lambda e: e <= place))
    runs = before(F.col("__first"))
    inside = F.when(runs == 0, F.lit(0)).otherwise((runs - 1) * step + before(F.get(F.col("__edges"), runs - 1)))
    # Never NULL for the planner, so that no filter is put below the shuffle of one of its readers.
    at = F.coalesce(F.when(F.col("__first").isNotNull(), inside), F.lit(-1))
    return df.join(edges, F.col(key) == F.col("__hot_key"), "left").withColumn(name, at).drop("__hot_key", "__first", "__edges")


def combined(df: DataFrame, key: str, order: str, place: Column, aggregates: Sequence[Column], hot: Hot) -> DataFrame:
    """One row per (key, order) with its chunk and the aggregates, partitioned by (key, chunk)."""
    df = df.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    if not hot.edges:
        return df.repartition(key).groupBy(key, order).agg(*aggregates).withColumn("__chunk", F.lit(-1))
    parts = chunked(df, key, place, hot)
    if not hot.burst:
        parts = parts.repartition(key, "__chunk")
    return parts.groupBy(key, "__chunk", order).agg(*aggregates)


def carried(rows: DataFrame, key: str, order: str, value: str, into: str, hot: Hot, *, include_current: bool) -> DataFrame:
    """``rows`` of ``combined`` with ``into``: the last non-NULL ``value`` of the same key
    before each row, or up to and with it."""
    last = Window.unboundedPreceding, 0 if include_current else -1
    w = Window.partitionBy(key, "__chunk").orderBy(order)
    out = rows.withColumn(into, F.last(value, ignorenulls=True).over(w.rowsBetween(*last)))
    if hot.edges:
        # The filter asks for an aggregate, so it stays above the shuffle, which is then used twice.
        ends = rows.where(F.col(value).isNotNull()).groupBy(key, "__chunk").agg(F.max_by(value, order).alias("__end"), F.max("__chunk").alias("__hot")).where("__hot >= 0").drop("__hot")
        grid = small_table(
            rows.sparkSession,
            [(k, c) for k, e in hot.edges for c in range(len(e) + 1)],
            T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("__chunk", T.IntegerType())]),
        )
        before = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        carry = grid.join(ends, [key, "__chunk"], "left").select(F.col(key).alias("__ck"), F.col("__chunk").alias("__cc"), F.last("__end", ignorenulls=True).over(before).alias("__before"))
        out = out.join(F.broadcast(carry), (F.col(key) == F.col("__ck")) & (F.col("__chunk") == F.col("__cc")), "left")
        out = out.withColumn(into, F.coalesce(into, "__before")).drop("__ck", "__cc", "__before")
    return out.drop("__chunk")


def running_totals(df: DataFrame, key: str, order: str, place: Column, sums: dict[str, Column], rows_per_chunk: int | None = None) -> DataFrame:
    """One row per (key, order) with its totals and, for each, ``<name>_through`` (summed along the
    order, up to and with the row) and ``<name>_all`` (of the key). ``place`` is a bigint that never
    falls where ``order`` rises. No task sees all of a hot key: see above."""
    hot = find_hot(df, key, place, rows_per_chunk)
    rows = combined(df, key, order, place, [F.sum(c).alias(n) for n, c in sums.items()], hot)
    w = Window.partitionBy(key, "__chunk")
    upto = w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(n).over(upto).alias(f"{n}_through") for n in sums], *[F.sum(n).over(w).alias(f"{n}_all") for n in sums])
    if hot.edges:
        ends = rows.groupBy(key, "__chunk").agg(*[F.sum(n).alias(f"__{n}") for n in sums], F.max("__chunk").alias("__hot")).where("__hot >= 0").drop("__hot")
        per, before = Window.partitionBy(key), Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(F.col(key).alias("__ck"), F.col("__chunk").alias("__cc"), *[F.sum(f"__{n}").over(before).alias(f"__{n}_before") for n in sums], *[F.sum(f"__{n}").over(per).alias(f"__{n}_whole") for n in sums])
        out = out.join(F.broadcast(carry), (F.col(key) == F.col("__ck")) & (F.col("__chunk") == F.col("__cc")), "left")
        out = out.withColumns({**{f"{n}_through": F.col(f"{n}_through") + F.coalesce(f"__{n}_before", F.lit(0)) for n in sums}, **{f"{n}_all": F.coalesce(f"__{n}_whole", f"{n}_all") for n in sums}})
    return out.select(key, order, *[c for n in sums for c in (n, f"{n}_through", f"{n}_all")])


def nearest_rank(df: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Per key the value at place ceil(q * n) of its known values in rising order, for each of
    ``shares`` by name. Values are counted once and summed along their order."""
    known = df.select(F.struct(key).alias("__key"), F.col(value).alias("__value")).where(F.col("__value").isNotNull())
    run = running_totals(known, "__key", "__value", monotone(F.col("__value")), {"n": F.lit(1)})
    reached = [F.min(F.when(F.col("n_through") >= F.ceil(F.col("n_all") * F.lit(q)), F.col("__value"))).alias(name) for name, q in shares.items()]
    return run.groupBy("__key").agg(*reached).select(F.col("__key")[key].alias(key), *shares)


def monotone(value: Column) -> Column:
    """A bigint that never falls where a number rises; it tells numbers apart by their logarithm."""
    v = value.cast("double")
    size = F.least(F.rint(F.log1p(F.abs(v) * 1e6) * 1e9), F.lit(1e15))
    # NaN comes after all numbers, as Spark orders it.
    return F.when(F.isnan(v), F.lit(2e15)).otherwise(F.signum(v) * size).cast("bigint")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def value_changes(df: DataFrame, key: Column, when: str, ident: str, value: str, rows_per_chunk: int | None = None) -> DataFrame:
    """The deliveries of each key whose value differs from the key's previous one.

    Rows of a key at one time are one delivery, named by the smallest ``ident``, whose value
    counts. Result: ``key, at, ident, value, previous``. A key's first delivery is no change.
    NULL keys, times and values take no part."""
    rows = df.select(key.alias("key"), F.col(when).alias("at"), F.col(ident).alias("ident"), F.col(value).alias("value"))
    rows = rows.where(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("value").isNotNull())
    place = micros(F.col("at"))
    hot = find_hot(rows, "key", place, rows_per_chunk)
    deliveries = combined(rows, "key", "at", place, [F.min_by("value", "ident").alias("value"), F.min("ident").alias("ident")], hot)
    out = carried(deliveries, "key", "at", "value", "previous", hot, include_current=False)
    return out.where(F.col("previous") != F.col("value")).select("key", "at", "ident", "value", "previous")


def key_totals(df: DataFrame, key: Column, value: str) -> DataFrame:
    """Counts and moments per key from native algebraic aggregates: each task combines its
    rows in a bounded hash table first, so a hot key shuffles one row per task.

    NULL keys form one group with key NULL; NULL values are not counted in ``n_values``."""
    return df.groupBy(key.alias("key")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("sum_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
