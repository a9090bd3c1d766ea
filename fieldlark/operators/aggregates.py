"""Aggregations that combine on the map side: profiles, breakdowns, shares, modes, lists.

Distinct counts under several conditions are two-level: one row per (group, counted key)
with a flag per condition, then sums of flags. That shuffles each key once, where
``count(DISTINCT) FILTER`` would expand every row once per condition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlark.functions.scalars import canonical_url, nonblank, row_text, tagged_hash
from fieldlark.operators.hot_keys import nearest_rank
from fieldlark.session import cut


def duplicate_membership(df: DataFrame, ident: str, url: str, row_columns: Sequence[str], taxon: Column, licence: Column) -> DataFrame:
    """Each row with its exact-row, URL and canonical-URL group sizes and its status:
    CONFLICT where one URL serves several taxa or licences (told apart by ``across_taxa`` and
    ``across_licences``), DUPLICATE, or UNIQUE.

    The digests of a row are made once and written. A group has several taxa if the smallest
    and largest differ, so that sizes and conflicts combine on the map side in one aggregate
    over all three kinds of groups; groups of one row are dropped before they are joined back."""
    base = cut(
        df.select(
            ident,
            F.sha2(row_text(*[F.col(c) for c in row_columns]), 256).alias("row_hash"),
            F.sha2(F.trim(url), 256).alias("url_hash"),
            F.sha2(canonical_url(F.col(url)), 256).alias("canonical_hash"),
            taxon.alias("taxon"),
            licence.alias("licence"),
        )
    )
    clashes = {c: F.coalesce(F.min(c) != F.max(c), F.lit(False)) for c in ("taxon", "licence")}

    def groups(key: str, kind: str, *aggs: Column) -> DataFrame:
        return base.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(f"{kind}_n"), *aggs).where(f"{kind}_n > 1")

    clash = lambda kind: [x.alias(f"{kind}_{c}") for c, x in clashes.items()]
    joined = base.join(groups("row_hash", "row"), "row_hash", "left").join(groups("url_hash", "url", *clash("url")), "url_hash", "left").join(groups("canonical_hash", "canonical", *clash("canonical")), "canonical_hash", "left")
    across = {c: F.coalesce(F.col(f"url_{c}"), F.lit(False)) | F.coalesce(F.col(f"canonical_{c}"), F.lit(False)) for c in clashes}
    # The names of statuses.
    status = lambda c: F.when(across[c], "CONFLICT").when(F.col("url_hash").isNull(), "NOT_APPLICABLE").otherwise("PASS")
    return joined.select(
        ident,
        F.coalesce("row_n", F.lit(1)).alias("row_group_size"),
        F.coalesce("url_n", F.lit(1)).alias("url_group_size"),
        F.coalesce("canonical_n", F.lit(1)).alias("canonical_group_size"),
        F.when(F.col("canonical_n").isNotNull(), tagged_hash("canonical-url", F.col("canonical_hash"))).alias("canonical_group_id"),
        status("taxon").alias("across_taxa"),
        status("licence").alias("across_licences"),
        F.when(across["taxon"] | across["licence"], "CONFLICT").when(F.coalesce("row_n", "url_n", "canonical_n").isNotNull(), "DUPLICATE").otherwise("UNIQUE").alias("duplicate_status"),
    )


def gate_breakdown(df: DataFrame, gates: Mapping[str, Column], dimensions: Mapping[str, Column], counted: str) -> DataFrame:
    """Rows and distinct ``counted`` keys, all and passed, for every gate and dimension value.

    The dimensions are unpivoted once and the gates are columns, so the input is read once
    instead of once per gate and dimension."""
    dims = F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("value")) for n, c in dimensions.items()])
    names = list(gates)
    flat = df.select(F.col(counted).alias("key"), *[F.coalesce(g, F.lit(False)).alias(f"g{i}") for i, g in enumerate(gates.values())], F.inline(dims))
    per_key = flat.groupBy("dimension", "value", "key").agg(
        F.count(F.lit(1)).alias("n"), *[a for i in range(len(names)) for a in (F.count_if(F.col(f"g{i}")).alias(f"p{i}"),)]
    )
    per_value = per_key.groupBy("dimension", "value").agg(
        F.sum("n").alias("n_rows"),
        F.count("key").alias("n_keys"),
        *[x for i in range(len(names)) for x in (F.sum(f"p{i}").alias(f"p{i}"), F.count_if((F.col(f"p{i}") > 0) & F.col("key").isNotNull()).alias(f"k{i}"))],
    )
    stack = F.array(*[F.struct(F.lit(n).alias("gate"), F.col(f"p{i}").alias("passed_rows"), F.col(f"k{i}").alias("passed_keys")) for i, n in enumerate(names)])
    return per_value.select("dimension", "value", "n_rows", "n_keys", F.inline(stack)).withColumn("pass_percentage", 100.0 * F.col("passed_rows") / F.col("n_rows"))


def concentration(df: DataFrame, group: str, dimensions: Mapping[str, Column], counted: str) -> DataFrame:
    """Per group and dimension: values, largest share, sum of squared shares and its inverse."""
    dims = F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("value")) for n, c in dimensions.items()])
    values = df.select(group, counted, F.inline(dims)).groupBy(group, "dimension", "value", counted).agg(F.count(F.lit(1)).alias("n"))
    values = values.groupBy(group, "dimension", "value").agg(F.sum("n").alias("n"), F.count(counted).alias("k"))
    # sum((n / N)^2) = sum(n^2) / N^2 needs no window over the group.
    squares = F.sum(F.col("n").cast("double") * F.col("n")) / (F.sum("n").cast("double") * F.sum("n"))
    return values.groupBy(group, "dimension").agg(
        F.sum("n").alias("n_rows"),
        F.sum("k").alias("n_keys"),
        F.count(F.lit(1)).alias("n_values"),
        F.max("n").alias("largest"),
        (F.max("n") / F.sum("n")).alias("max_share"),
        squares.alias("hhi"),
        (1 / squares).alias("effective_values"),
    )


def mode_with_support(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent known value per key (ties: the smallest) with its count and all."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("b"), F.sum("n").alias("observed")).select(*keys, F.col("b.v").alias("mode"), (-F.col("b.minus")).alias("support"), "observed")


def completeness(df: DataFrame, columns: Sequence[str], counted: str) -> DataFrame:
    """One row per column: rows and distinct ``counted`` keys where it is known, in one pass."""
    per_key = df.groupBy(counted).agg(F.count(F.lit(1)).alias("n"), *[F.count(nonblank(F.col(c))).alias(f"n{i}") for i, c in enumerate(columns)])
    wide = per_key.agg(F.sum("n").alias("n"), F.count(counted).alias("k"), *[x for i in range(len(columns)) for x in (F.sum(f"n{i}").alias(f"n{i}"), F.count_if((F.col(f"n{i}") > 0) & F.col(counted).isNotNull()).alias(f"k{i}"))])
    stack = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n{i}").alias("known_rows"), F.col(f"k{i}").alias("known_keys")) for i, c in enumerate(columns)])
    return wide.select(F.inline(stack), F.col("n").alias("n_rows"), F.col("k").alias("n_keys"))


def consistency(value: Column) -> Column:
    """CONFLICT where a group's values differ or are partly missing, UNKNOWN without any."""
    v = nonblank(value)
    low, high, gone = F.min(v), F.max(v), F.count_if(v.isNull())
    return F.when(low.isNull(), "UNKNOWN").when((low != high) | (gone > 0), "CONFLICT").otherwise("PASS")


def frequency(df: DataFrame, value: Column, top: int) -> DataFrame:
    """The ``top`` most frequent values with rank and share, and one row for NULL."""
    counts = df.groupBy(value.cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.where(F.col("value").isNotNull()).orderBy(F.desc("n"), "value").limit(top)
    ranked = known.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "value")))
    missing = counts.where(F.col("value").isNull()).withColumn("rank", F.lit(None).cast("int"))
    return ranked.unionByName(missing).withColumn("share", F.round(F.try_divide(F.col("n"), F.lit(total)), 6))


def token_frequency(df: DataFrame, text: Column, by: str) -> DataFrame:
    """Rows per part of a divided text; NULL and empty texts count under NULL."""
    parts = F.when(F.length(text) > 0, F.split(text, by)).otherwise(F.array(F.lit(None).cast("string")))
    return df.select(F.explode(parts).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def ordered_list(order: Sequence[Column | str], payload: Sequence[Column | str], into: str) -> Column:
    """An aggregate: structs of ``payload`` in ``order``; NULLs inside structs survive."""
    cols = [F.col(c) if isinstance(c, str) else c for c in payload]
    keys = [(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)]
    whole = F.struct(*keys, F.struct(*cols).alias("p"))
    return F.transform(F.array_sort(F.collect_list(whole)), lambda x: x["p"]).alias(into)


def spread(df: DataFrame, key: str, day: str, source: str, uncertainty: str, flags: Mapping[str, Column]) -> DataFrame:
    """Occurrence spread per key: counts, day range, distinct sources, nearest-rank
    uncertainty quantiles and counts per flag."""
    per_source = df.groupBy(key, source).agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("low"), F.max(day).alias("high"), *[F.count_if(c).alias(f"n_{n}") for n, c in flags.items()])
    sums = [F.sum(f"n_{n}").alias(f"n_{n}") for n in flags]
    whole = per_source.groupBy(F.col(key).alias("__of")).agg(F.sum("n").alias("n_records"), F.min("low").alias("first_day"), F.max("high").alias("last_day"), F.count(source).alias("n_sources"), *sums)
    quantiles = nearest_rank(df, key, uncertainty, {"uncertainty_p50": 0.5, "uncertainty_p95": 0.95})
    joined = whole.join(quantiles, F.col("__of").eqNullSafe(F.col(key)), "left")
    return joined.select(F.col("__of").alias(key), "n_records", "first_day", "last_day", "n_sources", "uncertainty_p50", "uncertainty_p95", *[f"n_{n}" for n in flags])


def status_summary(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows per status of each status column, in one pass."""
    stack = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("status")) for f in fields])
    return df.select(F.inline(stack)).groupBy("field", "status").agg(F.count(F.lit(1)).alias("n"))


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows without a full key, distinct keys and repeated rows."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_null"),
        F.count_if(known).alias("n_distinct"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("n_repeated"),
    )


def leakage_groups(kinds: Mapping[str, Sequence[Column]]) -> dict[str, Column]:
    """A group id for each kind of relation: rows that share it must not be parted between splits.
    NULL where one of the parts is missing."""
    return {k: tagged_hash(k, F.concat(*[x for i, c in enumerate(cs) for x in ([F.lit("|")] * bool(i) + [c])])) for k, cs in kinds.items()}


def schema_audit(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """One row per field that is expected or there: MATCH, TYPE_DIFFERS, MISSING or EXTRA, the two
    types, and in how many rows it has no value, counted in one pass. Names compare exactly."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    fields = [*expected, *[c for c in actual if c not in expected]]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"k{i}") for i, c in enumerate(actual)])
    place = {c: i for i, c in enumerate(actual)}

    def row(c: str) -> Column:
        status = "MISSING" if c not in actual else "EXTRA" if c not in expected else "MATCH" if actual[c] == expected[c] else "TYPE_DIFFERS"
        known = F.col(f"k{place[c]}") if c in actual else F.lit(0)
        return F.struct(F.lit(c).alias("field"), F.lit(expected.get(c)).cast("string").alias("expected"), F.lit(actual.get(c)).cast("string").alias("actual"), F.lit(status).alias("status"), F.col("n").alias("n_rows"), (F.col("n") - known).alias("n_missing"))

    return counts.select(F.inline(F.array(*map(row, fields))))
