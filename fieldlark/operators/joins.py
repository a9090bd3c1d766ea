"""Joins with checked cardinality, three rules for NULL keys, and snapshot comparison.

Rules for NULL in a key, kept apart by name: ``dimension`` compares with ``=`` (NULL
matches nothing), ``null_safe`` treats NULL as a value, ``blank_safe`` takes NULL and the
empty text for the same value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlark.functions.scalars import distinct_from, reasons
from fieldlark.session import cut


class CardinalityError(ValueError):
    """A key that should be unique or matched is not."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, or CardinalityError naming one repeated key. One map-side combined count."""
    twice = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if twice:
        raise CardinalityError(f"key {tuple(twice[0][k] for k in keys)} occurs {twice[0]['count']} times")
    return df


def require_matched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    lost = df.join(other.select(*keys), list(keys), "left_anti").limit(1).collect()
    if lost:
        raise CardinalityError(f"no match for {tuple(lost[0][k] for k in keys)}")
    return df


def with_ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """A dense number from 0 along a total order, without one task seeing all rows: a range
    shuffle, a sort inside each partition, and one offset per partition."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(placed.groupBy(part.alias("p")).count().orderBy("p").collect())
    offsets, total = {}, 0
    for p in sorted(sizes):
        offsets[p] = total
        total += sizes[p]
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("bigint")).drop("__at")
    table = F.create_map(*[F.lit(x).cast("bigint") for kv in offsets.items() for x in kv])
    return placed.withColumn(name, F.try_element_at(table, part) + place).drop("__at")


def ordinal_join(left: DataFrame, right: DataFrame, name: str = "ordinal", check: bool = True) -> DataFrame:
    """1:1 join of two tables by their ordinal; with ``check`` both must cover the same numbers."""
    if check:
        span = [d.agg(F.count(F.lit(1)), F.min(name), F.max(name), F.sum(name)).first() for d in (left, right)]
        if span[0] != span[1]:
            raise CardinalityError(f"ordinals differ: {span[0]} and {span[1]}")
    return left.join(right, name)


def dimension(spine: DataFrame, dim: DataFrame, keys: Sequence[str], pack: str | None = None, required: bool = False, unique: bool = True) -> DataFrame:
    """Left join that keeps every spine row once. ``pack`` puts the dimension's columns into
    one struct (of NULLs where nothing matches). The dimension is first reduced to the keys
    that occur; its size then lets the planner choose how to join."""
    if unique:
        require_unique(dim, keys)
    if required:
        require_matched(spine.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])), dim, keys)
    used = dim.join(spine.select(*keys).distinct(), list(keys), "left_semi")
    joined = spine.join(used, list(keys), "left")
    if not pack:
        return joined
    rest = [c for c in dim.columns if c not in keys]
    return joined.select(*[F.col(c) for c in spine.columns], F.struct(*rest).alias(pack))


def blank_safe(spine: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], pack: str) -> DataFrame:
    """Left join on text keys where NULL equals the empty text; keys that become equal so raise."""
    keyed = dim.withColumns({f"__k{i}": F.coalesce(F.col(d).cast("string"), F.lit("")) for i, (_, d) in enumerate(on)})
    names = [f"__k{i}" for i in range(len(on))]
    require_unique(keyed, names)
    left = spine.withColumns({f"__k{i}": F.coalesce(F.col(s).cast("string"), F.lit("")) for i, (s, _) in enumerate(on)})
    return left.join(keyed.select(*names, F.struct(*dim.columns).alias(pack)), names, "left").drop(*names)


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Equi-join that treats NULL as a value; Spark hashes such keys like any others."""
    return left.join(right, reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in on]), how)


def snapshot_changes(current: DataFrame, previous: DataFrame, key: str, digests: Mapping[str, str]) -> DataFrame:
    """NEW, CHANGED and DELETED keys between two snapshots, with the names of what changed."""
    cols = list(digests)
    c = current.select(F.col(key).alias("__c"), *[F.col(x).alias(f"c_{x}") for x in cols])
    p = previous.select(F.col(key).alias("__p"), *[F.col(x).alias(f"p_{x}") for x in cols])
    both = c.join(p, F.col("__c") == F.col("__p"), "full_outer")
    differs = {digests[x]: F.col("__c").isNotNull() & F.col("__p").isNotNull() & distinct_from(F.col(f"c_{x}"), F.col(f"p_{x}")) for x in cols}
    any_ = reduce(lambda a, b: a | b, differs.values())
    return both.where(F.col("__c").isNull() | F.col("__p").isNull() | any_).select(
        F.coalesce("__c", "__p").alias(key),
        F.when(F.col("__p").isNull(), "NEW").when(F.col("__c").isNull(), "DELETED").otherwise("CHANGED").alias("change_status"),
        reasons({"NEW": F.col("__p").isNull(), "DELETED": F.col("__c").isNull(), **differs}).alias("change_reasons"),
    )


def refresh_queue(current: DataFrame, previous: DataFrame, key: str, digest: str, looked_at: str, today: str, terms: Mapping[str, int]) -> DataFrame:
    """Keys to look at again: NEW or CHANGED since ``previous``, or SAME but with a term (days since
    ``looked_at``) run out; one flag per term, NULL where nothing was looked at. An unchanged
    rerun within all terms queues nothing."""
    require_unique(previous, [key])
    old = previous.select(F.col(key).alias("__k"), F.col(digest).alias("__d"))
    joined = current.join(old, F.col(key) == F.col("__k"), "left")
    status = F.when(F.col("__k").isNull(), "NEW").when(distinct_from(F.col(digest), F.col("__d")), "CHANGED").otherwise("SAME")
    age = F.datediff(F.lit(today).cast("date"), F.to_date(looked_at))
    flags = {name: age > days for name, days in terms.items()}
    due = reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(True)) for f in flags.values()], F.lit(False))
    return joined.withColumns({"change_status": status, **flags}).where((F.col("change_status") != "SAME") | due).drop("__k", "__d")


def coverage(expected: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """One row: keys expected, matched exactly once, missing, repeated and unexpected."""
    e = expected.groupBy(F.col(key).alias("__k")).agg(F.lit(True).alias("__expected"))
    r = results.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    return e.join(r, "__k", "full").agg(
        F.count("__expected").alias("n_expected"),
        F.count_if(F.col("__expected") & (F.col("__n") == 1)).alias("n_once"),
        F.count_if(F.col("__expected") & F.col("__n").isNull()).alias("n_missing"),
        F.count_if(F.col("__expected") & (F.col("__n") > 1)).alias("n_repeated"),
        F.count_if(F.col("__expected").isNull()).alias("n_unexpected"),
    )


def strongest_match(facts: DataFrame, scopes: Sequence[tuple[str, DataFrame]], ident: str) -> DataFrame:
    """Facts joined to scope memberships of several kinds, strongest kind first; for each
    fact and scope only the strongest kind stays. Each scope table has the join key and ``scope_id``."""
    parts = []
    for rank, (key, members) in enumerate(scopes):
        parts.append(facts.join(members, key).select(ident, "scope_id", F.lit(rank).alias("tier"), F.lit(key).alias("matched_by")))
    allm = reduce(DataFrame.unionByName, parts)
    best = allm.groupBy(ident, "scope_id").agg(F.min(F.struct("tier", "matched_by")).alias("b"))
    return best.select(ident, "scope_id", "b.tier", "b.matched_by")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, first in ``order``. Spark keeps only the first rows of each
    task before the shuffle (window group limit), so a hot key moves one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
