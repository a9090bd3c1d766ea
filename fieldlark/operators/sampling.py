"""Reproducible samples: by digest order, per stratum, proportional, in turns and in shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlark.functions.scalars import hash_order
from fieldlark.operators.hot_keys import monotone, nearest_rank, running_totals
from fieldlark.operators.joins import with_ordinal


def stratified_sample(df: DataFrame, strata: Sequence[str], ident: str, n: int, seed: str) -> DataFrame:
    """Up to ``n`` rows per stratum in the order of a seeded digest, with their rank."""
    w = Window.partitionBy(*strata).orderBy("__h", ident)
    return df.withColumn("__h", hash_order(seed, F.col(ident))).withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n).drop("__h")


def probability_sample(df: DataFrame, strata: Sequence[str], ident: str, total: int, seed: str) -> DataFrame:
    """A sample of about ``total`` rows, at least one per stratum and otherwise in proportion,
    with inclusion probability and weight."""
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("stratum_size"))
    n_all = df.count()
    take = F.least(F.col("stratum_size"), F.greatest(F.lit(1), F.round(F.col("stratum_size") * (total / max(1, n_all))).cast("bigint")))
    w = Window.partitionBy(*strata).orderBy("__h", ident)
    ranked = df.withColumn("__h", hash_order(seed, F.col(ident))).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= total)
    joined = ranked.join(sizes.withColumn("stratum_take", take), list(strata)).where(F.col("__rn") <= F.col("stratum_take"))
    return joined.withColumn("inclusion_probability", F.col("stratum_take") / F.col("stratum_size")).withColumn("weight", F.col("stratum_size") / F.col("stratum_take")).drop("__h", "__rn")


def seeded_shards(df: DataFrame, ident: str, n: int, shards: int, seed: str) -> DataFrame:
    """The first ``n`` rows in digest order, dealt to shards in turn. The limit is the
    feature: only the ``n`` rows are ranked in one task."""
    h = hash_order(seed, F.col(ident))
    top = df.withColumn("__h", h).orderBy("__h", ident).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("__h", ident))).withColumn("shard", F.pmod(F.col("rank") - 1, F.lit(shards))).drop("__h")


def in_turns(df: DataFrame, group: str, order: Sequence[Column | str], chunk: int = 1, cap: int | None = None) -> DataFrame:
    """Rows numbered so that groups take turns, ``chunk`` rows at a time; ``cap`` rows per group at most."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    out = df.withColumn("place_in_group", rn)
    if cap is not None:
        out = out.where(F.col("place_in_group") <= cap)
    return out.withColumn("turn", F.floor((F.col("place_in_group") - 1) / chunk).cast("bigint"))


def _placed(df: DataFrame, group: str, order: Sequence[Column | str]) -> DataFrame:
    rows = with_ordinal(df, [F.col(group).asc_nulls_first(), *order], "__o")
    groups = rows.groupBy(F.col(group).alias("__g")).agg(F.min("__o").alias("__first"), F.count(F.lit(1)).alias("__n"))
    return rows.join(groups, F.col(group).eqNullSafe(F.col("__g"))).withColumn("place_in_group", F.col("__o") - F.col("__first") + 1).drop("__o", "__g", "__first")


def places(df: DataFrame, group: str, order: Sequence[Column | str]) -> DataFrame:
    """Every row with its ``place_in_group`` from 1 along a total order. Places come from one order
    of all rows, dealt by ranges, less where the group begins: a hot group is many ranges."""
    return _placed(df, group, order).drop("__n")


def fair_schedule(df: DataFrame, group: str, order: Sequence[str], chunk: int) -> DataFrame:
    """Every row with its ``position`` from 0: groups take turns with whole chunks, in the order of
    their names, while they have one; what is left follows group by group. Places in a group
    come from one total order, so a hot group is spread over tasks by its order."""
    if chunk <= 0:
        raise ValueError("chunk must be positive")
    placed = _placed(df, group, order)
    turn = F.floor((F.col("place_in_group") - 1) / chunk).cast("bigint")
    # NULL as turn marks the rest, which has no whole chunk; it comes last.
    placed = placed.withColumn("turn", F.when(turn < F.floor(F.col("__n") / chunk), turn)).withColumn("__rest", F.col("turn").isNull())
    return with_ordinal(placed, ["__rest", "turn", group, "place_in_group"], "position").drop("__n", "__rest")


def cycled_pick(df: DataFrame, group: str, strata: Sequence[str], order: Sequence[str], limits: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of each group by turns of its strata, up to the group's cap. ``limits`` has (least rows,
    cap), largest first; smaller groups are taken whole."""
    sizes = df.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    cap = F.coalesce(*[F.when(F.col("__n") >= least, most) for least, most in limits], F.col("__n"))
    known = df.join(sizes, F.col(group).eqNullSafe(F.col("__g"))).withColumn("__cap", cap)
    # No stratum can give more than the cap.
    inner = known.withColumn("turn", F.row_number().over(Window.partitionBy(group, *strata).orderBy(*order))).where(F.col("turn") <= F.col("__cap"))
    out = inner.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("turn", *strata)))
    return out.where(F.col("place") <= F.col("__cap")).drop("__g", "__n", "__cap")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def tail_strata(df: DataFrame, value: str, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """low, middle or high by nearest-rank quantiles of a column."""
    ends = nearest_rank(df.select(F.lit(0).alias("__all"), value), "__all", value, {"low": low, "high": high}).first()
    low_end, high_end = (ends["low"], ends["high"]) if ends else (None, None)
    return df.withColumn("stratum", F.when(F.col(value).isNull(), None).when(F.col(value) <= F.lit(low_end), "low").when(F.col(value) >= F.lit(high_end), "high").otherwise("middle"))


def average_rank(df: DataFrame, key: str, score: str) -> DataFrame:
    """Rank from the best score down, ties averaged, and utility 1 - (r - 1) / (n - 1). Rows
    without a score have no rank and are left out. Rows are counted per score, and the counts
    summed along the scores."""
    known = df.where(F.col(score).isNotNull())
    run = running_totals(known.select(F.struct(key).alias("__key"), F.col(score).alias("__score")), "__key", "__score", monotone(F.col("__score")), {"n": F.lit(1)})
    better = F.col("n_all") - F.col("n_through")
    ranks = run.select(F.col("__key")[key].alias("__k"), "__score", (better + (F.col("n") + 1) / 2).alias("average_rank"), "n_all")
    joined = known.join(ranks, F.col(key).eqNullSafe(F.col("__k")) & (F.col(score) == F.col("__score")))
    utility = F.when(F.col("n_all") == 1, 1.0).otherwise(1 - (F.col("average_rank") - 1) / (F.col("n_all") - 1))
    return joined.withColumn("utility", utility).drop("__k", "__score", "n_all")


def margin_to_next(df: DataFrame, keys: Sequence[str], score: str, ident: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return df.withColumn("rank", F.row_number().over(w)).withColumn("margin", F.col(score) - F.lead(score).over(w)).withColumn("tied", F.coalesce(F.col(score) == F.lag(score).over(w), F.lit(False)))


def weighted_quantile(df: DataFrame, key: str, value: str, weight: str, q: float) -> DataFrame:
    """The first value whose cumulative weight reaches ``q`` of all. Weights are summed per value,
    and those sums along the values."""
    known = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(F.struct(key).alias("__key"), F.col(value).alias("__value"), F.col(weight).alias("__weight"))
    run = running_totals(known, "__key", "__value", monotone(F.col("__value")), {"w": F.col("__weight")})
    return run.where(F.col("w_through") >= F.col("w_all") * q).groupBy("__key").agg(F.min("__value").alias("quantile")).select(F.col("__key")[key].alias(key), "quantile")


def rising(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """The rows whose value is not above the one before them in order."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("before", F.lag(value).over(w)).where(F.col(value) <= F.col("before"))
