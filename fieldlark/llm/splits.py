"""Splits that keep related records together.

Records and the entities they name (component, item, author) form a bipartite graph;
minimum labels propagated over it give each record its group. Groups are then assigned
to splits so that sizes and label shares meet the given proportions: groups with at least
1/``BIG`` of all rows (at most ``BIG`` of them, a proven bound) are placed one by one on
the driver, largest first; all others are dealt by a hash into shards of about
``SHARD`` rows, each of which fills its fair part of what is left of every split and
label, again largest first, in its own task.

Defined results
- Ids are compared trimmed and in lower case; NULL and blank ids relate nothing; authors
  relate only if they begin with ``observer-``.
- A record that relates to nothing is a group of its own. NULL labels are a label.
- NULL splits are no split of a group, but their rows belong to it.
- Rows with a NULL id are left out. Repeated ids are records of their own, which meet if
  they share an entity. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.operators.graph import grouped_sets
from fieldlark.session import cut

SHARES = {"support_train": 0.55, "model_selection": 0.15, "calibration": 0.15, "final_test": 0.15}
BIG = 2_000
SHARD = 200_000


def _id(c: str) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def entities() -> Column:
    """The entities that a record names, each under its kind."""
    author = _id("photographer_id")
    kinds = [("c", _id("leakage_component_id")), ("i", _id("source_item_id")), ("a", F.when(author.startswith("observer-"), author))]
    return F.array_compact(F.array(*[F.concat(F.lit(f"{k}:"), e) for k, e in kinds]))


def related_groups(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``rec, root, round`` of the records that name an entity: one (root, round), one group.
    ``rec`` is a struct of the id and the columns in ``keep``."""
    packed = rows.where(F.col("prediction_id").isNotNull()).withColumn("rec", F.struct("prediction_id", *keep))
    return grouped_sets(packed, "rec", entities())


def broken_groups(rows: DataFrame) -> DataFrame:
    """``prediction_id`` of all rows of the groups that have more than one split."""
    split = F.lower(F.nullif(F.trim("dataset_split"), F.lit("")))
    groups = cut(related_groups(rows.withColumn("__split", split), ["__split"]).select("rec.*", "root", "round"))
    bad = groups.groupBy("root", "round").agg(F.min("__split").alias("low"), F.max("__split").alias("high")).where(F.col("low") != F.col("high"))
    return groups.join(bad.select("root", "round"), ["root", "round"], "left_semi").select("prediction_id").distinct()


def _best(group: dict[int, int], lack: list[list[float]]) -> int:
    """The split whose labels lack most of what the group has; ties go to the first."""
    gains = [sum(n * row[j] for j, n in group.items()) for row in lack]
    return max(range(len(gains)), key=lambda k: (gains[k], -k))


def _fill(groups: list[dict[int, int]], lack: list[list[float]]) -> list[int]:
    """Places groups (rows by number of the label) in the given order; ``lack`` is what each split still needs of each label."""
    out = []
    for g in groups:
        k = _best(g, lack)
        for j, n in g.items():
            lack[k][j] -= n
        out.append(k)
    return out


def assign_splits(rows: DataFrame, label: str = "true_class_label", shares: dict[str, float] = SHARES) -> DataFrame:
    """``prediction_id, component, split``: one row per row of ``rows``, groups whole."""
    spark = rows.sparkSession
    names = list(shares)
    named = rows.withColumn("__label", F.coalesce(F.col(label).cast("string"), F.lit("<NULL>")))
    related = related_groups(named, ["__label"]).select("rec.*", F.concat_ws(":", F.lit("g"), "root", "round").alias("component"))
    alone = named.where(F.col("prediction_id").isNotNull() & (F.size(entities()) == 0)).select("prediction_id", "__label", F.concat(F.lit("s:"), F.col("prediction_id")).alias("component"))
    grouped = cut(related.unionByName(alone).select(F.col("prediction_id").alias("rec"), F.col("__label").alias("label"), "component"))
    # Labels by number, the most frequent first; a group holds only the labels it has.
    counts = grouped.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").collect()
    m, n_all = len(counts), sum(r["n"] for r in counts)
    number = spark.createDataFrame([(r["label"], j) for j, r in enumerate(counts)], "label string, j int")
    pairs = grouped.join(F.broadcast(number), "label").groupBy("component", "j").agg(F.count(F.lit(1)).alias("k"))
    sizes = cut(pairs.groupBy("component").agg(F.sum("k").alias("n"), F.array_sort(F.collect_list(F.struct("j", "k"))).alias("per_label")))
    lack = [[shares[s] * r["n"] for r in counts] for s in names]
    limit = max(1, -(-n_all // BIG))
    big = sizes.where(F.col("n") >= max(limit, 2)).orderBy(F.desc("n"), "component").limit(BIG).collect()
    placed = [(r["component"], names[k]) for r, k in zip(big, _fill([dict(map(tuple, r["per_label"])) for r in big], lack), strict=True)]
    chosen = spark.createDataFrame(placed, "component string, split string")
    small = sizes.join(F.broadcast(chosen.select("component")), "component", "left_anti")
    shards = max(1, round(n_all / SHARD))
    want = [[max(0.0, x) for x in row] for row in lack]
    per_label = [sum(want[k][j] for k in range(len(names))) or 1.0 for j in range(m)]

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "component"], ascending=[False, True])
        groups = [{int(x["j"]): int(x["k"]) for x in g} for g in pdf["per_label"]]
        have = [0] * m
        for g in groups:
            for j, n in g.items():
                have[j] += n
        mine = [[want[k][j] / per_label[j] * have[j] for j in range(m)] for k in range(len(names))]
        picked = _fill(groups, mine)
        return pd.DataFrame({"component": pdf["component"].to_numpy(), "split": [names[k] for k in picked]})

    dealt = small.withColumn("shard", F.pmod(F.xxhash64("component"), F.lit(shards))).groupBy("shard").applyInPandas(place, "component string, split string")
    return grouped.join(dealt.unionByName(chosen), "component").select(F.col("rec").alias("prediction_id"), "component", "label", "split")


def split_balance(assigned: DataFrame) -> DataFrame:
    """Rows per split and label."""
    return assigned.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_rows"))




def split_check(assigned: DataFrame, shares: dict[str, float] = SHARES) -> DataFrame:
    """One row: rows, components that lie in several splits, and whether every split has its share of
    the rows up to the largest component (a whole group can't be divided) and one row."""
    per = assigned.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("split").alias("low"), F.max("split").alias("high"))
    sums = [F.coalesce(F.sum(F.when(F.col("low") == s, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, s in enumerate(shares)]
    whole = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("low") != F.col("high")).alias("n_torn"), F.max("n").alias("largest"), *sums)
    met = [F.abs(F.col(f"n{i}") - F.col("n_rows") * p) <= F.col("largest") + 1 for i, p in enumerate(shares.values())]
    return whole.select("n_rows", "n_torn", reduce(lambda a, b: a & b, met).alias("shares_met"))
