"""Candidate selection: unions of reasons, quotas, reuse of cached work, greedy batches, review decisions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlark.functions.scalars import reasons


def reason_union(parts: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Candidates of several sources, once each, with the sorted reasons they are in for."""
    tagged = [df.select(*keys).distinct().withColumn("reason", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(F.sort_array(F.collect_set("reason")).alias("reasons"))


def reuse_plan(requests: DataFrame, cache: DataFrame, key: str, version: Column, cached_version: str) -> DataFrame:
    """What to do for each request: REUSE a current entry, REFRESH an outdated one, COMPUTE."""
    known = cache.select(F.col(key), F.col(cached_version).alias("__v"), F.lit(True).alias("__known"))
    joined = requests.join(known, key, "left")
    action = F.when(F.col("__known").isNull(), "COMPUTE").when(F.col("__v").eqNullSafe(version), "REUSE").otherwise("REFRESH")
    return joined.withColumn("action", action).drop("__v", "__known")


def quota_pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, per: str | None = None, most: int | None = None) -> DataFrame:
    """Up to ``n`` rows per key in order, of which at most ``most`` share a value of ``per``."""
    out = df
    if per and most is not None:
        inner = Window.partitionBy(*keys, per).orderBy(*order)
        out = out.withColumn("__in", F.row_number().over(inner)).where(F.col("__in") <= most).drop("__in")
    return out.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= n)


def greedy_batches(df: DataFrame, group: str, order: str, size: str, capacity: int) -> DataFrame:
    """Rows of a group in order, a new batch when the next would not fit. Sequential by
    nature: sorted partitions stream through a fold that holds one running sum, so many
    small groups share a task and a large one needs no memory. Ties in the order go by size."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, batch, used = object(), 0, 0
        for b in batches:
            out = []
            for g, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if g != now:
                    now, batch, used = g, 0, 0
                elif used and used + (s or 0) > capacity:
                    batch, used = batch + 1, 0
                used += s or 0
                out.append(batch)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int32())], [group, order, "batch"])

    rows = df.select(group, order, size).repartition(group).sortWithinPartitions(group, order, size)
    return rows.mapInArrow(fold, f"{group} {kinds[group]}, {order} {kinds[order]}, batch int")


def review_outcome(decisions: DataFrame, request: str, reviewer: str, decided_at: Sequence[str], decision: str) -> DataFrame:
    """The last decision of each reviewer, then one outcome per request: the decision all
    agree on, CONFLICT, or the single one."""
    last = decisions.groupBy(request, reviewer).agg(F.max_by(decision, F.struct(*decided_at)).alias("d"))
    per = last.groupBy(request).agg(F.count(F.lit(1)).alias("n_reviewers"), F.sort_array(F.collect_set("d")).alias("decisions"))
    return per.withColumn("outcome", F.when(F.size("decisions") > 1, "CONFLICT").otherwise(F.get("decisions", F.lit(0))))


def rescore_plan(scores: DataFrame, changed: DataFrame, item: str, target: str, candidates: str, margin: str, band: float) -> DataFrame:
    """Which scores must be made again after items changed, and why: the target changed, a
    candidate did, or the margin is so small that any change may turn it. Changed items are
    joined, not collected: candidates are unpivoted and met with them by key."""
    gone = changed.select(F.col(item).alias("c")).distinct()
    touched = scores.select(target, F.explode(candidates).alias("c")).join(gone, "c", "left_semi").select(target).distinct().withColumn("by_candidate", F.lit(True))
    direct = gone.select(F.col("c").alias(target), F.lit(True).alias("by_target"))
    out = scores.join(touched, target, "left").join(direct, target, "left")
    why = reasons({"TARGET_CHANGED": F.coalesce("by_target", F.lit(False)), "CANDIDATE_CHANGED": F.coalesce("by_candidate", F.lit(False)), "NARROW_MARGIN": F.coalesce(F.abs(margin) <= band, F.lit(False))})
    return out.withColumn("rescore_reasons", why).withColumn("rescore", F.size("rescore_reasons") > 0).drop("by_candidate", "by_target")
