"""Weighted evaluation measures as aggregates.

Curves and threshold grids are read from score histograms or from per-score totals that
combine on the map side; what is ordered is bands of scores, never the rows of a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlark.functions.scalars import ratio, wilson
from fieldlark.session import cut


def confusion(df: DataFrame, keys: Sequence[str], truth: Column, positive: Column, weight: Column) -> DataFrame:
    """Weights of the four cells and the rates from them; rates without a base are NULL."""

    def cell(t: Column, p: Column) -> Column:
        return F.coalesce(F.sum(F.when(t & p, weight)), F.lit(0.0))

    cells = df.groupBy(*keys).agg(
        cell(truth, positive).alias("tp"), cell(~truth, positive).alias("fp"), cell(truth, ~positive).alias("fn"), cell(~truth, ~positive).alias("tn"),
        ratio(F.sum(weight) * F.sum(weight), F.sum(weight * weight)).alias("effective_n"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return (
        cells.withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f1", ratio(2 * tp, 2 * tp + fp + fn))
        .withColumn("specificity", ratio(tn, tn + fp))
        .withColumn("false_positive_rate", ratio(fp, fp + tn))
        .withColumn("false_negative_rate", ratio(fn, fn + tp))
    )


def proper_scores(df: DataFrame, keys: Sequence[str], truth: Column, p: Column, weight: Column, eps: float = 1e-15) -> DataFrame:
    """Weighted Brier score and log loss."""
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    y = truth.cast("double")
    return df.groupBy(*keys).agg(
        ratio(F.sum(weight * (p - y) * (p - y)), F.sum(weight)).alias("brier"),
        ratio(F.sum(-weight * F.when(truth, F.ln(q)).otherwise(F.ln(1 - q))), F.sum(weight)).alias("log_loss"),
    )


def reliability(df: DataFrame, keys: Sequence[str], truth: Column, p: Column, weight: Column, bins: int = 10) -> DataFrame:
    """Equal-width bins with mean score, observed share and weight."""
    at = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")
    return df.where(p.isNotNull()).groupBy(*keys, at.alias("bin")).agg(
        F.sum(weight).alias("weight"), ratio(F.sum(weight * p), F.sum(weight)).alias("mean_score"), ratio(F.sum(weight * truth.cast("double")), F.sum(weight)).alias("observed")
    )


def calibration_error(df: DataFrame, keys: Sequence[str], truth: Column, p: Column, weight: Column, bins: int = 10) -> DataFrame:
    binned = reliability(df, keys, truth, p, weight, bins)
    return binned.groupBy(*keys).agg(ratio(F.sum(F.col("weight") * F.abs(F.col("mean_score") - F.col("observed"))), F.sum("weight")).alias("ece"))


def roc_auc(df: DataFrame, keys: Sequence[str], truth: Column, p: Column, weight: Column, bands: int = 1024) -> DataFrame:
    """Weighted area under the ROC curve, exact with ties; NULL if a class is missing.

    Totals per score come first; the running sum is taken inside bands of scores and across
    the at most ``bands`` band totals of a key, so no task orders all scores of a key."""
    per = df.where(p.isNotNull()).groupBy(*keys, p.alias("s")).agg(F.sum(F.when(truth, weight).otherwise(0.0)).alias("pos"), F.sum(F.when(truth, 0.0).otherwise(weight)).alias("neg"))
    per = per.withColumn("band", F.least(F.floor(F.col("s") * bands), F.lit(bands - 1)))
    inside = Window.partitionBy(*keys, "band").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = per.withColumn("neg_in_band", F.coalesce(F.sum("neg").over(inside), F.lit(0.0)))
    sums = below.groupBy(*keys, "band").agg(
        F.sum(F.col("pos") * (F.col("neg_in_band") + F.col("neg") / 2)).alias("area"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    across = Window.partitionBy(*keys).orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("neg_before", F.coalesce(F.sum("neg").over(across), F.lit(0.0)))
    return sums.groupBy(*keys).agg(ratio(F.sum(F.col("area") + F.col("pos") * F.col("neg_before")), F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def pr_auc(df: DataFrame, keys: Sequence[str], truth: Column, p: Column, weight: Column, bands: int = 1024) -> DataFrame:
    """Weighted average precision (no interpolation), exact with ties; NULL if a class is missing.
    Summed from the top as in ``roc_auc``: inside bands of scores, then across band totals."""
    per = df.where(p.isNotNull()).groupBy(*keys, p.alias("s")).agg(F.sum(F.when(truth, weight).otherwise(0.0)).alias("pos"), F.sum(F.when(truth, 0.0).otherwise(weight)).alias("neg"))
    per = per.withColumn("band", F.least(F.floor(F.col("s") * bands), F.lit(bands - 1)))
    across = Window.partitionBy(*keys).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    sums = per.groupBy(*keys, "band").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    above = sums.select(*[F.col(k).alias(f"{k}_of") for k in [*keys, "band"]], *[F.coalesce(F.sum(x).over(across), F.lit(0.0)).alias(f"{x}_above") for x in ("pos", "neg")])
    inside = Window.partitionBy(*keys, "band").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    per = per.select(*keys, "band", "pos", "neg", F.sum("pos").over(inside).alias("tp"), F.sum("neg").over(inside).alias("fp"))
    at = [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in [*keys, "band"]]
    cum = per.join(above, at).select(*keys, "pos", "neg", (F.col("tp") + F.col("pos_above")).alias("tp"), (F.col("fp") + F.col("neg_above")).alias("fp"))
    area = F.sum(F.coalesce(ratio(F.col("pos") * F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)))
    return cum.groupBy(*keys).agg(F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), area / F.sum("pos")).alias("pr_auc"))


def threshold_grid(df: DataFrame, keys: Sequence[str], truth: Column, p: Column, weight: Column, steps: int = 100) -> DataFrame:
    """Precision, recall and kept share at each cut-off k / ``steps``: rows are counted per
    band once and summed from the top over at most ``steps + 1`` bands."""
    bands = df.where(p.isNotNull()).groupBy(*keys, F.floor(p * steps).cast("int").alias("band")).agg(F.sum(weight).alias("w"), F.sum(F.when(truth, weight).otherwise(0.0)).alias("pos"))
    w = Window.partitionBy(*keys)
    down = w.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    cum = bands.withColumns({"kept": F.sum("w").over(down), "hits": F.sum("pos").over(down), "all_w": F.sum("w").over(w), "all_pos": F.sum("pos").over(w)})
    return cum.select(
        *keys, (F.col("band") / steps).alias("threshold"), ratio(F.col("hits"), F.col("kept")).alias("precision"), ratio(F.col("hits"), F.col("all_pos")).alias("recall"), ratio(F.col("kept"), F.col("all_w")).alias("kept_share")
    )


def best_threshold(grid: DataFrame, keys: Sequence[str], least_precision: float) -> DataFrame:
    """The cut-off of highest recall whose precision is high enough; ties go to the highest cut-off."""
    ok = grid.where(F.col("precision") >= least_precision)
    best = F.max(F.struct("recall", "threshold", "precision"))
    return ok.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.threshold", "b.precision", "b.recall")


def multiclass_brier(df: DataFrame, keys: Sequence[str], scores: str, truth_at: Column, weight: Column) -> DataFrame:
    """Weighted mean of the squared distance of the scores from the one-hot truth."""
    d = F.aggregate(F.transform(F.col(scores), lambda x, i: F.pow(x - (i == truth_at).cast("double"), F.lit(2))), F.lit(0.0), lambda s, x: s + x)
    return df.where(truth_at.isNotNull()).groupBy(*keys).agg(ratio(F.sum(weight * d), F.sum(weight)).alias("multiclass_brier"))


def macro_calibration_error(df: DataFrame, keys: Sequence[str], scores: str, truth_at: Column, weight: str, bins: int = 10) -> DataFrame:
    """Mean over classes of each class's calibration error."""
    flat = df.where(truth_at.isNotNull()).select(*keys, F.col(weight).alias("w"), truth_at.alias("t"), F.posexplode(scores).alias("class", "p"))
    per = calibration_error(flat, [*keys, "class"], F.col("t") == F.col("class"), F.col("p"), F.col("w"), bins)
    return per.groupBy(*keys).agg(F.avg("ece").alias("macro_ece"))


def weighted_proportions(df: DataFrame, keys: Sequence[str], hit: Column, weight: Column, z: float = 1.959963984540054) -> DataFrame:
    """Weighted share of hits with Wilson's interval on Kish's effective number of trials. Rows
    without a weight, or with one that is not positive, take no part."""
    w = F.when(weight > 0, weight.cast("double"))
    sums = df.groupBy(*keys).agg(F.count(w).alias("n"), F.sum(w).alias("weight"), F.sum(F.when(hit, w).otherwise(w * 0)).alias("hit_weight"), ratio(F.sum(w) * F.sum(w), F.sum(w * w)).alias("effective_n"))
    share = ratio(F.col("hit_weight"), F.col("weight"))
    low, high = wilson(share * F.col("effective_n"), F.col("effective_n"), z)
    return sums.withColumns({"share": share, "low": low, "high": high})


def proportions(df: DataFrame, keys: Sequence[str], hit: Column) -> DataFrame:
    """Hits, trials and Wilson's interval."""
    counts = df.groupBy(*keys).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("n"))
    low, high = wilson(F.col("hits"), F.col("n"))
    return counts.withColumn("low", low).withColumn("high", high)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The continued fraction of the incomplete beta function (Lentz), for many values at once."""
    tiny = 1e-300
    apart = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(x), 1 / apart(1 - (a + b) * x / (a + 1))
    out = d.copy()
    for m in range(1, 100_000):
        up = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d, c = 1 / apart(1 + up * d), apart(1 + up / c)
        out = out * d * c
        down = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d, c = 1 / apart(1 + down * d), apart(1 + down / c)
        out = out * d * c
        if (np.abs(d * c - 1) < 1e-14).all():
            return out
    raise ArithmeticError("the incomplete beta function did not converge")


@F.pandas_udf(T.DoubleType())
def exact_low(hits: pd.Series, n: pd.Series) -> pd.Series:
    """Exact one-sided 95 % lower bound of a proportion (Clopper and Pearson): the binomial tail is an
    incomplete beta function, bisected for a whole batch at once, at a cost that grows with sqrt(n)."""
    k, m = hits.to_numpy("float64"), n.to_numpy("float64")
    out = np.where(m > 0, 0.0, np.nan)
    with np.errstate(all="ignore"):
        out = np.where((m > 0) & (k == m), 0.05 ** (1 / m), out)
    at = np.flatnonzero((k > 0) & (k < m))
    if len(at):
        a, b = k[at], m[at] - k[at] + 1
        front = np.array([math.lgamma(x + y) - math.lgamma(x) - math.lgamma(y) for x, y in zip(a, b, strict=True)])
        low, high = np.zeros(len(at)), a / m[at]
        for _ in range(60):
            x = (low + high) / 2
            left = x < (a + 1) / (a + b + 2)
            power = np.exp(front + a * np.log(x) + b * np.log1p(-x))
            part = power * _beta_fraction(np.where(left, a, b), np.where(left, b, a), np.where(left, x, 1 - x)) / np.where(left, a, b)
            under = np.where(left, part, 1 - part) < 0.05
            low, high = np.where(under, x, low), np.where(under, high, x)
        out[at] = (low + high) / 2
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def audited_thresholds(df: DataFrame, truth: Column, p: Column, weight: Column, component: Column, least_bound: float, least_items: int = 30, least_components: int = 30, bands: int = 1024) -> DataFrame:
    """Every distinct score as a cut-off, with weighted precision, Kish's n, Wilson's one-sided
    95 % bound on it, the exact bound over components, and the gates. A component is a trial
    where one of its rows is selected, and a hit where all its selected rows are.

    A component enters at its highest score and fails at the highest score of a miss, so it
    adds to two scores at most. Totals per score are summed from the top inside bands of
    scores and across the at most ``bands`` band totals. ``selected`` marks the accepted
    cut-off of most weight; ties go to the higher bound, then to the lower cut-off."""
    rows = df.select(p.alias("s"), truth.alias("t"), weight.cast("double").alias("w"), component.alias("c")).where("s is not null and t is not null and w is not null")
    tops = rows.groupBy("c").agg(F.max("s").alias("top"), F.max(F.when(~F.col("t"), F.col("s"))).alias("miss"))
    failing = F.col("miss") < F.col("top")
    enters = F.struct(F.col("top").alias("s"), F.lit(1).alias("trials"), F.when(F.col("miss").isNull() | failing, 1).otherwise(0).alias("successes"))
    fails = F.struct(F.when(failing, F.col("miss")).alias("s"), F.lit(0).alias("trials"), F.lit(-1).alias("successes"))
    steps = tops.select(F.inline(F.array(enters, fails))).where("s is not null")
    hit = F.col("t").cast("int")
    single = rows.select("s", F.lit(1).alias("n"), hit.alias("hits"), "w", (F.col("w") * hit).alias("hit_w"), (F.col("w") * F.col("w")).alias("ww"))
    sums = ["n", "hits", "w", "hit_w", "ww", "trials", "successes"]
    both = single.unionByName(steps, allowMissingColumns=True)
    per = both.groupBy("s").agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in sums])
    per = per.withColumn("band", F.greatest(F.least(F.floor(F.col("s") * bands), F.lit(bands - 1)), F.lit(0)))
    across, all_bands = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    above = per.groupBy("band").agg(*[F.sum(x).alias(x) for x in sums]).select("band", *[F.coalesce(F.sum(x).over(across), F.lit(0)).alias(f"{x}_above") for x in sums], F.sum("w").over(all_bands).alias("all_w"))
    inside = Window.partitionBy("band").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    cum = per.select("s", "band", *[F.sum(x).over(inside).alias(x) for x in sums]).join(F.broadcast(above), "band")
    cum = cum.select(F.col("s").alias("threshold"), "all_w", *[(F.col(x) + F.col(f"{x}_above")).alias(x) for x in sums])
    cum = cum.withColumn("precision", F.least(ratio(F.col("hit_w"), F.col("w")), F.lit(1.0))).withColumn("effective_n", ratio(F.col("w") * F.col("w"), F.col("ww")))
    weighted = wilson(F.col("precision") * F.col("effective_n"), F.col("effective_n"), 1.6448536269514722)[0]
    cum = cum.withColumns({"weighted_low": F.round(weighted, 9), "component_low": F.round(exact_low(F.col("successes").cast("double"), F.col("trials").cast("double")), 9), "coverage": ratio(F.col("w"), F.col("all_w"))})
    low = F.when(F.col("weighted_low").isNotNull() & F.col("component_low").isNotNull(), F.least("weighted_low", "component_low"))
    cum = cum.withColumn("low", low).withColumn("accepted", F.coalesce((F.col("n") >= least_items) & (F.col("trials") >= least_components) & (F.col("low") >= least_bound), F.lit(False)))
    cum = cut(cum)
    best = cum.where("accepted").agg(F.max_by("threshold", F.struct("coverage", "low", -F.col("threshold"))).alias("best"))
    return cum.crossJoin(F.broadcast(best)).select(
        "threshold", "hits", "n", F.round("w", 6).alias("weight"), F.round("precision", 9).alias("precision"), F.round("effective_n", 4).alias("effective_n"), "weighted_low", F.col("successes").alias("component_hits"),
        F.col("trials").alias("components"), "component_low", "low", F.round("coverage", 9).alias("coverage"), "accepted", F.coalesce(F.col("threshold") == F.col("best"), F.lit(False)).alias("selected"),
    )


def bootstrap_interval(df: DataFrame, cluster: str, hit: Column, replicates: int = 200, seed: int = 7) -> DataFrame:
    """Percentile interval of a share by resampling clusters: each cluster enters a replicate
    with a Poisson(1) count drawn from a digest of seed, replicate and cluster, so that the
    result is the same wherever it runs. Clusters are totals before they are repeated."""
    per = df.groupBy(cluster).agg(F.count_if(hit).alias("h"), F.count(F.lit(1)).alias("n"))
    drawn = per.select(cluster, "h", "n", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    u = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), "r", F.col(cluster).cast("string")), 256), 1, 8), 16, 10).cast("double") / 4294967296.0
    steps = np.cumsum([1 / np.e / np.prod(range(1, k + 1)) for k in range(8)])
    count = sum([F.when(u >= float(s), 1).otherwise(0) for s in steps[:-1]], F.lit(0))
    shares = drawn.withColumn("k", count).groupBy("r").agg(ratio(F.sum(F.col("k") * F.col("h")), F.sum(F.col("k") * F.col("n"))).alias("share"))
    return shares.agg(F.expr("percentile(share, 0.025)").alias("low"), F.avg("share").alias("mean"), F.expr("percentile(share, 0.975)").alias("high"))


def crossing_tokens(df: DataFrame, token: Column, part: Column) -> DataFrame:
    """Tokens that occur in more than one part, with the parts."""
    seen = df.select(token.alias("token"), part.alias("part")).where(F.col("token").isNotNull() & F.col("part").isNotNull()).groupBy("token").agg(F.sort_array(F.collect_set("part")).alias("parts"), F.count(F.lit(1)).alias("n_rows"))
    return seen.where(F.size("parts") > 1)


def isotonic(points: pd.DataFrame) -> np.ndarray:
    """Rising step values by pooling neighbours that violate the order: weighted means per block."""
    blocks: list[list[float]] = []
    for y, w in zip(points["y"], points["w"], strict=True):
        blocks.append([y, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            y2, w2, n2 = blocks.pop()
            y1, w1, n1 = blocks.pop()
            blocks.append([(y1 * w1 + y2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def isotonic_calibration(df: DataFrame, truth: Column, p: Column, weight: Column, bands: int = 1000) -> DataFrame:
    """``score, weight, calibrated`` of every distinct score: the exact isotonic map. Violators are
    pooled inside ``bands`` ranges of scores, each in a task of its own, and what is left of
    the blocks in one task; pooling in two steps gives the same map as pooling in one."""
    per = df.where(p.isNotNull()).groupBy(p.cast("double").alias("score")).agg(F.sum(weight).alias("w"), ratio(F.sum(weight * truth.cast("double")), F.sum(weight)).alias("y"))
    banded = per.where("w > 0").withColumn("band", F.floor(F.col("score") * bands))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("score")
        pooled = isotonic(pdf)
        return pdf.assign(block=np.concatenate([[0], np.cumsum(np.diff(pooled) != 0)]).astype("int64"))

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["band", "block"])
        return pdf[["band", "block"]].assign(calibrated=isotonic(pdf))

    blocked = cut(banded.groupBy("band").applyInPandas(inside, "score double, w double, y double, band bigint, block bigint"))
    blocks = blocked.groupBy("band", "block").agg(ratio(F.sum(F.col("w") * F.col("y")), F.sum("w")).alias("y"), F.sum("w").alias("w"))
    mapped = blocks.groupBy(F.lit(0).alias("all")).applyInPandas(across, "band bigint, block bigint, calibrated double")
    return blocked.join(mapped, ["band", "block"]).select("score", F.col("w").alias("weight"), "calibrated")


def logit_scaling(df: DataFrame, truth: Column, z: Column, weight: Column, most_steps: int = 50) -> tuple[float, float, float]:
    """Slope and offset of Platt scaling, and the slope of temperature scaling, by Newton's steps
    over the totals per distinct logit; seven sums a step reach the driver."""
    data = cut(df.groupBy(z.alias("z")).agg(F.sum(weight).alias("w"), F.sum(F.when(truth, weight).otherwise(0.0)).alias("h")).where("z is not null and w is not null"))
    a, b, t = 1.0, 0.0, 1.0
    still = [True, True]
    z, w, h = F.col("z"), F.col("w"), F.col("h")
    p, q = F.col("p"), F.col("q")
    for _ in range(most_steps):
        chance = lambda x: 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), x))))
        row = data.withColumns({"p": chance(z * a + b), "q": chance(z * t)}).agg(
            F.sum((w * p - h) * z), F.sum(w * p - h), F.sum(w * p * (1 - p) * z * z), F.sum(w * p * (1 - p) * z), F.sum(w * p * (1 - p)), F.sum((w * q - h) * z), F.sum(w * q * (1 - q) * z * z)
        ).first()
        g0, g1, h00, h01, h11, g, hh = (x or 0.0 for x in row)
        det = h00 * h11 - h01 * h01
        still = [still[0] and det > 1e-12, still[1] and hh > 1e-12]
        if still[0]:
            da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
            a, b = a - da, b - db
            still[0] = abs(da) + abs(db) > 1e-12
        if still[1]:
            t -= g / hh
            still[1] = abs(g / hh) > 1e-12
        if not any(still):
            break
    return a, b, t
