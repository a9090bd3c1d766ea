"""References to keys that do not exist, at the time the reference arrived.

References are grouped by the null mask of their composite key; each group is compared
on its non-null columns under the declared match semantics:

- ``simple``: a key with any NULL is no reference and is never an orphan.
- ``full``: a key of NULLs only is no reference; one with some NULLs is an orphan.
- ``partial``: a key of NULLs only is no reference; otherwise the non-null columns must match.

Targets may carry a time and a deletion mark. A target counts for a reference when its
time is not after the reference's. With a deletion mark the newest such target decides
(ties: the largest ``tie`` value). A NULL time of a reference means "after all targets";
a target without a time counts as the earliest. NULL deletion marks mean not deleted.
Repeated references are judged row by row; repeated targets change nothing. Empty
targets make every reference an orphan; empty references give an empty result. The
result has the columns of ``refs`` only, so other columns of the targets cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlark.operators.hot_keys import carried, combined, find_hot, micros

LATEST = 2**62


def whole_number(c: Column) -> Column:
    """Ids that are written unevenly: trimmed, and digits without sign and leading zeros."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(r"\A\+?[0-9]+\z"), F.regexp_replace(t, r"\A\+?0*(?=[0-9])", "")).otherwise(t)


def url_key(c: Column) -> Column:
    """A URL with scheme and host in lower case and without its fragment."""
    u = F.regexp_replace(F.trim(c), r"(?s)#.*\z", "")
    head = F.regexp_extract(u, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
    return F.concat(F.lower(head), F.substring(u, F.length(head) + 1, F.length(u)))


def _key(columns: Sequence[str]) -> Column:
    """One text of several columns, prefixed by their lengths so that no two keys collide."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")) for c in columns]
    return F.concat(*parts)


def _orphans(refs: DataFrame, targets: DataFrame, timed: bool, marked: bool, reasons: bool) -> DataFrame:
    """Of refs(__key, __t, ...) those without a live target, by an anti-join of the references
    with what is live; with ``reasons`` also ``orphan_reason``."""
    if not timed and not marked:
        lost = refs.join(targets.select("__key").distinct(), "__key", "left_anti")
        return lost.withColumn("orphan_reason", F.lit("absent")) if reasons else lost
    if not marked:
        first = targets.groupBy("__key").agg(F.min("__t").alias("__first"))
        live = first.select(F.col("__key").alias("__live"), "__first")
        lost = refs.join(live, (F.col("__key") == F.col("__live")) & (F.col("__first") <= F.col("__t")), "left_anti")
        if not reasons:
            return lost
        return lost.join(first, "__key", "left").withColumn("orphan_reason", F.when(F.col("__first").isNull(), "absent").otherwise("late")).drop("__first")
    # The state of a key at each moment of reference: both sides in one ordered run per key,
    # where rows of one key and moment are one event. The references themselves then meet
    # only the moments at which their key is live.
    events = targets.select("__key", "__t", F.lit(0).alias("__kind"), "__tie", "__gone")
    asked = refs.select("__key", "__t", F.lit(1).alias("__kind"), F.lit(None).cast(targets.schema["__tie"].dataType).alias("__tie"), F.lit(None).cast("boolean").alias("__gone"))
    both = events.unionByName(asked)
    hot = find_hot(both, "__key", F.col("__t"))
    newest = F.max(F.when(F.col("__kind") == 0, F.struct("__tie", "__gone")))["__gone"].alias("__gone")
    moments = combined(both, "__key", "__t", F.col("__t"), [newest, F.max("__kind").alias("__kind")], hot)
    seen = carried(moments, "__key", "__t", "__gone", "__state", hot, include_current=True).where("__kind = 1")
    lost = refs.join(seen.where("not __state").select("__key", "__t"), ["__key", "__t"], "left_anti")
    if not reasons:
        return lost
    gone = seen.where("__state").select("__key", "__t", F.lit("deleted").alias("__why"))
    return lost.join(gone, ["__key", "__t"], "left").withColumn("orphan_reason", F.coalesce("__why", F.lit("absent"))).drop("__why")


def orphan_references(
    refs: DataFrame,
    ref_keys: Sequence[Column],
    targets: DataFrame,
    target_keys: Sequence[Column],
    *,
    semantics: str = "simple",
    ref_time: Column | None = None,
    target_time: Column | None = None,
    target_deleted: Column | None = None,
    target_tie: Column | None = None,
    reasons: bool = True,
) -> DataFrame:
    """The rows of ``refs`` without a matching live target, with ``orphan_reason``:
    ``absent``, ``deleted``, ``late`` (only where no deletion mark is given) or ``partial_key``.
    Without ``reasons`` the column is left out, which saves a join."""
    if semantics not in ("simple", "full", "partial"):
        raise ValueError(semantics)
    n = len(ref_keys)
    names = [f"__k{i}" for i in range(n)]
    cols = refs.columns
    left = refs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__r"), *[k.alias(x) for k, x in zip(ref_keys, names, strict=True)], (F.coalesce(micros(ref_time), F.lit(LATEST)) if ref_time is not None else F.lit(LATEST)).alias("__t"))
    right = targets.select(
        *[k.alias(x) for k, x in zip(target_keys, names, strict=True)],
        (F.coalesce(micros(target_time), F.lit(-LATEST)) if target_time is not None else F.lit(-LATEST)).alias("__t"),
        (F.coalesce(target_deleted, F.lit(False)) if target_deleted is not None else F.lit(False)).alias("__gone"),
        (target_tie if target_tie is not None else F.lit(0)).alias("__tie"),
    )
    mask = reduce(lambda a, b: a + b, [F.when(F.col(x).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(names)])
    left = left.withColumn("__mask", mask)
    out = []
    for m in range(1 << n):
        present = [x for i, x in enumerate(names) if not m >> i & 1]
        if not present or (m and semantics == "simple"):
            continue
        group = left.where(F.col("__mask") == m)
        if m and semantics == "full":
            out.append(group.select("__r", *[F.lit("partial_key").alias("orphan_reason")] * reasons))
            continue
        asked = group.select(_key(present).alias("__key"), "__t", "__r")
        there = right.where(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in present])).select(_key(present).alias("__key"), "__t", "__gone", "__tie")
        out.append(_orphans(asked, there, ref_time is not None and target_time is not None, target_deleted is not None, reasons).select("__r", *["orphan_reason"] * reasons))
    found = reduce(DataFrame.unionByName, out)
    return found.select(*[F.col(f"__r.`{c}`").alias(c) for c in cols if not reasons or c != "orphan_reason"], *["orphan_reason"] * reasons)
