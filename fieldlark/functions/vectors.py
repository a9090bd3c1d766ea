"""Vectors held as arrays, by built-in higher-order functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine clipped to [-1, 1]; NULL where a vector has no length."""
    c = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.when(c.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))


def normalised(a: Column) -> Column:
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), norm(a)))


def top_k_mean(a: Column, k: int) -> Column:
    """Mean of the k largest values; NULL if there are fewer."""
    best = F.slice(F.sort_array(a, asc=False), 1, k)
    return F.when(F.size(a) >= k, F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / k)


def softmax(a: Column) -> Column:
    e = F.transform(a, lambda x: F.exp(x - F.array_max(a)))
    return F.transform(e, lambda x: F.try_divide(x, F.aggregate(e, F.lit(0.0), lambda s, y: s + y)))


def entropy(a: Column) -> Column:
    """Shannon entropy (nats) of scores brought to a sum of 1."""
    total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    share = F.transform(a, lambda x: F.try_divide(x, total))
    return -F.aggregate(share, F.lit(0.0), lambda s, p: s + F.when(p > 0, p * F.ln(p)).otherwise(0.0))


def margin(a: Column) -> Column:
    """Best less second best value; NULL for fewer than two."""
    s = F.sort_array(a, asc=False)
    return F.get(s, F.lit(0)) - F.get(s, F.lit(1))


def argmax(a: Column) -> Column:
    """Place of the largest value, from 0; ties go to the first."""
    return F.array_position(a, F.array_max(a)) - 1


def iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Overlap of two boxes (x1, y1, x2, y2): intersection over union."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    area = lambda q: (q[2] - q[0]) * (q[3] - q[1])
    return F.try_divide(w * h, area(a) + area(b) - w * h)
