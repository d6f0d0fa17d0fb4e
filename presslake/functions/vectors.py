"""Distances between two arrays of numbers, summed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def inner_product(left: Column, right: Column) -> Column:
    return _sum(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")))


def norm(vector: Column) -> Column:
    return F.sqrt(_sum(F.transform(vector, lambda a: a.cast("double") * a.cast("double"))))


def cosine_similarity(left: Column, right: Column) -> Column:
    """NULL when either vector has no length."""
    return F.try_divide(inner_product(left, right), norm(left) * norm(right))


def l2_distance(left: Column, right: Column) -> Column:
    diff = F.zip_with(left, right, lambda a, b: a.cast("double") - b.cast("double"))
    return F.sqrt(_sum(F.transform(diff, lambda d: d * d)))


METRICS = {
    # name -> (function, larger is nearer)
    "cosine": (cosine_similarity, True),
    "ip": (inner_product, True),
    "l2": (l2_distance, False),
}
