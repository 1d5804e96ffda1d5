"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.arrays import bind

EPSILON = 1e-6  # fixed value: keeps the norm of a zero vector away from zero


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))


def l2_normalize(vec: Column) -> Column:
    """``v / sqrt(sum(v^2) + 1e-6)``."""
    size = F.sqrt(F.aggregate(doubles(vec), F.lit(0.0), lambda t, x: t + x * x) + EPSILON)
    return bind(size, lambda n: F.transform(doubles(vec), lambda x: x / n))


def unit(vec: Column) -> Column:
    """``v / |v|``."""
    return bind(norm(doubles(vec)), lambda n: F.transform(doubles(vec), lambda x: x / n))


def cosine(a: Column, b: Column) -> Column:
    return dot(doubles(a), doubles(b)) / (norm(doubles(a)) * norm(doubles(b)))


def pcos(a: Column, b: Column) -> Column:
    """Cosine moved to [0, 1]."""
    return (cosine(a, b) + 1) / 2
