"""Expressions on ``array<float>`` embeddings; sums run in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .text import col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column | str, eps: float = 1e-12) -> Column:
    """Divide by the Euclidean norm; a zero vector stays zero."""
    return let(
        lambda v, length: F.transform(v, lambda x: x.cast("double") / length),
        v=col(v),
        length=F.greatest(norm(v), F.lit(eps)),
    )


def squared_distance(a: Column | str, b: Column | str) -> Column:
    gaps = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x * x)


def valid_numeric(v: Column | str) -> Column:
    """No NaN and no infinity in the array."""
    bad = F.exists(col(v), lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return ~bad
