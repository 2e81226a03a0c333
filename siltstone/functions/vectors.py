"""Vector expressions in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(as_column(a), as_column(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; NULL when a vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return F.lit(1.0) - cosine(a, b)


def normalise_embedding(c: Column | str) -> Column:
    """Floats, or NULL for the whole vector when one element is not a number."""
    values = F.transform(as_column(c), lambda x: x.try_cast("float"))
    return F.when(~F.exists(values, lambda x: x.isNull()), values)
