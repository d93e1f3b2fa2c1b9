"""Scores and confidences of links, and vector arithmetic, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def link_score(in_metadata: Column, n_body: Column) -> Column:
    """0.6 for a mention in the metadata, and up to 0.7 more the more often the body mentions it; 1 at most."""
    n = F.coalesce(n_body, F.lit(0))
    return F.round(F.least(F.lit(1.0), F.when(in_metadata, 0.6).otherwise(0.0) + (1 - F.exp(-n / 1.5)) * 0.7), 3)


def confidence(in_metadata: Column, n_body: Column) -> Column:
    return F.when(in_metadata | (F.coalesce(n_body, F.lit(0)) >= 2), "strong").otherwise("weak")


def dot(a: Column, b: Column) -> Column:
    """Of two arrays, in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))
