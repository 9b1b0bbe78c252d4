"""Argmax, cosine and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dominant_index(weights: Column | str) -> Column:
    """0-based position of the largest weight; ties go to the lowest position.

    An all-zero or missing distribution gives 0.
    """
    c = F.col(weights) if isinstance(weights, str) else weights
    return F.coalesce(F.array_position(c, F.array_max(c)).cast("int") - 1, F.lit(0))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two numeric arrays; a zero vector has similarity 0."""

    def dot(x, y) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0).cast("double"), lambda s, v: s + v)

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0).cast("double"))


def sentiment_label(score: Column | str, positive: float = 0.6, negative: float = 0.4) -> Column:
    """Bucket a 0..1 score; both bounds are inclusive, no score is Neutral.

    NaN compares greater than any number in Spark, so it is treated as missing.
    """
    c = F.col(score) if isinstance(score, str) else score
    known = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return F.when(known >= positive, "Positive").when(known <= negative, "Negative").otherwise("Neutral")
