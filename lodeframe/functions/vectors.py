"""Vector functions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def preference_similarity(a: Column, b: Column, embedded: Column) -> Column:
    """Likeness of two preferences: equal plain texts or equal meanings 1, different meanings 0, a wish and a refusal 0, else what the embeddings say."""
    x, y = T.plain_preference(a), T.plain_preference(b)
    one, other = T.meant_preference(x), T.meant_preference(y)
    return (
        F.when(x == y, 1.0)
        .when(one.isNotNull() & other.isNotNull(), F.when(one == other, 1.0).otherwise(0.0))
        .when(T.refuses(x) != T.refuses(y), 0.0)
        .otherwise(embedded)
    )
