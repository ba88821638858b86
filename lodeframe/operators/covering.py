"""Rows that try every pair of factor values in few combinations, and texts made from them.

For a prime q of at least as many values as any factor has, and at least one less
than there are factors, the q * q rows ``(a, b)`` with factor 0 = a, factor 1 = b and
factor j = a + (j - 1) * b modulo q hold every pair of values of every two factors:
two of these lines cross once.  A factor with fewer values takes the remainder by
their number, so its pairs are held too.  All combinations would be the product of
the factors' sizes; the rows are the square of the largest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .generation import small
from .ranking import distributed_rank


def prime_from(n: int) -> int:
    """The smallest prime of at least ``n``."""
    return next(k for k in count(max(2, n)) if all(k % d for d in range(2, int(k**0.5) + 1)))


def numbered(values: DataFrame, name: str) -> DataFrame:
    """``_k`` from 0 and the distinct values of a one-column table in order; null is no value."""
    own = values.select(F.col(values.columns[0]).alias(name)).where(F.col(name).isNotNull()).distinct()
    spread = own.withColumn("_first", F.left(F.col(name).cast("string"), F.lit(1)))
    ranked = distributed_rank(spread.withColumn("_text", F.col(name).cast("string")), [], [F.col("_text")], F.coalesce(F.ascii("_first"), F.lit(0)), "_k")
    return ranked.select((F.col("_k") - 1).alias("_k"), name)


def covering_rows(spark: SparkSession, factors: Mapping[str, DataFrame]) -> DataFrame:
    """``combination`` and a column a factor: rows in which every two values of different factors meet.

    ``factors`` are tables of one column, whose distinct values are used in the order
    of their texts.  A factor without a value is an error.
    """
    if not factors:
        raise ValueError("no factors")
    levels = {name: numbered(values, name) for name, values in factors.items()}
    sizes = {name: table.count() for name, table in levels.items()}
    if empty := [name for name, n in sizes.items() if not n]:
        raise ValueError(f"factors without values: {empty}")
    q = prime_from(max(*sizes.values(), len(factors) - 1)) if len(factors) > 1 else max(sizes.values())
    k = F.col("combination")
    a, b = (F.floor(k / q), k % q) if len(factors) > 1 else (k, F.lit(0))
    rows = spark.range(q * q if len(factors) > 1 else q).withColumnRenamed("id", "combination")
    for j, (name, table) in enumerate(levels.items()):
        line = a if j == 0 else b if j == 1 else (a + (j - 1) * b) % q
        # values are few beside the rows, and broadcast only when counted few
        side = small(table.withColumnRenamed("_k", f"_k{j}"))
        rows = rows.withColumn(f"_k{j}", (line % sizes[name]).cast("long")).join(side, f"_k{j}").drop(f"_k{j}")
    return rows.select("combination", *factors)


def pairs_covered(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``one, other, pairs``: distinct pairs of values that rows hold, for every two columns."""
    if len(names) < 2:
        return rows.sparkSession.createDataFrame([], "one string, other string, pairs long")
    listed = [F.struct(F.lit(a).alias("one"), F.lit(b).alias("other"), F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")) for i, a in enumerate(names) for b in names[i + 1 :]]
    return rows.select(F.explode(F.array(*listed)).alias("p")).select("p.*").distinct().groupBy("one", "other").agg(F.count("*").alias("pairs"))


def texts_of(rows: DataFrame, templates: Sequence[str], names: Sequence[str]) -> Column:
    """A text for each row: one of the templates in turn by its combination, ``{name}`` replaced by the factor's value."""
    if not templates:
        raise ValueError("no templates")
    chosen = F.element_at(F.array(*map(F.lit, templates)), (F.col("combination") % len(templates) + 1).cast("int"))
    for name in names:
        chosen = F.replace(chosen, F.lit(f"{{{name}}}"), rows[name].cast("string"))
    return chosen
