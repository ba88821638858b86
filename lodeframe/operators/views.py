"""Views of one corpus that share a core: each key stored once, with the views that hold it.

Membership is a bit a view, so a corpus of several overlapping views is one table, and
the sizes of all overlaps follow from one count by bit pattern.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_VIEWS = 63


def membership(rows: DataFrame, key: Sequence[str], views: Mapping[str, Column]) -> DataFrame:
    """``key, views``: one row for each key that any view holds, with the bits of these views.

    ``views`` are conditions on ``rows``; a null condition doesn't hold.  Repeated
    rows of a key add up; a null key is a key.
    """
    if not 0 < len(views) <= MOST_VIEWS:
        raise ValueError(f"between 1 and {MOST_VIEWS} views")
    bits = F.lit(0).cast("long")
    for k, holds in enumerate(views.values()):
        bits = bits.bitwiseOR(F.when(holds, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return rows.select(*key, bits.alias("views")).groupBy(*key).agg(F.bit_or("views").alias("views")).where("views <> 0")


def _bits(names: Sequence[str], wanted: Sequence[str]) -> int:
    if unknown := set(wanted) - set(names):
        raise ValueError(f"unknown views: {sorted(unknown)}")
    return sum(1 << k for k, name in enumerate(names) if name in wanted)


def of_view(members: DataFrame, names: Sequence[str], view: str) -> DataFrame:
    """The keys of one view."""
    return members.where(F.col("views").bitwiseAND(_bits(names, [view])) != 0).drop("views")


def core(members: DataFrame, names: Sequence[str], shared: Sequence[str] | None = None) -> DataFrame:
    """The keys that all of the views share."""
    bits = _bits(names, shared if shared is not None else names)
    return members.where(F.col("views").bitwiseAND(bits) == bits).drop("views")


def overlaps(members: DataFrame, names: Sequence[str]) -> DataFrame:
    """``a, b, keys``: how many keys each two views share, and with ``a = b`` how many a view holds; views in order, each two once."""
    patterns = members.groupBy("views").agg(F.count("*").alias("n"))
    held = F.filter(F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda k: F.when(F.getbit("views", k) == 1, k)), lambda k: k.isNotNull())
    pairs = F.flatten(F.transform("held", lambda a: F.transform(F.filter("held", lambda b: b >= a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    found = patterns.withColumn("held", held).select("n", F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.sum("n").alias("keys"))
    every = members.sparkSession.createDataFrame([(a, b, names[a], names[b]) for a in range(len(names)) for b in range(a, len(names))], "a int, b int, one string, other string")
    return every.join(found, ["a", "b"], "left").select(F.col("one").alias("a"), F.col("other").alias("b"), F.coalesce("keys", F.lit(0)).cast("long").alias("keys"))


def view_errors(sizes: DataFrame, least_core: int, expected: Mapping[str, int]) -> list[str]:
    """What is wrong with views of ``overlaps``: a size that isn't the expected one, two views that share less than the core."""
    rows = {(r.a, r.b): r["keys"] for r in sizes.collect()}  # a row for each two views
    wrong = [f"{name} holds {rows.get((name, name), 0)} keys, not {n}" for name, n in expected.items() if rows.get((name, name), 0) != n]
    return wrong + [f"{a} and {b} share {n} keys, fewer than {least_core}" for (a, b), n in sorted(rows.items()) if a != b and n < least_core]
