"""One-to-one matching by score, equal to a walk from the highest score down, at any size.

A pair is dominant when no better pair shares a side with it; a walk would take it
whatever comes before.  So all dominant pairs are taken at once and their sides go,
round by round: two grouped maxima and a join of what they agree on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard, stored

#: Pairs of a case that are walked inside its own row.
FEW_PAIRS = 128


def _walked(ranked: Column) -> Column:
    """The pairs that a walk over a sorted array takes."""
    empty = F.slice(ranked, 1, 0)
    free = lambda taken, p: ~F.exists(taken, lambda t: (t["i"] == p["i"]) | (t["j"] == p["j"]))
    return F.aggregate(ranked, empty, lambda taken, p: F.when(free(taken, p), F.array_append(taken, p)).otherwise(taken))


def greedy_pairs(scored: DataFrame, case: str, least: float, few: int = FEW_PAIRS) -> DataFrame:
    """Best one-to-one pairs of ``scored(case, i, j, score)``: highest score first, later indices first on ties, each side once.

    Scores under ``least``, NaN or null, and pairs without a case or an index are no
    pairs; repeated rows are one.  Cases of at most ``few`` pairs (counted) are walked
    in an array, the others by rounds, which are written to the shared folder.
    """
    spark = scored.sparkSession
    fit = F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")) & (F.col("score") >= least)
    kept = scored.select(case, "i", "j", "score").where(fit).dropna()
    # of one pair with several scores the best counts: the others share both sides with it
    kept = kept.groupBy(case, "i", "j").agg(F.max("score").alias("score"))
    sizes = kept.groupBy(case).agg(F.count("*").alias("_n"))
    large = sizes.where(F.col("_n") > few).select(case)
    own = kept.join(large, case, "left_anti").groupBy(case).agg(F.sort_array(F.collect_list(F.struct("score", "i", "j")), asc=False).alias("p"))
    walked = own.select(case, F.explode(_walked(F.col("p"))).alias("p")).select(case, "p.i", "p.j", "p.score")
    rest, path = stored(kept.join(large, case, "left_semi"), "pairs")
    taken = None
    while not rest.isEmpty():
        best = lambda side: rest.groupBy(case, side).agg(F.max(F.struct("score", "i", "j")).alias("p")).select(case, "p")  # noqa: E731, B023
        now, _ = stored(best("i").join(best("j"), [case, "p"]).select(case, "p.i", "p.j", "p.score"), "taken")
        taken = now if taken is None else taken.unionByName(now)
        left, left_path = stored(rest.join(now.select(case, "i"), [case, "i"], "left_anti").join(now.select(case, "j"), [case, "j"], "left_anti"), "pairs")
        discard(spark, path)
        rest, path = left, left_path
    return walked if taken is None else walked.unionByName(taken.select(walked.columns))
