"""Ranks and selections whose large groups spread over tasks."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distributed_rank(df: DataFrame, groups: Sequence[str], order: Sequence[Column], bucket: Column, name: str = "rank") -> DataFrame:
    """The row number from 1 within ``groups`` by ``order``.

    ``bucket`` must not fall as the order rises. Rows are numbered inside
    (group, bucket) and the buckets' counts, a small table, give the offsets, so
    a group with a third of all rows is numbered by many tasks.
    """
    marked = df.withColumn("_bucket", bucket)
    counts = marked.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    numbered = marked.withColumn("_row", F.row_number().over(inner)).alias("a")
    keys = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in (*groups, "_bucket")]
    joined = numbered.join(offsets.alias("b"), keys)
    return joined.select("a.*", (F.col("b._offset") + F.col("a._row")).cast("long").alias(name)).drop("_bucket", "_row")


def hash_order(seed: str, *keys: str) -> Column:
    """A reproducible order: SHA-256 of seed and keys."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") for k in keys]), 256)


def hashed_rank(df: DataFrame, groups: Sequence[str], seed: str, key: str, name: str = "rank", digits: int = 2) -> DataFrame:
    """Ranks by ``hash_order``; the hash's first hex digits are the buckets."""
    marked = df.withColumn("_hash", hash_order(seed, *groups, key))
    return distributed_rank(marked, groups, [F.col("_hash"), F.col(key)], F.left("_hash", F.lit(digits)), name).drop("_hash")


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each key; an aggregate, so repeated keys shrink before the shuffle."""
    others = [c for c in df.columns if c not in keys and c != order]
    first = F.min(F.struct(F.col(order), *others)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(df.columns)


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark keeps k rows a task before the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(w)).where(F.col("_row") <= k).drop("_row")


#: Groups whose sizes may become literals of a plan.
FEW_GROUPS = 1000


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Join conditions on equal keys; a null key is a key like any other."""
    return [left[k].eqNullSafe(right[k]) for k in keys]


def interleave(df: DataFrame, group: str, order: str, width: int = 4096, few_groups: int = FEW_GROUPS) -> DataFrame:
    """Round robin over groups, first-seen groups first: adds ``position`` from 1.

    ``order`` is a whole number; rows are numbered in buckets of ``width`` of it.  A
    null group is a group.  A row's position follows from its round and the groups'
    sizes alone: earlier rounds took ``min(size, round - 1)`` of each group.  Up to
    ``few_groups`` groups (counted) that is arithmetic on literals; beyond, rows are
    ranked inside their round by their group's first sight.
    """
    groups = df.groupBy(group).agg(F.min(order).alias("_seen"), F.count("*").alias("_size"))
    few = groups.orderBy("_seen").limit(few_groups + 1).collect()
    rounds = distributed_rank(df, [group], [F.col(order)], F.floor(F.col(order) / width), "round")
    if len(few) <= few_groups:
        sizes = F.array(*[F.lit(r["_size"]) for r in few]) if few else F.array().cast("array<bigint>")
        types = dict(df.dtypes)
        ranks = df.sparkSession.createDataFrame([(r[0], k) for k, r in enumerate(few)], f"`{group}` {types[group]}, _rank int")
        placed = rounds.join(F.broadcast(ranks), same(rounds, ranks, [group]))  # as many rows as were collected
        before = F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, n: acc + F.least(n, F.col("round") - 1))
        beside = F.size(F.filter(F.slice(sizes, F.lit(1), F.col("_rank")), lambda n: n >= F.col("round")))
        return placed.select(*[rounds[c] for c in df.columns], (before + beside + 1).cast("long").alias("position"))
    seen = groups.select(group, "_seen")
    marked = rounds.join(seen, same(rounds, seen, [group])).select(*[rounds[c] for c in df.columns], "round", "_seen")
    inside = distributed_rank(marked, ["round"], [F.col("_seen")], F.floor(F.col("_seen") / width), "_at")
    placed = inside.join(_rounds_before(rounds, width), "round")
    return placed.select(*[F.col(c) for c in df.columns], (F.col("_offset") + F.col("_at")).cast("long").alias("position"))


def _rounds_before(rounds: DataFrame, width: int) -> DataFrame:
    """How many rows earlier rounds have: sums inside stretches of ``width`` rounds, and of the stretches before, one row each."""
    counts = rounds.groupBy("round").agg(F.count("*").alias("_n")).withColumn("_far", F.floor(F.col("round") / width))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    near = F.coalesce(F.sum("_n").over(earlier(Window.partitionBy("_far").orderBy("round"))), F.lit(0))
    stretches = counts.groupBy("_far").agg(F.sum("_n").alias("_all"))
    stretches = stretches.select("_far", F.coalesce(F.sum("_all").over(earlier(Window.orderBy("_far"))), F.lit(0)).alias("_stretch"))
    return counts.withColumn("_near", near).join(stretches, "_far").select("round", (F.col("_near") + F.col("_stretch")).alias("_offset"))


def balanced_sample(df: DataFrame, group: str, key: str, most: int, seed: str) -> DataFrame:
    """Up to ``most`` rows, cycling over sorted groups, each in hash order; ``most`` must reach every group."""
    ranked = hashed_rank(df, [group], seed, key, "turn")
    return ranked.orderBy("turn", group).limit(most)


def evenly_spaced(df: DataFrame, order: Sequence[Column], bucket: Column, count: int) -> DataFrame:
    """``count`` rows at even distances of the order, the middle one for a single row; ``bucket`` as in ``distributed_rank``."""
    n = df.count()
    places = [n // 2] if count == 1 else sorted({round(k * (n - 1) / (count - 1)) for k in range(count)})
    return distributed_rank(df, [], order, bucket, "_place").where((F.col("_place") - 1).isin(places)).drop("_place")


def split_quotas(sizes: dict[tuple, int], fraction: float) -> dict[tuple, int]:
    """Validation rows of each stratum.

    Floors with at least one and at most all but one; then moved one at a time
    towards the rounded share of all, at the stratum furthest from its own share.
    Strata of one row stay in training.
    """
    quotas = {k: min(n - 1, max(1, int(n * fraction))) if n > 1 else 0 for k, n in sizes.items()}
    wanted = max(sum(n > 1 for n in sizes.values()), round(sum(sizes.values()) * fraction))
    wanted = min(wanted, sum(n - 1 for n in sizes.values()))
    missing = wanted - sum(quotas.values())
    step = 1 if missing > 0 else -1
    room = lambda k: quotas[k] < sizes[k] - 1 if step > 0 else quotas[k] > 1
    # furthest from its share first, ties go to the smallest stratum, null before all names
    name = lambda k: tuple((x is not None, x if x is not None else 0) for x in k)
    place = lambda k: (step * (quotas[k] - sizes[k] * fraction), name(k), k)
    heap = [place(k) for k in sizes if room(k)]
    heapq.heapify(heap)
    for _ in range(abs(missing)):
        *_, chosen = heapq.heappop(heap)
        quotas[chosen] += step
        if room(chosen):
            heapq.heappush(heap, place(chosen))
    return quotas


#: Strata that a split may have: their sizes, not their rows, are read by the driver.
MOST_STRATA, MOST_BROADCAST = 1_000_000, 100_000


def stratified_split(df: DataFrame, strata: Sequence[str], key: str, fraction: float, seed: str, adjust: bool = True) -> DataFrame:
    """Adds ``split`` (train or validation); quotas are computed from the strata's sizes alone.

    Null is a stratum like any other.  A stratum is a category: more than
    ``MOST_STRATA`` of them raise ``ValueError`` before anything is sent.
    """
    if not 0 < fraction < 1:
        raise ValueError("the fraction lies between 0 and 1")
    counted = df.groupBy(*strata).count().limit(MOST_STRATA + 1).collect()
    if len(counted) > MOST_STRATA:
        raise ValueError(f"more than {MOST_STRATA} strata")
    sizes = {tuple(r[:-1]): r[-1] for r in counted}
    if adjust:
        quotas = split_quotas(sizes, fraction)
    else:
        quotas = {k: min(n - 1, max(1, int(n * fraction))) if n > 1 else 0 for k, n in sizes.items()}
    spark = df.sparkSession
    types = dict(df.dtypes)
    ddl = ", ".join(f"{s} {types[s]}" for s in strata) + ", _quota int"
    table = spark.createDataFrame([(*k, q) for k, q in quotas.items()], ddl)
    table = F.broadcast(table) if len(quotas) <= MOST_BROADCAST else table
    ranked = hashed_rank(df, strata, seed, key)
    joined = ranked.join(table, same(ranked, table, strata)).select(*[ranked[c] for c in df.columns], "rank", "_quota")
    return joined.withColumn("split", F.when(F.col("rank") <= F.col("_quota"), "validation").otherwise("train")).drop("rank", "_quota")


def simple_split(df: DataFrame, group: str, key: str, fraction: float, seed: str, least: int = 0) -> DataFrame:
    """``round(n * fraction)`` rows of each group, halves to even, at least ``least``."""
    counts = df.groupBy(group).agg(F.greatest(F.bround(F.count("*") * F.lit(float(fraction))), F.lit(least)).alias("_take"))
    ranked = hashed_rank(df, [group], seed, key)
    joined = ranked.join(counts, same(ranked, counts, [group]))
    split = F.when(F.col("rank") <= F.col("_take"), "validation").otherwise("train")
    return joined.select(*[ranked[c] for c in df.columns], split.alias("split"))


def remainder_split(sizes: dict[str, int], fraction: float) -> dict[str, int]:
    """Floor quotas of at least one; what is left of the rounded total goes by largest remainder, later names first."""
    quotas = {k: max(1, int(n * fraction)) for k, n in sizes.items()}
    left = round(sum(sizes.values()) * fraction) - sum(quotas.values())
    for k in sorted(sizes, key=lambda k: (sizes[k] * fraction % 1, k), reverse=True)[: max(0, left)]:
        quotas[k] += 1
    return quotas


def select_pairs(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """Per target: ``max(1, round(share * wanted))`` rows for validation and the rest for training, in hash order.

    ``df`` has ``target, split, wanted``; where a side is short, the other fills it.
    """
    ranked = hashed_rank(df, ["target", "split"], seed, key)
    counts = df.groupBy("target").agg(
        F.first("wanted").alias("wanted"),
        F.count_if(F.col("split") == "validation").alias("n_val"),
        F.count_if(F.col("split") == "train").alias("n_train"),
    )
    quota = F.greatest(F.lit(1), F.bround(F.col("wanted") * F.lit(float(share))))
    val = F.least(quota, "n_val")
    train = F.least(F.col("wanted") - val, F.col("n_train"))
    counts = counts.select("target", (F.col("wanted") - train).alias("take_val"), train.alias("take_train"))
    joined = ranked.join(counts, same(ranked, counts, ["target"]))
    taken = F.when(ranked["split"] == "validation", F.col("take_val")).otherwise(F.col("take_train"))
    return joined.where(F.col("rank") <= taken).select(*[ranked[c] for c in df.columns])


def best_parameter(df: DataFrame, groups: Sequence[str], parameter: str, score: str) -> DataFrame:
    """The parameter with the highest score of each group, the smallest of those on ties; an aggregate, nothing is sorted."""
    best = F.max_by(F.struct(parameter, score), F.struct(F.col(score), (-F.col(parameter)).alias("_least"))).alias("_b")
    return df.where(F.col(score).isNotNull()).groupBy(*groups).agg(best).select(*groups, "_b.*")


def winner(df: DataFrame, tolerance: float = 0.02, within: float = 1.0) -> DataFrame:
    """The best run of ``df(run_id, parent_run_id, status, passed, score, size)``.

    Eligible are finished runs whose score isn't more than ``tolerance`` under
    their parent's (a missing parent rules a run out); contenders pass within
    one case of the best; then score, size and name decide.
    """
    parent = df.select(F.col("run_id").alias("p_id"), F.col("score").alias("p_score"))
    joined = df.join(parent, F.col("parent_run_id") == F.col("p_id"), "left")
    safe = F.col("parent_run_id").isNull() | (F.col("p_score").isNotNull() & (F.col("p_score") - F.col("score") <= tolerance))
    eligible = joined.where((F.col("status") == "completed") & safe)
    best = eligible.agg(F.max("passed").alias("best"))
    contenders = eligible.crossJoin(F.broadcast(best)).where(F.col("passed") >= F.col("best") - within)  # one row
    return contenders.orderBy(F.desc("score"), "size", "run_id").limit(1).select(df.columns)
