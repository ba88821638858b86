"""Aggregates of evaluation and corpus reports; all are partial before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _real(x: Column) -> Column:
    """Finite numbers from zero on; others are no measurement."""
    return F.when(~F.isnan(x) & (x >= 0) & (x != float("inf")), x.cast("double"))


def _bucketed(df: DataFrame, groups: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_x``, the finite number or null, and its bucket ``_b`` (256 to a power of two); and the buckets' count, sum, least and largest number."""
    x = F.when(~F.isnan(F.col(value).cast("double")) & (F.abs(value) != float("inf")), F.col(value).cast("double"))
    rows = df.select(*groups, x.alias("_x")).withColumn("_b", F.signum("_x") * F.floor(F.log2(F.abs("_x") + 1) * 256))
    return rows, rows.groupBy(*groups, "_b").agg(F.count("_x").alias("_n"), F.sum("_x").alias("_sum"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))


def _with_percentiles(df: DataFrame, groups: Sequence[str], value: str, percentiles: Mapping[str, float]) -> DataFrame:
    """``count, mean, min, max`` of each group's finite numbers beside exact percentiles, which no task gathers.

    The table is read twice: the buckets (one exchange for both uses) give all but
    the values around the wanted ranks.
    """
    rows, buckets = _bucketed(df, groups, value)
    n = F.sum("_n")
    out = buckets.groupBy(*groups).agg(n.alias("count"), F.try_divide(F.sum("_sum"), n).alias("mean"), F.min("_min").alias("min"), F.max("_max").alias("max"))
    found = _percentiles(rows, buckets, groups, sorted(set(percentiles.values())))
    at = lambda f: F.max(F.when(F.col("fraction") == F.lit(float(f)), F.col("percentile")))
    wide = found.groupBy(*groups).agg(*[at(f).alias(k) for k, f in percentiles.items()])
    if not groups:
        one = out.select(F.coalesce("count", F.lit(0).cast("long")).alias("count"), "mean", "min", "max")
        return one.crossJoin(wide)  # one row each
    on = reduce(lambda a, b: a & b, [out[g].eqNullSafe(wide[g]) for g in groups])
    return out.join(wide, on, "left").select(*[out[c] for c in out.columns], *percentiles)


def timing_summary(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Count, mean, exact p50 and p95 (linear interpolation), max and min of finite measurements."""
    measured = df.select(*groups, _real(F.col(value)).alias("x"))
    return _with_percentiles(measured, groups, "x", {"p50": 0.5, "p95": 0.95}).select(*groups, "count", "mean", "p50", "p95", "max", "min")


def exact_percentiles(df: DataFrame, groups: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """Exact percentiles by linear interpolation, without gathering a group's values.

    The first pass counts values by bucket (256 to a power of two), a table whose
    size doesn't follow the rows; it tells which bucket holds each wanted rank.
    The second pass counts distinct values of those buckets only.  Columns are
    ``groups, fraction, percentile``; numbers that aren't finite are left out.
    """
    return _percentiles(*_bucketed(df, groups, value), groups, fractions)


def _percentiles(rows: DataFrame, buckets: DataFrame, groups: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    buckets = buckets.where("_b is not null")
    by = Window.partitionBy(*groups)
    upto = by.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = buckets.select(*groups, "_b", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), "_n", F.sum("_n").over(by).alias("_total"))
    at = [F.lit(f) * (F.col("_total") - 1) for f in fractions]
    wanted = F.array(*[F.struct(F.lit(float(f)).alias("fraction"), F.floor(p).alias("low"), F.ceil(p).alias("high"), (p - F.floor(p)).alias("part")) for f, p in zip(fractions, at, strict=True)])
    holds = lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n"))
    needed = placed.withColumn("_w", F.filter(wanted, lambda w: holds(w["low"]) | holds(w["high"]))).where(F.size("_w") > 0)
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"k.{g}")) for g in (*groups, "_b")]
    # at most two buckets a group and fraction; whether they are few enough to broadcast is left to the planner
    inside = rows.alias("r").join(needed.alias("k"), on).select(*[F.col(f"r.{g}").alias(g) for g in groups], "r._b", "r._x", "k._before", "k._w")
    values = inside.groupBy(*groups, "_b", "_x").agg(F.count("*").alias("_c"), F.first("_before").alias("_before"), F.first("_w").alias("_w"))
    run = Window.partitionBy(*groups, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("_end", F.col("_before") + F.sum("_c").over(run)).withColumn("_begin", F.col("_end") - F.col("_c"))
    covers = lambda r: (r >= F.col("_begin")) & (r < F.col("_end"))
    hit = ranked.select(*groups, "_x", "_begin", "_end", F.explode("_w").alias("w")).select(
        *groups, "w.fraction", "w.part", F.when(covers(F.col("w.low")), F.col("_x")).alias("lo"), F.when(covers(F.col("w.high")), F.col("_x")).alias("hi")
    )
    ends = hit.groupBy(*groups, "fraction").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.first("part").alias("part"))
    return ends.select(*groups, "fraction", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("percentile"))


def workload_summary(df: DataFrame, groups: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long form: per group and metric the count, mean, median, p90 (ten digits), min and max of what is present."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics]))
    long = df.select(*groups, pairs.alias("m")).select(*groups, "m.metric", "m.x").where("x is not null and not isnan(x)")
    out = _with_percentiles(long, [*groups, "metric"], "x", {"median": 0.5, "p90": 0.9})
    return out.select(*groups, "metric", "count", "mean", "median", F.round("p90", 10).alias("p90"), "min", "max")


def mean_scores(df: DataFrame, groups: Sequence[str], score: str = "score") -> DataFrame:
    """Means over the rows that a metric applies to; null without any, and passed only at 1."""
    return df.groupBy(*groups).agg(
        F.avg(score).alias("score"), F.count(score).alias("applicable"), F.count("*").alias("total"), (F.avg(score) == 1).alias("passed")
    )


def assertion_rates(df: DataFrame) -> DataFrame:
    """Count, passed and rate of ``df(type, dimension, passed)`` by ``type:`` and ``dimension:`` label."""
    labels = F.explode(F.array(F.concat(F.lit("type:"), "type"), F.concat(F.lit("dimension:"), "dimension"))).alias("label")
    passed = F.count_if("passed")
    return df.select(labels, "passed").groupBy("label").agg(F.count("*").alias("count"), passed.alias("n_passed"), (passed / F.count("*")).alias("rate"))


def micro_f1(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 from sums of ``tp, fp, fn``.

    Precision is 0 where something was missed and nothing predicted, recall
    likewise, and both are null where there was nothing at all.
    """
    s = df.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    share = lambda part, other: F.when(F.col("tp") + F.col(part) > 0, F.col("tp") / (F.col("tp") + F.col(part))).when(F.col(other) > 0, 0.0)
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")))
    return s.withColumns({"precision": share("fp", "fn"), "recall": share("fn", "fp"), "f1": f1})


def field_confusion(gold: Column, actual: Column, exact: Column) -> Column:
    """tp, fp, fn of one case: touched fields on both sides, and those that are exactly right; a wrong field costs both."""
    right = F.size(F.array_intersect(F.array_intersect(gold, actual), exact))
    return F.struct(right.alias("tp"), (F.size(F.array_distinct(actual)) - right).alias("fp"), (F.size(F.array_distinct(gold)) - right).alias("fn"))


def slices(df: DataFrame, labels: Column, scores: Mapping[str, Column]) -> DataFrame:
    """Means and applicable counts by overlapping labels; a row counts once for each of its labels."""
    measured = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("x")) for k, v in scores.items()])
    exploded = df.select(F.array_distinct(labels).alias("labels"), measured.alias("s")).select(F.explode("labels").alias("label"), "s")
    long = exploded.select("label", F.explode("s").alias("m"))
    return long.groupBy("label", "m.metric").agg(F.avg("m.x").alias("score"), F.count("m.x").alias("applicable"))


def counters(df: DataFrame, groups: Mapping[str, Column]) -> DataFrame:
    """Counts of several keys at once, in long form ``(group, key, n)``; array keys count each element."""


    def keyed(name: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.struct(F.lit(name).alias("group"), x.cast("string").alias("key")))

    items = [keyed(k, v) for k, v in groups.items()]
    return df.select(F.explode(F.concat(*items)).alias("i")).groupBy("i.group", "i.key").agg(F.count("*").alias("n"))


def deficits(counts: DataFrame, minimums: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Keys that lack rows, those without any included; an unknown group is an error."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(g, k, n) for g, keys in minimums.items() for k, n in keys.items()], "group string, key string, minimum int")
    known = {r[0] for r in counts.select("group").distinct().collect()}  # one row a kind of counter
    if extra := set(minimums) - known:
        raise ValueError(f"unknown groups {sorted(extra)}")
    missing = F.col("minimum") - F.coalesce("n", F.lit(0))
    return F.broadcast(wanted).join(counts, ["group", "key"], "left").withColumn("missing", missing).where("missing > 0").select("group", "key", "missing")


def distinct_ratio(df: DataFrame, groups: Sequence[str], value: Column) -> DataFrame:
    marked = df.withColumn("_v", value)
    return marked.groupBy(*groups).agg(F.count("*").alias("n"), F.countDistinct("_v").alias("n_distinct"), (F.countDistinct("_v") / F.count("*")).alias("ratio"))


def top_values(df: DataFrame, groups: Sequence[str], value: Column, order: str, k: int = 10) -> DataFrame:
    """The k most frequent values of each group, ties by first appearance."""
    from .ranking import top_k

    counted = df.withColumn("value", value).groupBy(*groups, "value").agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return top_k(counted, groups, [F.desc("n"), F.asc("first_seen")], k)


def concentration(df: DataFrame, group: str, value: str, legal: int, slack: float) -> DataFrame:
    """The largest share of a value in each group, against ``ceil(n / legal) / n + slack`` where ``n >= legal``."""
    counted = df.groupBy(group, value).agg(F.count("*").alias("c"))
    agg = counted.groupBy(group).agg(F.sum("c").alias("n"), F.max("c").alias("most"))
    cap = F.when(F.col("n") >= legal, F.ceil(F.col("n") / legal) / F.col("n") + slack)
    return agg.select(group, "n", (F.col("most") / F.col("n")).alias("share"), cap.alias("cap"), F.coalesce(F.col("most") / F.col("n") > cap, F.lit(False)).alias("over"))


def hard_case_ratio(df: DataFrame, category: str, tags: str, hard: Sequence[str], required: float) -> DataFrame:
    """Hard and total rows of each category and how many are missing to the required share."""
    is_hard = F.coalesce(F.arrays_overlap(tags, F.array(*map(F.lit, hard))), F.lit(False))
    counts = df.groupBy(category).agg(F.count("*").alias("total"), F.count_if(is_hard).alias("hard"))
    missing = F.greatest(F.lit(0), F.floor(required * F.col("total") + 0.999999) - F.col("hard")).cast("long")
    return counts.withColumns({"ratio": F.col("hard") / F.col("total"), "missing": missing})


def effective_pass(protocol: Column, task: Column, least: float = 0.95) -> tuple[Column, Column]:
    """Whether a case passes, and the reasons why not."""
    reasons = F.array_compact(F.array(F.when(F.coalesce(protocol != 1, F.lit(True)), F.lit("protocol")), F.when(F.coalesce(task < least, F.lit(True)), F.lit("task"))))
    return F.size(reasons) == 0, reasons


def threshold_gate(means: DataFrame, minimums: Mapping[str, float]) -> DataFrame:
    """Each required metric of ``means(metric, score, applicable)`` against its minimum; a metric that never applied fails."""
    spark = means.sparkSession
    wanted = spark.createDataFrame(list(minimums.items()), "metric string, minimum double")
    ok = F.coalesce((F.col("score") >= F.col("minimum")) & (F.col("applicable") > 0), F.lit(False))
    return F.broadcast(wanted).join(means, "metric", "left").select("metric", "minimum", "score", F.coalesce("applicable", F.lit(0)).alias("applicable"), ok.alias("passed"))


def run_diff(left: DataFrame, right: DataFrame, key: str, passed: str, by: Sequence[str] = ()) -> DataFrame:
    """Flips between two runs over the same cases; ids that one run lacks are an error when the plan runs."""
    a = left.select(F.col(key).alias("_k"), *by, F.col(passed).alias("_a"))
    b = right.select(F.col(key).alias("_j"), F.col(passed).alias("_b"))
    both = a.join(b, F.col("_k") == F.col("_j"), "full_outer")
    checked = both.withColumn("_ok", F.assert_true(F.col("_k").isNotNull() & F.col("_j").isNotNull(), F.lit("the runs have different cases")))
    checked = checked.where(F.col("_ok").isNull())
    gained, lost = F.count_if(~F.col("_a") & F.col("_b")), F.count_if(F.col("_a") & ~F.col("_b"))
    return checked.groupBy(*by).agg(
        F.count("*").alias("cases"), gained.alias("gained"), lost.alias("lost"), (gained - lost).alias("net"), (F.avg(F.col("_b").cast("double")) - F.avg(F.col("_a").cast("double"))).alias("delta")
    )


def listed_hash(df: DataFrame, key: str, groups: Sequence[str] = ()) -> DataFrame:
    """SHA-256 of the sorted keys of each group, joined by line ends. For manifests of report size: a group's keys meet in one value."""
    return df.groupBy(*groups).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), "\n"), 256).alias("sha256"))


def set_hash(df: DataFrame, key: str, groups: Sequence[str] = ()) -> DataFrame:
    """A set's fingerprint without order and gathering: number of keys and sum of the first 52 bits of their SHA-256. For tables of any size."""
    bits = F.conv(F.left(F.sha2(F.col(key).cast("string"), 256), F.lit(13)), 16, 10).cast("decimal(20,0)")
    return df.groupBy(*groups).agg(F.count("*").alias("n"), F.sum(bits).cast("string").alias("hash_sum"))


def scorecard_lines(means: DataFrame) -> DataFrame:
    """Text lines of a scorecard; a metric that doesn't apply reads n/a."""
    shown = F.when(F.col("score").isNull(), F.lit("n/a")).otherwise(F.format_string("%.1f%%", F.col("score") * 100))
    return means.select("metric", F.concat("metric", F.lit(": "), shown).alias("line"))


def markdown_table(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """One row with a Markdown table of a report-sized frame."""
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns)
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("n/a")) for c in columns]), F.lit(" |"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), row.alias("line")))), lambda x: x["line"])
    return df.agg(F.concat_ws("\n", F.lit(head), F.array_join(lines, "\n")).alias("markdown"))
