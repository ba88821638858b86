"""Queries of evaluation and corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ranking, reports
from .catalog import register, table


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


@register("""
SELECT event_type, count(value) AS count, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
       max(value) AS max, min(value) AS min
FROM events WHERE value >= 0 AND isfinite(value) GROUP BY event_type
""")
def timing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.timing_summary(table(spark, sf_dir, "events"), "value", ["event_type"]), "mean", "p50", "p95")


@register("""
WITH fractions(fraction) AS (VALUES (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)), x AS (SELECT event_type, value AS v FROM events WHERE value >= 0 AND isfinite(value))
SELECT event_type, fraction, round(quantile_cont(v, 0.5), 6) AS percentile FROM x, fractions WHERE fraction = 0.5 GROUP BY ALL
UNION ALL SELECT event_type, fraction, round(quantile_cont(v, 0.9), 6) FROM x, fractions WHERE fraction = 0.9 GROUP BY ALL
UNION ALL SELECT event_type, fraction, round(quantile_cont(v, 0.99), 6) FROM x, fractions WHERE fraction = 0.99 GROUP BY ALL
""")
def spread_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of groups too large for one task's memory."""
    return _rounded(reports.exact_percentiles(table(spark, sf_dir, "events"), ["event_type"], "value", [0.5, 0.9, 0.99]), "percentile")


@register("""
WITH numbered AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'cold' ELSE 'hot' END AS phase FROM events),
long AS (SELECT phase, event_type, 'value' AS metric, value AS x FROM numbered UNION ALL SELECT phase, event_type, 'k', (props::JSON ->> '$.k')::DOUBLE FROM numbered)
SELECT phase, event_type, metric, count(*) AS count, round(avg(x), 6) AS mean, round(median(x), 6) AS median, round(quantile_cont(x, 0.9), 10) AS p90, min(x) AS min, max(x) AS max
FROM long GROUP BY phase, event_type, metric
""")
def workload_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    first = Window.partitionBy("user_id").orderBy("ts", "event_id")
    phased = events.withColumn("phase", F.when(F.row_number().over(first) == 1, "cold").otherwise("hot"))
    return _rounded(reports.workload_summary(phased, ["phase", "event_type"], ["value", "k"]), "mean", "median")


@register("""
SELECT lang, round(avg(CASE WHEN toxic = 0 THEN quality END), 6) AS score, count(CASE WHEN toxic = 0 THEN quality END) AS applicable, count(*) AS total,
       avg(CASE WHEN toxic = 0 THEN quality END) = 1 AS passed
FROM labels JOIN documents USING (doc_id) GROUP BY lang
""")
def scorecard_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return _rounded(reports.mean_scores(cases.withColumn("score", F.when(F.col("toxic") == 0, F.col("quality"))), ["lang"]), "score")


@register("""
SELECT source, sum((toxic = 1 AND quality = 1)::INT)::BIGINT AS tp, sum((toxic = 0 AND quality = 1)::INT)::BIGINT AS fp, sum((toxic = 1 AND quality = 0)::INT)::BIGINT AS fn,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) WHEN fn > 0 THEN 0 END, 6)::DOUBLE AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) WHEN fp > 0 THEN 0 END, 6)::DOUBLE AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END, 6)::DOUBLE AS f1
FROM labels JOIN documents USING (doc_id) GROUP BY source
""")
def confusion_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    flags = cases.select("source", *[((F.col("toxic") == t) & (F.col("quality") == q)).cast("int").alias(n) for n, t, q in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0))])
    return _rounded(reports.micro_f1(flags, ["source"]), "precision", "recall", "f1")


@register("""
WITH labelled AS (
  SELECT 'role:' || role AS label, length(text)::DOUBLE AS chars, CASE WHEN turn > 0 THEN turn::DOUBLE END AS later FROM conversations
  UNION ALL SELECT CASE WHEN turn = 0 THEN 'turn:first' ELSE 'turn:later' END, length(text), CASE WHEN turn > 0 THEN turn::DOUBLE END FROM conversations
), long AS (SELECT label, 'chars' AS metric, chars AS x FROM labelled UNION ALL SELECT label, 'later', later FROM labelled)
SELECT label, metric, round(avg(x), 6) AS score, count(x) AS applicable FROM long GROUP BY label, metric
""")
def slice_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(F.concat(F.lit("role:"), "role"), F.when(F.col("turn") == 0, "turn:first").otherwise("turn:later"))
    scores = {"chars": F.char_length("text"), "later": F.when(F.col("turn") > 0, F.col("turn"))}
    return _rounded(reports.slices(table(spark, sf_dir, "conversations"), labels, scores), "score")


MINIMUMS = {"event_type": {"click": 10, "error": 100_000, "refund": 5, "view": 3}, "digit": {"7": 1_000_000}}


@register("""
WITH counts AS (
  SELECT 'event_type' AS "group", event_type AS key, count(*) AS n FROM events GROUP BY event_type
  UNION ALL SELECT 'digit', (user_id % 10)::VARCHAR, count(*) FROM events GROUP BY user_id % 10
), wanted("group", key, minimum) AS (VALUES ('event_type', 'click', 10), ('event_type', 'error', 100000), ('event_type', 'refund', 5), ('event_type', 'view', 3), ('digit', '7', 1000000))
SELECT w."group", w.key, minimum - coalesce(n, 0) AS missing FROM wanted w LEFT JOIN counts c ON w."group" = c."group" AND w.key = c.key WHERE minimum > coalesce(n, 0)
""")
def coverage_deficits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    counts = reports.counters(events, {"event_type": F.array("event_type"), "digit": F.array(F.col("user_id") % 10)})
    return reports.deficits(counts, MINIMUMS)


@register("""
SELECT lang, source, count(*) AS n, count(DISTINCT text) AS n_distinct, round(count(DISTINCT text) / count(*), 6) AS ratio FROM documents GROUP BY lang, source
""")
def diversity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.distinct_ratio(table(spark, sf_dir, "documents"), ["lang", "source"], F.sha2("text", 256)), "ratio")


@register("""
SELECT o_orderpriority, value, n, first_seen FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, first_seen) AS r FROM (
    SELECT o_orderpriority, o_custkey % 40 AS value, count(*) AS n, min(o_orderkey) AS first_seen FROM orders GROUP BY ALL)) WHERE r <= 10
""")
def top_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_values(table(spark, sf_dir, "orders"), ["o_orderpriority"], F.col("o_custkey") % 40, "o_orderkey")


@register("""
WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS c FROM orders GROUP BY ALL), a AS (SELECT o_orderpriority, sum(c)::BIGINT AS n, max(c) AS most FROM c GROUP BY o_orderpriority)
SELECT o_orderpriority, n, round(most / n, 6) AS share, round(ceil(n / 3) / n + 0.05, 6) AS cap, most / n > ceil(n / 3) / n + 0.05 AS over FROM a
""")
def value_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.concentration(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", 3, 0.05), "share", "cap")


@register("""
SELECT lang, count(*) AS cases, count(*) FILTER (quality = 0 AND toxic = 1) AS gained, count(*) FILTER (quality = 1 AND toxic = 0) AS lost,
       count(*) FILTER (quality = 0 AND toxic = 1) - count(*) FILTER (quality = 1 AND toxic = 0) AS net, round(avg(toxic) - avg(quality), 6) AS delta
FROM labels JOIN documents USING (doc_id) GROUP BY lang
""")
def run_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxic flags taken as two runs over the labelled documents."""
    cases = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    left = cases.select("doc_id", "lang", (F.col("quality") == 1).alias("passed"))
    right = cases.select("doc_id", (F.col("toxic") == 1).alias("passed"))
    return _rounded(reports.run_diff(left, right, "doc_id", "passed", ["lang"]), "delta")


@register("""
WITH means AS (SELECT event_type AS metric, avg(CASE WHEN value < 100 THEN 1.0 ELSE 0 END) AS score, count(*) AS applicable FROM events GROUP BY event_type),
wanted(metric, minimum) AS (VALUES ('click', 0.5::DOUBLE), ('error', 0.999999::DOUBLE), ('absent', 0.1::DOUBLE))
SELECT w.metric, minimum, round(score, 6) AS score, coalesce(applicable, 0) AS applicable, coalesce(score >= minimum AND applicable > 0, false) AS passed FROM wanted w LEFT JOIN means m USING (metric)
""")
def threshold_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric")).agg(F.avg((F.col("value") < 100).cast("double")).alias("score"), F.count("*").alias("applicable"))
    return _rounded(reports.threshold_gate(means, {"click": 0.5, "error": 0.999999, "absent": 0.1}), "score")


_RUNS_SQL = """
WITH runs AS (
  SELECT 'run' || s_suppkey AS run_id, CASE WHEN s_suppkey % 3 > 0 THEN 'run' || floor(s_suppkey / 2)::BIGINT END AS parent_run_id, CASE WHEN s_suppkey % 11 = 5 THEN 'failed' ELSE 'completed' END AS status,
         floor(s_acctbal / 200)::BIGINT AS passed, round(s_acctbal / 10000, 2) AS score, s_nationkey AS size FROM supplier
), eligible AS (
  SELECT r.* FROM runs r LEFT JOIN runs p ON r.parent_run_id = p.run_id
  WHERE r.status = 'completed' AND (r.parent_run_id IS NULL OR (p.score IS NOT NULL AND p.score - r.score <= 0.02))
)
"""


@register(_RUNS_SQL + "SELECT * FROM eligible WHERE passed >= (SELECT max(passed) FROM eligible) - 1 ORDER BY score DESC, size, run_id LIMIT 1")
def select_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's winner; one row by its meaning."""
    key = F.col("s_suppkey")
    runs = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("run"), key.cast("string")).alias("run_id"),
        F.when(key % 3 > 0, F.concat(F.lit("run"), F.expr("s_suppkey div 2").cast("string"))).alias("parent_run_id"),
        F.when(key % 11 == 5, "failed").otherwise("completed").alias("status"),
        F.floor(F.col("s_acctbal") / 200).alias("passed"),
        F.round(F.col("s_acctbal") / 10000, 2).alias("score"),
        F.col("s_nationkey").alias("size"),
    )
    return ranking.winner(runs)


@register("""
WITH labels_ AS (SELECT 'type:' || event_type AS label, value < 50 AS passed FROM events UNION ALL SELECT 'dimension:' || (user_id % 3), value < 50 FROM events)
SELECT label, count(*) AS count, count(*) FILTER (passed) AS n_passed, round(count(*) FILTER (passed) / count(*), 6) AS rate FROM labels_ GROUP BY label
""")
def assertion_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("type"), (F.col("user_id") % 3).cast("string").alias("dimension"), (F.col("value") < 50).alias("passed"))
    return _rounded(reports.assertion_rates(rows), "rate")


@register("""
SELECT o_orderpriority AS category, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS hard, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS ratio,
       greatest(0, floor(0.4 * count(*) + 0.999999) - count(*) FILTER (o_orderstatus = 'F'))::BIGINT AS missing
FROM orders GROUP BY o_orderpriority
""")
def hard_case_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category"), F.array("o_orderstatus").alias("tags"))
    return _rounded(reports.hard_case_ratio(rows, "category", "tags", ["F"], 0.4), "ratio")


@register("""
SELECT user_id, count(*) AS n, count(*) FILTER (value >= 20 AND event_type = 'click') AS effective,
       string_agg(DISTINCT CASE WHEN event_type <> 'click' THEN 'protocol' END, ',') IS NOT NULL AS any_protocol_failure
FROM events GROUP BY user_id
""")
def effective_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, reasons = reports.effective_pass((F.col("event_type") == "click").cast("int"), F.col("value") / 20, 1.0)
    rows = table(spark, sf_dir, "events").select("user_id", ok.alias("ok"), reasons.alias("reasons"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("ok").alias("effective"), F.bool_or(F.array_contains("reasons", "protocol")).alias("any_protocol_failure"))


@register("""
SELECT lang, count(*) AS n, sum(('0x' || substr(sha256(doc_id::VARCHAR), 1, 13))::BIGINT)::VARCHAR AS hash_sum FROM documents GROUP BY lang
""")
def set_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.set_hash(table(spark, sf_dir, "documents"), "doc_id", ["lang"])
