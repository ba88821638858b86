"""Queries of scans, sinks, validation, evaluation, planning and provenance on records made from the tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..facets import Catalog, compact, load_catalog
from ..functions import text as T
from ..functions import times, units
from ..operators import appointments, generation, matching, provenance, ranking, records, reports, sessions
from ..sources import readers, sinks
from ..sources.shared import scratch
from ..sources.strict_json import strict_object
from ..streaming import windows as stream
from . import assertions, compiler, evaluation, intents
from .catalog import register, table

#: A catalog of orders: status and priority are sets, the total is money, the weight a mass.
SHOP = """
registry_version: "1.0"
search:
  query_fields: [comment]
  sort_fields:
    - {field: total, index_field: o_totalprice, orders: [asc, desc]}
fields:
  - name: status
    type: categorical
    index_field: o_orderstatus
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    values:
      - {code: f, label: Finished, aliases: [done]}
      - {code: o, label: Open, aliases: []}
      - {code: p, label: Pending, aliases: [waiting]}
  - name: flavor
    type: categorical
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    values:
      - {code: sweet, label: Sweet, aliases: []}
      - {code: honey, label: Honey, aliases: [], parent: sweet}
      - {code: sour, label: Sour, aliases: []}
  - name: allergen
    type: categorical
    hard_operators: [in, not_in]
    soft_operators: [avoid]
    values:
      - {code: nuts, label: Nuts, aliases: []}
      - {code: milk, label: Milk, aliases: []}
  - name: price
    type: number
    index_field: o_totalprice
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    minimum: 0
    unit_kind: currency
    unit_pattern: "^[A-Z]{3}$"
  - name: size
    type: number
    index_field: size_g
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    minimum: 0
    exclusive_minimum: true
    unit_kind: mass
    base_unit: g
    units:
      - {code: g, factor: 1}
      - {code: kg, factor: 1000}
"""
CATALOG: Catalog = load_catalog(SHOP)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))


# --- scans and sinks --------------------------------------------------------------------------------------------------


@register("SELECT n_nationkey AS id, n_name AS name, r_name AS region, r_regionkey AS key FROM nation JOIN region ON n_regionkey = r_regionkey")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines, known keys first at every depth, and read back with a schema."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nation.select(F.struct(F.col("r_regionkey").alias("key"), F.col("r_name").alias("region")).alias("place"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    path = scratch(spark, "jsonl") + "/rows"
    # the scan takes files of this name below a folder
    sinks.in_order(rows, ("id", "name", "place", "region", "key")).write.option("ignoreNullFields", "false").option("lineSep", "\n").json(path)
    lines = readers.text_lines(spark, f"{path}/*.json").withColumn("value", strict_object(F.col("line")))
    return readers.typed(lines, "id int, name string, place struct<region:string,key:int>").select("id", "name", F.col("place.region").alias("region"), F.col("place.key").alias("key"))


@register("SELECT c_mktsegment AS segment, count(*) AS lines, count(*) FILTER (c_custkey % 5 <> 0) AS good FROM customer GROUP BY c_mktsegment")
def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one file in several splits, every fifth one cut short: which are objects, by the segment that the text names."""
    line = F.concat(F.lit('{"segment":"'), F.col("c_mktsegment"), F.lit('","key":'), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 5 != 0, "}").otherwise(""))
    path = scratch(spark, "lines") + "/rows"
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    read = readers.text_lines(spark, f"{path}/*.txt").withColumn("value", strict_object(F.col("line")))
    return read.groupBy(F.regexp_extract("line", '"segment":"([^"]+)"', 1).alias("segment")).agg(F.count("*").alias("lines"), F.count("value").alias("good"))


@register("""
SELECT c_custkey AS k, c_custkey % 2 = 0 AS chat, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS said FROM customer
""")
def corpus_user_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users said, from rows of two layouts."""
    name = F.when(F.col("c_custkey") % 3 > 0, F.col("c_name"))
    said = F.to_json(F.struct(F.struct(name.alias("user_input")).alias("input")))
    turns = F.array(F.struct(F.lit("system").alias("from"), F.lit("s").alias("value")), F.struct(F.when(F.col("c_custkey") % 3 > 0, "human").otherwise("gpt").alias("from"), F.col("c_name").alias("value")))
    chat = F.to_json(F.struct(turns.alias("conversations")))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 2 == 0).alias("chat"), F.parse_json(F.when(F.col("c_custkey") % 2 == 0, chat).otherwise(said)).alias("value"))
    return rows.select("k", "chat", readers.user_text().alias("said"))


@register("""
SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text, min(turn) AS first_at, max(turn) + 100 AS ended_at, count(*)::BIGINT AS tokens FROM conversations WHERE text <> '' GROUP BY conv_id
""")
def event_stream_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and times of server-sent events: a delta for each turn, a comment, an empty delta, usage at the end."""
    turns = table(spark, sf_dir, "conversations").where("text <> ''")
    piece = lambda t: F.concat(F.lit("data: "), F.to_json(F.struct(F.array(F.struct(F.struct(t.alias("content")).alias("delta"))).alias("choices"))))
    line = lambda seq, ts, text: F.struct(seq.cast("long").alias("seq"), ts.cast("long").alias("ts"), text.alias("line"))
    deltas = turns.select(F.col("conv_id").alias("request_id"), line(F.col("turn"), F.col("turn"), piece(F.col("text"))).alias("l"))
    ends = turns.groupBy(F.col("conv_id").alias("request_id")).agg(F.max("turn").alias("t"), F.count("*").alias("n"))
    usage = F.concat(F.lit('data: {"usage":{"completion_tokens":'), F.col("n").cast("string"), F.lit("}}"))
    extra = F.array(line(F.lit(-2), F.lit(-2), F.lit(": ping")), line(F.lit(-1), F.lit(-1), piece(F.lit(""))), line(F.col("t") + 100, F.col("t") + 100, usage), line(F.col("t") + 101, F.col("t") + 101, F.lit("data: [DONE]")))
    lines = deltas.unionByName(ends.select("request_id", F.explode(extra).alias("l"))).select("request_id", "l.*")
    out = readers.sse(lines)
    return out.select(F.col("request_id").alias("conv_id"), "text", F.col("first_text_at").alias("first_at"), "ended_at", "tokens")


def _echo(url: str, body: Mapping[str, Any]) -> tuple[int, Mapping[str, Any]]:
    """A service without a network: it fails for every seventh customer and cuts short answers to small limits."""
    key = body["key"]
    if key % 7 == 0:
        return 400, {"error": "no"}
    cut = body["max_tokens"] < 20 and key % 3 == 0
    return 200, {"choices": [{"message": {"content": body["messages"][0]["content"].lower()}, "finish_reason": "length" if cut else "stop"}]}


@register("""
SELECT c_custkey::VARCHAR AS case_id, CASE WHEN c_custkey % 7 <> 0 THEN lower(c_name) END AS text, CASE WHEN c_custkey % 7 <> 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END END::INT AS attempts, c_custkey % 7 = 0 AS failed FROM customer
""")
def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a service: cut ones are asked for again with twice the room, failures are told apart."""
    body = F.to_json(F.struct(F.col("c_custkey").alias("key"), F.lit(16).alias("max_tokens"), F.array(F.struct(F.lit("user").alias("role"), F.col("c_name").alias("content"))).alias("messages")))
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("case_id"), body.alias("body"))
    out = readers.complete_all(asked, _echo, "local", 8)
    return out.select("case_id", "text", "attempts", F.col("error").isNotNull().alias("failed"))


@register("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'id ' || o_orderkey ELSE 'text ' || (o_orderkey % 10) END AS response FROM orders")
def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored answers by sample id, else by the exact text."""
    samples = orders(spark, sf_dir).select("k", F.col("k").cast("string").alias("sample_id"), (F.col("k") % 10).cast("string").alias("user_input"))
    none = F.lit(None).cast("string")
    by_id = samples.where("k % 2 = 0").select("sample_id", none.alias("user_input"), F.concat(F.lit("id "), "sample_id").alias("response"))
    by_text = spark.range(10).select(none.alias("sample_id"), F.col("id").cast("string").alias("user_input"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("response"))
    return matching.lookup_replay(samples, by_id.unionByName(by_text)).select("k", "response")


@register("""
SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0
""")
def unfinished_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers whose result folder lacks one of its files."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    parts = F.array(F.when(F.col("id") % 3 == 0, F.lit("scores")), F.when(F.col("id") % 2 == 1, F.lit("complete.marker")), F.lit("notes"))
    files = ids.select("id", F.explode(F.array_compact(parts)).alias("name"))
    return provenance.incomplete(ids, files, ("scores", "complete.marker"))


@register("SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'base' ELSE 'tuned' END AS side, event_type AS type, user_id FROM events")
def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two sides as compact JSON lines, read back."""
    events = table(spark, sf_dir, "events").withColumn("side", F.when(F.col("event_id") % 2 == 0, "base").otherwise("tuned"))
    lines = sinks.events(events, "side", "event_id", "event_type", F.struct("user_id"))
    read = F.from_json("value", "side string, seq long, type string, payload struct<user_id:long>").alias("r")
    return lines.select(read).select("r.side", "r.seq", "r.type", "r.payload.user_id")


@register("""
SELECT n_name AS run_id, count(*) AS cases, count(*) FILTER (c_custkey % 4 <> 0) / count(*)::DOUBLE AS pass_rate
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def run_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run folder with predictions, scores, summary and detail, and the summary read back from it."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("kind"))
    customers = table(spark, sf_dir, "customer").join(nation, "c_nationkey").withColumn("case_id", F.col("c_custkey").cast("string"))
    cases = customers.select("case_id", "kind", F.lit(1.0).alias("protocol"), F.when(F.col("c_custkey") % 4 == 0, 0.5).otherwise(1.0).alias("task"))
    scores = customers.select("case_id", F.lit("task").alias("name"), F.lit(None).cast("string").alias("field"), F.col("c_acctbal").alias("score"), F.lit(None).cast("string").alias("detail"))
    path = scratch(spark, "run") + "/out"
    sinks.write_run(path, customers.select("case_id", F.col("c_name").alias("text")), scores, cases)
    return spark.read.parquet(f"{path}/summary").select(F.col("kind").alias("run_id"), "cases", "pass_rate")


# --- catalog and validation --------------------------------------------------------------------------------------------


@register("""
WITH v AS (SELECT * FROM (VALUES ('status', 'f', 'done', 0), ('status', 'o', NULL, 1), ('status', 'p', 'waiting', 2), ('flavor', 'sweet', NULL, 0), ('flavor', 'honey', NULL, 1), ('flavor', 'sour', NULL, 2), ('allergen', 'nuts', NULL, 0), ('allergen', 'milk', NULL, 1)) t(field, code, alias, ordinal))
SELECT field, code, ordinal, count(o_orderkey) AS orders, count(o_orderkey) FILTER (o_orderkey % 2 = 0) AS by_alias
FROM v LEFT JOIN orders ON field = 'status' AND CASE WHEN o_orderkey % 2 = 0 THEN alias = CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'waiting' END ELSE code = lower(o_orderstatus) END
GROUP BY ALL
""")
def catalog_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of a catalog file as a dimension, with the orders that name each by its code or an alias."""
    rows = [(f.name, v.code, k) for f in CATALOG.fields for k, v in enumerate(f.values)]
    values = spark.createDataFrame(rows, "field string, code string, ordinal int")
    names = spark.createDataFrame([(f.name, v.code, list(v.aliases)) for f in CATALOG.fields for v in f.values], "field string, code string, aliases array<string>")
    status = F.col("o_orderstatus")
    term = F.when(F.col("o_orderkey") % 2 == 0, F.when(status == "F", " Done").when(status == "P", "WAITING")).otherwise(status)
    said = matching.resolve_aliases(table(spark, sf_dir, "orders").select("o_orderkey", F.lit("status").alias("field"), term.alias("term")), names)
    counts = said.where("code is not null").groupBy("field", "code").agg(F.count("*").alias("orders"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("by_alias"))
    zero = F.lit(0).cast("long")
    return values.join(counts, ["field", "code"], "left").select("field", "code", "ordinal", F.coalesce("orders", zero).alias("orders"), F.coalesce("by_alias", zero).alias("by_alias"))


def _change(conditions: Column, query: Column, clear: Column, reset: Column) -> Column:
    """A change as JSON text, from arrays of condition texts."""
    return F.concat(
        F.lit('{"schema_version":"1.0","reset":'), reset.cast("string"), F.lit(',"query_text":'), F.coalesce(F.concat(F.lit('"'), query, F.lit('"')), F.lit("null")),
        F.lit(',"hard_filters":['), F.array_join(conditions, ","), F.lit('],"soft_preferences":[],"sort":null,"clear_fields":['),
        F.array_join(F.transform(clear, lambda c: F.concat(F.lit('"'), c, F.lit('"'))), ","), F.lit('],"unmapped_terms":[]}'),
    )


def _condition(field: Column | str, op: Column | str, values: Column | str = "", value: Column | str = "null", unit: Column | str = "null") -> Column:
    cell = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.concat(F.lit('{"field":"'), cell(field), F.lit('","op":"'), cell(op), F.lit('","value":'), cell(value), F.lit(',"values":['), cell(values), F.lit('],"min_value":null,"max_value":null,"unit":'), cell(unit), F.lit("}"))


@register("""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'invalid_json' WHEN o_orderkey % 7 = 0 THEN 'invalid_operator' WHEN o_orderkey % 5 = 0 THEN 'invalid_range'
  WHEN o_orderkey % 3 = 0 THEN 'unknown_field' WHEN o_orderkey % 13 = 0 THEN 'invalid_unit' ELSE 'ok' END AS code FROM orders
""")
def change_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first problem of each of many changes, by its code."""
    k = F.col("k")
    status = _condition(F.when(k % 3 == 0, "nowhere").otherwise("status"), F.when(k % 7 == 0, "between").otherwise("in"), '"o"')
    price = _condition("price", "gte", value=F.when(k % 5 == 0, "-1").otherwise("5"), unit=F.when(k % 13 == 0, '"usd"').otherwise('"USD"'))
    first = F.when(k % 7 == 0, _condition("status", "between", '"o"')).when(k % 5 == 0, price).when(k % 3 == 0, status).otherwise(price)
    body = _change(F.array(first), F.lit(None).cast("string"), F.array().cast("array<string>"), F.lit(False))
    rows = orders(spark, sf_dir).select("k", F.when(k % 11 == 0, F.substr(body, F.lit(1), F.lit(40))).otherwise(body).alias("body"))

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for text in batch["body"].to_pylist():
                try:
                    _, problems = compiler.patch_problems(readers.parse(text), CATALOG)
                    codes.append(problems[0].code if problems else "ok")
                except readers.StrictJSONError:
                    codes.append("invalid_json")
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(codes, pa.string())], ["k", "code"])

    return rows.mapInArrow(checked, "k long, code string")


# --- evaluation --------------------------------------------------------------------------------------------------------

#: Cases of one user's events: the state is the first, the gold change the second, the answer the third and fourth; fields are event types.
_CASES_SQL = """
WITH marked AS (SELECT user_id, event_id, event_type AS f, floor(value / 40)::BIGINT AS v, event_id % 5 AS side, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 12 AS c FROM events),
sides AS (
  SELECT user_id, c, coalesce(list_sort(list(DISTINCT f || v) FILTER (side = 0)), []) AS before, coalesce(list_sort(list(DISTINCT f || v) FILTER (side IN (1, 2))), []) AS gold,
         coalesce(list_sort(list(DISTINCT f || v) FILTER (side IN (2, 3))), []) AS actual FROM marked GROUP BY user_id, c
), cases AS (
  SELECT *, (user_id + c) % 6 = 0 AS invalid,
    list_sort(list_concat(list_filter(before, lambda x: NOT list_contains(list_transform(gold, lambda y: y[:3]), x[:3])), gold)) AS goal,
    list_sort(list_concat(list_filter(before, lambda x: NOT list_contains(list_transform(actual, lambda y: y[:3]), x[:3])), actual)) AS after FROM sides
)
"""


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases as the scoring reads them, made from events in stretches of twelve."""
    events = table(spark, sf_dir, "events")
    numbered = ranking.distributed_rank(events, ["user_id"], [F.col("event_id")], F.floor(F.col("event_id") / 4096), "at")
    side, c = F.col("event_id") % 5, F.floor((F.col("at") - 1) / 12).alias("c")
    entry = F.struct(F.col("event_type").alias("field"), F.lit(False).alias("soft"), F.lit("eq").alias("op"), F.floor(F.col("value") / 40).cast("string").alias("value"))
    of = lambda *wanted: F.collect_set(F.when(side.isin(*wanted), entry))
    grouped = numbered.groupBy("user_id", c).agg(of(0).alias("before"), of(1, 2).alias("gold"), of(2, 3).alias("actual"))
    none = F.array().cast("array<string>")
    change = lambda entries: F.struct(F.lit(False).alias("reset"), entries.alias("entries"), none.alias("clear"), none.alias("unmapped"))
    invalid = (F.col("user_id") + F.col("c")) % 6 == 0
    merged = lambda new: sessions.merge_arrays(F.col("before"), F.col(new), none, F.lit(False))
    wide = grouped.withColumns({"goal": merged("gold"), "after": F.when(~invalid, merged("actual"))})
    asked = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(f).cast("string").alias("field")) for t, f in ASKED])
    return wide.select(
        F.lit("r").alias("run_id"), F.concat_ws("-", "user_id", "c").alias("case_id"), "before", change(F.col("gold")).alias("gold"), "goal", F.when(~invalid, change(F.col("actual"))).alias("actual"), "after",
        F.when(invalid, F.array(F.struct(F.lit("field").alias("what"), F.lit(None).cast("string").alias("field")))).otherwise(F.array().cast(assertions.STRANGERS)).alias("strangers"), asked.alias("asked"), F.lit(None).cast("string").alias("detail"),
    )


ASKED = (
    ("field_exact", "view"), ("field_replaced", "click"), ("field_preserved", "view"), ("field_cleared", "error"), ("operator_correct", "purchase"), ("value_normalized", "purchase"),
    ("hard_soft_correct", None), ("negation_correct", None), ("allergen_semantics_correct", None), ("query_text_correct", None), ("sort_correct", None), ("no_unknown_field", None),
    ("no_unknown_value", None), ("no_hallucinated_filter", None), ("unmapped_correct", None), ("minimal_patch", None),
)

_HOLDS_SQL = """
, flags AS (
  SELECT user_id, c, unnest([
    {'type': 'field_exact', 'ok': list_filter(actual, lambda x: x[:4] = 'view') = list_filter(gold, lambda x: x[:4] = 'view')},
    {'type': 'field_replaced', 'ok': len(list_filter(before, lambda x: x[:5] = 'click')) > 0 AND len(list_filter(actual, lambda x: x[:5] = 'click')) > 0
       AND list_filter(before, lambda x: x[:5] = 'click') <> list_filter(goal, lambda x: x[:5] = 'click') AND list_filter("after", lambda x: x[:5] = 'click') = list_filter(goal, lambda x: x[:5] = 'click')},
    {'type': 'field_preserved', 'ok': len(list_filter(before, lambda x: x[:4] = 'view')) > 0 AND list_filter(goal, lambda x: x[:4] = 'view') = list_filter(before, lambda x: x[:4] = 'view')
       AND list_filter("after", lambda x: x[:4] = 'view') = list_filter(before, lambda x: x[:4] = 'view')},
    {'type': 'field_cleared', 'ok': false},
    {'type': 'operator_correct', 'ok': len(list_filter(actual, lambda x: x[:8] = 'purchase')) = len(list_filter(gold, lambda x: x[:8] = 'purchase'))},
    {'type': 'value_normalized', 'ok': list_filter(actual, lambda x: x[:8] = 'purchase') = list_filter(gold, lambda x: x[:8] = 'purchase')},
    {'type': 'hard_soft_correct', 'ok': actual = gold}, {'type': 'negation_correct', 'ok': true}, {'type': 'allergen_semantics_correct', 'ok': true}, {'type': 'query_text_correct', 'ok': true},
    {'type': 'sort_correct', 'ok': true}, {'type': 'no_unknown_field', 'ok': true}, {'type': 'no_unknown_value', 'ok': true},
    {'type': 'no_hallucinated_filter', 'ok': len(list_filter(actual, lambda x: NOT list_contains(gold, x))) = 0}, {'type': 'unmapped_correct', 'ok': true},
    {'type': 'minimal_patch', 'ok': len(list_filter(actual, lambda x: NOT list_contains(gold, x))) = 0
       AND len(list_filter(actual, lambda x: list_filter(before, lambda y: y[:3] = x[:3]) = list_filter("after", lambda y: y[:3] = x[:3]))) = 0}
  ]) AS s, invalid FROM cases
), judged AS (SELECT user_id, c, s.type AS type, s.ok AND NOT invalid AS ok FROM flags)
"""


@register(_CASES_SQL + _HOLDS_SQL + """
SELECT 'type:' || type AS label, count(*) AS count, count(*) FILTER (ok) AS n_passed FROM judged GROUP BY type
UNION ALL SELECT 'dimension:' || CASE WHEN type IN ('field_exact', 'operator_correct', 'value_normalized') THEN 'field' WHEN type IN ('field_replaced', 'field_preserved', 'field_cleared', 'minimal_patch') THEN 'state'
  WHEN type IN ('hard_soft_correct', 'negation_correct') THEN 'intent' WHEN type IN ('allergen_semantics_correct', 'no_hallucinated_filter') THEN 'safety'
  WHEN type IN ('query_text_correct', 'sort_correct', 'unmapped_correct') THEN 'search' ELSE 'schema' END, count(*), count(*) FILTER (ok) FROM judged GROUP BY 1
""")
def assertion_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixteen assertions over cases made from events: count and passed by type and dimension."""
    scores = evaluation.score_cases(_cases(spark, sf_dir), CATALOG)
    return evaluation.assertion_statistics(scores).select("label", "count", "n_passed")


@register(_CASES_SQL + """
, per AS (
  SELECT user_id, c, invalid, list_distinct(list_transform(gold, lambda x: x[:3])) AS gf, CASE WHEN invalid THEN [] ELSE list_distinct(list_transform(actual, lambda x: x[:3])) END AS af, actual, gold, before, goal, "after" FROM cases
), more AS (
  SELECT *, list_distinct(list_concat(gf, af)) AS fs, list_filter(gf, lambda f: list_contains(af, f) AND list_filter(actual, lambda x: x[:3] = f) = list_filter(gold, lambda x: x[:3] = f)) AS hit,
    list_filter(['cli', 'err', 'pur', 'sig', 'vie'], lambda f: len(list_filter(before, lambda x: x[:3] = f)) > 0 AND NOT list_contains(gf, f)) AS kept FROM per
), long AS (
  SELECT unnest([
    {'name': 'schema_valid', 's': (NOT invalid)::INT::DOUBLE}, {'name': 'exact_match', 's': (NOT invalid AND actual = gold)::INT::DOUBLE},
    {'name': 'hallucination_free', 's': (NOT invalid AND len(list_filter(actual, lambda x: NOT list_contains(gold, x))) = 0)::INT::DOUBLE},
    {'name': 'field_extraction', 's': CASE WHEN len(fs) > 0 THEN CASE WHEN invalid THEN 0 ELSE len(list_filter(fs, lambda f: list_filter(actual, lambda x: x[:3] = f) = list_filter(gold, lambda x: x[:3] = f))) END / len(fs) ELSE (NOT invalid)::INT END::DOUBLE},
    {'name': 'state_preserve', 's': CASE WHEN len(kept) > 0 THEN CASE WHEN invalid THEN 0 ELSE len(list_filter(kept, lambda f: list_filter("after", lambda x: x[:3] = f) = list_filter(before, lambda x: x[:3] = f))) END / len(kept) END::DOUBLE},
    {'name': 'negation', 's': NULL::DOUBLE}, {'name': 'tp', 's': len(hit)::DOUBLE}, {'name': 'fp', 's': (len(af) - len(hit))::DOUBLE}, {'name': 'fn', 's': (len(gf) - len(hit))::DOUBLE}]) AS m FROM more
)
SELECT m.name AS name, round(avg(m.s), 6) AS score, count(m.s) AS applicable, count(*) AS total FROM long GROUP BY 1
""")
def patch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and field confusion of the same cases: mean, where it applies, and of how many."""
    fields = ("click", "error", "purchase", "signup", "view")
    named = assertions.metrics(F.lit(None).cast("array<boolean>"), fields) | assertions.confusion()
    wanted = ("schema_valid", "exact_match", "hallucination_free", "field_extraction", "state_preserve", "negation", "tp", "fp", "fn")
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), named[n].alias("score")) for n in wanted]))
    long = _cases(spark, sf_dir).select(rows.alias("m")).select("m.*")
    return reports.mean_scores(long, ["name"]).select("name", F.round("score", 6).alias("score"), "applicable", "total")


SCENARIOS = (
    "single_filter", "multi_filter", "hard_soft_mix", "negation", "allergy_vs_flavor", "numeric_price", "numeric_size", "relative_numeric", "replace", "preserve_state", "clear", "reset", "sort",
    "query_text", "unmapped",
)
POOLS = intents.Pools(["gift", "party"], ["fancy", "quick"], {"price": [5, 10, 20], "size": [1, 2, 3]})


@register("WITH s(scenario) AS (VALUES " + ", ".join(f"('{s}')" for s in SCENARIOS) + """)
SELECT scenario, r_name AS grp, (r_regionkey + 2)::BIGINT AS planned, (r_regionkey + 2)::BIGINT AS sound, (r_regionkey + 2)::BIGINT AS gold_passes FROM s, region
""")
def planned_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans of every scenario: as many as wanted, each within the sample contract, and its gold change passes its own assertions."""
    scenarios = F.explode(F.array(*map(F.lit, SCENARIOS))).alias("scenario")
    quotas = table(spark, sf_dir, "region").select(F.col("r_name").alias("grp"), (F.col("r_regionkey") + 2).alias("quota"), scenarios)
    wanted = generation.expand_requests(quotas.withColumn("key", F.concat_ws("/", "grp", "scenario")), "key", "quota")
    plans = intents.plan_intents(wanted, CATALOG, POOLS)

    def sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for r in batch.to_pylist():
                state = r["state"] and json.loads(r["state"])
                record = {"id": r["request_id"], "scenario": r["scenario"], "tags": r["tags"], "input": {"current_search_state": state, "user_input": r["draft"]}}
                flags.append(not evaluation.sample_errors(record | {"expected": json.loads(r["expected"]), "assertions": json.loads(r["assertions"])}, CATALOG))
            yield pa.RecordBatch.from_arrays([batch["request_id"], pa.array(flags)], ["case_id", "sound"])

    judged = plans.mapInArrow(sound, "case_id string, sound boolean")
    replayed_ = plans.select(F.lit("gold").alias("run_id"), F.col("request_id").alias("case_id"), "state", "expected", "assertions", F.col("expected").alias("text"))
    scores = evaluation.score(replayed_, CATALOG).where("kind = 'assertion'").groupBy("case_id").agg((F.min("score") == 1).alias("passes"))
    parts = F.split("case_id", "[/:]")
    both = judged.join(scores, "case_id").withColumns({"grp": F.get(parts, F.lit(0)), "scenario": F.get(parts, F.lit(1))})
    return both.groupBy("scenario", "grp").agg(F.count("*").alias("planned"), F.count_if("sound").alias("sound"), F.count_if("passes").alias("gold_passes"))


@register("""
WITH rows AS (SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS asks, o_orderkey % 4 = 0 AS claims, o_orderkey % 5 = 0 AS names FROM orders)
SELECT k, 0.7::DOUBLE * asks::INT + 0.3::DOUBLE AS score, asks AND NOT claims AS passed, CASE WHEN names THEN '' ELSE 'start_time' END AS errors FROM rows
""")
def reply_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts and times of replies made from orders: coverage of an act, forbidden claims, the appointment's time in one of its forms."""
    k = F.col("k")
    start = F.make_timestamp_ntz(F.lit(2026), F.lit(3), 1 + (k % 3).cast("int"), 9 + (k % 12).cast("int"), F.lit(30), F.lit(0))
    now = F.lit("2026-03-01 08:00").cast("timestamp_ntz")
    rows = orders(spark, sf_dir).select("k", start.alias("start")).withColumn("forms", times.time_forms(F.col("start"), now))
    said = F.get("forms", (k % F.size("forms")).cast("int"))
    reply = F.concat(F.when(k % 3 == 0, "请问服务时长？").otherwise("您好。"), F.when(k % 4 == 0, "预约成功。").otherwise("谢谢。"), F.when(k % 5 == 0, said).otherwise("改天"))
    gold = F.parse_json(F.concat(F.lit('{"start_time":"'), F.date_format("start", times.STAMP), F.lit('"}')))
    act = lambda *a: F.array(*map(F.lit, a))
    none = F.array().cast("array<string>")
    rows = rows.select("k", reply.alias("reply"), gold.alias("gold"))
    judged = T.judge_reply(F.col("reply"), act("ask_for_duration"), act("claim_booking_success"), none)
    rows = rows.select("k", judged.alias("j"), appointments.reply_errors(F.col("reply"), F.col("gold"), act("start_time"), now)[1].alias("errors"))
    return rows.select("k", "j.score", "j.passed", F.array_join("errors", ",").alias("errors"))


@register("""
SELECT r_name AS name, length(r_name) + 1 AS bytes, sha256(r_name || chr(10)) AS sha256, CASE r_regionkey % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'changed' ELSE 'ok' END AS status FROM region
""")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of written files, large ones streamed, against a manifest of which some rows are wrong."""
    path = scratch(spark, "files") + "/parts"
    region = table(spark, sf_dir, "region")
    region.select("r_name", F.col("r_name").alias("value")).write.partitionBy("r_name").text(path)
    hashes = provenance.file_hashes(spark, path, one_value=7).where(F.col("path").rlike(r"\.txt$"))
    named = hashes.withColumn("name", F.regexp_extract("path", "r_name=([^/]+)", 1))
    right = F.sha2(F.concat("r_name", F.lit("\n")), 256)
    manifest = region.select(F.col("r_name").alias("name"), F.when(F.col("r_regionkey") % 3 == 1, F.lit("0")).otherwise(F.upper(right)).alias("sha256"))
    checked = provenance.verify_manifest(manifest, named.select(F.col("name").alias("path"), "sha256"))
    return checked.select("name", "status").join(named.select("name", "bytes", "sha256"), "name")


@register("""
SELECT r_name AS model, threads, r_name || '-' || threads AS key FROM region, (VALUES (1), (4), (8)) t(threads) WHERE NOT (r_regionkey % 2 = 0 AND threads = 4)
""")
def pending_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a benchmark grid without a result; the finished ones come from a stage that is built once."""
    region = table(spark, sf_dir, "region")
    root, key = scratch(spark, "stages"), provenance.cache_key({"tables": 1}, "done", {"threads": 4})
    build = lambda: region.where("r_regionkey % 2 = 0").select(F.col("r_name").alias("model"), F.lit(4).alias("threads"))
    provenance.cached_stage(spark, root, key, build)
    done = provenance.cached_stage(spark, root, key, lambda: region.limit(0).select(F.col("r_name").alias("model"), F.lit(0).alias("threads")))
    models = [r[0] for r in region.select("r_name").collect()]  # five regions
    cells = provenance.pending({"model": models, "threads": [1, 4, 8]}, done, spark)
    return cells.withColumn("key", F.concat_ws("-", "model", "threads"))


@register("""
SELECT lang, source, count(*) AS rows, sha256('{"lineage":{"base":' || to_json(lang) || ',"revision":' || to_json(source) || '},"parameters":{"bits":4,"group":[1,2]},"stage":"build"}') AS key
FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL
""")
def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content keys of a build stage for each language and source of the documents."""
    parts = table(spark, sf_dir, "documents").where("lang is not null and source is not null").groupBy("lang", "source").agg(F.count("*").alias("rows"))
    lineage = {"revision": F.col("source"), "base": F.col("lang")}
    parameters = {"group": F.array(F.lit(1), F.lit(2)), "bits": F.lit(4)}
    return parts.select("lang", "source", "rows", provenance.cache_keys(lineage, "build", parameters).alias("key"))


@register("""
SELECT source, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS part, lang, count(*) AS n FROM documents GROUP BY ALL
""")
def split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each part of a data set by source and language."""
    docs = table(spark, sf_dir, "documents")
    parts = {"train": docs.where("doc_id % 10 <> 0"), "validation": docs.where("doc_id % 10 = 0")}
    return sinks.dataset_manifest(parts, "doc_id", ["source", "lang"]).select("source", "part", "lang", "n")


@register("""
WITH n AS (SELECT lang, count(*) AS n, greatest(1, floor(count(*) * 0.15)) AS floor_, count(*) * 0.15 % 1 AS rest FROM documents GROUP BY lang),
t AS (SELECT greatest(0, round_even(sum(n) * 0.15, 0) - sum(floor_)) AS extra FROM n)
SELECT lang, n, (floor_ + CASE WHEN row_number() OVER (ORDER BY round(rest, 9) DESC, lang DESC) <= (SELECT extra FROM t) THEN 1 ELSE 0 END)::BIGINT AS validation FROM n
""")
def remainder_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows of each language by largest remainder; one row a language reaches the driver."""
    counts = table(spark, sf_dir, "documents").groupBy("lang").count()
    sizes = {r.lang: r["count"] for r in counts.collect()}
    quotas = ranking.remainder_split(sizes, 0.15)
    return spark.createDataFrame([(k, sizes[k], quotas[k]) for k in sizes], "lang string, n long, validation long")


@register("""
SELECT event_type, arg_max(k, (avg_value, -k)) AS best FROM (SELECT event_type, (props::JSON ->> '$.k')::BIGINT AS k, round(avg(value), 9) AS avg_value FROM events GROUP BY ALL) GROUP BY event_type
""")
def best_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameter with the best mean of each type, the smallest on ties."""
    runs = table(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.round(F.avg("value"), 9).alias("score"))
    return ranking.best_parameter(runs, ["event_type"], "k", "score").select("event_type", F.col("k").alias("best"))


@register("""
WITH j AS (SELECT l_orderkey % 4 AS target, l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber <= 2 THEN 'validation' ELSE 'train' END AS split FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY target, split ORDER BY sha256('pairs:' || target || ':' || split || ':' || id), id) AS r FROM j)
SELECT target, split, count(*) AS n, sum(id)::BIGINT AS ids FROM r WHERE r <= CASE WHEN split = 'validation' THEN 10 ELSE 40 END GROUP BY ALL
""")
def preference_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty pairs of each target, a fifth of them for validation, in hash order."""
    lines = table(spark, sf_dir, "lineitem")
    pairs = lines.select((F.col("l_orderkey") % 4).alias("target"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_linenumber") <= 2, "validation").otherwise("train").alias("split"), F.lit(50).alias("wanted"))
    return ranking.select_pairs(pairs, "id", 0.2, "pairs").groupBy("target", "split").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@register("""
SELECT c_custkey AS k, 'Rules' || chr(10) || 'Catalog: ' || 'x' || chr(10) || 'State: ' || coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'null') AS system, c_name AS said,
  '<|im_start|>system' || chr(10) || 'Rules' || chr(10) || 'Catalog: x' || chr(10) || 'State: ' || coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'null') || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || c_name || '<|im_end|>' || chr(10) AS text
FROM customer
""")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages for each customer and the calibration text made of them."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("state"), "c_name")
    done = generation.render_prompts(rows, "Rules\nCatalog: x", "state", "c_name")
    message = lambda k: F.get("messages", F.lit(k))["content"]
    return done.select("k", message(0).alias("system"), message(1).alias("said"), generation.render_template(F.col("messages")).alias("text"))


@register("""
SELECT o_orderkey AS k, '{"a":' || (o_orderkey % 4) || ',"b":null,"c":"' || o_orderstatus || '"}' AS json, sha256('["' || o_orderstatus || '","{}","null"]') AS signature,
  CASE WHEN o_orderkey % 3 = 0 THEN 12.5 WHEN o_orderkey % 3 = 1 THEN 7 END::DOUBLE AS first_number, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round((o_orderkey % 7) * 1000.0 / (o_orderkey % 5), 6) END::DOUBLE AS tokens_per_s,
  'key *** of ' || o_orderstatus AS shown FROM orders
""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON, semantic signatures, numbers of a text, throughput and redaction."""
    k = F.col("k")
    text = F.when(k % 3 == 0, "v1.2.3 of 12.5 kg").when(k % 3 == 1, "7 pieces, 3 more").otherwise("none")
    return orders(spark, sf_dir).select(
        "k",
        T.canonical_json({"c": F.col("o_orderstatus"), "b": F.lit(None).cast("string"), "a": k % 4}).alias("json"),
        T.signature(F.col("o_orderstatus"), F.lit("{}"), F.lit(None).cast("string")).alias("signature"),
        F.get(T.numbers_in(text), F.lit(0)).cast("double").alias("first_number"),
        F.round(units.throughput(k % 7, k % 5), 6).alias("tokens_per_s"),
        T.redact(F.concat(F.lit("key s3cr3t of "), "o_orderstatus"), "s3cr3t").alias("shown"),
    )


@register("SELECT user_id, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY user_id")
def resumed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream that was stopped half way and goes on from its checkpoint when the rest has come."""
    events = table(spark, sf_dir, "events")
    source, state = scratch(spark, "arrivals") + "/in", scratch(spark, "state")
    events.where("event_id % 2 = 0").write.parquet(source)
    stream.replay_counts(spark, source, "user_id", "event_id", state)
    events.where("event_id % 2 <> 0").write.mode("append").parquet(source)
    return stream.replay_counts(spark, source, "user_id", "event_id", state)


@register("SELECT event_id, event_type FROM events")
def first_of_repeated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, though every file comes twice; the stream forgets ids that are older than its bound."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    source = scratch(spark, "twice") + "/in"
    events.unionByName(events).write.parquet(source)
    return stream.run_to_table(stream.first_seen(stream.read_stream(spark, source, files=1000), ["event_id"], "ts", "3650 days"), "append").select("event_id", "event_type")


@register("""
WITH v AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS confirmation, o_orderkey % 3 = 0 AS unrelated, o_orderkey % 5 = 0 AS calls, o_orderkey % 7 = 0 AS multi FROM orders)
SELECT label, count(*) AS n, round(avg((k % 10) / 10.0::DOUBLE), 6) AS score FROM (
  SELECT k, unnest(list_filter([CASE WHEN confirmation THEN 'confirmation' END, CASE WHEN NOT confirmation THEN 'missing_information' END, CASE WHEN multi THEN 'multi_turn' END,
    CASE WHEN calls THEN 'tool_call' END, CASE WHEN multi THEN 'tool_result' END, CASE WHEN unrelated THEN 'unrelated' END], lambda x: x IS NOT NULL)) AS label FROM v) GROUP BY label
""")
def labelled_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean score by the six scenario labels of appointment samples made from orders."""
    k = F.col("k")
    yes = lambda x: F.when(x, "true").otherwise("false")
    body = F.concat(
        F.lit('{"conversation_kind":"'), F.when(k % 7 == 0, "multi_turn").otherwise("single_turn"), F.lit('","input":{"history":['), F.when(k % 7 == 0, '{"role":"tool","tool_call_id":"a","content":"{}"}').otherwise(""),
        F.lit(']},"expected":{"action":"'), F.when(k % 5 == 0, "tool_call").otherwise("final"), F.lit('","confirmation":'), yes(k % 2 == 0), F.lit(',"unrelated":'), yes(k % 3 == 0),
        F.lit(',"info_complete":'), yes(k % 2 == 0), F.lit(',"missing_info":["start_time"]}}'),
    )
    rows = orders(spark, sf_dir).select("k", F.parse_json(body).alias("v"))
    out = reports.slices(rows.withColumn("labels", records.scenario_labels(F.col("v"))), F.col("labels"), {"task": (F.col("k") % 10) / 10.0})
    return out.select("label", F.col("applicable").alias("n"), F.round("score", 6).alias("score"))


@register("""
SELECT o_orderkey AS k, array_to_string(list_filter([CASE WHEN o_orderkey % 13 = 0 THEN 'id' END, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'steps' END, CASE WHEN o_orderkey % 5 = 0 THEN 'results' END, CASE WHEN o_orderkey % 5 = 0 THEN 'calls' END,
  CASE WHEN o_orderkey % 7 = 0 THEN 'tags' END, CASE WHEN o_orderkey % 11 = 0 THEN 'dpo_targets' END], lambda x: x IS NOT NULL), ',') AS errors FROM orders
""")
def raw_sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with a tool exchange, some with a rule broken: a missing id, a wrong step, a foreign result, two categories, a target that doesn't suit."""
    k = F.col("k")
    pick = lambda ok, yes, no: F.when(ok, yes).otherwise(no)
    call = '{"role":"assistant","content":null,"tool_calls":[{"id":"c1","type":"function","function":{"name":"find","arguments":"{}"}}]}'
    body = F.concat(
        F.lit('{"id":'), pick(k % 13 == 0, '""', '"r"'), F.lit(',"output_kind":"final","conversation_kind":"multi_turn","tags":["确认"'), pick(k % 7 == 0, ',"无关"', ""),
        F.lit('],"input":{"history":[{"role":"user","content":"hi"},'), pick((k % 2 == 0) & (k % 3 == 0), '{"role":"user","content":"again"},', ""), F.lit(call + ',{"role":"tool","tool_call_id":"'),
        pick(k % 5 == 0, "c2", "c1"), F.lit('","content":"{}"},{"role":"assistant","content":"done"}],"user_input":"thanks"},"expected":{"action":"final"},"dpo_targets":['), pick(k % 11 == 0, '"P7"', '"P5"'), F.lit("]}"),
    )
    # a scan is split by bytes, and keys are few bytes for much work, so they are dealt over all tasks
    keys = orders(spark, sf_dir).select("k").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k")
    rows = keys.select("k", F.parse_json(body).alias("value"))
    # an exchange whose result names another call leaves its own call open
    return records.scan(rows, raw=True).select("k", F.array_join("errors", ",").alias("errors"))


@register("SELECT c_custkey::VARCHAR AS case_id, CASE WHEN c_custkey % 9 = 0 THEN 'failed' WHEN c_custkey % 4 > 2 THEN 'too_many_calls' ELSE 'completed' END AS status, CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE least(c_custkey % 4, 2) END::INT AS calls FROM customer")
def tool_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded loop of tool calls for each customer: as many as its key asks for, two at most."""
    from ..sources.tool_loop import run_all

    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("case_id"), F.col("c_custkey").cast("string").alias("text"))
    return run_all(asked, _ask, {"look": _look}, 2, 8).select("case_id", "status", "calls")


def _ask(messages: list[dict[str, Any]]) -> str:
    """Asks for the tool as often as the key's remainder by four says; every ninth key for one that nobody knows."""
    key = int(messages[0]["content"])
    told = sum(m["role"] == "tool" for m in messages)
    if key % 9 == 0:
        return '{"action":"tool_call","tool_name":"nothing","arguments":{}}'
    return compact({"action": "tool_call", "tool_name": "look", "arguments": {"key": key}}) if told < key % 4 else '{"action":"final"}'


def _look(arguments: Mapping[str, Any]) -> Mapping[str, Any]:
    return {"found": arguments["key"]}


@register("""
WITH m AS (SELECT 'm' || r AS model_id, r % 5 = 0 AS is_anchor FROM range(10) t(r))
SELECT m.model_id, is_anchor, count(event_id) AS events, round(coalesce(sum(value), 0), 2) AS value FROM m LEFT JOIN events ON model_id = 'm' || (user_id % 12) GROUP BY ALL
""")
def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of eight targets and two anchors beside the events of each model; events of unknown models count for none."""
    base = {"family": "f", "variant": "v", "base_model": "b", "base_revision": "1", "artifact_path": "a", "manifest_path": "m"}
    models = [base | {"model_id": f"m{k}", "size_b": k, "stage": "sft", "artifact_kind": "f16" if k % 5 == 0 else "q4_k_m", "is_anchor": k % 5 == 0} for k in range(10)]
    found = provenance.model_registry(spark, {"models": models})
    used = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("m"), F.col("user_id") % 12).alias("model_id")).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return found.join(used, "model_id", "left").select("model_id", "is_anchor", F.coalesce("events", F.lit(0).cast("long")).alias("events"), F.round(F.coalesce("value", F.lit(0.0)), 2).alias("value"))


@register("""
SELECT s_suppkey AS id, s_name AS name, c_custkey AS other FROM (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS r FROM supplier)
JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r FROM customer WHERE c_custkey <= (SELECT count(*) FROM supplier) + (SELECT min(c_custkey) FROM customer) - 1) USING (r)
""")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers beside as many customers, the k-th with the k-th."""
    suppliers = table(spark, sf_dir, "supplier")
    customers = table(spark, sf_dir, "customer")
    n, first = suppliers.count(), customers.agg(F.min("c_custkey")).first()[0]
    some = customers.where(F.col("c_custkey") <= n + first - 1).select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("other"))
    return matching.positional_join(suppliers.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), some, "id")


@register("""
WITH h AS (SELECT o_orderkey AS k, (('0x' || substr(sha256(o_orderkey::VARCHAR), 57, 8))::BIGINT % 8)::INT AS h, o_orderkey % 3 = 0 AS taken FROM orders)
SELECT k, chr(97 + CASE WHEN taken THEN (h + 1) % 8 ELSE h END) AS chosen FROM h
""")
def unused_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of eight letters by the key's hash, the next one where that is taken."""
    letters = "abcdefgh"
    own = F.get(F.array(*map(F.lit, letters)), T.hash_choice(F.col("k").cast("string"), 8))
    used = F.when(F.col("k") % 3 == 0, F.array(own)).otherwise(F.array().cast("array<string>"))
    return orders(spark, sf_dir).select("k", T.pick_unused(F.col("k").cast("string"), list(letters), used).alias("chosen"))


@register("""
SELECT k, CASE k % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 1.0 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 ELSE 0.25 END::DOUBLE AS likeness FROM (SELECT o_orderkey AS k FROM orders)
""")
def preference_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferences in other widths and words, other meanings, refusals, and those that the embeddings decide."""
    from ..functions.vectors import preference_similarity

    k = F.col("k")
    pairs = [("ＡＢＣ 精油", "abc精油"), ("按脚", "足疗！"), ("泰式", "足底"), ("不喜欢热石", "热石"), ("热石", "冷敷")]
    side = lambda n: F.get(F.array(*[F.lit(p[n]) for p in pairs]), (k % 5).cast("int"))
    rows = orders(spark, sf_dir).select("k", side(0).alias("a"), side(1).alias("b"))
    return rows.select("k", preference_similarity(F.col("a"), F.col("b"), F.lit(0.25)).alias("likeness"))


@register("""
SELECT conv_id, count(*) + 1 + (conv_id % 2 = 0)::INT AS messages, 'R' || chr(10) || 'Time: 2026-03-01' || chr(10) || 'Tools: [{"function":{"description":"d","name":"look"},"type":"function"}]' AS system,
  coalesce(string_agg(k::VARCHAR, ',' ORDER BY k) FILTER (CASE WHEN k % 2 = 0 THEN role <> 'user' ELSE role <> 'assistant' END), '') AS misplaced
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations) GROUP BY conv_id
""")
def appointment_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with time, tools and history of each conversation, and the turns that stand where they may not."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("h"))
    rows = turns.withColumns({"now": F.lit("2026-03-01"), "said": F.when(F.col("conv_id") % 2 == 0, "next").otherwise(" ")})
    done = generation.render_appointment_prompts(rows, "R", {"look": {"description": "d"}}, "now", "h", "said")
    names = {"user": "human", "assistant": "gpt"}
    speaker = lambda r: F.coalesce(*[F.when(r == a, b) for a, b in names.items()], r)
    chats = F.transform("h", lambda t: F.struct(speaker(t["role"]).alias("from"), t["content"].alias("value")))
    return done.select("conv_id", F.size("messages").cast("long").alias("messages"), F.get("messages", F.lit(0))["content"].alias("system"), F.array_join(generation.turn_errors(chats).cast("array<string>"), ",").alias("misplaced"))


@register("""
SELECT s_name AS name, 'g' || (s_suppkey % 2) AS grp, 2 AS windows, '2026-02-01 0' || (8 + s_suppkey % 2) || ':00' AS opens, '2026-02-03 12:00' AS ends FROM supplier WHERE s_suppkey <= 40
""")
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar fixture of forty suppliers, moved so that its first day is another one; windows apart and in order."""
    names = [(r.s_suppkey, r.s_name) for r in table(spark, sf_dir, "supplier").where("s_suppkey <= 40").collect()]
    windows = lambda k: [{"start": "2026-01-07 10:00", "end": "2026-01-07 12:00"}, {"start": f"2026-01-05 0{8 + k % 2}:00", "end": "2026-01-05 12:00"}]
    found = readers.calendar({"providers": [{"name": n, "group": f"g{k % 2}", "skills": ["s"], "windows": windows(k)} for k, n in names]}, spark, "2026-02-01")
    stamp = lambda c: F.date_format(c, times.STAMP)
    return found.select("name", "grp", F.size("windows").alias("windows"), stamp(F.get("windows", F.lit(0))["start"]).alias("opens"), stamp(F.get("windows", F.lit(1))["end"]).alias("ends"))


@register("SELECT 'run-' || r_regionkey || 'b' AS run_id, r_regionkey::DOUBLE AS size, r_name AS model, CASE WHEN r_regionkey % 2 = 0 THEN r_regionkey / 4.0 END::DOUBLE AS score FROM region")
def scorecard_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorecards of run folders; a score that isn't finite was written as null, the run's name and size come from the folder."""
    path = scratch(spark, "cards")
    for r in table(spark, sf_dir, "region").collect():  # five runs
        card = spark.createDataFrame([(r.r_name, r.r_regionkey / 4.0 if r.r_regionkey % 2 == 0 else float("nan"))], "model string, score double")
        sinks.write_report(card, f"{path}/run-{r.r_regionkey}b")
    cards = readers.scorecards(spark, f"{path}/run-*/*.txt", "model string, score double")
    return cards.select("run_id", "size", "model", "score")


@register("SELECT 'r' || (c_custkey % 3) AS run_id, c_custkey::VARCHAR AS case_id, c_name AS text FROM customer")
def prediction_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as JSON lines, their run named in the row or else by the folder."""
    path = scratch(spark, "predictions")
    customers = table(spark, sf_dir, "customer").withColumn("case_id", F.col("c_custkey").cast("string"))
    for n in range(3):
        run = F.when(F.col("c_custkey") % 2 == 0, F.lit(f"r{n}"))
        rows = customers.where(F.col("c_custkey") % 3 == n).select(run.alias("run_id"), "case_id", F.col("c_name").alias("text"))
        rows.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/r{n}")
    return readers.predictions(spark, f"{path}/*/*.txt")


@register("""
SELECT n_nationkey::VARCHAR AS session, 3::BIGINT AS turns, CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 2 END::BIGINT AS committed, 'o_orderstatus:=[' || CASE WHEN n_nationkey % 2 = 0 THEN 'p' ELSE 'o' END || ']' AS filter FROM nation
""")
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State by session from a stream of changes: a broken change leaves the state as it was."""
    from ..streaming import session_state

    wanted = lambda code: _change(F.array(_condition("status", "in", f'"{code}"')), F.lit(None).cast("string"), F.array().cast("array<string>"), F.lit(False))
    last = F.when(F.col("n_nationkey") % 2 == 0, wanted("p")).otherwise(F.lit('{"broken"'))
    turn = lambda seq, text: F.struct(F.lit(seq).cast("long").alias("seq"), text.alias("text"))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("session"), F.explode(F.array(turn(1, wanted("f")), turn(2, wanted("o")), turn(3, last))).alias("t"))
    source = scratch(spark, "turns") + "/in"
    rows.select("session", "t.seq", "t.text").repartition(2, "session").write.parquet(source)
    done = stream.run_to_table(session_state.fold_stream(stream.read_stream(spark, source, files=1000), CATALOG, "USD"), "append")
    return done.groupBy("session").agg(F.count("*").alias("turns"), F.count_if("committed").alias("committed"), F.max_by("filter", F.when(F.col("committed"), F.col("seq"))).alias("filter"))


@register("""
SELECT string_agg(line, chr(10) ORDER BY r_name) AS lines, '| model | score |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_name || ' | ' || coalesce(score::VARCHAR, 'n/a') || ' |', chr(10) ORDER BY r_name) AS markdown
FROM (SELECT r_name, score, r_name || ': ' || coalesce(printf('%.1f%%', score * 100), 'n/a') AS line FROM (SELECT r_name, CASE WHEN r_regionkey % 2 = 0 THEN r_regionkey / 4.0 END::DOUBLE AS score FROM region))
""")
def report_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorecard as text and as a Markdown table; what doesn't apply reads n/a."""
    scores = table(spark, sf_dir, "region").select(F.col("r_name").alias("metric"), F.when(F.col("r_regionkey") % 2 == 0, F.col("r_regionkey") / 4.0).alias("score"))
    lines = reports.scorecard_lines(scores).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("metric", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    return lines.crossJoin(reports.markdown_table(scores.withColumnRenamed("metric", "model"), ["model", "score"], "model"))  # one row each


@register("""
SELECT o_orderkey AS k, round((1 + (o_orderkey % 2 = 0)::INT + 1 + (o_orderkey % 3 > 0)::INT + 1 + 1 + 0.5) / 7, 6)::DOUBLE AS score FROM orders
""")
def call_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls against a gold one: action, tool, four arguments and the preferences' F1."""
    k = F.col("k")
    call = lambda tool, start: F.parse_json(F.concat(F.lit('{"action":"tool_call","tool_name":"'), tool, F.lit('","arguments":{"technician_name":null,"start_time":"'), start, F.lit('","duration_minutes":60.0,"gender_preference":null}}')))
    rows = orders(spark, sf_dir).select("k", call(F.when(k % 2 == 0, "find").otherwise("other"), F.when(k % 3 > 0, "10:00").otherwise("11:00")).alias("a"), F.lit(None).alias("n"))
    gold = F.parse_json(F.lit('{"action":"tool_call","tool_name":"find","arguments":{"technician_name":null,"start_time":"10:00","duration_minutes":60,"gender_preference":null}}'))
    return rows.select("k", F.round(appointments.call_score(F.col("a"), gold, F.lit(0.5)), 6).alias("score"))


@register("""
WITH r AS (SELECT o_orderkey AS k, o_orderstatus AS s, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS r FROM orders)
SELECT s AS grp, choice, count(*) AS n FROM (SELECT s, CASE WHEN r <= 6 THEN 'b' ELSE 'any' END AS choice FROM r WHERE r <= 6) GROUP BY ALL
""")
def balanced_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six rows of each group all take the choice that was never used, the other having been used six times before."""
    rows = orders(spark, sf_dir).select("k", F.col("o_orderstatus").alias("grp"))
    used = rows.select("grp").distinct().select("grp", F.lit("a").alias("choice"), F.lit(6).alias("n"))
    done = generation.least_used(rows, "grp", "k", ["a", "b"], used, "s")
    first = ranking.top_k(done, ["grp"], [F.col("k")], 6)
    return first.groupBy("grp", "choice").agg(F.count("*").alias("n"))


@register("SELECT conv_id, count(*) AS turns, string_agg(CASE WHEN k % 2 = 0 THEN 'human' ELSE 'gpt' END, ',' ORDER BY k) AS speakers, 'S' AS system FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations) GROUP BY conv_id HAVING count(*) % 2 = 0")
def chat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of even length as training rows, every other turn the model's."""
    listed = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t")).where(F.size("t") % 2 == 0)
    message = lambda role, text: F.struct(role.alias("role"), text.alias("content"))
    turns = F.transform("t", lambda x, k: message(F.when(k % 2 == 0, "user").otherwise("assistant"), F.coalesce(x["text"], F.lit(""))))
    rows = listed.select("conv_id", F.concat(F.array(message(F.lit("system"), F.lit("S"))), turns).alias("m"))
    done = generation.sharegpt(rows, "m")
    return done.select("conv_id", F.size("conversations").cast("long").alias("turns"), F.array_join(F.transform("conversations", lambda c: c["from"]), ",").alias("speakers"), "system")
