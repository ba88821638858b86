"""Queries of the appointment domain and of generation, on answers made from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import appointments as A
from ..operators import generation
from ..sources.strict_json import strict_object
from . import contract
from .catalog import register, table

#: A final answer as JSON text, from an order: some fields wrong by the order's key.
_ANSWER_SQL = """
answers AS (
  SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d,
    '{"action":"' || CASE WHEN o_orderkey % 11 = 0 THEN 'done' ELSE 'final' END || '","gender_preference":null,"technician_gender":' ||
    CASE WHEN o_orderkey % 7 = 0 THEN '"other"' ELSE '"female"' END || ',"start_time":"' || strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':00","duration_minutes":' ||
    CASE o_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN '60.0' WHEN 2 THEN '-5' ELSE '60' END || ',"preferences":' || CASE WHEN o_orderkey % 3 = 0 THEN '["a","a"]' ELSE '[]' END ||
    ',"technician_name":"N' || (o_custkey % 4) || '","technician_status":"available","confirmation":false,"info_complete":true,"unrelated":false,"missing_info":[],"reply_type":"confirm_available","reply":' ||
    CASE WHEN o_orderkey % 13 = 0 THEN '"{x}"' ELSE '"N1, 60"' END || '}' AS body
  FROM orders
)
"""


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cell = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    body = cell(
        '{"action":"', F.when(k % 11 == 0, "done").otherwise("final"), '","gender_preference":null,"technician_gender":', F.when(k % 7 == 0, '"other"').otherwise('"female"'),
        ',"start_time":"', day, " ", F.lpad((k % 24).cast("string"), 2, "0"), ':00","duration_minutes":',
        F.when(k % 5 == 0, "true").when(k % 5 == 1, "60.0").when(k % 5 == 2, "-5").otherwise("60"), ',"preferences":', F.when(k % 3 == 0, '["a","a"]').otherwise("[]"),
        ',"technician_name":"N', (F.col("o_custkey") % 4).cast("string"), '","technician_status":"available","confirmation":false,"info_complete":true,"unrelated":false,"missing_info":[],"reply_type":"confirm_available","reply":',
        F.when(k % 13 == 0, '"{x}"').otherwise('"N1, 60"'), "}",
    )
    return table(spark, sf_dir, "orders").select(k.alias("k"), "o_custkey", body.alias("body")).withColumn("v", strict_object(F.col("body")))


@register("WITH " + _ANSWER_SQL + """
SELECT k, array_to_string(list_filter([CASE WHEN k % 11 = 0 THEN 'action' END, CASE WHEN k % 7 = 0 THEN 'technician_gender' END, CASE WHEN k % 5 < 3 THEN 'duration_minutes' END,
  CASE WHEN k % 3 = 0 THEN 'preferences' END, CASE WHEN k % 13 = 0 THEN 'reply' END], lambda x: x IS NOT NULL), ',') AS errors FROM answers
""")
def output_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("k", F.array_join(A.output_errors(F.col("v")), ",").alias("errors"))


@register("WITH " + _ANSWER_SQL + """
SELECT k, k % 5 >= 3 AS sixty, k % 24 BETWEEN 9 AND 20 AS open, (body::JSON ->> '$.technician_name') = 'N1' AS is_n1, true AS in_schema, false AS malformed FROM answers
""")
def expression_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    asked = {"sixty": "duration_minutes == 60", "open": "within_business_hours", "is_n1": "technician_name == N1", "in_schema": "no_field_outside_schema", "malformed": "nonsense"}
    return _answers(spark, sf_dir).select("k", *[A.expression_holds(v, F.col("body"), F.lit(e)).alias(n) for n, e in asked.items()])


@register("WITH " + _ANSWER_SQL + """
, judged AS (
  SELECT k, body::JSON ->> '$.technician_name' AS n, ((k % 11 <> 0)::INT + (k % 7 <> 0)::INT + (k % 5 IN (1, 3, 4))::INT + ((body::JSON ->> '$.technician_name') = 'N1')::INT + 7) / 11.0::DOUBLE AS exact FROM answers
)
SELECT k, round(0.7 * ((exact * 11 + CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END) / 12) + 0.3 * (1 + 0.5 + 1) / 3, 6)::DOUBLE AS score FROM judged
""")
def final_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers against a gold one that differs in the fields that are wrong."""
    answers = _answers(spark, sf_dir)
    start = A.field(F.col("v"), "start_time", "string")
    gold = F.concat(
        F.lit('{"action":"final","gender_preference":null,"technician_gender":"female","start_time":"'), start,
        F.lit('","duration_minutes":60,"preferences":[],"technician_name":"N1","technician_status":"available","confirmation":false,"info_complete":true,"unrelated":false,"missing_info":[],"reply_type":"confirm_available","reply":"x"}'),
    )
    judged = answers.withColumn("gold", F.parse_json(gold))
    preference = F.when(F.col("k") % 3 == 0, 0.0).otherwise(1.0)
    score = A.final_score(F.col("v"), F.col("gold"), preference, F.lit(0.5), F.lit(1.0))
    return judged.select("k", F.round(score, 6).alias("score"))


@register("WITH " + _ANSWER_SQL + """
SELECT k, CASE WHEN (body::JSON ->> '$.technician_name') NOT IN ('N1', 'N2') THEN body::JSON ->> '$.technician_name' END AS ungrounded FROM answers
""")
def entity_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return _answers(spark, sf_dir).select("k", A.ungrounded_name(F.col("v"), none, F.array(F.lit("N1")), none, F.array(F.lit("N2"))).alias("ungrounded"))


@register("""
WITH rows AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'tool_call' ELSE 'final' END AS action, CASE WHEN o_orderkey % 3 > 0 THEN 60 END AS dur, CASE WHEN o_orderkey % 5 > 0 THEN 1 END AS has_start, o_orderkey % 7 = 0 AS conf, o_orderkey % 11 = 0 AS unrel FROM orders)
SELECT k, 'shift' AS target FROM rows WHERE dur IS NOT NULL OR has_start IS NOT NULL
UNION ALL SELECT k, 'name' FROM rows UNION ALL SELECT k, 'flip' FROM rows
UNION ALL SELECT k, 'confirm' FROM rows WHERE conf OR unrel UNION ALL SELECT k, 'fill' FROM rows WHERE dur IS NULL OR has_start IS NULL
""")
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    slots = F.struct(
        F.when(k % 2 == 0, "tool_call").otherwise("final").alias("action"), F.when(k % 3 > 0, 60).alias("duration_minutes"), F.when(k % 5 > 0, F.col("o_orderdate")).alias("start_time"),
        F.concat(F.lit("N"), (F.col("o_custkey") % 4).cast("string")).alias("technician_name"), (k % 7 == 0).alias("confirmation"), (k % 11 == 0).alias("unrelated"),
    )
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), slots.alias("chosen"), F.col("o_orderdate").alias("now"))
    variants = A.perturbations(F.col("chosen.action"), F.col("chosen"), F.col("now"), ["N0", "N1", "N2", "N3", "N4"], F.col("k").cast("string"))
    return A.pairs(rows, variants, "chosen").select("k", "target")


@register("""
SELECT r_name || ':plan-' || lpad(n::VARCHAR, 6, '0') AS request_id, r_name FROM (SELECT r_name, unnest(range(1, r_regionkey * 3 + 1)) AS n FROM region)
""")
def expand_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotas = table(spark, sf_dir, "region").select("r_name", (F.col("r_regionkey") * 3).alias("quota"))
    return generation.expand_requests(quotas, "r_name", "quota").select("request_id", "r_name")


@register("""
SELECT conv_part AS part, longest, most, longest <= most AS passed FROM (
  SELECT 'text' AS conv_part, max(len(regexp_extract_all(text, '\\S+')))::BIGINT AS longest, 100 AS most FROM conversations
  UNION ALL SELECT 'chars', max(length(text))::BIGINT, 1000000 FROM conversations)
""")
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"text": generation.word_count(F.col("text")), "chars": F.char_length("text")}
    return generation.token_budget(table(spark, sf_dir, "conversations"), parts, {"text": 100, "chars": 1_000_000})


@register("""
SELECT conv_id, array_to_string(list_filter([CASE WHEN NOT bool_or(role = 'assistant') THEN 'assistant' END, CASE WHEN bool_or(contains(text, '<think>')) THEN 'thinking' END], lambda x: x IS NOT NULL), ',') AS errors FROM conversations GROUP BY conv_id
""")
def training_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    who = F.when(F.col("role") == "assistant", "gpt").otherwise("human")
    chats = turns.groupBy("conv_id").agg(F.collect_list(F.struct(who.alias("from"), F.col("text").alias("value"))).alias("c"))
    return chats.select("conv_id", F.array_join(generation.training_errors(F.col("c")), ",").alias("errors"))


@register("""
SELECT p_partkey, p_type AS code, regexp_matches(lower(p_name), '(^|[^a-z0-9])' || CASE p_type WHEN 'SMALL' THEN '(small|ring)' ELSE lower(p_type) END || '([^a-z0-9]|$)') AS grounded FROM part
""")
def value_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = spark.createDataFrame([("kind", c, c.title(), ["ring"] if c == "SMALL" else []) for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")], "field string, code string, label string, aliases array<string>")
    gold = table(spark, sf_dir, "part").select("p_partkey", F.lit("kind").alias("field"), F.col("p_type").alias("code"), "p_name")
    return generation.grounded(gold, values, "p_name").select("p_partkey", "code", "grounded")


#: The rules of the records below, as a contract file has them.
RECORD_CONTRACT = contract.load_contract("""
{"business_hours": {"open": "09:00", "close": "21:00"},
 "fields": {"gender_preference": {"allowed_values": ["female", "male", null]}, "technician_gender": {"allowed_values": ["female", "male", null]},
  "technician_status": {"allowed_values": ["not_checked", "available", "no_match"]}, "reply_type": {"allowed_values": ["confirm_available", "inform_no_match"]}},
 "completion": {"missing_slot_order": ["start_time", "duration_minutes"]},
 "reply": {"allowed_acts": ["request_confirmation"], "allowed_required_fields": ["start_time"]},
 "tools": {"find": {"arguments": ["technician_name", "start_time", "duration_minutes", "gender_preference", "preferences"]}}}
""")


@register("""
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':00' AS start, 30 + (o_orderkey % 3) * 30 AS minutes,
         o_orderkey % 24 BETWEEN 9 AND 20 AS open, o_orderkey % 5 <> 0 AS told, o_orderkey % 37 <> 0 AS final FROM orders
), w AS (
  SELECT *, row_number() OVER p + (NOT told OR k % 13 = 0)::INT AS users, last_value(CASE WHEN told THEN k END IGNORE NULLS) OVER p AS at_,
         bool_or(told AND k % 17 = 0) OVER p AS bad_tool, bool_or(told AND k % 17 <> 0 AND NOT open) OVER p AS bad_values
  FROM o WINDOW p AS (PARTITION BY c ORDER BY k)
), x AS (SELECT w.*, e.k IS NOT NULL AND e.start = w.start AND e.minutes = w.minutes AND e.k % 7 <> 0 AS supported FROM w LEFT JOIN o e ON e.k = w.at_)
SELECT k, array_to_string(list_filter([
  CASE WHEN bad_tool THEN 'tool' END, CASE WHEN bad_values THEN 'tool_values' END, CASE WHEN k % 19 = 0 THEN 'current_time' END, CASE WHEN k % 23 = 0 THEN 'available_tools' END,
  CASE WHEN k % 13 = 0 THEN 'user_input' END, CASE WHEN k % 2 = 1 AND NOT open THEN 'state_values' END, CASE WHEN k % 2 = 1 AND told AND k % 11 = 0 THEN 'state_follows' END,
  CASE WHEN users < 2 THEN 'conversation_kind' END, CASE WHEN NOT final THEN 'output' END, CASE WHEN final AND NOT open THEN 'values' END,
  CASE WHEN final AND k % 43 <> 0 AND NOT supported THEN 'supported' END, CASE WHEN final AND k % 43 = 0 THEN 'reply_type' END, CASE WHEN final AND k % 41 = 0 THEN 'confirmation' END,
  CASE WHEN k % 31 = 0 THEN 'acts' END, CASE WHEN k % 29 = 0 THEN 'references' END], lambda e: e IS NOT NULL), ',') AS errors
FROM x
""")
def record_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as one conversation: each is asked for, mostly looked up, and answered; an answer is held against the latest lookup before it."""
    k = F.col("o_orderkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    start = text(F.date_format("o_orderdate", "yyyy-MM-dd"), " ", F.lpad((k % 24).cast("string"), 2, "0"), ":00")
    minutes = 30 + (k % 3) * 30
    name = text("N", F.col("o_custkey") % 4)
    plan = lambda length: text('"gender_preference":null,"start_time":"', start, '","duration_minutes":', length, ',"preferences":[],"technician_name":"', name, '"')
    orders = table(spark, sf_dir, "orders")
    told = k % 5 != 0
    turn = lambda at, role, call, tool, content: F.struct((k * 4 + at).alias("turn"), F.lit(role).alias("role"), call.alias("call_id"), tool.alias("tool"), content.alias("content"))
    none = F.lit(None).cast("string")
    result = text('{"mode":"specific","status":"available","requested_technician":"', name, '","technician":{"gender":"female","name":"', F.when(k % 7 == 0, F.lit("X")).otherwise(name), '"}}')
    call_id = text("c", k % 3)
    asked = turn(0, "user", none, none, F.lit("please"))
    looked = [turn(1, "assistant", call_id, F.when(k % 17 == 0, "seek").otherwise("find"), text("{", plan(minutes), "}")), turn(2, "tool", call_id, none, result)]
    turns = orders.select(F.col("o_custkey").alias("conv"), F.explode(F.when(told, F.array(asked, *looked)).otherwise(F.array(asked))).alias("t")).select("conv", "t.*")
    state = text(
        "{", plan(F.when(k % 11 == 0, 999).otherwise(minutes)),
        ',"technician_gender":null,"technician_status":"not_checked","confirmation":false,"info_complete":true,"unrelated":false,"missing_info":[],"last_reply_type":null}',
    )
    expected = text(
        '{"action":"final",', plan(minutes), ',"technician_gender":"female","technician_status":"available","confirmation":', F.when(k % 41 == 0, "true").otherwise("false"),
        ',"info_complete":true,"unrelated":false,"missing_info":[],"reply_type":"', F.when(k % 43 == 0, "inform_no_match").otherwise("confirm_available"),
        '","reply":"', F.when(k % 37 == 0, "{}").otherwise("free"), '"}',
    )
    wanted = text('{"required_acts":["', F.when(k % 31 == 0, "sing").otherwise("request_confirmation"), '"],"forbidden_acts":[],"required_fields":[],"references":[', F.when(k % 29 == 0, "").otherwise('"free"'), "]}")
    answers = orders.select(
        F.col("o_custkey").alias("conv"), (k * 4 + 3).alias("turn"), k.alias("k"), F.lit("final").alias("output_kind"), F.lit("multi_turn").alias("conversation_kind"),
        F.when(k % 13 == 0, " ").when(~told, "go").alias("user_input"), F.when(k % 19 == 0, "soon").otherwise("2024-01-01 08:00").alias("current_time"),
        F.when(k % 23 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("find"))).alias("available_tools"),
        F.parse_json(F.when(k % 2 == 1, state)).alias("state"), F.parse_json(expected).alias("expected"), F.parse_json(wanted).alias("expectations"),
    )
    found = contract.record_errors(contract.before_answers(turns, answers, RECORD_CONTRACT), RECORD_CONTRACT)
    return found.select("k", F.array_join("errors", ",").alias("errors"))
