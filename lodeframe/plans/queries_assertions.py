"""The sixteen assertions over cases made from events, in which each holds in some and fails in others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking, sessions
from . import assertions
from .catalog import register, table

#: What an event is about, by its type.
FIELDS = {"view": "allergen", "click": "flavor", "error": "query_text", "purchase": "price", "signup": "sort"}
ASKED = (
    ("field_exact", "flavor"), ("field_replaced", "flavor"), ("field_preserved", "flavor"), ("field_cleared", "price"), ("operator_correct", "price"), ("value_normalized", "price"),
    ("hard_soft_correct", None), ("negation_correct", None), ("allergen_semantics_correct", None), ("query_text_correct", None), ("sort_correct", None), ("no_unknown_field", None),
    ("no_unknown_value", None), ("no_hallucinated_filter", None), ("unmapped_correct", None), ("minimal_patch", None),
)

_FIELD = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FIELDS.items()) + " END"
_OF = "list_filter({0}, lambda x: split_part(x, '|', 1) = {1})"
_PART = "list_sort(list_transform(list_filter({0}, lambda x: {1}), lambda x: {2}))"
_PLAIN = "split_part(x, '|', 1) NOT IN ('query_text', 'sort')"


def _of(entries: str, field: str) -> str:
    return _OF.format(entries, field if field == "f" else f"'{field}'")


def _parts(where: str, what: str) -> str:
    return _PART.format("actual", where, what) + " = " + _PART.format("gold", where, what)


_PRICE = "split_part(x, '|', 1) = 'price'"
_SOFT_FIELD_OP = "split_part(x, '|', 2) || split_part(x, '|', 1) || split_part(x, '|', 3)"
_INVENTED = "len(list_filter(actual, lambda x: NOT list_contains(gold, x))) = 0 AND len(list_filter(aclear, lambda f: NOT list_contains(gclear, f))) = 0"
_TOUCHED = "list_distinct(list_concat(list_transform(actual, lambda x: split_part(x, '|', 1)), aclear))"
_FLAGS = {
    "field_exact": f"{_of('actual', 'flavor')} = {_of('gold', 'flavor')} AND list_contains(aclear, 'flavor') = list_contains(gclear, 'flavor')",
    "field_replaced": f"NOT areset AND len({_of('before', 'flavor')}) > 0 AND list_contains({_TOUCHED}, 'flavor') AND {_of('before', 'flavor')} <> {_of('goal', 'flavor')} AND {_of('after_', 'flavor')} = {_of('goal', 'flavor')}",
    "field_preserved": f"NOT areset AND len({_of('before', 'flavor')}) > 0 AND {_of('goal', 'flavor')} = {_of('before', 'flavor')} AND {_of('after_', 'flavor')} = {_of('before', 'flavor')}",
    "field_cleared": f"NOT areset AND list_contains(gclear, 'price') AND list_contains(aclear, 'price') AND len({_of('after_', 'price')}) = 0",
    "operator_correct": _parts(_PRICE, _SOFT_FIELD_OP),
    "value_normalized": _parts(_PRICE, "split_part(x, '|', 4)"),
    "hard_soft_correct": _parts(_PLAIN, "split_part(x, '|', 2) || split_part(x, '|', 1) || split_part(x, '|', 4)"),
    "negation_correct": _parts(f"{_PLAIN} AND split_part(x, '|', 3) IN ('not_in', 'avoid')", "x"),
    "allergen_semantics_correct": f"{_of('actual', 'allergen')} = {_of('gold', 'allergen')} AND {_of('after_', 'allergen')} = {_of('goal', 'allergen')}",
    "query_text_correct": f"{_of('actual', 'query_text')} = {_of('gold', 'query_text')}",
    "sort_correct": f"{_of('actual', 'sort')} = {_of('gold', 'sort')}",
    "no_hallucinated_filter": _INVENTED,
    "unmapped_correct": "aun = gun",
    "minimal_patch": f"areset = greset AND {_INVENTED} AND (areset OR len(list_filter({_TOUCHED}, lambda f: CASE WHEN list_contains(aclear, f) THEN len({_of('before', 'f')}) = 0 ELSE {_of('before', 'f')} = {_of('after_', 'f')} END)) = 0)",
}
_MERGED = "list_sort(CASE WHEN {reset} THEN {new} ELSE list_concat(list_filter(before, lambda x: NOT list_contains(list_transform({new}, lambda y: split_part(y, '|', 1)), split_part(x, '|', 1)) AND NOT list_contains({clear}, split_part(x, '|', 1))), {new}) END)"


@register(f"""
WITH marked AS (
  SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 6 AS c, event_id % 5 AS side, {_FIELD} AS field,
         {_FIELD} || '|' || (value > 30)::VARCHAR || '|' || CASE WHEN value > 30 THEN CASE WHEN event_id % 3 = 0 THEN 'avoid' ELSE 'prefer' END ELSE CASE WHEN event_id % 3 = 0 THEN 'not_in' ELSE 'in' END END || '|' || (floor(value / 40)::BIGINT)::VARCHAR AS entry
  FROM events
), sides AS (
  SELECT user_id, c, coalesce(list_sort(list(DISTINCT entry) FILTER (side IN (0, 1))), []) AS before, coalesce(list_sort(list(DISTINCT entry) FILTER (side IN (2, 3))), []) AS gold,
         coalesce(list_sort(list(DISTINCT entry) FILTER (side = 2 OR (side = 3 AND event_id % 4 <> 0))), []) AS actual,
         coalesce(list_sort(list(DISTINCT field) FILTER (side = 4)), []) AS gclear, coalesce(list_sort(list(DISTINCT field) FILTER (side = 4 AND event_id % 3 <> 0)), []) AS aclear,
         coalesce(list_sort(list(DISTINCT field) FILTER (side = 1)), []) AS gun, coalesce(list_sort(list(DISTINCT field) FILTER (side = 1 AND event_id % 2 = 0)), []) AS aun,
         (user_id + c) % 5 = 0 AS greset, (user_id + c) % 10 = 0 AS areset, (user_id + c) % 13 = 0 AS invalid, (user_id + c) % 9 = 0 AS odd_field, (user_id + c) % 7 = 0 AS odd_value
  FROM marked GROUP BY user_id, c
), cases AS (
  SELECT *, {_MERGED.format(reset='greset', new='gold', clear='gclear')} AS goal, {_MERGED.format(reset='areset', new='actual', clear='aclear')} AS after_ FROM sides
), flags AS (
  SELECT unnest([{', '.join(f"{{'type': '{name}', 'ok': NOT invalid AND {sql}}}" for name, sql in _FLAGS.items())},
    {{'type': 'no_unknown_field', 'ok': NOT odd_field}}, {{'type': 'no_unknown_value', 'ok': NOT odd_field AND NOT odd_value}}]) AS s FROM cases
)
SELECT s.type AS type, count(*) AS cases, count(*) FILTER (s.ok) AS held FROM flags GROUP BY 1
""")
def assertion_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each assertion holds over cases with states, resets, cleared fields, wishes, refusals, unmapped words and unknown names."""
    events = table(spark, sf_dir, "events")
    at = ranking.distributed_rank(events, ["user_id"], [F.col("event_id")], F.floor(F.col("event_id") / 4096), "at")
    k, soft = F.col("event_id"), F.col("value") > 30
    side, c = k % 5, F.floor((F.col("at") - 1) / 6).alias("c")
    field = F.create_map(*[F.lit(x) for pair in FIELDS.items() for x in pair])[F.col("event_type")]
    op = F.when(soft, F.when(k % 3 == 0, "avoid").otherwise("prefer")).otherwise(F.when(k % 3 == 0, "not_in").otherwise("in"))
    entry = F.struct(field.alias("field"), soft.alias("soft"), op.alias("op"), F.floor(F.col("value") / 40).cast("string").alias("value"))
    of = lambda what, on: F.collect_set(F.when(on, what))
    sides = at.groupBy("user_id", c).agg(
        of(entry, side.isin(0, 1)).alias("before"), of(entry, side.isin(2, 3)).alias("gold_entries"), of(entry, (side == 2) | ((side == 3) & (k % 4 != 0))).alias("entries"),
        of(field, side == 4).alias("gold_clear"), of(field, (side == 4) & (k % 3 != 0)).alias("clear"), of(field, side == 1).alias("gold_unmapped"), of(field, (side == 1) & (k % 2 == 0)).alias("unmapped"),
    )
    n = F.col("user_id") + F.col("c")
    change = lambda entries, clear, unmapped, reset: F.struct(reset.alias("reset"), F.col(entries).alias("entries"), F.col(clear).alias("clear"), F.col(unmapped).alias("unmapped"))
    merged = lambda new, clear, reset: sessions.merge_arrays(F.col("before"), F.col(new), F.col(clear), reset)
    stranger = lambda on, what: F.when(on, F.struct(F.lit(what).alias("what"), F.lit(None).cast("string").alias("field")))
    valid = n % 13 != 0
    cases = sides.select(
        "before", change("gold_entries", "gold_clear", "gold_unmapped", n % 5 == 0).alias("gold"), merged("gold_entries", "gold_clear", n % 5 == 0).alias("goal"),
        F.when(valid, change("entries", "clear", "unmapped", n % 10 == 0)).alias("actual"), F.when(valid, merged("entries", "clear", n % 10 == 0)).alias("after"),
        F.array_compact(F.array(stranger(n % 9 == 0, "field"), stranger(n % 7 == 0, "value"))).alias("strangers"),
    )
    judged = F.array(*[F.struct(F.lit(t).alias("type"), assertions.holds(F.lit(t), F.lit(f).cast("string")).alias("ok")) for t, f in ASKED])
    flags = cases.select(F.explode(judged).alias("s"))
    return flags.groupBy("s.type").agg(F.count("*").alias("cases"), F.count_if("s.ok").alias("held"))
