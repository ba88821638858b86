"""The appointment domain: output contracts, expression assertions, faithfulness and scores, as Columns.

An output is a VARIANT: a *final* answer of fourteen fields, or a *tool call* of
three.  Types are read from the variant, so ``true`` is no number and ``60.0`` no
integer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times

#: Fixed values of the domain.
FINAL_KEYS = (
    "action", "confirmation", "duration_minutes", "gender_preference", "info_complete", "missing_info", "preferences", "reply", "reply_type", "start_time",
    "technician_gender", "technician_name", "technician_status", "unrelated",
)
CALL_KEYS = ("action", "arguments", "tool_name")
ARGUMENT_KEYS = ("duration_minutes", "gender_preference", "preferences", "start_time", "technician_name")
STATUSES = ("not_checked", "available", "unavailable", "not_found", "no_match")
REPLY_TYPES = (
    "handoff", "ask_start_time", "ask_duration", "ask_start_time_and_duration", "confirm_available", "inform_unavailable", "inform_not_found",
    "inform_no_match", "booking_authorized", "acknowledge_result", "appointment_paused",
)
MISSING = ("start_time", "duration_minutes")
STAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"
EXACT_FINAL = (
    "gender_preference", "technician_gender", "start_time", "duration_minutes", "technician_name", "technician_status", "confirmation", "info_complete",
    "unrelated", "missing_info", "action",
)
EXACT_CALL = ("technician_name", "start_time", "duration_minutes", "gender_preference")


def field(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def kind_of(v: Column, path: str) -> Column:
    """The JSON type of a place: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN or VOID; null if absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant")), "^[A-Z]+", 0)


def keys_of(v: Column, path: str | None = None) -> Column:
    inner = v if path is None else F.try_variant_get(v, f"$.{path}", "variant")
    return F.array_sort(F.json_object_keys(F.to_json(inner)))


def _keys_are(v: Column, keys: Sequence[str], path: str | None = None) -> Column:
    return F.coalesce(keys_of(v, path) == F.array(*map(F.lit, sorted(keys))), F.lit(False))


def _strings(v: Column, path: str) -> tuple[Column, Column]:
    """Whether a place is a list of distinct texts that aren't blank, and the list."""
    raw = F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant"))
    items = field(v, path, "array<string>")
    ok = raw.isin("ARRAY<STRING>", "ARRAY<VOID>") & F.forall(items, lambda x: F.coalesce(F.trim(x) != "", F.lit(False))) & (F.size(F.array_distinct(items)) == F.size(items))
    return F.coalesce(ok, F.lit(False)), items


def _null_or(v: Column, path: str, ok: Column) -> Column:
    return (kind_of(v, path) == "VOID") | F.coalesce(ok, F.lit(False))


def _positive(v: Column, path: str) -> Column:
    return (kind_of(v, path) == "BIGINT") & (field(v, path, "long") > 0)


def _stamp(v: Column, path: str) -> Column:
    return (kind_of(v, path) == "STRING") & field(v, path, "string").rlike(STAMP)


def _gender(v: Column, path: str) -> Column:
    return _null_or(v, path, (kind_of(v, path) == "STRING") & field(v, path, "string").isin("female", "male"))


def _named(v: Column, path: str) -> Column:
    return _null_or(v, path, (kind_of(v, path) == "STRING") & (F.trim(field(v, path, "string")) != ""))


def final_checks(v: Column) -> dict[str, Column]:
    wants, _ = _strings(v, "preferences")
    lacks_ok, lacks = _strings(v, "missing_info")
    reply, said = field(v, "reply_type", "string"), F.trim(field(v, "reply", "string"))
    plain = (kind_of(v, "reply") == "STRING") & (said != "") & ~F.startswith(said, F.lit("```")) & ~(F.startswith(said, F.lit("{")) & F.endswith(said, F.lit("}")))
    ordered = lacks == F.filter(F.array(*map(F.lit, MISSING)), lambda m: F.array_contains(lacks, m))
    return {
        "keys": _keys_are(v, FINAL_KEYS),
        "action": field(v, "action", "string") == "final",
        "gender_preference": _gender(v, "gender_preference"),
        "technician_gender": _gender(v, "technician_gender"),
        "start_time": _null_or(v, "start_time", _stamp(v, "start_time")),
        "duration_minutes": _null_or(v, "duration_minutes", _positive(v, "duration_minutes")),
        "preferences": wants,
        "technician_name": _named(v, "technician_name"),
        "technician_status": field(v, "technician_status", "string").isin(*STATUSES),
        "flags": reduce(lambda a, b: a & b, [kind_of(v, k) == "BOOLEAN" for k in ("confirmation", "info_complete", "unrelated")]),
        "missing_info": lacks_ok & ordered,
        "reply_type": reply.isin(*REPLY_TYPES),
        "reply": F.when(reply == "handoff", kind_of(v, "reply") == "VOID").otherwise(plain),
    }


def call_checks(v: Column) -> dict[str, Column]:
    wants, _ = _strings(v, "arguments.preferences")
    return {
        "keys": _keys_are(v, CALL_KEYS),
        "action": field(v, "action", "string") == "tool_call",
        "tool_name": (kind_of(v, "tool_name") == "STRING") & (field(v, "tool_name", "string") != ""),
        "arguments": _keys_are(v, ARGUMENT_KEYS, "arguments"),
        "technician_name": _named(v, "arguments.technician_name"),
        "start_time": _stamp(v, "arguments.start_time"),
        "duration_minutes": _positive(v, "arguments.duration_minutes"),
        "gender_preference": _gender(v, "arguments.gender_preference"),
        "preferences": wants,
    }


def errors_of(checks: Mapping[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def output_errors(v: Column) -> Column:
    """Names of the checks that an output fails, by its action; not an object: ``json``."""
    return (
        F.when(v.isNull(), F.array(F.lit("json")))
        .when(field(v, "action", "string") == "tool_call", errors_of(call_checks(v)))
        .otherwise(errors_of(final_checks(v)))
    )


def consistency_errors(v: Column, requested: Column) -> Column:
    """Errors of a raw final answer: missing_info names exactly the empty slots, an unrelated answer keeps defaults, a name belongs to the last tool result."""
    empty = F.filter(F.array(*[F.when(kind_of(v, m) == "VOID", F.lit(m)) for m in MISSING]), lambda m: m.isNotNull())
    unrelated = field(v, "unrelated", "boolean")
    name, status = field(v, "technician_name", "string"), field(v, "technician_status", "string")
    return errors_of(
        {
            "missing_info": unrelated | (field(v, "missing_info", "array<string>") == empty),
            "unrelated_defaults": ~unrelated | ((status == "not_checked") & name.isNull()),
            "name_source": name.isNull() | status.isin("not_checked") | F.coalesce(F.array_contains(requested, name), F.lit(False)),
            "no_match_name": (status != "no_match") | name.isNull(),
            "available_name": (status != "available") | name.isNotNull(),
        }
    )


def as_text(raw: Column, path: Column) -> Column:
    """A place of JSON text as an expression writes it: texts bare, all else as it stands; null for none."""
    json = F.call_function("get_json_object", raw, F.concat(F.lit("$."), path))
    return F.coalesce(json, F.lit("null"))


def expression_holds(v: Column, raw: Column, expression: Column) -> Column:
    """``field == value``, ``args.x == value`` or one of three named predicates; anything else doesn't hold.

    Values are compared as written in the output's text ``raw``: 60.0 is not 60 here.
    """
    expr = F.trim(expression)
    parts = F.split(expr, "==", 2)
    left, right = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    path = F.regexp_replace(left, r"^args\.", "arguments.")
    hour = F.regexp_extract(field(v, "start_time", "string"), r"^\S+ (\d{1,2}):", 1)
    schema = _keys_are(v, FINAL_KEYS) | _keys_are(v, CALL_KEYS)
    return F.coalesce(
        F.when(expr == "no_field_outside_schema", schema)
        .when(expr == "not_a_tool_call", F.coalesce(field(v, "action", "string") != "tool_call", F.lit(True)))
        .when(expr == "within_business_hours", F.coalesce((hour != "") & hour.cast("int").between(9, 20), F.lit(False)))
        .when(F.size(parts) == 2, as_text(raw, path) == right)
        .otherwise(F.lit(False)),
        F.lit(False),
    )


def ungrounded_name(v: Column, said: Column, offered: Column, requested: Column, known: Column) -> Column:
    """The name of an output that nothing supports, else null: user texts before a check, tool candidates or state after it."""
    status = field(v, "technician_status", "string")
    call = field(v, "action", "string") == "tool_call"
    name = F.when(call, field(v, "arguments.technician_name", "string")).otherwise(field(v, "technician_name", "string"))
    supported = (
        F.when(call | (status == "not_checked"), F.exists(said, lambda s: F.contains(s, name)))
        .when(status == "available", F.array_contains(F.concat(offered, known), name))
        .when(status.isin("unavailable", "not_found"), F.array_contains(F.concat(requested, known), name))
        .otherwise(F.lit(False))
    )
    return F.when(name.isNotNull() & (name != "") & ~F.coalesce(supported, F.lit(False)), name)


def same(a: Column, b: Column, path: str) -> Column:
    """Null-safe equality of a place in two outputs that both have it; 60.0 equals 60."""
    return F.coalesce(F.get_json_object(F.to_json(a), f"$.{path}").eqNullSafe(F.get_json_object(F.to_json(b), f"$.{path}")), F.lit(False)) & kind_of(a, path).isNotNull()


def _mean(hits: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [h.cast("double") for h in hits]) / len(hits)


def call_score(actual: Column, expected: Column, preference_f1: Column) -> Column:
    """Mean of action, tool, four arguments and the preferences' F1."""
    hits = [same(actual, expected, p) for p in ("action", "tool_name", *(f"arguments.{k}" for k in EXACT_CALL))]
    return _mean([*hits, preference_f1])


def final_score(actual: Column, expected: Column, preference_f1: Column, semantic: Column, faithful: Column) -> Column:
    """0.70 structured (eleven fields and the preferences) and 0.30 reply (type, meaning, faithfulness)."""
    structured = _mean([*[same(actual, expected, k) for k in EXACT_FINAL], preference_f1])
    reply = _mean([same(actual, expected, "reply_type"), semantic, faithful])
    return 0.70 * structured + 0.30 * reply


#: Names before or after a title, and what is no name.
NAME_BEFORE = r"(?:^|[，。！？、；：\s]|找到|安排|推荐|由)([一-鿿]{2,3})(?:老师|技师)"
NAME_AFTER = r"(?:老师|技师)([一-鿿]{2,3})(?=$|[，。！？、；：\s])"
NO_NAME = r"^(女|男|的女|的男|一位|这位|该位|合适)$|(的|位|名|个|女|男|吗|呢)$|性别|条件|时间|类型"


def names_in(reply: Column) -> Column:
    found = F.concat(F.regexp_extract_all(reply, F.lit(NAME_BEFORE), 1), F.regexp_extract_all(reply, F.lit(NAME_AFTER), 1))
    return F.array_distinct(F.filter(found, lambda n: ~n.rlike(NO_NAME)))


def says_time(reply: Column, stamp: Column, now: Column | None = None) -> Column:
    """Whether a normalised reply holds any way of writing a time."""
    return F.exists(times.time_forms(stamp, now), lambda f: F.contains(reply, T.normalize_reply(f)))


def faithfulness(checks: Column, errors: Column) -> Column:
    """Share of checks without an error; an error counts once."""
    return F.greatest(F.lit(0.0), (checks - F.size(F.array_distinct(errors))) / checks)


def reply_errors(reply: Column, expected: Column, required: Column, now: Column | None = None) -> tuple[Column, Column]:
    """Number of checks and errors of a reply against its expected answer; near days may be named from ``now``."""
    name, duration = field(expected, "technician_name", "string"), field(expected, "duration_minutes", "long")
    stamp = times.read_stamp(field(expected, "start_time", "string"))
    prefers = F.coalesce(field(expected, "preferences", "array<string>"), F.array().cast("array<string>"))
    needs = lambda k: F.array_contains(required, k)

    def found(said: Column) -> Column:
        lost = F.filter(prefers, lambda p: ~F.contains(said, T.normalize_reply(p)))
        return F.concat(
            F.array_compact(
                F.array(
                    F.when(needs("technician_name") & ~F.coalesce(F.contains(said, T.normalize_reply(name)), F.lit(False)), F.lit("technician_name")),
                    F.when(needs("duration_minutes") & ~F.coalesce(F.contains(said, F.concat(duration.cast("string"), F.lit("分钟"))), F.lit(False)), F.lit("duration_minutes")),
                    F.when(needs("start_time") & ~F.coalesce(says_time(said, stamp, now), F.lit(False)), F.lit("start_time")),
                )
            ),
            F.when(F.coalesce(F.exists(names_in(reply), lambda n: ~n.eqNullSafe(name)), F.lit(False)), F.array(F.lit("unsupported_technician_name"))).otherwise(F.array().cast("array<string>")),
            F.when(needs("preferences"), F.transform(lost, lambda p: F.concat(F.lit("preference:"), p))).otherwise(F.array().cast("array<string>")),
        )

    checks = 2 + F.size(F.array_intersect(required, F.array(*map(F.lit, ("technician_name", "duration_minutes", "start_time"))))) + F.when(needs("preferences"), F.size(prefers)).otherwise(0)
    return checks, T.bound(T.normalize_reply(reply), found)


# --- preference pairs ---------------------------------------------------------------------------------------------------


def perturbations(action: Column, output: Column, now: Column, names: Sequence[str], key: Column) -> dict[str, Column]:
    """Rejected variants of ``output`` (a struct of the answer's main slots), by family; null where a family doesn't apply.

    ``shift``: duration grows by 30, else the date moves by a day; ``name``: another
    name, by the key's hash; ``flip``: the action becomes the other one;
    ``confirm``: a confirmation or an unrelated answer is denied; ``fill``: missing slots are invented.
    """
    pool = F.array(*map(F.lit, names))
    start = T.hash_choice(key, len(names))
    turned = F.concat(F.slice(pool, start + 1, F.lit(len(names))), F.slice(pool, F.lit(1), start))
    other = F.get(F.filter(turned, lambda n: ~n.eqNullSafe(output["technician_name"])), F.lit(0))
    filled = output.withField("start_time", F.coalesce(output["start_time"], now)).withField("duration_minutes", F.coalesce(output["duration_minutes"], F.lit(60)))
    return {
        "shift": F.when(output["duration_minutes"].isNotNull(), output.withField("duration_minutes", output["duration_minutes"] + 30)).when(
            output["start_time"].isNotNull(), output.withField("start_time", output["start_time"] + F.expr("interval 1 day"))
        ),
        "name": output.withField("technician_name", other),
        "flip": F.when(action == "tool_call", output.withField("action", F.lit("final"))).otherwise(filled.withField("action", F.lit("tool_call"))),
        "confirm": F.when(output["confirmation"], output.withField("confirmation", F.lit(False))).when(output["unrelated"], output.withField("unrelated", F.lit(False))),
        "fill": F.when(output["start_time"].isNull() | output["duration_minutes"].isNull(), filled.withField("action", F.lit("tool_call"))),
    }


def pairs(df: DataFrame, variants: Mapping[str, Column], chosen: str) -> DataFrame:
    """Chosen and rejected answers, one row for each family that applies; a rejected one must differ."""
    items = F.array(*[F.struct(F.lit(k).alias("target"), v.alias("rejected")) for k, v in variants.items()])
    long = df.withColumn("_p", F.explode(items)).where(F.col("_p.rejected").isNotNull())
    return long.select("*", "_p.target", "_p.rejected").drop("_p").where(~F.col("rejected").eqNullSafe(F.col(chosen)))
