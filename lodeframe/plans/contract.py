"""The contract of conversation records: rules of a contract file, compiled to Columns.

A record is an answer at a turn of a conversation.  ``before_answers`` brings each
answer what the turns before it say: the latest tool exchange (a call and its
result), what is wrong with any exchange so far, how many turns the user has had and
whether the last turn is a tool's.  It is an as-of join: turns and answers are walked
together in stretches of a conversation, and what the stretches before a stretch say
is added from one row a stretch, so no conversation has to fit one task.
``record_errors`` then holds state, answer and expectations against each other.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.appointments import field, keys_of, kind_of, output_errors
from ..operators.matching import exchange_pairs

#: Keys of a state, and those in which a state is the plan of an answer.
STATE_KEYS = (
    "confirmation", "duration_minutes", "gender_preference", "info_complete", "last_reply_type", "missing_info", "preferences", "start_time", "technician_gender",
    "technician_name", "technician_status", "unrelated",
)
PLAN = ("gender_preference", "technician_gender", "start_time", "duration_minutes", "preferences", "technician_name", "technician_status")
#: What a state takes over from a call, and what it says until the result is read.
TAKEN_OVER = ("gender_preference", "start_time", "duration_minutes", "preferences", "technician_name")
UNTIL_READ = {"technician_status": '"not_checked"', "confirmation": "false", "info_complete": "true", "unrelated": "false", "missing_info": "[]"}
#: The reply that asks for what is missing, and the one that tells of a result at once.
ASKS = {("start_time",): "ask_start_time", ("duration_minutes",): "ask_duration", ("start_time", "duration_minutes"): "ask_start_time_and_duration"}
TELLS = {"available": "confirm_available", "unavailable": "inform_unavailable", "not_found": "inform_not_found", "no_match": "inform_no_match"}
FAILED = ("unavailable", "not_found", "no_match")
GENDERS = ("gender_preference", "technician_gender")


class ContractError(ValueError):
    """A contract file that can't be compiled."""


@dataclass(frozen=True)
class Contract:
    opens: str
    closes: str
    allowed: Mapping[str, tuple[str | None, ...]]
    slots: tuple[str, ...]
    acts: tuple[str, ...]
    fields: tuple[str, ...]
    tools: Mapping[str, tuple[str, ...]]


def load_contract(text: str) -> Contract:
    """A contract from its JSON text."""
    try:
        read: Any = json.loads(text)
        hours = read["business_hours"]
        for clock in (hours["open"], hours["close"]):
            hour, minute = clock.split(":")
            if not (len(hour) == len(minute) == 2 and 0 <= int(hour) < 24 and 0 <= int(minute) < 60):
                raise ContractError(f"not a clock: {clock!r}")
        return Contract(
            hours["open"],
            hours["close"],
            {name: tuple(rule["allowed_values"]) for name, rule in read["fields"].items()},
            tuple(read["completion"]["missing_slot_order"]),
            tuple(read["reply"]["allowed_acts"]),
            tuple(read["reply"]["allowed_required_fields"]),
            {name: tuple(tool["arguments"]) for name, tool in read["tools"].items()},
        )
    except (KeyError, TypeError, AttributeError, ValueError) as wrong:
        raise wrong if isinstance(wrong, ContractError) else ContractError(f"not a contract: {wrong!r}") from wrong


# --- values -----------------------------------------------------------------------------------------------------


def written(v: Column, path: str) -> Column:
    """A place as JSON text; an absent one is null, as written."""
    return F.coalesce(F.to_json(F.try_variant_get(v, f"$.{path}", "variant")), F.lit("null"))


def same(a: Column, b: Column, *paths: str) -> Column:
    out = F.lit(True)
    for path in paths:
        out = out & (written(a, path) == written(b, path))
    return out


def is_object(v: Column) -> Column:
    return v.isNotNull() & F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))


def missing(v: Column) -> Column:
    """Whether there is no value: SQL's null or JSON's."""
    return v.isNull() | (F.schema_of_variant(v) == "VOID")


def values_hold(v: Column, contract: Contract, *names: str) -> Column:
    """Genders that are allowed, a positive duration, preferences that are texts, a start within business hours; null where a value may be."""
    ok = F.lit(True)
    for name in GENDERS:
        if name in names or not names:
            allowed = [json.dumps(x, ensure_ascii=False) for x in contract.allowed[name]]
            ok = ok & written(v, name).isin(*allowed)
    kind = kind_of(v, "duration_minutes")
    ok = ok & (F.coalesce(kind, F.lit("VOID")).isin("VOID") | ((kind == "BIGINT") & (field(v, "duration_minutes", "long") > 0)))
    wishes = F.schema_of_variant(F.try_variant_get(v, "$.preferences", "variant"))
    ok = ok & wishes.isin("ARRAY<STRING>", "ARRAY<VOID>") & F.forall(field(v, "preferences", "array<string>"), lambda x: x.isNotNull() & (F.trim(x) != ""))
    start, said = field(v, "start_time", "string"), kind_of(v, "start_time")
    parsed = F.try_to_timestamp(F.when(start.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"), start), F.lit("yyyy-MM-dd HH:mm"))
    clock = F.date_format(parsed, "HH:mm")
    ok = ok & (F.coalesce(said, F.lit("VOID")).isin("VOID") | ((said == "STRING") & parsed.isNotNull() & (clock >= contract.opens) & (clock < contract.closes)))
    return F.coalesce(ok, F.lit(False))


#: What may be wrong with an exchange, bit by bit.
EXCHANGE_RULES = ("tool", "tool_arguments", "tool_values")


def exchange_mask(tool: Column, arguments: Column, contract: Contract) -> Column:
    """The rules that an exchange breaks, as bits; of a broken rule the later ones aren't asked."""
    listed = F.create_map(*[x for name, keys in contract.tools.items() for x in (F.lit(name), F.array(*map(F.lit, sorted(keys))))])
    keys = F.try_element_at(listed, tool)
    return F.when(keys.isNull(), 1).when(~F.coalesce(keys_of(arguments) == keys, F.lit(False)), 2).when(~values_hold(arguments, contract, "gender_preference"), 4).otherwise(0)


# --- what is before an answer -----------------------------------------------------------------------------------


def before_answers(turns: DataFrame, answers: DataFrame, contract: Contract, width: int = 65_536) -> DataFrame:
    """``answers(conv, turn, ...)`` with ``arguments, result`` of the latest exchange before it, ``exchange_errors, user_turns, tool_last``.

    ``turns(conv, turn, role, call_id, tool, content)``: a row a call (role
    assistant, with ``call_id``, ``tool`` and the arguments as ``content``), a row a
    tool's result, and a row every other turn; a turn with several calls has several
    rows.  Calls and results whose content is no JSON object are none.  Turns are
    whole numbers, in both tables; an answer sees the turns before its own.
    """
    read = turns.withColumn("_json", F.when(F.col("call_id").isNotNull() & F.col("role").isin("assistant", "tool"), F.try_parse_json("content")))
    read = read.withColumn("_sound", F.coalesce(is_object(F.col("_json")), F.lit(False)))
    calls = read.where("role = 'assistant' and _sound").select("conv", "turn", "call_id", "tool", F.col("_json").alias("arguments"))
    results = read.where("role = 'tool' and _sound").select("conv", "turn", "call_id", F.col("_json").alias("result"))
    both = calls.select("conv", "turn", F.lit("call").alias("kind"), "call_id").unionByName(results.select("conv", "turn", F.lit("result").alias("kind"), "call_id"))
    pairs = exchange_pairs(both, width).where("call_turn is not null")
    exchanges = (
        pairs.join(calls.select("conv", "call_id", F.col("turn").alias("call_turn"), "tool", "arguments"), ["conv", "call_id", "call_turn"])
        .join(results.select("conv", "call_id", F.col("turn").alias("result_turn"), "result"), ["conv", "call_id", "result_turn"])
        .select("conv", F.col("result_turn").alias("turn"), "arguments", "result", exchange_mask(F.col("tool"), F.col("arguments"), contract).alias("mask"))
    )
    # several results of one turn: one stands for it
    exchanges = exchanges.groupBy("conv", "turn").agg(F.max_by(F.struct("arguments", "result"), F.to_json("result")).alias("x"), F.bit_or("mask").alias("mask"))
    marks = turns.groupBy("conv", "turn").agg(F.max(F.col("role") == "tool").alias("tool"), F.max(F.col("role") == "user").alias("user"))
    none = F.lit(None)
    events = marks.select("conv", "turn", F.when(F.col("tool"), F.col("turn")).alias("tool_at"), F.col("turn").alias("any_at"), F.col("user").cast("long").alias("users"), none.cast("long").alias("exchange_at"), none.cast("int").alias("mask"), F.lit(False).alias("asks"))
    events = events.unionByName(exchanges.select("conv", "turn", none.cast("long").alias("tool_at"), none.cast("long").alias("any_at"), F.lit(0).cast("long").alias("users"), F.col("turn").alias("exchange_at"), "mask", F.lit(False).alias("asks")))
    asked = answers.select("conv", "turn").distinct()
    events = events.unionByName(asked.select("conv", "turn", none.cast("long").alias("tool_at"), none.cast("long").alias("any_at"), F.lit(0).cast("long").alias("users"), none.cast("long").alias("exchange_at"), none.cast("int").alias("mask"), F.lit(True).alias("asks")))
    sums = {"tool_at": F.max, "any_at": F.max, "users": F.sum, "exchange_at": F.max, "mask": F.bit_or}
    events = events.withColumn("_far", F.floor(F.col("turn") / width))
    # what is of the same turn isn't before the answer
    inside = Window.partitionBy("conv", "_far").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = events.select("conv", "turn", "_far", "asks", *[f(c).over(inside).alias(c) for c, f in sums.items()]).where("asks")
    stretches = events.groupBy("conv", "_far").agg(*[f(c).alias(c) for c, f in sums.items()])
    earlier = Window.partitionBy("conv").orderBy("_far").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select(F.col("conv").alias("_conv"), F.col("_far").alias("_stretch"), *[f(c).over(earlier).alias(f"_{c}") for c, f in sums.items()])
    joined = near.join(carried, near["conv"].eqNullSafe(carried["_conv"]) & (near["_far"] == carried["_stretch"]))
    zero = F.lit(0)
    told = joined.select(
        "conv",
        "turn",
        F.coalesce(F.coalesce("tool_at", "_tool_at") == F.coalesce("any_at", "_any_at"), F.lit(False)).alias("tool_last"),
        (F.coalesce("users", zero) + F.coalesce("_users", zero)).alias("user_turns"),
        F.coalesce("exchange_at", "_exchange_at").alias("_at"),
        F.coalesce("mask", zero).bitwiseOR(F.coalesce("_mask", zero)).alias("_broken"),
    )
    latest = exchanges.select(F.col("conv").alias("_of"), F.col("turn").alias("_at"), "x.arguments", "x.result")
    told = told.join(latest, told["conv"].eqNullSafe(latest["_of"]) & (told["_at"] == latest["_at"]), "left").drop("_of", "_at")
    named = F.array_compact(F.array(*[F.when(F.col("_broken").bitwiseAND(1 << k) > 0, F.lit(name)) for k, name in enumerate(EXCHANGE_RULES)]))
    told = told.select(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), "arguments", "result", named.alias("exchange_errors"), "user_turns", "tool_last")
    return answers.join(told, answers["conv"].eqNullSafe(told["_conv"]) & (answers["turn"] == told["_turn"])).drop("_conv", "_turn")


# --- rules ------------------------------------------------------------------------------------------------------


def _supported(expected: Column, arguments: Column, result: Column) -> Column:
    """Whether the latest result says what a final answer tells at once."""
    status, name, gender = written(expected, "technician_status"), written(expected, "technician_name"), written(expected, "technician_gender")
    mode, outcome = field(result, "mode", "string"), written(result, "status")
    person = is_object(F.try_variant_get(result, "$.technician", "variant"))
    candidates = F.try_variant_get(result, "$.candidates", "array<variant>")
    only = F.try_element_at(candidates, F.lit(1))
    specific = (status == outcome) & (name == written(result, "requested_technician"))
    of_person = (
        F.when(status == '"available"', person & (written(result, "technician.name") == name) & (written(result, "technician.gender") == gender))
        .when(status == '"unavailable"', gender == F.when(person, written(result, "technician.gender")).otherwise("null"))
        .otherwise((status == '"not_found"') & (gender == "null"))
    )
    nobody = (status == '"no_match"') & (name == "null") & (gender == "null")
    one = (status == '"available"') & (F.size(candidates) == 1) & is_object(only) & (written(only, "name") == name) & (written(only, "gender") == gender)
    found = F.when(mode == "specific", specific & of_person).when((mode == "search") & (outcome == '"no_match"'), nobody).when((mode == "search") & (outcome == '"matched"'), one)
    return F.coalesce(result.isNotNull() & same(expected, arguments, "gender_preference", "start_time", "duration_minutes", "preferences") & found, F.lit(False))


def _read_once(contract: Contract) -> dict[str, Column]:
    """What several rules ask of a record, as columns, so that each is read once and not once a rule."""
    state, expected, asked = F.col("state"), F.col("expected"), F.col("expectations")
    text = lambda path: field(expected, path, "string")
    flag = lambda path: field(expected, path, "boolean")
    gaps = F.array_compact(F.array(*[F.when(F.coalesce(kind_of(expected, s), F.lit("VOID")) == "VOID", F.lit(s)) for s in contract.slots]))
    return {
        "_has_state": is_object(state),
        "_state_keys": keys_of(state) == F.array(*map(F.lit, sorted(STATE_KEYS))),
        "_state_status": written(state, "technician_status"),
        "_is_asked": is_object(asked),
        "_sound": F.size(output_errors(expected)) == 0,
        "_action": text("action"),
        "_unrelated": flag("unrelated"),
        "_confirmation": flag("confirmation"),
        "_info_complete": flag("info_complete"),
        "_status": text("technician_status"),
        "_reply": text("reply_type"),
        "_lacks": field(expected, "missing_info", "array<string>"),
        "_gaps": gaps,
        "_tool": text("tool_name"),
    }


def record_rules(contract: Contract) -> dict[str, Column]:
    """Rule name to whether a record of ``before_answers`` keeps it.

    Columns: ``output_kind, conversation_kind, user_input, current_time`` (texts),
    ``available_tools`` (array), ``state, expected, expectations`` (VARIANT) and
    those that ``before_answers`` and ``_read_once`` add.  Rules about another kind of answer hold.
    """
    state, expected, asked = F.col("state"), F.col("expected"), F.col("expectations")
    arguments, result = F.col("arguments"), F.col("result")
    has_state, has_exchange, is_asked = F.col("_has_state"), F.col("result").isNotNull(), F.col("_is_asked")
    said = F.col("user_input")
    sound, action = F.col("_sound"), F.col("_action")
    final, call = sound & (action == "final"), sound & (action == "tool_call")
    only = lambda when, ok: ~F.coalesce(when, F.lit(False)) | F.coalesce(ok, F.lit(False))
    status, reply = F.col("_status"), F.col("_reply")
    confirmation, info_complete = F.col("_confirmation"), F.col("_info_complete")
    statuses = [json.dumps(s) for s in contract.allowed["technician_status"]]
    replies = [json.dumps(r) for r in contract.allowed["reply_type"]]
    trailing = F.col("tool_last")
    unrelated, unchecked = F.col("_unrelated"), status == "not_checked"
    gaps, lacks = F.col("_gaps"), F.col("_lacks")
    asks = F.lit(None).cast("string")
    for slots, name in ASKS.items():
        asks = F.when(lacks == F.array(*map(F.lit, slots)), name).otherwise(asks)
    tells = F.lit(None).cast("string")
    for name, kind in TELLS.items():
        tells = F.when(status == name, kind).otherwise(tells)
    planned = has_state & same(state, expected, *PLAN)
    open_, checked = final & ~unrelated & unchecked, final & ~unrelated & ~unchecked
    failed = status.isin(*FAILED)
    until_read = F.lit(True)
    for name, value in UNTIL_READ.items():
        until_read = until_read & (written(state, name) == value)
    tool = F.col("_tool")
    known_tool = tool.isin(*contract.tools)
    wanted = F.create_map(*[x for name, keys in contract.tools.items() for x in (F.lit(name), F.array(*map(F.lit, sorted(keys))))])[tool]
    given = F.try_variant_get(expected, "$.arguments", "variant")
    listed = lambda path, allowed: F.size(F.array_except(F.coalesce(field(asked, path, "array<string>"), F.array().cast("array<string>")), F.array(*map(F.lit, allowed)))) == 0
    user_turns = F.col("user_turns") + said.isNotNull().cast("int")
    clock = F.when(F.col("current_time").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"), F.try_to_timestamp("current_time", F.lit("yyyy-MM-dd HH:mm")))
    return {
        "current_time": F.coalesce(clock.isNotNull(), F.lit(False)),
        "available_tools": F.coalesce(F.col("available_tools") == F.array(*map(F.lit, contract.tools)), F.lit(False)),
        "user_input": F.when(said.isNull(), trailing).otherwise(F.trim(said) != ""),
        "state": missing(state) | has_state,
        "state_keys": only(has_state, F.col("_state_keys")),
        "state_values": only(has_state & F.col("_state_keys"), values_hold(state, contract)),
        "state_flags": only(
            has_state & F.col("_state_keys"),
            F.col("_state_status").isin(*statuses)
            & (kind_of(state, "confirmation") == "BOOLEAN")
            & (kind_of(state, "info_complete") == "BOOLEAN")
            & (kind_of(state, "unrelated") == "BOOLEAN")
            & F.startswith(F.schema_of_variant(F.try_variant_get(state, "$.missing_info", "variant")), F.lit("ARRAY"))
            & written(state, "last_reply_type").isin("null", *replies),
        ),
        "trailing": ~trailing | has_exchange,
        "state_follows": only(trailing & has_exchange & has_state, same(state, arguments, *TAKEN_OVER)),
        "state_unread": only(trailing & has_exchange & has_state, until_read & (written(state, "technician_gender") == "null")),
        "evidence": only(has_state & (F.col("_state_status") != '"not_checked"'), has_exchange),
        "output_kind": F.coalesce(action == F.col("output_kind"), F.lit(False)),
        "conversation_kind": F.col("conversation_kind") == F.when(user_turns >= 2, "multi_turn").otherwise("single_turn"),
        "output": sound,
        "values": only(final, values_hold(expected, contract)) & only(call, values_hold(given, contract, "gender_preference")),
        "status": only(final, status.isin(*[s for s in contract.allowed["technician_status"] if s])),
        "unrelated_reply": only(final & unrelated, (reply == "handoff") & (written(expected, "reply") == "null")),
        "unrelated_flags": only(final & unrelated, ~confirmation & ~info_complete & (F.size(lacks) == 0) & unchecked),
        "missing_info": only(open_, lacks == gaps),
        "info_complete": only(open_, info_complete == (F.size(gaps) == 0)),
        "asks": only(open_ & asks.isNotNull(), reply == asks),
        "complete": only(checked, (F.size(gaps) == 0) & info_complete & (F.size(lacks) == 0)),
        "supported": only(checked & (reply == tells), _supported(expected, arguments, result)),
        "paused": only(checked & (reply == "appointment_paused"), (status == "available") & planned & (written(state, "last_reply_type") == '"confirm_available"')),
        "authorized": only(checked & (reply == "booking_authorized"), confirmation & (status == "available") & planned),
        "acknowledged": only(checked & (reply == "acknowledge_result"), ~confirmation & failed & planned),
        "reply_type": only(checked, (reply == tells) | reply.isin("appointment_paused", "booking_authorized", "acknowledge_result")),
        "confirmation": only(final & ~unrelated & confirmation, reply.isin("booking_authorized", "acknowledge_result")),
        "call_tool": only(call, known_tool),
        "call_arguments": only(call & known_tool, keys_of(expected, "arguments") == wanted),
        "expectations": F.when(F.coalesce(action == "tool_call", F.lit(False)), missing(asked)).otherwise(is_asked),
        "acts": only(is_asked, listed("required_acts", contract.acts) & listed("forbidden_acts", contract.acts)),
        "required_fields": only(is_asked, listed("required_fields", contract.fields)),
        "references": only(is_asked & (reply != "handoff"), F.size(field(asked, "references", "array<string>")) > 0),
    }


def record_errors(records: DataFrame, contract: Contract) -> DataFrame:
    """``records`` of ``before_answers`` with ``errors``: the names of the broken rules, those of earlier exchanges first."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in record_rules(contract).items()]))
    read = _read_once(contract)
    return records.withColumns(read).withColumn("errors", F.concat("exchange_errors", broken)).drop(*read)
