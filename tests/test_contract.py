"""The record contract: each rule refuses and accepts, and what is before an answer equals a plain walk."""

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from lodeframe.plans import contract as R

CONTRACT = {
    "business_hours": {"open": "09:00", "close": "21:00"},
    "fields": {
        "gender_preference": {"allowed_values": ["female", "male", None]},
        "technician_gender": {"allowed_values": ["female", "male", None]},
        "technician_status": {"allowed_values": ["not_checked", "available", "unavailable", "not_found", "no_match"]},
        "reply_type": {"allowed_values": ["handoff", "ask_start_time", "confirm_available", "acknowledge_result"]},
    },
    "completion": {"missing_slot_order": ["start_time", "duration_minutes"]},
    "reply": {"allowed_acts": ["greet", "ask"], "allowed_required_fields": ["start_time"]},
    "tools": {"find": {"arguments": ["technician_name", "start_time", "duration_minutes", "gender_preference", "preferences"]}},
}
TEXT = json.dumps(CONTRACT)

PLAN = {"gender_preference": None, "start_time": "2024-05-01 10:00", "duration_minutes": 60, "preferences": ["oil"]}
ARGUMENTS = {**PLAN, "technician_name": "Ann"}
RESULT = {"mode": "specific", "status": "available", "requested_technician": "Ann", "technician": {"name": "Ann", "gender": "female"}}
FINAL = {
    "action": "final", **PLAN, "technician_name": "Ann", "technician_gender": "female", "technician_status": "available", "confirmation": False, "info_complete": True,
    "unrelated": False, "missing_info": [], "reply_type": "confirm_available", "reply": "Ann is free",
}
STATE = {
    **PLAN, "technician_name": "Ann", "technician_gender": None, "technician_status": "not_checked", "confirmation": False, "info_complete": True, "unrelated": False,
    "missing_info": [], "last_reply_type": None,
}
CALL = {"action": "tool_call", "tool_name": "find", "arguments": ARGUMENTS}
ASKED = {"required_acts": ["greet"], "forbidden_acts": [], "required_fields": ["start_time"], "references": ["free"]}
OPEN = {**FINAL, "technician_status": "not_checked", "technician_gender": None, "start_time": None, "missing_info": ["start_time"], "info_complete": False, "reply_type": "ask_start_time"}
AWAY = {**OPEN, "unrelated": True, "reply_type": "handoff", "reply": None, "missing_info": []}
HELD = {**STATE, "technician_status": "available", "technician_gender": "female", "last_reply_type": "confirm_available"}

BASE = {
    "turns": [("user", None, None, "hi"), ("assistant", "c1", "find", json.dumps(ARGUMENTS)), ("tool", "c1", None, json.dumps(RESULT))],
    "output_kind": "final", "conversation_kind": "single_turn", "user_input": None, "current_time": "2024-05-01 08:00", "available_tools": ["find"],
    "state": STATE, "expected": FINAL, "expectations": ASKED,
}
TALK = BASE["turns"] + [("assistant", None, None, "Ann is free")]
LATER = {"turns": TALK, "user_input": "yes", "conversation_kind": "multi_turn"}


def exchange(arguments=ARGUMENTS, result=RESULT, tool="find", answered="c1"):
    return [("user", None, None, "hi"), ("assistant", "c1", tool, json.dumps(arguments)), ("tool", answered, None, json.dumps(result))]


def found(status, person=None, **more):
    return {"turns": exchange(result={"mode": "specific", "status": status, "requested_technician": "Ann", "technician": person}), "expected": {**FINAL, "technician_status": status, "technician_gender": None, "reply_type": R.TELLS[status]} | more}


CASES = [
    ({}, []),
    ({"current_time": "2024-05-01"}, ["current_time"]),
    ({"current_time": "2024-13-01 10:00"}, ["current_time"]),
    ({"available_tools": []}, ["available_tools"]),
    ({"available_tools": None}, ["available_tools"]),
    ({"user_input": " "}, ["user_input", "conversation_kind"]),
    ({"turns": TALK}, ["user_input"]),
    ({"state": None}, []),
    ({"state": [1]}, ["state"]),
    ({"state": {"a": 1}}, ["state_keys", "state_follows", "state_unread", "evidence"][:3]),
    ({"state": {**STATE, "gender_preference": "x"}}, ["state_values", "state_follows"]),
    ({"state": {**STATE, "missing_info": None}}, ["state_flags", "state_unread"]),
    ({"state": {**STATE, "confirmation": 1}}, ["state_flags", "state_unread"]),
    ({"state": {**STATE, "last_reply_type": "shout"}}, ["state_flags"]),
    ({"state": {**STATE, "start_time": "2024-05-01 11:00"}}, ["state_follows"]),
    ({"state": {**STATE, "start_time": "2024-05-01 21:00"}}, ["state_values", "state_follows"]),
    ({"state": {**STATE, "technician_gender": "male"}}, ["state_unread"]),
    ({"state": HELD}, ["state_unread"]),
    ({"turns": exchange(answered="c9"), "state": None}, ["trailing", "supported"]),
    ({"turns": exchange(tool="seek")}, ["tool"]),
    ({"turns": exchange(arguments={"a": 1}), "state": None}, ["tool_arguments", "supported"]),
    ({"turns": exchange(arguments={**ARGUMENTS, "duration_minutes": -5}), "state": None}, ["tool_values", "supported"]),
    ({"turns": exchange(arguments={**ARGUMENTS, "preferences": [" "]}), "state": None}, ["tool_values", "supported"]),
    ({"turns": [("user", None, None, "a")], "user_input": "b", "conversation_kind": "multi_turn", "state": HELD}, ["evidence", "supported"]),
    ({"output_kind": "tool_call"}, ["output_kind"]),
    ({"conversation_kind": "multi_turn"}, ["conversation_kind"]),
    ({"expected": {**FINAL, "reply": "{}"}}, ["output"]),
    ({"expected": {"action": "none"}}, ["output_kind", "output"]),
    ({"expected": {**FINAL, "start_time": "2024-05-01 08:59"}}, ["values", "supported"]),
    ({"expected": AWAY}, []),
    ({"expected": {**AWAY, "reply_type": "ask_start_time", "reply": "x"}}, ["unrelated_reply"]),
    ({"expected": {**AWAY, "info_complete": True}}, ["unrelated_flags"]),
    ({"expected": OPEN}, []),
    ({"expected": {**OPEN, "missing_info": []}}, ["missing_info"]),
    ({"expected": {**OPEN, "info_complete": True}}, ["info_complete"]),
    ({"expected": {**OPEN, "reply_type": "ask_duration"}}, ["asks"]),
    ({"expected": {**FINAL, "duration_minutes": None, "missing_info": ["duration_minutes"]}}, ["complete", "supported"]),
    ({"expected": {**FINAL, "technician_name": "Bob"}}, ["supported"]),
    ({"expected": {**FINAL, "technician_gender": "male"}}, ["supported"]),
    (found("unavailable"), []),
    (found("unavailable", {"name": "Ann", "gender": "male"}), ["supported"]),
    (found("unavailable", {"name": "Ann", "gender": "male"}, technician_gender="male"), []),
    (found("not_found"), []),
    (found("not_found", technician_gender="male"), ["supported"]),
    ({"turns": exchange(result={"mode": "search", "status": "no_match"}), "expected": {**FINAL, "technician_status": "no_match", "technician_name": None, "technician_gender": None, "reply_type": "inform_no_match"}}, []),
    ({"turns": exchange(result={"mode": "search", "status": "matched", "candidates": [{"name": "Ann", "gender": "female"}]})}, []),
    ({"turns": exchange(result={"mode": "search", "status": "matched", "candidates": [{"name": "Ann", "gender": "female"}, {}]})}, ["supported"]),
    ({"turns": exchange(result={"mode": "other"})}, ["supported"]),
    (LATER | {"state": HELD, "expected": {**FINAL, "reply_type": "appointment_paused"}}, []),
    (LATER | {"state": {**HELD, "last_reply_type": None}, "expected": {**FINAL, "reply_type": "appointment_paused"}}, ["paused"]),
    (LATER | {"state": HELD, "expected": {**FINAL, "reply_type": "booking_authorized", "confirmation": True}}, []),
    (LATER | {"state": HELD, "expected": {**FINAL, "reply_type": "booking_authorized"}}, ["authorized"]),
    (LATER | {"state": {**HELD, "duration_minutes": 90}, "expected": {**FINAL, "reply_type": "booking_authorized", "confirmation": True}}, ["authorized"]),
    (LATER | {"state": {**HELD, "technician_status": "no_match"}, "expected": {**FINAL, "technician_status": "no_match", "reply_type": "acknowledge_result"}}, []),
    (LATER | {"state": HELD, "expected": {**FINAL, "reply_type": "acknowledge_result"}}, ["acknowledged"]),
    ({"expected": {**FINAL, "reply_type": "inform_no_match"}}, ["reply_type"]),
    ({"expected": {**FINAL, "confirmation": True}}, ["confirmation"]),
    ({"expected": CALL, "output_kind": "tool_call", "expectations": None}, []),
    ({"expected": CALL, "output_kind": "tool_call"}, ["expectations"]),
    ({"expected": {**CALL, "tool_name": "seek"}, "output_kind": "tool_call", "expectations": None}, ["call_tool"]),
    ({"expected": {**CALL, "arguments": {**ARGUMENTS, "start_time": "2024-05-01 23:00"}}, "output_kind": "tool_call", "expectations": None}, ["values"]),
    ({"expectations": None}, ["expectations"]),
    ({"expectations": {**ASKED, "required_acts": ["sing"]}}, ["acts"]),
    ({"expectations": {**ASKED, "forbidden_acts": ["sing"]}}, ["acts"]),
    ({"expectations": {**ASKED, "required_fields": ["reply"]}}, ["required_fields"]),
    ({"expectations": {**ASKED, "references": []}}, ["references"]),
]
TURNS = "conv int, turn long, role string, call_id string, tool string, content string"


def frames(spark, cases):
    turns, answers = [], []
    for k, (change, _) in enumerate(cases):
        record = copy.deepcopy(BASE) | change
        turns += [(k, t, *row) for t, row in enumerate(record["turns"])]
        answers.append((k, len(record["turns"]), *[record[c] for c in ("output_kind", "conversation_kind", "user_input", "current_time", "available_tools")], *[None if record[c] is None else json.dumps(record[c]) for c in ("state", "expected", "expectations")]))
    said = spark.createDataFrame(answers, "conv int, turn long, output_kind string, conversation_kind string, user_input string, current_time string, available_tools array<string>, state string, expected string, expectations string")
    for c in ("state", "expected", "expectations"):
        said = said.withColumn(c, F.parse_json(c))
    return spark.createDataFrame(turns, TURNS), said


@pytest.mark.parametrize("width", [65_536, 1])
def test_every_rule_accepts_and_refuses(spark, width):
    rules = R.load_contract(TEXT)
    turns, answers = frames(spark, CASES)
    out = R.record_errors(R.before_answers(turns, answers, rules, width), rules).select("conv", "errors").collect()
    assert {r.conv: r.errors for r in out} == {k: errors for k, (_, errors) in enumerate(CASES)}
    broken = {e for _, errors in CASES for e in errors}
    assert broken >= set(R.record_rules(rules)) - {"status", "call_arguments"} | set(R.EXCHANGE_RULES)


def test_what_is_before_an_answer_equals_a_plain_walk(spark):
    rules = R.load_contract(TEXT)
    rng = random.Random(3)
    turns, answers, expected = [], [], []
    for conv in [*range(12), None]:
        calls, exchanges, users, last = {}, [], 0, None
        for turn in range(rng.randrange(1, 40)):
            if rng.random() < 0.3:
                answers.append((conv, turn))
                latest = exchanges[-1] if exchanges else None
                expected.append((conv, turn, users, last == "tool", latest, "tool" if any(t == "seek" for t, _ in exchanges) else ""))
            role = last = rng.choice(["user", "assistant", "tool"])
            users += role == "user"
            if role == "assistant":
                name, tool = rng.choice("ab"), rng.choice(["find", "seek"])
                content = rng.choice([json.dumps({**ARGUMENTS, "duration_minutes": turn + 1}), "no json", "[1]"])
                turns.append((conv, turn, role, name, tool, content))
                if content[0] == "{":
                    calls[name] = (tool, turn + 1)
            elif role == "tool":
                name, content = rng.choice("abc"), rng.choice(['{"n":%d}' % turn, "5"])
                turns.append((conv, turn, role, name, None, content))
                if name in calls and content[0] == "{":
                    exchanges.append((calls[name][0], (calls[name][1], turn)))
            else:
                turns.append((conv, turn, role, None, None, "text"))
    told, said = spark.createDataFrame(turns, TURNS), spark.createDataFrame(answers, "conv int, turn long")
    for width in (65_536, 7, 1):
        out = R.before_answers(told, said, rules, width)
        rows = out.select("conv", "turn", "user_turns", "tool_last", F.try_variant_get("arguments", "$.duration_minutes", "int").alias("a"), F.try_variant_get("result", "$.n", "int").alias("n"), "exchange_errors").collect()
        got = {(r.conv, r.turn): (r.user_turns, r.tool_last, (r.a, r.n) if r.a else None, ",".join(r.exchange_errors)) for r in rows}
        assert len(rows) == len(answers)
        assert got == {(c, t): (u, last, x[1] if x else None, e) for c, t, u, last, x, e in expected}
    assert R.before_answers(told.limit(0), said, rules).count() == len(answers)
    assert R.before_answers(told, said.limit(0), rules).count() == 0


@pytest.mark.parametrize("text", ["[]", "{}", "nothing", TEXT.replace("09:00", "9"), TEXT.replace('"tools"', '"tool"')])
def test_bad_contracts(text):
    with pytest.raises(R.ContractError):
        R.load_contract(text)


def test_an_answer_is_checked_once_for_all_rules(spark):
    """Rules look at a column of what the answer's checks say, not at the checks themselves."""
    rules = R.load_contract(TEXT)
    read = {name: str(column._jc) for name, column in R.record_rules(rules).items()}
    checks = str((R.F.size(R.output_errors(R.F.col("expected"))) == 0)._jc)
    assert not [name for name, text in read.items() if checks in text] and "_sound" in read["output"]
