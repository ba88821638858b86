"""Scans of appointment records: samples and raw samples, with all that is wrong with each, as Columns over a VARIANT."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .appointments import field

#: The keys of a raw sample, its categories, and the preference targets that each may have.
RAW_KEYS = ("id", "output_kind", "conversation_kind", "tags", "input", "expected", "dpo_targets")
TARGETS = {"追问": ("P7",), "工具调用": ("P6", "P2P3"), "最终 JSON": ("P4", "P2P3"), "确认": ("P5",), "无关": ("P5", "P6")}
KINDS, CONVERSATIONS = ("final", "tool_call"), ("single_turn", "multi_turn")
#: The lists of reply expectations.
WANTS = tuple(f"reply_expectations.{k}" for k in ("required_acts", "forbidden_acts", "required_fields", "references"))
#: Roles that may follow a role.
FOLLOWS = {"user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)}


def _variants(v: Column, path: str = "") -> Column:
    """An object's values by key; null for all else.  Cheaper than its schema or JSON, which go through all that is inside."""
    return F.try_variant_get(v, f"$.{path}" if path else "$", "map<string,variant>")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _is_text(v: Column) -> Column:
    return (F.schema_of_variant(v) == "STRING") & (F.trim(_text(v)) != "")


def _keys_are(found: Column, *keys: str) -> Column:
    """Whether an object has these keys and no others; a VARIANT holds its keys in order."""
    return F.map_keys(found) == F.array(*map(F.lit, sorted(keys)))


def _is_json(text: Column, *opening: str) -> Column:
    """Whether a text is JSON that opens with one of the marks; others aren't parsed, since each failure costs an exception."""
    return F.substr(F.ltrim(text, F.lit(" \t\r\n")), F.lit(1), F.lit(1)).isin(*opening) & F.try_parse_json(text).isNotNull()


def turns_of(v: Column, path: str) -> Column:
    """What the history rules need of each turn; no turns where there is no list."""
    turns = F.coalesce(F.try_variant_get(v, f"$.{path}", "array<map<string,variant>>"), F.array().cast("array<map<string,variant>>"))

    def read(t: Column) -> Column:
        calls = F.try_variant_get(t["tool_calls"], "$", "array<map<string,variant>>")
        return F.struct(t.alias("turn"), _text(t["role"]).alias("role"), _text(t["content"]).alias("said"), t["tool_calls"].isNotNull().alias("calling"), F.size(calls).alias("calls"), F.try_element_at(calls, F.lit(1)).alias("call"))

    return F.transform(F.transform(turns, read), _turn_of)


def _turn_of(t: Column) -> Column:
    turn, role, said, call = t["turn"], t["role"], t["said"], t["call"]
    function = _variants(call["function"])
    call_ok = (
        F.is_variant_null(turn["content"])
        & (t["calls"] == 1)
        & _keys_are(call, "function", "id", "type")
        & _is_text(call["id"])
        & (_text(call["type"]) == "function")
        & _keys_are(function, "arguments", "name")
        & _is_text(function["name"])
        & _is_json(_text(function["arguments"]), "{")
    )
    tool_ok = _keys_are(turn, "content", "role", "tool_call_id") & _is_json(said, "{")
    text = (F.schema_of_variant(turn["content"]) == "STRING") & (F.trim(said) != "")
    plain_ok = _keys_are(turn, "content", "role") & text & ((role != "assistant") | ~F.coalesce(_is_json(said, "{", "["), F.lit(False)))
    ok = F.when((role == "assistant") & t["calling"], call_ok).when(role == "tool", tool_ok).when(role.isin("user", "assistant"), plain_ok)
    return F.struct(role.alias("role"), F.coalesce(ok, F.lit(False)).alias("ok"), F.when(t["calling"], _text(call["id"])).alias("asked"), _text(turn["tool_call_id"]).alias("answered"))


def walk(turns: Column) -> Column:
    """One walk over ``turns_of`` a history: whether turns are sound, steps legal and results called for, and what the last call still waits for."""
    sure = lambda c: F.coalesce(c, F.lit(False))
    start = {"n": F.lit(0), "role": F.lit(None).cast("string"), "turns": F.lit(True), "steps": F.lit(True), "results": F.lit(True), "asked": F.lit(None).cast("string"), "told": F.lit(False), "met": F.lit(False)}

    def step(a: Column, t: Column) -> Column:
        # a call asks once; the next call forgets what wasn't answered, which shows at the end
        asks, tool, asked = t["asked"].isNotNull(), sure(t["role"] == "tool"), F.coalesce(t["asked"], a["asked"])
        legal = reduce(lambda x, y: x | y, [(a["role"] == r) & t["role"].isin(*after) for r, after in FOLLOWS.items()])
        after = {
            "n": a["n"] + 1,
            "role": t["role"],
            "turns": a["turns"] & t["ok"],
            "steps": a["steps"] & ((a["n"] == 0) | sure(legal)),
            "results": a["results"] & (~tool | (sure(t["answered"] == asked) & (asks | ~a["told"]))),
            "asked": asked,
            "told": tool | (~asks & a["told"]),
            # a result without an id is wrong as a result, but leaves no call open
            "met": ~asks & (a["met"] | (tool & F.coalesce(t["answered"] == asked, F.lit(True)))),
        }
        return F.struct(*[c.alias(k) for k, c in after.items()])

    return F.aggregate(turns, F.struct(*[c.alias(k) for k, c in start.items()]), step)


def _read_once(v: Column, raw: bool) -> tuple[dict[str, Column], dict[str, Column]]:
    """What the rules ask of a record, as columns, so that each place is read once and not once a rule; the second ones stand on the first."""
    place = lambda path: F.try_variant_get(v, f"$.{path}", "variant")
    void = lambda x: x.isNull() | F.is_variant_null(x)
    told, state, history = place("input.user_input"), place("input.current_state"), place("input.history")
    read = {
        "turns": turns_of(v, "input.history"),
        "history": history.isNull() | F.try_variant_get(history, "$", "array<variant>").isNotNull(),
        "void": void(told),
        "said": F.coalesce(_is_text(told), F.lit(False)),
        "id": (F.schema_of_variant(place("id")) == "STRING") & (field(v, "id", "string") != ""),
        "input": _variants(v, "input").isNotNull(),
        "expected": _variants(v, "expected").isNotNull(),
        "state": void(state) | _variants(state).isNotNull(),
        "kind": field(v, "output_kind", "string"),
        "conversation": field(v, "conversation_kind", "string"),
        "action": field(v, "expected.action", "string"),
    } | _lists(v, "tags")
    if raw:
        read |= {"keys": _keys_are(_variants(v), *RAW_KEYS)} | _lists(v, "dpo_targets")
    else:
        wants = place("reply_expectations")
        read |= {"absent": void(wants), "wants": _variants(wants).isNotNull()} | _lists(v, "assertions", *WANTS)
    after = {"walk": walk(_fact("turns"))}
    if raw:
        after["categories"] = F.array_intersect(F.array(*map(F.lit, TARGETS)), _fact("tags"))
    return {_named(k): c for k, c in read.items()}, {_named(k): c for k, c in after.items()}


def _named(fact: str) -> str:
    return f"_scan_{fact.replace('.', '_')}"


def _fact(name: str) -> Column:
    return F.col(_named(name))


def _lists(v: Column, *paths: str) -> dict[str, Column]:
    """Of each place, its texts and whether its kind is that of a list of texts."""
    kinds = {f"{p}_kind": F.schema_of_variant(F.try_variant_get(v, f"$.{p}", "variant")).isin("ARRAY<STRING>", "ARRAY<VOID>") for p in paths}
    return {p: field(v, p, "array<string>") for p in paths} | kinds


def _are_texts(path: str) -> Column:
    return _fact(f"{path}_kind") & F.forall(_fact(path), lambda x: x.isNotNull())


def history_rules() -> dict[str, Column]:
    """Rules of a message history: sound turns, legal steps, every tool result with a call before it and every call answered."""
    walked, has_said = _fact("walk"), _fact("said")
    n, end = walked["n"], walked["role"]
    return {
        "history": _fact("history"),
        "turns": walked["turns"],
        "start": (n == 0) | (F.get(_fact("turns"), F.lit(0))["role"] == "user"),
        "steps": walked["steps"],
        "results": walked["results"],
        "calls": walked["asked"].isNull() | walked["met"],
        "end": F.when(has_said, (n == 0) | (end == "assistant")).otherwise((n > 0) & (end == "tool")),
        "user_input": _fact("void") | has_said,
    }


def _shape_rules() -> dict[str, Column]:
    return {
        "id": _fact("id"),
        "output_kind": _fact("kind").isin(*KINDS),
        "conversation_kind": _fact("conversation").isin(*CONVERSATIONS),
        "input": _fact("input"),
        "expected": _fact("expected"),
        "current_state": _fact("state"),
    }


def sample_rules() -> dict[str, Column]:
    """Rules of a sample: its shape, history, and reply expectations for final answers alone.  Stands on ``_read_once``."""
    call = (_fact("kind") == "tool_call") | F.coalesce(_fact("action") == "tool_call", F.lit(False))
    wanted = reduce(lambda a, b: a & b, map(_are_texts, WANTS))
    rest = {"assertions": _are_texts("assertions"), "tags": _are_texts("tags"), "reply_expectations": F.when(call, _fact("absent")).otherwise(_fact("wants") & wanted)}
    return _shape_rules() | history_rules() | rest


def raw_sample_rules() -> dict[str, Column]:
    """Rules of a raw sample: exact keys, one category, and targets that the category may have.  Stands on ``_read_once``."""
    targets, categories = _fact("dpo_targets"), _fact("categories")
    allowed = F.create_map(*[x for c, t in TARGETS.items() for x in (F.lit(c), F.array(*map(F.lit, t)))])[F.get(categories, F.lit(0))]
    rest = {
        "tags": _are_texts("tags") & (F.size(categories) == 1),
        "action": _fact("action") == _fact("kind"),
        "dpo_targets": _are_texts("dpo_targets") & (F.size(F.array_distinct(targets)) == F.size(targets)) & (F.size(F.array_except(targets, allowed)) == 0),
    }
    return {"keys": _fact("keys")} | _shape_rules() | history_rules() | rest


def scan(rows: DataFrame, raw: bool = False) -> DataFrame:
    """``file, line_no, value, errors`` of read JSON lines."""
    read, after = _read_once(F.col("value"), raw)
    found = rows.withColumns(read).withColumns(after)
    broken = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in (raw_sample_rules() if raw else sample_rules()).items()])
    # names differ, so leaving out null is all that the difference does; array_compact would read every rule without compiled code
    return found.withColumn("errors", F.array_except(broken, F.array(F.lit(None).cast("string")))).drop(*read, *after)


def scenario_labels(v: Column) -> Column:
    """The six labels by which samples are sliced, in order of name."""
    told = F.exists(F.coalesce(F.try_variant_get(v, "$.input.history", "array<variant>"), F.array().cast("array<variant>")), lambda t: (field(t, "role", "string") == "tool") & _is_json(field(t, "content", "string"), "{"))
    lacks = F.size(field(v, "expected.missing_info", "array<string>")) > 0
    flags = {
        "confirmation": field(v, "expected.confirmation", "boolean"),
        "missing_information": ~field(v, "expected.info_complete", "boolean") & lacks,
        "multi_turn": field(v, "conversation_kind", "string") == "multi_turn",
        "tool_call": field(v, "expected.action", "string") == "tool_call",
        "tool_result": told,
        "unrelated": field(v, "expected.unrelated", "boolean"),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(on, F.lit(False)), F.lit(name)) for name, on in flags.items()]))
