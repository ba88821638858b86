"""Plans of changes: for each wanted sample a scenario, a legal change, a state where the scenario needs one, and assertions.

A plan row is a function of (scenario, turn, catalog, seed) alone: every choice is
a cycle through its candidates, in an order that a hash of seed, scenario and
choice fixes, and a later choice of a row moves on by one whenever the choices
before it have gone round.  So within a scenario each candidate of a choice is
used as often as any other, give or take one round, and tasks need no shared
counters.  What is planned is checked against the sample contract before it
leaves (``evaluation.sample_errors``).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from ..facets import Catalog, Field
from .evaluation import derive_tags, sample_errors
from .predicates import Condition

RELATIVE = {"lower", "higher", "around"}
PLAN_DDL = "request_id string, scenario string, state string, expected string, assertions string, tags array<string>, draft string"


@dataclass
class Pools:
    """Free texts, numbers and currencies that plans may use."""

    query_terms: Sequence[str]
    unmapped_terms: Sequence[str]
    numbers: Mapping[str, Sequence[float]]
    currencies: Sequence[str] = ("USD",)


@dataclass
class Row:
    """Choices of one plan row."""

    catalog: Catalog
    pools: Pools
    scenario: str
    turn: int
    seed: str
    said: list[str] = field(default_factory=list)
    round: int = 1

    def pick(self, what: str, candidates: Sequence[Any], name: Callable[[Any], str] = str) -> Any:
        if not candidates:
            raise ValueError(f"{self.scenario}: no legal {what}")
        mix = lambda c: hashlib.sha256(f"{self.seed}:{self.scenario}:{what}:{name(c)}".encode()).digest()
        ordered = sorted(candidates, key=mix)
        moved = self.turn // self.round if self.round > 1 else 0
        chosen = ordered[(self.turn + moved) % len(ordered)]
        self.round *= len(ordered)
        return chosen

    def later(self, steps: int) -> Row:
        """The same choices some turns on, with a record of its own of what is said."""
        return Row(self.catalog, self.pools, self.scenario, self.turn + steps, self.seed)

    def field(self, what: str, ok: Callable[[Field], bool] = lambda f: True, but: Sequence[str] = ()) -> Field:
        return self.pick(what, [f for f in self.catalog.fields if f.extractable and f.name not in but and ok(f)], lambda f: f.name)

    def condition(self, f: Field, what: str, soft: bool = False, ops: Sequence[str] = ()) -> Condition:
        op = self.pick(f"{what} operator", [o for o in (f.soft if soft else f.hard) if not ops or o in ops])
        c = Condition(f.name, op, soft=soft)
        if f.values:
            c = replace(c, values=(self.pick(f"{what} value", f.values, lambda v: v.code).code,))
        elif f.type == "boolean":
            c = replace(c, value=self.pick(f"{what} value", [False, True]))
        elif op not in ("lower", "higher"):
            unit = None
            if f.unit_kind == "currency":
                unit = self.pick(f"{what} unit", self.pools.currencies)
            elif f.units:
                unit = self.pick(f"{what} unit", list(f.units))
            numbers = sorted(self.pools.numbers[f.name])
            if op == "between":
                low, high = self.pick(f"{what} interval", [(a, b) for k, a in enumerate(numbers) for b in numbers[k + 1 :]])
                c = replace(c, low=low, high=high, unit=unit)
            else:
                c = replace(c, value=self.pick(f"{what} number", numbers), unit=unit)
        self.said.append(" ".join(str(x) for x in (f.name, op, *c.values, *(x for x in (c.value, c.low, c.high, c.unit) if x is not None))))
        return c


#: What a scenario plans: conditions, other parts of the change, and the state before it.
Planned = tuple[list[Condition], dict[str, Any], dict[str, Any] | None]
PLANS: dict[str, Callable[[Row], Planned]] = {}


def plans(*scenarios: str) -> Callable[[Callable[[Row], Planned]], Callable[[Row], Planned]]:
    def add(plan: Callable[[Row], Planned]) -> Callable[[Row], Planned]:
        PLANS.update(dict.fromkeys(scenarios, plan))
        return plan

    return add


def filterable(f: Field) -> bool:
    return bool(f.hard)


def state_of(*conditions: Condition, **parts: Any) -> dict[str, Any]:
    return {"query_text": None, "sort": None} | parts | {"hard_filters": [c.write() for c in conditions], "soft_preferences": []}


@plans("single_filter", "multi_filter", "hard_soft_mix")
def several(row: Row) -> Planned:
    """One condition, two of different fields, or one and a wish."""
    one = row.field("field", filterable)
    found = [row.condition(one, "a")]
    if row.scenario == "multi_filter":
        found.append(row.condition(row.field("other", filterable, [one.name]), "b"))
    elif row.scenario == "hard_soft_mix":
        found.append(row.condition(row.field("wish", lambda f: bool(f.soft), [one.name]), "b", soft=True))
    return found, {}, None


@plans("negation")
def refused(row: Row) -> Planned:
    op = row.pick("strength", ["not_in", "avoid"])
    operators = lambda f: f.soft if op == "avoid" else f.hard
    return [row.condition(row.field("field", lambda f: op in operators(f)), "a", op == "avoid", [op])], {}, None


@plans("allergy_vs_flavor")
def allergic(row: Row) -> Planned:
    names = [n for n in ("allergen", "flavor") if n in row.catalog]
    return [row.condition(row.catalog[row.pick("field", names)], "a", ops=["not_in"])], {}, None


@plans("numeric_price", "numeric_size", "relative_numeric")
def measured(row: Row) -> Planned:
    if row.scenario == "relative_numeric":
        return [row.condition(row.field("field", lambda f: not RELATIVE.isdisjoint(f.soft)), "a", True, sorted(RELATIVE))], {}, None
    return [row.condition(row.catalog[row.scenario.removeprefix("numeric_")], "a")], {}, None


@plans("replace", "preserve_state")
def changed(row: Row) -> Planned:
    """A field gets another value than it has, a second field keeps its own."""
    choices = lambda f: len(f.values) or (2 if f.type == "boolean" else len(row.pools.numbers.get(f.name, ())) - 1)
    one = row.field("field", lambda f: bool(f.hard) and choices(f) > 1)
    new = row.condition(one, "a")
    olds = (row.later(k).condition(one, "old") for k in range(1, 100))
    old = next(c for c in olds if c != new)
    return [new], {}, state_of(old, row.later(0).condition(row.field("kept", filterable, [one.name]), "kept"))


@plans("clear")
def dropped(row: Row) -> Planned:
    name = row.pick("cleared", sorted(row.catalog.clearable))
    row.said.append(f"drop {name}")
    if name == "query_text":
        before = state_of(query_text=row.pick("old query", row.pools.query_terms))
    elif name == "sort":
        before = state_of(sort=row.pick("old sort", sorts(row.catalog), str))
    else:
        before = state_of(row.later(0).condition(row.catalog[name], "old"))
    return [], {"clear_fields": [name]}, before


@plans("reset")
def restarted(row: Row) -> Planned:
    before = row.later(0)
    return [row.condition(row.field("field", filterable), "a")], {"reset": True}, state_of(before.condition(before.field("old field", filterable), "old"))


@plans("sort")
def sorted_by(row: Row) -> Planned:
    chosen = row.pick("sort", sorts(row.catalog), str)
    row.said.append(f"{chosen['field']} {chosen['order']}")
    return [], {"sort": chosen}, None


@plans("query_text", "unmapped")
def spoken(row: Row) -> Planned:
    """A free text: words to search for, or a wish that no field stands for."""
    searched = row.scenario == "query_text"
    term = row.pick("term", row.pools.query_terms if searched else row.pools.unmapped_terms)
    row.said.append(term)
    return [], {"query_text": term} if searched else {"unmapped_terms": [term]}, None


def sorts(catalog: Catalog) -> list[dict[str, str]]:
    return [{"field": s.name, "order": o} for s in catalog.sorts for o in s.orders]


def assertions_for(conditions: Sequence[Condition], parts: Mapping[str, Any], state: Mapping[str, Any] | None) -> list[dict[str, str | None]]:
    """Assertions that the change supports."""
    out = [("field_exact", c.field) for c in conditions] + [("operator_correct", c.field) for c in conditions]
    out += [("query_text_correct", None)] * ("query_text" in parts) + [("sort_correct", None)] * ("sort" in parts) + [("unmapped_correct", None)] * ("unmapped_terms" in parts)
    out += [("field_cleared", f) for f in parts.get("clear_fields", ())]
    if state is not None and not parts.get("reset"):
        old = {c["field"] for c in state["hard_filters"]}
        new = {c.field for c in conditions}
        out += [("field_replaced", f) for f in sorted(old & new)] + [("field_preserved", f) for f in sorted(old - new - set(parts.get("clear_fields", ())))]
    out += [("no_hallucinated_filter", None), ("minimal_patch", None)]
    return [{"type": t, "field": f} for t, f in dict.fromkeys(out)]


def plan_row(request_id: str, scenario: str, turn: int, catalog: Catalog, pools: Pools, seed: str) -> dict[str, Any]:
    """One plan; a row that breaks the sample contract is an error."""
    if scenario not in PLANS:
        raise ValueError(f"unknown scenario {scenario!r}")
    row = Row(catalog, pools, scenario, turn, seed)
    conditions, parts, state = PLANS[scenario](row)
    empty = {"schema_version": "1.0", "reset": False, "query_text": None, "sort": None, "clear_fields": [], "unmapped_terms": []}
    expected = empty | parts | {"hard_filters": [c.write() for c in conditions if not c.soft], "soft_preferences": [c.write() for c in conditions if c.soft]}
    asked = assertions_for(conditions, parts, state)
    draft = "; ".join(row.said) or scenario
    record = {"id": request_id, "scenario": scenario, "tags": ["planned"], "input": {"current_search_state": state, "user_input": draft}, "expected": expected, "assertions": asked}
    record["tags"] = derive_tags(record, catalog)
    if errors := sample_errors(record, catalog):
        raise ValueError(f"{request_id}: {errors}")
    text = lambda x: json.dumps(x, ensure_ascii=False)
    return {"request_id": request_id, "scenario": scenario, "state": state and text(state), "expected": text(expected), "assertions": text(asked), "tags": record["tags"], "draft": draft}


def plan_intents(requests: DataFrame, catalog: Catalog, pools: Pools, seed: str = "plan") -> DataFrame:
    """Plans of ``requests(request_id, scenario, number)``, numbered from 1 within a scenario (``generation.expand_requests``)."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["request_id", "scenario", "state", "expected", "assertions", "tags", "draft"]
        kinds = [pa.string()] * 5 + [pa.list_(pa.string()), pa.string()]
        for batch in batches:
            rows = [plan_row(r["request_id"], r["scenario"], r["number"] - 1, catalog, pools, seed) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    return requests.select("request_id", "scenario", "number").mapInArrow(plan, PLAN_DDL)
