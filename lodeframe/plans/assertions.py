"""Assertions and metrics of a change beside its gold change, as Columns.

A case holds five lists of entries: the state ``before``, the ``gold`` change and
its ``goal`` state, the ``actual`` change and the state ``after`` it.  An entry is
``struct(field, soft, op, value)``, its value in canonical text; the query text and
the sort are entries too.  So every check is a comparison of sets or bags, and runs
in the JVM on whole columns.

A change is ``struct(reset, entries, clear, unmapped)``; ``actual`` and ``after``
are null where the prediction isn't valid, and then nothing holds.  ``strangers``
lists what the raw answer names that the catalog doesn't: ``struct(what, field)``,
where ``what`` is ``field`` (any key or field out of place) or ``value``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPECIAL = ("query_text", "sort")
NEGATIVE = ("not_in", "avoid")
ENTRY = "struct<field string, soft boolean, op string, value string>"
STATE = f"array<{ENTRY}>"
CHANGE = f"struct<reset boolean, entries {STATE}, clear array<string>, unmapped array<string>>"
STRANGERS = "array<struct<what string, field string>>"

#: The assertions and what each is about, for statistics.
DIMENSIONS = {
    "field_exact": "field",
    "field_replaced": "state",
    "field_preserved": "state",
    "field_cleared": "state",
    "operator_correct": "field",
    "value_normalized": "field",
    "hard_soft_correct": "intent",
    "negation_correct": "intent",
    "allergen_semantics_correct": "safety",
    "query_text_correct": "search",
    "sort_correct": "search",
    "no_unknown_field": "schema",
    "no_unknown_value": "schema",
    "no_hallucinated_filter": "safety",
    "unmapped_correct": "search",
    "minimal_patch": "state",
}
#: The assertions that must name a field, and those of them that the query text and the sort don't suit.
OF_A_FIELD = ("field_exact", "field_replaced", "field_preserved", "field_cleared", "operator_correct", "value_normalized")
OF_CONDITIONS = ("operator_correct", "value_normalized")


class CaseColumns:
    """The columns of a case by name."""

    def __getattr__(self, name: str) -> Column:
        return F.col(name)


case = CaseColumns()
Check = Callable[[Column], Column]


def held(entries: Column, name: Column | str) -> Column:
    """What a state or change holds for a field."""
    return F.array_sort(F.filter(entries, lambda e: e["field"] == name))


def has(entries: Column, name: Column | str) -> Column:
    return F.exists(entries, lambda e: e["field"] == name)


def touched(change: Column) -> Column:
    return F.array_union(F.transform(change["entries"], lambda e: e["field"]), change["clear"])


def within(name: Column, field: Column) -> Column:
    """Whether a field is meant; no name means all."""
    return name.isNull() | (field == name)


def traits(change: Column, name: Column, parts: Sequence[str], only: Check | None = None) -> Column:
    """The bag of some parts of the conditions meant."""
    wanted = lambda e: within(name, e["field"]) & ~e["field"].isin(*SPECIAL) & (only(e) if only else F.lit(True))
    return F.array_sort(F.transform(F.filter(change["entries"], wanted), lambda e: F.struct(*[e[p] for p in parts])))


def agree(parts: Sequence[str], only: Check | None = None) -> Check:
    return lambda name: traits(case.actual, name, parts, only) == traits(case.gold, name, parts, only)


def exact(name: Column) -> Column:
    cleared = F.array_contains(case.actual["clear"], name) == F.array_contains(case.gold["clear"], name)
    return (held(case.actual["entries"], name) == held(case.gold["entries"], name)) & cleared


def replaced(name: Column) -> Column:
    moved = held(case.before, name) != held(case.goal, name)
    return ~case.actual["reset"] & has(case.before, name) & F.array_contains(touched(case.actual), name) & moved & (held(case.after, name) == held(case.goal, name))


def preserved(name: Column) -> Column:
    return ~case.actual["reset"] & has(case.before, name) & (held(case.goal, name) == held(case.before, name)) & (held(case.after, name) == held(case.before, name))


def cleared(name: Column) -> Column:
    return ~case.actual["reset"] & F.array_contains(case.gold["clear"], name) & F.array_contains(case.actual["clear"], name) & ~has(case.after, name)


def allergens(name: Column) -> Column:
    return (held(case.actual["entries"], "allergen") == held(case.gold["entries"], "allergen")) & (held(case.after, "allergen") == held(case.goal, "allergen"))


def nothing_invented(name: Column) -> Column:
    """All that the change sets or clears, the gold change does too."""
    entries = F.forall(case.actual["entries"], lambda e: ~within(name, e["field"]) | F.array_contains(case.gold["entries"], e))
    return entries & F.forall(case.actual["clear"], lambda f: ~within(name, f) | F.array_contains(case.gold["clear"], f))


def nothing_needless(name: Column) -> Column:
    """Nothing invented, nothing set to what it is, nothing cleared that isn't there."""
    idle = lambda f: F.when(F.array_contains(case.actual["clear"], f), ~has(case.before, f)).otherwise(held(case.before, f) == held(case.after, f))
    fields = F.forall(touched(case.actual), lambda f: ~within(name, f) | ~idle(f))
    return (case.actual["reset"] == case.gold["reset"]) & nothing_invented(name) & (case.actual["reset"] | fields)


def special(name: str) -> Check:
    return lambda _: held(case.actual["entries"], name) == held(case.gold["entries"], name)


def known(what: str) -> Check:
    """Read from the raw answer: it may be invalid otherwise. A field out of place leaves no value known."""
    return lambda name: ~F.exists(case.strangers, lambda s: (s["what"] == "field") | ((s["what"] == what) & within(name, s["field"])))


is_negative = lambda e: e["op"].isin(*NEGATIVE)
RAW: dict[str, Check] = {"no_unknown_field": known("field"), "no_unknown_value": known("value")}
CHECKS: dict[str, Check] = {
    "field_exact": exact,
    "field_replaced": replaced,
    "field_preserved": preserved,
    "field_cleared": cleared,
    "operator_correct": agree(("soft", "field", "op")),
    "value_normalized": agree(("field", "value")),
    "hard_soft_correct": agree(("soft", "field", "value")),
    "negation_correct": agree(("soft", "field", "op", "value"), is_negative),
    "allergen_semantics_correct": allergens,
    "query_text_correct": special("query_text"),
    "sort_correct": special("sort"),
    "no_hallucinated_filter": nothing_invented,
    "unmapped_correct": lambda _: F.array_sort(case.actual["unmapped"]) == F.array_sort(case.gold["unmapped"]),
    "minimal_patch": nothing_needless,
}


def holds(kind: Column, name: Column) -> Column:
    """Whether the assertion ``kind`` about the field ``name`` holds for a case; unknown kinds and missing fields are errors."""
    wrong = F.raise_error(F.concat(F.lit("unsupported assertion: "), F.coalesce(kind, F.lit("null")), F.lit(" "), F.coalesce(name, F.lit("null"))))
    out = F.when(~F.coalesce(kind.isin(*DIMENSIONS), F.lit(False)) | (kind.isin(*OF_A_FIELD) & name.isNull()) | (kind.isin(*OF_CONDITIONS) & name.isin(*SPECIAL)), wrong.cast("boolean"))
    for k, check in RAW.items():
        out = out.when(kind == k, check(name))
    for k, check in CHECKS.items():
        out = out.when(kind == k, case.actual.isNotNull() & check(name))
    return F.coalesce(out, F.lit(False))


def dimension(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in DIMENSIONS.items() for x in pair])[kind]


def share(flags: Column) -> Column:
    """Part of the flags that hold; null without any."""
    return F.when(F.size(flags) > 0, F.size(F.filter(flags, lambda x: x)) / F.size(flags))


def metrics(passed: Column, extractable: Sequence[str]) -> dict[str, Column]:
    """The ten metrics; null where one doesn't apply.  ``passed`` has a flag for each assertion."""
    valid = case.actual.isNotNull()
    anything = F.lit(None).cast("string")
    sure = lambda x: F.coalesce(valid & x, F.lit(False))
    number = lambda x: sure(x).cast("double")
    actual_entries = F.coalesce(case.actual["entries"], F.array().cast(STATE))
    fields = F.array_union(touched(case.gold), F.coalesce(touched(case.actual), F.array().cast("array<string>")))
    names = F.array(*[F.lit(n) for n in (*extractable, *SPECIAL)])
    kept = F.filter(names, lambda n: ~case.gold["reset"] & has(case.before, n) & ~F.array_contains(touched(case.gold), n))
    negative = F.exists(case.gold["entries"], is_negative) | F.exists(actual_entries, is_negative)
    allergic = has(case.goal, "allergen") | has(case.before, "allergen") | has(case.gold["entries"], "flavor") | has(case.gold["entries"], "allergen") | has(actual_entries, "allergen")
    whole = lambda c: F.struct(c["reset"], F.array_sort(c["entries"]), F.array_sort(c["clear"]), F.array_sort(c["unmapped"]))
    return {
        "schema_valid": valid.cast("double"),
        "assertions": share(passed),
        "exact_match": number(whole(case.actual) == whole(case.gold)),
        "field_extraction": F.coalesce(share(F.transform(fields, lambda f: sure(exact(f)))), valid.cast("double")),
        "hard_soft": number(CHECKS["hard_soft_correct"](anything)),
        "negation": F.when(negative, number(CHECKS["negation_correct"](anything))),
        "state_preserve": share(F.transform(kept, lambda f: sure(preserved(f)))),
        "allergen_semantics": F.when(F.lit("allergen" in extractable) & allergic, number(allergens(anything))),
        "hallucination_free": number(nothing_invented(anything)),
        "minimal_patch": number(nothing_needless(anything)),
    }


def confusion() -> dict[str, Column]:
    """Fields touched rightly, wrongly and missed; a wrong field costs both."""
    mine = F.coalesce(touched(case.actual), F.array().cast("array<string>"))
    right = F.size(F.filter(F.array_intersect(touched(case.gold), mine), lambda f: F.coalesce(exact(f), F.lit(False))))
    return {"tp": right.cast("double"), "fp": (F.size(mine) - right).cast("double"), "fn": (F.size(touched(case.gold)) - right).cast("double")}
