"""Assertions, metrics, contracts: gold replayed is perfect, each wrong answer trips its check."""

import json

import pytest
from lodeframe.operators import reports
from lodeframe.plans import evaluation
from lodeframe.plans.assertions import DIMENSIONS
from lodeframe.plans.evaluation import mutations, sample_errors, score

from .shelf import CATALOG, condition, patch

STATE = {"query_text": "tea", "hard_filters": [condition("level", "gte", value=2), condition("allergen", "not_in", values=["milk"])], "soft_preferences": [], "sort": None}
GOLD = patch(
    hard_filters=[condition("flavor", "in", values=["matcha", "peanut"]), condition("level", "gte", value=3)],
    soft_preferences=[condition("price", "lower", soft=True)],
    clear_fields=["query_text"],
    unmapped_terms=["fancy"],
)
ASSERTIONS = [
    ("field_exact", "flavor"), ("field_replaced", "level"), ("field_preserved", "allergen"), ("field_cleared", "query_text"), ("operator_correct", "flavor"),
    ("value_normalized", "flavor"), ("hard_soft_correct", None), ("negation_correct", None), ("allergen_semantics_correct", None), ("query_text_correct", None),
    ("sort_correct", None), ("no_unknown_field", None), ("no_unknown_value", None), ("no_hallucinated_filter", None), ("unmapped_correct", None), ("minimal_patch", None),
]


def rows(texts):
    asked = json.dumps([{"type": t, "field": f} for t, f in ASSERTIONS])
    return [("run", name, json.dumps(STATE), json.dumps(GOLD), asked, text) for name, text in texts.items()]


def test_gold_replay_and_negative_controls(spark):
    reordered = GOLD | {"hard_filters": [GOLD["hard_filters"][1] | {"value": 3}, GOLD["hard_filters"][0] | {"values": ["peanut", "matcha"]}]}
    wrong = mutations(GOLD)
    texts = {"gold": json.dumps(GOLD), "reordered": json.dumps(reordered), "null": None} | wrong
    frame = spark.createDataFrame(rows(texts), "run_id string, case_id string, state string, expected string, assertions string, text string")
    got = {(r.case_id, r.name, r.field): r.score for r in score(frame, CATALOG).collect()}
    for good in ("gold", "reordered"):
        assert [got[good, t, f] for t, f in ASSERTIONS] == [1.0] * 16
        assert all(v in (1.0, None) for (c, n, _), v in got.items() if c == good and n not in ("tp", "fp", "fn"))
        assert (got[good, "tp", None], got[good, "fp", None], got[good, "fn", None]) == (4, 0, 0)
    for name in wrong:
        field = dict(ASSERTIONS).get(name)
        assert got[name, name, field] == 0.0, name
    assert got["null", "schema_valid", None] == 0 and got["null", "fn", None] == 4
    means = reports.mean_scores(score(frame, CATALOG).where("kind = 'metric'"), ["name"])
    assert means.where("name = 'schema_valid'").first().applicable == len(texts)


def scored(spark, expected, text, asked, state=None):
    """Scores by name and field of one answer."""
    row = ("r", "c", state and json.dumps(state), json.dumps(expected), json.dumps([{"type": t, "field": f} for t, f in asked]), text)
    frame = spark.createDataFrame([row], "run_id string, case_id string, state string, expected string, assertions string, text string")
    return {(r.name, r.field): r.score for r in score(frame, CATALOG).collect()}


def test_unknown_value_is_read_from_the_raw_object(spark):
    asked = [("no_unknown_field", None), ("no_unknown_value", None), ("no_unknown_value", "flavor"), ("no_unknown_value", "allergen")]
    text = json.dumps(patch(hard_filters=[condition("flavor", "in", values=["vanilla"])]))
    got = scored(spark, GOLD, text, asked)
    assert got["schema_valid", None] == 0
    assert [got[a] for a in asked] == [1, 0, 0, 1]
    assert [scored(spark, GOLD, "[1, 2]", asked)[a] for a in asked] == [0, 0, 0, 0]


def test_single_checks_differ_where_they_should(spark):
    """Each answer changes one trait of the gold condition; only the checks of that trait fail."""
    traits = [("operator_correct", "price"), ("value_normalized", "price"), ("hard_soft_correct", None), ("field_exact", "price")]
    gold = patch(hard_filters=[condition("price", "gte", value=5, unit="USD")])
    answers = {
        "same": (patch(hard_filters=[condition("price", "gte", value=5.0, unit="USD")]), [1, 1, 1, 1]),
        "operator": (patch(hard_filters=[condition("price", "lte", value=5, unit="USD")]), [0, 1, 1, 0]),
        "value": (patch(hard_filters=[condition("price", "gte", value=6, unit="USD")]), [1, 0, 0, 0]),
        "kind": (patch(soft_preferences=[condition("price", "around", soft=True, value=5, unit="USD")]), [0, 1, 0, 0]),
        "more": (patch(hard_filters=gold["hard_filters"], query_text="x"), [1, 1, 1, 1]),
    }
    for name, (answer, want) in answers.items():
        got = scored(spark, gold, json.dumps(answer), [*traits, ("no_hallucinated_filter", None), ("no_hallucinated_filter", "price")])
        assert [got[t] for t in traits] == want, name
        assert got["no_hallucinated_filter", None] == (name == "same"), name
        assert got["no_hallucinated_filter", "price"] == (name in ("same", "more")), name


def test_state_checks(spark):
    state = {"query_text": None, "hard_filters": [condition("level", "gte", value=2)], "soft_preferences": [], "sort": None}
    same = patch(hard_filters=[condition("level", "gte", value=2)])
    asked = [("minimal_patch", None), ("minimal_patch", "level"), ("field_replaced", "level"), ("field_preserved", "level")]
    got = scored(spark, same, json.dumps(same), asked, state)
    assert [got[a] for a in asked] == [0, 0, 0, 1]
    other = patch(hard_filters=[condition("level", "gte", value=3)])
    assert [scored(spark, other, json.dumps(other), asked, state)[a] for a in asked] == [1, 1, 1, 0]
    fresh = other | {"reset": True}
    assert [scored(spark, fresh, json.dumps(fresh), asked, state)[a] for a in asked] == [1, 1, 0, 0]
    # nothing to preserve, nothing negative: these don't apply
    got = scored(spark, patch(query_text="x"), json.dumps(patch(query_text="x")), [])
    assert got["state_preserve", None] is None and got["negation", None] is None and got["assertions", None] is None


def test_statistics_by_dimension(spark):
    frame = spark.createDataFrame(rows({"gold": json.dumps(GOLD), "null": None}), "run_id string, case_id string, state string, expected string, assertions string, text string")
    got = {r.label: (r["count"], r.n_passed) for r in evaluation.assertion_statistics(score(frame, CATALOG)).collect()}
    counts = {}
    for kind, _ in ASSERTIONS:
        counts[DIMENSIONS[kind]] = counts.get(DIMENSIONS[kind], 0) + 1
    assert {k.removeprefix("dimension:"): v for k, v in got.items() if k.startswith("dimension:")} == {d: (2 * n, n) for d, n in counts.items()}
    assert got["type:field_exact"] == (2, 1)


def test_unsupported_assertions_are_errors(spark):
    for bad in (("field_exact", None), ("operator_correct", "sort"), ("no_such_check", "level")):
        with pytest.raises(Exception, match="unsupported assertion"):
            scored(spark, GOLD, json.dumps(GOLD), [bad])


def test_scorer_names_are_unique(spark):
    frame = spark.createDataFrame(rows({"gold": "{}"}), "run_id string, case_id string, state string, expected string, assertions string, text string")
    with pytest.raises(ValueError, match="two scorers"):
        score(frame, CATALOG, evaluation.SCORERS | {"again": evaluation.patch_metrics})


def sample(**parts):
    base = {"id": "s1", "scenario": "replace", "tags": ["x"], "input": {"current_search_state": STATE, "user_input": "a fancy one"}, "expected": GOLD, "assertions": [{"type": "field_exact", "field": "flavor"}]}
    return base | parts


def test_sample_contract():
    assert sample_errors(sample(), CATALOG) == []
    assert sample_errors(sample(scenario="reset"), CATALOG)
    assert sample_errors(sample(input={"current_search_state": STATE, "user_input": "plain"}), CATALOG)
    assert sample_errors(sample(tags=[]), CATALOG)
    assert sample_errors(sample(assertions=[{"type": "field_cleared", "field": "flavor"}]), CATALOG)
    assert sample_errors(sample(expected=GOLD | {"reset": True}), CATALOG)
    assert sample_errors({}, CATALOG)
    for kind, field, fine in (
        ("field_exact", "flavor", True), ("field_exact", "price", True), ("field_exact", "allergen", False), ("operator_correct", "level", True),
        ("operator_correct", "sort", False), ("value_normalized", "size", False), ("field_preserved", "allergen", True), ("field_preserved", "level", False),
        ("field_replaced", "level", True), ("field_replaced", "flavor", False), ("field_cleared", "query_text", True), ("field_cleared", "sort", False),
        ("minimal_patch", None, True), ("minimal_patch", "level", True), ("negation_correct", None, True), ("field_exact", None, False), ("nothing", None, False),
    ):
        assert (sample_errors(sample(assertions=[{"type": kind, "field": field}]), CATALOG) == []) == fine, (kind, field)
    idle = GOLD | {"hard_filters": [condition("level", "gte", value=2)], "soft_preferences": []}
    assert sample_errors(sample(expected=idle, scenario="clear", assertions=[{"type": "minimal_patch", "field": None}]), CATALOG)
    assert sample_errors(sample(assertions=[{"type": "sort_correct", "field": None}] * 2), CATALOG)
    tags = evaluation.derive_tags(sample(), CATALOG)
    assert tags[:2] == ["multi_turn", "replace"] and {"hard_soft", "clear", "preserve_state", "unmapped", "relative_numeric"} <= set(tags)
