"""Terms and cues in clauses against plain searches, and what texts fail to say of their plans."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodeframe.facets import load_catalog
from lodeframe.functions import text as T
from lodeframe.operators import clauses as C

TERMS = {
    ("term", "flavor=choc"): ["choc", "Dark Chocolate", "巧克力"],
    ("term", "size=big"): ["big", "extra-large", "大号", "a级", "$5"],
    ("term", "size=no_nut"): ["no_nut", "无 坚果"],
    ("negative", "no"): ["no", "don't", "不要"],
    ("preference", "prefer"): ["prefer", "preferred"],
}
ODD = [
    None,
    "",
    "no chocolate, choc!choc",
    "dark   chocolate; dark--chocolate. dark chocolates",
    "I don’t prefer DARK–Chocolate",
    "不要巧克力大号，无 坚果；ba级 a级级",
    "piano choc_x xchoc no_nut no nut",
    "$5 x$5 $55 -- no - choc",
    "extra-large extra large extra  -large",
    ",,;.\n\n",
    "choc " * 150,
]


def plain_spans(text, terms):
    out = set()
    for k, clause in enumerate(re.split(C.CLAUSE_MARKS, text.lower().replace("’", "'"))):
        for (kind, name), found in terms.items():
            best = {}
            for term in found:
                term = term.strip().lower()
                if term.isascii():
                    body = r"[\s\-‐-―]+".join(map(re.escape, term.split()))
                    pattern = re.compile(r"(?=(?<![a-z0-9_])(" + body + r")(?![a-z0-9_]))")
                else:
                    pattern = re.compile(f"(?=({re.escape(term)}))")
                for m in pattern.finditer(clause):
                    best[m.start(1)] = max(best.get(m.start(1), 0), m.end(1))
            out |= {(k, kind, name, a, b) for a, b in best.items()}
    return out


def odd_texts():
    rng = random.Random(6)
    parts = ["choc", " ", "no ", "dark", "-", "chocolate", "，", "不要", "巧克力", "大号", "a级", "don't ", "prefer ", "$5", "_", "x", ". ", "无 坚果", "  "]
    return ODD + ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(80)]


def test_only_atoms_of_terms_are_placed(spark):
    text = "no " + "dark " * 400 + "chocolate"
    clauses = C.split_clauses(spark.createDataFrame([(1, text), (2, "a dark day")], "id int, text string"))
    spans = C.find_spans(clauses, ["id"], C.term_table(spark, {("term", "c"): ["dark chocolate"], ("negative", "n"): ["no"]}))
    assert {(r.id, r.start, r.end) for r in spans.collect()} == {(1, 0, 2), (1, 3 + 5 * 399, len(text))}
    assert "IN (" in (plan := spans._jdf.queryExecution().optimizedPlan().toString()) or "INSET" in plan


def test_spans_and_bound_cues(spark):
    texts = odd_texts()
    # clashing column names ride along
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "id int, text string, name string, at int").select("id", "text")
    clauses = C.split_clauses(docs)
    spans = C.find_spans(clauses, ["id"], C.term_table(spark, TERMS)).cache()
    found = {}
    for r in spans.collect():
        assert (r.clause_no, r.kind, r.name, r.start, r.end) not in found.setdefault(r.id, set())
        found[r.id].add((r.clause_no, r.kind, r.name, r.start, r.end))
    for k, t in enumerate(texts):
        assert found.get(k, set()) == (plain_spans(t, TERMS) if t else set()), t
    cues = {(r.id, r.clause_no, r.kind, r.start, r.name): (r.bound, r.distance) for r in C.bind_cues(spans, ["id"]).collect()}
    assert len(cues) == sum(kind != "term" for own in found.values() for _, kind, *_ in own)
    for (k, no, _, start, name), got in cues.items():
        end = max(e for n, _, m, s, e in found[k] if (n, m, s) == (no, name, start))
        own = sorted((s, True, e, m) for n, kind, m, s, e in found[k] if n == no and kind == "term")
        before, after = [x for x in own if x[0] < start], [x for x in own if x[0] >= start]
        near = []
        if after:
            near.append((max(after[0][0] - end, 0), 0, after[0][3]))
        if before:
            near.append((max(start - before[-1][2], 0), 1, before[-1][3]))
        assert got == ((min(near)[2], min(near)[0]) if near else (None, None))


def test_running_starts(spark):
    for n in (0, 1, 64, 65, 1000):
        numbers = [random.Random(n).randrange(9) for _ in range(n)]
        out = spark.createDataFrame([(numbers,)], "n array<int>").select(T.starts(F.col("n"))).first()[0]
        assert out == [sum(numbers[:k]) for k in range(n)]


CATALOG = """
registry_version: "1.0"
search: {query_fields: [comment]}
fields:
  - name: flavor
    type: categorical
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    values: [{code: choc, label: Chocolate, aliases: [巧克力]}, {code: plum, label: Plum, aliases: []}]
  - name: allergen
    type: categorical
    hard_operators: [in, not_in]
    soft_operators: [avoid]
    values: [{code: nuts, label: Nuts, aliases: [坚果]}]
  - name: price
    type: number
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    unit_kind: currency
    base_unit: USD
    units: [{code: USD, factor: "1"}, {code: CNY, factor: "0.14"}]
  - name: weight
    type: number
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    unit_kind: mass
    base_unit: g
    units: [{code: g, factor: "1"}, {code: kg, factor: "1000"}]
"""

#: text, conditions (kind, field, operator, codes, numbers, unit), query text, reset, cleared fields, errors
CASES = [
    ("Chocolate please", [("hard", "flavor", "in", ["choc"], [], None)], None, False, 0, []),
    ("no chocolate please", [("hard", "flavor", "in", ["choc"], [], None)], None, False, 0, ["negation:flavor"]),
    ("no chocolate please", [("hard", "flavor", "not_in", ["choc"], [], None)], None, False, 0, []),
    ("not plum, chocolate", [("hard", "flavor", "in", ["choc"], [], None)], None, False, 0, []),
    ("no flavor chocolate, chocolate", [("hard", "flavor", "in", ["choc"], [], None)], None, False, 0, ["negation:flavor"]),
    ("sweet things", [("hard", "flavor", "in", ["choc", "plum"], [], None)], None, False, 0, ["ungrounded:flavor=choc", "ungrounded:flavor=plum"]),
    ("allergic to nuts", [("hard", "allergen", "not_in", ["nuts"], [], None)], None, False, 0, []),
    ("对坚果过敏", [("hard", "allergen", "not_in", ["nuts"], [], None)], None, False, 0, []),
    ("allergic to chocolate", [("hard", "flavor", "in", ["choc"], [], None)], None, False, 0, ["allergy:flavor"]),
    ("I preferred plum", [("soft", "flavor", "prefer", ["plum"], [], None)], None, False, 0, []),
    ("plum it is", [("soft", "flavor", "prefer", ["plum"], [], None)], None, False, 0, ["preference:flavor"]),
    ("ideally plum", [("hard", "flavor", "in", ["plum"], [], None)], None, False, 0, ["softened:flavor"]),
    ("under 20 dollars", [("hard", "price", "lte", [], ["20"], "USD")], None, False, 0, []),
    ("under 20元", [("hard", "price", "lte", [], ["20"], "CNY")], None, False, 0, []),
    ("under 20", [("hard", "price", "lte", [], ["20"], "USD")], None, False, 0, ["unit:price"]),
    ("under 20 €", [("hard", "price", "lte", [], ["20"], None)], None, False, 0, ["currency:price"]),
    ("2.5 kg or 3", [("hard", "weight", "between", [], ["2.50", "4"], "kg")], None, False, 0, ["number:weight"]),
    ("5千克以下的蛋糕", [("hard", "weight", "lte", [], ["5"], "g")], None, False, 0, ["unit:weight"]),
    ("abc", [], None, False, 0, ["short"]),
    (None, [], None, False, 0, ["short"]),
    ("show cakes", [], "Birthday", True, 2, ["clear", "query_text", "reset"]),
    ("start over, birthday, remove all", [], "Birthday", True, 1, []),
]


def test_planned_texts(spark):
    samples = spark.createDataFrame([(k, c[0], c[2], c[3], c[4]) for k, c in enumerate(CASES)], "id int, text string, query_text string, reset boolean, clears int")
    rows = [(k, p, *c[:4], [Decimal(n) for n in c[4]], c[5]) for k, case in enumerate(CASES) for p, c in enumerate(case[1])]
    conditions = spark.createDataFrame(rows, "id int, place int, kind string, field string, operator string, codes array<string>, numbers array<decimal(38,10)>, unit string")
    out = {r.id: r.errors for r in C.planned_text_errors(samples, conditions, load_catalog(CATALOG)).collect()}
    assert out == {k: c[5] for k, c in enumerate(CASES)}
    # words of another language as cues
    more = C.planned_text_errors(samples, conditions, load_catalog(CATALOG), {"negative": ("please",)})
    assert {r.id: r.errors for r in more.collect()}[0] == ["negation:flavor"]
    assert C.planned_text_errors(samples.limit(0), conditions.limit(0), load_catalog(CATALOG)).collect() == []


def test_reply_likeness_is_that_of_normalised_texts(spark):
    rows = [("好的，请问两点？", ["好的 请问2点"], 1.0), ("好的，请问两点？", [], 1.0), ("abc", ["xyz", "a-b-c"], 1.0), ("ab", ["zz"], 0.7), ("", ["a"], 0.7)]
    df = spark.createDataFrame([(r, x) for r, x, _ in rows], "reply string, refs array<string>")
    none = F.array().cast("array<string>")
    out = df.select(T.judge_reply(F.col("reply"), none, none, F.col("refs"))["score"]).collect()
    assert [r[0] for r in out] == [pytest.approx(s) for _, _, s in rows]
