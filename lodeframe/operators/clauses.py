"""Terms and cues in the clauses of texts, and what they say about conditions.

Texts are split into clauses, clauses into atoms (runs of ASCII letters, digits and
underscores, and single other characters) with their places.  Terms meet the atoms
by their own first atom, an equality join, and are then read out at that place, so
every mention has its span and no text is searched once a term.

A cue (a negation, a wish, an allergy) speaks for its clause; ``bind_cues`` also
ties each cue to the term of its clause that stands nearest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..facets import Catalog
from ..functions import text as T
from .generation import small

#: Fixed value: marks between clauses.
CLAUSE_MARKS = "[，,；;。.!?！？\n]"

#: Cues by kind.
CUES: dict[str, tuple[str, ...]] = {
    "negative": (
        "不要", "排除", "不含", "不能含", "不想要", "不太想要", "不太想选", "别用", "避免", "避开", "不选", "exclude", "avoid", "without", "no", "not", "don't",
        "do not", "steer clear of", "stay away from", "rather not", "not keen on", "not a fan of",
    ),
    "preference": (
        "最好", "优先", "尽量", "偏好", "希望", "软偏好", "prefer", "ideally", "if possible", "would like", "rather", "不太想要", "不太想选", "not keen on", "not a fan of",
    ),
    "optional": ("最好", "优先", "尽量", "偏好", "prefer", "ideally", "if possible"),
}
#: Other forms that a cue stands for.
FORMS: dict[str, tuple[str, ...]] = {
    "prefer": ("prefer", "prefers", "preferred", "preferring", "preference", "preferences", "preferably"),
    "avoid": ("avoid", "avoids", "avoided", "avoiding", "avoidance"),
    "exclude": ("exclude", "excludes", "excluded", "excluding"),
}
#: Signs of an allergy, which stand for themselves even inside a word.
ALLERGY = ("过敏", "allergic")
#: How a unit is written; those of a currency also tell that a price has one.
UNITS: dict[str, tuple[str, ...]] = {
    "g": ("g", "克", "gram", "grams"),
    "kg": ("kg", "公斤", "千克", "kilogram", "kilograms"),
    "oz": ("oz", "盎司", "ounce", "ounces"),
    "USD": ("usd", "美元", "dollar", "dollars", "$"),
    "EUR": ("eur", "欧元", "euro", "euros", "€"),
    "CNY": ("cny", "人民币", "rmb", "元"),
}
CURRENCIES = ("USD", "EUR", "CNY")
#: Words that start a search anew, and that take conditions away.
RESETS = ("重新", "重来", "从头", "reset", "start over", "restart", "start again")
CLEARS = ("取消", "清除", "不限", "不要", "去掉", "remove", "clear", "cancel", "no limit", "drop")
#: Fixed value: letters and digits that a request has at least.
LEAST_LETTERS = 4

#: Atoms of terms up to which the others are left out at once; atoms of a clause up to which places aren't summed up beforehand.
MET, BRIEF = 1000, 256

#: Runs of ASCII letters, digits and underscores; of white space and hyphens; single other characters.
ATOM = r"[a-z0-9_]+|[\s\-\x{2010}-\x{2015}]+|[^a-z0-9_\s\-\x{2010}-\x{2015}]"
BETWEEN = r"[\s\-\x{2010}-\x{2015}]+"
SPACE = r"(?U)\s+"
WORD_END, WORD_START = "[a-z0-9_]$", "(?![a-z0-9_])"


def split_clauses(texts: DataFrame, text: str = "text", marks: str = CLAUSE_MARKS) -> DataFrame:
    """``texts`` with one row a clause instead: ``clause_no`` (from 0) and ``clause``, lower-cased, curly apostrophes straightened; null texts have none."""
    plain = F.translate(F.lower(F.col(text)), "’‘", "''")
    return texts.select(*[c for c in texts.columns if c != text], F.posexplode(F.split(plain, marks)).alias("clause_no", "clause"))


def term_table(spark: SparkSession, terms: Mapping[tuple[str, str], Sequence[str]]) -> DataFrame:
    """``kind, name, term`` of the terms of each ``(kind, name)``."""
    rows = [(kind, name, term) for (kind, name), found in terms.items() for term in dict.fromkeys(found)]
    return spark.createDataFrame(rows, "kind string, name string, term string")


def cue_terms(cues: Mapping[str, Sequence[str]] = CUES) -> dict[tuple[str, str], Sequence[str]]:
    """Cues as terms named by themselves."""
    return {(kind, cue): FORMS.get(cue, (cue,)) for kind, found in cues.items() for cue in found}


def value_terms(catalog: Catalog) -> dict[tuple[str, str], Sequence[str]]:
    """Codes, labels and aliases of a catalog's values, named ``field=code``."""
    return {("term", f"{f.name}={v.code}"): [v.code, v.label, *v.aliases] for f in catalog.fields for v in f.values}


def _readable(terms: DataFrame) -> DataFrame:
    """Terms with the atom by which they are met, what stands before it, and what reads the rest.

    ASCII terms are met by their first atom; others by their first character beyond
    ASCII, as letters before it may be the end of a longer word.
    """
    term = F.lower(F.trim("term"))
    read = terms.select("kind", "name", term.alias("term")).where("term <> ''").distinct()
    ascii_only = F.col("term").rlike(r"^\p{ASCII}+$")
    lead = F.when(ascii_only, "").otherwise(F.regexp_extract("term", r"^\p{ASCII}*", 0))
    rest = F.substr("term", F.char_length("lead") + 1)
    escaped = F.regexp_replace(F.regexp_replace("rest", r"([^\w\s])", r"\\$1"), SPACE, BETWEEN.replace("\\", "\\\\"))
    read = read.withColumn("lead", lead).withColumn("rest", rest)
    pattern = F.when(ascii_only, F.concat(F.lit("^"), escaped, F.lit(WORD_START)))
    return read.select("kind", "name", "lead", "rest", pattern.alias("pattern"), F.regexp_extract("rest", ATOM, 0).alias("atom"), F.size(F.regexp_extract_all("term", F.lit(f"({ATOM})"), F.lit(1))).alias("atoms"))


def find_spans(clauses: DataFrame, keys: Sequence[str], terms: DataFrame) -> DataFrame:
    """``keys, clause_no, kind, name, start, end`` of every mention of ``terms(kind, name, term)`` in ``clauses(keys, clause_no, clause)``.

    ASCII terms stand at word borders with any white space or hyphens between their
    words, others anywhere.  Offsets count the code points of the clause from 0.
    Mentions that overlap are all found, one of several terms of a name at one place
    once.  Null and empty terms are nowhere.  A term that begins with a hyphen is
    met only where a run of hyphens and spaces begins.
    """
    readable = small(_readable(terms))
    around = readable.agg(F.coalesce(F.max("atoms"), F.lit(1))).first()[0]
    atoms = F.regexp_extract_all("clause", F.lit(f"({ATOM})"), F.lit(1))
    met = [r.atom for r in readable.select("atom").distinct().limit(MET + 1).collect()]
    # atoms that no term is met by go before their surroundings are made
    wanted = (lambda x: x["atom"].isin(*met)) if 0 < len(met) <= MET else (lambda x: F.lit(True))
    # every atom with its place and as many atoms before and behind it as the longest term has
    near = lambda all_, start, n: F.array_join(F.slice(all_, start, n), "")
    told = lambda v: F.filter(F.transform(v["all"], lambda a, k: F.struct(a.alias("atom"), k.alias("k"))), wanted)
    placed = lambda v: F.transform(
        told(v),
        lambda x: F.struct(
            x["atom"].alias("atom"),
            F.coalesce(F.get(v["starts"], x["k"]), F.char_length(near(v["all"], F.lit(1), x["k"]))).alias("at"),
            near(v["all"], F.greatest(x["k"] - around, F.lit(0)) + 1, F.least(x["k"], F.lit(around))).alias("before"),
            near(v["all"], x["k"] + 1, F.lit(around + 1)).alias("ahead"),
        ),
    )
    # in a short clause each place is read off what stands before it
    begun = lambda all_: F.when(F.size(all_) > BRIEF, T.starts(F.transform(all_, F.char_length)))
    every = T.bound(atoms, lambda all_: T.bound(F.struct(all_.alias("all"), begun(all_).alias("starts")), placed))
    rows = clauses.select(*keys, "clause_no", F.explode(every).alias("x")).select(*keys, "clause_no", "x.*")
    joined = rows.join(readable, "atom")
    word = F.expr("regexp_extract(ahead, pattern, 0)")
    as_word = (F.col("pattern").isNotNull()) & ~F.col("before").rlike(WORD_END) & (word != "")
    anywhere = F.col("pattern").isNull() & F.endswith("before", F.col("lead")) & F.startswith("ahead", F.col("rest"))
    start = F.col("at") - F.char_length("lead")
    end = F.when(F.col("pattern").isNotNull(), F.col("at") + F.char_length(word)).otherwise(F.col("at") + F.char_length("rest"))
    found = joined.where(as_word | anywhere).select(*keys, "clause_no", "kind", "name", start.alias("start"), end.alias("end"))
    return found.groupBy(*keys, "clause_no", "kind", "name", "start").agg(F.max("end").alias("end"))


def bind_cues(spans: DataFrame, keys: Sequence[str], term: str = "term") -> DataFrame:
    """Every cue of ``find_spans`` with the term of its clause that stands nearest: ``keys, clause_no, kind, name, start, end, bound, distance``.

    Nearest of the last term that starts before the cue and the first that starts
    with or after it; at equal distance the latter.  Without a term in the clause
    both are null.
    """
    order = [F.col("start"), F.col("kind") == term, F.col("end"), F.col("kind"), F.col("name")]
    clause = Window.partitionBy(*keys, "clause_no").orderBy(*order)
    own = F.when(F.col("kind") == term, F.struct("name", "start", "end"))
    before = F.last(own, ignorenulls=True).over(clause.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(own, ignorenulls=True).over(clause.rowsBetween(1, Window.unboundedFollowing))
    gap = lambda side, apart: F.when(F.col(side).isNotNull(), F.greatest(apart, F.lit(0)))
    gap_before, gap_after = gap("_b", F.col("start") - F.col("_b.end")), gap("_a", F.col("_a.start") - F.col("end"))
    first = F.col("_a").isNull() | (gap_before < gap_after)
    bound = F.when(F.col("_b").isNotNull() & first, F.col("_b.name")).otherwise(F.col("_a.name"))
    distance = F.when(F.col("_b").isNotNull() & first, gap_before).otherwise(gap_after)
    cues = spans.withColumns({"_b": before, "_a": after}).where(F.col("kind") != term)
    return cues.select(*keys, "clause_no", "kind", "name", "start", "end", bound.alias("bound"), distance.alias("distance"))


def clause_signs(clauses: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each clause that has a mention: its terms' names, and whether it has cues of each kind or tells of an allergy."""
    said = spans.groupBy(*keys, "clause_no").agg(F.collect_set(F.when(F.col("kind") == "term", F.col("name"))).alias("terms"), *[F.bool_or(F.col("kind") == kind).alias(kind) for kind in CUES])
    allergy = F.lit(False)
    for sign in ALLERGY:
        allergy = allergy | F.contains("clause", F.lit(sign))
    return clauses.join(said, [*keys, "clause_no"]).withColumn("allergy", allergy)


def polarity(signs: DataFrame, conditions: DataFrame) -> DataFrame:
    """What the clauses that name a condition's values say about it.

    ``conditions(id, place, kind, field, operator, codes)`` with ``signs`` by ``id``.
    Clauses that also name the field count alone where there are any.  Returns
    ``id, place, field, kind, operator, mentioned, negative, preference, optional, allergy``.
    """
    named = conditions.select("id", "place", "field", F.explode(F.transform(F.array_distinct("codes"), lambda c: F.concat("field", F.lit("="), c))).alias("name"))
    heard = named.join(signs.withColumn("name", F.explode("terms")), ["id", "name"]).withColumn("explicit", F.contains("clause", F.lower("field")))
    kinds = [*CUES, "allergy"]
    found = heard.groupBy("id", "place").agg(
        F.bool_or("explicit").alias("explicit"),
        *[F.bool_or(F.col(k) & F.col("explicit")).alias(f"{k}_explicit") for k in kinds],
        *[F.bool_or(k).alias(k) for k in kinds],
    )
    of = lambda k: F.coalesce(F.when(F.col("explicit"), F.col(f"{k}_explicit")).otherwise(F.col(k)), F.lit(False)).alias(k)
    joined = conditions.join(found, ["id", "place"], "left")
    return joined.select("id", "place", "field", "kind", "operator", F.col("explicit").isNotNull().alias("mentioned"), *map(of, kinds))


def mentions_unit(text: Column, unit: str) -> Column:
    """Whether a lower-cased text writes a unit: ASCII ones apart from letters, a bare yuan after a digit, a gram that isn't part of a kilogram."""
    hit = F.lit(False)
    for alias in UNITS.get(unit, (unit,)):
        alias = alias.lower()
        if alias == "元":
            hit = hit | text.rlike(r"\d\s*元")
        elif alias == "克":
            hit = hit | text.rlike("(?<!千)克")
        elif alias.isascii():
            hit = hit | text.rlike("(?<![a-z])" + "".join(c if c.isalnum() else f"\\{c}" for c in alias) + "(?![a-z])")
        else:
            hit = hit | F.contains(text, F.lit(alias))
    return hit


def planned_text_errors(samples: DataFrame, conditions: DataFrame, catalog: Catalog, extra_cues: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """What a generated text fails to say of its plan: ``id, errors`` of every sample, errors sorted.

    ``samples(id, text, query_text, reset, clears)`` with ``clears`` the number of
    cleared fields; ``conditions(id, place, kind, field, operator, codes, numbers,
    unit)`` with ``kind`` hard or soft and ``numbers`` as decimals in an array.
    ``extra_cues`` adds words to the cues of a kind.  A sample without conditions is
    held against its own rules alone; a null text is an empty one.
    """
    spark = samples.sparkSession
    cues = {k: (*CUES[k], *(extra_cues or {}).get(k, ())) for k in CUES}
    clauses = split_clauses(samples.select("id", "text"))
    spans = find_spans(clauses, ["id"], term_table(spark, value_terms(catalog) | cue_terms(cues)))
    heard = polarity(clause_signs(clauses, spans, ["id"]), conditions)
    listed = lambda test: F.col("field").isin(*[f.name for f in catalog.fields if test(f)])
    # values are named one by one: each code needs a mention of its own
    codes = conditions.select("id", "place", "field", F.explode("codes").alias("code")).withColumn("name", F.concat("field", F.lit("="), "code"))
    seen = spans.where("kind = 'term'").select("id", "name").distinct()
    absent = codes.join(seen, ["id", "name"], "left_anti").select("id", F.concat(F.lit("ungrounded:"), "name").alias("error"))
    negative = F.col("negative") | ((F.col("field") == "allergen") & F.col("allergy"))
    valued = listed(lambda f: bool(f.values))
    rules = {
        "negation": valued & (negative != F.col("operator").isin("not_in", "avoid")),
        "allergy": (F.col("field") == "flavor") & F.col("allergy"),
        "preference": valued & (F.col("kind") == "soft") & ~F.col("preference"),
        "softened": valued & (F.col("kind") == "hard") & (F.col("field") != "allergen") & F.col("optional"),
    }
    broken = F.array_compact(F.array(*[F.when(on, F.concat(F.lit(f"{name}:"), "field")) for name, on in rules.items()]))
    polar = heard.select("id", F.explode(broken).alias("error"))
    text = F.lower(F.coalesce("text", F.lit("")))
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"(?<![\d.])(-?\d+(?:\.\d+)?)(?!\d|\.\d)"), F.lit(1)), lambda x: x.cast("decimal(38,10)"))
    unit_of = F.lit(True)
    for unit in UNITS:
        unit_of = F.when(F.col("unit") == unit, mentions_unit(F.col("said"), unit)).otherwise(unit_of)
    unit_of = F.when(F.col("unit").isin(*UNITS), unit_of).otherwise(F.contains("said", F.lower("unit")))
    priced = F.lit(False)
    for unit in CURRENCIES:
        priced = priced | mentions_unit(F.col("said"), unit)
    beside = conditions.join(samples.select("id", text.alias("said"), numbers.alias("told")), "id")
    written = {
        "number": F.size(F.array_except(F.coalesce(F.col("numbers").cast("array<decimal(38,10)>"), F.array().cast("array<decimal(38,10)>")), "told")) > 0,
        "unit": F.col("unit").isNotNull() & ~unit_of,
        "currency": listed(lambda f: f.unit_kind == "currency") & F.col("unit").isNull() & priced,
    }
    told = beside.select("id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(on, F.lit(False)), F.concat(F.lit(f"{name}:"), "field")) for name, on in written.items()]))).alias("error"))
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))
    of_sample = {
        "short": F.char_length(F.regexp_replace(text, r"[^\p{L}\p{N}]", "")) < LEAST_LETTERS,
        "query_text": F.col("query_text").isNotNull() & ~F.contains(text, F.lower("query_text")),
        "reset": F.coalesce("reset", F.lit(False)) & ~has(RESETS),
        "clear": (F.coalesce("clears", F.lit(0)) > 0) & ~has(CLEARS),
    }
    own = samples.select("id", F.explode(F.array_compact(F.array(*[F.when(on, F.lit(name)) for name, on in of_sample.items()]))).alias("error"))
    errors = absent.unionByName(polar).unionByName(told).unionByName(own).groupBy("id").agg(F.array_sort(F.collect_set("error")).alias("errors"))
    return samples.select("id").join(errors, "id", "left").select("id", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))
