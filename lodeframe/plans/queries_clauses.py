"""Queries of terms and cues in clauses, on the texts of documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..facets import load_catalog
from ..functions import text as T
from ..operators import clauses
from .catalog import register, table

#: Words of the tables' languages, as terms and as cues.
WORDS = {
    ("term", "article"): ("the", "le", "la", "der"),
    ("term", "joiner"): ("and", "et", "und", "of the"),
    ("negative", "with"): ("with", "avec", "mit"),
    ("preference", "for"): ("for", "pour"),
}
_MARKS = "[，,；;。.!?！？\\n]"
_SPANS = f"""
texts AS (SELECT 'documents' AS origin, doc_id::VARCHAR AS id, text FROM documents UNION ALL SELECT 'conversations', conv_id || '-' || turn, text FROM conversations),
pieces AS (SELECT origin, id, string_split_regex(translate(lower(text), '’‘', ''''''), '{_MARKS}') AS all_ FROM texts),
clauses AS (SELECT origin, id, k AS clause_no, all_[k] AS clause FROM (SELECT *, unnest(range(1, len(all_) + 1)) AS k FROM pieces)),
atomised AS (SELECT origin, id, clause_no, regexp_extract_all(clause, '[a-z0-9_]+|[\\s\\-]+|[^a-z0-9_\\s\\-]') AS atoms FROM clauses),
placed AS (SELECT origin, id, clause_no, k, atoms[k] AS atom, atoms[k + 1] AS gap, atoms[k + 2] AS next FROM (SELECT *, unnest(range(1, len(atoms) + 1)) AS k FROM atomised)),
started AS (SELECT *, sum(length(atom)) OVER (PARTITION BY origin, id, clause_no ORDER BY k) - length(atom) AS start_ FROM placed),
spans AS (
  SELECT origin, id, clause_no, start_, start_ + length(atom) AS end_,
         CASE WHEN atom IN ('the', 'le', 'la', 'der') THEN 'article' WHEN atom IN ('and', 'et', 'und') THEN 'joiner' WHEN atom IN ('with', 'avec', 'mit') THEN 'with' ELSE 'for' END AS name
  FROM started WHERE atom IN ('the', 'le', 'la', 'der', 'and', 'et', 'und', 'with', 'avec', 'mit', 'for', 'pour')
  UNION ALL
  SELECT origin, id, clause_no, start_, start_ + length(atom || gap || next), 'joiner' FROM started WHERE atom = 'of' AND next = 'the' AND regexp_full_match(gap, '[\\s\\-]+')
),
kinds AS (SELECT *, CASE name WHEN 'with' THEN 'negative' WHEN 'for' THEN 'preference' ELSE 'term' END AS kind FROM spans)"""


@register(f"""
WITH {_SPANS},
beside AS (
  SELECT *, last_value(CASE WHEN kind = 'term' THEN {{'name': name, 's': start_, 'e': end_}} END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
         first_value(CASE WHEN kind = 'term' THEN {{'name': name, 's': start_, 'e': end_}} END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a
  FROM kinds WINDOW w AS (PARTITION BY origin, id, clause_no ORDER BY start_, kind = 'term', end_, kind, name)
), near AS (
  SELECT *, CASE WHEN b IS NOT NULL THEN greatest(start_ - b.e, 0) END AS gap_b, CASE WHEN a IS NOT NULL THEN greatest(a.s - end_, 0) END AS gap_a FROM beside WHERE kind <> 'term'
), bound_ AS (
  SELECT *, b IS NOT NULL AND (a IS NULL OR gap_b < gap_a) AS first_ FROM near
)
SELECT origin, kind, name, CASE WHEN first_ THEN b.name ELSE a.name END AS bound, count(*) AS cues, sum(start_)::BIGINT AS starts, sum(CASE WHEN first_ THEN gap_b ELSE gap_a END)::BIGINT AS distances
FROM bound_ GROUP BY ALL
""")
def cue_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues of all texts with the term of their clause that each is nearest to, counted by cue and term."""
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").cast("string").alias("id"), "text")
    said = table(spark, sf_dir, "conversations").select(F.lit("conversations").alias("origin"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    keys = ["origin", "id"]
    spans = clauses.find_spans(clauses.split_clauses(docs.unionByName(said)), keys, clauses.term_table(spark, WORDS))
    found = clauses.bind_cues(spans, keys)
    return found.groupBy("origin", "kind", "name", "bound").agg(F.count("*").alias("cues"), F.sum("start").alias("starts"), F.sum("distance").alias("distances"))


#: Values that the turns of the conversations name, with cues in their languages.
GRAMMAR = load_catalog("""
registry_version: "1.0"
search: {query_fields: [text]}
fields:
  - name: article
    type: categorical
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    values: [{code: d, label: the, aliases: []}, {code: m, label: le, aliases: [der]}, {code: f, label: la, aliases: [die]}]
  - name: joiner
    type: categorical
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    values: [{code: both, label: and, aliases: [et, und]}, {code: part, label: of, aliases: [de]}]
""")
LOCAL_CUES = {"negative": ("with", "avec", "mit"), "preference": ("for", "pour"), "optional": ("by", "est")}


@register(r"""
WITH turns AS (
  SELECT conv_id || '-' || turn AS id, text, lower(text) AS said, (conv_id + turn)::BIGINT AS k FROM conversations WHERE role = 'user'
), conditions AS (
  SELECT id, k, 0 AS place, 'hard' AS kind, 'article' AS field, k % 3 = 1 AS refuses, [['d', 'm', 'f'][k % 3 + 1]] AS codes FROM turns
  UNION ALL SELECT id, k, 1, 'soft', 'joiner', k % 2 = 1, CASE WHEN k % 5 = 0 THEN ['both', 'part'] ELSE ['both'] END FROM turns WHERE k % 4 <> 0
), words AS (SELECT * FROM (VALUES ('article', 'd', ['d', 'the']), ('article', 'm', ['m', 'le', 'der']), ('article', 'f', ['f', 'la', 'die']), ('joiner', 'both', ['both', 'and', 'et', 'und']), ('joiner', 'part', ['part', 'of', 'de'])) t(field, code, names)
), clauses AS (
  SELECT id, clause, regexp_extract_all(clause, '[a-z0-9_]+') AS held FROM (SELECT id, unnest(string_split_regex(said, '[，,；;。.!?！？\n]')) AS clause FROM turns)
), wanted AS (
  SELECT c.*, w.code, w.names FROM (SELECT *, unnest(codes) AS code_ FROM conditions) c JOIN words w ON w.field = c.field AND w.code = c.code_
), heard AS (
  SELECT w.id, w.place, contains(l.clause, w.field) AS explicit, list_has_any(held, ['with', 'avec', 'mit', 'no', 'not', 'without', 'avoid', 'exclude']) AS neg, list_has_any(held, ['for', 'pour', 'rather', 'ideally', 'prefer']) AS pref,
         list_has_any(held, ['by', 'est', 'ideally', 'prefer']) AS opt, w.code
  FROM wanted w JOIN clauses l ON w.id = l.id AND list_has_any(held, names)
), summed AS (
  SELECT id, place, coalesce(CASE WHEN bool_or(explicit) THEN bool_or(neg AND explicit) ELSE bool_or(neg) END, false) AS neg,
         CASE WHEN bool_or(explicit) THEN bool_or(pref AND explicit) ELSE bool_or(pref) END AS pref, CASE WHEN bool_or(explicit) THEN bool_or(opt AND explicit) ELSE bool_or(opt) END AS opt
  FROM heard GROUP BY ALL
), errors AS (
  SELECT w.id, 'ungrounded:' || w.field || '=' || w.code AS error FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM heard h WHERE h.id = w.id AND h.code = w.code)
  UNION ALL SELECT c.id, 'negation:' || field FROM conditions c LEFT JOIN summed s ON c.id = s.id AND c.place = s.place WHERE coalesce(neg, false) <> refuses
  UNION ALL SELECT c.id, 'preference:' || field FROM conditions c LEFT JOIN summed s ON c.id = s.id AND c.place = s.place WHERE kind = 'soft' AND NOT coalesce(pref, false)
  UNION ALL SELECT c.id, 'softened:' || field FROM conditions c LEFT JOIN summed s ON c.id = s.id AND c.place = s.place WHERE kind = 'hard' AND coalesce(opt, false)
  UNION ALL SELECT id, 'short' FROM turns WHERE length(regexp_replace(coalesce(said, ''), '[^\p{L}\p{N}]', '', 'g')) < 4
  UNION ALL SELECT id, 'query_text' FROM turns WHERE NOT contains(coalesce(said, ''), CASE WHEN k % 2 = 0 THEN 'le' ELSE 'er' END)
  UNION ALL SELECT id, 'reset' FROM turns WHERE k % 7 = 0 AND NOT (contains(coalesce(said, ''), 'reset') OR contains(coalesce(said, ''), 'restart'))
  UNION ALL SELECT id, 'clear' FROM turns WHERE k % 6 = 0 AND NOT (contains(coalesce(said, ''), 'clear') OR contains(coalesce(said, ''), 'drop') OR contains(coalesce(said, ''), 'remove') OR contains(coalesce(said, ''), 'cancel'))
)
SELECT t.id, coalesce((SELECT string_agg(DISTINCT error, ' ' ORDER BY error) FROM errors e WHERE e.id = t.id), '') AS errors FROM turns t
""")
def planned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user turn fails to say of a plan that its numbers choose: values, polarity, wishes, a phrase, a reset, cleared fields."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    k = F.col("conv_id") + F.col("turn")
    turns = turns.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text", k.alias("k"))
    pick = lambda on, yes, no: F.when(on, yes).otherwise(no)
    k = F.col("k")
    hard = F.struct(F.lit(0).alias("place"), F.lit("hard").alias("kind"), F.lit("article").alias("field"), pick(k % 3 == 1, "not_in", "in").alias("operator"), F.array(F.element_at(F.array(*map(F.lit, "dmf")), (k % 3 + 1).cast("int"))).alias("codes"))
    soft = F.struct(F.lit(1).alias("place"), F.lit("soft").alias("kind"), F.lit("joiner").alias("field"), pick(k % 2 == 1, "avoid", "prefer").alias("operator"), pick(k % 5 == 0, F.array(F.lit("both"), F.lit("part")), F.array(F.lit("both"))).alias("codes"))
    wanted = turns.select("id", F.explode(pick(k % 4 == 0, F.array(hard), F.array(hard, soft))).alias("c")).select("id", "c.*", F.lit(None).cast("array<decimal(38,10)>").alias("numbers"), F.lit(None).cast("string").alias("unit"))
    samples = turns.select("id", "text", pick(k % 2 == 0, "le", "er").alias("query_text"), (k % 7 == 0).alias("reset"), pick(k % 6 == 0, 1, 0).alias("clears"))
    found = clauses.planned_text_errors(samples, wanted, GRAMMAR, LOCAL_CUES)
    return found.select("id", F.array_join("errors", " ").alias("errors"))


_SHOUTED = "replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ', ', ')"
_PLAIN = r"regexp_replace(regexp_replace(lower(trim(regexp_replace({}, '\s+', ' ', 'g'))), '1小时', '60分钟', 'g'), '[\s，。！？、；：,.!?;:''\"“”‘’（）()【】\[\]—-]+', '', 'g')"


@register(f"""
WITH items AS (SELECT item_id, text, lead(text) OVER (ORDER BY item_id) AS following FROM benchmark),
sides AS (
  SELECT item_id, 0 AS ref, {_PLAIN.format('text')} AS a, {_PLAIN.format(_SHOUTED)} AS b FROM items WHERE item_id % 2 = 0
  UNION ALL SELECT item_id, 1, {_PLAIN.format('text')}, {_PLAIN.format('following')} FROM items WHERE following IS NOT NULL
), grams AS (
  SELECT item_id, ref, side, n, substr(t, k, n) AS g, count(*) AS c
  FROM (SELECT *, unnest(range(1, length(t) - n + 2)) AS k FROM (SELECT item_id, ref, side, n, CASE side WHEN 'a' THEN a ELSE b END AS t FROM sides, (VALUES ('a'), ('b')) s(side), (VALUES (2), (3)) z(n)))
  GROUP BY ALL
), f1 AS (
  SELECT item_id, ref, n, 2 * coalesce(sum(least(x, y)) FILTER (x IS NOT NULL AND y IS NOT NULL), 0) / (sum(coalesce(x, 0)) + sum(coalesce(y, 0)))::DOUBLE AS f
  FROM (SELECT item_id, ref, n, g, sum(c) FILTER (side = 'a') AS x, sum(c) FILTER (side = 'b') AS y FROM grams GROUP BY ALL) GROUP BY ALL
), best AS (SELECT item_id, max(f) AS f FROM (SELECT item_id, ref, avg(f) AS f FROM f1 GROUP BY ALL) GROUP BY item_id)
SELECT item_id, round(0.70 + 0.30 * coalesce(f, 1.0), 6) AS score FROM items LEFT JOIN best USING (item_id)
""")
def reply_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reply score of every benchmark text against the next one and, for even ids, itself in other letters and marks."""
    items = table(spark, sf_dir, "benchmark")
    after = items.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("following"))
    both = items.join(after, "item_id", "left")
    refs = F.array_compact(F.array(F.col("following"), F.when(F.col("item_id") % 2 == 0, F.expr(_SHOUTED))))
    none = F.array().cast("array<string>")
    return both.select("item_id", F.round(T.judge_reply(F.col("text"), none, none, refs)["score"], 6).alias("score"))
