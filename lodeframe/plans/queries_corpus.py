"""Queries of corpus hygiene, splits, chat rendering and text likeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times, vectors
from ..operators import corpus, matching, pairing, ranking
from .catalog import register, table

_SQUEEZED = r"trim(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'))"
_FINGERPRINT = f"""sha256('{{"current_time":null,"history":[],"user_input":' || to_json({_SQUEEZED})::VARCHAR || '}}')"""


@register(rf"SELECT doc_id, sha256({_SQUEEZED}) AS text_sha256, length({_SQUEEZED}) AS n_squeezed FROM documents")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    squeezed = T.squeeze(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(squeezed, 256).alias("text_sha256"), F.char_length(squeezed).cast("long").alias("n_squeezed"))


@register(rf"SELECT first_doc AS doc_id, source, lang FROM (SELECT min(doc_id) AS first_doc FROM documents GROUP BY sha256({_SQUEEZED})) JOIN documents ON doc_id = first_doc")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "documents").select(T.fingerprint(F.col("text")).alias("fp"), "doc_id", "source", "lang")
    return ranking.keep_first(marked, ["fp"], "doc_id").select("doc_id", "source", "lang")


@register(rf"SELECT min(doc_id) AS first_row, count(*) AS n FROM documents GROUP BY sha256({_SQUEEZED}) HAVING count(*) > 1")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "documents").select(T.fingerprint(F.col("text")).alias("fp"), "doc_id")
    return corpus.duplicates(marked, ["fp"], "doc_id").select("first_row", "n")


@register("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def isolation_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    return corpus.containing(docs, items, "text", "item").select("doc_id", "item_id")


@register("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(d.text, b.text))")
def isolation_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.clean_of(table(spark, sf_dir, "documents").select("doc_id"), isolation_overlap(spark, sf_dir), "doc_id")


_KEYS = """
WITH parts AS (
  SELECT 'benchmark' AS part, sha256(trim(text)) AS key FROM benchmark
  UNION SELECT CASE WHEN source < 'src5' THEN 'first' ELSE 'second' END, sha256(trim(text)) FROM documents
)
"""


@register(_KEYS + "SELECT x.part AS a, y.part AS b, key FROM parts x JOIN parts y USING (key) WHERE x.part < y.part")
def splits_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = lambda df: df.select(F.sha2(F.trim("text"), 256).alias("key"))
    docs = table(spark, sf_dir, "documents")
    parts = {"benchmark": keyed(table(spark, sf_dir, "benchmark")), "first": keyed(docs.where("source < 'src5'")), "second": keyed(docs.where("source >= 'src5'"))}
    return corpus.splits_overlap(parts, "key")


_RANKED = "row_number() OVER (PARTITION BY lang ORDER BY sha256('split:' || lang || ':' || doc_id), doc_id)"


@register("""
WITH RECURSIVE sizes AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL),
strata AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, lang NULLS FIRST) AS k FROM sizes),
lists AS (SELECT list(n ORDER BY k) AS ns, list(CASE WHEN n > 1 THEN least(n - 1, greatest(1, floor(n * 0.1::DOUBLE))) ELSE 0 END::BIGINT ORDER BY k) AS qs,
  least(greatest(count(*) FILTER (n > 1), round_even(sum(n) * 0.1::DOUBLE, 0)), sum(n - 1))::BIGINT AS wanted FROM strata),
walk AS (
  SELECT ns, qs, wanted FROM lists
  UNION ALL SELECT ns, list_transform(qs, lambda q, k: q + CASE WHEN k = spot THEN step ELSE 0 END), wanted FROM (
    SELECT *, list_position(costs, list_min(costs)) AS spot FROM (
      SELECT *, list_transform(qs, lambda q, k: CASE WHEN (step > 0 AND q < ns[k] - 1) OR (step < 0 AND q > 1) THEN step * (q - ns[k] * 0.1::DOUBLE) ELSE 1e9 END) AS costs FROM (
        SELECT *, sign(wanted - list_sum(qs))::BIGINT AS step FROM walk WHERE list_sum(qs) <> wanted)))
), quotas AS (SELECT s.source, s.lang, w.qs[s.k] AS quota FROM walk w, strata s WHERE list_sum(w.qs) = w.wanted),
ranked AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY source, lang ORDER BY sha256('split:' || source || ':' || lang || ':' || doc_id), doc_id) AS r FROM documents)
SELECT doc_id, r.lang, r.source, CASE WHEN r <= quota THEN 'validation' ELSE 'train' END AS split FROM ranked r JOIN quotas q ON r.source IS NOT DISTINCT FROM q.source AND r.lang IS NOT DISTINCT FROM q.lang
""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of each stratum for validation, adjusted to a tenth of all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return ranking.stratified_split(docs, ["source", "lang"], "doc_id", 0.1, "split")


@register(f"""
SELECT doc_id, lang, CASE WHEN r <= greatest(1, round_even(n * 0.1::DOUBLE, 0)) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, lang, {_RANKED} AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents)
""")
def simple_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.simple_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.1, "split", least=1)


@register("""
SELECT doc_id, lang, r AS turn FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('sample:' || lang || ':' || doc_id), doc_id) AS r FROM documents)
ORDER BY r, lang LIMIT 50
""")
def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.balanced_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 50, "sample")


@register("""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS round, min(doc_id) OVER (PARTITION BY lang) AS seen FROM documents)
SELECT doc_id, lang, row_number() OVER (ORDER BY round, seen) AS position FROM r
""")
def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.interleave(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id")


@register("""
WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS k, count(*) OVER () AS n FROM documents)
SELECT doc_id, n_chars FROM r WHERE k IN (SELECT round_even(i * (n - 1) / 4.0::DOUBLE, 0)::BIGINT FROM range(5) t(i))
""")
def evenly_spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five documents at even distances of length: the small report is the feature."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return ranking.evenly_spaced(docs, [F.col("n_chars"), F.col("doc_id")], F.floor(F.col("n_chars") / 64), 5)


@register("""
SELECT conv_id, count(*) AS n_turns, count(*) FILTER (NOT coalesce((p = '' AND role IN ('system', 'user')) OR (p = 'system' AND role = 'user') OR (p = 'user' AND role = 'assistant')
  OR (p = 'assistant' AND role = 'user'), false)) AS illegal, max(turn - k) <> min(turn - k) AS has_gap, arg_max(role, turn) IN ('assistant', 'user') AS ends_well
FROM (SELECT *, coalesce(lag(role) OVER w, '') AS p, row_number() OVER w AS k FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) GROUP BY conv_id
""")
def chat_fsm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.history_status(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


@register("""
SELECT conv_id, sha256(string_agg(turn || '|' || CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END || '|' || text, chr(10) ORDER BY turn)) AS sha256, count(*) AS n FROM conversations GROUP BY conv_id
""")
def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat rows, rendered as JSON and read back to check the escaping."""
    chats = corpus.render_chat(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", {"user": "human", "assistant": "gpt", "system": "system"})
    read = F.from_json("conversations", "array<struct<`from`:string,value:string>>")
    first = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min("turn").alias("t0"))
    lines = F.transform("c", lambda x, k: F.concat((k + F.col("t0")).cast("string"), F.lit("|"), x["from"], F.lit("|"), x["value"]))
    return chats.withColumn("c", read).join(first, "conv_id").select("conv_id", F.sha2(F.array_join(lines, "\n"), 256).alias("sha256"), F.size("c").cast("long").alias("n"))


@register("""
WITH t AS (SELECT item_id, lower(text) AS t FROM benchmark),
grams AS (SELECT item_id, n, substr(t, p, n) AS g, count(*) AS c FROM (SELECT item_id, t, n, unnest(range(1, length(t) - n + 2)) AS p FROM t, (VALUES (2), (3)) s(n)) GROUP BY ALL),
totals AS (SELECT item_id, n, sum(c) AS c FROM grams GROUP BY ALL),
shared AS (SELECT a.item_id AS a, b.item_id AS b, a.n, sum(least(a.c, b.c)) AS c FROM grams a JOIN grams b ON a.n = b.n AND a.g = b.g AND b.item_id % 10 = 0 AND a.item_id <> b.item_id GROUP BY ALL),
f1 AS (SELECT x.item_id AS a, y.item_id AS b, sum(2 * coalesce(s.c, 0) / (x.c + y.c)) / 2 AS f1 FROM totals x JOIN totals y ON x.n = y.n AND y.item_id % 10 = 0 AND x.item_id <> y.item_id
  LEFT JOIN shared s ON s.a = x.item_id AND s.b = y.item_id AND s.n = x.n GROUP BY ALL)
SELECT a AS item_id, round(max(f1), 6)::DOUBLE AS best, count(*) AS compared FROM f1 GROUP BY a
""")
def ngram_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item against every item whose id is divisible by ten: how many those are, and the best likeness."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.lower("text").alias("text"))
    pairs = matching.text_likeness(items, items.where("item_id % 10 = 0"), "item_id", "text")
    return pairs.groupBy(F.col("a").alias("item_id")).agg(F.round(F.max("f1"), 6).alias("best"), F.count("*").alias("compared"))


@register("""
SELECT q.vec_id AS query, v.vec_id AS vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 5) AS cosine, q.label = v.label AS same_label
FROM embeddings q JOIN embeddings v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id WHERE list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) >= 0.3
""")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100 against all vectors: those of cosine 0.3 or more."""
    vecs = table(spark, sf_dir, "embeddings")
    found = matching.search_vectors(vecs.where("vec_id % 100 = 0"), vecs, "vec_id", "embedding", 0.3, ["label"])
    return found.select("query", F.col("row").alias("vec_id"), F.round("cosine", 5).alias("cosine"), (F.col("query_label") == F.col("row_label")).alias("same_label"))


@register("""
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS cosine, a.label = b.label AS same_label
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3
""")
def similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of vectors, of any labels, whose cosine is 0.3 or more."""
    pairs = matching.similar_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.3, ["label"])
    return pairs.select("a", "b", F.round("cosine", 5).alias("cosine"), (F.col("a_label") == F.col("b_label")).alias("same_label"))


@register("""
WITH RECURSIVE scored AS (
  SELECT a.vec_id // 8 AS c, a.vec_id AS i, b.vec_id AS j, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id // 8 = b.vec_id // 8 AND a.vec_id % 8 < 4 AND b.vec_id % 8 >= 4
), ranked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY score DESC, i DESC, j DESC) AS r FROM scored WHERE score >= 0),
walk AS (
  SELECT DISTINCT c, 0::BIGINT AS r, []::BIGINT[] AS left_, []::BIGINT[] AS right_, []::BIGINT[] AS taken FROM ranked
  UNION ALL SELECT w.c, n.r, CASE WHEN free THEN list_append(left_, n.i) ELSE left_ END, CASE WHEN free THEN list_append(right_, n.j) ELSE right_ END, CASE WHEN free THEN list_append(taken, n.r) ELSE taken END
  FROM (SELECT w.*, n.i, n.j, n.r AS next_r, NOT list_contains(left_, n.i) AND NOT list_contains(right_, n.j) AS free FROM walk w JOIN ranked n ON n.c = w.c AND n.r = w.r + 1) w JOIN ranked n ON n.c = w.c AND n.r = w.next_r
), ends AS (SELECT c, arg_max(taken, r) AS taken FROM walk GROUP BY c)
SELECT s.c AS "case", s.i, s.j, s.score FROM ranked s JOIN ends e ON e.c = s.c AND list_contains(e.taken, s.r)
""")
def greedy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases of eight vectors: four expected ones, each matched with one of four actual ones at most, best first."""
    vecs = table(spark, sf_dir, "embeddings").withColumn("case", F.floor(F.col("vec_id") / 8))
    a, b = vecs.where("vec_id % 8 < 4").alias("a"), vecs.where("vec_id % 8 >= 4").alias("b")
    scored = a.join(b, F.col("a.case") == F.col("b.case")).select(F.col("a.case").alias("case"), F.col("a.vec_id").alias("i"), F.col("b.vec_id").alias("j"), F.round(vectors.cosine(F.col("a.embedding"), F.col("b.embedding")), 9).alias("score"))
    return pairing.greedy_pairs(scored, "case", 0.0)


@register()
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose matching-block ratio is 0.8 or more: each copy with the first of its equals, and all pairs of these firsts."""
    return matching.similar_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


@register("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 * 15 + 30 END AS rejected_duration,
       CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M') END AS rejected_date FROM orders
""")
def perturb_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    duration = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 7 * 15)
    out = corpus.perturb_orders(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", duration)
    return out.select("o_orderkey", "rejected_duration", F.date_format("rejected_date", "yyyy-MM-dd HH:mm").alias("rejected_date"))


@register("""
SELECT o_orderkey, strftime(CASE o_orderkey % 4
    WHEN 0 THEN o_orderdate::DATE + INTERVAL 1 DAY + to_hours((o_orderkey % 11 + 13)::INT) + to_minutes((o_orderkey % 60)::INT)
    WHEN 1 THEN o_orderdate::DATE + INTERVAL 2 DAY + to_hours((o_orderkey % 11 + 1)::INT)
    WHEN 2 THEN o_orderdate::DATE + INTERVAL 15 HOUR
    ELSE o_orderdate END, '%Y-%m-%d %H:%M') AS resolved FROM orders
""")
def relative_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases made from order keys, resolved against the order date."""
    k = F.col("o_orderkey")
    phrase = (
        F.when(k % 4 == 0, F.concat(F.lit("please tomorrow, in the afternoon at "), (k % 11 + 1).cast("string"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0")))
        .when(k % 4 == 1, F.concat(F.lit("后天上午"), (k % 11 + 1).cast("string"), F.lit("点")))
        .when(k % 4 == 2, F.lit("今天下午的，时间三点钟"))
        .otherwise(F.lit("some day at 3:00"))
    )
    found = times.resolve_relative(phrase, F.col("o_orderdate"), F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(found, times.STAMP).alias("resolved"))


@register("""
SELECT event_id, hour(ts) >= 9 AND hour(ts) < 21 AS open, ('0x' || substr(sha256(event_id::VARCHAR), 57, 8))::BIGINT % 8 AS pick, 'events-' || lpad(event_id::VARCHAR, 6, '0') AS sample_id FROM events
""")
def event_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business hours, hash-indexed choice of eight, and sample ids."""
    return table(spark, sf_dir, "events").select(
        "event_id", times.in_business(F.col("ts")).alias("open"), T.hash_choice(F.col("event_id").cast("string"), 8).cast("long").alias("pick"), T.sample_id("events", F.col("event_id")).alias("sample_id")
    )


@register("""
SELECT user_id, array_to_string(list_filter([CASE WHEN count(*) > 60 THEN 'busy' END, CASE WHEN bool_or(event_type = 'error') THEN 'error' END, CASE WHEN max(value) > 150 THEN 'peak' END], lambda x: x IS NOT NULL)
  || list_sort(list(DISTINCT event_type)), ',') AS tags FROM events GROUP BY user_id
""")
def tag_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.bool_or(F.col("event_type") == "error").alias("err"), F.max("value").alias("top"), F.collect_set("event_type").alias("types"))
    tags = corpus.derive_tags({"busy": F.col("n") > 60, "error": F.col("err"), "peak": F.col("top") > 150}, F.col("types"))
    # a tag that is also a field stays where it stood first
    full = F.concat(F.filter(tags, lambda t: t.isin("busy", "peak") | ((t == "error") & F.col("err"))), F.lit([]).cast("array<string>"))
    rest = F.array_sort("types")
    return users.select("user_id", F.array_join(F.concat(full, rest), ",").alias("tags"))


@register("""
WITH lines AS (SELECT *, l_orderkey * 10 + l_linenumber AS id FROM lineitem),
own AS (SELECT id, unnest(list_filter([CASE WHEN l_quantity >= 50 THEN 'quantity' END, CASE WHEN l_discount > 0.09 THEN 'discount' END], lambda x: x IS NOT NULL)) AS error FROM lines)
SELECT id, error, count(*) AS n FROM (SELECT * FROM own UNION ALL SELECT id, 'duplicate_id' FROM lines GROUP BY id HAVING count(*) > 1) GROUP BY ALL
""")
def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    checked = lines.withColumn("errors", corpus.errors_of({"quantity": F.col("l_quantity") < 50, "discount": F.col("l_discount") <= 0.09}))
    return corpus.dataset_errors(checked, "id", "errors").groupBy("id", "error").agg(F.count("*").alias("n"))


@register("""
SELECT l_suppkey AS chain, count(*) AS n, min(l_partkey) AS first_step, max(l_partkey) AS last_step, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY l_suppkey
HAVING count(*) <> count(DISTINCT l_partkey) OR max(l_partkey) - min(l_partkey) + 1 <> count(*)
""")
def chain_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("chain"), F.col("l_partkey").alias("step"))
    return corpus.chain_gaps(steps, "chain", "step")


@register("""
WITH calls AS (SELECT user_id AS conv, event_id, ts, value::INT % 5 AS call_id FROM events WHERE event_type = 'click'), results AS (SELECT user_id AS conv, event_id, ts, value::INT % 5 AS call_id FROM events WHERE event_type = 'error')
SELECT r.conv, r.call_id, r.event_id AS result_turn, max(c.event_id) AS call_turn FROM results r LEFT JOIN calls c ON c.conv = r.conv AND c.call_id = r.call_id AND c.event_id < r.event_id GROUP BY ALL
""")
def exchange_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "error"))
    turns = events.select(F.col("user_id").alias("conv"), F.col("event_id").alias("turn"), F.when(F.col("event_type") == "click", "call").otherwise("result").alias("kind"), (F.bround("value").cast("int") % 5).alias("call_id"))
    return matching.exchange_pairs(turns).select("conv", "call_id", "result_turn", "call_turn")
