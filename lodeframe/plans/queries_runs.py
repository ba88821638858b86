"""Queries of resumed generation, overlapping views and deep hierarchies, over the documents and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import covering, hierarchies, resume, views
from ..sources.shared import scratch
from .catalog import register, table

PARTS = 3


@register(r"""
WITH answered AS (
  SELECT doc_id::VARCHAR AS id, doc_id % 3 AS batch, trim(regexp_replace(regexp_extract(text, '^[^\n]*'), '\s+', ' ', 'g')) AS title FROM documents
), valid AS (SELECT *, sha256(lower(title)) AS fingerprint FROM answered WHERE length(title) >= 20),
ranked AS (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY batch, id) AS r FROM valid)
SELECT id, fingerprint, batch::INT AS batch, title FROM ranked WHERE r = 1
""")
def resumed_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title for each document, asked for in three batches by an attempt that stops after the first and one that goes on: titles of some length, none twice."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", (F.col("doc_id") % PARTS).alias("part"))
    titled = lambda pending: pending.select("id", T.squeeze(F.regexp_extract("text", r"^[^\n]*", 0)).alias("title"))
    folder = scratch(spark, "generation")
    done = docs.limit(0)
    for stop in (1, None):
        run = resume.Run(spark, folder, {"task": "title", "least": 20}, "title string")
        done = resume.generate(run, docs, titled, F.col("part"), PARTS, F.sha2(F.lower("title"), 256), F.char_length("title") >= 20, stop)
    return done


_VIEWS = "WITH keys AS (SELECT md5(text) AS key, bool_or(n_chars >= 1000) AS long, bool_or(lang = 'en') AS english, bool_or(source <= 'src5') AS early FROM documents WHERE text IS NOT NULL GROUP BY 1)"


@register(f"""
{_VIEWS}, held AS (SELECT key, name FROM keys, (VALUES ('long'), ('english'), ('early')) v(name) WHERE CASE name WHEN 'long' THEN long WHEN 'english' THEN english ELSE early END)
SELECT a.name AS a, b.name AS b, count(*) AS keys FROM held a JOIN held b ON a.key = b.key AND list_position(['long', 'english', 'early'], a.name) <= list_position(['long', 'english', 'early'], b.name) GROUP BY ALL
UNION ALL SELECT 'core', 'core', count(*) FROM keys WHERE long AND english AND early
""")
def view_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts that three views of the documents share, two by two, and their common core."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.md5("text").alias("key"), "n_chars", "lang", "source")
    named = {"long": F.col("n_chars") >= 1000, "english": F.col("lang") == "en", "early": F.col("source") <= "src5"}
    members = views.membership(docs, ["key"], named)
    both = views.overlaps(members, list(named)).where("keys > 0")
    core = views.core(members, list(named)).agg(F.count("*").alias("keys")).select(F.lit("core").alias("a"), F.lit("core").alias("b"), "keys")
    return both.unionByName(core)


@register("""
WITH RECURSIVE edges AS (
  SELECT o_orderkey AS child, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before, o_custkey % 10 AS parent_of_first FROM orders
), tree AS (
  SELECT child, -1 - parent_of_first AS root, 1 AS depth FROM edges WHERE before IS NULL
  UNION ALL SELECT e.child, t.root, t.depth + 1 FROM edges e JOIN tree t ON e.before = t.child
)
SELECT root, count(*) + 1 AS nodes, max(depth)::BIGINT AS deepest, sum(depth)::BIGINT AS depths FROM tree GROUP BY root
""")
def order_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chains of a customer below ten roots: what lies below a root is a range of places."""
    from pyspark.sql import Window

    orders = table(spark, sf_dir, "orders")
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    edges = orders.select(F.col("o_orderkey").alias("child"), F.coalesce(before, -1 - F.col("o_custkey") % 10).alias("parent"))
    placed = hierarchies.intervals(edges, "child", "parent")
    # the roots are few: ten literals
    roots = F.broadcast(placed.where("depth = 0").select(F.col("node").alias("root"), F.col("low").alias("from"), F.col("high").alias("to")))
    below = placed.join(roots, (F.col("from") <= F.col("low")) & (F.col("low") <= F.col("to")))
    return below.groupBy("root").agg(F.count("*").alias("nodes"), F.max("depth").alias("deepest"), F.sum("depth").alias("depths"))


_TEMPLATES = ("{priority} order of {segment} from {nation}, status {status}", "from {nation}: {segment}, {status}, not {priority}")


@register("""
WITH n AS (SELECT DISTINCT n_name AS v FROM nation), p AS (SELECT DISTINCT o_orderpriority AS v FROM orders), s AS (SELECT DISTINCT o_orderstatus AS v FROM orders), t AS (SELECT DISTINCT event_type AS v FROM events),
nations AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM n), priorities AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM p), statuses AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM s), kinds AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM t),
q AS (SELECT min(c) AS q FROM range(2, 1000) r(c) WHERE c >= (SELECT greatest((SELECT count(*) FROM n), (SELECT count(*) FROM p), (SELECT count(*) FROM s), (SELECT count(*) FROM t), 3)) AND NOT EXISTS (SELECT 1 FROM range(2, 32) d(x) WHERE x < c AND c % x = 0)),
lines AS (SELECT a * q + b AS combination, a, b, (a + b) % q AS c, (a + 2 * b) % q AS d FROM q, range(0, 1000) x(a), range(0, 1000) y(b) WHERE a < q AND b < q),
rows AS (
  SELECT combination, nations.v AS nation, priorities.v AS priority, statuses.v AS status, kinds.v AS segment FROM lines
  JOIN nations ON nations.k = a % (SELECT count(*) FROM n) JOIN priorities ON priorities.k = b % (SELECT count(*) FROM p) JOIN statuses ON statuses.k = c % (SELECT count(*) FROM s) JOIN kinds ON kinds.k = d % (SELECT count(*) FROM t)
)
SELECT combination, CASE WHEN combination % 2 = 0 THEN priority || ' order of ' || segment || ' from ' || nation || ', status ' || status ELSE 'from ' || nation || ': ' || segment || ', ' || status || ', not ' || priority END AS text,
       (SELECT count(DISTINCT nation || priority) + count(DISTINCT nation || status) + count(DISTINCT nation || segment) + count(DISTINCT priority || status) + count(DISTINCT priority || segment) + count(DISTINCT status || segment) FROM rows) AS pairs
FROM rows
""")
def covering_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in which every two values of four factors, taken from the tables, meet; and how many pairs those are."""
    of = lambda name, column: table(spark, sf_dir, name).select(column)
    factors = {"nation": of("nation", "n_name"), "priority": of("orders", "o_orderpriority"), "status": of("orders", "o_orderstatus"), "segment": of("events", "event_type")}
    rows = covering.covering_rows(spark, factors)
    pairs = covering.pairs_covered(rows, list(factors)).agg(F.sum("pairs").alias("pairs"))
    return rows.select("combination", covering.texts_of(rows, _TEMPLATES, list(factors)).alias("text")).crossJoin(pairs)  # one row
