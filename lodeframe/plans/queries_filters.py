"""Queries over catalogs, predicates, lookups and hierarchies."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..facets import Catalog, Field, Sort, Value
from ..functions import text as T
from ..functions import units as U
from ..operators import hierarchies, matching, sessions
from .catalog import register, table
from .compiler import State, compile_state, soft_score
from .predicates import Condition

#: A catalog for the part table.
PARTS = Catalog(
    "1.0",
    (
        Field("kind", "categorical", "p_type", ("in", "not_in"), ("prefer", "avoid"), tuple(Value(c.lower(), c) for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))),
        Field("brand", "categorical", "p_brand", ("in", "not_in"), ("prefer", "avoid"), tuple(Value(f"brand_{k}", f"Brand#{k}") for k in range(1, 26))),
        Field("size", "integer", "p_size", ("eq", "gte", "lte", "between"), ("lower", "higher", "around"), minimum=Decimal(0)),
        Field("price", "number", "p_retailprice", ("eq", "gte", "lte", "between"), ("lower", "higher", "around"), unit_kind="currency", minimum=Decimal(0)),
    ),
    (Sort("price", "p_retailprice", ("asc", "desc")),),
    ("p_name",),
)


def in_labels(catalog: Catalog) -> Catalog:
    """The catalog with the labels as codes, for tables that store labels."""
    from dataclasses import replace

    return replace(catalog, fields=tuple(replace(f, values=tuple(replace(v, code=v.label) for v in f.values)) for f in catalog.fields))


STORED = in_labels(PARTS)
CHEAP = State(
    conditions=(
        Condition("kind", "in", values=("SMALL", "ECONOMY")),
        Condition("brand", "not_in", values=("Brand#2",)),
        Condition("size", "between", low=3, high=9),
        Condition("price", "lte", value=1000.0, unit="USD"),
    ),
    sort=("price", "asc"),
)


@register("""
SELECT p_partkey, p_name, p_type, p_brand, p_size, p_retailprice FROM part
WHERE p_type IN ('SMALL', 'ECONOMY') AND p_brand <> 'Brand#2' AND p_size BETWEEN 3 AND 9 AND p_retailprice <= 1000
""")
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = compile_state(CHEAP, STORED, currency="USD")
    return query.apply(table(spark, sf_dir, "part")).select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")


@register("""
SELECT p_partkey, p_size, p_retailprice FROM part
WHERE p_size >= 10 AND p_size = 12 AND p_retailprice BETWEEN 900 AND 1500 AND lower(p_name) LIKE '%ring%'
""")
def facet_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State("Ring", (Condition("size", "gte", value=10), Condition("size", "eq", value=12), Condition("price", "between", low=900, high=1500, unit="USD")))
    return compile_state(state, STORED, currency="USD").apply(table(spark, sf_dir, "part")).select("p_partkey", "p_size", "p_retailprice")


@register("""
SELECT p_partkey, round((CASE WHEN p_type = 'PROMO' THEN 1.0 ELSE 0 END) - (CASE WHEN p_brand IN ('Brand#1', 'Brand#3') THEN 1.0 ELSE 0 END)
       + (1 - (p_retailprice - lo) / (hi - lo)) + 1 / (1 + abs(p_size - 10) / 10.0), 6)::DOUBLE AS score
FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)
WHERE p_size <= 20
""")
def soft_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(
        conditions=(
            Condition("size", "lte", value=20),
            Condition("kind", "prefer", values=("PROMO",), soft=True),
            Condition("brand", "avoid", values=("Brand#1", "Brand#3"), soft=True),
            Condition("price", "lower", soft=True),
            Condition("size", "around", value=10, soft=True),
        )
    )
    parts = table(spark, sf_dir, "part")
    low, high = parts.agg(F.min("p_retailprice"), F.max("p_retailprice")).first()
    query = compile_state(state, STORED, currency="USD")
    return query.apply(parts).select("p_partkey", F.round(soft_score(query.hints, {"p_retailprice": (low, high)}), 6).alias("score"))


@register("""
SELECT p_brand, min(p_size) AS lo, max(p_size) - 40 AS hi FROM part GROUP BY p_brand HAVING min(p_size) > max(p_size) - 40
UNION ALL SELECT 'all', 5, 3
""")
def contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges made from the part table: at least the smallest size and at most 40 under the largest."""
    sizes = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_size").alias("a"), (F.max("p_size") - 40).alias("b"))
    sizes = sizes.unionByName(spark.createDataFrame([("all", 5, 3)], "p_brand string, a int, b int"))
    ops = F.array(F.struct(F.lit("gte").alias("op"), F.col("a").alias("value")), F.struct(F.lit("lte").alias("op"), F.col("b").alias("value")))
    conditions = sizes.select("p_brand", F.explode(ops).alias("c")).select("p_brand", "c.op", F.col("c.value").cast("double").alias("value"))
    conditions = conditions.withColumns({"min_value": F.lit(None).cast("double"), "max_value": F.lit(None).cast("double")})
    found = sessions.contradictions(conditions, ["p_brand"])
    return found.select("p_brand", F.col("low").cast("int").alias("lo"), F.col("high").cast("int").alias("hi"))


@register("""
SELECT p_partkey FROM part WHERE p_partkey % 7 = 0 OR p_type IN ('SMALL', 'PROMO')
""")
def excluded_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set conditions of every part of which the wanted values are all excluded."""
    gone = F.when(F.col("p_partkey") % 7 == 0, F.array(F.col("p_type"), F.lit("LARGE"))).otherwise(F.array(F.lit("SMALL"), F.lit("PROMO")))
    pair = F.array(F.struct(F.lit("in").alias("op"), F.array("p_type").alias("values")), F.struct(F.lit("not_in").alias("op"), gone.alias("values")))
    conditions = table(spark, sf_dir, "part").select("p_partkey", F.explode(pair).alias("c")).select("p_partkey", "c.*")
    closure = STORED.tables(spark)["closure"].where("field = 'kind'").select("code", "descendant")
    return sessions.set_contradictions(conditions, ["p_partkey"], closure)


@register("""
WITH RECURSIVE edges AS (
  SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT r_name, 'WORLD' FROM region
), up AS (
  SELECT child AS descendant, child AS ancestor FROM edges UNION SELECT 'WORLD', 'WORLD'
  UNION SELECT u.descendant, e.parent FROM up u JOIN edges e ON u.ancestor = e.child
)
SELECT ancestor, count(*) AS n FROM up GROUP BY ancestor
""")
def hierarchy_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchies.closure(_places(spark, sf_dir), "child", "parent").groupBy("ancestor").agg(F.count("*").alias("n"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    edges = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    return edges.unionByName(region.select(F.col("r_name").alias("child"), F.lit("WORLD").alias("parent")))


@register("""
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE')
""")
def hierarchy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ``in`` filter on regions, expanded down to nations while the plan is built."""
    wanted = hierarchies.closure(_places(spark, sf_dir), "child", "parent").where(F.col("ancestor").isin("ASIA", "EUROPE"))
    nations = table(spark, sf_dir, "nation").join(wanted, F.col("n_name") == F.col("descendant"), "left_semi")
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@register("""
WITH RECURSIVE up AS (
  SELECT n_nationkey AS node, n_nationkey AS spot, 0 AS depth FROM nation
  UNION ALL SELECT node, floor(spot / 3)::INT, depth + 1 FROM up WHERE spot > 0
)
SELECT node::INT AS node, max(depth)::BIGINT AS depth, 0 AS root FROM up GROUP BY node
""")
def ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps to the root where nation k hangs below k // 3."""
    from ..operators.provenance import ancestry as steps

    edges = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("child"), F.expr("case when n_nationkey > 0 then cast(n_nationkey div 3 as int) end").alias("parent"))
    return steps(edges, "child", "parent")


FACTORS = {"g": Decimal(1), "kg": Decimal(1000), "oz": Decimal("28.349523125")}


@register("""
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity::DECIMAL(18,6) * (CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 28.349523125 END)::DECIMAL(20,10))::DOUBLE, 6) AS grams
FROM lineitem
""")
def unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.when(F.col("l_linenumber") % 4 == 0, "g").when(F.col("l_linenumber") % 4 == 1, "kg").when(F.col("l_linenumber") % 4 == 2, "oz").otherwise("stone")
    grams = F.round(U.to_base_unit(F.col("l_quantity"), unit, FACTORS), 6)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", grams.alias("grams"))


@register("""
SELECT l_orderkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate <= l_shipdate AND l_shipdate < l_shipdate + INTERVAL 30 DAY AND l_shipdate + INTERVAL 30 DAY <= o_orderdate + INTERVAL 900 DAY
GROUP BY l_orderkey
""")
def interval_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments that lie, with 30 days after them, within 900 days after their order."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("s"), F.expr("l_shipdate + interval 30 days").alias("e"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("lo"), F.expr("o_orderdate + interval 900 days").alias("hi"))
    found = matching.interval_join(lines, orders, ["k"], "s", "e", "lo", "hi")
    return found.groupBy(F.col("k").alias("l_orderkey")).agg(F.count("*").alias("n"))


def _requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every order as a request for its day; suppliers as providers that work on a few days of the orders' years."""
    start = F.expr("o_orderdate + make_dt_interval(0, cast(8 + o_orderkey % 14 as int), 0, 0)")
    requests = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("S"), (F.col("o_custkey") % 120).cast("string"))).alias("wanted_name"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("wanted_group"),
        F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit("k1"))).otherwise(F.array().cast("array<string>")).alias("wanted_skills"),
        start.alias("start"),
        (start + F.expr("interval 1 hour")).alias("end"),
    )
    day = lambda k: F.expr(f"timestamp_ntz'1995-01-01' + make_dt_interval(cast((s_suppkey * {k}) % 2000 as int), 9, 0, 0)")
    window = lambda k: F.struct(day(k).alias("start"), (day(k) + F.expr("interval 12 hours")).alias("end"))
    providers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("provider"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("name"),
        F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (F.col("s_nationkey") % 3 + 1).cast("int")).alias("grp"),
        F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("k1"), F.lit("k2"))).otherwise(F.array(F.lit("k2"))).alias("skills"),
        F.array(*[window(k) for k in DAY_STEPS]).alias("windows"),
    )
    return requests, providers


DAY_STEPS = (11, 17, 23, 41, 97)
_REQUESTS_SQL = (
    """
WITH requests AS (
  SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 4 = 0 THEN 'S' || (o_custkey % 120) END AS wanted_name,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS wanted_group, o_orderkey % 5 = 0 AS wants_k1,
         o_orderdate + to_hours((8 + o_orderkey % 14)::INT) AS s, o_orderdate + to_hours((9 + o_orderkey % 14)::INT) AS e
  FROM orders
), providers AS (
  SELECT s_suppkey AS provider, 'S' || s_suppkey AS name, ['F', 'O', 'P'][(s_nationkey % 3 + 1)::INT] AS grp, s_suppkey % 2 = 0 AS has_k1 FROM supplier
), days AS (
  SELECT DISTINCT s_suppkey AS provider, TIMESTAMP '1995-01-01 09:00:00' + to_days(((s_suppkey * k) % 2000)::INT) AS d FROM supplier, (VALUES """
    + ", ".join(f"({k})" for k in DAY_STEPS)
    + """) t(k)
), judged AS (
  SELECT r.request_id, p.provider, coalesce(wanted_name = name, true) AS considered,
         coalesce(wanted_name = name, true) AND d <= s AND e <= d + INTERVAL 12 HOUR AND (NOT wants_k1 OR has_k1) AND coalesce(wanted_group = grp, true) AS matched
  FROM requests r JOIN days ON d::DATE = s::DATE JOIN providers p USING (provider)
)
"""
)


@register(_REQUESTS_SQL + "SELECT request_id, provider, considered, matched FROM judged")
def provider_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_providers(*_requests(spark, sf_dir)).select("request_id", "provider", "considered", "matched")


@register(
    _REQUESTS_SQL
    + """
, told AS (
  SELECT r.request_id, CASE WHEN wanted_name <> name THEN 'name' WHEN wanted_name IS NULL AND d IS NULL THEN 'time'
    ELSE array_to_string(list_filter([CASE WHEN wanted_group <> grp THEN 'group' END, CASE WHEN wants_k1 AND NOT has_k1 THEN 'skills' END, CASE WHEN NOT coalesce(d <= s AND e <= d + INTERVAL 12 HOUR, false) THEN 'time' END], lambda x: x IS NOT NULL), ',') END AS reasons
  FROM requests r CROSS JOIN providers p LEFT JOIN days d ON d.provider = p.provider AND d::DATE = s::DATE
)
SELECT request_id, reasons, count(*)::BIGINT AS providers FROM told GROUP BY ALL
"""
)
def provider_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each provider fits a request or doesn't: providers of each request by their reasons, from a trace of classes."""
    return matching.trace_reasons(*_requests(spark, sf_dir))


@register(
    _REQUESTS_SQL
    + """
, counted AS (SELECT request_id, count(*) FILTER (matched) AS matches FROM judged GROUP BY request_id)
SELECT r.request_id, coalesce(matches, 0) AS matches,
       CASE WHEN NOT (s::DATE = e::DATE AND hour(s) >= 9 AND hour(e) * 60 + minute(e) <= 21 * 60 AND matches IS NOT NULL) THEN 'coverage_miss'
            WHEN wanted_name IS NOT NULL AND wanted_name NOT IN (SELECT name FROM providers) THEN 'not_found'
            WHEN wanted_name IS NOT NULL THEN CASE WHEN matches > 0 THEN 'available' ELSE 'unavailable' END
            WHEN matches = 1 THEN 'matched' WHEN matches = 0 THEN 'no_match' ELSE 'coverage_miss' END AS status
FROM requests r LEFT JOIN counted c USING (request_id)
"""
)
def match_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_status(*_requests(spark, sf_dir))


@register("""
SELECT o_orderkey, trim(lower(o_orderpriority)) AS term,
       CASE trim(lower(o_orderpriority)) WHEN '1-urgent' THEN 'urgent' WHEN '2-high' THEN 'high' WHEN '3-medium' THEN 'medium' END AS code
FROM orders
""")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = spark.createDataFrame([("priority", "urgent", ["1-URGENT"]), ("priority", "high", [" 2-High "]), ("priority", "medium", ["3-medium"])], "field string, code string, aliases array<string>")
    terms = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("priority").alias("field"), F.col("o_orderpriority").alias("term"))
    return matching.resolve_aliases(terms, values).select("o_orderkey", F.trim(F.lower("term")).alias("term"), "code")


@register("""
SELECT a.l_orderkey, a.l_partkey AS a, b.l_partkey AS b
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b
  ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
""")
def field_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    baskets = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return matching.field_pairs(baskets, "l_orderkey", F.col("parts"))


@register("""
SELECT event_id, (props::JSON ->> '$.k')::INT AS k FROM events WHERE json_valid(props)
""")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.strict_json import strict_object

    parsed = table(spark, sf_dir, "events").withColumn("v", strict_object(F.col("props")))
    return parsed.where("v is not null").select("event_id", F.expr("variant_get(v, '$.k', 'int')").alias("k"))


@register("""
SELECT p_partkey, CASE WHEN regexp_matches(lower(p_name), '(^|[^a-z0-9])ring([^a-z0-9]|$)') THEN 1 ELSE 0 END AS names_ring, length(p_name) AS n_chars,
       length(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS n_alnum FROM part
""")
def term_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    alnum = F.char_length(F.regexp_replace("p_name", r"(?U)[^\p{L}\p{N}]", ""))
    return table(spark, sf_dir, "part").select("p_partkey", T.mentions(F.col("p_name"), "ring").cast("int").alias("names_ring"), F.char_length("p_name").cast("long").alias("n_chars"), alnum.cast("long").alias("n_alnum"))
