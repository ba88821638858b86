"""Planning and rendering of generated rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..facets import Catalog, compact
from ..functions import text as T
from .ranking import distributed_rank


def expand_requests(quotas: DataFrame, key: str, count: str) -> DataFrame:
    """One row for each wanted item of ``quotas``, numbered from 1."""
    return quotas.where(F.col(count) > 0).select("*", F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))).alias("number")).withColumn("request_id", T.sample_id("plan", F.col("number"))).withColumn(
        "request_id", F.concat(F.col(key), F.lit(":"), F.col("request_id"))
    )


def grid(spark: SparkSession, dimensions: Mapping[str, Sequence[Any]]) -> DataFrame:
    """All combinations of literal dimensions, the last one turning fastest."""
    out = spark.range(1).drop("id")
    for name, values in dimensions.items():
        out = out.select("*", F.explode(F.array(*map(F.lit, values))).alias(name))
    return out


def _ranked_choices(choices: Sequence[str], seed: str, group: Column) -> Column:
    """The choices in an order that seed and group fix."""
    marked = [F.struct(F.sha2(F.concat(F.lit(f"{seed}:{c}:"), group.cast("string")), 256).alias("h"), F.lit(c).alias("c")) for c in choices]
    return F.transform(F.array_sort(F.array(*marked)), lambda x: x["c"])


def rotate(df: DataFrame, group: str, order: str, choices: Sequence[str], seed: str, name: str = "choice") -> DataFrame:
    """The least used choice of each group in turn where none was used before: a cycle through an order that the group's hash fixes."""
    turn = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return df.withColumn("_turn", turn).withColumn(name, F.get(_ranked_choices(choices, seed, F.col(group)), F.col("_turn") % len(choices))).drop("_turn")


def least_used(df: DataFrame, group: str, order: str, choices: Sequence[str], used: DataFrame, seed: str, name: str = "choice") -> DataFrame:
    """Each row of a group, in order, takes the choice that was used least until then; ties in an order that the group's hash fixes.

    ``used(group, choice, n)`` has earlier uses; choices without a row there have
    none.  The k-th row takes the k-th of all uses ``(n, n + 1, ...)`` of the
    choices in order of number, so no row waits for another.
    """
    ranked = distributed_rank(df, [group], [F.col(order)], F.floor(F.col(order) / 4096), "_turn")
    sizes = df.groupBy(group).agg(F.count("*").alias("_rows"))
    wide = used.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("choice", F.col("n").cast("long")))).alias("_used"))
    sizes = sizes.join(wide, sizes[group].eqNullSafe(wide[group]), "left").select(sizes[group], "_rows", "_used")
    ordered = _ranked_choices(choices, seed, F.col(group))
    before = lambda c: F.coalesce(F.try_element_at(F.coalesce(F.col("_used"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))), c), F.lit(0))
    starts = F.transform(ordered, lambda c, k: F.struct(before(c).alias("n"), k.alias("k"), c.alias("c")))
    table = sizes.select(F.col(group), starts.alias("_starts"))
    joined = ranked.join(table, ranked[group].eqNullSafe(table[group])).select(*[ranked[c] for c in ranked.columns], "_starts")
    # uses below a level: sum of max(0, level - n); the row's level is the highest with fewer uses below it than its turn
    sorted_n = F.array_sort(F.transform("_starts", lambda x: x["n"]))
    filled = lambda level: F.aggregate("_starts", F.lit(0).cast("long"), lambda acc, x: acc + F.greatest(F.lit(0).cast("long"), level - x["n"]))
    turn = F.col("_turn")
    # between two uses the level rises by one for every choice that has come in
    bases = F.transform(sorted_n, lambda n, i: F.struct(n.alias("n"), filled(n).alias("filled"), (i + 1).alias("open")))
    base = F.array_max(F.filter(bases, lambda b: b["filled"] < turn))
    level = base["n"] + F.floor((turn - 1 - base["filled"]) / base["open"])
    place = turn - filled(level)
    open_ = F.filter("_starts", lambda x: x["n"] <= level)
    chosen = F.get(F.transform(F.array_sort(F.transform(open_, lambda x: F.struct(x["k"].alias("k"), x["c"].alias("c")))), lambda x: x["c"]), (place - 1).cast("int"))
    return joined.withColumn(name, chosen).drop("_turn", "_starts")


def plan_errors(plan: DataFrame, minimums: Mapping[str, int], group: str) -> DataFrame:
    """Groups of a plan with fewer rows than wanted, checked before anything is generated."""
    wanted = plan.sparkSession.createDataFrame(list(minimums.items()), "grp string, minimum int")
    counts = plan.groupBy(F.col(group).cast("string").alias("grp")).agg(F.count("*").alias("n"))
    return F.broadcast(wanted).join(counts, "grp", "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n < minimum")


def prompt_prefix(catalog: Catalog, rules: Sequence[str]) -> str:
    """The constant part of a prompt, written once: rules and the public view of the catalog."""
    return "\n".join([*rules, "Catalog: " + compact(catalog.public_view())])


def render_prompts(df: DataFrame, prefix: str, state: str, text: str) -> DataFrame:
    """System and user message of each row; a missing state is written as null."""
    system = F.concat(F.lit(prefix + "\nState: "), F.coalesce(F.col(state), F.lit("null")))
    return df.withColumn("messages", F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), F.col(text).alias("content"))))


def render_appointment_prompts(df: DataFrame, rules: str, tools: Mapping[str, Mapping[str, Any]], now: str, history: str, text: str, allowed: Column | None = None) -> DataFrame:
    """System text with rules, time and tools, then the history, then what the user says, if anything.

    ``history`` is an array of structs of role and content; ``allowed`` names the
    tools of a row, all by default; a tool that nobody knows is an error when the
    plan runs.
    """
    names = F.array(*map(F.lit, tools)) if allowed is None else allowed
    shown = F.create_map(*[x for name in tools for x in (F.lit(name), F.lit(tool_schema(name, tools)))])
    schemas = F.transform(names, lambda n: F.coalesce(F.try_element_at(shown, n), F.raise_error(F.concat(F.lit("unknown tool "), n))))
    system = F.concat(F.lit(rules + "\nTime: "), F.col(now), F.lit("\nTools: ["), F.array_join(schemas, ","), F.lit("]"))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    none = F.array().cast("array<struct<role:string,content:string>>")
    told = F.coalesce(F.transform(history, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))), none)
    said = F.when(F.coalesce(F.trim(F.col(text)) != "", F.lit(False)), F.array(message("user", F.col(text)))).otherwise(none)
    return df.withColumn("messages", F.concat(F.array(message("system", system)), told, said))


#: Who may speak at an even place of a chat, from 0, and who at an odd one.
ODD_TURNS, EVEN_TURNS = ("gpt", "function_call"), ("human", "observation")


def turn_errors(chats: Column) -> Column:
    """Places of a chat, from 0, whose speaker may not stand there: people and observations ask, the model and its calls answer."""
    return F.filter(
        F.transform(chats, lambda c, k: F.when(F.when(k % 2 == 0, c["from"].isin(*EVEN_TURNS)).otherwise(c["from"].isin(*ODD_TURNS)), F.lit(None).cast("int")).otherwise(k)), lambda k: k.isNotNull()
    )


def render_template(messages: Column, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> Column:
    """Messages as one calibration text."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(begin), m["role"], F.lit("\n"), m["content"], F.lit(f"{end}\n"))), "")


def tool_schema(name: str, tools: Mapping[str, Mapping[str, Any]]) -> str:
    if name not in tools:
        raise KeyError(f"unknown tool {name!r}")
    return compact({"type": "function", "function": {"name": name, **tools[name]}})


def sharegpt(df: DataFrame, messages: str) -> DataFrame:
    """System text and alternating human and gpt turns; another order is an error when the plan runs."""
    m = F.col(messages)
    rest = F.filter(m, lambda x: x["role"] != "system")
    alternates = F.forall(F.transform(rest, lambda x, k: x["role"] == F.when(k % 2 == 0, "user").otherwise("assistant")), lambda ok: ok) & (F.size(rest) % 2 == 0)
    system = F.try_element_at(F.filter(m, lambda x: x["role"] == "system"), F.lit(1))["content"]
    chats = F.transform(rest, lambda x: F.struct(F.when(x["role"] == "user", "human").otherwise("gpt").alias("from"), x["content"].alias("value")))
    checked = df.where(F.assert_true(alternates, F.lit("roles must alternate and end with the assistant")).isNull())
    return checked.withColumns({"system": F.coalesce(system, F.lit("")), "conversations": chats})


def word_count(text: Column) -> Column:
    """The offline stand-in for a tokenizer."""
    return F.regexp_count(text, F.lit(r"\S+"))


def pluggable_count(tokenizer: Callable[[str], int]) -> Callable[[Column], Column]:
    """A token counter from any Python tokenizer, in Arrow batches."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: 0 if t is None else tokenizer(t))

    return count


def token_budget(df: DataFrame, parts: Mapping[str, Column], limits: Mapping[str, int]) -> DataFrame:
    """Longest row of each part in tokens and whether it stays within its limit."""
    longest = df.agg(*[F.max(c).alias(k) for k, c in parts.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("part"), F.col(k).cast("long").alias("longest"), F.lit(limits[k]).alias("most")) for k in parts])
    return longest.select(F.explode(rows).alias("r")).select("r.*", (F.col("r.longest") <= F.col("r.most")).alias("passed"))


def training_errors(chats: Column, chosen: Column | None = None, rejected: Column | None = None) -> Column:
    """Errors of a training row: no assistant turn, thinking tags, a rejected answer that equals the chosen one."""
    checks = {
        "assistant": F.exists(chats, lambda c: c["from"] == "gpt"),
        "thinking": ~F.exists(chats, lambda c: F.contains(c["value"], F.lit("<think>")) | F.contains(c["value"], F.lit("</think>"))),
    }
    if chosen is not None and rejected is not None:
        checks["pair"] = ~chosen.eqNullSafe(rejected)
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in checks.items()]))


def config_merge(base: Mapping[str, Any], over: Mapping[str, Any], allowed: frozenset[str] | None = None) -> dict[str, Any]:
    """Right-biased deep merge of configurations; only allowed top keys may be overridden."""
    if allowed is not None and (extra := set(over) - allowed):
        raise ValueError(f"not to be overridden: {sorted(extra)}")
    out = dict(base)
    for k, v in over.items():
        out[k] = config_merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


#: Rows of a dimension up to which it is broadcast.
SMALL = 100_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """A side with a broadcast hint if it was counted to have at most so many rows; else the planner chooses."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def grounded(conditions: DataFrame, values: DataFrame, text: str) -> DataFrame:
    """Gold codes ``(id, field, code)`` that the text names by code, label or alias."""
    terms = values.select("field", "code", F.explode(F.array_distinct(F.concat(F.array("code", "label"), "aliases"))).alias("term"))
    joined = conditions.join(small(terms), ["field", "code"], "left")
    flexible = F.regexp_replace(F.regexp_replace("term", r"([^\w\s-])", r"\\$1"), r"[\s_-]+", r"[-_\\s]+")
    ascii_hit = F.expr("rlike(lower(_text), concat('(?<![a-z0-9])', lower(_pattern), '(?![a-z0-9])'))")
    hit = F.when(F.col("term").rlike(r"^\p{ASCII}+$"), ascii_hit).otherwise(F.contains(F.col(text), F.col("term")))
    marked = joined.withColumns({"_text": F.col(text), "_pattern": flexible}).withColumn("_hit", F.coalesce(hit, F.lit(False)))
    keys = [c for c in conditions.columns if c != text]
    return marked.groupBy(*keys).agg(F.bool_or("_hit").alias("grounded"))
