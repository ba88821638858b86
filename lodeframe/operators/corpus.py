"""Corpus hygiene: duplicates, isolation from evaluation data, tags, contracts of conversations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound


def duplicates(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keys of more than one row, with their number and first row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(order).alias("first_row")).where("n > 1")


def overlap(train: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Training rows whose key occurs in held-out data."""
    return train.join(held.select(key).distinct(), key, "left_semi")


def clean_of(train: DataFrame, held: DataFrame, key: str) -> DataFrame:
    return train.join(held.select(key).distinct(), key, "left_anti")


def splits_overlap(splits: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Keys that two splits share, ``(a, b, key)`` for each pair of splits."""
    names = list(splits)
    found = [
        splits[a].select(key).intersect(splits[b].select(key)).select(F.lit(a).alias("a"), F.lit(b).alias("b"), key)
        for k, a in enumerate(names)
        for b in names[k + 1 :]
    ]
    return reduce(DataFrame.unionByName, found)


def containing(docs: DataFrame, items: DataFrame, doc_text: str, item_text: str, key_words: int = 8, most_keys: int = 20_000) -> DataFrame:
    """``(doc, item)`` where an item's text occurs in a document's.

    Items are keyed by the inner ones of their first ``key_words`` words (the first
    and the last may be parts of words in a document), documents by every run of as
    many words.  Items of one or two words have no inner words; they are keyed by
    their first ``SHORT`` characters, documents by every run of as many characters.
    Up to ``most_keys`` keys of a kind prune the documents' runs before anything is
    shuffled; more are left to the join.
    """
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    item = items.withColumn("_w", words(F.col(item_text))).withColumn("_n", F.least(F.size("_w"), F.lit(key_words))).where("_n > 0")
    inner = F.slice("_w", 2, F.greatest(F.col("_n") - 2, F.lit(0)))
    short = F.left(F.col(item_text), F.lit(SHORT))
    # kinds of key: so many words, or, below zero, so many characters
    item = item.withColumn("_k", F.when(F.col("_n") > 2, F.col("_n") - 2).otherwise(-F.char_length(short)))
    item = item.withColumn("_key", F.when(F.col("_k") > 0, F.array_join(inner, " ")).otherwise(short))
    item = item.withColumn("_start", F.when(F.col("_k") > 0, F.get(inner, 0)).otherwise(short)).drop("_w", "_n")
    kinds = [r[0] for r in item.select("_k").distinct().collect()]  # at most key_words + SHORT numbers
    starts = {k: [r[0] for r in item.where(F.col("_k") == k).select("_start").distinct().limit(most_keys + 1).collect()] for k in kinds}

    def wanted(start: Column, k: int) -> Column:
        return start.isin(starts[k]) if len(starts[k]) <= most_keys else F.lit(True)

    def runs(text: Column, dw: Column, k: int) -> Column:
        """The distinct runs of a text that may be keys: they begin as one does."""
        n = abs(k)
        if k > 0:
            places = F.sequence(F.lit(1), F.greatest(F.size(dw) - n + 1, F.lit(1)))
            found = F.filter(places, lambda p: wanted(F.get(dw, p - 1), k))
            found = F.transform(found, lambda p: F.array_join(F.slice(dw, p, F.lit(n)), " "))
        else:
            places = F.sequence(F.lit(1), F.greatest(F.char_length(text) - n + 1, F.lit(1)))
            found = F.filter(F.transform(places, lambda p: F.substr(text, p, F.lit(n))), lambda s: wanted(s, k))
        return F.transform(F.array_distinct(found), lambda key: F.struct(F.lit(k).alias("k"), key.alias("key")))

    text = F.col(doc_text)
    every = bound(words(text), lambda dw: F.concat(*[runs(text, dw, k) for k in kinds])) if kinds else F.array().cast("array<struct<k:int,key:string>>")
    keyed = docs.select(*docs.columns, F.explode(every).alias("_r")).select(*docs.columns, F.col("_r.k").alias("_k"), F.col("_r.key").alias("_key"))
    joined = keyed.join(item.drop("_start"), ["_k", "_key"])
    return joined.where(F.contains(text, F.col(item_text))).drop("_k", "_key")


#: Characters that key an item without inner words.
SHORT = 4

#: Roles that may follow a role; the first turn of a conversation follows "".
FOLLOWS: dict[str, tuple[str, ...]] = {"": ("system", "user"), "system": ("user",), "user": ("assistant", "call"), "assistant": ("user",), "call": ("result",), "result": ("assistant", "call")}


def history_status(turns: DataFrame, conv: str, turn: str, role: str, follows: Mapping[str, Sequence[str]] = FOLLOWS, last: Sequence[str] = ("assistant", "user")) -> DataFrame:
    """One row a conversation: turns, illegal steps, gaps in the numbering, whether the last role is legal."""
    w = Window.partitionBy(conv).orderBy(turn)
    before = F.coalesce(F.lag(role).over(w), F.lit(""))
    legal = reduce(lambda acc, kv: acc | ((before == kv[0]) & F.col(role).isin(*kv[1])), follows.items(), F.lit(False))
    marked = turns.select(conv, turn, role, legal.alias("_legal"), (F.col(turn) - F.row_number().over(w)).alias("_shift"))
    return marked.groupBy(conv).agg(
        F.count("*").alias("n_turns"),
        F.count_if(~F.col("_legal")).alias("illegal"),
        (F.max("_shift") != F.min("_shift")).alias("has_gap"),
        F.max_by(role, turn).isin(*last).alias("ends_well"),
    )


def chain_gaps(steps: DataFrame, chain: str, step: str) -> DataFrame:
    """Chains whose steps aren't contiguous from their first."""
    return steps.groupBy(chain).agg(F.count("*").alias("n"), F.min(step).alias("first_step"), F.max(step).alias("last_step"), F.countDistinct(step).alias("n_distinct")).where(
        "n <> n_distinct or last_step - first_step + 1 <> n"
    )


def derive_tags(columns: Mapping[str, Column], fields: Column, most: int = 16) -> Column:
    """Tags whose condition holds, in the order given, then the touched fields; repeated ones once, at most ``most``."""
    capability = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in columns.items()]))
    return F.slice(F.array_distinct(F.concat(capability, F.array_sort(F.array_distinct(fields)))), 1, most)


def errors_of(checks: Mapping[str, Column]) -> Column:
    """Codes of the checks that fail; a check that is null fails."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in checks.items()]))


def dataset_errors(df: DataFrame, key: str, errors: str) -> DataFrame:
    """All record errors and repeated ids, ``(id, error)``."""
    own = df.select(F.col(key).alias("id"), F.explode(errors).alias("error"))
    twice = df.groupBy(F.col(key).alias("id")).count().where("count > 1").select("id", F.lit("duplicate_id").alias("error"))
    return own.unionByName(twice)


def render_chat(turns: DataFrame, conv: str, turn: str, role: str, text: str, names: Mapping[str, str]) -> DataFrame:
    """One JSON row a conversation: a list of ``{from, value}`` in order of turns."""
    shown = F.lit(None).cast("string")
    for k, v in names.items():
        shown = F.when(F.col(role) == k, v).otherwise(shown)
    item = F.struct(F.col(turn).alias("turn"), shown.alias("from"), F.coalesce(F.col(text), F.lit("")).alias("value"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    return turns.groupBy(conv).agg(F.to_json(ordered).alias("conversations"))


def perturb_orders(df: DataFrame, date: str, amount: str, duration: Column) -> DataFrame:
    """A rejected variant of each row: a duration grows by 30, else the date moves by a day; rows without either are left out."""
    changed = df.withColumns(
        {
            "rejected_duration": F.when(duration.isNotNull(), duration + 30),
            "rejected_date": F.when(duration.isNull(), F.col(date) + F.expr("interval 1 day")),
        }
    )
    return changed.where("rejected_duration is not null or rejected_date is not null")
