"""Mixing sources to target weights.

Tokens are aggregated per source, capped weighted targets give each source a
repetition rate, and every document is emitted ``floor(rate)`` times plus one
Bernoulli copy whose probability is the fraction of the rate.

The draws are systematic, so a source of few documents, or one very long
document, doesn't carry the total far from its target: a source's documents stand
in cells by the bits of their size, smallest first, and the running sum of the
probabilities, from a start that is a hash of the source, tells how many copies
each cell gets (``floor`` of the sum at its end minus ``floor`` at its beginning).
They go to the documents with the smallest hashes of the cell.  Over seeds each document is
copied with exactly the fraction as its probability, whatever its size.

A cell's border hash is found by counting, so no source or cell, however large, is
gathered or sorted by one task.  Draws are functions of the table alone: reruns
and recomputed partitions agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of a hash, and of its stretch.
DIGITS, STRETCH = 13, 3
HASHES = 16**DIGITS
#: Source tables up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, max_repeat: float = 3.0
) -> DataFrame:
    """Target per source from ``(source, source_size)`` rows.

    Sources sorted by code point, null last, take ``weights`` cyclically and
    divide ``share`` of all sizes.  A target stops at ``max_repeat`` times its
    source's size and the excess is shared out again by weight.  The fixed
    point is the water level of the sorted caps: sources with the smallest
    cap per weight are capped first, and the level after the k-th cap is
    ``(total - caps so far) / weight left``.  One row per source enters the
    windows, never documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    w = sizes.withColumn("weight", F.get(cycle, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    w = w.withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    w = w.withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    w = w.withColumn("fits", (F.col("total") - F.col("caps_before")) * F.col("weight") <= F.col("cap") * F.col("weight_left"))
    # the first source in cap order that is not capped fixes the level of all later ones
    w = w.withColumn("rank", F.row_number().over(order))
    w = w.withColumn("first_open", F.min(F.when(F.col("fits"), F.col("rank"))).over(everything))
    opened = F.col("rank") == F.col("first_open")
    w = w.withColumn("level_left", F.max(F.when(opened, F.col("total") - F.col("caps_before"))).over(everything))
    w = w.withColumn("level_weight", F.max(F.when(opened, F.col("weight_left"))).over(everything))
    target = F.when(
        F.col("rank") >= F.col("first_open"), F.col("level_left") * F.col("weight") / F.col("level_weight")
    ).otherwise(F.col("cap"))
    return w.select("source", "source_size", target.cast("double").alias("target"))


def _hash(key: Column) -> Column:
    """A whole number below ``HASHES``."""
    return F.conv(F.left(F.sha2(key, 256), F.lit(DIGITS)), 16, 10).cast("long")


def sized_rows(docs: DataFrame, seed: str) -> DataFrame:
    """``docs(doc_id, source, text)`` with ``size``, ``cell`` and ``draw``, the hash of id and text, so rows of one id draw apart where their texts differ."""
    own = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rows = docs.select("*", count_words(F.col("text")).alias("mix_size"))
    cell = F.when(F.col("mix_size") > 0, F.char_length(F.bin("mix_size"))).otherwise(0)
    return rows.withColumn("mix_cell", cell).withColumn("mix_draw", _hash(F.concat(F.lit(f"{seed}:"), own)))


def _hinted(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if small.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else small


def _on(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    conditions = [left[k].eqNullSafe(right[k]) for k in keys]
    return reduce(lambda a, b: a & b, conditions)


def mix_plan(
    sized: DataFrame, seed: str = "mix", weights: Sequence[int] = (1, 2, 3), share: float = 1.0, max_repeat: float = 3.0
) -> DataFrame:
    """One row per source and cell of ``sized(source, mix_size, mix_cell, mix_draw)``.

    Columns are ``source, mix_cell, source_size, target, whole, border``: a
    document is emitted ``whole`` times and once more if its draw is at most
    ``border``.
    """
    cells = materialize(sized.groupBy("source", "mix_cell").agg(F.count("*").alias("rows"), F.sum("mix_size").cast("long").alias("words")), "mix-cells")
    sources = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.select("source", "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part"))
    smaller = Window.partitionBy("source").orderBy("mix_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(smaller), F.lit(0))
    start = _hash(F.concat(F.lit(f"{seed}:source:"), F.coalesce("source", F.lit("")))) / F.lit(float(HASHES))
    cells = cells.withColumn("before", before)
    cells = cells.join(sources, _on(cells, sources, "source")).drop(sources["source"])
    upto = lambda n: F.floor(start + F.col("part") * n)
    cells = cells.withColumn("extra", upto(F.col("before") + F.col("rows")) - upto(F.col("before")))
    cells = materialize(cells, "mix-extras")
    borders = _borders(sized, cells)
    # a cell without a border to find takes none or all
    border = F.when(F.col("extra") <= 0, F.lit(-1)).when(F.col("extra") >= F.col("rows"), F.lit(HASHES)).otherwise(F.col("found"))
    found = cells.join(borders, _on(cells, borders, "source", "mix_cell"), "left").drop(borders["source"], borders["mix_cell"])
    return materialize(found.select("source", "mix_cell", "source_size", "target", "whole", border.cast("long").alias("border")), "mix-plan")


def _borders(sized: DataFrame, cells: DataFrame) -> DataFrame:
    """``source, mix_cell, found``: the ``extra``-th smallest draw of each cell that copies some of its documents.

    Draws are counted by stretches of their range; only the stretch that holds the
    border is ranked, a 4096th of the cell.
    """
    open_ = cells.where("extra > 0 and extra < rows").select("source", "mix_cell", "extra")
    stretch = F.floor(F.col("mix_draw") / (HASHES // 16**STRETCH))
    rows = sized.select("source", "mix_cell", "mix_draw", stretch.alias("stretch"))
    hinted = _hinted(open_)
    rows = rows.join(hinted, _on(rows, hinted, "source", "mix_cell")).select(rows["source"], rows["mix_cell"], "mix_draw", "stretch", "extra")
    counts = rows.groupBy("source", "mix_cell", "stretch").agg(F.count("*").alias("n"), F.first("extra").alias("extra"))
    lower = Window.partitionBy("source", "mix_cell").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("below", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    holding = counts.where("below < extra and extra <= below + n").select("source", "mix_cell", "stretch", (F.col("extra") - F.col("below")).alias("wanted"))
    held = _hinted(materialize(holding, "mix-stretches"))
    inside = rows.join(held, _on(rows, held, "source", "mix_cell", "stretch")).select(rows["source"], rows["mix_cell"], rows["stretch"], "mix_draw", "wanted")
    order = Window.partitionBy("source", "mix_cell", "stretch").orderBy("mix_draw")
    return inside.withColumn("at", F.row_number().over(order)).where("at = wanted").select("source", "mix_cell", F.col("mix_draw").alias("found"))


def decide(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``source_size, target, copies`` to rows with ``source, mix_cell, mix_draw``."""
    hinted = _hinted(plan)
    copies = (F.col("whole") + F.when(F.col("mix_draw") <= F.col("border"), 1).otherwise(0)).cast("int")
    joined = rows.join(hinted, _on(rows, hinted, "source", "mix_cell")).drop(hinted["source"], hinted["mix_cell"])
    return joined.withColumn("copies", copies).drop("whole", "border")


def mixed(docs: DataFrame, seed: str = "mix", **plan_options) -> DataFrame:
    """Per document of ``docs(doc_id, source, text)``: the mix's decision.

    Returns ``doc_id, source, size, source_size, target, copies, taken``.
    A null text has size 0, a null source is a source of its own, rows that repeat
    an id each get a row (and share a draw only where their texts are equal), rows
    without an id draw by their text, and a source whose documents are all empty gets rate 0.  Other columns of
    ``docs`` are ignored.  An empty table gives an empty result.
    """
    sized = sized_rows(docs.select("doc_id", "source", "text"), seed).drop("text")
    sized = materialize(sized, "mix-sizes")
    done = decide(sized, mix_plan(sized, seed, **plan_options))
    taken = (F.col("copies") * F.col("mix_size")).cast("long")
    return done.select("doc_id", "source", F.col("mix_size").alias("size"), "source_size", "target", "copies", taken.alias("taken"))


def emit(docs: DataFrame, seed: str = "mix", **plan_options) -> DataFrame:
    """The mixed rows themselves: each row of ``docs`` as often as decided, with its own columns only."""
    sized = materialize(sized_rows(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    plan = mix_plan(sized, seed, **plan_options)
    whole = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"))
    done = decide(sized_rows(whole, seed), plan)
    copied = done.select("mix_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("mix_copy"))
    return copied.select("mix_row.*")
