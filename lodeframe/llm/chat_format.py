"""Chat formatting with a loss mask, in Spark expressions only.

A conversation's rows are collected as structs and sorted by turn.  Adjacent
turns of one role become one block, the texts of a block being joined by a
separator mark, so the single turns can still be read back::

    <|im_start|>user\\nfirst<|im_sep|>second<|im_end|>\\n<|im_start|>assistant\\n...

Inside a text ``\\`` becomes ``\\\\`` and a ``|`` that follows ``<`` becomes
``\\|``, so no text can hold a mark; roles are URL-encoded, so a role holds
neither a mark nor a line end.  Both are reversible.

Defined cases: a null text or role is the empty string; rows without a turn
sort first; rows that tie on the turn are ordered by role, then text, and
repeated rows stay; each distinct row without a ``conv_id`` is a conversation of
its own, so those never meet in one value; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=<)\|", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _literal_split(text: Column, mark: str) -> Column:
    return F.split(text, r"\Q" + mark + r"\E")


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, text)``.

    Returns ``conv_id, formatted, loss_spans``: spans are structs of ``start``
    (code points from 0) and ``length`` into ``formatted`` that cover exactly
    the texts of ``trained_role``, without marks.

    Rows of a conversation meet in one array because they meet in one output
    value; the partial aggregation before the shuffle already shortens it.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("t"))
    sorted_turns = rows.groupBy("conv_id", alone.alias("alone")).agg(F.sort_array(F.collect_list("t")).alias("turns")).drop("alone")
    # the first turn of each block, then the blocks as slices
    opens = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get(F.col("turns"), i)["role"] != F.get(F.col("turns"), i - 1)["role"]),
    )
    opened = sorted_turns.withColumn("opens", opens)
    blocks = F.transform(
        "opens",
        lambda first, k: F.struct(
            F.get(F.col("turns"), first)["role"].alias("role"),
            F.transform(
                F.slice("turns", first + 1, F.coalesce(F.get(F.col("opens"), k + 1), F.size("turns")) - first),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )
    merged = opened.select("conv_id", blocks.alias("blocks"))
    written = F.transform(
        "blocks", lambda b: F.concat(F.lit(START), F.url_encode(b["role"]), F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END))
    )
    formatted = merged.select("conv_id", F.array_join(written, "").alias("formatted"))
    return formatted.withColumn("loss_spans", loss_spans(F.col("formatted"), trained_role))


def _blocks(formatted: Column) -> Column:
    """The blocks of a formatted text, without their marks."""
    return F.filter(_literal_split(formatted, END), lambda b: b.startswith(START))


def _role(block: Column) -> Column:
    return F.url_decode(F.substring_index(F.substr(block, F.lit(len(START) + 1)), "\n", 1))


def _body(block: Column) -> Column:
    return F.substr(block, F.locate("\n", block) + 1)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


#: Numbers that a running sum adds up at a time.
STRIDE = 64


def running_sums(numbers: Column) -> Column:
    """The sum of the numbers before each one: sums of strides first, then inside the own stride.

    The work for n numbers is n * ``STRIDE`` + (n / ``STRIDE``) ** 2 additions, and no array is copied for a number.
    """
    zero = F.lit(0).cast("long")
    total = lambda xs: F.aggregate(xs, zero, lambda acc, x: acc + x)
    strides = F.transform(F.sequence(F.lit(0), F.floor(F.size(numbers) / STRIDE).cast("int")), lambda c: total(F.slice(numbers, c * STRIDE + 1, STRIDE)))
    heads = _once(strides, lambda s: F.transform(s, lambda _, c: total(F.slice(s, F.lit(1), c))))
    stride = lambda i: F.floor(i / STRIDE).cast("int")
    return _once(heads, lambda h: F.transform(numbers, lambda _, i: F.get(h, stride(i)) + total(F.slice(numbers, stride(i) * STRIDE + 1, i % STRIDE))))


def loss_spans(formatted: Column, trained_role: str) -> Column:
    """Spans of the texts of ``trained_role``, from the lengths of texts and marks alone."""
    # a text is led by its block's header, and the end of the block before, or by a separator
    header = lambda b, k: F.locate("\n", b) + F.when(k > 0, len(END)).otherwise(0)
    pieces = F.flatten(
        F.transform(
            _blocks(formatted),
            lambda b, k: F.transform(
                _literal_split(_body(b), SEP),
                lambda x, i: F.struct(
                    F.when(i == 0, header(b, k)).otherwise(len(SEP)).cast("long").alias("lead"), F.char_length(x).cast("long").alias("length"), (_role(b) == trained_role).alias("trained")
                ),
            ),
        )
    )

    def spans(all_: Column) -> Column:
        steps = F.transform(all_, lambda p: p["lead"] + p["length"])
        placed = _once(steps, lambda n: _once(running_sums(n), lambda at: F.transform(all_, lambda p, i: F.struct((F.get(at, i) + p["lead"]).cast("int").alias("start"), p["length"].cast("int").alias("length"), p["trained"].alias("trained")))))
        return F.transform(F.filter(placed, lambda p: p["trained"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))

    return _once(pieces, spans)


def read_turns(formatted: Column) -> Column:
    """The array of ``(role, text)`` turns that a formatted text was made of."""
    return F.flatten(
        F.transform(
            _blocks(formatted),
            lambda b: F.transform(_literal_split(_body(b), SEP), lambda x: F.struct(_role(b).alias("role"), unescape(x).alias("text"))),
        )
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """What lies under the loss mask, unescaped and put together.

    Code points are cut from a form of four bytes each, where a place is found at
    once.  A span is cut with the character before it, so that a mark of byte order
    that begins a text isn't taken for one of the cut.
    """
    wide = 4
    cut = lambda b, s: F.decode(F.substr(b, (s["start"] - 1) * wide + 1, (s["length"] + 1) * wide), "UTF-32")
    return _once(F.encode(formatted, "UTF-32"), lambda b: F.array_join(F.transform(spans, lambda s: unescape(F.substr(cut(b, s), F.lit(2)))), ""))
