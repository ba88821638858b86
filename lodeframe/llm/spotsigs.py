"""Document fingerprints: SpotSigs, in Spark expressions only.

Common words are anchors.  Each content word that follows anchors starts a
signature: the anchors before it and the chain of ``CHAIN`` content words from
it on.  A word with no anchor among the ``LONELY`` words before it starts one too,
so text without running language still has signatures, and the rule stays local:
an edit changes only the signatures near it.  A text's fingerprint is the set of its signatures, so page furniture
without running language adds little to it.

Sets are partitioned by length: band ``b`` holds the sizes from ``RATIO ** b``
up to the next power.  Two sets' Jaccard likeness is at most the ratio of their
sizes, so sets whose bands or sizes lie too far apart for the floor asked for
are pruned without reading them, and the rest are intersected.

Defined cases: a null text is empty; an empty text, or one without letters or
digits, has the empty fingerprint; two empty fingerprints are alike (1), an empty
one is unlike any other (0); a text of anchors only is one signature; equal texts have equal
fingerprints; rows without an id come last in the order of ids, and rows that
repeat an id are in order of a hash of their texts; extra columns are ignored.  Ids
must be integers; others raise ``TypeError``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import integer_ids

CHAIN, LONELY = 3, 4
RATIO = 1.25
MARK, GAP = "\x02", " "

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his in is it its not of on or she that the their there they this "
    "to was we were which will with you "
    "als auch auf aus bei das dem den der des die ein eine einen einer es für hat ich im ist mit nicht sich sie sind so und von war wie zu zum zur "
    "au aux avec ce cette dans de du elle en est et il je la le les leur mais ne nous par pas plus pour qui que sa se ses son sont sur un une vous "
    "al como con del el ella este esta ha las lo los más me muy no o para pero por ser si sin su sus también una uno y ya"
).split()


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _name(chain: Column) -> Column:
    return F.left(F.md5(chain), F.lit(16))


def signatures(text: Column) -> Column:
    """Sorted distinct signatures of a text, as hex digits of 64 bits."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    # every anchor is written in front of the content word that follows it
    marked = F.transform(
        F.filter(words, lambda w: w != ""), lambda w: F.concat(w, F.when(w.isin(ANCHORS), F.lit(MARK)).otherwise(F.lit(GAP)))
    )
    return bound(F.array_join(marked, ""), lambda written: bound(F.split(written, GAP), lambda spots: _chains(written, spots)))


def _chains(written: Column, spots: Column) -> Column:
    """Signatures of content words that carry their anchors in front.

    The last of ``spots`` holds anchors without a content word, or nothing.
    """
    last = F.size(spots) - 1
    plain = lambda x: F.substring_index(x, MARK, -1)
    spot = lambda x: F.coalesce(F.instr(x, MARK) > 0, F.lit(False))

    def chain(word: Column, at: Column) -> Column:
        following = [plain(F.get(spots, at + k)) for k in range(1, CHAIN)]
        starts = spot(word)
        lonely = F.lit(True)
        for k in range(1, LONELY + 1):
            lonely = lonely & ~spot(F.get(spots, at - k))
        return F.when((at < last) & (starts | lonely), _name(F.concat_ws(GAP, word, *following)))

    found = F.array_compact(F.transform(spots, chain))
    whole = F.when(written != "", F.array(_name(written))).otherwise(F.array().cast("array<string>"))
    return bound(found, lambda some: F.when(F.size(some) > 0, F.array_sort(F.array_distinct(some))).otherwise(whole))


def digest(sigs: Column) -> Column:
    """A fingerprint as a short string: size and digest of the set."""
    return F.concat(F.size(sigs).cast("string"), F.lit("-"), F.md5(F.array_join(sigs, ",")))


def band(size: Column) -> Column:
    """The length partition of a set."""
    return F.when(size > 0, F.floor(F.log(size.cast("double")) / F.log(F.lit(RATIO)))).otherwise(F.lit(-1)).cast("int")


def likeness(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard likeness of two sets, 0 where their lengths prove it below ``floor``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = band(large) - band(small)
    far = apart > F.ceil(F.log(F.lit(1 / floor)) / F.log(F.lit(RATIO))) if floor > 0 else F.lit(False)
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | far | (small < floor * large), F.lit(0.0))
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


#: Ranges of ids to a shuffle partition: several small ones even out long texts.
RANGES = 4


def _above(borders: list[int], place: Column) -> Column:
    """How many of these rising numbers lie above ``place``: a step over a few of them, then over those in between."""
    if not borders:
        return F.lit(0)
    width = max(1, math.isqrt(len(borders)))
    groups = [borders[k : k + width] for k in range(0, len(borders), width)]
    over = lambda numbers: F.size(F.filter(numbers, lambda b: b > place))
    coarse = over(F.array(*[F.lit(g[-1]) for g in groups]))  # groups whose last is above, all but the first of them wholly
    fine = F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), F.lit(len(groups)) - coarse)
    wholly = F.get(F.array(*[F.lit(sum(map(len, groups[k + 1 :]))) for k in range(len(groups))]), F.lit(len(groups)) - coarse)
    return F.when(coarse == 0, 0).otherwise(over(fine) + wholly)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows of ``(doc_id, text)`` dealt into ranges of descending ids.

    Adds ``place``, ``tie``, ``range_no`` and ``is_halo``: each range also gets, as
    its last row, a copy of the first row of the next range (after the last, the
    first range), so a window over one range sees the successor of each of its own
    rows.  Borders are quantiles over all ids; rows that share an id, or have none,
    are in order of a hash of their texts, and where they fill more than a range
    they are dealt into several by it.  So a range holds its share of the rows
    however large one source, group or id is.
    """
    least = -(2**63)
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("place"), F.xxhash64(text).alias("tie"))
    share = F.array(*[F.lit(k / ranges) for k in range(1, ranges)])
    found = Counter(rows.agg(F.percentile_approx("place", share, F.lit(max(10_000, 20 * ranges)))).first()[0] or [])
    # an id that is several borders fills as many ranges, which lie behind the rest of its range
    full = {place: n for place, n in found.items() if n > 1}
    most = 1 + max(full.values(), default=0)
    part = F.lit(0)
    for place, n in full.items():
        part = F.when(F.col("place") == place, 1 + F.least(F.lit(n - 1), F.floor((F.col("tie") / 2.0**63 + 1) / 2 * n))).otherwise(part)
    rows = rows.withColumn("own", (_above(sorted(found), F.col("place")).cast("long") * most + part).cast("long"))
    firsts = dict(sorted(tuple(r) for r in rows.groupBy("own").agg(F.max("place")).collect()))  # one row a range
    order = list(firsts)
    before = {own: order[k - 1] for k, own in enumerate(order)}
    first = F.element_at(F.create_map(*[F.lit(x) for pair in firsts.items() for x in pair]), F.col("own")) if firsts else F.lit(least)
    to = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("own")) if before else F.lit(0).cast("long")
    heads = rows.where(F.col("place") == first).groupBy("own").agg(F.min(F.struct("tie", "text", "doc_id", "place")).alias("r"))
    halo = heads.select("r.doc_id", "r.text", "r.place", "r.tie", to.alias("range_no"), F.lit(True).alias("is_halo"))
    return rows.select("doc_id", "text", "place", "tie", F.col("own").alias("range_no"), F.lit(False).alias("is_halo")).unionByName(halo)


def compare_with_edited(docs: DataFrame, floor: float = 0.0) -> DataFrame:
    """Each text, its edited form and the next document, fingerprinted and compared.

    The edited text has the last third of its code points (rounded down)
    replaced by the first as many of the next document in descending id order.
    Returns ``doc_id, n_chars, edited, signatures, edited_signatures, near_edited, near_next``.
    """
    in_range = Window.partitionBy("range_no").orderBy("is_halo", F.col("place").desc(), "tie", "text")
    integer_ids(docs)
    rows = with_next(docs).withColumn("next_text", F.lead("text").over(in_range))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third))
    rows = rows.select("doc_id", "place", "tie", "text", "range_no", "is_halo", n.cast("long").alias("n_chars"), F.when(~F.col("is_halo"), edited).alias("edited"))
    rows = rows.withColumn("signatures", signatures(F.col("text")))
    rows = rows.withColumn("next_signatures", F.lead("signatures").over(in_range)).where(~F.col("is_halo"))
    rows = rows.withColumn("edited_signatures", signatures(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "signatures",
        "edited_signatures",
        likeness(F.col("signatures"), F.col("edited_signatures"), floor).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures"), floor).alias("near_next"),
    )
