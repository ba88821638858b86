"""Substring deduplication over word windows, with a count-min prefilter.

A window is ``size`` consecutive words of one document.  Each word is removed
that lies in a window whose word sequence also starts in a document with a
smaller id; windows are judged on the input.

1. Documents are dealt into blocks by a hash of their ids.  Every block sketches
   its windows' hashes; the merged sketch tells which windows are estimated to
   occur more than once (``windows``).  Estimates are never too low, so no
   repeated window is lost.
2. A second pass keeps the windows estimated repeated.  Each block groups its own
   first: a window's places beyond the smallest id in the block are decided there,
   so a block sends each window once, however common the window.
3. Those are dealt into buckets of the hash, in packed columns, and grouped
   exactly (96 bits of hash); all but the smallest id are removed windows.
   Windows that the sketch counts in more than ``HOT`` blocks are first grouped by
   parts of the blocks, of which each sends on its smallest id.
4. Positions, packed, return to the blocks, which cut the covered words.

Blocks, slices and buckets grow in number with the input, not in size; nothing is
collected or broadcast.

Defined cases: a null text has no words; documents with fewer than ``size`` words
keep all; a window repeated inside one document only stays; rows with a null id
take no part and keep all words; rows that repeat an id are the same document to
each other (neither is smaller) and are each judged by their own text; extra
columns are carried along, but for one named ``dedup``, whose place the result
takes.  Ids must be integers; others raise ``TypeError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .storage import integer_ids, text_batches
from .windows import CELLS_PER_WINDOW, Answers, Sizes, block_answers, block_number, concatenated, level, pack, runs, unpack, window_hashes, word_hashes

SIZE = 13
#: Windows that a bucket may hold about, and blocks in which a window may occur before its places are grouped in parts.
BUCKET_WINDOWS, HOT = 1_000_000, 1000
PLACES = ["docs", "parts", "counts", "places"]
PLACES_DDL = "docs binary, parts binary, counts binary, places binary"
WINDOWS = ["block", "keys", "checks", *PLACES]
WINDOWS_DDL = f"block int, keys binary, checks binary, {PLACES_DDL}"
DEDUP = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _heads(starts: np.ndarray) -> np.ndarray:
    """For each row the index of its group's first row."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))


def pack_places(doc: np.ndarray, part: np.ndarray, pos: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Places sorted by document and position: documents, their numbers of places, packed positions."""
    starts = np.flatnonzero(_changes(doc, part))
    steps = np.diff(pos.astype(np.int64), prepend=0)
    steps[starts] = pos[starts]
    counts = np.diff(starts, append=len(doc)).astype(np.int32)
    return doc[starts].astype(np.int64).tobytes(), part[starts].astype(np.int32).tobytes(), counts.tobytes(), pack(np.cumsum(steps))


def unpack_places(docs: bytes, parts: bytes, counts: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.frombuffer(counts, np.int32)
    run = unpack(places)
    starts = np.cumsum(n) - n
    before = np.where(starts > 0, run[starts - 1], 0)
    return np.repeat(np.frombuffer(docs, np.int64), n), np.repeat(np.frombuffer(parts, np.int32), n), (run - np.repeat(before, n)).astype(np.int32)


class Held:
    """Windows with their places: ``key, check, block, doc, part, pos`` as columns."""

    def __init__(self, *columns: np.ndarray):
        self.key, self.check, self.block, self.doc, self.part, self.pos = self.columns = columns

    def at(self, rows: np.ndarray) -> Held:
        return Held(*(c[rows] for c in self.columns))

    def later(self) -> np.ndarray:
        """Which windows also start in a document with a smaller id among these."""
        order = np.lexsort((self.doc, self.check, self.key))
        key, check, doc = self.key[order], self.check[order], self.doc[order]
        out = np.zeros(len(doc), bool)
        out[order] = doc > doc[_heads(_changes(key, check))]
        return out

    def records(self, by: np.ndarray, with_keys: bool = True) -> Iterator[tuple]:
        """``(value of by, block, keys, checks, places)``, one for each value and block; without keys they are decided."""
        order = np.lexsort((self.pos, self.part, self.doc, self.block, by))
        group = np.cumsum(_changes(by[order], self.block[order]))
        for _, a, b in runs(group):
            x = self.at(order[a:b])
            keys = (x.key.tobytes(), x.check.tobytes()) if with_keys else (b"", b"")
            yield int(by[order[a]]), int(x.block[0]), *keys, *pack_places(x.doc, x.part, x.pos)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32() if n in ("bucket", "salt", "block") else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[Held | None, list[tuple]]:
    """The open windows of records, and the decided records as they came."""
    held, decided = [], []
    for batch in batches:
        for block, keys, checks, *places in zip(*[batch[c].to_pylist() for c in WINDOWS], strict=True):
            if not keys:
                decided.append((block, keys, checks, *places))
                continue
            doc, part, pos = unpack_places(*places)
            held.append((np.frombuffer(keys, np.uint64), np.frombuffer(checks, np.uint32), np.full(len(doc), block, np.int32), doc, part, pos))
    return (Held(*(np.concatenate([h[k] for h in held]) for k in range(6))) if held else None), decided


class Block:
    """A block's documents, each with a number that tells equal ids with different texts apart."""

    def __init__(self, table: pa.Table, size: int):
        self.ids = table["doc_id"].to_pylist()
        self.texts = [x.as_py() or b"" for x in table["data"]]
        names = [(i, xxhash.xxh3_128_digest(t)) if i is not None else None for i, t in zip(self.ids, self.texts, strict=True)]
        numbers = {x: k for k, x in enumerate(sorted({x for x in names if x}))}
        self.numbers = [numbers.get(x) if x else None for x in names]
        self.size = size

    def windows(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Id, number, word hashes and window hashes of each document with an id."""
        for i, k, text in zip(self.ids, self.numbers, self.texts, strict=True):
            if k is not None and len(text) >= 2 * self.size - 1:
                words = word_hashes(text)
                yield i, k, words, window_hashes(words, self.size)


def removed_windows(blocked: DataFrame, sizes: Sizes, size: int, hot: int) -> DataFrame:
    """Packed starts of removed windows by block, of ``blocked(block, doc_id, data, ...)``."""
    spark = blocked.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sizes.windows // BUCKET_WINDOWS + 1)
    salts = -(-sizes.blocks // hot)
    hot_level = int(level(np.array([hot]))[0])

    def hashes(table: pa.Table) -> np.ndarray:
        return concatenated(h for *_, h in Block(table, size).windows())

    def candidates(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            block = key[0].as_py()
            texts = list(Block(left, size).windows())
            estimates = Answers(right, sizes).levels(concatenated(h for *_, h in texts))
            held: list[tuple[np.ndarray, ...]] = []
            done = 0
            for i, k, words, h in texts:
                own = estimates[done : done + len(h)]
                done += len(h)
                pos = np.flatnonzero(own > 1)
                if len(pos):
                    check = window_hashes(words, size, 1)[pos].astype(np.uint32)
                    n = len(pos)
                    held.append((h[pos], check, np.full(n, block, np.int32), np.full(n, i, np.int64), np.full(n, k, np.int32), pos.astype(np.int32), own[pos]))
            if held:
                *columns, own = (np.concatenate([x[k] for x in held]) for k in range(7))
                open_ = Held(*columns)
                gone = open_.later()
                # decided here: they pass the buckets without keys
                found = [(block % buckets, 0, *rest) for _, *rest in open_.at(gone).records(open_.block[gone], with_keys=False)]
                left_, own = open_.at(~gone), own[~gone]
                bucket = (((left_.key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                salt = np.where((own >= hot_level) & (salts > 1), 1 + block % salts, 0)
                found += [(x // (salts + 1), x % (salts + 1), *rest) for x, *rest in left_.records(bucket * (salts + 1) + salt)]
        return pa.Table.from_batches([_batch(found, ["bucket", "salt", *WINDOWS])])

    def in_parts(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of hot windows the places with the smallest id of this part are still open, all others are decided."""
        held, decided = _read(batches)
        rows = [(x[0] % buckets, *x) for x in decided]
        if held:
            gone = held.later()
            rows += [(block % buckets, block, *rest) for _, block, *rest in held.at(gone).records(held.block[gone], with_keys=False)]
            if key[1].as_py():
                kept = held.at(~gone)
                rows += list(kept.records(np.full(len(kept.doc), key[0].as_py())))
        yield _batch(rows, ["bucket", *WINDOWS])

    def grouped(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, decided = _read(batches)
        rows = [(x[0], *x[3:]) for x in decided]
        if held:
            gone = held.later()
            rows += [(block, *rest[2:]) for _, block, *rest in held.at(gone).records(held.block[gone], with_keys=False)]
        yield _batch(rows, ["block", *PLACES])

    answers = block_answers(blocked, hashes, sizes)
    sent = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(candidates, f"bucket int, salt int, {WINDOWS_DDL}")
    if salts > 1:
        sent = sent.groupBy("bucket", "salt").applyInArrow(in_parts, f"bucket int, {WINDOWS_DDL}")
    return sent.groupBy("bucket").applyInArrow(grouped, f"block int, {PLACES_DDL}")


def cut(raw: bytes, places: np.ndarray | None, size: int) -> tuple[str, int, int, str]:
    """Text without the words of the windows at ``places``, words before, words removed, digest of the kept words."""
    words = raw.split()
    n = len(words)
    if places is not None and len(places):
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, places, 1)
        np.add.at(edge, np.minimum(places + size, n), -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:n]) == 0)]
    kept = b" ".join(words)
    return (raw if len(words) == n else kept).decode(), n, n - len(words), hashlib.sha256(kept).hexdigest()


def deduplicated(docs: DataFrame, size: int = SIZE, cells_per_window: float = CELLS_PER_WINDOW, hot: int = HOT) -> DataFrame:
    """Each row of ``docs`` with ``text`` without its removed words.

    Returns the columns of ``docs`` and ``n_words, n_removed, kept_sha256`` (of
    the kept words joined by one space) in the struct ``dedup``.  A text of which
    nothing is removed stays as it is.  ``cells_per_window`` and ``hot`` change
    the work, not the result.
    """
    integer_ids(docs)
    columns = [c for c in docs.columns if c != "dedup"]
    text_batches(docs.sparkSession)
    sizes = Sizes.of(docs.select(F.col("text").cast("binary").alias("data")), cells_per_window)
    blocked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"]).alias("row"),
        block_number(sizes.blocks, F.col("doc_id").cast("long"), F.when(F.col("doc_id").isNull(), F.col("text"))).alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("data"),
    )
    # the blocks are dealt out once: the three steps that read them share one exchange
    removed = removed_windows(blocked, sizes, size, hot)

    def cut_block(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        starts: dict[int, list[np.ndarray]] = {}
        for row in zip(*[right[c].to_pylist() for c in PLACES], strict=True):
            _, part, pos = unpack_places(*row)
            for number, a, b in runs(part):
                starts.setdefault(number, []).append(pos[a:b])
        block = Block(left, size)
        out: list[tuple[str, int, int, str]] = []
        for number, raw in zip(block.numbers, block.texts, strict=True):
            found = starts.get(number) if number is not None else None
            out.append(cut(raw, np.concatenate(found) if found else None, size))
        row = left["row"].combine_chunks()
        row = row.chunk(0) if isinstance(row, pa.ChunkedArray) else row
        given = left["data"].is_valid().to_pylist()
        texts = pa.array([x[0] if there else None for x, there in zip(out, given, strict=True)], pa.string())
        cells = {c: texts if c == "text" else row.field(c) for c in columns}
        fields = [pa.array([x[k] for x in out], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.string()))]
        cells["dedup"] = pa.StructArray.from_arrays(fields, DEDUP.fieldNames())
        return pa.table(cells)

    schema = StructType([*(f for f in docs.schema.fields if f.name != "dedup"), StructField("dedup", DEDUP)])
    return blocked.groupBy("block").cogroup(removed.groupBy("block")).applyInArrow(cut_block, schema)
