"""Cross-tokenizer alignment: the tokens of two tokenizers over the same bytes.

Both encode a space and the text.  Over the bytes of a batch of texts stand two
owner arrays, ``np.repeat`` of the token numbers by their byte lengths.  Where either
owner changes, a new pair of owners begins: these pairs are the overlaps.  Where both
change at once, both tokenizers have a border: these are the cuts, and between two
cuts lies a group.  All token pairs of a group are links.

Which links are strong follows from the whole corpus: the count of an id pair is the
number of documents that hold it linked, and a link is best where its count is the
highest of its A id.

1. ``_aligned``: one pass encodes, aligns and hashes; a chunk of documents writes its
   rows with their distinct id pairs, and one row of the chunk's distinct pairs with
   the number of its documents that hold each.
2. The chunks' pairs are summed by pair, the highest counts are taken by A id.
3. Each chunk gets back the counts of its own pairs and sums them up document by
   document (``_scored``).

So a text is read once and never shuffled, a pair travels once a chunk, not once a
document, and nothing is broadcast but the two vocabularies.

Defined cases: a null or empty text, and one whose bytes a tokenizer doesn't give
back, has no tokens: zeros and an empty digest; strings of special tokens are plain
text; rows that repeat an id, or have none, are documents of their own; extra columns
are ignored.  A group's pairs are made from its distinct ids, so a long group of the
same few tokens costs little; a document's distinct pairs are held at once.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import PIECES, ByteBPE
from .storage import forget, materialize, text_batches, write_shared

#: Bytes of text that a chunk of documents holds about; speed and memory depend on it, results don't.
CHUNK_BYTES = 2**23
#: Links of a group from which its distinct ids are paired instead of its tokens.
LARGE_GROUP = 4096
MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file: ids of a text, and the bytes of each id."""

    def __init__(self, content: str, pattern: str):
        read = json.loads(content)
        alphabet = byte_alphabet()
        special = {t["id"] for t in read["added_tokens"]}
        vocabulary = {i: piece for piece, i in read["model"]["vocab"].items() if i not in special}
        if sorted(vocabulary) != list(range(len(vocabulary))):
            raise ValueError("ids must run from 0, special ones last")
        joined = {"".join(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(read["model"]["merges"])}
        in_order = [joined[vocabulary[i]] for i in range(len(vocabulary)) if len(vocabulary[i]) > 1]
        if in_order != sorted(in_order):
            raise ValueError("ids of merged tokens must follow the merges")
        self.tokens = [bytes(alphabet[c] for c in vocabulary[i]) for i in range(len(vocabulary))]
        self.pattern = pattern
        self.library = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(self.tokens)}, special_tokens={})
        self.linear: ByteBPE | None = None

    #: The library's time grows with the square of a piece, so texts with long ones are encoded by ``ByteBPE``, whose time doesn't.
    LONG_PIECE = 500
    long_space = re.compile(rf"\s{{{LONG_PIECE}}}")

    def encode(self, text: str) -> np.ndarray:
        if max(map(len, text.split()), default=0) >= self.LONG_PIECE or self.long_space.search(text):
            self.linear = self.linear or ByteBPE(self.tokens, self.pattern)
            return np.frombuffer(self.linear.encode(text), np.uint32)
        return self.library.encode_to_numpy(text, disallowed_special=())


class Pieces(dict):
    """Stretch of text to its ids as little-endian bytes, found on first sight.

    No piece of the vocabulary holds a space after another character, or a newline,
    so stretches that begin with spaces or a newline are encoded by themselves.
    """

    #: together these cover every string that begins with a space
    stretches = re.compile(r" +[^ \n]*|\n[^ \n]*")

    def __init__(self, model: bytes):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        plain = [p for i, p in enumerate(names) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        self.apart = not any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in plain)
        probe = [self.model.encode(t) for t in ("\n", "a\n")]
        self.apart = self.apart and [self.tokens[i] for i in probe[0]] == [b" ", b"\n"] and self.tokens[probe[1][-1]] == b"\n"

    def learn(self, stretches: list[str]) -> None:
        """Encode stretches that aren't known yet, in one call."""
        # the newline that is added keeps spaces at the end, the space that the model adds goes before a newline
        asked = [s if s[0] == "\n" else s[1:] + "\n" for s in stretches]
        for stretch, ids in zip(stretches, self.model.encode(asked, num_threads=1), strict=True):
            self[stretch] = array("I", ids[1:] if stretch[0] == "\n" else ids[:-1]).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text``, which holds no ``MARK``; the model adds a space before it."""
        if not self.apart:
            return np.array(self.model.encode(text), np.uint32)
        stretches = self.stretches.findall(" " + text)
        if len(self) >= PIECES:
            self.clear()
        new = list({s for s in stretches if s not in self})
        self.learn(new)
        ids = np.frombuffer(b"".join(map(self.__getitem__, stretches)), np.uint32)
        for s in new:
            if len(s) > 64:  # long ones hardly come again
                del self[s]
        return ids


class Alignment:
    """Tokens of several texts, A's and B's over the same bytes: their groups and links."""

    def __init__(self, a_lengths: np.ndarray, b_lengths: np.ndarray):
        # the owner of every byte
        self.a_owner, self.b_owner = np.repeat(np.arange(len(a_lengths), dtype=np.int32), a_lengths), np.repeat(np.arange(len(b_lengths), dtype=np.int32), b_lengths)
        if len(self.a_owner) != len(self.b_owner):
            raise ValueError("both sides must cover the same bytes")
        a_new, b_new = np.diff(self.a_owner, prepend=-1) != 0, np.diff(self.b_owner, prepend=-1) != 0
        #: bytes at which a new pair of owners, and a new group, begins
        self.pairs, self.cuts = np.flatnonzero(a_new | b_new), np.flatnonzero(a_new & b_new)
        #: first token of every group
        self.a_first, self.b_first = self.a_owner[self.cuts], self.b_owner[self.cuts]
        self.a_count, self.b_count = np.diff(self.a_first, append=len(a_lengths)), np.diff(self.b_first, append=len(b_lengths))

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of tokens that share bytes."""
        return self.a_owner[self.pairs], self.b_owner[self.pairs]

    def links(self, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All token pairs of each of the groups."""
        which = np.arange(len(self.cuts)) if groups is None else groups
        a_first, b_first, a_count, b_count = self.a_first[which], self.b_first[which], self.a_count[which], self.b_count[which]
        group = np.repeat(np.arange(len(which)), a_count)  # of every A token
        a = np.arange(len(group)) - np.repeat(np.cumsum(a_count) - a_count, a_count) + np.repeat(a_first, a_count)
        times = b_count[group]
        within = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(a, times), within + np.repeat(b_first[group], times)


def id_pairs(alignment: Alignment, a_ids: np.ndarray, b_ids: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked id pairs ``a << 32 | b`` with their document and how often it holds them, sorted by document and pair.

    ``document`` numbers the document of every group, in rising order.
    """
    size = alignment.a_count * alignment.b_count
    small = np.flatnonzero(size <= LARGE_GROUP)
    a, b = alignment.links(small)
    keys = [(a_ids[a].astype(np.uint64) << np.uint64(32)) | b_ids[b]]
    owners = [np.repeat(document[small], size[small])]
    times = [np.ones(len(a), np.int64)]
    for g in np.flatnonzero(size > LARGE_GROUP):
        own_a, n_a = np.unique(a_ids[alignment.a_first[g] :][: alignment.a_count[g]], return_counts=True)
        own_b, n_b = np.unique(b_ids[alignment.b_first[g] :][: alignment.b_count[g]], return_counts=True)
        keys.append(((own_a.astype(np.uint64)[:, None] << np.uint64(32)) | own_b[None, :]).ravel())
        times.append((n_a[:, None] * n_b[None, :]).ravel())
        owners.append(np.full(len(keys[-1]), document[g]))
    key, owner, often = np.concatenate(keys), np.concatenate(owners), np.concatenate(times)
    order = np.lexsort((key, owner))
    key, owner, often = key[order], owner[order], often[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first)
    return key[starts], owner[starts], np.add.reduceat(often, starts) if len(starts) else often


class Digest:
    """The groups of a text written as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_size: int, b_size: int):
        #: decimal ids, each with the three marks that may follow it, filled up with zero bytes
        self.written = np.array([f"{i}{mark}".encode() for i in range(max(a_size, b_size)) for mark in ",|;"])

    def codes(self, alignment: Alignment, a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        """Numbers in ``written`` for all tokens, group by group."""
        a_group = np.repeat(np.arange(len(alignment.cuts)), alignment.a_count)
        b_group = np.repeat(np.arange(len(alignment.cuts)), alignment.b_count)
        a_mark, b_mark = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        a_mark[alignment.a_first + alignment.a_count - 1] = 1
        b_mark[alignment.b_first + alignment.b_count - 1] = 2
        out = np.empty(len(a_ids) + len(b_ids), np.int64)
        out[np.arange(len(a_ids)) + alignment.b_first[a_group]] = a_ids.astype(np.int64) * 3 + a_mark
        out[np.arange(len(b_ids)) + (alignment.a_first + alignment.a_count)[b_group]] = b_ids.astype(np.int64) * 3 + b_mark
        return out

    def text(self, codes: np.ndarray) -> bytes:
        return self.written.take(codes).tobytes().translate(None, b"\0")[:-1]


class Aligner:
    """Both tokenizers, and the alignment of batches of texts."""

    def __init__(self, a_content: str, b_model: bytes, pattern: str):
        self.a, self.b = ByteLevel(a_content, pattern), Pieces(b_model)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side.tokens], np.int64) for side in (self.a, self.b))
        self.digest = Digest(len(self.a_sizes), len(self.b_sizes))

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides, none where the text is empty or a side doesn't give its bytes back."""
        none = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        if not text or MARK in text:
            return none
        a, b, data = self.a.encode(" " + text), self.b.encode(text), b" " + text.encode()
        # byte-level tokens give every byte back, so their number tells
        if int(self.a_sizes[a].sum()) != len(data) or b"".join(map(self.b.tokens.__getitem__, b.tolist())) != data:
            return none
        return a, b

    def align(self, texts: Sequence[str | None]) -> tuple[list[tuple], list[tuple[np.ndarray, np.ndarray]]]:
        """``(n_a, n_b, n_groups, n_links, digest)`` of every text, and its distinct id pairs with how often it holds them."""
        found = [self.tokens(t) for t in texts]
        a_ids, b_ids = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint32) for k in (0, 1))
        both = Alignment(self.a_sizes[a_ids], self.b_sizes[b_ids])
        # texts are cut from each other too, as both sides begin anew
        a_ends, b_ends = (np.cumsum([len(f[k]) for f in found]) for k in (0, 1))
        group_ends = np.searchsorted(both.a_first, a_ends)
        document = np.repeat(np.arange(len(found)), np.diff(group_ends, prepend=0))
        links = np.concatenate([[0], np.cumsum(both.a_count * both.b_count)])
        codes = self.digest.codes(both, a_ids, b_ids)
        key, owner, often = id_pairs(both, a_ids, b_ids, document)
        pair_ends = np.searchsorted(owner, np.arange(len(found)), "right")
        rows, pairs = [], []
        at = group_at = pair_at = 0
        for (a, b), end, group_end, pair_end in zip(found, a_ends + b_ends, group_ends, pair_ends, strict=True):
            written = hashlib.sha256(self.digest.text(codes[at:end])).hexdigest() if len(a) else ""
            rows.append((len(a), len(b), int(group_end - group_at), int(links[group_end] - links[group_at]), written))
            pairs.append((key[pair_at:pair_end], often[pair_at:pair_end]))
            at, group_at, pair_at = end, group_end, pair_end
        return rows, pairs


#: The aligner of this Python worker, which Spark keeps from task to task.
_aligners: dict[str, Aligner] = {}


def aligner(key: str, content: tuple[str, bytes, str]) -> Aligner:
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*content)
    return _aligners[key]


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_PASS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string()), ("n_pairs", pa.int32()), ("places", pa.binary()), ("often", pa.binary()), ("held", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32()))]
)
_PASS_DDL = "chunk long, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, places binary, often binary, held array<long>, holders array<int>"


def narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()))).tobytes() if len(numbers) else b""


def widen(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


class Chunk:
    """Documents of one task, up to ``CHUNK_BYTES`` of text or one document."""

    def __init__(self) -> None:
        self.size = 0
        self.ids: list[pa.Array] = []
        self.rows: list[tuple] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: pa.Array, rows: list[tuple], pairs: list[tuple[np.ndarray, np.ndarray]], size: int) -> None:
        self.ids.append(ids)
        self.rows += rows
        self.pairs += pairs
        self.size += size

    def written(self, name: int) -> Iterator[pa.RecordBatch]:
        """Its documents, whose pairs are named by their places among the chunk's; and the chunk's pairs with their holders."""
        held, holders = np.unique(np.concatenate([p for p, _ in self.pairs]), return_counts=True)
        places = [narrow(np.diff(np.searchsorted(held, p), prepend=0)) for p, _ in self.pairs]
        n, none = len(self.rows), [None] * len(self.rows)
        ids = pa.concat_arrays(self.ids)
        schema = _PASS.set(1, pa.field("doc_id", ids.type))
        columns = [[name] * n, ids, *zip(*self.rows, strict=True), [len(p) for p, _ in self.pairs], places, [narrow(o) for _, o in self.pairs], none, none]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
        last = [[name], *[[None]] * 9, [held.view(np.int64)], [holders.astype(np.int32)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(last, schema.types, strict=True)], schema=schema)


def _aligned(docs: DataFrame, a_file: str, b_file: str, pattern: str, chunk_bytes: int) -> DataFrame:
    """Rows of documents with ``places`` and ``often`` of their pairs, and for every chunk one row with ``held`` and ``holders``."""
    spark = docs.sparkSession
    with open(a_file) as a, open(b_file, "rb") as b:
        content = a.read(), b.read(), pattern
    sent = spark.sparkContext.broadcast(content)
    name = hashlib.sha256(content[0].encode() + content[1] + pattern.encode()).hexdigest()
    id_type = dict(docs.dtypes)["doc_id"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(name, sent.value)
        chunk, place = Chunk(), None
        for batch in batches:
            if place is None and batch.num_rows:
                place = batch["place"][0].as_py()
            texts = [t.as_py() for t in batch["text"]]
            start = 0
            while start < len(texts):
                # a stretch of texts of bounded length is aligned at once
                end, taken = start, 0
                while end < len(texts) and (end == start or taken + len(texts[end] or "") <= chunk_bytes // 8):
                    taken += len(texts[end] or "")
                    end += 1
                chunk.add(batch["doc_id"].slice(start, end - start), *both.align(texts[start:end]), taken)
                start = end
                if chunk.size >= chunk_bytes:
                    yield from chunk.written(place)
                    chunk, place = Chunk(), place + 1
        if chunk.rows:
            yield from chunk.written(place)

    # a chunk's name: the task's number in the high bits, the chunk's in the task in the low ones
    placed = docs.select("doc_id", "text", F.shiftleft(F.spark_partition_id().cast("long"), 32).alias("place"))
    return placed.mapInArrow(aligned, _PASS_DDL.format(id_type))


def _scored(rows: DataFrame, counts: DataFrame, id_type: str) -> DataFrame:
    """Documents with ``n_best`` and ``count_sum``, from the counts of their chunk's pairs."""
    names = ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"]

    def scored(key: tuple[pa.Scalar, ...], docs: pa.Table, known: pa.Table) -> pa.Table:
        # the chunk's pairs came back, each once: in order they stand at their places
        order = np.argsort(known["pair"].to_numpy())
        count, best = known["count"].to_numpy()[order], known["best"].to_numpy()[order]
        n_best, count_sum = [], []
        for n, places, often in zip(*(docs[c].to_pylist() for c in ("n_pairs", "places", "often")), strict=True):
            at, times = np.cumsum(widen(places, n)), widen(often, n)
            n_best.append(int(times[best[at]].sum()) if n else 0)
            count_sum.append(int((times * count[at]).sum()) if n else 0)
        columns = [docs["doc_id"], *[docs[c] for c in _COUNTS], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), docs["groups_sha256"]]
        return pa.table(columns, names)

    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(scored, schema)


def pair_counts(held: DataFrame) -> DataFrame:
    """``pair, count, best`` from ``held(chunk, pair, holders)``: documents a pair, and whether no pair of its A id has more."""
    counts = held.groupBy("pair").agg(F.sum("holders").alias("count"))
    counts = materialize(counts.withColumn("a", F.shiftright("pair", 32)), "align-counts")
    # ids that are as frequent as words have many pairs; each task first takes the highest of its own
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    return counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align_documents(docs: DataFrame, a_file: str, b_file: str, pattern: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs(doc_id, text)``.

    ``a_file`` is a byte-level BPE file, ``pattern`` splits its texts; ``b_file`` is a
    model of pieces with byte fallback.  ``chunk_bytes`` changes the work, not the
    result.
    """
    spark: SparkSession = docs.sparkSession
    text_batches(spark)
    id_type = dict(docs.dtypes)["doc_id"]
    done = materialize(_aligned(docs, a_file, b_file, pattern, chunk_bytes), "align-rows")
    held = done.where(F.col("held").isNotNull())
    held = held.select("chunk", F.explode(F.arrays_zip("held", "holders")).alias("x")).select("chunk", F.col("x.held").alias("pair"), F.col("x.holders").alias("holders"))
    counts, path = write_shared(pair_counts(held), "align-pairs")
    answers = materialize(held.select("chunk", "pair").join(counts, "pair"), "align-answers")
    forget(spark, path)
    return _scored(done.where(F.col("held").isNull()).drop("held", "holders"), answers, id_type)
