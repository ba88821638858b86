"""Byte-level BPE by longest matches and backtracking.

A token sequence is the one that the merges produce exactly when every two
adjacent tokens are compatible: merging their joined bytes gives back these two
tokens.  So a piece is encoded from left to right by the longest token that is
compatible with its predecessor, going back where none is.  The longest token at
every position comes from one pass of an Aho-Corasick automaton over the bytes
written as Latin-1; compatibility of a pair is found once by the merges and then
remembered.  A position that was given up is never entered again, so the work is
linear in the piece.

Defined cases: a null or empty text has no ids and decodes to no bytes; texts of
any length are encoded whole; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .storage import text_batches

#: Entries that the piece and the pair memory hold before they are emptied.
PIECES, PAIRS = 300_000, 200_000


def load_ranks(lines: Iterable[str]) -> list[bytes]:
    """Token bytes by rank, from the lines of a rank file."""
    pairs = (line.split() for line in lines if line.strip())
    by_rank = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [by_rank[i] for i in range(len(by_rank))]


class PieceMemory(dict):
    """Piece to its ids as little-endian bytes, found on first sight."""

    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.bpe.encode_piece(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids


class ByteBPE:
    def __init__(self, tokens: list[bytes], pattern: str):
        # White space is the Unicode property, which \s of this library is not for U+001C to U+001F
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.tokens = tokens
        self.sizes = [len(token) for token in tokens]
        self.ranks = {token: rank for rank, token in enumerate(tokens)}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            if self.merge(token) == [rank]:  # tokens that no merge reaches are never used
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        self.memory = PieceMemory(self)

    def merge(self, data: bytes) -> list[int]:
        """The merges by rank, for tokens and pairs of tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == len(ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def next_shorter(self, rank: int) -> int:
        """The longest reachable token that is a proper prefix, or -1."""
        known = self.shorter.get(rank)
        if known is None:
            token, known = self.tokens[rank].decode("latin-1"), -1
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in self.automaton:
                    known = self.automaton.get(token[:n])
                    break
            self.shorter[rank] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, sizes, pairs, longest = len(data), self.sizes, self.pairs, [-1] * len(data)
        for end, rank in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - sizes[rank]] = rank  # of one start, the longest match ends last
        out: list[int] = []
        open_at = bytearray(b"\x01") * (n + 1)
        at, last, rank = 0, -1, longest[0] if n else -1
        while at < n:
            while rank >= 0:
                if open_at[at + sizes[rank]]:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | rank)
                    if self.compatible(last, rank) if fits is None else fits:
                        break
                rank = self.next_shorter(rank)
            if rank >= 0:
                out.append(rank)
                at += sizes[rank]
                last, rank = rank, longest[at] if at < n else -1
            else:
                # nothing fits here after this predecessor: give the position up and shorten the predecessor
                if not out:
                    raise ValueError("bytes without a token")
                open_at[at] = 0
                rank = out.pop()
                at -= sizes[rank]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memory.__getitem__, self.pieces.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


#: Encoders of this Python worker, which Spark keeps from task to task.
_encoders: dict[str, ByteBPE] = {}


def encoder(key: str, lines: list[str], pattern: str) -> ByteBPE:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ByteBPE(load_ranks(lines), pattern)
    return _encoders[key]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` encoded and decoded again.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with
    ``keep_ids``, ``ids`` (array of int).  The rank file is read on the
    driver; its lines, whose number is that of the vocabulary, are broadcast.
    """
    spark: SparkSession = docs.sparkSession
    text_batches(spark)
    with open(rank_file) as file:
        lines = list(file)
    sent = spark.sparkContext.broadcast(lines)
    key = hashlib.sha256("".join([*lines, pattern]).encode()).hexdigest()
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(key, sent.value, pattern)
        for batch in batches:
            counts, id_hashes, text_hashes, ids = [], [], [], []
            for text in batch["text"]:
                packed = bpe.encode(text.as_py() or "")
                counts.append(len(packed) // 4)
                id_hashes.append(hashlib.sha256(packed).hexdigest())
                text_hashes.append(hashlib.sha256(bpe.decode(packed)).hexdigest())
                if keep_ids:
                    ids.append(array("I", packed).tolist())
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(encoded, schema)
