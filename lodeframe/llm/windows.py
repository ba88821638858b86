"""Hashes of word windows, and count-min sketches of them merged over blocks.

A window's hash is a polynomial in its words' 64-bit hashes, computed for a whole
block of documents at once.  A sketch has ``DEPTH`` rows of cells, as many cells
as the data needs, cut into slices:

1. ``partial_sketches``: every block of documents sends, slice by slice, the cells
   that its windows touch and which of them it touched more than once, Rice-coded;
2. ``merged_answers``: a task adds up one slice over all blocks and sends to each
   block the merged counts of the cells that it asked for;
3. ``Answers``: the block looks its windows up.  A window's estimate is the least
   of its counts in the rows.

A block that sends every slice a row makes blocks times slices rows, which grow with
the square of the data.  Beyond ``DIRECT_ROWS`` of them the way has two levels
(``_two_levels``): blocks send to groups of slices, a task adds up what the blocks of
one super-block send to one group, and only these sums go to the slices, one row a
super-block and slice; answers come back the same way.  So rows follow the windows
(``Sizes.rows_sent``, ``Sizes.bytes_sent``).

Counts are never too low, so a window that occurs twice anywhere is estimated
repeated.  Nothing is collected by the driver or broadcast.  Width follows the
data without bound, so the share of single windows that pass stays the same at
every size (``pass_rate``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
DEPTH = 2
CELLS_PER_WINDOW = 4
#: Windows that a slice serves about, and bytes of text that a block holds about, for small and for large inputs.
SLICE_WINDOWS = (2**20, 2**22)
BLOCK_BYTES = (2**23, 2**25)
#: Slices, and blocks, up to which the small figure is used; slices at least.
MANY, LEAST_SLICES = 4096, 16
#: Rows from blocks to slices up to which they are sent directly, and blocks of a super-block.
DIRECT_ROWS, SUPER = 2**26, 1024
BYTES_PER_WORD = 6


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space (space, and 9 to 13)."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, data.split()), dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_hashes(ids: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` ids, by doubling."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, run, width = MULTIPLIERS[which], ids, 1
    out: np.ndarray | None = None
    done, left = 0, size
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                part = run[done : done + n]
                out = part.copy() if out is None else out * power + part
                done += width
            left >>= 1
            if left:
                run = run[: len(run) - width] * power + run[width:]
                power, width = power * power, width * 2
        assert out is not None
        return mixed(out)


# --- packed numbers ---------------------------------------------------------------------------------------------


def pack(sorted_numbers: np.ndarray) -> bytes:
    """Numbers in rising order as Rice-coded steps: count, low bits a step, unary highs, lows."""
    n = len(sorted_numbers)
    if not n:
        return b""
    steps = np.diff(sorted_numbers.astype(np.int64), prepend=0)
    low = max(0, int(sorted_numbers[-1]) // n).bit_length() - 1
    low = max(0, low)
    ends = np.cumsum((steps >> low) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    highs = np.packbits(unary).tobytes()
    head = n.to_bytes(4, "little") + bytes([low]) + len(highs).to_bytes(4, "little")
    lows = ((steps[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    return head + highs + np.packbits(lows.ravel()).tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    n, low, size = int.from_bytes(data[:4], "little"), data[4], int.from_bytes(data[5:9], "little")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, 9)))[:n]
    steps = (np.diff(ends, prepend=-1) - 1) << low
    if low:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=9 + size))[: n * low].reshape(n, low)
        steps += bits @ (1 << np.arange(low))
    return np.cumsum(steps)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8))[:n].astype(bool)


def level(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes that rise with them: themselves below 64, eighths of a doubling beyond."""
    large = 64 + 8 * np.log2(np.maximum(counts, 64) / 64)
    return np.where(counts < 64, counts, np.minimum(large, 255)).astype(np.uint8)


# --- sizes ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sizes:
    """Blocks of documents, and the sketch's slices and cells a slice.  Speed and memory depend on them, results don't."""

    windows: int
    blocks: int
    slices: int
    slice_cells: int
    #: slices of a group, and blocks of a super-block, where the way has two levels; else 1 and 0
    span: int = 1
    super_blocks: int = 0

    @classmethod
    def of(cls, docs: DataFrame, cells_per_window: float = CELLS_PER_WINDOW) -> Sizes:
        """For ``docs`` with the binary column ``data``."""
        size = docs.agg(F.sum(F.octet_length("data"))).first()[0] or 0
        return cls.for_bytes(size, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells_per_window)

    @classmethod
    def for_bytes(cls, size: int, partitions: int, cells_per_window: float = CELLS_PER_WINDOW) -> Sizes:
        """Blocks keep all ``partitions`` busy; slices follow the data alone, since each block sends each slice a row."""
        windows = size // BYTES_PER_WORD + 1
        pieces = lambda n, steps, least: max(least, min(-(-n // steps[0]), MANY), -(-n // steps[1]))
        slices = pieces(windows, SLICE_WINDOWS, LEAST_SLICES)
        sizes = cls(windows, pieces(size, BLOCK_BYTES, partitions), slices, max(8, math.ceil(windows * cells_per_window / slices)))
        return sizes.two_levels(math.isqrt(slices) + 1, SUPER) if sizes.blocks * slices > DIRECT_ROWS else sizes

    def two_levels(self, span: int, super_blocks: int) -> Sizes:
        return replace(self, span=span, super_blocks=super_blocks)

    @property
    def piece_cells(self) -> int:
        """Cells of what a block sends in one row: a slice, or a group of them."""
        return self.span * self.slice_cells

    @property
    def rows_sent(self) -> int:
        """Rows of the sketch on the way to the slices, at most."""
        if not self.super_blocks:
            return DEPTH * self.blocks * self.slices
        return DEPTH * (self.blocks * -(-self.slices // self.span) + -(-self.blocks // self.super_blocks) * self.slices)

    @property
    def bytes_sent(self) -> float:
        """About what the sketch shuffles both ways, where all windows are different: steps between a sender's cells in Rice code, a bit and a half each for counts and answers, 48 bytes a row."""
        cells = self.slices * self.slice_cells
        bits = lambda senders: math.log2(max(1.0, cells * senders / self.windows)) + 2 + 1.5
        levels = [self.blocks] + ([-(-self.blocks // self.super_blocks)] if self.super_blocks else [])
        return sum(DEPTH * self.windows * bits(n) / 8 for n in levels) + 2 * 48 * self.rows_sent

    @property
    def pass_rate(self) -> float:
        """Expected share of the windows that occur once and are estimated repeated."""
        return (1 - math.exp(-self.windows / (self.slices * self.slice_cells))) ** DEPTH

    def cells(self, h: np.ndarray) -> Iterator[np.ndarray]:
        """Each hash's cell in each row: the slice from its high bits, the cell in it from its low ones."""
        for _ in range(DEPTH):
            part = ((h >> np.uint64(40)) * np.uint64(self.slices)) >> np.uint64(24)
            yield part * np.uint64(self.slice_cells) + (((h & np.uint64(0xFFFFFFFF)) * np.uint64(self.slice_cells)) >> np.uint64(32))
            h = mixed(h + MULTIPLIERS[0])


def block_number(blocks: int, *columns: Column | str) -> Column:
    """The block of a row: by its id, or by its text where it has none, so no id holds a block together that it doesn't name."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


# --- the sketch -------------------------------------------------------------------------------------------------

Hashes = Callable[[pa.Table], np.ndarray]
PARTIAL_DDL = "row_no int, slice_no int, block int, cells binary, twice binary"
ANSWER_DDL = "row_no int, slice_no int, block int, repeated binary, levels binary"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32()] * 3 + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def partial_sketches(blocked: DataFrame, hashes: Hashes, sizes: Sizes) -> DataFrame:
    """Each block's cells by row and slice (or group of slices), of ``blocked`` with a column ``block``."""

    def partial(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block, rows = key[0].as_py(), []
        for row, cells in enumerate(sizes.cells(hashes(table))):
            cells.sort()
            first = np.ones(len(cells), bool)
            first[1:] = cells[1:] != cells[:-1]
            starts = np.flatnonzero(first)
            once = cells[starts]
            twice = np.diff(starts, append=len(cells)) > 1
            part = (once // np.uint64(sizes.piece_cells)).astype(np.int64)
            for k, a, b in runs(part):
                rows.append((row, k, block, pack(once[a:b] - np.uint64(k * sizes.piece_cells)), pack_bits(twice[a:b])))
        return pa.Table.from_batches([_batch(rows, ["row_no", "slice_no", "block", "cells", "twice"])])

    return blocked.groupBy("block").applyInArrow(partial, PARTIAL_DDL)


def runs(sorted_numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value with the places where its run begins and ends."""
    if len(sorted_numbers):
        starts = np.flatnonzero(np.diff(sorted_numbers, prepend=sorted_numbers[0] - 1))
        for a, b in zip(starts, np.append(starts[1:], len(sorted_numbers)), strict=True):
            yield int(sorted_numbers[a]), int(a), int(b)


def merged_answers(partials: DataFrame, sizes: Sizes) -> DataFrame:
    """The merged counts, for each block those of its own cells: which are over one, and the levels of these."""
    names = ["row_no", "slice_no", "block", "repeated", "levels"]

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(sizes.slice_cells, np.uint32)
        asked: list[tuple[int, bytes]] = []
        for batch in batches:
            for block, cells, twice in zip(batch["block"], batch["cells"], batch["twice"], strict=True):
                asked.append((block.as_py(), cells.as_py()))
                at = unpack(asked[-1][1])
                counts[at] += 1 + unpack_bits(twice.as_py(), len(at)).astype(np.uint32)
        rows = []
        for block, cells in asked:
            found = level(counts[unpack(cells)])
            rows.append((key[0].as_py(), key[1].as_py(), block, pack_bits(found > 1), found[found > 1].tobytes()))
            if len(rows) == MANY:
                yield _batch(rows, names)
                rows = []
        yield _batch(rows, names)

    return partials.groupBy("row_no", "slice_no").applyInArrow(merge, ANSWER_DDL)


SUM_DDL = "row_no int, slice_no int, super_block int, cells binary, above binary, counts binary"
BACK_DDL = "row_no int, group_no int, super_block int, slice_no int, repeated binary, levels binary"


def _summed(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order, and the sums of their counts."""
    every = np.concatenate(cells) if cells else np.zeros(0, np.int64)
    own, back = np.unique(every, return_inverse=True)
    return own, np.bincount(back, np.concatenate(counts) if counts else None, len(own)).astype(np.int64)


def _two_levels(partials: DataFrame, sizes: Sizes) -> DataFrame:
    """What ``merged_answers`` gives, where blocks have sent to groups of slices: sums of super-blocks go to the slices and answers come back through them.

    ``partials`` is read twice and should be a written table.
    """
    placed = partials.withColumn("super_block", F.floor(F.col("block") / sizes.super_blocks).cast("int"))

    def add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts = [], []
        for batch in batches:
            for own, twice in zip(batch["cells"], batch["twice"], strict=True):
                at = unpack(own.as_py())
                cells.append(at)
                counts.append(1 + unpack_bits(twice.as_py(), len(at)).astype(np.int64))
        own, total = _summed(cells, counts)
        rows = []
        for k, a, b in runs(own // sizes.slice_cells):
            above = total[a:b] > 1
            rows.append((key[0].as_py(), key[1].as_py() * sizes.span + k, key[2].as_py(), pack(own[a:b] - k * sizes.slice_cells), pack_bits(above), total[a:b][above].astype(np.uint32).tobytes()))
        names = ["row_no", "slice_no", "super_block", "cells", "above", "counts"]
        types = [pa.int32()] * 3 + [pa.binary()] * 3
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(sizes.slice_cells, np.uint32)
        asked: list[tuple[int, bytes]] = []
        for batch in batches:
            for sender, cells, above, more in zip(*(batch[c].to_pylist() for c in ("super_block", "cells", "above", "counts")), strict=True):
                at = unpack(cells)
                own = np.ones(len(at), np.uint32)
                own[unpack_bits(above, len(at))] = np.frombuffer(more, np.uint32)
                counts[at] += own
                asked.append((sender, cells))
        rows = []
        for sender, cells in asked:
            found = level(counts[unpack(cells)])
            rows.append((key[0].as_py(), key[1].as_py() // sizes.span, sender, key[1].as_py(), pack_bits(found > 1), found[found > 1].tobytes()))
        names = ["row_no", "group_no", "super_block", "slice_no", "repeated", "levels"]
        types = [pa.int32()] * 4 + [pa.binary()] * 2
        for a in range(0, len(rows), MANY):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[a : a + MANY]], t) for k, t in enumerate(types)], names)

    def hand_on(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        asked = [(block.as_py(), unpack(cells.as_py())) for block, cells in zip(left["block"], left["cells"], strict=True)]
        own = np.unique(np.concatenate([at for _, at in asked])) if asked else np.zeros(0, np.int64)
        found = np.ones(len(own), np.uint8)
        back = {k: (bits, levels) for k, bits, levels in zip(*(right[c].to_pylist() for c in ("slice_no", "repeated", "levels")), strict=True)}
        for k, a, b in runs(own // sizes.slice_cells):
            bits, levels = back[key[1].as_py() * sizes.span + k]
            piece = found[a:b]
            piece[unpack_bits(bits, b - a)] = np.frombuffer(levels, np.uint8)
        rows = []
        for block, at in asked:
            mine = found[np.searchsorted(own, at)]
            rows.append((key[0].as_py(), key[1].as_py(), block, pack_bits(mine > 1), mine[mine > 1].tobytes()))
        return pa.Table.from_batches([_batch(rows, ["row_no", "slice_no", "block", "repeated", "levels"])])

    by = ["row_no", "slice_no", "super_block"]
    sums = placed.groupBy(*by).applyInArrow(add_up, SUM_DDL)
    back = sums.groupBy("row_no", "slice_no").applyInArrow(merge, BACK_DDL)
    return placed.groupBy(*by).cogroup(back.groupBy("row_no", "group_no", "super_block")).applyInArrow(hand_on, ANSWER_DDL)


def block_answers(blocked: DataFrame, hashes: Hashes, sizes: Sizes) -> DataFrame:
    """What ``Answers`` reads of the merged sketch, for each block of ``blocked``."""
    partials = partial_sketches(blocked, hashes, sizes)
    if not sizes.super_blocks:
        return merged_answers(partials, sizes)
    return _two_levels(materialize(partials, "sketch"), sizes)


class Answers:
    """One block's windows with their estimated counts."""

    def __init__(self, table: pa.Table, sizes: Sizes):
        self.sizes = sizes
        self.pieces = {(r, k): (b, x) for r, k, b, x in zip(*[table[c].to_pylist() for c in ("row_no", "slice_no", "repeated", "levels")], strict=True)}

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each window's estimate (``level``); ``h`` must be the hashes that the block sketched."""
        least = np.full(len(h), 255, np.uint8)
        for row, cells in enumerate(self.sizes.cells(h)):
            own, back = np.unique(cells, return_inverse=True)
            found = np.ones(len(own), np.uint8)
            for k, a, b in runs((own // np.uint64(self.sizes.piece_cells)).astype(np.int64)):
                bits, levels = self.pieces[row, k]
                piece = found[a:b]
                piece[unpack_bits(bits, b - a)] = np.frombuffer(levels, np.uint8)
            np.minimum(least, found[back], out=least)
        return least


def concatenated(parts: Iterable[np.ndarray]) -> np.ndarray:
    held = list(parts)
    return np.concatenate(held) if held else np.zeros(0, np.uint64)
