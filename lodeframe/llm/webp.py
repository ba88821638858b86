"""Lossless WebP: a decoder and an encoder for the VP8L bit stream, over numpy arrays.

Decoding reads the prefix codes, undoes back-references and the colour cache, and
inverts the transforms (predictor, cross-colour, subtract-green, palette with
bundled pixels) in reverse order; the result is an array of pixels.

Streams with one group of prefix codes are decoded in arrays where they hold a
colour cache or copies from further back than one pixel, but not both: every bit
position is looked up at once, the chain of token starts is followed, colour cache
hits are filled from the last literal of their cell, and copies are made slice by
slice.  Any other stream is decoded token by token.  The encoder writes what
either way reads; its options choose transforms, cache and copies, and
``encode_smallest`` takes the options that need the fewest bits.
"""

from __future__ import annotations

import heapq
import math
import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, lru_cache

import numpy as np

PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
LITERAL, COPY, CACHED = range(3)
LENGTH_CODES, DISTANCE_CODES, MAX_SIDE = 24, 40, 16384
#: Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
CACHE_MULTIPLIER = 0x1E35A7BD
#: Places near a pixel, nearest first, that short distance codes stand for.
NEAR = sorted(
    ((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0),
    key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]),
)


# --- bits -------------------------------------------------------------------------------------------------------


class BitReader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def peek(self, n: int) -> int:
        first = self.at >> 3
        return (int.from_bytes(self.data[first : first + 5], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        value = self.peek(n)
        self.at += n
        return value


class BitWriter:
    """Collects codes and their lengths; arrays are appended whole."""

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def write(self, value: int, n: int) -> None:
        self.extend(np.array([value], np.uint32), np.array([n], np.int64))

    def extend(self, codes: np.ndarray, lengths: np.ndarray) -> None:
        self.codes.append(codes.astype(np.uint32, copy=False))
        self.lengths.append(lengths.astype(np.int64, copy=False))

    def bits(self) -> np.ndarray:
        codes, lengths = np.concatenate(self.codes), np.concatenate(self.lengths)
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        return (np.repeat(codes, lengths) >> place.astype(np.uint32)).astype(np.uint8) & 1


# --- prefix codes -----------------------------------------------------------------------------------------------


def code_lengths(counts: Sequence[int], longest: int) -> list[int]:
    """Huffman code lengths of at most ``longest`` bits; counts are flattened until they fit."""
    used = [k for k, c in enumerate(counts) if c]
    out = [0] * len(counts)
    if len(used) <= 1:
        return out
    weights = {k: counts[k] for k in used}
    while True:
        heap: list[tuple[int, int, tuple[int, ...]]] = [(w, k, (k,)) for k, w in weights.items()]
        heapq.heapify(heap)
        depth = dict.fromkeys(used, 0)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for k in a[2] + b[2]:
                depth[k] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= longest:
            for k, d in depth.items():
                out[k] = d
            return out
        weights = {k: (w + 1) // 2 + 1 for k, w in weights.items()}


def canonical(lengths: Sequence[int]) -> np.ndarray:
    """Codes as they stand in the stream, lowest bit first."""
    codes = np.zeros(len(lengths), np.uint32)
    code = 0
    for n in range(1, 16):
        for k, length in enumerate(lengths):
            if length == n:
                codes[k] = int(f"{code:0{n}b}"[::-1], 2)
                code += 1
        code <<= 1
    return codes


@dataclass(frozen=True)
class PrefixCode:
    """Symbol and length for every window of ``bits`` bits."""

    bits: int
    symbols: np.ndarray
    lengths: np.ndarray

    @cached_property
    def kinds(self) -> np.ndarray:
        """What each symbol of the green code is: a literal, a copy or a colour of the cache."""
        return ((self.symbols >= 256).astype(np.uint8) + (self.symbols >= 256 + LENGTH_CODES)).astype(np.uint8)

    @classmethod
    def of(cls, lengths: Sequence[int], only: int = 0) -> PrefixCode:
        """``only`` is the symbol of a code without bits."""
        bits = max(lengths, default=0)
        symbols, sizes = np.full(1 << bits, only, np.int32), np.zeros(1 << bits, np.uint8)
        if bits:
            for k, (code, n) in enumerate(zip(canonical(lengths), lengths, strict=True)):
                if n:
                    symbols[int(code) :: 1 << n] = k
                    sizes[int(code) :: 1 << n] = n
        return cls(bits, symbols, sizes)

    def read(self, bits: BitReader) -> int:
        window = bits.peek(self.bits)
        bits.at += int(self.lengths[window])
        return int(self.symbols[window])


def read_prefix_code(bits: BitReader, size: int) -> PrefixCode:
    if bits.read(1):  # one or two symbols
        two, wide = bits.read(1), bits.read(1)
        first = bits.read(8 if wide else 1)
        if not two:
            return PrefixCode.of([0] * size, first)
        lengths = [0] * size
        lengths[first] = lengths[bits.read(8)] = 1
        return PrefixCode.of(lengths)
    of_lengths = [0] * 19
    for k in range(4 + bits.read(4)):
        of_lengths[CODE_LENGTH_ORDER[k]] = bits.read(3)
    used = [k for k, n in enumerate(of_lengths) if n]
    coder = PrefixCode.of([0] * 19, used[0]) if len(used) == 1 else PrefixCode.of(of_lengths)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    lengths, before = [], 8
    while len(lengths) < size and left:
        left -= 1
        symbol = coder.read(bits)
        if symbol < 16:
            lengths.append(symbol)
            before = symbol or before
        elif symbol == 16:
            lengths += [before] * (3 + bits.read(2))
        else:
            lengths += [0] * (3 + bits.read(3) if symbol == 17 else 11 + bits.read(7))
    lengths = (lengths + [0] * size)[:size]
    used = [k for k, n in enumerate(lengths) if n]
    return PrefixCode.of([0] * size, used[0]) if len(used) == 1 else PrefixCode.of(lengths)


def write_prefix_code(out: BitWriter, lengths: Sequence[int], only: int = 0) -> None:
    used = [k for k, n in enumerate(lengths) if n]
    if not used and only < 256:
        for value, n in ((1, 1), (0, 1), (1, 1), (only, 8)):
            out.write(value, n)
        return
    if len(used) == 2 and used[1] < 256:
        for value, n in ((1, 1), (1, 1), (1, 1), (used[0], 8), (used[1], 8)):
            out.write(value, n)
        return
    if not used:
        lengths = [int(k == only) for k in range(len(lengths))]
    runs: list[tuple[int, int, int]] = []  # symbol, extra, extra bits
    k, before = 0, 8
    while k < len(lengths):
        n = 1
        while k + n < len(lengths) and lengths[k + n] == lengths[k]:
            n += 1
        if lengths[k] == 0 and n >= 3:
            n = min(n, 138)
            runs.append((17, n - 3, 3) if n <= 10 else (18, n - 11, 7))
        elif lengths[k] and lengths[k] == before and n >= 3:
            n = min(n, 6)
            runs.append((16, n - 3, 2))
        else:
            n = 1
            runs.append((lengths[k], 0, 0))
            before = lengths[k] or before
        k += n
    counts = [0] * 19
    for symbol, _, _ in runs:
        counts[symbol] += 1
    of_lengths = code_lengths(counts, 7)
    written = of_lengths if any(of_lengths) else [int(c > 0) for c in counts]
    codes = canonical(of_lengths)
    shown = max(4, 1 + max(i for i, s in enumerate(CODE_LENGTH_ORDER) if written[s]))
    out.write(0, 1)
    out.write(shown - 4, 4)
    for symbol in CODE_LENGTH_ORDER[:shown]:
        out.write(written[symbol], 3)
    out.write(0, 1)  # all symbols follow
    for symbol, extra, n in runs:
        out.write(int(codes[symbol]), of_lengths[symbol])
        if n:
            out.write(extra, n)


def value_prefix(value: int) -> tuple[int, int, int]:
    """Prefix symbol, extra bits' value and number for a length or distance from 1."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    second = (v >> (top - 1)) & 1
    return 2 * top + second, v & ((1 << (top - 1)) - 1), top - 1


def read_value(bits: BitReader, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.read(n) + 1


def cache_index(argb: np.ndarray, bits: int) -> np.ndarray:
    return ((argb.astype(np.uint64) * np.uint64(CACHE_MULTIPLIER)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - bits)


# --- entropy-coded pixels ---------------------------------------------------------------------------------------


def read_group(bits: BitReader, cache_bits: int) -> list[PrefixCode]:
    green = 256 + LENGTH_CODES + ((1 << cache_bits) if cache_bits else 0)
    codes = [read_prefix_code(bits, n) for n in (green, 256, 256, 256, DISTANCE_CODES)]
    # equal codes of red, blue and alpha are one, so they are looked up once
    for k in (2, 3):
        same = next((c for c in codes[1:k] if np.array_equal(c.symbols, codes[k].symbols) and np.array_equal(c.lengths, codes[k].lengths)), None)
        codes[k] = same or codes[k]
    return codes


#: Groups by the bits that they were read from; streams of one encoder share them.
_groups: dict[tuple[int, int], tuple[int, list[PrefixCode]]] = {}


def shared_group(bits: BitReader, cache_bits: int) -> list[PrefixCode]:
    """A group that was read before from the same bits, or a new one."""

    def here(n: int) -> int:
        first, offset = bits.at >> 3, bits.at & 7
        return (int.from_bytes(bits.data[first : first + (offset + n + 7 >> 3)], "little") >> offset) & ((1 << n) - 1)

    for (cached, n), (value, group) in _groups.items():
        if cached == cache_bits and here(n) == value:
            bits.at += n
            return group
    began = bits.at
    group = read_group(bits, cache_bits)
    n = bits.at - began
    if len(_groups) < 8:
        bits.at = began
        _groups.setdefault((cache_bits, n), (here(n), group))
        bits.at = began + n
    return group


def far_back(code: int, width: int) -> int:
    """How many pixels back a distance code reaches."""
    if code > len(NEAR):
        return code - len(NEAR)
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


def decode_in_arrays(bits: BitReader, group: list[PrefixCode], cache_bits: int, total: int, width: int) -> np.ndarray | None:
    """Pixels, or None where a colour cache meets a copy from further back than one pixel."""
    green, red, blue, alpha, distance = group
    if not green.bits:
        return None  # tokens without bits are read one by one
    raw = np.frombuffer(bits.data[bits.at >> 3 :] + bytes(8), np.uint8).astype(np.uint32)
    words = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
    windows = np.empty((len(words), 8), np.uint16)  # a code has 15 bits at most
    for k in range(8):
        windows[:, k] = (words >> np.uint32(k)).astype(np.uint16)
    windows = windows.ravel()
    look = lambda code: windows & np.uint16((1 << code.bits) - 1)
    g = look(green)
    kind, step = green.kinds[g], green.lengths[g]
    here = np.arange(len(windows), dtype=np.int32)
    ends = here + step
    limit = np.int32(len(windows) - 1)
    places = []
    widths: dict[int, np.ndarray] = {}
    for code in (red, blue, alpha):
        np.minimum(ends, limit, out=ends)
        places.append(ends)
        if code.bits and id(code) not in widths:
            widths[id(code)] = code.lengths[look(code)]
        ends = ends + widths[id(code)][ends] if code.bits else ends.copy()
    # four codes have 60 bits at most, so 255 is free for copies
    step = np.where(kind == LITERAL, (ends - here).astype(np.uint8), step)
    step[kind == COPY] = 255
    follow = step.tobytes()
    at, made, starts, repeats = bits.at & 7, 0, [], []
    add = starts.append
    while made < total:
        n = follow[at]
        if n != 255:
            add(at)
            made += 1
            at += n
            continue
        reader = BitReader(bits.data)
        reader.at = (bits.at & ~7) + at
        length = read_value(reader, green.read(reader) - 256)
        back = far_back(read_value(reader, distance.read(reader)), width)
        if back > made or (cache_bits and back != 1):
            return None
        repeats.append((len(starts), length, back))
        made += length
        at = reader.at - (bits.at & ~7)
    tokens = np.array(starts, np.int64)
    symbol = green.symbols[g[tokens]].astype(np.uint32)
    is_literal = symbol < 256
    parts = [code.symbols[look_at & np.uint16((1 << code.bits) - 1)].astype(np.uint32) for code, look_at in zip((red, blue, alpha), (windows[p[tokens]] for p in places), strict=True)]
    pixels = parts[2] << np.uint32(24) | parts[0] << np.uint32(16) | symbol << np.uint32(8) | parts[1]
    if cache_bits and not is_literal.all():
        cell = np.where(is_literal, cache_index(pixels, cache_bits).astype(np.int64), symbol.astype(np.int64) - 256 - LENGTH_CODES)
        order = np.argsort(cell, kind="stable")
        opens = np.ones(len(order), bool)
        opens[1:] = cell[order][1:] != cell[order][:-1]
        rank = np.arange(len(order))
        source = np.maximum.accumulate(np.where(is_literal[order] | opens, rank, 0))
        filled = pixels[order][source]
        # a hit on a cell that nothing was put into reads the initial zero
        filled[~is_literal[order][source]] = 0
        pixels[order] = filled
    if repeats:
        pixels = with_copies(pixels, repeats)
    bits.at = (bits.at & ~7) + at
    return pixels[:total]


def with_copies(literals: np.ndarray, copies: list[tuple[int, int, int]]) -> np.ndarray:
    """Pixels of literals and ``(literals before, length, back)`` copies between them."""
    out = np.empty(len(literals) + sum(n for _, n, _ in copies), np.uint32)
    taken = at = 0
    for before, length, back in copies:
        out[at : at + before - taken] = literals[taken:before]
        at += before - taken
        taken = before
        source = out[at - back : at]
        out[at : at + length] = source[:length] if back >= length else np.resize(source, length)
        at += length
    out[at:] = literals[taken:]
    return out


def decode_one_by_one(bits: BitReader, group_of: Callable[[int], list[PrefixCode]], cache_bits: int, width: int, total: int) -> np.ndarray:
    pixels = [0] * total
    cache = [0] * (1 << cache_bits) if cache_bits else []
    filled = 0  # pixels that the cache has taken
    at = 0
    while at < total:
        green, red, blue, alpha, distance = group_of(at)
        symbol = green.read(bits)
        if symbol < 256:
            r, b, a = red.read(bits), blue.read(bits), alpha.read(bits)
            pixels[at] = a << 24 | r << 16 | symbol << 8 | b
            at += 1
        elif symbol < 256 + LENGTH_CODES:
            length = read_value(bits, symbol - 256)
            back = far_back(read_value(bits, distance.read(bits)), width)
            for k in range(at, min(total, at + length)):
                pixels[k] = pixels[k - back]
            at = min(total, at + length)
        else:
            while filled < at:
                cache[(pixels[filled] * CACHE_MULTIPLIER & 0xFFFFFFFF) >> (32 - cache_bits)] = pixels[filled]
                filled += 1
            pixels[at] = cache[symbol - 256 - LENGTH_CODES]
            at += 1
    return np.array(pixels, np.uint32)


def read_pixels(bits: BitReader, width: int, height: int, main: bool = False) -> np.ndarray:
    cache_bits = bits.read(4) if bits.read(1) else 0
    total = width * height
    if main and bits.read(1):
        tile = bits.read(3) + 2
        across = -(-width >> tile)
        numbers = (read_pixels(bits, across, -(-height >> tile)) >> np.uint32(8)) & np.uint32(0xFFFF)
        groups = [read_group(bits, cache_bits) for _ in range(int(numbers.max()) + 1)]
        group_of = lambda at: groups[int(numbers[(at // width >> tile) * across + (at % width >> tile)])]
        return decode_one_by_one(bits, group_of, cache_bits, width, total)
    group = shared_group(bits, cache_bits)
    began = bits.at
    found = decode_in_arrays(bits, group, cache_bits, total, width)
    if found is not None:
        return found
    bits.at = began
    return decode_one_by_one(bits, lambda at: group, cache_bits, width, total)


# --- transforms -------------------------------------------------------------------------------------------------


def channels(argb: np.ndarray) -> np.ndarray:
    """Four channels (alpha, red, green, blue) of the last axis."""
    return np.stack([(argb >> np.uint32(s)).astype(np.int32) & 255 for s in (24, 16, 8, 0)], axis=-1)


def joined(parts: np.ndarray) -> np.ndarray:
    p = (parts & 255).astype(np.uint32)
    return p[..., 0] << np.uint32(24) | p[..., 1] << np.uint32(16) | p[..., 2] << np.uint32(8) | p[..., 3]


def predicted(mode: np.ndarray, left: np.ndarray, top: np.ndarray, top_right: np.ndarray, top_left: np.ndarray) -> np.ndarray:
    """The prediction of each pixel by its mode, over arrays of channels."""
    half = lambda a, b: (a + b) >> 1
    clamp = lambda x: np.clip(x, 0, 255)
    mid = half(left, top)
    guess = left + top - top_left
    nearer_left = np.abs(guess - left).sum(-1, keepdims=True) < np.abs(guess - top).sum(-1, keepdims=True)
    # (a - b) / 2 rounds to zero
    diff = mid - top_left
    options = [
        np.broadcast_to(np.array([255, 0, 0, 0], np.int32), left.shape),
        left,
        top,
        top_right,
        top_left,
        half(half(left, top_right), top),
        half(left, top_left),
        mid,
        half(top_left, top),
        half(top, top_right),
        half(half(left, top_left), half(top, top_right)),
        np.where(nearer_left, left, top),
        clamp(guess),
        clamp(mid + np.sign(diff) * (np.abs(diff) >> 1)),
    ]
    # modes beyond the last stand for the first
    return np.choose(np.where(mode < len(options), mode, 0)[..., None], options)


def tiles(values: np.ndarray, width: int, height: int, tile: int) -> np.ndarray:
    return np.repeat(np.repeat(values, 1 << tile, 0), 1 << tile, 1)[:height, :width]


#: Modes that need the pixel to the left.
FROM_LEFT = np.isin(np.arange(16), (1, 5, 6, 7, 10, 11, 12, 13))
FIRST = np.array([255, 0, 0, 0], np.int32)


def one_predicted(mode: int, left: list[int], top: list[int], top_right: list[int], top_left: list[int]) -> list[int]:
    """``predicted`` for one pixel whose mode needs the left one."""
    if mode == 1:
        return left
    if mode == 11:
        nearer = sum(abs(t - c) for t, c in zip(top, top_left, strict=True)) < sum(abs(x - c) for x, c in zip(left, top_left, strict=True))
        return left if nearer else top
    out = []
    for x, t, r, c in zip(left, top, top_right, top_left, strict=True):
        if mode == 5:
            v = ((x + r >> 1) + t) >> 1
        elif mode == 6:
            v = x + c >> 1
        elif mode == 7:
            v = x + t >> 1
        elif mode == 10:
            v = ((x + c >> 1) + (t + r >> 1)) >> 1
        elif mode == 12:
            v = min(255, max(0, x + t - c))
        else:
            mid = x + t >> 1
            v = min(255, max(0, mid + int((mid - c) / 2)))
        out.append(v)
    return out


def invert_predictor(image: np.ndarray, modes: np.ndarray, tile: int) -> np.ndarray:
    """Undo the prediction: the first row and column by running sums, the rest a row at a time.

    A row's pixels that need their left neighbour are walked one by one, all
    others are arrays; where every pixel is predicted by the left one, or by the
    one above, the whole image is a running sum.
    """
    height, width = image.shape
    mode = tiles(((modes >> np.uint32(8)) & np.uint32(15)).astype(np.int32), width, height, tile)
    out = channels(image)
    out[0, 0] += FIRST
    inner = mode[1:, 1:]
    if inner.size and (inner == 2).all():
        out[0] = np.cumsum(out[0], 0)
        return joined(np.cumsum(out, 0))
    out[:, 0] = np.cumsum(out[:, 0], 0)
    if not inner.size or (inner == 1).all():
        return joined(np.cumsum(out, 1))
    out[0] = np.cumsum(out[0], 0)
    out &= 255
    for y in range(1, height):
        above, row, own = out[y - 1], out[y], mode[y]
        top_right = np.roll(above, -1, 0)
        top_right[-1] = row[0]
        top_left = np.roll(above, 1, 0)
        needs = FROM_LEFT[own]
        needs[0] = True
        free = np.flatnonzero(~needs)
        if len(free):
            guess = predicted(own[free], row[free], above[free], top_right[free], top_left[free])
            row[free] = (row[free] + guess) & 255
        for x in np.flatnonzero(needs)[1:].tolist():
            guess = one_predicted(int(own[x]), row[x - 1].tolist(), above[x].tolist(), top_right[x].tolist(), top_left[x].tolist())
            row[x] = (row[x] + guess) & 255
    return joined(out)


def apply_predictor(image: np.ndarray, modes: np.ndarray, tile: int) -> np.ndarray:
    height, width = image.shape
    mode = tiles(((modes >> np.uint32(8)) & np.uint32(15)).astype(np.int32), width, height, tile)
    c = channels(image)
    left, top = np.roll(c, 1, 1), np.roll(c, 1, 0)
    top_left, top_right = np.roll(top, 1, 1), np.roll(top, -1, 1)
    top_right[:, -1] = c[:, 0]
    guess = predicted(mode, left, top, top_right, top_left)
    guess[0, :] = left[0, :]
    guess[:, 0] = top[:, 0]
    guess[0, 0] = (255, 0, 0, 0)
    return joined(c - guess)


def cross_colour(image: np.ndarray, elements: np.ndarray, tile: int, invert: bool) -> np.ndarray:
    height, width = image.shape
    signed = lambda x: (x & 255).astype(np.uint8).view(np.int8).astype(np.int32)
    e = channels(tiles(elements, width, height, tile))
    red_to_blue, green_to_blue, green_to_red = (signed(e[..., k]) for k in (1, 2, 3))
    c = channels(image)
    green = signed(c[..., 2])
    red = c[..., 1] + (green_to_red * green >> 5) * (1 if invert else -1)
    from_red = signed(red if invert else c[..., 1])
    change = (green_to_blue * green >> 5) + (red_to_blue * from_red >> 5)
    c[..., 3] = c[..., 3] + change * (1 if invert else -1)
    c[..., 1] = red
    return joined(c)


def subtract_green(image: np.ndarray, invert: bool) -> np.ndarray:
    c = channels(image)
    c[..., [1, 3]] += c[..., [2]] * (1 if invert else -1)
    return joined(c)


def bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def from_palette(image: np.ndarray, palette: np.ndarray, width: int) -> np.ndarray:
    shift = bundle_bits(len(palette))
    bundle, each = 1 << shift, 8 >> shift
    green = (image >> np.uint32(8)) & np.uint32(255)
    index = (green[:, :, None] >> (np.arange(bundle, dtype=np.uint32) * np.uint32(each))) & np.uint32((1 << each) - 1)
    index = index.reshape(len(image), -1)[:, :width]
    return np.append(palette, np.zeros(256, np.uint32))[index]


def to_palette(image: np.ndarray, palette: np.ndarray) -> np.ndarray:
    shift = bundle_bits(len(palette))
    bundle, each = 1 << shift, 8 >> shift
    index = np.searchsorted(palette, image).astype(np.uint32)
    index = np.pad(index, ((0, 0), (0, -index.shape[1] % bundle))).reshape(len(image), -1, bundle)
    return (index << (np.arange(bundle, dtype=np.uint32) * np.uint32(each))).sum(-1, dtype=np.uint32) << np.uint32(8)


# --- files ------------------------------------------------------------------------------------------------------


def decode(data: bytes) -> np.ndarray:
    """The pixels of a lossless WebP file, ``uint32`` ARGB by row and column."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    at = 12
    while data[at : at + 4] != b"VP8L":
        at += 8 + struct.unpack("<I", data[at + 4 : at + 8])[0] + 1 & ~1
        if at >= len(data):
            raise ValueError("no lossless image")
    size = struct.unpack("<I", data[at + 4 : at + 8])[0]
    bits = BitReader(data[at + 8 : at + 8 + size])
    if bits.read(8) != 0x2F:
        raise ValueError("wrong signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo: list[Callable[[np.ndarray], np.ndarray]] = []
    coded = width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            tile = bits.read(3) + 2
            across, down = -(-coded >> tile), -(-height >> tile)
            values = read_pixels(bits, across, down).reshape(down, across)
            if kind == PREDICTOR:
                undo.append(lambda image, v=values, t=tile: invert_predictor(image, v, t))
            else:
                undo.append(lambda image, v=values, t=tile: cross_colour(image, v, t, True))
        elif kind == SUBTRACT_GREEN:
            undo.append(lambda image: subtract_green(image, True))
        else:
            n = bits.read(8) + 1
            palette = joined(np.cumsum(channels(read_pixels(bits, n, 1)), axis=0))
            undo.append(lambda image, p=palette, w=coded: from_palette(image, p, w))
            coded = -(-coded >> bundle_bits(n))
    image = read_pixels(bits, coded, height, main=True).reshape(height, coded)
    for step in reversed(undo):
        image = step(image)
    return image


@dataclass
class Options:
    """How to write an image.

    ``copies`` are repeats of the last pixel, with ``far_copies`` any that came
    before (without a colour cache).  ``weights`` fixes the literals' code; without,
    it follows the image.
    """

    cache_bits: int = 0
    copies: bool = True
    far_copies: bool = False
    palette: bool = False
    subtract_green: bool = False
    predictor: np.ndarray | None = None
    cross_colour: np.ndarray | None = None
    tile: int = 2
    weights: tuple[int, ...] | None = field(default=None)


#: Pixels that a copy from further back has at least, and at most.
LEAST_COPY, MOST_COPY = 3, 4096


def distinct(numbers: np.ndarray) -> int:
    x = np.sort(numbers)
    return int(np.count_nonzero(x[1:] != x[:-1])) + (len(x) > 0)


def sequence_hashes(pixels: np.ndarray, kind: type = np.uint64) -> np.ndarray:
    """Hashes of every ``LEAST_COPY`` pixels in a row."""
    n = max(0, len(pixels) - LEAST_COPY + 1)
    p = pixels.astype(kind, copy=False)
    h = p[:n]
    for k in range(1, LEAST_COPY):
        h = h * kind(0x9E3779B1) + p[k : k + n]
    return h


def far_copies_of(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """``(place, length, back)`` of copies, the nearest place with the same next pixels first found, left to right."""
    h = sequence_hashes(pixels)
    n = len(h)
    if n < 2:
        return []
    order = np.argsort(h, kind="stable")
    again = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(again):
        return []
    before = np.full(n, -1, np.int64)
    before[order[again + 1]] = order[again]
    out, at = [], 0
    for place in np.flatnonzero(before >= 0).tolist():
        if place < at:
            continue
        source, length, step = int(before[place]), 0, 16
        while length < MOST_COPY:
            a, b = pixels[place + length : place + length + step], pixels[source + length : source + length + step]
            differ = np.flatnonzero(a != b[: len(a)])
            if len(differ):
                length += int(differ[0])
                break
            length += len(a)
            if len(a) < step:
                break
            step *= 2
        length = min(length, MOST_COPY)
        if length >= LEAST_COPY:
            out.append((place, length, place - source))
            at = place + length
    return out


Tokens = tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]


def tokens_of(pixels: np.ndarray, options: Options) -> Tokens:
    """Starts of literals and cache hits, their green symbols, and the copies between them."""
    if options.far_copies:
        copies = far_copies_of(pixels)
    else:
        copies = []
        if options.copies and len(pixels) > 4:
            heads = np.flatnonzero(np.concatenate([[True], pixels[1:] != pixels[:-1]]))
            runs = np.diff(heads, append=len(pixels)) - 1
            for head, n in zip(heads[runs >= 4].tolist(), runs[runs >= 4].tolist(), strict=True):
                copies += [(head + 1 + k, min(MOST_COPY, n - k), 1) for k in range(0, n, MOST_COPY)]
    starts = np.arange(len(pixels))
    if copies:
        covered = np.zeros(len(pixels) + 1, np.int64)
        places, lengths = np.array([c[0] for c in copies]), np.array([c[1] for c in copies])
        np.add.at(covered, places, 1)
        np.add.at(covered, places + lengths, -1)
        starts = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    own = pixels[starts]
    green = ((own >> np.uint32(8)) & np.uint32(255)).astype(np.int64)
    if options.cache_bits:
        cell = cache_index(own, options.cache_bits).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        hit = np.zeros(len(own), bool)
        hit[order[1:]] = (cell[order[1:]] == cell[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
        green = np.where(hit, 256 + LENGTH_CODES + cell, green)
    return starts, green, copies


@lru_cache(maxsize=8)
def fixed_codes(weights: tuple[int, ...], cache_bits: int, far: bool) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Code lengths, codes and the bits of the header for fixed weights."""
    green = [*weights, *[4] * LENGTH_CODES, *([3] * (1 << cache_bits) if cache_bits else [])]
    # without far copies only the pixel to the left is named
    distances = code_lengths([1] * 12 + [4] * (DISTANCE_CODES - 12), 12) if far else [1, 1] + [0] * (DISTANCE_CODES - 2)
    lengths = [code_lengths(green, 12), *[code_lengths(weights, 12)] * 3, distances]
    out = BitWriter()
    for x in lengths:
        write_prefix_code(out, x)
    return [np.array(x, np.int64) for x in lengths], [canonical(x) for x in lengths], out.bits()


def distance_prefix(back: int) -> tuple[int, int, int]:
    """A distance as prefix symbol and extra bits; code 2 is the pixel to the left."""
    return value_prefix(2 if back == 1 else back + len(NEAR))


def bits_needed(pixels: np.ndarray, options: Options, tokens: Tokens | None = None) -> int:
    """Bits of the pixels' tokens under fixed weights, as ``write_pixels`` would write them."""
    starts, green, copies = tokens or tokens_of(pixels, options)
    size, _, header = fixed_codes(options.weights, options.cache_bits, options.far_copies)
    own = pixels[starts]
    literal = own[green < 256]
    bits = len(header) + int(size[0][green].sum())
    bits += sum(int(size[k][(literal >> np.uint32(s)) & np.uint32(255)].sum()) for k, s in ((1, 16), (2, 0), (3, 24)))
    for _, length, back in copies:
        symbol, _, extra = value_prefix(length)
        far, _, more = distance_prefix(back)
        bits += int(size[0][256 + symbol]) + extra + int(size[4][far]) + more
    return bits


def write_pixels(out: BitWriter, pixels: np.ndarray, options: Options, main: bool = False, tokens: Tokens | None = None) -> None:
    if options.far_copies:  # a copied pixel would enter the cache anew
        options = replace(options, cache_bits=0)
    cache_bits = options.cache_bits
    out.write(int(cache_bits > 0), 1)
    if cache_bits:
        out.write(cache_bits, 4)
    if main:
        out.write(0, 1)
    starts, green, copies = tokens or tokens_of(pixels, options)
    own = pixels[starts]
    red, blue, alpha = ((own >> np.uint32(s)).astype(np.int64) & 255 for s in (16, 0, 24))
    literal = green < 256
    prefixes = [(value_prefix(length), distance_prefix(back)) for _, length, back in copies]
    if options.weights is not None:
        lengths, codes, header = fixed_codes(options.weights, cache_bits, options.far_copies)
        out.extend(header.astype(np.uint32), np.ones(len(header), np.int64))
    else:
        size = 256 + LENGTH_CODES + ((1 << cache_bits) if cache_bits else 0)
        seen = np.concatenate([green, np.array([256 + p[0] for p, _ in prefixes], np.int64)])
        far = np.array([d[0] for _, d in prefixes], np.int64)
        lengths, codes = [], []
        for values, n in ((seen, size), (red[literal], 256), (blue[literal], 256), (alpha[literal], 256), (far, DISTANCE_CODES)):
            lengths.append(np.array(code_lengths(np.bincount(values, minlength=n).tolist(), 15), np.int64))
            codes.append(canonical(lengths[-1].tolist()))
            write_prefix_code(out, lengths[-1].tolist(), int(values[0]) if len(values) else 0)
    # a row a token: green, red, blue, alpha
    table = np.zeros((len(starts), 4), np.uint32)
    width = np.zeros((len(starts), 4), np.int64)
    table[:, 0], width[:, 0] = codes[0][green], lengths[0][green]
    for k, values in enumerate((red, blue, alpha), 1):
        table[:, k] = codes[k][values]
        width[:, k] = np.where(literal, lengths[k][values], 0)
    done = 0
    for (place, _, _), ((symbol, extra, n), (far_symbol, more, m)) in zip(copies, prefixes, strict=True):
        to = int(np.searchsorted(starts, place))
        out.extend(table[done:to].ravel(), width[done:to].ravel())
        done = to
        out.extend(
            np.array([codes[0][256 + symbol], extra, codes[4][far_symbol], more], np.uint32), np.array([lengths[0][256 + symbol], n, lengths[4][far_symbol], m], np.int64)
        )
    out.extend(table[done:].ravel(), width[done:].ravel())


#: Steps to a neighbour that prediction may code in few bits, and the share of them from which it is tried.
SMALL_STEP, SMALL_SHARE = 4, 0.4
#: Share of pixels that must begin a sequence seen before for copies to be tried.
AGAIN_SHARE = 0.1
#: Colours up to which a palette is tried: its table costs more than a header of fixed codes beyond.
MOST_COLOURS = 64


def worth_trying(image: np.ndarray, options: Options, colours: int) -> bool:
    """Whether a profile can be the smallest: its gains show in cheap counts."""
    pixels = image.ravel()
    if options.palette:
        return colours <= MOST_COLOURS
    if options.predictor is not None:
        back = 1 if int(options.predictor.flat[0]) >> 8 == 1 else image.shape[1]
        samples = pixels.view(np.uint8)
        steps = samples[4 * back :] - samples[: -4 * back]
        return len(steps) > 0 and np.count_nonzero(steps + np.uint8(SMALL_STEP) <= 2 * SMALL_STEP) >= SMALL_SHARE * len(steps)
    if options.far_copies:
        keys = sequence_hashes(pixels, np.uint32)
        return distinct(keys) < (1 - AGAIN_SHARE) * len(keys)
    return True


def encode_smallest(image: np.ndarray, profiles: Sequence[Options]) -> tuple[bytes, int]:
    """The file under the profile that needs the fewest bits, and the profile's place.

    Profiles with fixed weights are compared by their tokens' exact bits after
    their transforms; a palette's by its colours and the bits of an index.
    """
    image = np.ascontiguousarray(image, np.uint32)
    pixels = image.ravel()
    colours = distinct(pixels)
    tried = [k for k, options in enumerate(profiles) if worth_trying(image, options, colours)]
    costs: dict[int, float] = {}
    tokens: dict[int, Tokens] = {}
    for k in tried if len(tried) > 1 else []:
        if profiles[k].palette:
            costs[k] = 400 + 28 * colours + (8 >> bundle_bits(colours)) * len(pixels)
        else:
            coded = transformed(image, profiles[k]).ravel()
            tokens[k] = tokens_of(coded, profiles[k])
            costs[k] = bits_needed(coded, profiles[k], tokens[k])
    best = min(tried, key=lambda k: costs.get(k, 0))
    return encode(image, profiles[best], tokens.get(best)), best


def transformed(image: np.ndarray, options: Options) -> np.ndarray:
    """The image after the predictor, cross-colour and subtract-green transforms of the options."""
    fit = lambda x: np.broadcast_to(x, (-(-image.shape[0] >> options.tile), -(-image.shape[1] >> options.tile)))
    if options.predictor is not None:
        image = apply_predictor(image, fit(options.predictor), options.tile)
    if options.cross_colour is not None:
        image = cross_colour(image, fit(options.cross_colour), options.tile, False)
    return subtract_green(image, False) if options.subtract_green else image


def encode(image: np.ndarray, options: Options, tokens: Tokens | None = None) -> bytes:
    """A lossless WebP file of ``uint32`` ARGB pixels; a predictor or cross-colour element of one value stands for all tiles."""
    height, width = image.shape
    if not (0 < width <= MAX_SIDE and 0 < height <= MAX_SIDE):
        raise ValueError("an image has 1 to 16384 rows and columns")
    out = BitWriter()
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)):
        out.write(value, n)
    plain = Options(copies=options.copies)
    fit = lambda x: np.broadcast_to(x, (-(-height >> options.tile), -(-image.shape[1] >> options.tile)))

    def begin(kind: int) -> None:
        out.write(1, 1)
        out.write(kind, 2)

    colours = np.unique(image) if options.palette else image[:0].ravel()
    if options.palette and len(colours) <= 256:
        begin(PALETTE)
        out.write(len(colours) - 1, 8)
        write_pixels(out, joined(np.diff(channels(colours), axis=0, prepend=0)), plain)
        image = to_palette(image, colours)
    if options.predictor is not None:
        begin(PREDICTOR)
        out.write(options.tile - 2, 3)
        write_pixels(out, fit(options.predictor).ravel(), plain)
        image = apply_predictor(image, fit(options.predictor), options.tile)
    if options.cross_colour is not None:
        begin(CROSS_COLOUR)
        out.write(options.tile - 2, 3)
        write_pixels(out, fit(options.cross_colour).ravel(), plain)
        image = cross_colour(image, fit(options.cross_colour), options.tile, False)
    if options.subtract_green:
        begin(SUBTRACT_GREEN)
        image = subtract_green(image, False)
    out.write(0, 1)
    write_pixels(out, image.ravel(), options, main=True, tokens=tokens)
    body = np.packbits(out.bits(), bitorder="little").tobytes()
    chunk = b"VP8L" + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk
