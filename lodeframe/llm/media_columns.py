"""Media columns: payloads stored as lossless WebP images, read back and described.

A payload's bytes are the samples of an image of 8-bit ARGB pixels, 16 pixels a
row (more where that would need over 16,384 rows); a payload over ``IMAGE_BYTES``
is dealt over several images.  Of the ``PROFILES`` each image takes the one that
needs the fewest bits: a colour cache, copies from further back, a palette, or
prediction with the cross-colour transform.  The stored files are decoded again by
``webp.decode``, and the features are computed from what was read back.

Defined cases: a null text is empty and gives one block of zero bytes; equal
payloads give equal files and features on every machine; the size of a payload is
bounded by that of a column's value only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import webp
from .storage import text_batches

BLOCK, ROW_PIXELS = 64, 16


def byte_weight(b: int) -> int:
    """How often a byte is expected in text; only the size of the files depends on it."""
    c = chr(b)
    if c == " ":
        return 180
    if c.isascii() and c.islower():
        return 90 if c in "aeinorst" else 40
    if c.isascii() and (c.isalnum() or c in "\n.,"):
        return 10
    return 3 if b in (0, 195) or 0x20 <= b < 0x7F or 0x80 <= b < 0xC0 else 1


def step_weight(b: int) -> int:
    """How often a step between neighbours is expected where prediction is of use."""
    return max(1, 400 >> min(abs((b + 128) % 256 - 128), 8))


TEXT, STEPS = tuple(byte_weight(b) for b in range(256)), tuple(step_weight(b) for b in range(256))
#: Red and blue less by the green sample: multipliers are in units of 1/32.
BY_GREEN = np.array([[0x20 << 8 | 0x20]], np.uint32)
LEFT, ABOVE = np.array([[1 << 8]], np.uint32), np.array([[2 << 8]], np.uint32)
PROFILES = (
    webp.Options(cache_bits=7, weights=TEXT),
    webp.Options(far_copies=True, weights=TEXT),
    webp.Options(palette=True),
    webp.Options(predictor=LEFT, cross_colour=BY_GREEN, weights=STEPS, tile=9),
    webp.Options(predictor=ABOVE, cross_colour=BY_GREEN, weights=STEPS, tile=9),
)
#: Bytes of the largest image: 2 ** 14 rows and columns of four.
IMAGE_BYTES = 4 * webp.MAX_SIDE**2


def padded(data: bytes) -> bytes:
    """``data`` with zero bytes up to a positive multiple of ``BLOCK``."""
    return data + bytes(-len(data) % BLOCK if data else BLOCK)


def store(payload: bytes, image_bytes: int = IMAGE_BYTES) -> list[bytes]:
    """The files of a payload, usually one."""
    return [store_image(payload[k : k + image_bytes]) for k in range(0, len(payload), image_bytes)]


def store_image(payload: bytes) -> bytes:
    pixels = np.frombuffer(payload, "<u4")
    width = ROW_PIXELS
    while len(pixels) > width * webp.MAX_SIDE:
        width *= 2
    rows = -(-len(pixels) // width)
    image = np.zeros(rows * width, np.uint32)
    image[: len(pixels)] = pixels
    return webp.encode_smallest(image.reshape(rows, width), PROFILES)[0]


def read_back(media: list[bytes], size: int, image_bytes: int = IMAGE_BYTES) -> bytes:
    parts = [webp.decode(m).astype("<u4", copy=False).tobytes() for m in media]
    return b"".join(p[: max(0, min(image_bytes, size - k * image_bytes))] for k, p in enumerate(parts))


def describe(samples: bytes, media_bytes: int) -> str:
    """Mean, deviation, entropy, share of steps between neighbours, and bits stored a sample."""
    x = np.frombuffer(samples, np.uint8)
    counts = np.bincount(x, minlength=256)
    levels = np.arange(256)
    total = int(counts @ levels)
    squares = int(counts @ (levels * levels))
    n = len(x)
    mean = total / n
    deviation = math.sqrt(max(0.0, squares / n - mean * mean))
    entropy = math.fsum(c / n * math.log2(n / c) for c in counts[counts > 0].tolist())
    edges = int(np.count_nonzero(np.abs(np.diff(x.astype(np.int16))) > 32))
    return f"mean={mean:.4f};deviation={deviation:.4f};entropy={entropy:.4f};edges={edges / n:.4f};bits={8 * media_bytes / n:.4f}"


def media_columns(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media, samples, feature`` of ``docs(doc_id, text)``; ``media`` are the files, ``samples`` is the payload as read back."""
    id_type = dict(docs.dtypes)["doc_id"]
    text_batches(docs.sparkSession)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, files, samples, features = [], [], [], []
            for text in batch["text"].cast(pa.binary()):
                data = text.as_py() or b""
                payload = padded(data)
                files.append(store(payload))
                samples.append(read_back(files[-1], len(payload)))
                features.append(describe(samples[-1], sum(map(len, files[-1]))))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(files, pa.list_(pa.binary())), pa.array(samples, pa.binary()), pa.array(features, pa.string())],
                ["doc_id", "n_bytes", "media", "samples", "feature"],
            )

    return docs.select("doc_id", "text").mapInArrow(stored, f"doc_id {id_type}, n_bytes long, media array<binary>, samples binary, feature string")
