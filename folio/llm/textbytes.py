"""Vectorised words and hashes of Arrow text columns, as UTF-8 bytes.

Texts are taken whole, in slices of about a megabyte (a longer text is a slice of its own), so memory follows the
longest text and not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
#: [^\x20\x09-\x0D], byte by byte.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Spans are mixed 8 bytes at a time up to this length; what is longer adds a digest of its rest.
_MIXED_BYTES = 512
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of the first word of each text (with the total at the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    w = IS_WORD[buf]
    before = np.zeros(n, bool)
    before[1:] = w[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = w[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(w & ~before)
    return starts, np.flatnonzero(w & ~after) + 1, np.searchsorted(starts, offsets)


def eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as numbers; zeros follow the end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans: equal for equal bytes. Each 8 bytes are mixed into what came before them, so no
    sum or polynomial of the bytes decides, and texts made of repeated patterns don't collide."""
    size, view = ends - starts, eights(buf)
    out = mix(size.astype(np.uint64) + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))
    live, done = np.flatnonzero(size > 0), 0
    while len(live) and done < _MIXED_BYTES:
        left, word = size[live] - done, view[starts[live] + done]
        short = left < 8
        word[short] &= _MASKS[left[short]]
        out[live] = mix(out[live] ^ word)
        live, done = live[left > 8], done + 8
    for i in live.tolist():
        rest = hashlib.blake2b(buf[starts[i] + done : ends[i]].tobytes(), digest_size=8).digest()
        out[i : i + 1] = mix(out[i : i + 1] ^ np.frombuffer(rest, "<u8"))
    return out


def sequence_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive items."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out * U(3) + hashes[i : i + n] + U(i + 1))
    return out
