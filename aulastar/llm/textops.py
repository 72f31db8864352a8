"""Vectorised byte and word helpers shared by the operators that work on Arrow batches.

A batch of texts is one byte array plus row offsets, as Arrow stores it.  Words are ``[^\\x20\\x09-\\x0D]+``; lower-casing
touches A-Z alone.  Null texts count as empty."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are taken together up to this size; one longer text is a chunk of its own

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NO_LETTER = np.ones(256, dtype=bool)   # letters of ASCII, and every byte beyond it
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column, nulls as empty."""
    col = col.cast(pa.large_string()).fill_null("")
    n, (_, off, data) = len(col), col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset : col.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8), offsets


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about ``limit`` bytes."""
    data, off = buffers(col)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def word_bounds(data: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, a run of bytes that are not in ``gap``."""
    ink = ~gap[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    before = np.concatenate(([False], ink[:-1])) if len(ink) else ink
    after = np.concatenate((ink[1:], [False])) if len(ink) else ink
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gap: np.ndarray = SPACE) -> np.ndarray:
    """A 64-bit hash of the bytes of every word."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    value = _BYTE_VALUE[data]
    value[gap[data]] = 0
    gaps = np.diff(np.append(starts, len(data)))
    place = np.zeros(len(data), dtype=np.int64)
    place[starts[0] :] = np.arange(len(data) - starts[0]) - np.repeat(starts - starts[0], gaps)
    value *= powers(int(gaps.max()))[place]
    return mix64(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def shingle_hashes(words: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word index of every run of ``k`` words within a row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(row[:n] == row[k - 1 :])
    h = np.zeros(len(first), dtype=np.uint64)
    for j, c in enumerate(powers(k + 1)[1:]):
        h += words[first + j] * c
    return mix64(h), first


def batches_out(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
