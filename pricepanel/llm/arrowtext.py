"""Whole-text columns as UTF-8 byte arrays: word spans and 64-bit word hashes.

All functions are vectorised over one bounded slice of rows (``slices``), so a
task's memory follows ``SLICE_BYTES`` and its longest single text, never the
partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
LONG_WORD = 64

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_WEIGHT = _RNG.integers(0, 2**64, LONG_WORD, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, a-z, everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` with at most ``limit`` bytes of ``column`` (one row at least)."""
    sizes = np.cumsum(_offsets(batch.column(column))[2])
    begin = 0
    while begin < batch.num_rows:
        base = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _offsets(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    column = column.fill_null("") if pa.types.is_large_string(column.type) else column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return column, offsets, np.diff(offsets)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null reads as empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column, offsets, _ = _offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per row the index of its first word (n + 1 values).

    Words never cross a row boundary.
    """
    inside = is_word[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
    after = np.concatenate((inside[1:], [False])) if len(raw) else inside
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: multilinear over its bytes, finalised with its length."""
    lengths = ends - starts
    out = np.zeros(len(starts), dtype=np.uint64)
    short = lengths <= LONG_WORD
    s, n = starts[short], lengths[short]
    if len(s):
        heads = np.cumsum(n) - n
        inner = np.arange(int(n.sum())) - np.repeat(heads, n)
        values = _BYTE[raw[inner + np.repeat(s, n)]] * _WEIGHT[inner]
        out[short] = np.add.reduceat(values, heads) + n.astype(np.uint64)
    for i in np.flatnonzero(~short):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(out)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` consecutive words (in order)."""
    out = hashes[:len(hashes) - size + 1]
    for k in range(1, size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k:len(hashes) - size + 1 + k])
    return out


def fields_of(fields) -> str:
    """DDL of schema fields, for the output of a map stage."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
