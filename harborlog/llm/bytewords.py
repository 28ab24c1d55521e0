"""Words and word shingles of Arrow string columns, found and hashed with numpy.

All work is on UTF-8 bytes and whole texts. Texts are walked in chunks of bounded size that end between two words, so a very
long text needs memory for its words, not for a table of all its bytes. A word's hash is a polynomial in its bytes, taken
from prefix sums modulo 2**64 and then mixed; it doesn't depend on where the word stands.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
SHINGLE = 5

#: Bytes that separate words: blanks for shingles, all ASCII but letters and digits for terms.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NO_TERM = np.zeros(256, bool)
NO_TERM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words of several texts in order; the words of text ``i`` are ``first[i]`` to ``first[i + 1]``."""

    start: np.ndarray  # in bytes, within all texts together
    end: np.ndarray
    hash: np.ndarray  # uint64
    first: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base % (1 << 64)))
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for chunks of up to n bytes; only the usual size is kept."""
    size = max(n, CHUNK) + 1
    if size in _tables:
        return _tables[size]
    made = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
    if size == CHUNK + 1:
        _tables[size] = made
    return made


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data`` (of bounded size), the same for equal bytes."""
    power, inverse = _tables_for(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    value = (sums[end] - sums[start]) * inverse[start]
    return mixed(value + (end - start).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array, separator: np.ndarray = BLANK, lower: bool = True) -> Words:
    data, offsets = raw(texts)
    starts, ends, hashes, n = [], [], [], len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    low = 0
    while low < n:
        high = min(low + CHUNK, n)
        if high < n:
            # Back to the last place between two words, or on to the next if a single word fills the chunk.
            cut = np.flatnonzero(separator[data[low + 1 : high]] | edge[low + 1 : high])
            while not len(cut):
                ahead = min(high + CHUNK, n)
                cut = np.flatnonzero(np.append(separator[data[high:ahead]], True) | edge[high : ahead + 1]) if ahead == n else np.flatnonzero(separator[data[high:ahead]] | edge[high:ahead])
                cut, high = (cut[:1] + high - low - 1, ahead)
            high = low + 1 + int(cut[-1])
        part = LOWER[data[low:high]] if lower else data[low:high]
        inside = ~separator[part]
        before = np.concatenate(([False], inside[:-1])) & ~edge[low:high]
        after = np.concatenate((inside[1:], [False])) & ~edge[low + 1 : high + 1]
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        starts.append(start + low)
        ends.append(end + low)
        hashes.append(span_hashes(part, start, end))
        low = high
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    start = np.concatenate(starts)
    return Words(start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, offsets))


_WEIGHTS = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(64)]


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words in order; fewer words are one run, no words give none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    n = min(width, len(hashes))
    total = np.full(len(hashes) - n + 1, np.uint64(n))
    for i in range(n):
        total += hashes[i : len(hashes) - n + 1 + i] * _WEIGHTS[i]
    return mixed(total)


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in parts of about ``size`` bytes of text at most, or one row."""
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(length) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def give_back() -> None:
    """Return memory that is free to the system: a process that lives on keeps it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that gives memory back when it ends: a worker goes on to other stages, and keeps what it doesn't give back."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return each
