"""Words of whole Arrow columns at once: offsets and 64-bit hashes, computed on the bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer document is taken alone.
CHUNK = 1 << 20

#: Bytes of words: all but space, tab, line feed, vertical tab, form feed, carriage return.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of words: digits, letters, everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers = {False: np.ones(1, dtype=np.uint64), True: np.ones(1, dtype=np.uint64)}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of an odd number, or of its inverse, modulo 2**64; kept between calls."""
    if len(_powers[inverse]) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, CHUNK + CHUNK // 8), base, dtype=np.uint64)
        steps[0] = 1
        _powers[inverse] = np.cumprod(steps, dtype=np.uint64)
    return _powers[inverse][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one-to-one."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial over the bytes, one entry more than bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, the same wherever the span stands."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix), inverse=True)[starts])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive numbers."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, dtype=np.uint64)
    factors = powers(2 * n + 2)
    for i in range(n):
        out += hashes[i : i + size] * factors[2 * i + 1]
    return mix(out)


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, and the bounds of each row in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in slices of at most `limit` bytes of text, or of one row."""
    for batch in batches:
        _, bounds = raw(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1
            end = max(at + 1, min(end, batch.num_rows))
            yield batch.slice(at, end - at)
            at = end


@dataclass
class Words:
    """Words of some documents: bytes from starts to ends of data; first[d] to first[d + 1] are those of document d."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @cached_property
    def hashes(self) -> np.ndarray:
        return span_hash(prefix_hash(self.data), self.starts, self.ends)

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(column: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Maximal runs of bytes of that kind within each row."""
    data, bounds = raw(column)
    if lower:
        data = LOWER[data]
    inside = kind[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[heads] = inside[heads]
    tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    finishes[tails] = inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))
