"""Exact substring dedup on bytes by suffix arrays: each byte covered by a 50-byte string that a smaller document has, goes.

Strings that may repeat are brought together in shards (repeats.py). The suffix array of a shard is made by induced
sorting: suffixes are classified as larger or smaller than their right neighbour; the substrings between leftmost
smaller ones are sorted by inducing, named, and the string of names is sorted by the same function, or, when it has
more names than an inducing pass can walk through bucket by bucket, by doubling ranks, as far as a window reaches. From
the order of the leftmost smaller suffixes, all others are induced, each bucket as one numpy step. Common prefixes with
the predecessor are then computed in text order (permuted), up to the window: equal windows are neighbours that share it.

Texts are taken as UTF-8 bytes and a cut may fall within a character, so what is kept is binary. Null and empty texts
have no byte. Rows with a null doc_id lose nothing and take nothing from others. Rows of one doc_id are one document,
which never repeats itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.repeats import Scheme, Units, remove
from floorwatch.llm.words import prefix_hash, raw, span_hash

WINDOW = 50
GRAM = 28

#: Alphabets that an inducing pass walks through; larger ones are sorted by doubling.
ALPHABET = 4096


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last, a sentinel, is."""
    n = len(text)
    out = np.ones(n, dtype=bool)
    step = np.sign(np.diff(text.astype(np.int64)))
    place = np.where(step != 0, np.arange(n - 1), n)
    decided = np.minimum.accumulate(place[::-1])[::-1]
    out[:-1] = step[np.minimum(decided, n - 2)] > 0 if n > 1 else True
    return out


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of all suffixes from that of the leftmost smaller ones."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if len(sizes) <= 1 << 16:
        text = text.astype(np.uint16)  # numbers of 16 bits are sorted by counting
    order = np.full(len(text), -1, dtype=np.int64)
    fill = starts.copy()
    letters = np.flatnonzero(sizes)

    seed_letters = text[seeds]
    by_letter = np.argsort(seed_letters, kind="stable")
    seeds = seeds[by_letter]
    seed_bounds = np.searchsorted(seed_letters[by_letter], np.arange(len(sizes) + 1))

    def spread(from_: np.ndarray, want_small: bool, letter: int) -> np.ndarray:
        """Put the left neighbours of that kind into their buckets, return those of the same letter."""
        left = from_ - 1
        left = left[left >= 0]
        left = left[small[left] == want_small]
        there = text[left]
        same = left[there == letter]
        left, there = left[there != letter], there[there != letter]
        if len(left):
            by = np.argsort(there, kind="stable")
            left, there = left[by], there[by]
            heads = np.flatnonzero(np.concatenate([[True], there[1:] != there[:-1]]))
            count = np.diff(np.append(heads, len(there)))
            within = np.arange(len(there)) - np.repeat(heads, count)
            base = np.repeat(fill[there[heads]], count)
            order[base - 1 - within if want_small else base + within] = left
            fill[there[heads]] += -count if want_small else count
        return same

    for letter in letters:  # larger suffixes, buckets from left to right
        now = order[starts[letter] : fill[letter]]
        while len(now):
            now = spread(now, False, letter)
            order[fill[letter] : fill[letter] + len(now)] = now
            fill[letter] += len(now)
        spread(seeds[seed_bounds[letter] : seed_bounds[letter + 1]], False, letter)
    larger = fill.copy()
    fill[:] = ends
    last = len(text) - 1
    order[0] = last
    fill[text[last]] -= 1
    for letter in letters[::-1]:  # smaller suffixes, buckets from right to left
        now = order[fill[letter] : ends[letter]][::-1]
        while len(now):
            now = spread(now, True, letter)
            order[fill[letter] - len(now) : fill[letter]] = now[::-1]
            fill[letter] -= len(now)
        spread(order[starts[letter] : larger[letter]][::-1], True, letter)
    return order


def _doubled(text: np.ndarray, depth: int) -> np.ndarray:
    """The order of suffixes by their first `depth` letters at least."""
    rank, done = text.astype(np.int64), 1
    while True:
        key = rank * (rank.max() + 2)
        key[:-done or None] += (rank[done:] + 1) if done < len(rank) else 0
        order = np.argsort(key)  # equal ones get one rank, in any order
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty_like(new)
        rank[order] = new
        done *= 2
        if new[-1] == len(new) - 1 or done >= min(depth, len(text)):
            return order


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` letters at least. The last letter is 0 and the only one."""
    if len(text) < 3:
        return np.arange(len(text))[::-1]
    small = _smaller(text)
    leftmost = small.copy()
    leftmost[0] = False
    leftmost[1:] &= ~small[:-1]
    places = np.flatnonzero(leftmost)
    sizes = np.bincount(text)
    if len(places) > 1:
        rough = _induce(text, small, places, sizes)
        rough = rough[leftmost[rough]]
        length = np.empty(len(text), dtype=np.int64)
        length[places] = np.append(np.diff(places) + 1, 1)
        one, two = rough[:-1], rough[1:]
        differ = length[one] != length[two]
        open_ = np.flatnonzero(~differ)
        for k in range(int(length[places].max())):
            open_ = open_[length[one[open_]] > k]
            if not len(open_):
                break
            unlike = text[one[open_] + k] != text[two[open_] + k]
            differ[open_[unlike]] = True
            open_ = open_[~unlike]
        names = np.empty(len(text), dtype=np.int64)
        names[rough] = np.concatenate([[0], np.cumsum(differ)])
        reduced = names[places]
        if differ.all():
            seeds = rough
        elif reduced.max() < ALPHABET:
            seeds = places[suffix_order(reduced, depth)]
        else:
            seeds = places[_doubled(reduced, depth)]
    else:
        seeds = places
    return _induce(text, small, seeds, sizes)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By place in the text: how many bytes a suffix shares with the one before it in the order, up to `most`."""
    before = np.full(len(data), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(most + 8, dtype=np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(data) + most, dtype=np.uint64)
    for i in range(8):
        eight |= padded[i : i + len(eight)] << np.uint64(8 * i)
    out = np.zeros(len(data), dtype=np.int64)
    at = np.flatnonzero(before >= 0)
    other = before[at]
    for k in range(0, most, 8):
        unlike = eight[at + k] ^ eight[other + k]
        alike = unlike == 0
        low = unlike & (~unlike + np.uint64(1))
        out[at] += np.where(alike, 8, np.log2(np.where(alike, 1, low).astype(np.float64)).astype(np.int64) // 8)
        at, other = at[alike], other[alike]
    return np.minimum(out, most)


def earliest(strings: list[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For each string, the least owner of each of its windows."""
    size = np.asarray([len(s) for s in strings], dtype=np.int64)
    starts = np.cumsum(size + 1) - size - 1
    data = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    text = data.astype(np.int64) + 2
    text[starts + size] = 1  # ends of strings, below all bytes
    order = suffix_order(np.append(text, 0), WINDOW)[1:]
    owner = np.repeat(owners, size + 1)
    whole = np.zeros(len(data), dtype=bool)  # a window starts here and ends within its string
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size - WINDOW + 1, -1)
    whole = np.cumsum(edge[:-1]) > 0
    order = order[whole[order]]
    shared = common_prefixes(data, order, WINDOW)[order]
    heads = np.flatnonzero(np.concatenate([[True], shared[1:] < WINDOW]))
    lowest = np.minimum.reduceat(owner[order], heads)
    first = np.empty(len(data), dtype=np.int64)
    first[order] = np.repeat(lowest, np.diff(np.append(heads, len(order))))
    return [first[a : a + n - WINDOW + 1] for a, n in zip(starts, size, strict=True)]


def _units(texts: pa.Array) -> Units:
    data, bounds = raw(texts)
    prefix = prefix_hash(data)
    at = np.arange(max(0, len(data) - GRAM + 1))
    packed = data.tobytes()
    return Units(
        span_hash(prefix, at, at + GRAM), bounds, lambda a, n: packed[a : a + n],
        lambda a: span_hash(prefix, a, a + WINDOW),
    )


def _rest(text: bytes):
    return len(text), lambda kept: b"".join([text[a:b] for a, b in kept])


SCHEME = Scheme(WINDOW, GRAM, _units, earliest, _rest)


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary)."""
    mine = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = remove(mine, SCHEME)
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.col("rest").alias("kept"))
