"""SimHash near duplicates by an inverted index over byte positions, with count filtering.

A fingerprint has 64 bits: each is 1 if it is set in over half the hashes of a text's word shingles. Two fingerprints
that differ in at most 4 bits differ in at most 4 of their 8 bytes, so they share at least 4 bytes in place. For a pair
that meets in a posting list, the shared bytes are tallied, and only pairs with 4 or more are verified bit by bit.

- Documents of one fingerprint are one entry, so copies cost nothing beyond their own row.
- A list of a single byte would hold 1/256 of all fingerprints. So lists stand for sets of 2, 3 or 4 positions, chosen
  such that any 4 of the 8 positions contain one of the sets (7, 20 or 70 sets). The more fingerprints, the larger the
  sets; every choice finds the same pairs.
- Lists are compared in tasks that read them sorted, each in full, and union what is linked: a list of n entries yields
  less than n links, whatever the number of pairs.
- A list above `LIST` entries is dealt into blocks by hash, a different deal in each list, and blocks are compared. What is
  linked by then is one component. Then the entries of each large component are dealt into blocks of their own, the
  others into mixed ones, and every two blocks are compared that can hold a pair of two components. So a large group of
  near copies is not compared with itself again, but no link between components is lost.

Null or empty texts and those without words have fingerprint zero and are linked like any other. Texts of fewer words than
a shingle are one shingle. Texts are read whole, very long ones in slices. Rows that repeat a doc_id are separate rows of one
id; a null doc_id gets the component of its fingerprint, and is null if no row there has an id. Ties cannot occur: exactly
half the hashes leave a bit 0. An empty table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.graph import components
from floorwatch.llm.tables import keep
from floorwatch.llm.words import Words, chunks, words_of

WORDS = 4
SEED = 42
BITS = 4
BYTES = 8
#: Entries of a list that are compared in one go, and of half a block.
LIST = 1024
#: Entries that a list should have on average at most, else its positions become one more.
MEAN = 128
#: Rows that are compared side by side, at least.
ROWS = 1 << 16
#: Shingles whose bits are counted at once.
SLICE = 1 << 18

#: A byte's eight bits in eight lanes of eight bits.
_LANES = ((np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.uint64) << (8 * np.arange(8)).astype(np.uint64)).sum(
    axis=1, dtype=np.uint64
)
_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def position_sets(size: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any 4 of the 8 positions contain one of them."""
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]  # of 4 positions, two share a group
    if size == 2:
        return [pair for group in groups for pair in combinations(group, 2)]
    if size == 3:  # three in a group, or two in one and one in the next
        inside = [group for group in groups if len(group) == 3]
        turned = zip(groups, groups[1:] + groups[:1], strict=True)
        return inside + [(*pair, one) for group, after in turned for pair in combinations(group, 2) for one in after]
    return list(combinations(range(BYTES), 4))


def shingle_hashes(found: Words, words: int = WORDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of every row in order, and how many each row has."""
    sizes = found.ends - found.starts
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    plain = np.full(int(begin[-1]), 32, dtype=np.uint8)  # words with one space after each
    order = np.arange(int(sizes.sum()))
    shift = np.repeat(np.arange(len(sizes)), sizes)
    plain[order + shift] = found.data[order + np.repeat(found.starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)] if len(sizes) else []
    number = np.where(found.counts >= words, found.counts - words + 1, np.minimum(found.counts, 1))
    first = np.repeat(found.first[:-1], number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    last = first + np.repeat(np.minimum(found.counts, words), number) - 1
    view = memoryview(plain)
    spans = map(view.__getitem__, map(slice, begin[first].tolist(), (begin[last] + sizes[last]).tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, spans, repeat(seed)), dtype=np.uint64, count=len(first)), number


def majority(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each row the bits that are set in over half its hashes; zero without any."""
    stretches = -(-number // 255)  # a lane of eight bits counts to 255
    owner = np.repeat(np.arange(len(number)), stretches)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    heads = (np.cumsum(number) - number)[owner] + 255 * nth
    ends = np.append(heads[1:], len(hashes))
    counts = np.zeros((len(number), 64), dtype=np.int64)
    at = 0
    while at < len(heads):
        to = max(at + 1, int(np.searchsorted(ends, heads[at] + SLICE, side="right")))
        lanes = _LANES[hashes[heads[at] : ends[to - 1]].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, heads[at:to] - heads[at], axis=0).view(np.uint8).astype(np.int64)
        mine = owner[at:to]
        cut = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        counts[mine[cut]] += np.add.reduceat(sums, cut, axis=0)
        at = to
    return np.packbits(2 * counts > number[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp: the fingerprint's bits as a signed number; docs: doc_id, text."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            bits = majority(*shingle_hashes(words_of(batch.column("text"), lower=True), words, seed))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(printed, "doc_id long, fp long")


def postings(prints: DataFrame, size: int) -> DataFrame:
    """list, fp: each fingerprint once per set of positions; a list is a set and its bytes."""
    keys = []
    for number, chosen in enumerate(position_sets(size)):
        mask = sum(255 << 8 * at for at in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask).cast("long"))))
    return prints.select(F.explode(F.array(*keys)).alias("list"), "fp")


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many bytes are zero in each exclusive or: the tally of shared positional bytes."""
    return BYTES - np.bitwise_count(((x & _LOW) + _LOW | x) & _HIGH)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the entries a[i] and b[i] have become one group each; a label is the least index of its group."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low < high
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while not np.array_equal(label, up := label[label]):
            label = up
    return label


def linked(lists: np.ndarray, prints: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(entry, least entry of its group) of all entries that are linked within their list; lists are sorted."""
    heads = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]]))
    sizes = np.diff(np.append(heads, len(lists)))
    company = np.repeat(sizes > 1, sizes)
    prints, sizes = prints[company], sizes[sizes > 1]
    end = np.repeat(np.cumsum(sizes), sizes)
    label = np.arange(len(prints))
    left, step = np.arange(len(prints)), 0
    while len(left):
        step += 1
        left = left[left + step < end[left]]
        x = prints[left] ^ prints[left + step]
        near = np.flatnonzero(shared_bytes(x) >= BYTES - bits)
        near = left[near[np.bitwise_count(x[near]) <= bits]]
        label = unite(label, near, near + step)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return prints[moved], prints[label[moved]]


def compared(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """a, b: links within the lists of rows list, fp."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def links(lists: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            a, b = linked(lists, prints, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append((batch.column("list").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)))
            if sum(len(h[0]) for h in held) >= ROWS:
                lists, prints = (np.concatenate(c) for c in zip(*held, strict=True))
                whole = int(np.searchsorted(lists, lists[-1]))  # the last list may go on
                held = [(lists[whole:], prints[whole:])]
                if whole:
                    yield links(lists[:whole], prints[:whole])
        if held:
            yield links(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return rows.repartition("list").sortWithinPartitions("list").mapInArrow(compare, "a long, b long")


def _between(entries: DataFrame) -> DataFrame:
    """list, fp: for every two blocks of a large list that can hold a link of two components, the entries of both.

    entries: list, fp, component. Blocks are of one large component, or mixed from small ones.
    """
    half = LIST // 2
    sizes = entries.groupBy("list", "component").count()
    open_lists = sizes.groupBy("list").agg(
        F.count("*").alias("components"),
        F.ceil(F.sum(F.when(F.col("count") < half, F.col("count"))) / half).alias("mixed"),
    ).filter("components > 1")
    large = sizes.filter(F.col("count") >= half).select("list", "component", F.ceil(F.col("count") / half).alias("pure"))
    dealt = keep(
        entries.join(open_lists.select("list", "mixed"), "list").join(large, ["list", "component"], "left").select(
            "list", "fp",
            F.when(F.col("pure").isNotNull(), F.col("component")).alias("of"),
            F.pmod(F.xxhash64("fp", "list"), F.coalesce("pure", "mixed")).alias("nth"),
        ),
        "dealt",
    )
    blocks = dealt.select("list", "of", "nth").distinct()
    one, two = (blocks.select("list", *(F.col(c).alias(f"{c}{i}") for c in ("of", "nth"))) for i in "12")
    both_mixed = F.col("of1").isNull() & F.col("of2").isNull() & (F.col("nth1") <= F.col("nth2"))
    mixed_pure = F.col("of1").isNull() & F.col("of2").isNotNull()
    pairs = one.join(two, "list").filter(both_mixed | mixed_pure | (F.col("of1") < F.col("of2")))
    pairs = keep(pairs.withColumn("pair", F.xxhash64("list", "of1", "nth1", F.lit(0), "of2", "nth2")), "pairs")
    sides = [pairs.select("list", F.col(f"of{i}").alias("of"), F.col(f"nth{i}").alias("nth"), "pair") for i in "12"]
    met = sides[0].union(sides[1]).distinct()
    same = (dealt["list"] == met["list"]) & dealt["of"].eqNullSafe(met["of"]) & (dealt["nth"] == met["nth"])
    return dealt.join(met, same).select(F.col("pair").alias("list"), "fp")


def links(prints: DataFrame, bits: int = BITS, size: int | None = None) -> DataFrame:
    """a, b: links between distinct fingerprints, enough to connect all that are within `bits` of each other."""
    if not 0 <= bits <= 4:
        raise ValueError("4 of 8 bytes are sure to be shared only up to 4 bits")
    if size is None:
        number = prints.count()
        size = next((p for p in (2, 3) if number <= MEAN * 256**p), 4)
    rows = postings(prints, size)
    large = keep(rows.groupBy("list").count().filter(F.col("count") > LIST), "lists")
    blocks = F.ceil(F.col("count") / (LIST // 2))
    block = F.when(blocks.isNull(), F.col("list")).otherwise(F.xxhash64("list", F.pmod(F.xxhash64("fp", "list"), blocks)))
    found = keep(compared(rows.join(large, "list", "left").select(block.alias("list"), "fp"), bits), "links")
    if large.isEmpty():
        return found
    roots = components(found)
    entries = rows.join(large.select("list"), "list", "left_semi").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    more = compared(_between(keep(entries.select("list", "fp", F.coalesce("component", "fp").alias("component")), "entries")), bits)
    return found.union(keep(more, "links"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED, bits: int = BITS
) -> DataFrame:
    """doc_id, fp (signed), component_id (smallest doc_id reachable) of every row."""
    rows = keep(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), words, seed), "prints")
    classes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), bits)).select(F.col("node").alias("fp"), "component")
    rooted = keep(classes.join(roots, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "rooted")
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
