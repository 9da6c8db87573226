"""Windows that stand in more than one document: how candidates meet, whatever a window is made of.

A window is `window` consecutive units (words, or bytes) of a document. Its minimiser is the least hash of the grams of
`gram` units within it. Consecutive windows of one minimiser are a run (a super-k-mer) and travel as one packed string.
Equal windows have equal minimisers, so they meet in the shard of that minimiser.

1. Which minimisers stand in two documents or more? Each task sends their hashes, 4 bytes each, to the part of the hash
   range they are in; what comes twice sets a bit in a map of fixed size (MAP_BITS), which then goes to all tasks. Bits
   that are set by chance cost work and change nothing. Very frequent minimisers set a bit in a second map.
2. Which of these stand in different strings? Tasks send them once more with a hash of each string; what comes with two
   sets a bit in a third map. The others, three quarters in text with many copies, are told by their minimiser alone.
3. Runs whose minimiser has its bit go to its shard, those of several strings with their string, packed. What a chunk of
   text has in a smaller document too is not sent: all its windows are repeats, which is known at once. So a passage that
   many documents share is sent once per chunk. The windows of a very frequent minimiser, whose runs may all differ at
   their ends, go one by one to the shard of their own hash, so that no shard gets them all, with a digest of 128 bits.
4. In a shard, documents that hold the same string as a smaller one lose it whole. Only the first holder of a string
   needs more: `earliest` tells for each of its windows the smallest document of the shard that has it.
5. The spans go back to their documents. Those that have none are finished where they are read; only the others move.

Every task holds a chunk of text, a part of the hash range or a shard, whose numbers grow with the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.tables import bitmap_of, bits_set, has_key, keep
from floorwatch.llm.words import chunks, mix

#: Bits of the map of repeated minimisers: 16 MB.
MAP_BITS = 27

#: Bytes of text for each part of the hash range, and for each shard.
PART_BYTES = 64 << 20
SHARD_BYTES = 8 << 20

#: A task counts a minimiser in so many documents of a chunk at most; in so many in all, it is very frequent.
COUNTED = 64
FREQUENT = 1024

#: Bytes of what may stand for a string, at most; every string of a window is longer.
STANDS = 16

#: Bytes of strings that are compared at once in a shard, if no minimiser has more.
GROUP_BYTES = 512 << 10


@dataclass
class Units:
    """Units of a chunk of documents: hash of each, hash of each gram, first unit by document."""

    grams: np.ndarray
    first: np.ndarray
    #: (first unit, number of units) -> the string that holds just them
    pack: Callable[[int, int], bytes]
    #: first units -> hash of the window that starts there
    windows: Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Scheme:
    window: int
    gram: int
    units: Callable[[pa.Array], Units]
    #: strings, their owners -> for each string, the least owner of each of its windows
    earliest: Callable[[list[bytes], np.ndarray], list[np.ndarray]]
    #: text -> its units, and from spans of units what they hold
    rest: Callable[[bytes], tuple[int, Callable[[list[list[int]]], bytes]]]


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    done = 1
    while 2 * done <= width and len(values) > done:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    more = width - done
    return np.minimum(values[:-more], values[more:]) if 0 < more < len(values) else values[: max(0, len(values) - more)]


def runs(units: Units, scheme: Scheme) -> tuple[np.ndarray, ...]:
    """document, first window (as its first unit), number of windows and minimiser of every run."""
    size = np.maximum(np.diff(units.first) - scheme.window + 1, 0)
    if not size.any():
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))
    minimum = least(units.grams, scheme.window - scheme.gram + 1)
    doc = np.repeat(np.arange(len(size)), size)
    at = np.repeat(units.first[:-1], size) + np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    key = minimum[at]
    head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]))
    return doc[head], at[head], np.diff(np.append(head, len(doc))), key[head]


def _total(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _part_bits(total: int) -> int:
    return int(np.clip(np.ceil(np.log2(max(total, 1) / PART_BYTES)), 6, 20))


def repeated(docs: DataFrame, scheme: Scheme, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The maps of minimisers in two documents or more, and of very frequent ones, by their leading bits."""
    part_bits = _part_bits(total)
    payload = np.uint64(64 - part_bits - 32)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc, _, _, key = runs(scheme.units(batch.column("text")), scheme)
            order = np.argsort(key, kind="stable")
            doc, key = doc[order], key[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, times = np.unique(key[new], return_counts=True)
            key = np.repeat(key, np.minimum(times, COUNTED))
            part = (key >> np.uint64(64 - part_bits)).astype(np.int32)
            low = ((key >> payload) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            parts, heads = np.unique(part, return_index=True)
            blobs = [x.tobytes() for x in np.split(low, heads[1:])] if len(parts) else []
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "hashes"])

    cell_bits = MAP_BITS - part_bits

    def counted(table: pa.Table) -> pa.Table:
        hashes = np.sort(np.concatenate([np.frombuffer(b.as_py(), dtype=np.uint32) for b in table.column("hashes")]))
        heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        times = np.diff(np.append(heads, len(hashes)))
        maps = []
        for enough in (2, FREQUENT):
            bits = np.zeros(1 << cell_bits, dtype=bool)
            bits[hashes[heads[times >= enough]] >> np.uint32(32 - cell_bits)] = True
            maps.append(pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary()))
        return pa.table({"part": table.column("part").slice(0, 1), "twice": maps[0], "often": maps[1]})

    found = (
        docs.select("text").mapInArrow(sent, "part int, hashes binary")
        .groupBy("part").applyInArrow(counted, "part int, twice binary, often binary")
    )
    twice, often = _collected(found, ("twice", "often"), cell_bits)
    return twice, often


def _collected(found: DataFrame, names: tuple[str, ...], cell_bits: int) -> list[np.ndarray]:
    """Whole maps from those of the parts."""
    maps = [np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8) for _ in names]
    step = 1 << (cell_bits - 3)
    for row in found.toLocalIterator():
        at = row["part"] * step
        for bits, name in zip(maps, names, strict=True):
            bits[at : at + step] = np.frombuffer(zlib.decompress(row[name]), dtype=np.uint8)
    return maps


def _passed(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    return bits_set(bits, (key >> np.uint64(64 - MAP_BITS)).astype(np.int64))


def differing(docs: DataFrame, scheme: Scheme, total: int, twice: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The map of repeated, not very frequent minimisers whose runs are not all the same string."""
    part_bits = _part_bits(total)
    cell_bits = MAP_BITS - part_bits
    earlier = docs.sparkSession.sparkContext.broadcast((twice, often))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, often = earlier.value
        for batch in chunks(batches):
            units = scheme.units(batch.column("text"))
            _, at, number, key = runs(units, scheme)
            go = _passed(twice, key) & ~_passed(often, key)
            at, number, key = at[go].tolist(), number[go].tolist(), key[go]
            string = np.fromiter(
                (xxhash.xxh3_64_intdigest(units.pack(a, n + scheme.window - 1)) for a, n in zip(at, number, strict=True)),
                dtype=np.uint64, count=len(key),
            )
            order = np.lexsort((string, key))
            key, string = key[order], string[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (string[1:] != string[:-1])
            key, string = key[new], string[new]
            low = ((key >> np.uint64(32 - part_bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            parts, heads = np.unique((key >> np.uint64(64 - part_bits)).astype(np.int32), return_index=True)
            cut = lambda x: pa.array([p.tobytes() for p in np.split(x, heads[1:])] if len(parts) else [], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), cut(low), cut(string)], names=["part", "hashes", "strings"]
            )

    def compared(table: pa.Table) -> pa.Table:
        low, string = (
            np.concatenate([np.frombuffer(b.as_py(), dtype=kind) for b in table.column(name)])
            for name, kind in (("hashes", np.uint32), ("strings", np.uint64))
        )
        order = np.lexsort((string, low))
        low, string = low[order], string[order]
        unlike = low[1:][(low[1:] == low[:-1]) & (string[1:] != string[:-1])]
        bits = np.zeros(1 << cell_bits, dtype=bool)
        bits[unlike >> np.uint32(32 - cell_bits)] = True
        packed = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
        return pa.table({"part": table.column("part").slice(0, 1), "several": pa.array([packed], pa.binary())})

    found = (
        docs.select("text").mapInArrow(sent, "part int, hashes binary, strings binary")
        .groupBy("part").applyInArrow(compared, "part int, several binary")
    )
    return _collected(found, ("several",), cell_bits)[0]


def merged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans united where they touch, as int32 pairs; the input ordered by start."""
    if not len(start):
        return np.zeros((0, 2), dtype=np.int32)
    reach = np.maximum.accumulate(end)
    head = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return np.stack([start[head], reach[np.append(head[1:], len(start)) - 1]], axis=1).astype(np.int32)


def _by_doc(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Documents and the merged spans of each, all in one pass: each document has a stretch of the number line for itself."""
    if not len(doc):
        return [], []
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    base = (np.cumsum(new) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + base)
    head = np.flatnonzero(new | np.concatenate([[True], (start + base)[1:] > reach[:-1]]))
    tail = np.append(head[1:], len(doc)) - 1
    blob = np.stack([start[head], reach[tail] - base[tail]], axis=1).astype(np.int32).tobytes()
    heads = np.flatnonzero(new[head])
    cuts = [*(8 * heads).tolist(), len(blob)]
    return doc[head[heads]].tolist(), [blob[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _bale(columns: list[np.ndarray], strings: list[bytes]) -> bytes:
    """What a chunk sends to a shard: four columns, the lengths of the strings, and the strings, compressed."""
    numbers = np.stack([*columns, np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))])
    return zstandard.ZstdCompressor(level=1).compress(len(strings).to_bytes(8, "little") + numbers.tobytes() + b"".join(strings))


def _opened(bales: pa.ChunkedArray) -> tuple[list[np.ndarray], list[bytes]]:
    parts, strings = [], []
    opener = zstandard.ZstdDecompressor()
    for bale in bales:
        data = opener.decompress(bale.as_py())
        n = int.from_bytes(data[:8], "little")
        numbers = np.frombuffer(data, dtype=np.int64, count=5 * n, offset=8).reshape(5, n)
        at = 8 + 40 * n
        for size in numbers[4].tolist():
            strings.append(data[at : at + size])
            at += size
        parts.append(numbers[:4])
    return list(np.concatenate(parts, axis=1)), strings


def spans(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, spans: pairs of int32, units of the document that windows of smaller documents cover."""
    spark = docs.sparkSession
    total = _total(docs)
    repeats = repeated(docs, scheme, total)
    maps = spark.sparkContext.broadcast((*repeats, differing(docs, scheme, total, *repeats)))
    shards = max(64, total // SHARD_BYTES)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, often, several = maps.value
        for batch in chunks(batches):
            ids = batch.column("doc_id").to_numpy()
            units = scheme.units(batch.column("text"))
            doc, at, number, key = runs(units, scheme)
            hot = _passed(often, key)
            wanted = _passed(twice, key) & ~hot
            each = number[hot]
            single = np.repeat(at[hot], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at = np.concatenate([at[wanted], single])
            key = np.concatenate([key[wanted], units.windows(single)])
            owner = ids[np.concatenate([doc[wanted], np.repeat(doc[hot], each)])]
            local = at - units.first[np.concatenate([doc[wanted], np.repeat(doc[hot], each)])]
            number = np.concatenate([number[wanted], np.ones(len(single), dtype=np.int64)])
            # what stands for a run: its string, its minimiser if no other string has it, or the digest of a window
            how = np.where(np.arange(len(at)) >= wanted.sum(), 2, np.where(_passed(several, key), 0, 1)).tolist()
            bodies = []
            for kind, a, n, k in zip(how, at.tolist(), number.tolist(), key.tolist(), strict=True):
                if kind == 1:
                    bodies.append(k.to_bytes(8, "little"))
                else:
                    body = units.pack(a, n + scheme.window - 1)
                    bodies.append(xxhash.xxh3_128_digest(body) if kind else body)
            first: dict[bytes, int] = {}
            for body, who in zip(bodies, owner.tolist(), strict=True):
                if first.setdefault(body, who) > who:
                    first[body] = who
            least_owner = np.fromiter((first[b] for b in bodies), dtype=np.int64, count=len(bodies))
            gone = owner > least_owner
            sent = np.flatnonzero(~gone)
            lost, blobs = _by_doc(owner[gone], local[gone], local[gone] + number[gone] + scheme.window - 1)
            lost_ids = np.asarray(lost, dtype=np.int64)
            shard = np.concatenate([(mix(key[sent]) % np.uint64(shards)).astype(np.int64), np.abs(lost_ids) % shards])
            order = np.argsort(shard, kind="stable")
            columns = [
                np.concatenate([key[sent].view(np.int64), np.zeros(len(lost), dtype=np.int64)])[order],
                np.concatenate([owner[sent], lost_ids])[order],
                np.concatenate([local[sent], np.full(len(lost), -1)])[order],
                np.concatenate([number[sent], np.zeros(len(lost), dtype=np.int64)])[order],
            ]
            strings = [*(bodies[i] for i in sent), *blobs]
            strings = [strings[i] for i in order]
            found, heads = np.unique(shard[order], return_index=True)
            tails = np.append(heads[1:], len(order))[: len(heads)]
            bales = [_bale([c[a:b] for c in columns], strings[a:b]) for a, b in zip(heads, tails, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(bales, pa.binary())], names=["shard", "bale"])

    def resolved(table: pa.Table) -> pa.Table:
        (key, doc, start, number), body = _opened(table.column("bale"))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i in np.flatnonzero(start < 0):
            known = np.frombuffer(body[i], dtype=np.int32).reshape(-1, 2)
            out.append((np.full(len(known), doc[i]), known[:, 0], known[:, 1]))
        rows = np.flatnonzero(start >= 0)
        which: dict[bytes, int] = {}
        index = np.fromiter((which.setdefault(body[i], len(which)) for i in rows.tolist()), dtype=np.int64, count=len(rows))
        holder = np.full(len(which), np.iinfo(np.int64).max)
        np.minimum.at(holder, index, doc[rows])
        copies = rows[doc[rows] > holder[index]]
        out.append((doc[copies], start[copies], start[copies] + number[copies] + scheme.window - 1))
        # strings whose minimiser has other strings too, in groups of whole minimisers; minimisers and digests are no strings
        minimiser = np.zeros(len(which), dtype=np.int64)
        minimiser[index] = key[rows]
        strings = list(which)
        size = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        spelt = np.flatnonzero(size > STANDS)
        order = spelt[np.argsort(minimiser[spelt], kind="stable")]
        heads = np.flatnonzero(np.concatenate([[True], np.diff(minimiser[order]) != 0])) if len(order) else np.zeros(0, dtype=np.int64)
        tails = np.append(heads[1:], len(order)).astype(np.int64)[: len(heads)]
        group: list[int] = []
        weight = 0
        string, at = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]  # windows that a smaller document has

        def solve() -> None:
            owners = scheme.earliest([strings[i] for i in group], holder[group])
            many = np.fromiter(map(len, owners), dtype=np.int64, count=len(owners))
            own = np.repeat(np.asarray(group), many)
            hit = np.flatnonzero(np.concatenate(owners) < holder[own])
            string.append(own[hit])
            at.append(hit - np.repeat(np.cumsum(many) - many, many)[hit])

        several = np.flatnonzero(tails - heads > 1)
        before = np.concatenate([[0], np.cumsum(size[order])])
        for a, b in zip(heads[several].tolist(), tails[several].tolist(), strict=True):
            group += order[a:b].tolist()
            weight += int(before[b] - before[a])
            if weight > GROUP_BYTES:
                solve()
                group, weight = [], 0
        if group:
            solve()
        string, at = np.concatenate(string), np.concatenate(at)
        at = at[np.argsort(string, kind="stable")]
        times = np.bincount(string, minlength=len(which))
        first = np.cumsum(times) - times
        mine = np.flatnonzero((doc[rows] == holder[index]) & (times[index] > 0))
        each = times[index[mine]]
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        begin = np.repeat(start[rows[mine]], each) + at[np.repeat(first[index[mine]], each) + nth]
        out.append((np.repeat(doc[rows[mine]], each), begin, begin + scheme.window))
        found = [np.concatenate([part[k] for part in out]).astype(np.int64) for k in range(3)]
        ids, blobs = _by_doc(*found)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "spans": pa.array(blobs, pa.binary())})

    rows = docs.filter("doc_id is not null").mapInArrow(packed, "shard long, bale binary")
    return rows.groupBy("shard").applyInArrow(resolved, "doc_id long, spans binary")


def _united(parts: list[bytes], size: int) -> list[list[int]]:
    """The spans of all parts, within the document, united where they touch."""
    pairs = np.minimum(np.frombuffer(b"".join(parts), dtype=np.int32).reshape(-1, 2), size)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return merged(pairs[:, 0], pairs[:, 1]).tolist()


def remove(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, n_units, n_removed, n_spans, rest of every row; docs has doc_id and text."""
    spark = docs.sparkSession
    found = keep(spans(docs, scheme), "spans")
    seen = bitmap_of(found, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").cast(pa.large_binary()), batch.column("parts"), strict=True):
                size, held = scheme.rest(text.as_py() or b"")
                gone = _united(parts.as_py(), size) if parts.is_valid else []
                edges = [0, *(x for span in gone for x in span), size]
                kept = [[a, b] for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]
                rows.append((size, sum(b - a for a, b in gone), len(gone), held(kept)))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["doc_id", "n_units", "n_removed", "n_spans", "rest"],
            )

    schema = "doc_id long, n_units long, n_removed long, n_spans long, rest binary"
    maybe = F.coalesce(has_key(spark, seen, F.col("doc_id")) & F.col("doc_id").isNotNull(), F.lit(False))
    whole = docs.filter(~maybe).select("doc_id", "text", F.lit(None).cast("array<binary>").alias("parts"))
    lists = found.groupBy("doc_id").agg(F.collect_list("spans").alias("parts"))
    hit = docs.filter(maybe).join(lists, "doc_id", "left").select("doc_id", "text", "parts")
    return whole.mapInArrow(cut, schema).union(hit.mapInArrow(cut, schema))
