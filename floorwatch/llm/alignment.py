"""Alignment of two tokenizers by diagonal run skipping, and how common each linked pair of ids is.

Both tokenizers cut the same bytes; offsets at which tokens of both end cut them into groups. Where tokens run one to one,
the end offsets of both lie on a diagonal: ends_a[i] = ends_b[i + shift]. From a place at which both end, a probe of a
few entries, then probes of twice, four times... as many compare the end arrays at the current shift and jump over the run. The first irregular
group is resolved step by step, always on the side that ends first, and gives the new shift.

1. Tasks encode and align whole texts, in chunks of about `CHUNK` bytes of text or one longer text. A chunk is one row: the results
   of its documents, their distinct linked pairs of ids, and for each distinct pair of the chunk in how many of its
   documents it is linked. So a pair that is everywhere moves once per chunk, not once per document. Which documents have
   which pairs is one packed value, an eighth of the arrays: rows of several MB each would fill an executor's heap.
2. These numbers are summed over all chunks, and the highest of every A id is found.
3. Each chunk gets the counts of its own pairs back and values its documents.

Links of a group are all its A tokens times all its B tokens; they are counted, not listed, so a group of very many tokens costs
only its distinct ids. Texts that are null, empty, or not given back byte by byte by both tokenizers have no tokens. Very long
texts are one chunk. Repeated rows and rows of one or a null doc_id are documents of their own, each counted. Ties for
the highest count all count as highest. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floorwatch.llm.tables import keep
from floorwatch.llm.words import chunks

A_NAME = "byte_bpe_50k"
B_NAME = "piece_bpe_32k.model"
#: Bytes of text of a chunk.
CHUNK = 2 << 20
#: Entries of the first probe of a run, compared one by one; wider probes compare slices.
PROBE = 32
#: Links of a group that are listed before equal ids are put together.
LISTED = 64

_loaded: dict[str, object] = {}


class Table:
    """Bytes of all tokens of a vocabulary, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.asarray([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def ends(self, ids: np.ndarray, text: bytes) -> np.ndarray | None:
        """Where each token ends in the text, None if the tokens do not give the text back."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids) or ends[-1] != len(text):
            return None
        at = np.arange(len(text)) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return ends if np.array_equal(self.data[at], np.frombuffer(text, dtype=np.uint8)) else None


class ByteLevel:
    """Ids and token lengths by the byte-level vocabulary; special tokens in a text are plain text."""

    def __init__(self, name: str):
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.name = name
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.tokens[number] = token
        self.table = Table(self.tokens)

    @cached_property
    def plain(self) -> Tokenizer:
        """The asked file itself; loaded only where it is needed."""
        found = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))
        found.encode_special_tokens = True
        return found

    def encode(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_ordinary(text), dtype=np.int64)
        except BaseException as panic:  # its pattern engine gives up on some endless runs of one character
            if type(panic).__name__ != "PanicException":
                raise
            return np.asarray(self.plain.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class Pieces:
    """Ids and token lengths by the piece vocabulary, which puts a space before each text itself."""

    def __init__(self, name: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        numbers = range(self.model.vocab_size())
        self.tokens = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)])
            if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in numbers
        ]
        self.table = Table(self.tokens)

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.model.encode(text, num_threads=1), dtype=np.int64)


def _load(kind: type, name: str):
    if name not in _loaded:
        _loaded[name] = kind(name)
    return _loaded[name]


def cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every group how many A tokens and how many B tokens lie before its end; both arrays end alike."""
    a, b = ends_a.tolist(), ends_b.tolist()
    n, m = len(a), len(b)
    first: list[int] = []  # A index of each run or irregular group's last token, the shift there, and the run's length
    shifts: list[int] = []
    sizes: list[int] = []
    i = shift = 0
    while i < n:
        start, end = i, min(n, m - shift)
        width = PROBE
        stop = min(end, i + width)
        while i < stop and a[i] == b[i + shift]:
            i += 1
        while i == stop < end:  # all alike so far: the next probe is twice as wide
            width *= 2
            stop = min(end, i + width)
            same = ends_a[i:stop] == ends_b[i + shift : stop + shift]
            i = stop if same.all() else i + int(same.argmin())
        if i > start:
            first.append(start)
            shifts.append(shift)
            sizes.append(i - start)
        if i < n:  # an irregular group
            j = i + shift
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            shift = j - i
            first.append(i)
            shifts.append(shift)
            sizes.append(1)
            i += 1
    size = np.asarray(sizes, dtype=np.int64)
    own = np.asarray(first, dtype=np.int64) - (np.cumsum(size) - size)
    in_a = np.arange(size.sum()) + np.repeat(own, size) + 1
    return in_a, in_a + np.repeat(np.asarray(shifts, dtype=np.int64), size)


_DIGITS = np.char.ljust(np.arange(100_000).astype("S5"), 5).view(np.uint8).reshape(-1, 5)


def written(ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> bytes:
    """All groups as a1,a2|b1;a3|b2,b3."""
    n_a, n_b = np.diff(in_a, prepend=0), np.diff(in_b, prepend=0)
    size = len(ids_a) + len(ids_b)
    ids, after = np.zeros(size, dtype=np.int64), np.full(size, ord(","), dtype=np.uint8)
    ids[np.arange(len(ids_a)) + np.repeat(in_b - n_b, n_a)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(in_a, n_b)] = ids_b
    after[in_a + in_b - n_b - 1] = ord("|")
    after[in_a + in_b - 1] = ord(";")
    cells = np.concatenate([_DIGITS[ids], after[:, None]], axis=1)
    return cells[(cells != ord(" ")) & (cells != 0)].tobytes()[:-1]


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs (A id << 32 | B id), sorted, and the number of links of each."""
    n_a, n_b = np.diff(in_a, prepend=0), np.diff(in_b, prepend=0)
    first_a, first_b = in_a - n_a, in_b - n_b
    many = n_a * n_b > LISTED
    few = ~many
    links = (n_a * n_b)[few]
    nth = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
    wide = np.repeat(n_b[few], links)
    a = ids_a[np.repeat(first_a[few], links) + nth // wide]
    b = ids_b[np.repeat(first_b[few], links) + nth % wide]
    pairs, counts = np.unique(a << 32 | b, return_counts=True)
    if not many.any():
        return pairs, counts
    found, numbers = [pairs], [counts]
    for g in np.flatnonzero(many):
        own_a, times_a = np.unique(ids_a[first_a[g] : in_a[g]], return_counts=True)
        own_b, times_b = np.unique(ids_b[first_b[g] : in_b[g]], return_counts=True)
        found.append((own_a[:, None] << 32 | own_b[None, :]).ravel())
        numbers.append((times_a[:, None] * times_b[None, :]).ravel())
    pairs, at = np.unique(np.concatenate(found), return_inverse=True)
    counts = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(counts, at, np.concatenate(numbers))
    return pairs, counts


_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK = (
    "chunk long, doc_id array<long>, "
    + "".join(f"{c} array<long>, " for c in _COLUMNS)
    + "groups_sha256 array<string>, links binary, pairs array<long>, docs array<long>"
)


def _packed(bounds: np.ndarray, at: np.ndarray, times: np.ndarray) -> bytes:
    """Three arrays in one value; places ascend within a document and most times are 1, so it is a small one."""
    steps = np.diff(at, prepend=0).astype(np.int32)
    small = np.minimum(times, 255).astype(np.uint8)
    sizes = np.asarray([len(bounds), len(at), (small == 255).sum()], dtype=np.int64)
    parts = (sizes, bounds.astype(np.int64), times[small == 255].astype(np.int64), steps, small)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in parts))


def _unpacked(links: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(links)
    n, m, wide = np.frombuffer(data, dtype=np.int64, count=3).tolist()
    longs = np.frombuffer(data, dtype=np.int64, count=n + wide, offset=24)
    steps = np.frombuffer(data, dtype=np.int32, count=m, offset=24 + 8 * (n + wide))
    times = np.frombuffer(data, dtype=np.uint8, count=m, offset=24 + 8 * (n + wide) + 4 * m).astype(np.int64)
    times[times == 255] = longs[n:]
    return longs[:n], np.cumsum(steps, dtype=np.int64), times


def _nested(parts: list) -> pa.ListArray:
    """One row that holds all of an array."""
    values = parts if isinstance(parts, pa.Array) else pa.array(parts)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def align(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME) -> DataFrame:
    """One row per chunk: its documents, their distinct pairs as places in the chunk's own list, documents of each pair.

    `links` holds bounds, at and times: pairs of document d are at[bounds[d]:bounds[d + 1]], with as many links as `times` says.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = _load(ByteLevel, a_name), _load(Pieces, b_name)
        number = TaskContext.get().partitionId() << 32
        for batch in chunks(_gathered(batches), limit=CHUNK):
            rows, hashes, pairs, times = [], [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                spaced = (" " + text).encode()
                a = left.encode(" " + text) if text else np.zeros(0, dtype=np.int64)
                b = right.encode(text) if text else a
                ends_a, ends_b = left.table.ends(a, spaced), right.table.ends(b, spaced)
                if ends_a is None or ends_b is None:
                    rows.append((0, 0, 0, 0))
                    hashes.append("")
                    pairs.append(np.zeros(0, dtype=np.int64))
                    times.append(pairs[-1])
                    continue
                in_a, in_b = cuts(ends_a, ends_b)
                rows.append((len(a), len(b), len(in_a), int((np.diff(in_a, prepend=0) * np.diff(in_b, prepend=0)).sum())))
                hashes.append(hashlib.sha256(written(a, b, in_a, in_b)).hexdigest())
                for found, part in zip((pairs, times), linked_pairs(a, b, in_a, in_b), strict=True):
                    found.append(part)
            own, at, held = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            counts = np.asarray(rows, dtype=np.int64)
            columns = [batch.column("doc_id"), *(np.ascontiguousarray(counts[:, i]) for i in range(4)), pa.array(hashes, pa.string())]
            links = _packed(np.cumsum([0, *map(len, pairs)]), at, np.concatenate(times))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), *map(_nested, columns), pa.array([links], pa.binary()), _nested(own), _nested(held)],
                names=["chunk", "doc_id", *_COLUMNS, "groups_sha256", "links", "pairs", "docs"],
            )
            number += 1

    return docs.mapInArrow(aligned, _CHUNK)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to the size of a chunk."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > CHUNK:
            yield _together(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield _together(held)


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, total (documents that hold it linked, corpus-wide), best (whether no pair of its A id has more)."""
    held = aligned.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("p.pairs", "p.docs")
    totals = keep(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("total")), "pairs")
    a = F.shiftright("pair", 32)
    highest = totals.groupBy(a.alias("a")).agg(F.max("total").alias("highest"))
    return totals.withColumn("a", a).join(highest, "a").select("pair", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))


_VALUED = "doc_id long, " + "".join(f"{c} long, " for c in _COLUMNS) + "n_best long, count_sum long, groups_sha256 string"


def _valued(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one chunk with the counts of their links."""
    row = {c: chunk.column(c).combine_chunks().flatten() for c in ("doc_id", *_COLUMNS, "groups_sha256")}
    place = counts.column("place").to_numpy()
    bounds, at, times = _unpacked(chunk.column("links")[0].as_py())

    def summed(name: str) -> pa.Array:
        values = np.zeros(len(place), dtype=np.int64)  # every pair of a chunk has its answer
        values[place] = counts.column(name).to_numpy()
        return pa.array(np.diff(np.concatenate([[0], np.cumsum(values[at] * times)])[bounds]))

    kept = {c: row[c] for c in ("doc_id", *_COLUMNS)}
    return pa.table(kept | {"n_best": summed("best"), "count_sum": summed("total"), "groups_sha256": row["groups_sha256"]})


def valued(aligned: DataFrame) -> DataFrame:
    """Per document its numbers, links of highest count and the sum of counts."""
    asked = aligned.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(aligned), "pair").select(F.col("chunk").alias("of"), "place", "total", "best")
    rows = aligned.drop("pairs", "docs")
    return rows.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_valued, _VALUED)


def align_tokenizers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_name: str = A_NAME, b_name: str = B_NAME) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    mine = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return valued(keep(align(mine, a_name, b_name), "aligned"))
