"""Best-fit packing of tokenised documents into sequences, large items matched first.

Documents become ids and an end id; only longer ones than a sequence are cut, so that all pieces but the first are full.
What is packed are lengths, of which there are at most `capacity`: the counts per length go to the driver, are packed
there as groups of equal sequences, and each piece looks up its place by its rank among the pieces of its length. So
neither the driver nor any task holds the pieces, however many there are, and each piece moves once.

1. Pieces above a third of the capacity fit at most twice: from the largest down, each takes the largest fitting
   partner. No way with two per sequence needs fewer sequences.
2. Smaller ones, from the largest down, go to the sequence with the smallest gap that holds them, else to a new one.

A null text is empty and so is only the end id; repeated rows are packed as often as they come; null ids are packed too.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floorwatch.llm.tables import keep

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"

#: Pieces of one length and salt that are numbered in one task, about.
NUMBERED = 1_000_000

_encoders: dict[str, object] = {}


def encoder(name: str):
    """text -> ids, as the tokenizer file `name`.json gives them; the same vocabulary's ranks are faster to apply."""
    if name not in _encoders:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> np.ndarray:
            try:
                return np.asarray(fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
            except BaseException as panic:  # its pattern engine gives up on some endless runs of one character
                if type(panic).__name__ != "PanicException":
                    raise
                return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

        _encoders[name] = encode
    return _encoders[name]


def cut(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        end = np.asarray([END_ID], dtype="<u4")
        for batch in batches:
            rows, owner = [], []
            for d, value in enumerate(batch.column(1)):
                ids = np.concatenate([encode(value.as_py() or ""), end])
                start, stop = 0, len(ids) % capacity or capacity
                for piece in range(-(-len(ids) // capacity)):
                    owner.append(d)
                    rows.append((piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
                    start, stop = stop, stop + capacity
            columns = np.asarray(rows, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(columns[:, 0].astype(np.int32)),
                    *(pa.array(columns[:, i]) for i in (1, 2, 3)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, schema)


class Plan:
    """Runs of places: ranks first.. of a length, one to each sequence from `sequence` on, all at one offset."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.given = dict.fromkeys(counts, 0)
        self.runs: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap: groups of (first sequence, number)
        self.open: list[int] = []  # the gaps in order
        sizes = sorted((s for s, n in counts.items() if n), reverse=True)
        for size in sizes:
            (self.match if 3 * size > capacity else self.fit)(size)

    def place(self, size: int, sequence: int, number: int, offset: int) -> None:
        self.runs.append((size, self.given[size], sequence, offset))
        self.given[size] += number
        self.left[size] -= number

    def add(self, gap: int, sequence: int, number: int) -> None:
        if gap and number:
            if gap not in self.gaps:
                insort(self.open, gap)
                self.gaps[gap] = []
            self.gaps[gap].append((sequence, number))

    def start(self, number: int) -> int:
        first = self.sequences
        self.sequences += number
        return first

    def match(self, size: int) -> None:
        """Sequences for all pieces of a large size that have none yet, with their partners."""
        partner = min(size, self.capacity - size)
        while self.left[size]:
            while 3 * partner > self.capacity and self.left.get(partner, 0) < (2 if partner == size else 1):
                partner -= 1
            paired = 3 * partner > self.capacity
            number = self.left[size]
            if paired:
                number = number // 2 if partner == size else min(number, self.left[partner])
            first = self.start(number)
            self.place(size, first, number, 0)
            if paired:
                self.place(partner, first, number, size)
            self.add(self.capacity - size - partner * paired, first, number)

    def fit(self, size: int) -> None:
        """The smallest gap that holds the size takes as many as it can, then the next."""
        while n := self.left[size]:
            at = bisect_left(self.open, size)
            if at == len(self.open):
                self.add(self.capacity, self.start(max(1, number := n // (self.capacity // size))), max(1, number))
                continue
            gap = self.open[at]
            first, number = self.gaps[gap].pop()
            if not self.gaps[gap]:
                del self.gaps[gap], self.open[at]
            each = min(gap // size, n)
            used = min(number, n // each)
            for k in range(each):
                self.place(size, first, used, self.capacity - gap + k * size)
            self.add(gap - each * size, first, used)
            self.add(gap, first + used, number - used)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of cut() with sequence_id and offset. They should be a table, since they are read twice."""
    spark = pieces.sparkSession
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    runs = np.asarray(sorted(Plan(counts, capacity).runs), dtype=np.int64).reshape(-1, 4)
    sent = spark.sparkContext.broadcast(runs)
    salts = max(64, sum(counts.values()) // NUMBERED)

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    shares = salted.groupBy("length", "salt").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("own", own).join(shares.select("length", "salt", before.alias("before")), ["length", "salt"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = sent.value
        key = table[:, 0] << 48 | table[:, 1]
        at = np.searchsorted(key, length.to_numpy() << 48 | rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": table[at, 2] + rank.to_numpy() - table[at, 1], "offset": table[at, 3]})

    placed = ranked.withColumn("at", place("length", (F.col("own") + F.col("before")).cast("long")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(keep(cut(docs, capacity=capacity), "pieces"), capacity)
