"""Benchmark decontamination: one Aho-Corasick automaton over windows of the items, one scan of every text.

Items and texts are normalised alike: A-Z in lower case, everything but letters, digits and bytes beyond ASCII between
words is one space. A pattern is `words` consecutive words of an item, or a shorter item as a whole, with a space before
and after, so that it only matches whole words. A match gives words of the normalised text, whose offsets in the
original text are known. There is no shuffle: the automaton goes to the documents.

The items go to every task, so they are cut into blocks of at most BLOCK_BYTES of patterns' text. A batch of documents
is scanned with one block after the other and the hits are united, so more items cost time, not memory.

Null or empty texts have no words and no hits; null or empty items match nothing; an item whose id is null counts as
the item 'null'; repeated items count once per item_id; repeated documents are separate rows with equal results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.llm.words import ALNUM, chunks, words_of

#: Consecutive words of an item that make a window.
WINDOW = 10

#: Bytes of item text in one automaton; its nodes take about 40 times as much for each word of a window.
BLOCK_BYTES = 1 << 20

#: A-Z to lower case, what is in no word to a space.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if ALNUM[b] else 32 for b in range(256))

SPANS = "array<struct<start:int,end:int>>"


def normal(text: str) -> list[bytes]:
    """Words of an item."""
    return text.encode().translate(_TABLE).split()


class Matcher:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            found = normal(text)
            for i in range(max(1, len(found) - window + 1) if found else 0):
                owners.setdefault(b" " + b" ".join(found[i : i + window]) + b" ", set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, who in owners.items():
            self.automaton.add_word(pattern.decode("latin-1"), (len(pattern), frozenset(who)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def hits(self, text: str) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(first byte, end, items) of every pattern in a normalised text, its outer spaces left out."""
        if not self.empty:
            for last, (size, who) in self.automaton.iter(text):
                yield last - size + 2, last, who


_built: dict[str, Matcher] = {}


def _matcher(name: str, block: Broadcast, window: int, only: bool) -> Matcher:
    """Built once per Python worker if there is one block, else when it is its turn."""
    if only and name in _built:
        return _built[name]
    _built.clear()
    matcher = Matcher(block.value, window)
    if only:
        _built[name] = matcher
    return matcher


def blocks_of(
    spark: SparkSession, items: DataFrame, item_id: str = "item_id", text: str = "text"
) -> list[tuple[str, Broadcast]]:
    """The items in blocks of bounded size, each named and sent to the tasks."""
    out, block, size = [], [], 0

    def send() -> None:
        out.append((uuid.uuid4().hex, spark.sparkContext.broadcast(block)))

    for row in items.select(item_id, text).toLocalIterator():
        if row[1]:
            block.append((str(row[0]) if row[0] is not None else "null", row[1]))
            size += len(row[1])
        if size >= BLOCK_BYTES:
            send()
            block, size = [], 0
    if block:
        send()
    return out


def scan(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_hit, items (sorted ids) and spans, the hit words' bytes in the original UTF-8 text.

    A column of docs that has one of these names is replaced.
    """
    added = ("n_words", "n_hit", "items", "spans")
    row = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    carried = docs.select(F.struct(*row).alias("row"), F.col(f"`{text}`").alias("text"))
    kind = carried.schema["row"].dataType.simpleString()
    found = _scanned(carried, f"row {kind}, n_words long, n_hit long, items array<string>, spans {SPANS}", items, window)
    return found.select("row.*", *added)


def _scanned(docs: DataFrame, schema: str, items: DataFrame, window: int) -> DataFrame:
    blocks = blocks_of(docs.sparkSession, items)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = words_of(batch.column("text"), ALNUM)
            data = words.data.tobytes().translate(_TABLE)
            found = [(set(), []) for _ in range(batch.num_rows)]
            for name, block in blocks:
                matcher = _matcher(name, block, window, len(blocks) == 1)
                for d in np.flatnonzero(words.counts):
                    at, end = words.bounds[d], words.bounds[d + 1]
                    normalised = b" " + b" ".join(data[at:end].split()) + b" "
                    for first, last, who in matcher.hits(normalised.decode("latin-1")):
                        found[d][0].update(who)
                        # the words before a match are as many as the spaces before it, less the leading one
                        found[d][1].append((first, last, normalised))
            n_hit, ids, spans = [], [], []
            for d, (who, places) in enumerate(found):
                hit = np.zeros(words.counts[d] + 1, dtype=np.int32)
                if places:
                    spaces = np.flatnonzero(np.frombuffer(places[0][2], dtype=np.uint8) == 32)
                    first = np.searchsorted(spaces, [p[0] for p in places]) - 1
                    last = np.searchsorted(spaces, [p[1] for p in places])
                    np.add.at(hit, first, 1)
                    np.add.at(hit, last, -1)
                covered = np.cumsum(hit[:-1]) > 0
                n_hit.append(int(covered.sum()))
                ids.append(sorted(who))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                base = words.first[d]
                spans.append(
                    [
                        {
                            "start": int(words.starts[base + a] - words.bounds[d]),
                            "end": int(words.ends[base + b - 1] - words.bounds[d]),
                        }
                        for a, b in zip(edges[::2], edges[1::2], strict=True)
                    ]
                )
            pieces = [
                batch.column("row"),
                pa.array(words.counts, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(ids, pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ]
            yield pa.RecordBatch.from_arrays(pieces, names=["row", "n_words", "n_hit", "items", "spans"])

    return docs.mapInArrow(results, schema)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without any hit, as they are, whatever their columns' names."""
    carried = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    kind = carried.schema["row"].dataType.simpleString()
    found = _scanned(carried, f"row {kind}, n_words long, n_hit long, items array<string>, spans {SPANS}", items, window)
    return found.filter("n_hit = 0").select("row.*")
