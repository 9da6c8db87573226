"""Toxicity by compression distance: windows of a text are compressed with a zstandard dictionary of toxic text and with
one of ordinary text, and the difference of the lengths tells which kind of text they are closer to.

Training, on a bounded sample of labelled rows (SAMPLE rows of each class in the order of a hash of their id). Their whole
texts are read by tasks, which count segments, draw samples and compute features; only these come to the driver:
- zstandard trains a dictionary on ordinary text. It gives both dictionaries their coding tables and common content.
- The last part of the content differs: segments (words and beginnings of words, with the space before) that are far
  more frequent in one class, by documents. So ordinary language compresses alike and only the difference counts.
- Thresholds are calibrated by cross-fitting: each third of the sample is compressed with dictionaries made of the other
  two, and a logistic function of the largest differences and the number of windows is fitted. It is shifted so that the
  best F1 is reached at a score of THRESHOLD. Both weight the sampled rows of a class by all its labelled rows, so that
  toxic text is as frequent as it is among the labels, whatever the size of the sample.

Scoring covers whole texts, window by window, and needs no shuffle. The model is a few kilobytes. Labels, language,
source and id are no inputs of a score. Null and empty texts have the score of a text without differences. Without
labelled rows of both classes nothing can be learnt, and all scores are 0.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.tables import keep

SAMPLE = 4000
WINDOW_BYTES = 48
DICTIONARY_BYTES = 6000
SEGMENT_BYTES = 1200
THRESHOLD = 0.7
#: Pieces of eight words of each ordinary text from which zstandard trains, evenly over the text.
PIECES = 38
#: Segments that are the common content at most, and those counted before a task hands them on.
COMMON = 2000
COUNTED = 200_000
FOLDS = 3

#: A segment is in this share of the documents of its class at least (and in three of them), and so many times as
#: frequent as in the other class. Rarer ones mark single documents and their copies rather than a class.
SEGMENT_SHARE = 0.05
SEGMENT_RATIO = 30

#: Characters at the ends of words that are no part of them.
ENDS = ".,;:!?\"'()[]"

#: How both dictionaries are applied: matches of four bytes, found through two hash tables.
SETTINGS = dict(
    window_log=14, hash_log=15, chain_log=14, search_log=1, min_match=4, strategy=zstandard.STRATEGY_DFAST,
    write_content_size=False, write_checksum=False, write_dict_id=False,
)


def words(text: str) -> list[str]:
    return [w for w in (x.strip(ENDS) for x in text.lower().split()) if w]


def windows(text: str) -> list[bytes]:
    """Whole words, WINDOW_BYTES or a little more at a time, all of the text."""
    data = (" " + " ".join(words(text)) + " ").encode()
    out, at = [], 0
    while at < len(data) - 1:
        end = data.find(b" ", min(len(data) - 1, at + WINDOW_BYTES))
        end = len(data) - 1 if end < 0 else end
        out.append(data[at : end + 1])
        at = end
    return out


def _segments(text: str) -> set[str]:
    """Each word and beginning of a word in the text."""
    mine = set()
    for w in set(words(text)):
        if len(w) >= 3:
            mine.add(f" {w} ")
        mine.update(f" {w[:n]}" for n in range(4, min(len(w), 9)))
    return mine


def _pieces(text: str) -> list[bytes]:
    """Eight words each, from everywhere in the text."""
    w = words(text)
    n = -(-len(w) // 8)
    starts = range(n) if n <= PIECES else np.linspace(0, n - 1, PIECES).astype(int)
    return [(" " + " ".join(w[8 * i : 8 * i + 8]) + " ").encode() for i in starts]


def _typical(mine: Counter, n: int, other: Counter, m: int) -> bytes:
    """The segments that tell a class from the other, the best last, where they are cheapest to refer to."""
    value = {}
    for s, k in mine.items():
        ratio = (k / n) / ((other[s] + 0.5) / m)
        if k >= max(3, SEGMENT_SHARE * n) and ratio >= SEGMENT_RATIO:
            value[s] = k / n * math.log(ratio)
    covered = {s for t in value for s in (t[:i] for i in range(5, len(t))) if s in value and value[t] > 0.7 * value[s]}
    best = sorted((v, s) for s, v in value.items() if s not in covered)
    return "".join(s for _, s in best).encode()[-SEGMENT_BYTES:]


class Dictionaries:
    """The two dictionaries as bytes."""

    def __init__(self, bad: Counter, n_bad: int, good: Counter, n_good: int, samples: list[bytes]):
        """bad, good: in how many texts of each class a segment is; samples: pieces of ordinary text."""
        special = _typical(bad, n_bad, good, n_good)
        usual = sorted((-k, s) for s, k in good.items())[:COMMON]
        common = "".join(s for _, s in usual[::-1]).encode()
        try:
            base = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little text
            base = common.rjust(DICTIONARY_BYTES)[-DICTIONARY_BYTES:]
        usual = common.rjust(len(special))[len(common) - len(special) if len(common) > len(special) else 0 :][: len(special)]
        cut = len(base) - len(special)
        self.toxic, self.ordinary = base[:cut] + special, base[:cut] + usual

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        how = zstandard.ZstdCompressionParameters(**SETTINGS)
        return tuple(
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=how)
            for d in (self.toxic, self.ordinary)
        )


def features(text: str, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> tuple[float, ...]:
    """The three largest differences, their counts, and the number of windows."""
    parts = windows(text)
    gains = np.zeros(max(3, len(parts)), dtype=np.int64)
    gains[: len(parts)] = [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in parts]
    top = np.sort(np.partition(gains, len(gains) - 3)[-3:])[::-1].astype(float)
    size = math.log1p(len(parts))
    many = [math.log1p(float((gains >= k).sum())) for k in (2, 3, 4)]
    return (*top, top[0] * size, top[1] * size, size, *many, float(np.maximum(gains, 0).sum()) / (1 + len(parts)))


@dataclass
class Model:
    dictionaries: Dictionaries
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(rows)), (rows - self.mean) / self.scale])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrated(dictionaries: Dictionaries, rows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """The model of these features; weight: how many labelled rows each one stands for."""
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    model = Model(dictionaries, mean, scale, np.zeros(rows.shape[1] + 1))
    x = np.column_stack([np.ones(len(rows)), (rows - mean) / scale])
    model.weights = _logistic(x, y, weight)
    order = np.argsort(-model.scores(rows), kind="stable")
    f1 = 2 * np.cumsum((weight * y)[order]) / (np.cumsum(weight[order]) + (weight * y).sum())
    best = int(f1.argmax())
    between = x[order[best : best + 2]] @ model.weights
    model.weights[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - between.mean()
    return model


def _folds(keys: list, labels: list[int]) -> dict | None:
    """The fold of each text; None unless both classes are left without any one fold."""
    fold = {k: i % FOLDS for i, k in enumerate(dict.fromkeys(keys))}
    held = [{fold[k] for k, v in zip(keys, labels, strict=True) if v == label} for label in (0, 1)]
    return fold if all(len(h) > 1 for h in held) else None


def _without(counts: dict, n: dict, pieces: dict, f: int) -> Dictionaries:
    """The dictionaries of all folds but f. By (label, fold): segments, texts; by fold: pieces of ordinary text."""
    others = [g for g in range(FOLDS) if g != f]
    both = [sum((counts.get((label, g), Counter()) for g in others), Counter()) for label in (1, 0)]
    many = [sum(n.get((label, g), 0) for g in others) for label in (1, 0)]
    return Dictionaries(both[0], many[0], both[1], many[1], [p for g in others for p in pieces.get(g, [])])


def fit(texts: list[str], toxic: list[int], weight: tuple[float, float] = (1, 1)) -> Model | None:
    """A model from labelled texts; None without both classes. Repeated texts count once for each of their labels.

    weight: how many labelled rows a text of each class stands for.
    """
    rows = list(dict.fromkeys(zip(texts, toxic, strict=True)))
    fold = _folds([t for t, _ in rows], [y for _, y in rows])
    if fold is None:
        return None
    counts, n, pieces = defaultdict(Counter), Counter(), defaultdict(list)
    for text, y in rows:
        counts[y, fold[text]].update(_segments(text))
        n[y, fold[text]] += 1
        if not y:
            pieces[fold[text]] += _pieces(text)
    pairs = [_without(counts, n, pieces, f).compressors() for f in range(FOLDS)]
    found = np.asarray([features(text, *pairs[fold[text]]) for text, _ in rows])
    y = np.asarray([y for _, y in rows])
    return calibrated(_without(counts, n, pieces, -1), found, y.astype(float), np.asarray(weight, dtype=float)[y])


def _counted(sample: DataFrame, fold: dict[int, int], n: Counter) -> dict[tuple[int, int], Counter]:
    """By label and fold, the segments that may become part of a dictionary, with their numbers of texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def taken() -> pa.RecordBatch:
            labels, folds, segments = zip(*found, strict=True)
            columns = [pa.array(labels, pa.int32()), pa.array(folds, pa.int32()), pa.array(segments, pa.string())]
            columns.append(pa.array(list(found.values()), pa.int64()))
            return pa.RecordBatch.from_arrays(columns, names=["toxic", "fold", "segment", "n"])

        for batch in batches:
            for text, y, key in zip(*(batch.column(c) for c in ("text", "toxic", "print")), strict=True):
                y, f = y.as_py(), fold[key.as_py()]
                found.update((y, f, x) for x in _segments(text.as_py()))
                if len(found) > COUNTED:
                    yield taken()
                    found.clear()
        if found:
            yield taken()

    rows = sample.select("text", "toxic", "print").mapInArrow(counted, "toxic int, fold int, segment string, n long")
    each = [(label, f) for label in (0, 1) for f in range(FOLDS)]
    sums = [F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"n{y}{f}") for y, f in each]
    table = keep(rows.groupBy("segment").agg(*sums), "segments")
    wanted = None
    for f in (-1, *range(FOLDS)):
        others = [g for g in range(FOLDS) if g != f]
        good, bad = (sum((F.col(f"n{y}{g}") for g in others), F.lit(0)) for y in (0, 1))
        least = max(3, SEGMENT_SHARE * sum(n[1, g] for g in others))
        some = table.filter(bad >= least).union(table.orderBy(good.desc(), "segment").limit(COMMON))
        wanted = some if wanted is None else wanted.union(some)
    counts: dict[tuple[int, int], Counter] = {k: Counter() for k in each}
    for r in wanted.distinct().collect():
        for y, f in each:
            if r[f"n{y}{f}"]:
                counts[y, f][r["segment"]] = r[f"n{y}{f}"]
    return counts


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, tuple[float, float]]:
    """(text, toxic, print of at most SAMPLE rows of each class, how many labelled rows each row of a class stands for)."""
    labels = labels.filter("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int")).dropDuplicates(["doc_id"])
    known = keep(docs.filter("text is not null").select("doc_id").join(labels, "doc_id").distinct(), "labelled")
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    first = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for y in (0, 1)]
    ids = F.broadcast(first[0].union(first[1]))
    rows = docs.filter("text is not null").select("doc_id", "text").join(ids, "doc_id")
    rows = rows.select("text", "toxic", F.xxhash64("text").alias("print")).dropDuplicates(["print", "toxic"])
    return keep(rows, "toxicity-sample"), tuple(max(1.0, count.get(y, 0) / SAMPLE) for y in (0, 1))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """From the rows of `labels` (doc_id, toxic), at most SAMPLE of each class, with their whole texts."""
    sample, weight = sampled(docs, labels)
    keys = sorted((r["print"], r["toxic"]) for r in sample.select("print", "toxic").collect())
    fold = _folds([k for k, _ in keys], [y for _, y in keys])
    if fold is None:
        return None
    n = Counter((y, fold[k]) for k, y in keys)
    counts = _counted(sample, fold, n)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([_pieces(t.as_py()) for t in batch.column("text")], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("print"), found], names=["print", "pieces"])

    pieces = defaultdict(list)
    ordinary = sample.filter("toxic = 0").select("text", "print").mapInArrow(drawn, "print long, pieces array<binary>")
    for r in sorted(ordinary.collect(), key=lambda r: r["print"]):
        pieces[fold[r["print"]]] += [bytes(p) for p in r["pieces"]]
    held = [_without(counts, n, pieces, f) for f in range(FOLDS)]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [d.compressors() for d in held]
        for batch in batches:
            keys = batch.column("print").to_pylist()
            found = [list(features(t.as_py(), *pairs[fold[k]])) for t, k in zip(batch.column("text"), keys, strict=True)]
            columns = [batch.column("print"), batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["print", "toxic", "features"])

    rows = sample.select("text", "print", "toxic").mapInArrow(described, "print long, toxic int, features array<double>").collect()
    rows.sort(key=lambda r: (r["print"], r["toxic"]))
    y = np.asarray([r["toxic"] for r in rows])
    found = np.asarray([r["features"] for r in rows])
    return calibrated(_without(counts, n, pieces, -1), found, y.astype(float), np.asarray(weight)[y])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        pair = model.dictionaries.compressors() if model else None
        for batch in batches:
            result = np.zeros(batch.num_rows)
            if model and batch.num_rows:
                result = model.scores(np.asarray([features(t.as_py() or "", *pair) for t in batch.column("text")]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(result)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, schema)
