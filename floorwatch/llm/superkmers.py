"""Substring dedup on words by super-k-mers: each word covered by a window of 13 words that a smaller document has, goes.

Consecutive windows that share a minimiser travel as one packed string to its shard, where sorting their windows finds
equal ones exactly. How they meet, how frequent ones are split and what is sent is told in repeats.py.

Words are runs of bytes other than ASCII white space, unchanged. Null, empty and short texts have no window and lose
nothing. Rows with a null doc_id lose nothing and take nothing from others. Rows of one doc_id are one document, which
never repeats itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.repeats import Scheme, Units, remove
from floorwatch.llm.words import grams, words_of

WINDOW = 13
GRAM = 4


def _units(texts: pa.Array) -> Units:
    words = words_of(texts)
    raw = words.data.tobytes()
    spoken: list[bytes] = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        spoken += raw[a:b].split()
    wide = grams(words.hashes, WINDOW)
    return Units(
        grams(words.hashes, GRAM), words.first, lambda at, n: b" ".join(spoken[at : at + n]), lambda at: wide[at]
    )


def earliest(strings: list[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For each packed string, the least owner of each of its windows: all windows sorted, equal ones side by side."""
    out, rows = [], []
    for i, (string, owner) in enumerate(zip(strings, owners.tolist(), strict=True)):
        edges = [-1, *np.flatnonzero(np.frombuffer(string, dtype=np.uint8) == 32).tolist(), len(string)]
        number = len(edges) - WINDOW
        out.append(np.empty(number, dtype=np.int64))
        rows += [(string[edges[j] + 1 : edges[j + WINDOW]], owner, i, j) for j in range(number)]
    rows.sort()
    window = None
    for body, owner, i, j in rows:
        if body != window:
            window, first = body, owner
        out[i][j] = first
    return out


def _rest(text: bytes):
    words = text.split()
    return len(words), lambda kept: b" ".join([w for a, b in kept for w in words[a:b]])


SCHEME = Scheme(WINDOW, GRAM, _units, earliest, _rest)


def dedup_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept (the words left, joined by one space)."""
    mine = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = remove(mine, SCHEME)
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "n_spans", F.col("rest").cast("string").alias("kept"))
