"""Token counts by greedy longest match in linear time: a vocabulary trie with failure links and popped-token counts.

Where a word leaves the trie at node v, the longest-match tokens that surely come off the front of v's string are
precomputed as a number, and the failure link leads to the node of what is left. So each byte is read once and no
piece is ever built. All distinct words of a chunk walk through the trie side by side in numpy.

Words are runs of bytes other than ASCII white space, A-Z in lower case. The vocabulary's tokens are taken without their
end-of-word marks, so that any piece may stand anywhere in a word. A word that cannot be covered counts as one token. Null and empty texts have no words and no tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.words import chunks, words_of

VOCABULARY = "word_bpe_49k.json"
_WIDTH = 256


def vocabulary(name: str = VOCABULARY) -> list[tuple[int, ...]]:
    """Distinct tokens of the file as bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}  # the printable stand-ins of byte-level vocabularies
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(public_tokenizers.path(name)) as file:
        tokens = json.load(file)["model"]["vocab"]
    bodies = {token.removesuffix("</w>") for token in tokens}
    return sorted(tuple(shown[c] for c in body) for body in bodies if body and all(c in shown for c in body))


class Automaton:
    """keys (node * 256 + byte, sorted) and targets of the trie; per node its failure link (-1: none) and pops."""

    def __init__(self, tokens: Iterable[tuple[int, ...]]):
        children: list[dict[int, int]] = [{}]
        final = {0: False}
        for token in tokens:
            at = 0
            for symbol in token:
                if symbol not in children[at]:
                    children[at][symbol] = len(children)
                    children.append({})
                at = children[at][symbol]
            final[at] = True
        link, pops = np.full(len(children), -1), np.zeros(len(children), dtype=np.int64)
        level = [0]
        while level:
            for node in level:
                for symbol, child in children[node].items():
                    if final.get(child):
                        link[child], pops[child] = 0, 1
                        continue
                    back, popped = link[node], pops[node]
                    while back >= 0 and symbol not in children[back]:
                        popped, back = popped + pops[back], link[back]
                    if back >= 0:
                        link[child], pops[child] = children[back][symbol], popped
            level = [child for node in level for child in children[node].values()]
        edges = sorted((node * _WIDTH + s, child) for node, below in enumerate(children) for s, child in below.items())
        self.keys = np.asarray([k for k, _ in edges], dtype=np.int64)
        self.targets = np.asarray([t for _, t in edges], dtype=np.int64)
        self.link, self.pops = link, pops

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Children, -1 where there is none."""
        wanted = nodes * _WIDTH + symbols
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], -1)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word data[start:end]."""
        total = np.zeros(len(starts), dtype=np.int64)
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that those still walking are a prefix
        starts, sizes = starts[order], (ends - starts)[order]
        node = np.zeros(len(starts), dtype=np.int64)
        lost = np.zeros(len(starts), dtype=bool)
        count = np.zeros(len(starts), dtype=np.int64)
        for i in range(int(sizes[0]) if len(sizes) else 0):
            walking = int(np.searchsorted(-sizes, -i, side="left"))
            at = np.flatnonzero(~lost[:walking])
            symbol = data[starts[at] + i].astype(np.int64)
            while len(at):
                there = self.step(node[at], symbol)
                node[at[there >= 0]] = there[there >= 0]
                at, symbol = at[there < 0], symbol[there < 0]
                link = self.link[node[at]]
                lost[at[link < 0]] = True
                at, symbol, link = at[link >= 0], symbol[link >= 0], link[link >= 0]
                count[at] += self.pops[node[at]]
                node[at] = link
        at = np.flatnonzero(~lost)
        while len(at := at[node[at] > 0]):
            link = self.link[node[at]]
            lost[at[link < 0]] = True
            count[at] += self.pops[node[at]]
            node[at] = np.maximum(link, 0)
        total[order] = np.where(lost, 1, count)
        return total


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary(name)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = sent.value
        for batch in chunks(batches):
            words = words_of(batch.column("text"), lower=True)
            _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
            each = automaton.counts(words.data, words.starts[first], words.ends[first])[which]
            running = np.concatenate([[0], np.cumsum(each)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words.counts, pa.int64()),
                    pa.array(running[words.first[1:]] - running[words.first[:-1]], pa.int64()),
                ],
                names=["doc_id", "n_words", "n_tokens"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    mine = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mine.mapInArrow(counted, f"doc_id {kind}, n_words long, n_tokens long")
