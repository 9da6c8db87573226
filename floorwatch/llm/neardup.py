"""Near duplicates by chosen paths: documents branch by minwise shingles until the nodes are small enough to compare.

A document is its set of `words` consecutive words, hashed to 64 bits. Documents with equal sets are one class from the
start, its smallest doc_id stands for it. Each of several trees puts every class into the node of one of its minwise
values. A node of at most LEAF classes is compared exhaustively, on full sets. A larger one branches: BRANCHES minwise
positions are chosen by the node, and each member goes to the child of its value there, so that alike members stay
together and others part; a pair may go on in more than one child. After DEPTH branchings a node that is still too
large is compared block by block, which is exact as well.

A pair at a threshold of 0.85 shares a first node in 85 % of the trees, and a branching keeps it with probability
1 - 0.15^2. So six trees miss it with a chance of 1 in 100,000, and in nodes that branch of 1 in 10,000. Other thresholds
have as many trees as that takes: eight at 0.80.

Full sets travel only for members whose minwise values agree with those of another member of the leaf in a third of the
positions. They travel to the leaves of the first two trees; to those of the others only where a leaf still holds two components.
Within a leaf a link between members that are connected already is left out, so that a leaf of n members yields at most
n - 1 links and components are those of all links.

Null or empty texts, and those without words, have no shingle and are linked with nothing. Rows with a null doc_id are
returned with null component_id and kept. Rows that repeat a doc_id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.graph import components
from floorwatch.llm.tables import bitmap_of, has_key, keep
from floorwatch.llm.words import chunks, grams, mix, powers, words_of

WORDS = 5
#: Links have 100 * intersection >= PERCENT * union, unless another percentage is asked for.
PERCENT = 85
#: Chance that a pair at the threshold shares a first node in no tree.
MISSED = 1.2e-5
POSITIONS = 16
BRANCHES = 2
DEPTH = 3
#: Trees that are compared in full; the others only where members of a node are not connected yet.
EARLY = 2
#: Minwise values that a member has to share with another one of its leaf before full sets travel. A pair at 0.85 shares
#: fewer with a chance of 1 in 5 million, one at 0.80 of 1 in 300,000.
AGREE = 5
#: Classes of a leaf, and shingles of all of them together.
LEAF = 2048
LEAF_SHINGLES = 4_000_000

SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, sketch array<long>"


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of all rows, sorted within each row, and their bounds by row."""
    found = words_of(texts, lower=True)
    every = grams(found.hashes, words)
    sets = []
    for d, n in enumerate(found.counts):
        at = found.first[d]
        if n >= words:
            sets.append(np.unique(every[at : at + n - words + 1]))
        elif n:
            whole = found.hashes[at : at + n] * powers(2 * n + 2)[1::2][:n]
            sets.append(mix(np.asarray([whole.sum(dtype=np.uint64) + np.uint64(n)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)), bounds


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Set size, two fingerprints of the set, and its minwise values under POSITIONS hash functions."""
    factors = mix(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64)) | np.uint64(1)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values, bounds = shingle_sets(batch.column("text"), words)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            heads = bounds[:-1][some]
            out = np.zeros((batch.num_rows, POSITIONS + 2), dtype=np.uint64)
            if len(some):
                out[some, 0] = np.add.reduceat(mix(values), heads)
                out[some, 1] = np.add.reduceat(mix(values ^ factors[0]), heads)
                for k in range(POSITIONS):
                    spread = values * factors[k]
                    spread ^= spread >> np.uint64(31)
                    spread *= factors[POSITIONS + k]
                    out[some, k + 2] = np.minimum.reduceat(spread, heads)
            flat = pa.array(out[:, 2:].ravel().view(np.int64))
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, POSITIONS, dtype=np.int32), flat)
            columns = [batch.column("doc_id"), pa.array(size)]
            columns += [pa.array(np.ascontiguousarray(out[:, i]).view(np.int64)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=["doc_id", "n_shingles", "f1", "f2", "sketch"])

    return docs.mapInArrow(sketched, SKETCH)


def full_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and its sorted shingles, eight bytes each."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values, bounds = shingle_sets(batch.column("text"), words)
            blobs = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(blobs, pa.binary())], names=["doc_id", "shingles"])

    return docs.mapInArrow(packed, "doc_id long, shingles binary")


def _sized(rows: DataFrame, label: str) -> DataFrame:
    """Rows of nodes that have company, with the number of members."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight")).filter("size > 1")
    return keep(rows.join(sizes, "node"), label)


def trees(percent: int) -> int:
    """How many trees a threshold takes, as far as there are positions."""
    return next((n for n in range(1, POSITIONS) if (1 - percent / 100) ** n <= MISSED), POSITIONS)


def leaves(classes: DataFrame, percent: int = PERCENT, wanted: tuple[int, ...] | None = None) -> DataFrame:
    """leaf, doc_id: groups whose members are to be compared with each other. classes: doc_id, n_shingles, sketch.

    `wanted` are numbers of trees, all by default.
    """
    wanted = tuple(range(trees(percent))) if wanted is None else wanted
    first = F.array(*(F.struct(F.lit(t).alias("tree"), F.get("sketch", F.lit(t)).alias("value")) for t in wanted))
    rows = classes.select("doc_id", "n_shingles", F.explode(first).alias("at")).select("doc_id", "n_shingles", "at.tree", "at.value")
    level = _sized(rows.select("doc_id", "n_shingles", F.xxhash64("tree", "value").alias("node")), "nodes")
    is_large = (F.col("size") > LEAF) | (F.col("weight") > LEAF_SHINGLES)
    done = level.filter(~is_large).select(F.col("node").alias("leaf"), "doc_id")
    for depth in range(1, DEPTH + 1):
        large = level.filter(is_large)
        if large.isEmpty():
            break
        if depth == DEPTH:
            done = done.union(_blocks(large))
            break
        position = lambda i: F.pmod(F.xxhash64("node", F.lit(i)), F.lit(POSITIONS))
        chosen = F.array_distinct(F.array(*(position(i) for i in range(BRANCHES))))
        rows = large.join(classes.drop("n_shingles"), "doc_id").select("doc_id", "n_shingles", "node", "sketch", F.explode(chosen).alias("at"))
        child = F.xxhash64("node", "at", F.get("sketch", F.col("at").cast("int")))
        level = _sized(rows.select("doc_id", "n_shingles", child.alias("node")), "nodes")
        done = done.union(level.filter(~is_large).select(F.col("node").alias("leaf"), "doc_id"))
    # the same members often meet in several trees; one leaf of each membership does
    members = done.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("who"))
    one = members.groupBy("n", "who").agg(F.min("leaf").alias("leaf")).select("leaf")
    return keep(done.join(one, "leaf", "left_semi"), "leaves")


def _blocks(large: DataFrame) -> DataFrame:
    """Members dealt into blocks of half a leaf, and a leaf for every two blocks."""
    number = F.ceil(F.greatest(F.col("size") / (LEAF // 2), F.col("weight") / (LEAF_SHINGLES // 2))).cast("int")
    own = F.pmod(F.xxhash64("doc_id", "node"), number)
    rows = large.select("doc_id", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), number - 1)).alias("other"))
    leaf = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(leaf.alias("leaf"), "doc_id")


def _root(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def compare(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between members of a leaf, as many as connect what all links connect."""
    order = np.argsort(ids, kind="stable")
    ids, sets = ids[order], [sets[i] for i in order]
    size = np.asarray([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(ids)), size)
    values = np.concatenate(sets)
    by_value = np.argsort(values, kind="stable")
    values, owner = values[by_value], owner[by_value]
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    tails = np.concatenate([heads[1:], [len(values)]])
    distinct = values[heads]
    parent = {i: i for i in range(len(ids))}
    links = []
    for i in range(len(ids) - 1):
        at = np.searchsorted(distinct, sets[i])
        lengths = tails[at] - heads[at]
        begin = np.repeat(heads[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        shared = np.bincount(owner[begin + np.arange(len(begin))], minlength=len(ids))[i + 1 :]
        enough = 100 * shared >= percent * (size[i] + size[i + 1 :] - shared)
        for j in np.flatnonzero(enough & (shared > 0)) + i + 1:
            a, b = _root(parent, i), _root(parent, int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return links


def _compared(table: pa.Table, percent: int) -> pa.Table:
    ids = table.column("doc_id").to_numpy()
    sets = [np.frombuffer(b.as_py(), dtype=np.uint64) for b in table.column("shingles")]
    links = np.asarray(compare(ids, sets, percent), dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})


def _company(table: pa.Table) -> pa.Table:
    """The members of a leaf whose minwise values agree with those of another one in AGREE positions or more."""
    values = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, POSITIONS)
    met = np.zeros(len(values), dtype=bool)
    for i in range(len(values) - 1):
        alike = np.flatnonzero((values[i + 1 :] == values[i]).sum(axis=1) >= AGREE) + i + 1
        met[alike] = True
        met[i] |= len(alike) > 0
    return table.select(["leaf", "doc_id"]).filter(pa.array(met))


def in_company(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """leaf, doc_id of the members that may be alike to another one of their leaf."""
    known = groups.join(classes.select("doc_id", "sketch"), "doc_id").select("leaf", "doc_id", "sketch")
    return keep(known.groupBy("leaf").applyInArrow(_company, "leaf long, doc_id long"), "company")


def _links(docs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """a, b: links within the groups leaf, doc_id, by the full sets of their members."""
    seen = bitmap_of(groups, "doc_id")
    wanted = docs.filter(F.col("doc_id").isNotNull() & has_key(docs.sparkSession, seen, F.col("doc_id")))

    def compared(table: pa.Table) -> pa.Table:
        return _compared(table, percent)

    links = groups.join(full_sets(wanted), "doc_id").groupBy("leaf").applyInArrow(compared, "a long, b long")
    return keep(links, "links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id) of every row."""
    mine = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = keep(sketches(mine), "sketches")
    some = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("class"))
    firsts = keep(
        some.join(classes.select(F.col("class").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select("doc_id", "n_shingles", "sketch").dropDuplicates(["doc_id"]),
        "classes",
    )
    count = trees(percent)
    early, late = tuple(range(EARLY)), tuple(range(EARLY, count))
    found = _links(mine, in_company(leaves(firsts, percent, early), firsts), percent)
    roots = components(found)
    if late:
        # Members that are one component already need no comparison with each other.
        groups = leaves(firsts, percent, late).join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        rooted = keep(groups.select("leaf", "doc_id", F.coalesce("component", "doc_id").alias("root")), "rooted")
        apart = rooted.groupBy("leaf").agg((F.min("root") != F.max("root")).alias("apart")).filter("apart").select("leaf")
        groups = in_company(rooted.join(apart, "leaf", "left_semi").select("leaf", "doc_id"), firsts)
        roots = components(found.union(_links(mine, groups, percent)))
    known = some.select("doc_id", "n_shingles", "f1", "f2").join(classes, ["n_shingles", "f1", "f2"])
    found = known.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class").alias("component_id")
    )
    alone = rows.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept: Column = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.union(alone).withColumn("kept", kept)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without those that a document with a smaller id stands for."""
    gone = near_duplicates(docs, doc_id, text, percent).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(doc_id) == F.col("_gone"), "left_anti")
