"""Prefix trie of rebuilt conversations, by fingerprints that can be multiplied; no rebuilt text ever exists.

A rebuilt conversation is a head of another conversation (its base) and a suffix of its own turns. A run of turns has
as fingerprint the pair (number of turns n, sum of turn_i * M**(n - i) modulo 2**64), twice with different turn hashes.
Such pairs form a monoid: (n, a) * (m, b) = (n + m, a * M**m + b), and M has an inverse, so that the fingerprint of any
run follows from two of the beginnings of its conversation, and that of head * suffix from three numbers.

1. Turns are dealt by ranges of (conv_id, turn), so that one conversation may lie in many partitions. Each partition
   multiplies its own turns; the last run of every partition is all that the driver sees, to hand the product on to
   the partitions behind it.
2. Every rebuilt conversation and depth is a row of numbers. Rows of equal depth and fingerprint are a node; its
   smallest member owns it. The rows of a node must agree in the reference of their last turn and in their parent's
   fingerprint, and turns of one reference must have one role and text, compared as stored. If they don't, all is done
   again with other hashes. So nodes are exact, not likely.
3. A conversation owns the nodes of its own path from some depth down to its end: a chain. So a subtree is the rest of
   one chain, and the whole chains of all other members. Sums over subtrees are sums over members, without walking the
   tree level by level.
4. Ids that end at a node are sorted by range, packed into strings of at most `PACKED` ids and hashed in order as a stream.

Turns stand in the order of turn, null first; equal ones by role, then by a hash of the content; repeated rows are
repeated turns. Null role or text is empty, and an empty turn is a turn. Rows of null conv_id belong to no conversation
and are left out. Texts are only hashed where they lie, and compared where several are alike; their length does not
matter. An empty table has no node, not even a root. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorwatch.llm.tables import bitmap_of, has_key, keep
from floorwatch.llm.words import powers

#: Turns that a base may lend at most, and conversations of one base, as the contract fixes them.
HEAD = 8
FAMILY = 5
MULTIPLIER = int(powers(2)[1])
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
#: Depths of a chain that are summed in one group.
STRETCH = 256
#: Ids of one packed string.
PACKED = 8192
NODE = ["depth", "f1", "f2"]


def power(exponents: np.ndarray) -> np.ndarray:
    """M**exponent modulo 2**64."""
    out = np.ones(len(exponents), dtype=np.uint64)
    base = MULTIPLIER
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        out[(exponents >> bit & 1).astype(bool)] *= np.uint64(base)
        base = base * base % (1 << 64)
    return out


def _unsigned(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy().view(np.uint64) for n in names]


def _batch(**columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def hashed_turns(conversations: DataFrame, salt: int) -> DataFrame:
    """conv, turn, role, text, reference t1 and t2, bytes of the text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(F.lit(2 * salt), role, text).alias("t1"),
        F.xxhash64(F.lit(2 * salt + 1), text, role).alias("t2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and fingerprint of the turns of each conversation up to every row, as far as this partition holds it."""
    part = TaskContext.get().partitionId()
    conv, n, h = None, 0, [np.uint64(0), np.uint64(0)]
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield held
        own = batch.column("conv").to_numpy()
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        first = np.repeat(heads, np.diff(np.append(heads, len(own))))
        at = np.arange(len(own))
        pos = at - first + 1
        goes_on = (first == 0) & (own[0] == conv)
        out = []
        for lane, t in enumerate(_unsigned(batch, "t1", "t2")):
            total = np.concatenate([[np.uint64(0)], np.cumsum(t * powers(len(t), inverse=True), dtype=np.uint64)])
            runs = (total[1:] - total[first]) * powers(len(t))
            runs[goes_on] += h[lane] * power(pos[goes_on])
            out.append(runs)
        pos = pos + np.where(goes_on, n, 0)
        conv, n, h = own[-1], int(pos[-1]), [out[0][-1], out[1][-1]]
        held = _batch(
            part=np.full(len(own), part, dtype=np.int32),
            conv=own, n=pos, l1=out[0], l2=out[1], t1=batch.column("t1"), t2=batch.column("t2"), bytes=batch.column("bytes"),
            last=np.zeros(len(own), dtype=bool),
        )
    if held is not None:
        last = np.arange(held.num_rows) == held.num_rows - 1
        yield held.set_column(held.num_columns - 1, "last", pa.array(last))


def _handed_on(local: DataFrame) -> DataFrame:
    """For each partition the product that reaches it from those before it; one row per partition."""
    ends = local.filter("last").select("part", "conv", "n", "l1", "l2").orderBy("part").collect()
    size, rows, run = 1 << 64, [], None
    for end in ends:
        if run:
            rows.append((end.part, *(x - size if x >= size // 2 else x for x in run)))
        if run and run[0] == end.conv:
            step = pow(MULTIPLIER, end.n, size)
            run = (end.conv, run[1] + end.n, (run[2] * step + end.l1) % size, (run[3] * step + end.l2) % size)
        else:
            run = (end.conv, end.n, end.l1 % size, end.l2 % size)
    schema = "part int, conv long, before long, b1 long, b2 long"
    return local.sparkSession.createDataFrame(rows, schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of a partition behind those that were handed on to it."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        step = power(n)
        l1, l2, b1, b2 = _unsigned(batch, "l1", "l2", "b1", "b2")
        yield _batch(
            conv=batch.column("conv"), pos=n + batch.column("before").to_numpy(), p1=b1 * step + l1, p2=b2 * step + l2,
            t1=batch.column("t1"), t2=batch.column("t2"), bytes=batch.column("bytes"),
        )


def beginnings(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), fingerprint p1, p2 of the turns up to pos, reference and bytes of the turn at pos."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("t1"), F.col("t2")]
    dealt = turns.drop("text").repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "role")
    local = keep(
        dealt.mapInArrow(
            _products,
            "part int, conv long, n long, l1 long, l2 long, t1 long, t2 long, bytes long, last boolean",
        ),
        "turns",
    )
    reached = local.drop("last").join(F.broadcast(_handed_on(local)), ["part", "conv"], "left").fillna(0, ["before", "b1", "b2"])
    return reached.mapInArrow(_whole, "conv long, pos long, p1 long, p2 long, t1 long, t2 long, bytes long")


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of a base's head times the run of own turns after the own head, and those of their parents."""
    for batch in batches:
        length = batch.column("length").to_numpy()
        behind = batch.column("pos").to_numpy() - batch.column("head").to_numpy()
        depth = batch.column("lent").to_numpy() + behind
        step, out = power(behind), {}
        for lane in "12":
            p, t, b, o = _unsigned(batch, f"p{lane}", f"t{lane}", f"b{lane}", f"o{lane}")
            out[f"f{lane}"] = (b - o) * step + p
            out[f"u{lane}"] = (out[f"f{lane}"] - t) * np.uint64(INVERSE)
        yield _batch(
            conv=batch.column("conv"), depth=depth, f1=out["f1"], f2=out["f2"], u1=out["u1"], u2=out["u2"],
            t1=batch.column("t1"), t2=batch.column("t2"), bytes=batch.column("bytes"), ends=depth == length,
        )


def members(starts: DataFrame, base: Column, head: Column, limit: int = HEAD) -> DataFrame:
    """conv, depth, node f1 and f2, its parent u1 and u2, last turn t1, t2, bytes, ends, for each rebuilt conversation.

    base and head are columns over conv: whose turns come first, and how many of them, `limit` at most.
    """
    few = F.when(F.col("pos") <= limit, F.struct("pos", "p1", "p2", "t1", "t2", "bytes"))
    convs = keep(
        starts.groupBy("conv")
        .agg(F.max("pos").alias("n"), F.sort_array(F.collect_list(few)).alias("heads"))
        .select("conv", "n", "heads", base.cast("long").alias("base"), F.least(head, F.lit(limit)).cast("long").alias("head")),
        "conversations",
    )
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads"))
    lent = F.least("head", F.coalesce("base_n", F.lit(0)))

    def product(heads: str, size: Column, lane: str) -> Column:
        return F.coalesce(F.get(heads, (size - 1).cast("int"))[f"p{lane}"], F.lit(0))

    joined = convs.join(bases, "base", "left").withColumn("lent", lent)
    pairs = keep(
        joined.select(
            "conv", "head", "lent", "base_heads",
            (F.col("lent") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"),
            *(product("base_heads", F.col("lent"), i).alias(f"b{i}") for i in "12"),
            *(product("heads", F.least("head", "n"), i).alias(f"o{i}") for i in "12"),
        ),
        "rebuilt",
    )
    at = pairs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "lent")).alias("depth"))
    turn = F.get("base_heads", (F.col("depth") - 1).cast("int"))
    of_base = at.select(
        "conv", "depth",
        *(product("base_heads", F.col("depth"), i).alias(f"f{i}") for i in "12"),
        *(product("base_heads", F.col("depth") - 1, i).alias(f"u{i}") for i in "12"),
        *(F.coalesce(turn[c], F.lit(0)).alias(c) for c in ("t1", "t2", "bytes")),
        (F.col("depth") == F.col("length")).alias("ends"),
    )
    own = starts.filter(F.col("pos") > F.least(head, F.lit(limit))).join(pairs.drop("base_heads"), "conv").mapInArrow(
        _suffixes,
        "conv long, depth long, f1 long, f2 long, u1 long, u2 long, t1 long, t2 long, bytes long, ends boolean",
    )
    return of_base.union(own)


def nodes_of(rows: DataFrame) -> DataFrame:
    """Nodes with owner, members and parent; `agree` tells whether all members have one last turn and one parent."""
    same = ["u1", "u2", "t1", "t2", "bytes"]
    agree = F.lit(True)
    for c in same:
        agree = agree & (F.min(c) == F.max(c))
    return rows.groupBy(*NODE).agg(
        F.min("conv").alias("owner"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in same), agree.alias("agree")
    )


def references_hold(turns: DataFrame, starts: DataFrame) -> bool:
    """Whether turns of one reference have one role and text; only those that are alike move, once per task."""
    shared = keep(starts.groupBy("t1", "t2").count().filter("count > 1").select("t1"), "shared")
    alike = turns.filter(has_key(turns.sparkSession, bitmap_of(shared, "t1"), F.col("t1")))
    kinds = alike.select("t1", "t2", "role", "text").distinct().groupBy("t1", "t2").count()
    return kinds.filter("count > 1").isEmpty()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive ids of one node as strings."""
    for batch in batches:
        ids = batch.column("conv").to_numpy()
        key = np.stack([batch.column(c).to_numpy() for c in NODE], axis=1)
        heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(ids) else []
        bounds = sorted({*heads, *range(0, len(ids), PACKED), len(ids)})
        heads = np.asarray(bounds[:-1], dtype=np.int64)
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield _batch(**{c: key[heads, i] for i, c in enumerate(NODE)}, least=ids[heads], ids=pa.array(texts, pa.string()))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node from its strings in order."""
    node, digest = None, None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in NODE]
        for *key, ids in zip(*columns, batch.column("ids").to_pylist(), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        yield _ends(done)
    if node is not None:
        yield _ends([(*node, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*NODE, "ends_sha256"])


def ends_of(rows: DataFrame) -> DataFrame:
    """depth, f1, f2, ends_sha256 of nodes at which members end."""
    ends = rows.filter("ends").select(*NODE, "conv")
    packed = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(
        _packed, "depth long, f1 long, f2 long, least long, ids string"
    )
    return packed.repartition(*NODE).sortWithinPartitions(*NODE, "least").mapInArrow(
        _hashed, "depth long, f1 long, f2 long, ends_sha256 string"
    )


def _rest_of_chain(nodes: DataFrame) -> DataFrame:
    """Nodes with `rest`: what is saved from here to the end of the owner's chain, summed in stretches of depths."""
    stretch = F.floor(F.col("depth") / STRETCH)
    down = Window.partitionBy("owner", "stretch").orderBy(F.desc("depth"))
    inside = nodes.withColumn("stretch", stretch).withColumn("rest", F.sum("saved").over(down))
    sums = inside.groupBy("owner", "stretch").agg(F.sum("saved").alias("below"))
    later = Window.partitionBy("owner").orderBy(F.desc("stretch"))
    sums = sums.withColumn("below", F.sum("below").over(later) - F.col("below"))
    return inside.join(sums, ["owner", "stretch"]).withColumn("rest", F.col("rest") + F.col("below")).drop("stretch", "below")


def trie(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    up = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("f1"), F.col("u2").alias("f2"))
    children = up.agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("u1"), F.col("f2").alias("u2"), F.col("owner").alias("parent_conv_id")
    )
    own = (
        nodes.join(children, NODE, "left").join(parents, ["depth", "u1", "u2"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    )
    own = keep(own.select("owner", *NODE, "parent_conv_id", "n_convs", "n_children", "saved"), "own")
    chains = keep(
        own.groupBy("owner").agg(
            F.min("depth").alias("top"),
            F.sum("saved").alias("chain_saved"),
            F.max((F.col("n_children") == 0).cast("int")).alias("chain_leaf"),
        ),
        "chains",
    )
    # members other than the owner bring their whole chains, which begin further down
    others = rows.select("conv", *NODE).join(chains.withColumnRenamed("owner", "conv"), "conv").filter("depth < top")
    others = others.groupBy(*NODE).agg(F.sum("chain_saved").alias("more_saved"), F.sum("chain_leaf").alias("more_leaves"))
    found = (
        _rest_of_chain(own).join(chains.select("owner", "chain_leaf"), "owner")
        .join(others, NODE, "left").join(ends_of(rows), NODE, "left")
    )
    return found.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("chain_leaf") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("rest") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, base: Column | None = None, head: Column | None = None, limit: int = HEAD) -> DataFrame:
    """The trie of all rebuilt conversations; base and head are columns over `conv`, by default those of the contract."""
    conv = F.col("conv")
    base = conv - F.pmod(conv, F.lit(FAMILY)) if base is None else base
    head = F.pmod(F.crc32(conv.cast("string")), F.lit(limit + 1)) if head is None else head
    for salt in count():
        turns = hashed_turns(conversations, salt)
        starts = beginnings(turns)
        rows = keep(members(starts, base, head, limit), "members")
        nodes = keep(nodes_of(rows), "nodes")
        if references_hold(turns, starts) and nodes.filter("not agree").isEmpty():
            return trie(rows, nodes)
