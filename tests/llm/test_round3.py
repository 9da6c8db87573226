"""Cross-tokenizer alignment, SimHash near duplicates and the conversation trie against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from floorwatch.llm import alignment, bytesim, prefixtrie, queries
from floorwatch.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def documents(spark, rows):
    """Documents with columns whose names operators use themselves."""
    wide = [(d, t, 1, "x", 2.0, d) for d, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, chunk int, list string, component double, fp long")


# --- cross-tokenizer alignment

ODD_TEXTS = [
    (1, None), (2, ""), (3, "a" * 3000), (4, "  two  spaces\n\n\ttab "), (5, "<|endoftext|> <s> </s> x"), (6, "日本語テキスト é▁x"),
    (7, " lead"), (8, "12345678901234567890"), (9, "\u0000\u0001 a"), (10, "한국어 문장입니다 ﬁ ½"), (None, "no id"), (7, " lead"),
    (12, "word " * 30_000), (13, "x" * 100_000),
]


def shown_bytes():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute_alignment(rows):
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown, cut, holds = shown_bytes(), [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
            bytes_a = [bytes(shown[c] for c in left.id_to_token(i)) for i in a]
            names = [right.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in names]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b = (np.cumsum([len(x) for x in parts]) for parts in (bytes_a, bytes_b))
                _, at_a, at_b = np.intersect1d(ends_a, ends_b, return_indices=True)
                groups = [
                    (a[i:j], b[k:m])
                    for i, j, k, m in zip([0, *at_a[:-1] + 1], at_a + 1, [0, *at_b[:-1] + 1], at_b + 1, strict=True)
                ]
        cut.append((doc_id, groups))
        holds.update({(x, y) for xs, ys in groups for x in set(xs) for y in set(ys)})
    highest = defaultdict(int)
    for (x, _), n in holds.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, groups in cut:
        links = Counter()
        for xs, ys in groups:
            for x, m in Counter(xs).items():
                for y, n in Counter(ys).items():
                    links[x, y] += m * n
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((
            doc_id, sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if holds[p] == highest[p[0]]), sum(n * holds[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def test_alignment_of_odd_texts(spark):
    assert rows_of(alignment.align_tokenizers(documents(spark, ODD_TEXTS))) == brute_alignment(ODD_TEXTS)


def test_alignment_over_many_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    monkeypatch.setattr(alignment, "CHUNK", 5000)
    assert rows_of(queries.op11_cross_tokenizer_alignment(spark, SF)) == brute_alignment([tuple(r) for r in docs.collect()])


def test_alignment_of_nothing(spark):
    assert alignment.align_tokenizers(documents(spark, [])).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=120), st.lists(st.integers(1, 3), min_size=1, max_size=120))
def test_cuts_are_the_common_ends(a, b):
    a, b = np.cumsum(a), np.cumsum(b)
    total = max(a[-1], b[-1])
    a, b = (np.append(x, total) if x[-1] < total else x for x in (a, b))
    common, at_a, at_b = np.intersect1d(a, b, return_indices=True)
    in_a, in_b = alignment.cuts(a, b)
    assert in_a.tolist() == (at_a + 1).tolist() and in_b.tolist() == (at_b + 1).tolist()


@pytest.mark.parametrize("length", [1, 7, 31, 32, 33, 95, 96, 97, 1000])
def test_long_runs_are_jumped(length):
    """A run, a group of two and one, and a run again."""
    a = np.arange(1, 2 * length + 3)
    b = np.delete(a, length)
    in_a, in_b = alignment.cuts(a, b)
    assert a[in_a - 1].tolist() == b.tolist() and in_b.tolist() == list(range(1, len(b) + 1))


# --- SimHash near duplicates

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly pack boxes of frozen jam and nobody hears"


def brute_simhash(rows, bits=4):
    prints = []
    for doc_id, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((doc_id, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    component = brute_components({p for _, p in prints}, bits)
    least = {}
    for doc_id, p in prints:
        known = [x for x in (least.get(component[p]), doc_id) if x is not None]
        least[component[p]] = min(known, default=None)
    return sorted(((d, f"{p:016x}", least[component[p]]) for d, p in prints), key=repr)


def brute_components(prints, bits=4):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    ordered = sorted(prints)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def op12(spark, docs):
    found = bytesim.near_duplicates(docs)
    return sorted(((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in found.collect()), key=repr)


def test_simhash_of_odd_texts(spark):
    rows = [
        (5, None), (3, ""), (9, " \n\t "), (4, "One"), (8, "one"), (6, "one two"), (7, "one  two\nthree"), (2, "ONE two three FOUR"),
        (1, PROSE), (10, PROSE.upper()), (11, PROSE + " indeed"), (12, "É" + PROSE), (None, PROSE), (None, "only here"), (1, PROSE),
        (13, "tall tale " * 40_000), (14, " ".join(["a"] * 5)),
    ]
    assert op12(spark, documents(spark, rows)) == brute_simhash(rows)


def test_simhash_of_nothing(spark):
    assert op12(spark, documents(spark, [])) == []


def test_simhash_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = sorted((tuple(r) for r in queries.op12_simhash_near_dedup(spark, SF).collect()), key=repr)
    assert found == brute_simhash([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("size", [2, 3, 4])
def test_four_positions_hold_a_set(size):
    sets = bytesim.position_sets(size)
    assert len(sets) == len(set(sets)) == {2: 7, 3: 20, 4: 70}[size]
    from itertools import combinations

    assert all(any(set(s) <= set(four) for s in sets) for four in combinations(range(8), 4))


@pytest.mark.parametrize(("size", "limit"), [(2, 1024), (2, 16), (3, 16), (4, 8)])
def test_groups_of_near_fingerprints(spark, monkeypatch, size, limit):
    """Chains, a dense group whose lists are far above the limit, two such groups one link apart, and strangers."""
    rng = np.random.default_rng(size)

    def flipped(p, n):
        for bit in rng.choice(64, n, replace=False):
            p ^= 1 << int(bit)
        return p

    centre = int(rng.integers(1 << 62))
    dense = {flipped(centre, n) for n in (1, 2, 3) for _ in range(50)}
    bridge = flipped(centre, 4)
    other = {flipped(flipped(bridge, 4), 2) for _ in range(60)}
    chain = [int(rng.integers(1 << 62))]
    for _ in range(40):
        chain.append(flipped(chain[-1], 4))
    prints = {centre, bridge} | dense | other | set(chain) | {int(rng.integers(1 << 63)) for _ in range(300)}
    monkeypatch.setattr(bytesim, "LIST", limit)
    df = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in bytesim.links(df, size=size).collect()]
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {p: root(p) for p in prints} == brute_components(prints)


def test_bits_beyond_the_guarantee(spark):
    with pytest.raises(ValueError, match="4 bits"):
        bytesim.links(spark.createDataFrame([(1,)], "fp long"), bits=5)


# --- conversation prefix trie


def brute_trie(rows):
    """rows: conv_id, turn, role, text in the order that ties take."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    rebuilt = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = own.get(conv - conv % 5, [])[:head] + turns[head:]
    nodes = defaultdict(list)
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            nodes[tuple(turns[:depth])].append(conv)
    children = Counter(path[:-1] for path in nodes if path)
    leaves, saved = Counter(), Counter()
    for path, convs in nodes.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted(
        (
            min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path)).encode()).hexdigest(),
        )
        for path, convs in nodes.items()
    )


def conversations(spark, rows):
    wide = [(*r, 1, "x", 2) for r in rows]
    return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, depth int, conv string, t1 long").repartition(5)


def talk(seed, convs=60, kinds=3):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in rng.choice(200, convs, replace=False).tolist():
        turns = rng.permutation(40)[: rng.integers(1, 14)].tolist()
        rows += [(conv, t, ("user", "assistant", None)[rng.integers(3)], (None, "", "ja", "né")[rng.integers(kinds)]) for t in turns]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_trie_against_brute_force(spark, seed):
    rows = talk(seed, kinds=1 + seed)
    assert sorted(rows_of(prefixtrie.prefix_trie(conversations(spark, rows))), key=lambda r: r[:2]) == brute_trie(rows)


def test_trie_with_null_turns_ids_and_repeated_rows(spark):
    rows = [
        (0, None, "user", "a"), (0, 1, None, None), (0, 2, "user", "b"), (3, 1, "user", "z"), (3, 1, "user", "z"), (8, 5, "user", "only"),
        (None, 1, "user", "nowhere"), (5, None, None, None), (7, 2, "user", "x" * 50_000), (-3, 1, "user", "below zero"),
    ]
    assert rows_of(prefixtrie.prefix_trie(conversations(spark, rows))) == sorted(brute_trie(rows), key=repr)


def test_trie_of_one_long_conversation_over_many_partitions(spark, monkeypatch):
    rows = [(c, t, "user", f"{t % 3}") for c in (10, 11, 12) for t in range(700 if c == 11 else 5)]
    monkeypatch.setattr(prefixtrie, "STRETCH", 16)
    monkeypatch.setattr(prefixtrie, "PACKED", 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(prefixtrie.prefix_trie(conversations(spark, rows))) == sorted(brute_trie(rows), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_nothing(spark):
    assert prefixtrie.prefix_trie(conversations(spark, [])).collect() == []


def test_unequal_turns_of_one_reference_are_noticed(spark):
    turns = spark.createDataFrame([(1, 1, "u", "a", 7, 7, 1), (2, 1, "u", "b", 7, 7, 1)], "conv long, turn long, role string, text string, t1 long, t2 long, bytes long")
    starts = turns.select("conv", "t1", "t2")
    assert not prefixtrie.references_hold(turns, starts)
    assert prefixtrie.references_hold(turns.filter("conv = 1"), starts)


def test_trie_in_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    found = queries.op13_conversation_prefix_trie(spark, SF)
    names = [d[0] for d in con.execute(ORACLE["op13_conversation_prefix_trie"]).description]
    assert rows_of(found.select(names)) == sorted(con.fetchall(), key=repr)
