"""Each operator against a brute-force version, and on awkward rows."""

import collections
import hashlib
import html
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from floorwatch.llm import (
    contamination, extraction, graph, linedup, neardup, packing, quality, queries, suffixes, superkmers, tokens, toxicity,
)

LONG = " ".join(f"word{i}" for i in range(60))
AWKWARD = [
    (1, None), (2, ""), (3, LONG), (3, LONG), (4, LONG + " tail"), (None, LONG), (5, "   \n\n\t"), (6, "x" * 300),
    (7, "x" * 300), (8, LONG.replace("word7 ", "wordy ")),
]
CLASHING = "doc_id long, text string, line string, id string, n long, _row int, key string, spans int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, "l", "i", 1, 2, "k", 3) for r in AWKWARD], CLASHING)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASHING)


class Roots(dict):
    def of(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.of(a), self.of(b)
        self[max(a, b)] = min(a, b)


def test_near_duplicates_are_those_of_brute_force(spark, sf_dir, texts):
    sets = {}
    for d, text in texts.items():
        w = words(lower(text))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    roots = Roots()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                roots.join(a, b)
    found = queries.op4_minhash_near_dedup(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == {
        d: (len(s), roots.of(d), roots.of(d) == d) for d, s in sets.items()
    }


def test_large_nodes_branch_and_fall_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 8)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:100], f"own{i}", *base[101:]])) for i in range(60)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found} == {0}


def test_the_pipeline_links_at_four_fifths(spark):
    w = [f"w{i}" for i in range(104)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:94], *(f"x{i}" for i in range(10))]))]  # 90 of 110 shingles: 0.82
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]
    assert neardup.keep_one(docs).count() == 2
    assert (neardup.trees(85), neardup.trees(80)) == (6, 8)


@pytest.mark.parametrize(("query", "window", "size"), [("op8_substring_dedup", 13, "n_words"), ("op5_suffix_array_dedup", 50, "n_bytes")])
def test_removed_windows_are_those_of_brute_force(spark, sf_dir, texts, query, window, size):
    cut = (lambda t: tuple(w.encode() for w in words(t))) if window == 13 else (lambda t: t.encode())
    glue = b" " if window == 13 else b""
    first, units = {}, {d: cut(t) for d, t in texts.items()}
    for d in sorted(units):
        for i in range(len(units[d]) - window + 1):
            first.setdefault(units[d][i : i + window], d)
    expected = {}
    for d, u in units.items():
        gone = np.zeros(len(u), dtype=bool)
        for i in range(len(u) - window + 1):
            if first[u[i : i + window]] < d:
                gone[i : i + window] = True
        rest = glue.join((x if window == 13 else bytes([x])) for x, g in zip(u, gone, strict=True) if not g)
        expected[d] = (len(u), int(gone.sum()), hashlib.sha256(rest).hexdigest())
    found = queries.QUERIES[query](spark, sf_dir).collect()
    assert {r["doc_id"]: (r[size], r["n_removed"], r["kept_sha256"]) for r in found} == expected


def test_suffix_order_is_that_of_sorting():
    rng = np.random.default_rng(7)
    for _ in range(150):
        text = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 300)), 0)
        expected = sorted(range(len(text)), key=lambda i, t=text: t[i:].tolist())
        assert suffixes.suffix_order(text, len(text)).tolist() == expected


def test_earliest_owner_of_each_window():
    rng = np.random.default_rng(3)
    pieces = [bytes(rng.integers(97, 100, 120).astype(np.uint8)) for _ in range(3)]
    strings = [pieces[0] + pieces[1], pieces[2] + pieces[0], pieces[1] + pieces[2]]
    owners = np.asarray([5, 2, 9])
    least = {}
    for s, o in zip(strings, owners, strict=True):
        for i in range(len(s) - 49):
            least[s[i : i + 50]] = min(o, least.get(s[i : i + 50], o))
    for s, got in zip(strings, suffixes.earliest(strings, owners), strict=True):
        assert got.tolist() == [least[s[i : i + 50]] for i in range(len(s) - 49)]


def test_hits_are_those_of_brute_force(spark, sf_dir, texts):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = collections.defaultdict(set)
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = cut(r["text"])
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(r["item_id"]))
    expected = {}
    for d, text in texts.items():
        w, hit, items = cut(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= owners
        expected[d] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
    found = queries.op6_benchmark_decontamination(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in found} == expected


def test_offsets_lead_to_the_original(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 1)  # every item in a block of its own
    docs = spark.createDataFrame([(1, "Sé -- A  b, C! end"), (2, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a B c"), (2, "sé"), (3, None)], "item_id long, text string")
    row = contamination.scan(docs, items).orderBy("doc_id").first()
    raw = row["text"].encode()
    assert [raw[s["start"] : s["end"]].decode() for s in row["spans"]] == ["Sé -- A  b, C"]
    assert row["items"] == ["1", "2"]
    assert [r["doc_id"] for r in contamination.decontaminate(docs, items).collect()] == [2]


def test_token_counts_are_greedy(spark, sf_dir, texts):
    known = set(tokens.vocabulary())
    longest = max(map(len, known))

    def greedy(word):
        at, n, symbols = 0, 0, tuple(word)
        while at < len(symbols):
            at += max(k for k in range(1, min(longest, len(symbols) - at) + 1) if symbols[at : at + k] in known)
            n += 1
        return n

    found = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in queries.op7_token_counts(spark, sf_dir).collect()}
    for d, text in list(texts.items())[:40]:
        w = [x.encode() for x in words(lower(text))]
        assert found[d] == (len(w), sum(map(greedy, w)))


def test_a_word_that_no_token_covers_is_one():
    automaton = tokens.Automaton([(97,), (97, 98, 99), (98,)])
    data = np.frombuffer(b"ababcz", dtype=np.uint8)
    assert automaton.counts(data, np.asarray([0, 0, 4]), np.asarray([2, 5, 6])).tolist() == [2, 3, 1]


def test_sequences_are_full_and_hold_the_ids(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op9_best_fit_packing(spark, sf_dir).collect():
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for d, text in texts.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces[d], key=lambda r: r["piece"]):
            part = np.asarray(ids[at : at + r["length"]], dtype="<u4")
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
        total += at
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-total // 2048) * 1.02 + 1


def test_encoder_agrees_on_special_strings():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("", "<|endoftext|> x<|endoftext|>", "  \n\n a", "x" * 5000, "\u00a0é\u2003"):
        assert packing.encoder(packing.VOCABULARY)(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_alike_lines_go_but_the_first(spark):
    line = "the quick brown fox jumps over the lazy dog near the old river bank " * 6
    rows = [(1, f"{line}\nshort"), (2, f"a\n{line.upper()}!!\n\nb"), (3, line.replace("fox", "fix", 1)), (4, "short\nshort!")]
    found = linedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = {r["doc_id"]: (r["text"], r["n_removed"]) for r in found.collect()}
    assert kept[1] == (rows[0][1], 0) and kept[2] == ("a\n\nb", 1) and kept[4] == ("", 2)
    assert kept[3][1] in (0, 1)  # one letter apart: removed if the SimHashes are close


def test_lines_alike_by_brute_force_are_found(spark):
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(3000)]
    lines = ["page number 12", "page number 13", "wonderful", "wonderfull", "wonderfull day", "wonderful day"]
    lines += ["ninety nine letters", "ninety nine letters a", "eightteen of them!", "eightteen of them it"]  # 19, 21, 17, 20
    for n in [*range(5, 61)] * 4:
        w = list(rng.choice(vocabulary, n))
        lines.append(" ".join(w))
        for kind in range(4):  # a word changed, a word put in, two letters changed, a tenth of the words changed
            v = list(w)
            for i in rng.choice(n, (1, 0, 2, max(1, n // 10))[kind], replace=False):
                v[i] = v[i][:-1] + "q" if kind == 2 else str(rng.choice(vocabulary))
            if kind == 1:
                v.insert(int(rng.integers(n)), str(rng.choice(vocabulary)))
            lines.append(" ".join(v))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    pairs = docs.alias("a").crossJoin(docs.alias("b")).filter("a.doc_id < b.doc_id").selectExpr(
        "a.doc_id as a", "b.doc_id as b", "a.text as at", "b.text as bt", "greatest(length(a.text), length(b.text)) div 10 as most"
    )
    pairs = pairs.filter("abs(length(at) - length(bt)) <= most and levenshtein(at, bt, cast(most as int)) >= 0")
    roots = Roots()
    for r in pairs.collect():
        roots.join(r["a"], r["b"])
    expected = {d for d in list(roots) if roots.of(d) != d}
    gone = {r["doc_id"] for r in linedup.dedup_lines(docs).filter("n_removed > 0").collect()}
    assert {1, 3, 5} <= gone  # 3: lines of 9 and 10 characters
    assert len(expected) > 500 and gone <= expected and len(gone) >= 0.99 * len(expected)


def test_lines_that_share_frequent_short_words_seldom_meet(spark):
    rng = np.random.default_rng(5)
    short = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(24)]
    lines = [[*rng.choice(short, 18, replace=False), *(f"{k:05d}x{i}" for k in range(6))] for i in range(300)]
    # of three long words in twenty, one changed: still found
    lines += [[*short[:17], f"first{i}", f"second{i}", f"third{i}{j}"] for i in range(40) for j in "ab"]
    rows = spark.createDataFrame([(i, [str(x) for x in w]) for i, w in enumerate(lines)], "id long, words array<string>")
    keys = {r["id"]: set(r["keys"]) for r in linedup.with_keys(rows).collect()}
    counts = collections.Counter(k for i in range(300) for k in keys[i])
    assert sum(n for n in counts.values() if n > 1) < 2 * 300
    assert all(keys[i] & keys[i + 1] for i in range(300, 380, 2))


def test_verdicts_hold_no_texts_of_dropped_documents(spark, monkeypatch):
    held = []
    monkeypatch.setattr(quality, "keep", lambda df, label: held.append(df) or df)
    quality.keep_good(spark.createDataFrame([(1, "too short")], "doc_id long, text string"))
    assert [(r["row"], r["kept"], r["clean"]) for r in held[0].collect()] == [(None, False, None)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(i, 0) for i in range(21)} | {(i, 100) for i in range(100, 120)}


def test_failed_lines_go_and_then_documents(spark):
    good = " ".join(f"plain{i} prose." for i in range(40))
    rows = [(1, good + "\nHome | News | About | Contact\nAll rights reserved"), (2, "$$$ ### &&& " * 60), (3, None)]
    found = {r["doc_id"]: r["quality"] for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["kept"] and found[1]["clean_text"] == good
    assert not found[2]["kept"] and not found[3]["kept"] and found[3]["clean_text"] is None


def test_article_of_marked_and_unmarked_pages():
    tree = extraction.Tree(*extraction.labelled())
    page = """<header><h1>Site</h1></header><nav><a href=x>Home</a></nav><article><h1>Head</h1><p><b>One &amp; t<i>w</i>o<br><p>Short.
    <div class="ad">Buy this now and save a lot of money today</div><p>Th&nbsp;ree</article><section class="comments"><p>I disagree
    with all of it, every single word of it</p></section><script>var x="</p>"</script><footer>c</footer>"""
    assert extraction.main_text(page, tree) == "Head One & two Short. Th ree"
    prose = "A paragraph of prose with a good many words in it that stands in no marked container at all."
    assert extraction.main_text(f"<body><ul><li><a>x</a><li><a>y</a></ul><p>{prose}<p>{prose}", tree) == f"{prose} {prose}"
    assert extraction.main_text("", tree) == "" and extraction.main_text("<<p<", tree) == ""


PROSE = "This long paragraph has quite a number of plain words that tell a story about nothing in particular until it stops."
SHAPES = {
    "marked": "<article>{}</article>",
    "page with a sidebar": '<div class="page with-sidebar"><article>{}</article><div class="sidebar">A word or two aside</div></div>',
    "no mark, with a sidebar": '<div class="with-sidebar"><div>{}</div><div class="sidebar"><p>A word or two aside</p></div></div>',
    "layout by its sidebar": '<div class="sidebar-layout">{}</div>',
    "main in a box with adverts": '<div class="has-ads"><main>{}</main></div>',
    "search results": '<div class="search-results"><article>{}</article></div>',
    "table cell and a teaser": '<table><tr><td>{}</td></tr></table><div class="teaser-entry">read on now</div>',
    "reader opinions": '<main>{}<div class="user-opinions"><p>I disagree with every word</p><p>%s</p></div></main>' % PROSE,
    "comments by their heading": "<main>{}<section><h2>3 Comments</h2><p>I disagree</p><p>%s</p></section></main>" % PROSE,
    "comments as articles": '<article>{}</article><div class="comments"><article>%s</article><article>%s</article></div>' % (PROSE, PROSE),
    "link list": "<article>{}<ul><li><a href=x>Buy now</a></li><li><a href=y>Sign in</a></li></ul></article>",
    "form around the page": '<form id="page"><div>{}</div></form>',
    "form in the article": "<article>{}<form><p>Have our letter sent to you</p><input></form></article>",
    "long notice": '<div class="cookie-notice"><p>%s</p><p>%s</p></div><div>{}</div>' % (PROSE, PROSE),
    "header of the article": "<header><h1>Site</h1><p>its motto</p></header><article><header>{}</header></article>",
    "named content": '<div id="content">{}</div><div id="sidebar"><h3>About</h3><p>%s</p></div>' % PROSE,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_articles_of_many_page_shapes(shape):
    page = SHAPES[shape].replace("{}", f"<h1>Head line</h1><p>{PROSE}</p><p>{PROSE}</p>")
    page = f'<nav><a href=x>Home</a></nav><div class="ad">Buy this now and save money today.</div>{page}<footer>&copy; a firm</footer>'
    tree = extraction.Tree(*extraction.labelled())
    assert extraction.main_text(f"<html><body>{page}</body></html>", tree) == f"Head line {PROSE} {PROSE}"


def test_awkward_pages(spark):
    long = "<article>" + f"<p>{PROSE}</p>" * 5000 + "</article>"
    rows = [(1, "a", None, 1), (1, "a", None, 1), (None, None, "", 2), (2, "b", long, 3), (3, "c", long[:90], 4), (4, "d", "<nav>x</nav>", 5)]
    kind = "page_id long, url string, html string, text int"
    found = extraction.extract(spark.createDataFrame(rows, kind)).collect()
    texts = {r["page_id"]: (r["text"], r["n_chars"]) for r in found}
    assert len(found) == 6 and texts[1] == texts[None] == texts[4] == ("", 0)
    assert texts[2] == (" ".join([PROSE] * 5000), len(PROSE) * 5000 + 4999)
    assert texts[3] == (long[12:90].strip(), len(long[12:90].strip()))
    assert extraction.extract(spark.createDataFrame([], kind)).collect() == []


def test_pages_give_their_articles(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op2_html_extraction(spark, sf_dir).collect():
        inner = re.sub(r"</?b>", "", pages[r["page_id"]].split("<article>")[1].split("</article>")[0])
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()) and r["n_chars"] == len(r["text"])


def test_toxic_words_are_learnt():
    rng = np.random.default_rng(0)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "mo", "ti", "lu", "se") for b in ("ren", "sol", "dip", "gan") for c in ("a", "et", "on")]
    make = lambda bad: " ".join(rng.choice(vocabulary, 60)) + " " + " ".join(rng.choice(["scumbag", "vermin"], 4) if bad else [])
    texts, labels = zip(*[(make(i % 4 == 0), int(i % 4 == 0)) for i in range(240)], strict=True)
    model = toxicity.fit(list(texts), list(labels))
    pair = model.dictionaries.compressors()
    new = [make(i % 2 == 0) for i in range(60)]
    scores = model.scores(np.asarray([toxicity.features(t, *pair) for t in new]))
    right = sum((s >= toxicity.THRESHOLD) == (i % 2 == 0) for i, s in enumerate(scores))
    assert right >= 54
    assert toxicity.fit(["a"], [1]) is None


def test_the_threshold_does_not_depend_on_the_sample():
    rng = np.random.default_rng(1)
    make = lambda y, n: np.column_stack([rng.normal(2.0 * y, 1, n) for _ in range(2)])
    good, bad = make(0, 8800), make(1, 1200)
    limits = []
    for n in (8800, 1200):  # all ordinary rows, then as many as toxic ones
        y = np.repeat([0.0, 1.0], [n, 1200])
        model = toxicity.calibrated(None, np.concatenate([good[:n], bad]), y, np.where(y == 1, 1, 8800 / n))
        limits.append((model.scores(np.concatenate([good, bad])) >= toxicity.THRESHOLD).sum())
    assert abs(limits[0] - limits[1]) < 0.15 * limits[0]


def test_rows_of_a_capped_class_stand_for_all(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 10)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    sample, weight = toxicity.sampled(docs, docs.selectExpr("doc_id", "int(doc_id < 20) as toxic"))
    assert weight == (4.0, 2.0) and sample.count() == 20


def test_toxic_words_at_the_end_of_long_texts_are_learnt(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "mo", "ti", "lu", "se") for b in ("ren", "sol", "dip", "gan") for c in ("a", "et", "on")]
    rows = [(i, " ".join(rng.choice(vocabulary, 4500)) + (" scumbag vermin" * 3 if i % 4 == 0 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, docs.selectExpr("doc_id", "int(doc_id % 4 = 0) as toxic"))
    assert b" scumbag " in model.dictionaries.toxic and b" vermin " in model.dictionaries.toxic
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert np.mean([found[i] for i in range(0, 60, 4)]) > 2 * np.mean([v for i, v in found.items() if i % 4])
    assert b" last " in b"".join(toxicity._pieces("word " * 5000 + "last"))


OPERATORS = {
    "passages": superkmers.dedup_passages,
    "substrings": suffixes.dedup_substrings,
    "near": neardup.near_duplicates,
    "lines": linedup.dedup_lines,
    "packing": packing.pack_documents,
    "tokens": tokens.count_tokens,
    "quality": quality.assess,
    "toxicity": lambda d: toxicity.score(d, None),
    "contamination": lambda d: contamination.scan(d, d.selectExpr("doc_id as item_id", "text")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_empty_tables(name, awkward, none):
    assert OPERATORS[name](awkward).count() == len(AWKWARD)
    assert OPERATORS[name](none).count() == 0


def test_stages_keep_the_columns(awkward):
    for stage in (quality.keep_good, neardup.keep_one):
        assert stage(awkward).columns == awkward.columns
