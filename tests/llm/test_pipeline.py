"""The stages of the pipeline, each on all that its predecessor kept, against plain Python; and on awkward rows."""

import re

import pytest

import corpus_pipeline
from floorwatch.llm import quality
from floorwatch.llm.packing import encoder
from floorwatch.llm.tables import keep, read

SF = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def results(spark):
    """(docs before the stage, result) by stage."""
    docs, out = read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = keep(stage(spark, docs, SF), name)
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"
    ]


def test_quality_rules_keep_what_the_operator_keeps(results):
    before, after = results["quality_rules"]
    judged = quality.assess(before).select("doc_id", "quality.kept", "quality.clean_text").collect()
    assert texts(after) == {r["doc_id"]: r["clean_text"] for r in judged if r["kept"]}
    assert after.columns == before.columns
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_line_dedup_only_takes_lines_out(results):
    before, after = (texts(df) for df in results["line_dedup"])
    assert before.keys() == after.keys()
    for doc_id, text in after.items():
        lines = iter(before[doc_id].split("\n"))
        assert all(any(line == other for other in lines) for line in text.split("\n") if line)


def test_near_dedup_leaves_one_of_each_group(results):
    before, after = (texts(df) for df in results["near_dedup"])
    sets = {}
    for doc_id, text in before.items():
        words = re.findall("[^\x20\x09-\x0d]+", lower(text))
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ordered = sorted(sets)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert after.keys() == {d for d in sets if root(d) == d}


def test_decontamination_drops_what_holds_a_window(spark, results):
    before, after = (texts(df) for df in results["decontamination"])

    def words(text):
        return [w for w in re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text).encode())]

    windows = set()
    for row in read(spark, SF, "benchmark").collect():
        item = words(row["text"])
        windows |= {tuple(item[i : i + 10]) for i in range(max(1, len(item) - 9))} if item else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        own = words(text)
        return any(tuple(own[i : i + n]) in windows for n in sizes for i in range(len(own) - n + 1))

    assert after.keys() == {d for d, text in before.items() if not hit(text)}


def test_packing_places_every_token_once(results):
    before, pieces = results["best_fit_packing"]
    encode = encoder("byte_bpe_50k")
    want = {d: len(encode(text or "")) + 1 for d, text in texts(before).items()}
    got, places = {}, {}
    for r in pieces.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_stages_on_awkward_rows(spark):
    good = " ".join(f"first{i} second{i} third{i} fourth{i}." for i in range(30))
    rows = [
        (1, None, "en", "a", 0, "x"), (2, "", "en", "a", 0, "x"), (3, good, "en", "a", 0, "x"), (4, good, "en", "a", 0, "y"),
        (5, "short", None, None, None, None), (None, good + " But a different end.", "en", "a", 0, "x"),
        (6, "long " * 3000 + good, "en", "a", 0, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans"]
        kept[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert kept["quality_rules"] == [3, 4, None]
    # the second copy has lost its only line, and an empty text is linked with nothing
    assert {r["doc_id"]: bool(r["text"]) for r in docs.collect()}[3] and kept["decontamination"] == [3, 4, None]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
