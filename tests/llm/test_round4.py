"""What rows hold and what is worked out per row, where that decides whether large tables fit."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from floorwatch.llm import alignment, linedup, repeats, suffixes, superkmers
from floorwatch.llm.tables import discard, keep


def test_links_of_a_chunk_are_packed_and_come_back():
    rng = np.random.default_rng(4)
    places = [np.sort(rng.choice(13_000, 600, replace=False)) for _ in range(400)]
    at = np.concatenate(places)
    times = np.where(rng.random(len(at)) < 0.1, 3, 1).astype(np.int64)
    times[:5] = 254, 255, 256, 70_000, 1 << 40
    bounds = np.cumsum([0, *map(len, places)])
    links = alignment._packed(bounds, at, times)
    assert len(links) * 4 < bounds.nbytes + 4 * len(at) + times.nbytes
    for got, asked in zip(alignment._unpacked(links), (bounds, at, times), strict=True):
        assert got.tolist() == asked.tolist()
    none = np.zeros(0, dtype=np.int64)
    assert [x.tolist() for x in alignment._unpacked(alignment._packed(np.zeros(3, dtype=np.int64), none, none))] == [[0, 0, 0], [], []]


def test_rows_of_chunks_hold_no_array_over_all_documents_pairs(spark):
    texts = [(i, " ".join(f"word{j} of {i}" for j in range(200))) for i in range(200)]
    row = alignment.align(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).first()
    ids = sum(len(row[c]) for c in row.__fields__ if isinstance(row[c], list))
    assert ids <= 6 * len(texts) + 2 * len(row["pairs"])


def test_the_asked_file_is_loaded_where_it_is_needed_only():
    left = alignment.ByteLevel(alignment.A_NAME)
    ids = left.encode(" plain words").tolist()
    assert "plain" not in vars(left)
    assert left.plain.encode(" plain words", add_special_tokens=False).ids == ids


def test_spans_of_many_documents_are_merged_in_one_pass(monkeypatch):
    rng = np.random.default_rng(5)
    doc, start = rng.integers(-5, 300, 4000), rng.integers(0, 500, 4000)
    end = start + rng.integers(1, 9, 4000)
    monkeypatch.setattr(repeats, "merged", None)  # no call per document
    docs, blobs = repeats._by_doc(doc, start, end)
    found = {d: np.frombuffer(b, dtype=np.int32).reshape(-1, 2).tolist() for d, b in zip(docs, blobs, strict=True)}
    assert docs == sorted(set(doc.tolist()))
    for d, spans in found.items():
        covered = sorted({x for a, b in zip(start[doc == d].tolist(), end[doc == d].tolist(), strict=True) for x in range(a, b)})
        assert [x for a, b in spans for x in range(a, b)] == covered
        assert all(b < c for (_, b), (c, _) in zip(spans[:-1], spans[1:], strict=True))
    assert repeats._by_doc(*(np.zeros(0, dtype=np.int64),) * 3) == ([], [])


def test_spans_beyond_a_document_and_spans_that_touch():
    parts = [np.asarray([[0, 3], [8, 30]], dtype=np.int32).tobytes(), np.asarray([[3, 5], [40, 50]], dtype=np.int32).tobytes()]
    assert repeats._united(parts, 20) == [[0, 5], [8, 20]]
    assert repeats._united([], 20) == []
    size, held = suffixes.SCHEME.rest("äbc d".encode())
    assert (size, held([[0, 1], [3, 6]])) == (6, "äbc d".encode()[:1] + b"c d")
    size, held = superkmers.SCHEME.rest(b" a  b c\nd ")
    assert (size, held([[0, 1], [2, 4]])) == (4, b"a c d")


def test_counts_of_letters_leave_every_alike_pair(spark):
    rng = random.Random(6)
    words = ["the", "river", "ließ", "日本", "stone", "a", "canal", "élan", "mud", "harbour"]
    rows = []
    for i in range(600):
        a = " ".join(rng.choices(words, k=rng.randint(3, 40)))
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 10))):
            at = rng.randrange(len(b))
            b[at:at + 1] = rng.choice([[], [rng.choice("e ßx本")], [b[at], rng.choice("ta 日")]])
        other = " ".join(rng.choices(words, k=rng.randint(3, 40)))
        rows += [(2 * i, a, "".join(b)), (2 * i + 1, a, other)]
    pairs = spark.createDataFrame(rows, "id long, at string, bt string")
    sides = [linedup._counted(pairs.select("id", F.col(f"{s}t").alias("text")), s) for s in "ab"]
    allowed = F.floor(F.greatest(F.char_length("at"), F.char_length("bt")) * linedup.EDIT_PERCENT / 100)
    found = (
        pairs.join(sides[0], pairs.id == F.col("a")).join(sides[1], F.col("a") == F.col("b"))
        .select((F.levenshtein("at", "bt") <= allowed).alias("alike"), linedup._may_be_alike().alias("maybe")).collect()
    )
    assert len(found) == 1200
    assert all(r["maybe"] for r in found if r["alike"]) and sum(r["alike"] for r in found) > 500
    assert sum(r["maybe"] for r in found if not r["alike"]) < 200


def test_lines_that_share_words_only_are_not_paired_up(spark, monkeypatch):
    rng = random.Random(7)
    common = "zzcommon zzshared zzequal"
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = [common + " " + " ".join(rng.choice(letters) * rng.randint(5, 9) for _ in range(14)) for _ in range(60)]
    lines += [lines[0] + " x", lines[1] + " x"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    tested = []
    linked = linedup._linked

    def counted(pairs, texts):
        tested.append(pairs.count())
        return linked(pairs, texts)

    monkeypatch.setattr(linedup, "_linked", counted)
    monkeypatch.setattr(linedup, "TAKEN", 1)
    gone = linedup.dedup_lines(docs).filter("n_removed = 1")
    assert sorted(r["doc_id"] for r in gone.collect()) == [60, 61]
    assert tested[1] < 100


def test_only_kept_tables_are_discarded(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    kept = keep(given, "some table")
    folder = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(folder.replace("%20", " "))
    discard(kept)
    discard(given)
    assert not os.path.isdir(folder.replace("%20", " ")) and given.count() == 5
