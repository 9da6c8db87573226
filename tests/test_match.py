import random

from conftest import rows
from pyspark.sql import functions as F

from floorwatch.operators import match

SCHEMA = "SKUName string, ProductName string, Status string, Multiplier double"


def brute(names, mapping):
    plain = [(n, n.strip(" ").lower()) for n in names]
    return sorted(
        (n, m[1])
        for n, p in plain
        for m in mapping
        if m[1] is not None and m[1].strip(" ") and m[1].strip(" ").lower() in p
    )


def random_case(seed, letters="ab c%_\\é", mapped=60, names=200):
    pick = random.Random(seed)

    def word(low, high):
        return "".join(pick.choice(letters) for _ in range(pick.randint(low, high)))

    mapping = [(f"S{i}", word(1, 9), "Top 58", None) for i in range(mapped)]
    mapping += [("SB", " ", "Top 58", None), ("SN", None, "Top 58", None)]
    return sorted({word(1, 25) for _ in range(names)}), mapping


def test_pairs_equal_brute_force(spark):
    for seed, gram in ((1, 3), (2, 6), (3, 1)):
        names, mapping = random_case(seed)
        df = spark.createDataFrame([(n,) for n in names], "name string")
        dim = spark.createDataFrame(mapping, SCHEMA)
        want = brute(names, mapping)
        for limit in (1 << 30, 0):
            pairs = match.contains_pairs(df, dim, gram, limit).select("name", "mappedName")
            assert sorted(tuple(r) for r in pairs.collect()) == want


def test_rules_of_rank(spark):
    mapping = spark.createDataFrame(
        [
            ("EXACT", " Blue Bolt ", "Top 58", None),
            ("LONGER", "blue bolt x", "Top 58", None),
            ("LONG", "bolt", "Top 58", None),
            ("TIE B", "ring a", "Top 58", None),
            ("TIE A", "ring b", "Top 58", None),
            ("BLANK", "  ", "Top 58", None),
            ("WILD", "50%_x\\", "Top 58", None),
        ],
        SCHEMA,
    )
    names = ["BLUE BOLT", "big blue bolt x2", "old bolts", "ring a ring b", "tea", "50%_x\\ off", "50 ax b"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["SKUName"] for r in match.best_match(df, mapping).collect()}
    assert got == {
        "BLUE BOLT": "EXACT",
        "big blue bolt x2": "LONGER",
        "old bolts": "LONG",
        "ring a ring b": "TIE A",
        "tea": None,
        "50%_x\\ off": "WILD",
        "50 ax b": None,
    }


def test_empty_mapping(spark):
    names = spark.createDataFrame([("a",)], "name string")
    empty = spark.createDataFrame([], SCHEMA)
    assert match.contains_pairs(names, empty).count() == 0
    assert [tuple(r)[:3] for r in match.best_match(names, empty).collect()] == [("a", None, None)]


def test_exact_match_fans_out_and_reports_it(spark):
    mapping = spark.createDataFrame(
        [("A", "soap", "Top 58", None), ("B", "soap", "Top 58", None), ("C", "Tea", "Top 58", None)],
        SCHEMA,
    )
    facts = spark.createDataFrame([("soap",), ("tea",), (None,)], "productName string")
    got = match.match_exact(facts, mapping).select("productName", "SKUName")
    assert rows(got) == [("soap", "A"), ("soap", "B"), ("tea", None), (None, None)]
    assert rows(match.duplicate_names(mapping)) == [("soap", 2)]


def test_names_are_distinct_and_never_null(spark):
    facts = spark.createDataFrame([("a",), ("a",), (None,)], "productName string")
    assert rows(match.distinct_names(facts)) == [("a",)]
    matches = match.distinct_names(facts).withColumn("SKUName", F.lit("S"))
    assert rows(match.attach_matches(facts, matches)) == [("a", "S"), ("a", "S"), (None, None)]
