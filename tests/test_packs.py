import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from floorwatch.functions.text import clean_dimension, pack_hint, pack_size, sold_count, to_whole
from floorwatch.operators import packs

SIZES = [
    ("buy 2 get 1", 3.0),
    ("beli 3 gratis 1", 4.0),
    ("[free mug] buy 2", 2.0),
    ("[6 pcs]", 6.0),
    ("[ 6 pc ]", 6.0),
    ("6 pcs", 6.0),
    ("6 pcsx", 1.0),
    ("isi 3", 3.0),
    ("isi 0", 0.0),
    ("x2", 2.0),
    ("x 12", 12.0),
    ("max 500", 500.0),
    ("twinpack", 2.0),
    ("Twin Pack", 2.0),
    ("triplepack", 3.0),
    ("triple pack", 3.0),
    ("", 1.0),
    ("sachet", 1.0),
    ("buy 2 get 1 x 6", 3.0),
    (None, 1.0),
]


def test_pack_sizes(spark):
    df = spark.createDataFrame([(h, "soap", w) for h, w in SIZES], "h string, n string, want double")
    got = df.select("h", "want", pack_size(F.col("h"), F.col("n")).alias("got")).collect()
    assert [(r["h"], r["got"]) for r in got] == [(r["h"], r["want"]) for r in got]


def test_one_brand_does_not_count_by_isi(spark):
    df = spark.createDataFrame([("isi 3", "SariWangi teh isi 3")], "h string, n string")
    assert df.select(pack_size(F.col("h"), F.col("n"))).first()[0] == 1.0


@pytest.mark.parametrize(
    "name, mapped, hint",
    [
        ("Blue  Bolt x2", "blue  bolt", "x2"),
        ("Blue Bolt x2", None, "blue bolt x2"),
        ("Blue Bolt x2", " ", "blue bolt x2"),
        ("a Blue Bolt b Blue Bolt c", "BLUE BOLT", "a b c"),
        (None, "blue", None),
    ],
)
def test_pack_hint(spark, name, mapped, hint):
    df = spark.createDataFrame([(name, mapped)], "n string, m string")
    assert df.select(pack_hint(F.col("n"), F.col("m"))).first()[0] == hint


def test_effective_multiplier(spark):
    given = [None, math.nan, 0.0, -1.0, 2.0]
    df = spark.createDataFrame([(g, 7.0) for g in given], "Multiplier double, derivedMultiplier double")
    assert [r["Multiplier"] for r in packs.with_multiplier(df).collect()] == [7.0, 7.0, 7.0, 7.0, 2.0]


def test_flags(spark):
    cases = [(10.0, None), (10.0, math.nan), (10.0, 10.0), (9.9, 10.0), (None, 10.0)]
    df = spark.createDataFrame(cases, "finalPrice double, floor double")
    raw = df.select(packs.below_raw(F.col("floor"))).collect()
    assert [r[0] for r in raw] == [False, False, False, True, False]
    assert df.select(packs.below_raw(F.col("floor"), F.lit(0.0))).distinct().collect() == [(False,)]
    again = df.select(packs.below_floor(F.col("floor"))).collect()
    assert [r[0] for r in again] == [False, False, False, True, None]


def test_unit_prices(spark):
    df = spark.createDataFrame(
        [(6.0, 3.0, 2.0), (6.0, 3.0, 0.0), (6.0, 3.0, None)],
        "basePrice double, finalPrice double, Multiplier double",
    )
    got = [tuple(r)[:2] for r in packs.unit_prices(df).collect()]
    assert got == [(3.0, 1.5), (None, None), (6.0, 3.0)]


def test_filters(spark):
    sku = packs.EXCLUDED_PACKS[0][0]
    df = spark.createDataFrame(
        [
            (600000.0, sku, 2.0, "x"),
            (600000.0, sku, 3.0, "x"),
            (600000.0, None, 2.0, "x"),
            (600000.0, None, 3.0, "x"),
            (600001.0, "other", 2.0, "x"),
            (None, "other", 2.0, "x"),
            (1.0, "other", None, "get one FREE"),
            (1.0, sku, None, "bundle"),
            (1.0, "other", 2.0, None),
        ],
        "finalPrice double, SKUName string, derivedMultiplier double, packHintText string",
    )
    assert packs.price_cap(df).count() == 7
    kept = rows(packs.exclude_packs(df).select("SKUName", "derivedMultiplier"))
    assert kept == rows(
        spark.createDataFrame(
            [(sku, 3.0), (None, 3.0), ("other", 2.0), ("other", 2.0), ("other", None), ("other", 2.0)],
            "a string, b double",
        )
    )
    assert packs.drop_promos(df).count() == 6


def test_override_paths_agree(spark):
    facts = spark.createDataFrame(
        [
            ("shop", "SOAP", "soap x2", "x2", 2.0, 2.0),
            ("shop", "SOAP", "soap x2", "x2", 2.0, 2.0),
            ("SHOP ", "soap", "Soap X2", "X2", 2.0, 2.0),
            ("other", "SOAP", "soap x2", "x2", 2.0, 2.0),
            ("shop", None, "tea", "tea", 1.0, 1.0),
            ("shop", "SOAP", None, None, 1.0, 1.0),
        ],
        "account string, SKUName string, productName string, packHintText string,"
        " Multiplier double, derivedMultiplier double",
    )
    rules = spark.createDataFrame(
        [
            ("SOAP", "shop", "x2", 4.0),
            ("soap ", " Shop", "x2   ", 5.0),
            ("SOAP", "nowhere", "x2", 9.0),
        ],
        "`SKU NAME` string, Account string, ProductPattern string, Multiplier double",
    )
    matches = packs.override_matches(facts, rules)
    first = packs.first_override(matches)
    assert rows(first) == rows(packs.first_override_by_window(matches))
    by_steps = packs.apply_overrides(facts, first).select(*facts.columns)
    in_one = packs.override_rows(facts, rules).select(*facts.columns)
    assert rows(by_steps) == rows(in_one)
    assert rows(in_one.select("Multiplier")) == [(1.0,), (1.0,), (2.0,), (5.0,), (5.0,), (5.0,)]


def test_manual_rules(spark):
    sheet = spark.createDataFrame(
        [("A", "s", "x", "2"), ("A", "s", None, "2"), ("A", "s", "x", "two"), ("A", "s", "x", "NaN")],
        "`SKU NAME` string, Account string, ProductPattern string, Multiplier string",
    )
    assert rows(packs.manual_rules(sheet)) == [("A", "s", "x", 2.0)]


SOLD = [
    ("140.8K Terjual", 140800),
    ("235 Terjual", 235),
    ("1M Terjual", 1000000),
    ("2 m Terjual", 2000000),
    ("10K+ Terjual", None),
    ("5 terjual", None),
    ("1.2.3 Terjual", None),
    (None, None),
]


def test_sold_count(spark):
    df = spark.createDataFrame([(s,) for s, _ in SOLD], "s string")
    assert [r[0] for r in df.select(sold_count(F.col("s"))).collect()] == [w for _, w in SOLD]


def test_to_whole(spark):
    texts = ["5", " 5 ", "5.0", "5.5", "many", "", None, "9007199254740993", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(to_whole(F.col("s"))).collect()]
    assert got == [5, 5, 5, None, None, None, None, 9007199254740993, 1000]


def test_clean_dimension(spark):
    df = spark.createDataFrame(
        [("a", math.nan, 1), ("nan", 2.0, 2), ("", 3.0, 3), ("None", None, 4), (" ", 5.0, 5)],
        "t string, x double, `Unnamed: 3` int",
    )
    assert [tuple(r) for r in clean_dimension(df).collect()] == [
        ("a", None),
        (None, 2.0),
        (None, 3.0),
        (None, None),
        (None, 5.0),
    ]
