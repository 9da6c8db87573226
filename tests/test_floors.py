import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from floorwatch.config import STATIC_PERIODS, Period
from floorwatch.functions.dates import file_date, iso_year, week_columns
from floorwatch.operators import floors, track

FLOOR = "BFP Summary Minis"
FACTS = "SKUName string, Status string, week int, year int, productName string"


def tables(spark, rivals_priced=False, early=False, seed=0):
    pick = random.Random(seed)
    skus = [f"S{i}" for i in range(6)] + (["R0"] if rivals_priced else [])
    static = "`SKU NAME` string, `BFP Summary Minis` double"
    first = spark.createDataFrame([(s, pick.randint(1, 9) * 1.0) for s in skus if pick.random() < 0.8], static)
    second = spark.createDataFrame([(s, pick.randint(1, 9) * 1.0) for s in skus if pick.random() < 0.8], static)
    weeks = [(w, 2026) for w in range(6, 12)] + ([(30, 2025)] if early else [])
    weekly = spark.createDataFrame(
        [(s, float(w), w, y) for s in skus for w, y in weeks if pick.random() < 0.8],
        "`SKU NAME` string, `BFP Summary Minis` double, week int, year int",
    )
    rows_ = []
    for i in range(200):
        sku = pick.choice(["S0", "S1", "S2", "S7", "R0", None])
        status = None if sku is None else "Competitor" if sku == "R0" else "Top 58"
        week, year = pick.choice(
            [(20, 2025), (21, 2025), (5, 2026), (6, 2026), (9, 2026), (1, 2025), (53, 2024), (None, None)]
        )
        rows_.append((sku, status, week, year, f"p{i % 40}"))
    facts = spark.createDataFrame(rows_, FACTS)
    mapping = facts.select("SKUName", "Status").distinct().filter("SKUName IS NOT NULL")
    return facts, list(zip(STATIC_PERIODS, (first, second))), weekly, mapping


def test_single_pass_equals_union(spark):
    for seed, priced in ((1, False), (2, True)):
        facts, statics, weekly, _ = tables(spark, priced, early=True, seed=seed)
        union = floors.floor_union(facts, statics, weekly, FLOOR)
        for fits in (True, False):
            single = floors.floor_single_pass(facts, statics, weekly, FLOOR, fits=fits)
            assert rows(single.select(*union.columns)) == rows(union)


def test_overlapping_periods(spark):
    facts, statics, weekly, _ = tables(spark, early=True, seed=5)
    wide = [(Period("all", None, 202606), statics[0][1]), statics[1]]
    union = floors.floor_union(facts, wide, weekly, FLOOR)
    single = floors.floor_single_pass(facts, wide, weekly, FLOOR)
    assert rows(single.select(*union.columns)) == rows(union)


def test_range_equals_union_where_the_check_says_so(spark):
    for seed in (3, 4):
        facts, statics, weekly, mapping = tables(spark, seed=seed)
        assert floors.range_is_exact(mapping, statics, weekly, FLOOR)
        union = floors.floor_union(facts, statics, weekly, FLOOR)
        ranged = floors.floor_range(facts, statics, weekly, FLOOR).select(*union.columns)
        assert rows(track.final_view(union, FLOOR)) == rows(track.final_view(ranged, FLOOR))


def test_check_refuses_what_would_differ(spark):
    _, statics, weekly, mapping = tables(spark, rivals_priced=True, seed=2)
    assert not floors.range_is_exact(mapping, statics, weekly, FLOOR)
    _, statics, weekly, mapping = tables(spark, early=True, seed=1)
    assert not floors.range_is_exact(mapping, statics, weekly, FLOOR)


def test_period_edges(spark):
    df = spark.createDataFrame(
        [(2024, 53), (2025, 20), (2025, 21), (2026, 5), (2026, 6), (None, None)], "year int, week int"
    )
    first, second = [
        [(r["year"], r["week"]) for r in floors.period_filter(df, p).collect()] for p in STATIC_PERIODS
    ]
    assert first == [(2024, 53), (2025, 20)]
    assert second == [(2025, 21), (2026, 5)]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 29),)], "d date")
    week, year = week_columns(F.col("d"))
    assert tuple(df.select(week, year, iso_year(F.col("d"))).first()) == (1, 2025, 2026)
    texts = spark.createDataFrame([("",), ("250230",), ("250131",)], "t string")
    assert [r[0] for r in texts.select(file_date(F.col("t"))).collect()] == [None, None, dt.date(2025, 1, 31)]


def test_weeks(spark):
    sheet = spark.createDataFrame([("A", 1.0)], "`SKU NAME` string, p double")
    assert floors.refresh_weekly(sheet, None, dt.date(2026, 1, 15)).count() == 0
    grown = floors.refresh_weekly(sheet, None, dt.date(2026, 2, 12))
    assert rows(grown.select("week", "year")) == [(6, 2026), (7, 2026)]
    dearer = sheet.withColumn("p", F.lit(2.0))
    later = floors.refresh_weekly(dearer, grown, dt.date(2026, 2, 19))
    assert rows(later.select("week", "p")) == [(6, 1.0), (7, 1.0), (8, 2.0)]
    assert rows(floors.historical_floors(sheet, "Q1", 2025)) == [("A", 1.0, "Q1", 2025)]


def range_join(facts, statics, weekly):
    """The period lookup as a plain join over ranges of weeks."""
    yw = F.col("year") * 100 + F.col("week")
    parts = [
        t.select(floors.SKU, F.lit(p.from_yw or 0).alias("lo"), F.lit(p.until_yw or 1_000_000).alias("hi"), FLOOR)
        for p, t in statics
    ]
    parts.append(weekly.select(floors.SKU, yw.alias("lo"), (yw + 1).alias("hi"), FLOOR))
    dim = parts[0]
    for part in parts[1:]:
        dim = dim.unionByName(part)
    held = (F.col("SKUName") == F.col(f"`{floors.SKU}`")) & (yw >= F.col("lo")) & (yw < F.col("hi"))
    return facts.join(dim, held, "left").drop(floors.SKU, "lo", "hi")


def test_range_lookup_equals_a_range_join(spark):
    """Also with SKUs named twice, entries without a price, overlapping tables, and a mapping too large to send."""
    facts, statics, weekly, _ = tables(spark, True, early=True, seed=7)
    none = statics[0][1].limit(2).withColumn(FLOOR, F.lit(None).cast("double"))
    twice = [(statics[0][0], statics[0][1].union(statics[0][1]).union(none)), statics[1]]
    wide = [(Period("all", None, 202607), statics[0][1]), statics[1]]
    doubled = weekly.union(weekly.filter("week = 7"))
    nothing = weekly.filter("false")
    for tables_, weeks in ((statics, weekly), (twice, doubled), (wide, weekly), (statics, nothing), ([], weekly)):
        want = rows(range_join(facts, tables_, weeks))
        for fits in (None, False):
            got = floors.floor_range(facts, tables_, weeks, FLOOR, fits=fits)
            assert rows(got.select(*range_join(facts, tables_, weeks).columns)) == want


def test_range_lookup_repeats_no_row_where_tables_name_each_sku_once(spark):
    facts, statics, weekly, _ = tables(spark, seed=3)
    text = floors.floor_range(facts, statics, weekly, FLOOR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text
