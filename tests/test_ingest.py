import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from floorwatch.sources import drift, files, normalise, sheets

D = dt.date
REGEX = r"SHOP\d*_(\d{6})"


def put(folder, name, **columns):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(columns), os.path.join(folder, name))


@pytest.fixture()
def folder(tmp_path):
    """Plain files, one per day, in a folder with a blank and a plus in its name."""
    path = str(tmp_path / "price scraping+1")
    for day in ("250101", "250102", "250105"):
        put(path, f"SHOP2_{day}.parquet", productName=["a", "b"], finalPrice=[1.0, 2.0])
    put(path, "SHOP2_250230.parquet", productName=["bad day"], finalPrice=[3.0])
    put(path, "notes.parquet", productName=["no day"], finalPrice=[4.0])
    return path


@pytest.mark.parametrize(
    "start, end, days",
    [
        (D(2025, 1, 1), D(2025, 1, 2), 2),
        (D(2025, 1, 2), None, 2),
        (None, D(2025, 1, 1), 1),
        (D(2025, 1, 3), D(2025, 1, 4), 0),
    ],
)
def test_window_ends_are_inclusive(spark, folder, start, end, days):
    assert files.read_window(spark, folder, REGEX, start, end).count() == 2 * days
    loaded = drift.load_scrapes(spark, folder, "Shop", REGEX, start=start, end=end)
    assert (loaded.count() if loaded is not None else 0) == 2 * days


def test_files_outside_the_window_are_not_opened(spark, folder):
    df = files.read_window(spark, folder, REGEX, D(2025, 1, 1), D(2025, 1, 2))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    assert plan.metrics().apply("numFiles").value() == 2


def test_without_a_window_every_file_is_read(spark, folder):
    rows_ = drift.load_scrapes(spark, folder, "Shop", REGEX)
    got = rows(rows_.select("productName", "date", "scrape_date", "week", "year", "account", "source_file"))
    assert ("a", D(2025, 1, 5), "1/5/2025", 1, 2025, "Shop", "SHOP2") in got
    assert ("bad day", None, None, None, None, "Shop", "SHOP2") in got
    assert ("no day", None, None, None, None, "Shop", "notes") in got
    assert len(got) == 8


def test_columns_are_those_of_the_newest_day(spark, tmp_path):
    path = str(tmp_path / "drift")
    put(path, "SHOP_250101.parquet", productName=[5, 6], plu=["12", "x"], gone=[1, 1])
    put(path, "SHOP9_250102.parquet", productName=["n"], plu=[3.0], extra=[True], finalPrice=["1.5"])
    put(path, "SHOP10_250103.parquet", productName=["m"], plu=[4], extra=[False], finalPrice=[2], status=["s"])
    got = drift.load_scrapes(spark, path, "Shop", REGEX, drop_cols=("status",))
    assert dict(got.dtypes)["plu"] == "bigint" and dict(got.dtypes)["finalPrice"] == "double"
    assert "gone" not in got.columns and "status" not in got.columns
    assert rows(got.select("productName", "plu", "extra", "finalPrice")) == [
        ("5", 12, None, None),
        ("6", None, None, None),
        ("m", 4, False, 2.0),
        ("n", 3, True, 1.5),
    ]


def test_folders_written_by_spark_count_as_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("LAZADA_X_250101.parquet", "a"), ("LAZADA_X_250102.parquet", "b")], "file string, productName string"
    )
    path = str(tmp_path / "named")
    files.write_named(df, path, "file")
    assert sorted(os.listdir(path)) == ["LAZADA_X_250101.parquet", "LAZADA_X_250102.parquet"]
    regex = r"LAZADA[^/]*_(\d{6})\.parquet"
    got = drift.load_scrapes(spark, path, "lazada", regex, start=D(2025, 1, 2))
    assert rows(got.select("productName", "source_file", "date")) == [("b", "LAZADA_X", D(2025, 1, 2))]


def test_empty_folder(spark, tmp_path):
    os.makedirs(tmp_path / "none")
    assert drift.load_scrapes(spark, str(tmp_path / "none"), "Shop", REGEX) is None
    assert normalise.normalise_folder(spark, str(tmp_path / "none"), str(tmp_path / "o"), "SHOP") is None


def normalised(spark, tmp_path, retailer):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    result = normalise.normalise_folder(spark, source, target, retailer)
    return target, {r["label"]: (r["status"], r["fractions"]) for r in result.report.collect()}, result


def test_generic_repairs(spark, tmp_path):
    path = str(tmp_path / "in")
    put(path, "S_250101.parquet", concat=["c"], productName=[1], finalPrice=["9"], junk=[0], plu=[1.5])
    put(path, "S_250102.parquet", combinedProductName=["d"], productName=["p"], finalPrice=[1.0], plu=[1])
    target, report, result = normalised(spark, tmp_path, "SUPERINDO")
    assert report == {"S_250101.parquet": ("fixed", 1), "S_250102.parquet": ("ok", 0)}
    assert rows(result.summary) == [("fixed", 1), ("ok", 1), ("total", 2)]
    got = drift.load_scrapes(spark, target, "S", r"S_(\d{6})")
    assert rows(got.select("combinedProductName", "productName", "finalPrice", "plu")) == [
        ("c", "1", 9.0, None),
        ("d", "p", 1.0, 1),
    ]
    # A second run finds nothing to do and changes nothing.
    again = normalise.normalise_folder(spark, target, str(tmp_path / "twice"), "SUPERINDO")
    assert rows(again.summary) == [("ok", 2), ("total", 2)]
    twice = drift.load_scrapes(spark, str(tmp_path / "twice"), "S", r"S_(\d{6})")
    assert rows(twice.select(*got.columns)) == rows(got)


def test_old_layout_by_a_single_old_column(spark, tmp_path):
    path = str(tmp_path / "in")
    put(path, "G_250101.parquet", Name=["n"], basePrice=["3"], Keyword=["k"], junk=[1])
    put(path, "G_250102.parquet", productName=["m"], basePrice=[4.0], shop=["X"], sold=[2])
    target, report, _ = normalised(spark, tmp_path, "GUARDIAN")
    assert {k: v[0] for k, v in report.items()} == {"G_250101.parquet": "fixed", "G_250102.parquet": "ok"}
    got = files.read_folder(spark, f"{target}/G_250101.parquet")
    assert got.columns == ["keyword", "productName", "basePrice", "shop", "sold"]
    assert rows(got) == [("k", "n", 3.0, "Guardian", None)]


def test_sold_words_are_judged_per_file(spark, tmp_path):
    path = str(tmp_path / "in")
    put(path, "L_250101.parquet", sold=["140.8K Terjual", "7", None], junk=[1, 1, 1])
    put(path, "L_250102.parquet", sold=["7", "8", "9"], junk=[1, 1, 1])
    put(path, "L_250103.parquet", sold=[1])
    target, report, _ = normalised(spark, tmp_path, "LAZADA")
    assert [report[k][0] for k in sorted(report)] == ["fixed", "fixed", "ok"]
    words = files.read_folder(spark, f"{target}/L_250101.parquet")
    assert rows(words.select("sold")) == [(140800,), (None,), (None,)]
    assert "junk" in words.columns
    numbers = files.read_folder(spark, f"{target}/L_250102.parquet")
    assert rows(numbers) == [(7,), (8,), (9,)]


def test_sheets(spark, tmp_path):
    sheet = spark.createDataFrame([("n", "S", "1")], "`Product Name` string, `SKU name` string, `Unnamed: 2` string")
    assert sheets.sheet_mapping(sheet).columns == ["ProductName", "SKUName"]
    path = str(tmp_path / "sheet.csv")
    sheet.write.csv(path, header=True)
    assert rows(sheets.read_sheet(spark, path)) == rows(sheet)
    both = sheets.sheet_mappings({"A": sheet, "B": sheet.withColumn("Status", F.lit("Top 58"))})
    assert rows(sheets.mapping_of(both, "B").select("Status")) == [("Top 58",)]


@pytest.fixture()
def with_broken(folder):
    """The same folder with garbage on a day of its own, a cut-off file, and half a day written in parts."""
    for name, content in (("SHOP2_250103.parquet", b"garbage"), ("SHOP3_250101.parquet", b"PAR1")):
        with open(os.path.join(folder, name), "wb") as file:
            file.write(content)
    put(os.path.join(folder, "SHOP4_250102.parquet"), "part-0.parquet", productName=["half"], finalPrice=[9.0])
    with open(os.path.join(folder, "SHOP4_250102.parquet", "part-1.parquet"), "wb") as file:
        file.write(b"gone")
    return folder


def test_broken_files_are_set_aside_and_the_others_read(spark, with_broken):
    scan = drift.scan_scrapes(spark, with_broken, "Shop", REGEX)
    assert {r["label"] for r in scan.unreadable.collect()} == {
        "SHOP2_250103.parquet", "SHOP3_250101.parquet", "SHOP4_250102.parquet"
    }
    assert all("Arrow" in r["error"] for r in scan.unreadable.collect())
    assert scan.rows.count() == 8 and scan.rows.filter("productName = 'half'").isEmpty()


def test_a_window_sees_its_own_broken_files(spark, with_broken):
    scan = drift.scan_scrapes(spark, with_broken, "Shop", REGEX, start=D(2025, 1, 3), end=D(2025, 1, 5))
    assert [r["label"] for r in scan.unreadable.collect()] == ["SHOP2_250103.parquet"]
    assert scan.rows.count() == 2
    clean = drift.scan_scrapes(spark, with_broken, "Shop", REGEX, start=D(2025, 1, 4))
    assert clean.unreadable.isEmpty() and clean.rows.count() == 2


def test_strict_loading_names_the_broken_file(spark, with_broken):
    with pytest.raises(drift.UnreadableFiles, match="SHOP2_250103.parquet: ArrowInvalid"):
        drift.load_scrapes(spark, with_broken, "Shop", REGEX, start=D(2025, 1, 3), end=D(2025, 1, 3))


def test_only_broken_files(spark, tmp_path):
    path = str(tmp_path / "in")
    os.makedirs(path)
    with open(os.path.join(path, "S_250101.parquet"), "wb") as file:
        file.write(b"nothing")
    assert drift.scan_scrapes(spark, path, "S", r"S_(\d{6})").rows is None
    _, report, result = normalised(spark, tmp_path, "SUPERINDO")
    assert report == {"S_250101.parquet": ("error", 0)}
    assert rows(result.summary) == [("error", 1), ("total", 1)]


def test_normalising_goes_on_behind_a_broken_file(spark, tmp_path):
    path = str(tmp_path / "in")
    put(path, "S_250101.parquet", concat=["c"], finalPrice=["9"])
    put(path, "S_250102.parquet", combinedProductName=["d"], finalPrice=[1.0])
    with open(os.path.join(path, "S_250103.parquet"), "wb") as file:
        file.write(b"nothing")
    target, report, result = normalised(spark, tmp_path, "SUPERINDO")
    assert {k: v[0] for k, v in report.items()} == {
        "S_250101.parquet": "fixed", "S_250102.parquet": "ok", "S_250103.parquet": "error"
    }
    assert rows(result.summary) == [("error", 1), ("fixed", 1), ("ok", 1), ("total", 3)]
    assert result.report.filter("error IS NOT NULL").select("label").first()[0] == "S_250103.parquet"
    assert drift.load_scrapes(spark, target, "S", r"S_(\d{6})").count() == 2
