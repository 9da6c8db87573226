"""A whole channel from files to tracks, and again with a later day."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from floorwatch import CHANNELS, run_channel
from floorwatch.config import STATIC_PERIODS
from floorwatch.plans.channel import Floors
from floorwatch.sources.sheets import column_pair_mapping
from floorwatch.sources.shared import fresh_path
from floorwatch.sources.store import TrackStore

D = dt.date
FILES = {"LAZADA": "LAZADA", "BLIBLI": "BLIBLI", "TOKPED": "TOKOPEDIA"}


def put(folder, name, products):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(
        pa.table(
            {
                "productName": [p for p, _ in products],
                "basePrice": [x + 1.0 for _, x in products],
                "finalPrice": [x for _, x in products],
                "status": ["live"] * len(products),
                "url": ["u"] * len(products),
            }
        ),
        os.path.join(folder, name),
    )


@pytest.fixture()
def world(spark, tmp_path):
    config = CHANNELS["DCOMM"]
    folders = {code: str(tmp_path / code) for code in FILES}
    # BLIBLI and TOKPED drop the scraped status; LAZADA never has one.
    for code, prefix in FILES.items():
        put(
            folders[code],
            f"{prefix}_A_260209.parquet",
            [("Blue Soap 90g x2", 18.0), ("RIVAL soap", 5.0), ("tea", 1.0), ("Blue Soap 90g FREE mug", 3.0)],
        )
    lazada = os.path.join(folders["LAZADA"], "LAZADA_A_260209.parquet")
    pq.write_table(pq.read_table(lazada).drop(["status"]), lazada)
    names = "`TOP 58` string, LAZADA string, BLIBLI string, TOKPED string, `LAZADA MULTIPLIER` string, `BLIBLI MULTIPLIER` string, `TOKPED MULTIPLIER` string"
    sheet = spark.createDataFrame([("BLUE", "blue soap", "blue soap 90g", "blue soap", None, "4", "nan")], names)
    rivals = spark.createDataFrame(
        [("RIVAL", "rival soap", "rival soap", "rival soap", None, None, None)],
        names.replace("TOP 58", "COMP").replace("TOKPED string", "TOKOPEDIA string"),
    )
    mapping = column_pair_mapping(sheet, "TOP 58", config.retailers, rivals, "COMP")
    static = spark.createDataFrame([("BLUE", 1.0, 1.0)], "`SKU NAME` string, `BFP Summary Minis` double, `BFP LMT` double")
    weekly = static.withColumns(
        {"BFP Summary Minis": F.lit(9.5), "week": F.lit(7), "year": F.lit(2026)}
    ).unionByName(
        static.withColumns({"SKU NAME": F.lit("GHOST"), "week": F.lit(7), "year": F.lit(2026)})
    )
    return {
        "config": config,
        "folders": folders,
        "mappings": {r.code: mapping.filter(F.col("retailer") == r.code).drop("retailer") for r in config.retailers},
        "floors": Floors([(p, static) for p in STATIC_PERIODS], weekly),
        "rules": spark.createDataFrame(
            [("BLUE", "tokped", "90g x2", 3.0)],
            "`SKU NAME` string, Account string, ProductPattern string, Multiplier double",
        ),
    }


def test_channel_from_files(spark, world, tmp_path):
    store = TrackStore(spark, fresh_path(spark, "dcomm"), "channel_test_track")
    raw_store = TrackStore(spark, fresh_path(spark, "dcomm-raw"))
    args = {**world, "store": store, "raw_store": raw_store, "snapshots": str(tmp_path / "snap")}
    result = run_channel(spark, full_refresh=True, today=D(2026, 2, 10), **args)

    got = store.read()
    before = rows(got)
    assert len(before) == 6
    blue = {r["account"]: r for r in got.filter("skuName = 'BLUE'").collect()}
    assert {a: (r["finalPrice"], r["derivedMultiplier"], r["belowBfp"]) for a, r in blue.items()} == {
        "lazada": (9.0, 2.0, True),
        "blibli": (4.5, 2.0, True),
        "tokped": (6.0, 3.0, True),
    }
    assert blue["lazada"]["source_file"] == "LAZADA_A" and blue["lazada"]["date"] == D(2026, 2, 9)
    assert got.filter("status = 'Competitor' AND bfp IS NULL").count() == 3
    assert raw_store.read().count() == 9
    assert "location" in got.columns and got.filter("location IS NOT NULL").count() == 0
    gaps = result.gaps["LAZADA"]
    assert rows(gaps.select("SKU NAME", "issue_type")) == [("GHOST", "NO MAPPING IN lazada")]
    assert sorted(os.listdir(tmp_path / "snap" / "DCOMM")) == [f"{c}_260210" for c in sorted(FILES)]

    # The same day again, and one more: only LAZADA has new files.
    # The newest file decides which columns are read, so it has all of them.
    put(world["folders"]["LAZADA"], "LAZADA_B_260210.parquet", [("blue soap", 10.0)])
    newest = os.path.join(world["folders"]["LAZADA"], "LAZADA_B_260210.parquet")
    pq.write_table(pq.read_table(newest).drop(["status"]), newest)
    for _ in range(2):
        run_channel(spark, today=D(2026, 2, 10), **args)
        after = store.read()
        assert rows(after.filter("date < DATE'2026-02-10'").select(*got.columns)) == before
        assert after.count() == 7
    extra = after.filter("date = DATE'2026-02-10'").select("account", "finalPrice", "bfp", "belowBfp", "url")
    assert rows(extra) == [("lazada", 10.0, 9.5, False, "u")]
    assert spark.table("channel_test_track").count() == 7

    # A window without any file changes nothing.
    nothing = run_channel(spark, from_date=D(2027, 1, 1), to_date=D(2027, 1, 2), today=D(2026, 2, 10), **args)
    assert nothing.track is None and store.read().count() == 7


def test_range_lookup_gives_the_same_track(spark, world):
    from floorwatch.plans.channel import build_channel
    from floorwatch.sources.drift import load_scrapes

    config = world["config"]
    scrapes = {
        r.code: load_scrapes(spark, world["folders"][r.code], r.account, r.file_regex, r.drop_cols)
        for r in config.retailers
    }
    tracks = [
        build_channel(config, scrapes, world["mappings"], world["floors"], world["rules"], one_period=one).track
        for one in (False, True)
    ]
    assert rows(tracks[0]) == rows(tracks[1])


def test_four_channels():
    assert {name: [r.account for r in c.retailers] for name, c in CHANNELS.items()} == {
        "DCOMM": ["lazada", "blibli", "tokped"],
        "HSM": ["HYPERMART", "TIPTOP", "SUPERINDO"],
        "MINIS": ["ALFAMART", "INDOMARET", "MIDI"],
        "HABA": ["WATSON", "GUARDIAN"],
    }


def test_a_run_reads_each_folder_twice(spark, world, monkeypatch, tmp_path):
    """Once for the names, once for the rows of all outputs."""
    from pyspark.sql import DataFrameWriter

    plans = []
    plain = DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    stores = [TrackStore(spark, fresh_path(spark, "twice")) for _ in range(2)]
    run_channel(
        spark, store=stores[0], raw_store=stores[1], snapshots=str(tmp_path / "s"), full_refresh=True, today=D(2026, 2, 10), **world
    )
    for folder in world["folders"].values():
        scans = [line for plan in plans for line in plan.split("\n") if "FileScan parquet" in line and folder in line]
        assert len(scans) == 2
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_run_summary(spark, world):
    store, raw_store = (TrackStore(spark, fresh_path(spark, "summary")) for _ in range(2))
    with open(os.path.join(world["folders"]["BLIBLI"], "BLIBLI_B_260208.parquet"), "wb") as file:
        file.write(b"broken")
    result = run_channel(spark, store=store, raw_store=raw_store, full_refresh=True, today=D(2026, 2, 10), **world)
    got = {r["retailer"]: r for r in result.summary_frame(spark).collect()}
    counted = {r["account"]: r["count"] for r in store.read().groupBy("account").count().collect()}
    assert {r["account"]: r["rows"] for r in got.values()} == counted
    assert {r["account"]: r["raw_rows"] for r in got.values()} == {
        r["account"]: r["count"] for r in raw_store.read().groupBy("account").count().collect()
    }
    assert {c: r["overridden"] for c, r in got.items()} == {"LAZADA": 0, "BLIBLI": 0, "TOKPED": 1}
    assert {c: r["unreadable"] for c, r in got.items()} == {"LAZADA": 0, "BLIBLI": 1, "TOKPED": 0}
    assert {c: r["left_out"] for c, r in got.items()} == {"LAZADA": "", "BLIBLI": "status", "TOKPED": "status"}
    assert [r["label"] for r in result.unreadable["BLIBLI"].collect()] == ["BLIBLI_B_260208.parquet"]


def test_days_of_broken_files_keep_their_rows(spark, world):
    store = TrackStore(spark, fresh_path(spark, "keeps"))
    args = {**world, "store": store}
    for code, prefix in FILES.items():
        put(world["folders"][code], f"{prefix}_A_260210.parquet", [("blue soap 90g x2", 10.0)])
    newest = os.path.join(world["folders"]["LAZADA"], "LAZADA_A_260210.parquet")
    pq.write_table(pq.read_table(newest).drop(["status"]), newest)
    run_channel(spark, full_refresh=True, today=D(2026, 2, 11), **args)
    before = rows(store.read())
    with open(os.path.join(world["folders"]["LAZADA"], "LAZADA_A_260209.parquet"), "wb") as file:
        file.write(b"broken")
    run_channel(spark, from_date=D(2026, 2, 1), today=D(2026, 2, 11), **args)
    assert rows(store.read()) == before


def test_windows_without_days():
    from floorwatch.operators.windows import without_days

    whole = (D(2025, 1, 1), D(2025, 1, 5))
    assert without_days(whole, []) == [whole]
    assert without_days(whole, [D(2025, 1, 1), D(2025, 1, 3), D(2024, 1, 1)]) == [
        (D(2025, 1, 2), D(2025, 1, 2)), (D(2025, 1, 4), D(2025, 1, 5))
    ]
    assert without_days((D(2025, 1, 1), D(2025, 1, 1)), [D(2025, 1, 1)]) == []
    assert without_days((None, D(2025, 1, 5)), [D(2025, 1, 3)]) == [(None, D(2025, 1, 5))]
