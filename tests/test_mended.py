"""Cases that lost, doubled or refused rows before."""

import datetime as dt

from floorwatch.operators.windows import windows_frame
from floorwatch.sources.drift import renamed
from floorwatch.sources.files import write_named
from floorwatch.sources.store import TrackStore, stored_partitions

DAY = [dt.date(2025, 1, d) for d in range(1, 5)]


def test_append_keeps_a_table_made_elsewhere(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS made_elsewhere")
    old = spark.createDataFrame([("A", DAY[0], 1.0), ("A", DAY[1], 2.0)], "account string, date date, price double")
    old.write.saveAsTable("made_elsewhere")
    store = TrackStore(spark, str(tmp_path / "track"), table="made_elsewhere")
    new = spark.createDataFrame([("A", DAY[1], 3.0)], old.schema)
    store.save(new, "append", windows_frame(spark, {"A": (DAY[1], DAY[1])}))
    rows = {(r["date"], r["price"]) for r in spark.table("made_elsewhere").collect()}
    assert rows == {(DAY[0], 1.0), (DAY[1], 3.0)}
    spark.sql("DROP TABLE made_elsewhere")


def test_accounts_like_numbers_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", DAY[0], 1), ("010", DAY[1], 2)], "account string, date date, x int")
    df.write.partitionBy("account", "date").parquet(str(tmp_path / "t"))
    found = {(r["account"], r["date"]) for r in stored_partitions(spark, str(tmp_path / "t")).collect()}
    assert found == {("007", DAY[0]), ("010", DAY[1])}


def test_writing_names_twice_gives_the_same_folder(spark, tmp_path):
    df = spark.createDataFrame([(1, "a.parquet"), (2, "a.parquet"), (3, "b.parquet")], "x int, name string")
    for _ in range(2):
        write_named(df, str(tmp_path), "name")
    assert sorted(r["x"] for r in spark.read.parquet(str(tmp_path / "a.parquet")).collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "b.parquet")).count() == 1


def test_both_spellings_become_one_column(spark):
    df = spark.createDataFrame([("new", "old"), (None, "old")], "name string, concat string")
    out = renamed(df, [("concat", "name")])
    assert out.columns == ["name"] and [r["name"] for r in out.collect()] == ["new", "old"]
