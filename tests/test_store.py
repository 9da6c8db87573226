import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from floorwatch.operators import windows
from floorwatch.sources import store
from floorwatch.sources.shared import fresh_path, read_small, write_small

D = dt.date
SCHEMA = "account string, date date, skuName string, price double"


@pytest.fixture()
def sink(spark):
    sink = store.TrackStore(spark, fresh_path(spark, "store"))
    sink.replace(old(spark))
    return sink


def old(spark):
    return spark.createDataFrame(
        [
            ("007", D(2025, 1, 1), "a", 1.0),
            ("007", D(2025, 1, 2), "b", 2.0),
            ("007", D(2025, 1, 3), "c", 3.0),
            ("a b/c=d", D(2025, 1, 2), "d", 4.0),
            ("a b/c=d", None, "e", 5.0),
        ],
        SCHEMA,
    )


def same_columns(df, like):
    return rows(df.select(*like.columns))


def test_read_gives_what_was_written(spark, sink):
    assert same_columns(sink.read(), old(spark)) == rows(old(spark))


def test_merge_equals_the_plain_merge(spark, sink):
    new = spark.createDataFrame(
        [
            ("007", D(2025, 1, 2), "b2", 9.0),
            ("a b/c=d", D(2025, 1, 2), "d", 4.0),
            ("a b/c=d", D(2025, 1, 2), "d2", 4.5),
            ("new", D(2025, 1, 1), "n", 6.0),
        ],
        SCHEMA,
    ).withColumn("extra", F.lit("x"))
    frame = windows.windows_frame(
        spark, {"007": (D(2025, 1, 2), D(2025, 1, 3)), "a b/c=d": (None, D(2025, 1, 9)), "new": (None, None)}
    )
    want = windows.merge_window(old(spark), new, frame)
    for _ in range(2):
        sink.save(new, "append", frame)
        got = sink.read()
        assert set(got.columns) == set(want.columns)
        assert same_columns(got, want) == rows(want)


def test_untouched_partitions_keep_their_files(spark, sink):
    before = {f for f in sink.read().inputFiles() if "2025-01-01" in f}
    new = spark.createDataFrame([("007", D(2025, 1, 3), "z", 1.0)], SCHEMA)
    frame = windows.windows_frame(spark, {"007": (D(2025, 1, 3), D(2025, 1, 3))})
    sink.save(new, "append", frame)
    assert before and before <= set(sink.read().inputFiles())


def test_empty_batch_clears_its_window(spark, sink):
    frame = windows.windows_frame(spark, {"007": (D(2025, 1, 2), D(2025, 1, 9))})
    sink.save(old(spark).filter("false"), "append", frame)
    assert {r["skuName"] for r in sink.read().collect()} == {"a", "d", "e"}


def test_failed_replacement_leaves_the_old_version(spark, sink):
    broken = old(spark).withColumn("price", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        sink.replace(broken)
    assert same_columns(sink.read(), old(spark)) == rows(old(spark))


def test_interrupted_merge_is_completed_by_the_next(spark, sink, monkeypatch):
    """Before the last step nothing has changed; after half of it the same merge puts things right."""
    new = spark.createDataFrame([("007", D(2025, 1, 3), "z", 1.0)], SCHEMA)
    frame = windows.windows_frame(spark, {"007": (D(2025, 1, 2), D(2025, 1, 3))})
    want = rows(windows.merge_window(old(spark), new, frame))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sink, "_write", stop)
        with pytest.raises(KeyboardInterrupt):
            sink.merge(new, frame)
    assert same_columns(sink.read(), old(spark)) == rows(old(spark))
    with monkeypatch.context() as patch:
        patch.setattr(sink, "_drop", stop)
        with pytest.raises(KeyboardInterrupt):
            sink.merge(new, frame)
    again = store.TrackStore(spark, sink.base)
    again.merge(new, frame)
    assert same_columns(again.read(), old(spark)) == want


def test_rows_without_a_date_outlive_new_ones(spark, sink):
    new = spark.createDataFrame([("a b/c=d", None, "f", 6.0)], SCHEMA)
    sink.save(new, "append", windows.windows_frame(spark, {"a b/c=d": (D(2025, 1, 1), D(2025, 1, 1))}))
    assert {r["skuName"] for r in sink.read().filter("date IS NULL").collect()} == {"e", "f"}


def test_merge_reads_touched_partitions_only(spark):
    """A thousand accounts; new rows arrive outside the windows of ten."""
    sink = store.TrackStore(spark, fresh_path(spark, "many"))
    days = spark.sql("SELECT explode(sequence(DATE'2025-01-01', DATE'2025-01-03')) AS date")
    accounts = spark.range(300).select(F.concat(F.lit("acc "), "id").alias("account"))
    sink.replace(accounts.crossJoin(days).select("account", "date", F.lit("s").alias("skuName"), F.lit(1.0).alias("price")))
    new = sink.read().filter("account IN ('acc 7', 'acc 8') AND date = DATE'2025-01-02'").withColumn("price", F.lit(2.0))
    frame = windows.windows_frame(spark, {f"acc {i}": (D(2025, 1, 3), D(2025, 1, 3)) for i in range(200)})
    stored = sink.partitions()
    touched = new.select("account", "date").distinct()
    state = []
    both = sink._with_kept(sink.read(), new, windows.clear_windows(stored, frame), touched)
    assert both.count() == 4
    asked = touched.filter("date >= DATE'0001-01-01'")
    kept = sink.read().join(store.materialise(asked, "asked").filter("date >= DATE'0001-01-01'"), ["account", "date"], "left_semi")
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString().lower()
    sink.save(new, "append", frame)
    state = sink.read()
    assert state.count() == 900 - 200 + 2 and state.filter("price = 2").count() == 2


def test_table_elsewhere_is_merged_by_partition(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS parted_elsewhere")
    old(spark).write.partitionBy("account", "date").saveAsTable("parted_elsewhere")
    sink = store.TrackStore(spark, str(tmp_path / "unused"), "parted_elsewhere")
    untouched = {f for f in spark.table("parted_elsewhere").inputFiles() if "2025-01-01" in f}
    new = spark.createDataFrame([("007", D(2025, 1, 3), "z", 1.0), ("a b/c=d", D(2025, 1, 2), "y", 2.0)], SCHEMA)
    frame = windows.windows_frame(spark, {"007": (D(2025, 1, 2), D(2025, 1, 3))})
    sink.save(new, "append", frame)
    assert same_columns(sink.read(), old(spark)) == rows(windows.merge_window(old(spark), new, frame))
    assert untouched <= set(spark.table("parted_elsewhere").inputFiles())
    assert rows(sink.last_dates()) == [("007", D(2025, 1, 3)), ("a b/c=d", D(2025, 1, 2))]
    spark.sql("DROP TABLE parted_elsewhere")


def test_last_dates_open_no_file(spark, sink):
    found = sink.last_dates()
    assert rows(found) == [("007", D(2025, 1, 3)), ("a b/c=d", D(2025, 1, 2))]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile" in text and "FileScan parquet" not in text and "content" not in text.split("ReadSchema")[0]


def test_table_shows_the_current_version(spark):
    sink = store.TrackStore(spark, fresh_path(spark, "store"), "store_test_track")
    sink.replace(old(spark))
    assert spark.table("store_test_track").count() == 5
    sink.replace(old(spark).filter("skuName = 'a'"))
    assert spark.table("store_test_track").count() == 1
    assert rows(sink.read().select("account", "date")) == [("007", D(2025, 1, 1))]


def test_a_column_keeps_its_type(spark, sink):
    frame = windows.windows_frame(spark, {"007": (D(2025, 1, 3), D(2025, 1, 3))})
    with pytest.raises(ValueError, match="price is double"):
        sink.save(old(spark).withColumn("price", F.lit(1)), "append", frame)


def test_modes(spark, sink):
    with pytest.raises(ValueError, match="window"):
        sink.save(old(spark), "append", windows.windows_frame(spark, {}))
    with pytest.raises(ValueError, match="Unknown"):
        sink.save(old(spark), "upsert")
    assert store.TrackStore(spark, fresh_path(spark, "none")).read() is None


def test_small_files_are_replaced(spark):
    path = fresh_path(spark, "marker")
    assert read_small(spark, path) is None
    write_small(spark, path, "one")
    write_small(spark, path, "two ü\nlines")
    assert read_small(spark, path) == "two ü\nlines"


def test_listing_gives_the_partitions(spark, sink):
    found = store.stored_partitions(spark, sink.base)
    assert rows(found.select("account", "date")) == rows(old(spark).select("account", "date").distinct())
