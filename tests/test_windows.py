import datetime as dt

import pytest
from conftest import rows

from floorwatch.operators import track, windows

D = dt.date
SCHEMA = "account string, date date, skuName string"


@pytest.fixture(scope="module")
def existing(spark):
    return spark.createDataFrame(
        [
            ("Shop", D(2025, 1, 1), "a"),
            ("shop", D(2025, 1, 2), "b"),
            ("SHOP", D(2025, 1, 5), "c"),
            ("shop", D(2025, 1, 6), "d"),
            ("shop", None, "e"),
            ("other", D(2025, 1, 3), "f"),
        ],
        SCHEMA,
    )


def test_windows(spark, existing):
    accounts = spark.createDataFrame([("SHOP",), ("Other",), ("New",)], "account string")
    history = track.last_dates(existing)
    end = D(2025, 2, 1)
    got = rows(windows.resolve_windows(accounts, history, None, end))
    assert got == [
        ("new", None, end),
        ("other", D(2025, 1, 3), end),
        ("shop", D(2025, 1, 6), end),
    ]
    given = rows(windows.resolve_windows(accounts, history, D(2025, 3, 1), end))
    assert given == [(a, D(2025, 3, 1), end) for a in ("new", "other", "shop")]
    assert rows(windows.resolve_windows(accounts, None, None, end)) == [
        (a, None, end) for a in ("new", "other", "shop")
    ]


def test_both_ends_are_cleared_and_nothing_else(spark, existing):
    frame = windows.windows_frame(spark, {"Shop": (D(2025, 1, 2), D(2025, 1, 5)), "other": (None, D(2025, 2, 1))})
    kept = {r["skuName"] for r in windows.clear_windows(existing, frame).collect()}
    assert kept == {"a", "d", "e", "f"}


def test_merge_twice_is_merge_once(spark, existing):
    frame = windows.windows_frame(spark, {"shop": (D(2025, 1, 2), D(2025, 1, 6)), "new": (None, D(2025, 1, 6))})
    new = spark.createDataFrame(
        [("shop", D(2025, 1, 2), 1.0), ("new", D(2025, 1, 1), 2.0), ("new", D(2025, 1, 1), 2.0)],
        "account string, date date, price double",
    )
    once = windows.merge_window(existing.dropDuplicates(), new, frame)
    twice = windows.merge_window(once, new, frame)
    assert rows(once) == rows(twice)
    assert rows(once.filter("account = 'new'")) == [("new", D(2025, 1, 1), None, 2.0)]
    assert rows(windows.merge_window(None, existing, frame)) == rows(existing)


def test_empty_window_clears_nothing(spark, existing):
    frame = windows.windows_frame(spark, {"shop": (D(2025, 1, 6), D(2025, 1, 1))})
    assert windows.clear_windows(existing, frame).count() == existing.count()


def test_union_needs_a_frame():
    with pytest.raises(ValueError):
        track.union_tracks([])
