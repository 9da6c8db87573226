"""Incremental processing: one window of days per account."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.operators.joins import dim_join

Window = tuple[dt.date | None, dt.date | None]


def windows_frame(spark: SparkSession, windows: Mapping[str, Window]) -> DataFrame:
    """Windows given by hand, one per configured account."""
    rows = [(account.lower(), start, end) for account, (start, end) in windows.items()]
    return spark.createDataFrame(rows, "account string, start date, end date")


def without_days(window: Window, days: Collection[dt.date]) -> list[Window]:
    """The parts of a window that are left when some of its days are not to be touched."""
    start, end = window
    if start is None or end is None:
        return [window]
    parts, one = [], dt.timedelta(days=1)
    for day in sorted(d for d in set(days) if start <= d <= end):
        if start < day:
            parts.append((start, day - one))
        start = day + one
    return parts + [(start, end)] if start <= end else parts


def intervals_frame(spark: SparkSession, windows: Mapping[str, Sequence[Window]]) -> DataFrame:
    """Several windows per account; an account without any clears nothing."""
    rows = [
        (account.lower(), start, end)
        for account, parts in windows.items()
        for start, end in parts or [(None, None)]
    ]
    return spark.createDataFrame(rows, "account string, start date, end date")


def resolve_windows(
    accounts: DataFrame,
    history: DataFrame | None,
    from_date: dt.date | None,
    to_date: dt.date,
) -> DataFrame:
    """(account, start, end): from the given date, else from the last day kept, itself included.

    An account without history and without a given date has start NULL: all
    its files are read and nothing of it is cleared.
    """
    wanted = accounts.select(F.lower("account").alias("account")).distinct()
    end = F.lit(to_date).cast("date").alias("end")
    if from_date is not None or history is None:
        start = F.lit(from_date).cast("date").alias("start")
        return wanted.select("account", start, end)
    known = history.select(F.lower("account").alias("account"), "max_date")
    return wanted.join(known, "account", "left").select(
        "account", F.col("max_date").alias("start"), end
    )


def clear_windows(existing: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows outside every window. Rows without a date are in none.

    A missing start clears nothing. One join, however many accounts there are.
    """
    bounds = windows.filter("start IS NOT NULL").select(
        F.lower("account").alias("_wa"), F.col("start").alias("_ws"), F.col("end").alias("_we")
    )
    keyed = existing.withColumn("_ea", F.lower("account"))
    inside = F.col("date").between(F.col("_ws"), F.col("_we"))
    return dim_join(keyed, bounds, [("_ea", "_wa")], how="left_anti", also=inside).drop("_ea")


def merge_window(existing: DataFrame | None, new: DataFrame, windows: DataFrame) -> DataFrame:
    """What the table holds after ``new`` replaced its windows; running it twice changes nothing."""
    if existing is None:
        return new
    kept = clear_windows(existing, windows)
    return kept.unionByName(new, allowMissingColumns=True).dropDuplicates()
