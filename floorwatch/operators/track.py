"""The price track: final view, shared columns, union of retailers, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from floorwatch.config import COMPETITOR_STATUS


def final_rows(
    df: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
    has_competitor: bool = True,
    status_col: str = "Status",
) -> DataFrame:
    """Rows with a SKU, and a floor or (where asked for) competitor status."""
    priced = F.col(f"`{floor_col}`").isNotNull()
    if has_competitor:
        priced = priced | (F.col(status_col) == COMPETITOR_STATUS)
    return df.filter(priced & F.col(sku_col).isNotNull())


def final_view(
    df: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
    has_competitor: bool = True,
    status_col: str = "Status",
) -> DataFrame:
    return final_rows(df, floor_col, sku_col, has_competitor, status_col).dropDuplicates()


def track_columns(
    df: DataFrame, floor_col: str, sku_col: str = "SKUName", has_location: bool = True
) -> DataFrame:
    """The shared sixteen columns; url, location and source_file NULL where absent."""
    present = {c.lower() for c in df.columns}

    def text_or_null(name: str, wanted: bool = True) -> Column:
        if wanted and name.lower() in present:
            return F.col(name)
        return F.lit(None).cast("string").alias(name)

    return df.select(
        F.col(sku_col).alias("skuName"),
        F.col("productName").alias("productName"),
        text_or_null("url"),
        F.col("basePrice"),
        F.col("finalPrice"),
        text_or_null("location", has_location),
        F.col(f"`{floor_col}`").alias("bfp"),
        F.col("Status").alias("status"),
        F.col("account"),
        F.col("date"),
        F.col("week"),
        F.col("year"),
        F.col("packHintText"),
        F.col("derivedMultiplier"),
        F.col("belowBfp").alias("belowBfp"),
        text_or_null("source_file"),
    )


def union_tracks(tracks: Sequence[DataFrame], keep_location: bool = True) -> DataFrame:
    """All retailers of a channel, deduplicated once at the end, unsorted."""
    if not tracks:
        raise ValueError("A channel needs at least one retailer track")
    union = reduce(lambda a, b: a.unionByName(b), tracks)
    if not keep_location:
        union = union.drop("location")
    return union.dropDuplicates()


def track_order(df: DataFrame) -> list[Column]:
    place = [F.col("location").asc()] if "location" in df.columns else []
    return [F.col("date").desc(), F.col("account").asc(), *place, F.col("skuName").asc()]


def sort_track(df: DataFrame) -> DataFrame:
    """Total order, for a reader; sinks sort inside their partitions only."""
    return df.orderBy(*track_order(df))


def last_dates(track: DataFrame) -> DataFrame:
    """Latest date per lower-case account."""
    return (
        track.groupBy(F.lower("account").alias("account"))
        .agg(F.max("date").alias("max_date"))
        .filter("max_date IS NOT NULL")
    )


def count_by_account(track: DataFrame) -> DataFrame:
    return track.groupBy("account").agg(F.count("*").alias("rows"))


def observed_rows(
    df: DataFrame, name: str, accounts: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """Count rows, and those of some accounts, while they pass by, instead of in a job of their own."""
    watch = Observation(name)
    counts = [F.count(F.when(F.lower("account") == a.lower(), 1)).alias(account_key(a)) for a in accounts]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts), watch


def account_key(account: str) -> str:
    """Name under which `observed_rows` counts the rows of an account."""
    return f"rows of {account.lower()}"
