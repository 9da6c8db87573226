"""Dated scrape files: listing, window, columns from the file name.

A scrape "file" is either one parquet file or a folder of that name holding
part files, as Spark writes it.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.functions.dates import date_text, file_date, week_columns
from floorwatch.sources.shared import file_system

LABEL = r"([^/\\]+\.parquet)(?:/part-[^/\\]*)?$"


def file_label(path: Column) -> Column:
    """Name of the scrape file within a plain (not URL-encoded) path."""
    return F.regexp_extract(path, LABEL, 1)


def scanned_label() -> Column:
    """`file_label` of the file a row is read from; constant per file, so Spark prunes on it."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return file_label(F.try_url_decode(encoded))


def label_date(label: Column, file_regex: str) -> Column:
    return file_date(F.regexp_extract(label, file_regex, 1))


def source_name(label: Column) -> Column:
    """The label without its extension and without its date."""
    return F.regexp_replace(F.regexp_replace(label, r"\.parquet$", ""), r"_\d{6}$", "")


def in_window(day: Column, start: dt.date | None, end: dt.date | None) -> Column | None:
    """Both ends inclusive and optional; None when there is no window at all."""
    if start is None and end is None:
        return None
    within = day.isNotNull()
    if start is not None:
        within = within & (day >= F.lit(start))
    if end is not None:
        within = within & (day <= F.lit(end))
    return within


def list_files(spark: SparkSession, folder: str, file_regex: str) -> DataFrame:
    """(path, label, day) of every parquet file, from the listing alone. Files of zero bytes are not listed."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path")
    )
    label = file_label(F.col("path"))
    return found.select("path", label.alias("label"), label_date(label, file_regex).alias("day"))


def read_folder(spark: SparkSession, *paths: str) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )


def read_window(
    spark: SparkSession,
    folder: str,
    file_regex: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Rows of the files whose name date lies in the window; other files are not opened.

    For folders of one schema. Without a window every file is read.
    """
    df = read_folder(spark, folder)
    within = in_window(label_date(scanned_label(), file_regex), start, end)
    return df if within is None else df.filter(within)


def enrich(
    df: DataFrame,
    label: Column,
    file_regex: str,
    account: str,
    by_iso_year: bool = False,
) -> DataFrame:
    """date, scrape_date (text), week, year, account and source_file from the file name."""
    named = df.withColumn("_label", label)
    day = label_date(F.col("_label"), file_regex)
    week, year = week_columns(F.col("date"), by_iso_year)
    return (
        named.withColumn("date", day)
        .withColumns(
            {
                "scrape_date": date_text(F.col("date")),
                "week": week,
                "year": year,
                "account": F.lit(account),
                "source_file": source_name(F.col("_label")),
            }
        )
        .drop("_label")
    )


def write_named(df: DataFrame, folder: str, name_col: str) -> None:
    """Write the rows of each name to a folder of that name under ``folder``.

    A folder of that name is replaced. Tasks write in parallel, several parts per name if need be; the driver
    only renames folders.
    """
    spark = df.sparkSession
    stage = f"{folder.rstrip('/')}/_stage-{uuid4().hex}"
    df.write.partitionBy(name_col).parquet(stage)
    fs, stage_path = file_system(spark, stage)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(stage_path):
        found = re.fullmatch(rf"{re.escape(name_col)}=(.*)", status.getPath().getName())
        if found:
            target = path_of(f"{folder.rstrip('/')}/{unquote(found.group(1))}")
            # a folder left by an earlier run is replaced; a rename would move into it
            fs.delete(target, True)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"Cannot put {target} in place")
    fs.delete(stage_path, True)
