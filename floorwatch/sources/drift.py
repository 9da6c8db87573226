"""Folders whose files differ in schema, or cannot be read at all.

Footers are read by the executors and written down once: for each file its columns, or why it has none. Files with
the same schema are read together, and every group is cast to the wanted columns. Files without a readable footer
are set aside as a table of their own, and the others go on. A scrape file that was written in parts counts as
unreadable if one of its parts is, since the others alone would be half a day.

What reaches the driver are the few distinct schemas and the names of the files to read, which Spark's own file
index holds there as well.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorwatch.config import SCRAPE_TYPES
from floorwatch.sources.files import (
    enrich,
    in_window,
    list_files,
    read_folder,
    scanned_label,
)
from floorwatch.sources.shared import materialise

FOOTER_FIELDS = (
    "path string, label string, day date, position int, column string, type string, error string"
)


@dataclass(frozen=True)
class Inspected:
    """Files by their footers; both are stored tables."""

    columns: DataFrame
    """path, label, day, position, column, type: one row per column of every readable file."""
    unreadable: DataFrame
    """path, label, day, error: the files set aside."""


@dataclass(frozen=True)
class Scan:
    rows: DataFrame | None
    """Rows of all readable files in the window; None where there are none."""
    unreadable: DataFrame
    """path, label, day, error of the files in the window that were set aside."""
    left_out: tuple[str, ...] = ()
    """Columns that older files have and the result has not."""


class UnreadableFiles(OSError):
    """A folder has files that cannot be read, and the caller did not ask to go on without them."""


def _footer(path: str) -> list[tuple[int, str, str]]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    uri = path.replace("s3a://", "s3://", 1)
    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    if uri.startswith("file://"):
        store, inner = fs.LocalFileSystem(), uri[len("file://") :]
    else:
        store, inner = fs.FileSystem.from_uri(uri)
    schema = pq.read_schema(inner, filesystem=store)
    if not len(schema):
        raise ValueError("no columns")
    return [(i, field.name, str(field.type)) for i, field in enumerate(schema)]


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, label, day in batch.itertuples(index=False):
            try:
                rows += [(path, label, day, *field, None) for field in _footer(path)]
            except Exception as error:  # noqa: BLE001 - whatever is wrong with a file is its result
                said = str(error).split("\n", 1)[0]
                rows.append((path, label, day, None, None, None, f"{type(error).__name__}: {said}"))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in FOOTER_FIELDS.split(", ")])


def renamed(df: DataFrame, renames: Sequence[tuple[str, str]]) -> DataFrame:
    """Old names into new ones; where a file has both, the new one's value counts if there is one."""
    for old, new in renames:
        if old not in df.columns or old == new:
            continue
        if new in df.columns:
            df = df.withColumn(new, F.coalesce(F.col(f"`{new}`"), F.col(f"`{old}`"))).drop(old)
        else:
            df = df.withColumnRenamed(old, new)
    return df


def footers(files: DataFrame) -> DataFrame:
    """One row per file and column, from the footers alone; one row with an error per file without."""
    return files.select("path", "label", "day").mapInPandas(_read_footers, FOOTER_FIELDS)


def inspect(files: DataFrame) -> Inspected:
    """Every footer is read once, whatever is asked of it later."""
    found = materialise(footers(files), "footers")
    broken = found.filter("error IS NOT NULL").select("path", "label", "day", "error")
    labels = broken.select("label").distinct()
    healthy = found.filter("error IS NULL").drop("error")
    return Inspected(healthy.join(labels, "label", "left_anti"), broken)


def schema_of_files(columns: DataFrame) -> DataFrame:
    """(path, label, day, layout): files of one layout have the same columns and types."""
    parts = F.sort_array(F.collect_list(F.struct("position", "column", "type")))
    return columns.groupBy("path", "label", "day").agg(F.to_json(parts).alias("layout"))


def layout_groups(columns: DataFrame) -> list[tuple[str, list[str]]]:
    """Layout and the paths that have it. File names only, never rows."""
    groups: dict[str, list[str]] = {}
    for row in schema_of_files(columns).select("layout", "path").toLocalIterator():
        groups.setdefault(row["layout"], []).append(row["path"])
    return [(layout, sorted(paths)) for layout, paths in sorted(groups.items())]


def newest_file(files: DataFrame) -> str | None:
    """Path of the file with the latest date, then the last name."""
    latest = F.max(F.struct(F.col("day").isNotNull(), "day", "label", "path"))
    row = files.agg(latest["path"].alias("path")).first()
    return row["path"]


def cast_to(col: Column, from_type: T.DataType, to_type: T.DataType | str) -> Column:
    """A cast that gives NULL where it cannot; decimal text is cut to a whole number."""
    name = to_type if isinstance(to_type, str) else to_type.simpleString()
    if name == "bigint" and isinstance(from_type, T.StringType):
        return F.coalesce(
            col.try_cast("bigint"), col.try_cast("double").try_cast("bigint")
        )
    return col.try_cast(name)


def cast_whole_columns(df: DataFrame, names: Sequence[str] = ("plu", "sold")) -> DataFrame:
    for field in df.schema.fields:
        if field.name in names:
            df = df.withColumn(field.name, cast_to(F.col(field.name), field.dataType, "bigint"))
    return df


def canonical_schema(newest: T.StructType) -> T.StructType:
    """The newest file's columns, with fixed types where one is known."""
    return T.StructType(
        [
            T.StructField(f.name, T._parse_datatype_string(SCRAPE_TYPES[f.name]), True)
            if f.name in SCRAPE_TYPES
            else T.StructField(f.name, f.dataType, True)
            for f in newest.fields
        ]
    )


def to_schema(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` in its types; absent ones are NULL, others are left out."""
    present = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        own = present.get(field.name.lower())
        if own is None:
            col = F.lit(None).cast(field.dataType)
        elif own.dataType == field.dataType:
            col = F.col(f"`{own.name}`")
        else:
            col = cast_to(F.col(f"`{own.name}`"), own.dataType, field.dataType)
        columns.append(col.alias(field.name))
    return df.select(*columns, *keep)


def scan_scrapes(
    spark: SparkSession,
    folder: str,
    account: str,
    file_regex: str,
    drop_cols: Sequence[str] = (),
    renames: Sequence[tuple[str, str]] = (),
    start: dt.date | None = None,
    end: dt.date | None = None,
    by_iso_year: bool = False,
) -> Scan:
    """Scrapes of one retailer, whatever schemas its files have, and the files that cannot be read.

    The columns are those of the newest readable file in the whole folder, so they
    do not depend on the window asked for.
    """
    found = inspect(list_files(spark, folder, file_regex))
    within = in_window(F.col("day"), start, end)
    if within is None:
        columns, unreadable = found.columns, found.unreadable
    else:
        columns, unreadable = found.columns.filter(within), found.unreadable.filter(within)
    groups = layout_groups(columns)
    if not groups:
        return Scan(None, unreadable)

    as_stored = renamed(read_folder(spark, newest_file(found.columns)), renames)
    schema = canonical_schema(as_stored.schema)
    given = {part["column"] for layout, _ in groups for part in json.loads(layout)}
    left_out = given - {old for old, _ in renames} - {f.name for f in schema.fields} | (given & set(drop_cols))
    parts = []
    for _, paths in groups:
        part = read_folder(spark, *paths).select("*", scanned_label().alias("_file"))
        parts.append(to_schema(renamed(part, renames), schema, keep=["_file"]))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    named = enrich(rows, F.col("_file"), file_regex, account, by_iso_year)
    return Scan(named.drop("_file", *drop_cols), unreadable, tuple(sorted(left_out)))


def load_scrapes(
    spark: SparkSession,
    folder: str,
    account: str,
    file_regex: str,
    drop_cols: Sequence[str] = (),
    renames: Sequence[tuple[str, str]] = (),
    start: dt.date | None = None,
    end: dt.date | None = None,
    by_iso_year: bool = False,
) -> DataFrame | None:
    """`scan_scrapes` where every file has to be readable; None without files."""
    scan = scan_scrapes(
        spark, folder, account, file_regex, drop_cols, renames, start, end, by_iso_year
    )
    first = scan.unreadable.select("label", "error").orderBy("label").first()
    if first is not None:
        raise UnreadableFiles(f"{folder}/{first['label']}: {first['error']}")
    return scan.rows
