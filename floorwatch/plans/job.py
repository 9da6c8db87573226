"""The whole job: worksheets to dimensions, dimensions and scrape files to price tracks.

A workbook is a folder with one table per worksheet, named like the worksheet, as CSV or parquet. What the steps
derive is stored, so a later run may leave a step out and use what is there:

    floor sheet ----(refresh_floors)----> weekly floors --+
    workbook -----(refresh_mappings)----> mappings -------+--> channel run --> tracks, snapshots, gaps, summary
    workbook --------------------------> manual rules ----+
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from floorwatch.config import ChannelConfig
from floorwatch.functions.text import clean_dimension
from floorwatch.operators.floors import historical_floors, refresh_weekly
from floorwatch.operators.packs import manual_rules
from floorwatch.plans.channel import ChannelResult, Floors, run_channel
from floorwatch.sources.dims import (
    FLOOR_VIEWS,
    mapping_view,
    read_dimension,
    register_floor_views,
    write_dimension,
)
from floorwatch.sources.shared import file_system, materialise
from floorwatch.sources.sheets import column_pair_mapping, mapping_of, read_sheet, sheet_mappings
from floorwatch.sources.store import TrackStore

# Fixed value: title of the worksheet with rules for bundles.
RULES_SHEET = "Manual Multiplier Mapping"


@dataclass(frozen=True)
class JobSettings:
    """Where everything lies; nothing is derived from the machine it runs on."""

    channel: ChannelConfig
    workbook: str
    """Folder of the channel's worksheets."""
    folders: Mapping[str, str]
    """Scrape files per retailer code."""
    floors: Mapping[str, str]
    """Stored floor tables: one per closed period by its name, and 'CURRENT', the weekly one."""
    mappings: str
    """Folder of the stored mappings."""
    track: str
    track_table: str | None = None
    raw_track: str | None = None
    raw_track_table: str | None = None
    snapshots: str | None = None
    floor_workbook: str | None = None
    floor_sheet: str | None = None
    """Worksheet that the weekly floors are refreshed from."""
    closed_sheets: Mapping[str, tuple[str, str, int]] = field(default_factory=dict)
    """(worksheet, quarter, year) per closed period whose table is to be built anew."""


def find_sheet(spark: SparkSession, workbook: str, title: str) -> DataFrame:
    """A worksheet by its title."""
    for kind in ("parquet", "csv"):
        path = f"{workbook.rstrip('/')}/{title}.{kind}"
        fs, where = file_system(spark, path)
        if fs.exists(where):
            return read_sheet(spark, path)
    raise FileNotFoundError(f"{workbook} has no worksheet '{title}'")


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def refresh_floors(spark: SparkSession, settings: JobSettings, as_of: dt.date) -> None:
    """Closed periods from their sheets; the weekly table up to the ISO week of ``as_of``, known weeks unchanged."""
    for name, (title, quarter, year) in settings.closed_sheets.items():
        sheet = clean_dimension(find_sheet(spark, settings.floor_workbook, title))
        write_dimension(historical_floors(sheet, quarter, year), settings.floors[name])
    if settings.floor_sheet is None:
        return
    sheet = clean_dimension(find_sheet(spark, settings.floor_workbook, settings.floor_sheet))
    path = settings.floors["CURRENT"]
    existing = read_dimension(spark, path) if _exists(spark, path) else None
    # A table of its own first, since the old weeks are read from the path that is overwritten.
    write_dimension(materialise(refresh_weekly(sheet, existing, as_of), "weekly-floors"), path)


def extract_mappings(spark: SparkSession, settings: JobSettings) -> DataFrame:
    """Mappings of all retailers of a channel, in the form of worksheet that the channel uses."""
    channel = settings.channel
    if channel.mapping_sheet is None:
        return sheet_mappings(
            {r.code: find_sheet(spark, settings.workbook, r.mapping_sheet) for r in channel.retailers}
        )
    rivals = None
    if channel.competitor_sheet and any(r.has_competitor for r in channel.retailers):
        rivals = find_sheet(spark, settings.workbook, channel.competitor_sheet)
    return column_pair_mapping(
        find_sheet(spark, settings.workbook, channel.mapping_sheet),
        channel.mapping_sku_col,
        channel.retailers,
        rivals,
        channel.competitor_sku_col,
    )


def refresh_mappings(spark: SparkSession, settings: JobSettings) -> dict[str, int]:
    """Store the mappings, one folder per retailer; returns how many product names each has more than once."""
    nth = F.row_number().over(Window.partitionBy("retailer", "ProductName").orderBy("SKUName"))
    numbered = extract_mappings(spark, settings).withColumn("_nth", nth)
    watch = Observation("mapping names")
    codes = [r.code for r in settings.channel.retailers]
    twice = (F.col("_nth") == 2) & F.col("ProductName").isNotNull()
    counted = numbered.observe(
        watch, *[F.count(F.when(twice & (F.col("retailer") == c), 1)).alias(c) for c in codes]
    )
    counted.drop("_nth").write.mode("overwrite").partitionBy("retailer").parquet(settings.mappings)
    return watch.get


def stored_mappings(spark: SparkSession, settings: JobSettings) -> dict[str, DataFrame]:
    """The stored mapping of each retailer, registered as a view of its name."""
    stored = read_dimension(spark, settings.mappings)
    return {
        r.code: mapping_view(spark, f"mapping_{r.view}", settings.mappings, mapping_of(stored, r.code))
        for r in settings.channel.retailers
    }


def stored_floors(spark: SparkSession, settings: JobSettings) -> Floors:
    """The floor tables, registered as views."""
    periods = settings.channel.periods
    names = [*(p.name for p in periods), "CURRENT"]
    # The fixed view names are those of two closed periods and the weekly table.
    views = FLOOR_VIEWS if len(names) == len(FLOOR_VIEWS) else [f"bfp_{n.lower()}" for n in names]
    register_floor_views(spark, {v: settings.floors[n] for v, n in zip(views, names, strict=True)})
    *closed, weekly = (spark.table(v) for v in views)
    return Floors(list(zip(periods, closed, strict=True)), weekly)


def run_job(
    spark: SparkSession,
    settings: JobSettings,
    refresh_floor_tables: bool = False,
    refresh_mapping_tables: bool = True,
    from_date: dt.date | None = None,
    to_date: dt.date | None = None,
    full_refresh: bool = False,
    today: dt.date | None = None,
) -> ChannelResult:
    """All steps of one channel, those left out excepted.

    Mappings are extracted when asked for, and when none are stored yet.
    """
    today = today or dt.date.today()
    channel = settings.channel
    if refresh_floor_tables:
        refresh_floors(spark, settings, today)
    duplicates: dict[str, int] = {}
    if refresh_mapping_tables or not _exists(spark, settings.mappings):
        duplicates = refresh_mappings(spark, settings)
    rules = None
    if channel.has_multiplier:
        rules = materialise(manual_rules(find_sheet(spark, settings.workbook, RULES_SHEET)), "rules")
    raw_store = None
    if channel.keep_raw and settings.raw_track:
        raw_store = TrackStore(spark, settings.raw_track, settings.raw_track_table)
    return run_channel(
        spark,
        channel,
        settings.folders,
        stored_mappings(spark, settings),
        stored_floors(spark, settings),
        TrackStore(spark, settings.track, settings.track_table),
        raw_store,
        rules,
        settings.snapshots,
        from_date,
        to_date,
        full_refresh,
        today,
        duplicates=duplicates,
    )
