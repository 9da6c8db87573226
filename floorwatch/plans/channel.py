"""One channel from scrapes to price track."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from floorwatch.config import ChannelConfig, Period, RetailerConfig
from floorwatch.operators.floors import floor_range, floor_single_pass, range_is_exact
from floorwatch.operators.joins import BROADCAST_BYTES, fits_broadcast, measured_bytes
from floorwatch.operators.match import (
    attach_matches,
    best_match,
    distinct_names,
    match_exact,
    with_pack_columns,
)
from floorwatch.operators.gaps import gap_report
from floorwatch.operators.packs import (
    below_raw,
    both_outputs,
    price_cap,
    processed_rows,
    raw_rows,
    without_packs,
)
from floorwatch.operators.track import account_key, final_rows, track_columns, union_tracks
from floorwatch.operators.windows import intervals_frame, resolve_windows, without_days
from floorwatch.sources.drift import scan_scrapes
from floorwatch.sources.shared import materialise
from floorwatch.sources.store import TrackStore, save_snapshot


@dataclass(frozen=True)
class Floors:
    """Static floor tables with their periods, and the weekly one."""

    statics: Sequence[tuple[Period, DataFrame]]
    weekly: DataFrame

    def measured(self) -> int:
        """Bytes of all tables; every lookup uses a part of them."""
        return sum(measured_bytes(df) for df in [*(t for _, t in self.statics), self.weekly])


@dataclass
class RetailerSummary:
    """What one run did with a retailer, counted while its rows were written."""

    retailer: str
    account: str | None
    rows: int = 0
    """Rows of the track that came in, without repeated ones."""
    raw_rows: int = 0
    view_rows: int = 0
    """Rows of the final view before repeated ones are removed."""
    overridden: int = 0
    """Rows whose multiplier is a manual rule's."""
    duplicate_names: int = 0
    """Product names that the mapping has more than once."""
    left_out: tuple[str, ...] = ()
    """Columns of older files that the newest one has not."""
    unreadable: int = 0
    """Files set aside."""


@dataclass
class ChannelResult:
    track: DataFrame | None
    raw_track: DataFrame | None
    views: dict[str, DataFrame] = field(default_factory=dict)
    gaps: dict[str, DataFrame] = field(default_factory=dict)
    unreadable: dict[str, DataFrame] = field(default_factory=dict)
    """path, label, day, error per retailer that has such files."""
    summary: dict[str, RetailerSummary] = field(default_factory=dict)

    def summary_frame(self, spark: SparkSession) -> DataFrame:
        """One row per retailer that was processed."""
        rows = [
            (s.retailer, s.account, s.rows, s.raw_rows, s.view_rows, s.overridden, s.duplicate_names,
             ",".join(s.left_out), s.unreadable)
            for s in self.summary.values()
        ]
        schema = (
            "retailer string, account string, rows bigint, raw_rows bigint, view_rows bigint, "
            "overridden bigint, duplicate_names bigint, left_out string, unreadable bigint"
        )
        return spark.createDataFrame(rows, schema)


def matched_rows(
    config: ChannelConfig,
    retailer: RetailerConfig,
    scrapes: DataFrame,
    mapping: DataFrame,
    spread: Column | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """Scrapes with SKU, status and pack columns.

    Matching and reading pack hints is done once per distinct name; that
    table is written down, so that its size is known when it meets the rows.
    ``names`` are the distinct names where they are known already.
    """
    product = retailer.product_col
    if not config.contains_match:
        return without_packs(match_exact(scrapes, mapping, product, spread))
    names = distinct_names(scrapes, product) if names is None else names.select("name")
    matches = best_match(names, mapping)
    if config.has_multiplier:
        matches = with_pack_columns(matches)
    matches = materialise(matches, f"names-{retailer.code.lower()}")
    rows = attach_matches(scrapes, matches, product, spread)
    if not config.has_multiplier:
        return without_packs(rows)
    # A row without a name speaks of no pack.
    return rows.withColumn(
        "derivedMultiplier", F.coalesce("derivedMultiplier", F.lit(1.0))
    )


def flagged_rows(
    config: ChannelConfig,
    retailer: RetailerConfig,
    scrapes: DataFrame,
    mapping: DataFrame,
    floors: Floors,
    rules: DataFrame | None = None,
    spread: Column | None = None,
    one_period: bool = False,
    floors_fit: bool | None = None,
    rules_fit: bool | None = None,
    names: DataFrame | None = None,
    hit: str | None = None,
) -> DataFrame:
    """Rows with their floors and flag, before any price is divided.

    ``one_period`` takes the period lookup, if the dimensions allow it.
    """
    floor_col = retailer.floor_col
    sku = config.sku_col
    if config.has_multiplier:
        # Commutes with everything below; here it reaches the scan.
        scrapes = price_cap(scrapes, config.price_cap)
    position = None
    if spread is not None:
        # Fixed on the scan, before any shuffle could reorder the rows.
        scrapes = scrapes.withColumn("_position", spread)
        position = F.col("_position")
    matched = matched_rows(config, retailer, scrapes, mapping, position, names)
    exact = one_period and range_is_exact(mapping, floors.statics, floors.weekly, floor_col)
    lookup = floor_range if exact else floor_single_pass
    priced = lookup(
        matched, floors.statics, floors.weekly, floor_col, sku, spread=position, fits=floors_fit
    )
    if not config.has_multiplier:
        flagged = priced.withColumn("belowBfp", below_raw(F.col(f"`{floor_col}`")))
        return flagged.drop("_position")
    return raw_rows(
        priced,
        floor_col,
        rules,
        config.price_cap,
        config.excluded_packs,
        sku,
        position,
        rules_fit,
        hit,
    ).drop("_position")


def staged_outputs(
    config: ChannelConfig, retailer: RetailerConfig, flagged: DataFrame, hit: str
) -> tuple[dict[str, DataFrame], Observation]:
    """Final rows of each output ('processed', and 'raw' if kept), written by one job and read back.

    Snapshot, processed and raw track all come from these tables, so the scrapes are read once for all of them.
    """
    output = F.col("_output")
    if config.has_multiplier and config.keep_raw:
        rows = both_outputs(flagged, retailer.floor_col, config.promo_words)
    else:
        if config.has_multiplier:
            flagged = processed_rows(flagged, retailer.floor_col, config.promo_words)
        rows = flagged.withColumn("_output", F.lit("processed"))
    rows = final_rows(rows, retailer.floor_col, config.sku_col, retailer.has_competitor)
    overridden = F.col(hit) if hit in rows.columns else F.lit(False)
    watch = Observation(f"outputs of {retailer.code}")
    counted = rows.observe(
        watch,
        F.count(F.when(output == "processed", 1)).alias("processed"),
        F.count(F.when(output == "raw", 1)).alias("raw"),
        F.count(F.when(overridden & (output == "processed"), 1)).alias("overridden"),
    )
    table = materialise(counted.drop(hit), f"rows-{retailer.code.lower()}", by=["_output"])
    names = ("processed", "raw") if config.keep_raw else ("processed",)
    return {n: table.filter(output == n).drop("_output") for n in names}, watch


def build_channel(
    config: ChannelConfig,
    scrapes: Mapping[str, DataFrame | None],
    mappings: Mapping[str, DataFrame],
    floors: Floors,
    rules: DataFrame | None = None,
    gap_week: tuple[int, int] | None = None,
    spread: Column | None = None,
    one_period: bool = False,
) -> ChannelResult:
    """The tracks of a channel, its final views and gap reports; nothing is written but name tables.

    Retailers without scrapes are left out. ``gap_week`` is (week, year).
    Duplicates are removed once, after the union of the retailers.
    """
    result = ChannelResult(None, None)
    # Measured once for all retailers.
    floors_fit = floors.measured() <= BROADCAST_BYTES
    rules_fit = None if rules is None else fits_broadcast(rules)
    tracks, raw_tracks = [], []
    for retailer in config.retailers:
        rows = scrapes.get(retailer.code)
        if rows is None:
            continue
        mapping = mappings[retailer.code]
        processed = raw = flagged_rows(
            config,
            retailer,
            rows,
            mapping,
            floors,
            rules,
            spread,
            one_period,
            floors_fit,
            rules_fit,
        )
        if config.has_multiplier:
            processed = processed_rows(raw, retailer.floor_col, config.promo_words)

        def final(df: DataFrame) -> DataFrame:
            return final_rows(df, retailer.floor_col, config.sku_col, retailer.has_competitor)

        def columns(df: DataFrame) -> DataFrame:
            return track_columns(df, retailer.floor_col, config.sku_col, config.has_location)

        if gap_week is not None:
            result.gaps[retailer.code] = gap_report(
                floors.weekly,
                mapping,
                rows,
                retailer.floor_col,
                *gap_week,
                shop=retailer.view,
                product_col=retailer.product_col,
                contains=config.contains_match,
            )
        view = final(processed)
        result.views[retailer.code] = view.dropDuplicates()
        tracks.append(columns(view))
        if config.keep_raw:
            raw_tracks.append(columns(final(raw)))
    if tracks:
        result.track = union_tracks(tracks, config.keep_location)
    if raw_tracks:
        result.raw_track = union_tracks(raw_tracks, config.keep_location)
    return result


def channel_windows(
    spark: SparkSession,
    config: ChannelConfig,
    history: DataFrame | None,
    from_date: dt.date | None,
    to_date: dt.date | None,
    today: dt.date,
) -> dict[str, tuple[dt.date | None, dt.date | None]]:
    """Window per lower-case account; one row per account comes to the driver.

    ``history`` is (account, max_date) of the track, None without one.
    """
    accounts = spark.createDataFrame(
        [(r.account,) for r in config.retailers if r.account], "account string"
    )
    rows = resolve_windows(accounts, history, from_date, to_date or today).collect()
    return {r["account"]: (r["start"], r["end"]) for r in rows}


def seen_names(scrapes: DataFrame, product_col: str, week: int, year: int) -> DataFrame:
    """(name, in_week): every distinct name, and whether it was seen in the week. One pass, a stored table."""
    in_week = F.coalesce((F.col("week") == week) & (F.col("year") == year), F.lit(False))
    rows = scrapes.select(F.col(product_col).alias("name"), in_week.alias("in_week"))
    seen = rows.filter("name IS NOT NULL").groupBy("name").agg(F.bool_or("in_week").alias("in_week"))
    return materialise(seen, "seen-names")


def run_channel(
    spark: SparkSession,
    config: ChannelConfig,
    folders: Mapping[str, str],
    mappings: Mapping[str, DataFrame],
    floors: Floors,
    store: TrackStore,
    raw_store: TrackStore | None = None,
    rules: DataFrame | None = None,
    snapshots: str | None = None,
    from_date: dt.date | None = None,
    to_date: dt.date | None = None,
    full_refresh: bool = False,
    today: dt.date | None = None,
    one_period: bool = False,
    duplicates: Mapping[str, int] | None = None,
) -> ChannelResult:
    """Read the scrapes of each retailer's folder, build the channel and save its tracks.

    Without ``full_refresh`` each account is processed from ``from_date``, or
    from its last day in the track, up to ``to_date`` or today, and that
    window is replaced. ``to_date`` has no effect on a full refresh.

    Each folder is read twice: for its distinct names, and for the rows, whose
    outputs are written by one job per retailer. Files that cannot be read are
    set aside, and what the track holds of their days stays.
    """
    today = today or dt.date.today()
    if full_refresh:
        windows = {r.account.lower(): (None, None) for r in config.retailers}
    else:
        windows = channel_windows(spark, config, store.last_dates(), from_date, to_date, today)

    year, week = today.year, today.isocalendar()[1]
    floors_fit = floors.measured() <= BROADCAST_BYTES
    rules_fit = None if rules is None else fits_broadcast(rules)
    result = ChannelResult(None, None)
    tracks, raw_tracks = [], []
    cleared = {}
    for retailer in config.retailers:
        start, end = windows[retailer.account.lower()]
        scan = scan_scrapes(
            spark,
            folders[retailer.code],
            retailer.account,
            retailer.file_regex,
            retailer.drop_cols,
            retailer.renames,
            start,
            end,
        )
        # Names of broken files only.
        broken = scan.unreadable.select("label", "day").distinct().collect()
        if broken:
            result.unreadable[retailer.code] = scan.unreadable
        # A retailer without files keeps the rows it has.
        if scan.rows is None:
            continue
        cleared[retailer.account] = without_days((start, end), [r["day"] for r in broken if r["day"]])
        mapping = mappings[retailer.code]
        names = seen_names(scan.rows, retailer.product_col, week, year)
        result.gaps[retailer.code] = gap_report(
            floors.weekly,
            mapping,
            scan.rows,
            retailer.floor_col,
            week,
            year,
            shop=retailer.view,
            product_col=retailer.product_col,
            contains=config.contains_match,
            names=names.filter("in_week").select("name"),
        )
        flagged = flagged_rows(
            config,
            retailer,
            scan.rows,
            mapping,
            floors,
            rules,
            # Scrapes come straight from files, where the position of a row is stable.
            F.monotonically_increasing_id(),
            one_period,
            floors_fit,
            rules_fit,
            names,
            hit="_overridden",
        )
        outputs, watch = staged_outputs(config, retailer, flagged, "_overridden")
        counts = watch.get
        result.summary[retailer.code] = RetailerSummary(
            retailer.code,
            retailer.account,
            view_rows=counts["processed"],
            overridden=counts["overridden"],
            duplicate_names=(duplicates or {}).get(retailer.code, 0),
            left_out=scan.left_out,
            unreadable=len(broken),
        )
        result.views[retailer.code] = outputs["processed"].dropDuplicates()

        def columns(df: DataFrame) -> DataFrame:
            return track_columns(df, retailer.floor_col, config.sku_col, config.has_location)

        tracks.append(columns(outputs["processed"]))
        if "raw" in outputs:
            raw_tracks.append(columns(outputs["raw"]))
    if not tracks:
        return result
    result.track = union_tracks(tracks, config.keep_location)
    if raw_tracks:
        result.raw_track = union_tracks(raw_tracks, config.keep_location)
    if snapshots:
        for code, view in result.views.items():
            save_snapshot(view, f"{snapshots.rstrip('/')}/{config.name}/{code}", today)

    mode = "overwrite" if full_refresh else "append"
    frame = intervals_frame(spark, cleared)
    accounts = list(cleared)
    saved = store.save(result.track, mode, frame, distinct=True, accounts=accounts)
    saved_raw = {}
    if result.raw_track is not None and raw_store is not None:
        saved_raw = raw_store.save(result.raw_track, mode, frame, distinct=True, accounts=accounts)
    for summary in result.summary.values():
        summary.rows = saved[account_key(summary.account)]
        summary.raw_rows = saved_raw.get(account_key(summary.account), 0)
    return result
