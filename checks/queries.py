"""One query per operator, over the shared test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from floorwatch.config import LMT_FLOOR, MINIS_FLOOR
from floorwatch.functions import dates, text
from floorwatch.operators import floors, gaps, match, packs, track, windows
from floorwatch.plans.channel import ChannelResult, build_channel
from floorwatch.plans.job import JobSettings, refresh_floors, run_job
from floorwatch.sources import dims, drift, files, normalise, sheets, store
from floorwatch.sources.shared import fresh_path, materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 19)


# --- scans, sources, sinks --------------------------------------------------
@query
def scan_file_window(spark, sf_dir):
    folder = fx.dated_folder(spark, sf_dir)
    return files.read_window(spark, folder, fx.FILE_REGEX, START, END).select(
        "event_id", "productName", "finalPrice"
    )


@query
def scan_no_window(spark, sf_dir):
    folder = fx.dated_folder(spark, sf_dir)
    rows = files.read_window(spark, folder, fx.FILE_REGEX)
    return rows.groupBy("location").agg(F.count("*").alias("rows"))


@query
def scan_schema_drift(spark, sf_dir):
    return drift.load_scrapes(
        spark,
        fx.drift_folder(spark, sf_dir),
        "SHOP",
        fx.FILE_REGEX,
        renames=(("concat", "combinedProductName"),),
    )


@query
def scan_drift_window(spark, sf_dir):
    return drift.load_scrapes(
        spark,
        fx.drift_folder(spark, sf_dir),
        "SHOP",
        fx.FILE_REGEX,
        drop_cols=("event_id",),
        start=START,
        end=END,
    ).select("date", "location", "plu", "finalPrice")


@query
def scan_with_broken_file(spark, sf_dir):
    return drift.scan_scrapes(
        spark,
        fx.broken_folder(spark, sf_dir),
        "SHOP",
        fx.FILE_REGEX,
        renames=(("concat", "combinedProductName"),),
    ).rows


@query
def unreadable_files(spark, sf_dir):
    """The quarantine beside the files that can be read."""
    found = drift.inspect(files.list_files(spark, fx.broken_folder(spark, sf_dir), fx.FILE_REGEX))
    readable = found.columns.select("label", "day").distinct().withColumn("readable", F.lit(True))
    broken = found.unreadable.select("label", "day", F.col("error").isNull().alias("readable"))
    return readable.unionByName(broken)


@query
def cast_ints(spark, sf_dir):
    base = fx.event_scrapes(spark, sf_dir)
    as_text = base.select(
        "event_id",
        F.concat("plu", F.when(F.col("location") == "error", ".7").otherwise("")).alias("plu"),
        F.when(F.col("location") == "view", "many").otherwise(F.col("sold").cast("string")).alias("sold"),
    )
    return drift.cast_whole_columns(as_text)


@query
def filename_enrich(spark, sf_dir):
    rows = files.read_window(spark, fx.dated_folder(spark, sf_dir), fx.FILE_REGEX)
    named = files.enrich(rows, files.scanned_label(), fx.FILE_REGEX, "Shop One")
    return named.select("event_id", "date", "scrape_date", "week", "year", "account", "source_file")


@query
def drop_cols(spark, sf_dir):
    rows = files.read_window(spark, fx.dated_folder(spark, sf_dir), fx.FILE_REGEX, START, END)
    return rows.drop("status", "combinedProductName", "plu", "sold")


@query
def bfp_views(spark, sf_dir):
    given = fx.floors(spark, sf_dir)
    frames = [df for _, df in given.statics] + [given.weekly]
    paths = {}
    for name, df in zip(dims.FLOOR_VIEWS, frames):
        paths[name] = fresh_path(spark, name)
        dims.write_dimension(df, paths[name])
    dims.register_floor_views(spark, paths)
    return spark.sql(
        f"SELECT a.`SKU NAME` AS sku, a.`{MINIS_FLOOR}` AS first_floor, "
        f"b.`{MINIS_FLOOR}` AS second_floor, c.week, c.year, c.`{MINIS_FLOOR}` AS weekly_floor "
        "FROM bfp_q1_2025 a JOIN bfp_q2_2025 b ON a.`SKU NAME` = b.`SKU NAME` "
        "JOIN bfp_top58 c ON a.`SKU NAME` = c.`SKU NAME`"
    )


@query
def mapping_view(spark, sf_dir):
    path = fresh_path(spark, "mapping")
    dims.write_dimension(fx.mapping(spark, sf_dir), path)
    dims.mapping_view(spark, "mapping_shop", path)
    return spark.sql("SELECT * FROM mapping_shop")


@query
def snapshot_roundtrip(spark, sf_dir):
    rows = _priced(spark, sf_dir).select("SKUName", "productName", "account", "date", MINIS_FLOOR)
    view = track.final_view(rows.withColumn("Status", F.lit(None).cast("string")), MINIS_FLOOR)
    path = store.save_snapshot(view.drop("Status"), fresh_path(spark, "snapshot"), END)
    return spark.read.parquet(path).withColumnRenamed(MINIS_FLOOR, "bfp")


def _merged_store(spark, sf_dir, table=None) -> store.TrackStore:
    sink = store.TrackStore(spark, fresh_path(spark, "track"), table)
    sink.save(fx.existing_track(spark, sf_dir), "overwrite")
    frame = windows.windows_frame(spark, fx.TRACK_WINDOWS)
    sink.save(fx.new_batch(spark, sf_dir), "append", frame)
    return sink


@query
def track_roundtrip(spark, sf_dir):
    return _merged_store(spark, sf_dir).read()


@query
def table_or_parquet(spark, sf_dir):
    sink = _merged_store(spark, sf_dir, "floorwatch_check_track")
    from_table = store.table_or_parquet(spark, "floorwatch_check_track", f"{sink.base}/none")
    assert store.table_or_parquet(spark, "no_such_table", f"{sink.base}/none") is None
    return from_table.groupBy("account").agg(F.count("*").alias("rows"), F.max("date").alias("last"))


@query
def sheet_source(spark, sf_dir):
    path = f"{fresh_path(spark, 'sheet')}.csv"
    fx.wide_sheet(spark, sf_dir).write.csv(path, header=True)
    return sheets.read_sheet(spark, path)


@query
def dim_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "dim")
    dims.write_dimension(fx.weekly(spark, sf_dir), path)
    return dims.read_dimension(spark, path).select(
        F.col("SKU NAME").alias("sku"),
        F.col(MINIS_FLOOR).alias("minis"),
        F.col(LMT_FLOOR).alias("lmt"),
        "week",
        "year",
    )


# --- schema normalisation ---------------------------------------------------
def _loose_events(spark, sf_dir) -> DataFrame:
    """Event scrapes as a careless scraper writes them."""
    return fx.event_scrapes(spark, sf_dir).selectExpr(
        "event_id",
        "plu AS productName",
        "CASE WHEN location <> 'view' THEN location END AS location",
        "CASE WHEN location = 'error' THEN 'n/a' ELSE CAST(finalPrice AS STRING) END AS finalPrice",
        "CASE WHEN location = 'click' THEN plu END AS basePrice",
        "CASE WHEN location = 'error' THEN 'none' WHEN location = 'view' THEN concat(plu, '.5') "
        "WHEN location = 'click' THEN concat(plu, '.0') ELSE CAST(plu AS STRING) END AS plu",
        "CASE WHEN location <> 'click' THEN sold END AS stock",
        "CASE WHEN location = 'view' THEN combinedProductName END AS combinedProductName",
        "CASE WHEN location <> 'error' THEN upper(combinedProductName) END AS concat",
        "event_id AS `Unnamed: 0`",
        "status AS `productName.1`",
    )


@query
def norm_prices(spark, sf_dir):
    rows = normalise.fix_prices(_loose_events(spark, sf_dir))
    return rows.select("event_id", "finalPrice", "basePrice")


@query
def norm_ints(spark, sf_dir):
    rows = normalise.fix_whole_numbers(_loose_events(spark, sf_dir))
    return rows.select("event_id", "plu", "stock")


@query
def norm_drop_junk(spark, sf_dir):
    rows = _loose_events(spark, sf_dir).drop("combinedProductName")
    return normalise.keep_columns(rows, ["event_id", "stock", "location"])


@query
def norm_rename(spark, sf_dir):
    rows = normalise.rename_join_name(_loose_events(spark, sf_dir))
    return rows.select("event_id", "combinedProductName")


@query
def norm_old_layout(spark, sf_dir):
    old = fx.event_scrapes(spark, sf_dir).selectExpr(
        "productName AS Name",
        "finalPrice AS Price",
        "CAST(basePrice AS STRING) AS `Regular Price`",
        "plu AS `Discount (%)`",
        "concat('i', event_id) AS `Image URL`",
        "concat('u', event_id) AS `Product URL`",
        "location AS Keyword",
        "sold AS stock",
    )
    return normalise.fix_whole_numbers(normalise.fix_prices(normalise.migrate_old_layout(old)))


def _sold_texts(spark, sf_dir) -> DataFrame:
    return fx.event_scrapes(spark, sf_dir).selectExpr(
        "event_id",
        "location",
        "CASE location WHEN 'click' THEN concat(plu, '.', event_id % 10, 'K Terjual') "
        "WHEN 'view' THEN concat(plu, ' Terjual') WHEN 'error' THEN concat(plu, 'K+ Terjual') "
        "WHEN 'purchase' THEN concat('>', plu, ' m  Terjual') "
        "ELSE concat(plu, ' terjual') END AS sold",
    )


@query
def parse_sold(spark, sf_dir):
    rows = _sold_texts(spark, sf_dir)
    return rows.select("event_id", text.sold_count(F.col("sold")).alias("sold"))


@query
def needs_sold_fix(spark, sf_dir):
    rows = _sold_texts(spark, sf_dir).withColumn(
        "sold", F.when(F.col("location") == "view", F.col("event_id").cast("string")).otherwise(F.col("sold"))
    )
    return normalise.files_with_sold_words(rows, "location")


@query
def norm_text(spark, sf_dir):
    rows = normalise.fix_text(_loose_events(spark, sf_dir))
    return rows.select("event_id", "productName", "location")


@query
def drift_report(spark, sf_dir):
    listed = files.list_files(spark, fx.drift_folder(spark, sf_dir), fx.FILE_REGEX)
    newest = files.read_folder(spark, drift.newest_file(listed)).columns
    return normalise.drift_report(drift.footers(listed), newest)


@query
def norm_report(spark, sf_dir):
    folder = fx.broken_folder(spark, sf_dir)
    target = fresh_path(spark, "normalised")
    return normalise.normalise_folder(spark, folder, target, "SHOP", fx.FILE_REGEX).summary


@query
def norm_folder(spark, sf_dir):
    folder = fx.drift_folder(spark, sf_dir)
    target = fresh_path(spark, "normalised")
    normalise.normalise_folder(spark, folder, target, "SHOP", fx.FILE_REGEX)
    return drift.load_scrapes(spark, target, "SHOP", fx.FILE_REGEX)


# --- dimensions -------------------------------------------------------------
@query
def mapping_unpivot(spark, sf_dir):
    columns = [(r.code, r.mapping_col, r.multiplier_col) for r in fx.region_retailers()]
    return sheets.unpivot_mapping(fx.wide_sheet(spark, sf_dir), "TOP 58", columns, "Top 58")


@query
def mapping_dropna(spark, sf_dir):
    columns = [(r.code, r.mapping_col, None) for r in fx.region_retailers()]
    kept = sheets.unpivot_mapping(fx.wide_sheet(spark, sf_dir), "TOP 58", columns, "Top 58")
    return kept.groupBy("retailer").agg(F.count("*").alias("kept"))


@query
def mapping_status_union(spark, sf_dir):
    return sheets.column_pair_mapping(
        fx.wide_sheet(spark, sf_dir),
        "TOP 58",
        fx.region_retailers(),
        fx.wide_sheet(spark, sf_dir, rivals=True),
        "COMP",
    )


@query
def manual_rules(spark, sf_dir):
    rules = packs.manual_rules(fx.rules_sheet(spark, sf_dir))
    return rules.withColumnRenamed("SKU NAME", "sku")


@query
def mapping_sheet(spark, sf_dir):
    sheet = fx.mapping(spark, sf_dir).selectExpr(
        "ProductName AS `Product Name`",
        "CASE WHEN Status = 'Competitor' THEN ' ' ELSE SKUName END AS `SKU name`",
        "Status",
        "1 AS `Unnamed: 3`",
    )
    return sheets.sheet_mapping(sheet)


@query
def clean_dim(spark, sf_dir):
    return text.clean_dimension(
        fx.mapping(spark, sf_dir).selectExpr(
            "SKUName",
            "CASE WHEN Status = 'Competitor' THEN 'nan' WHEN Multiplier = 2 THEN 'None' "
            "ELSE ProductName END AS ProductName",
            "CASE WHEN Status = 'Top 58' AND Multiplier IS NULL THEN DOUBLE('NaN') "
            "ELSE Multiplier END AS Multiplier",
            "Status AS `Unnamed: 0`",
        )
    )


@query
def bfp_week_expand(spark, sf_dir):
    sheet = fx.floor_sheet(spark, sf_dir, 20).withColumnRenamed("SKU NAME", "sku")
    grown = floors.refresh_weekly(sheet.select("sku", MINIS_FLOOR), None, dt.date(2026, 3, 12))
    early = floors.refresh_weekly(sheet.select("sku", MINIS_FLOOR), None, dt.date(2026, 2, 1))
    return grown.unionByName(early).withColumnRenamed(MINIS_FLOOR, "bfp")


@query
def bfp_append_missing(spark, sf_dir):
    old = floors.expand_weeks(fx.floor_sheet(spark, sf_dir, 20), 8, 2026)
    both = floors.refresh_weekly(fx.floor_sheet(spark, sf_dir, 30), old, dt.date(2026, 3, 12))
    return both.select(F.col("SKU NAME").alias("sku"), F.col(MINIS_FLOOR).alias("bfp"), "week", "year")


@query
def bfp_historical(spark, sf_dir):
    sheet = floors.historical_floors(fx.floor_sheet(spark, sf_dir, 20), "Q1", 2025)
    return sheet.select(
        F.col("SKU NAME").alias("sku"), F.col(LMT_FLOOR).alias("lmt"), "Quartal", "year"
    )


@query
def iso_week(spark, sf_dir):
    days = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    week, year = dates.week_columns(F.col("day"), by_iso_year=True)
    return days.distinct().select("day", week, year)


# --- joins ------------------------------------------------------------------
@query
def join_mapping_exact(spark, sf_dir):
    names = match.match_exact(fx.obs(spark, sf_dir), fx.mapping(spark, sf_dir))
    return names.select("account", "productName", "date", "SKUName", "Status", "Multiplier")


@query
def join_mapping_contains(spark, sf_dir):
    names = match.distinct_names(fx.obs(spark, sf_dir))
    pairs = match.contains_pairs(names, fx.mapping(spark, sf_dir))
    return names.join(pairs, "name", "left").select("name", "mappedName", "SKUName", "Status")


@query
def join_contains_ngram(spark, sf_dir):
    pairs = match.contains_pairs(
        fx.pack_names(spark, sf_dir).select("name").distinct(), fx.mapping(spark, sf_dir), gram=3
    )
    return pairs.select("name", "mappedName", "SKUName")


@query
def join_contains_shuffled(spark, sf_dir):
    """The mapping as if it were too large to broadcast."""
    names = match.distinct_names(fx.obs(spark, sf_dir))
    pairs = match.contains_pairs(names, fx.mapping(spark, sf_dir), limit=0, keep_unmatched=True)
    return pairs.select("name", "mappedName", "SKUName", "Status")


@query
def distinct_names(spark, sf_dir):
    rows = fx.obs(spark, sf_dir)
    names = match.distinct_names(rows)
    back = match.attach_matches(rows, names.withColumn("known", F.col("name")))
    return back.groupBy("known").agg(F.count("*").alias("rows"))


def _best(spark, sf_dir) -> DataFrame:
    names = match.distinct_names(fx.obs(spark, sf_dir))
    return match.with_pack_columns(match.best_match(names, fx.mapping(spark, sf_dir)))


def _matched(spark, sf_dir) -> DataFrame:
    best = fx.kept(spark, sf_dir, "names", _best)
    return match.attach_matches(fx.obs(spark, sf_dir), best)


def _priced(spark, sf_dir) -> DataFrame:
    given = fx.floors(spark, sf_dir)
    return floors.floor_single_pass(
        _matched(spark, sf_dir), given.statics, given.weekly, MINIS_FLOOR
    )


@query
def best_match(spark, sf_dir):
    names = match.distinct_names(fx.obs(spark, sf_dir))
    return match.best_match(names, fx.mapping(spark, sf_dir))


@query
def join_bfp_static(spark, sf_dir):
    period, table = fx.statics(spark, sf_dir)[0]
    rows = floors.period_filter(_matched(spark, sf_dir), period)
    return floors.join_static(rows, table, MINIS_FLOOR).select(
        "productName", "date", "SKUName", F.col(MINIS_FLOOR).alias("bfp")
    )


@query
def join_bfp_weekly(spark, sf_dir):
    rows = floors.join_weekly(_matched(spark, sf_dir), fx.weekly(spark, sf_dir), MINIS_FLOOR)
    return rows.select("productName", "date", "week", "year", "SKUName", F.col(MINIS_FLOOR).alias("bfp"))


def _floor_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "account", "productName", "date", "finalPrice", "SKUName", F.col(MINIS_FLOOR).alias("bfp")
    )


@query
def floor_union(spark, sf_dir):
    given = fx.floors(spark, sf_dir)
    rows = _matched(spark, sf_dir)
    return _floor_columns(floors.floor_union(rows, given.statics, given.weekly, MINIS_FLOOR))


@query
def floor_single_pass(spark, sf_dir):
    return _floor_columns(_priced(spark, sf_dir))


@query
def floor_range(spark, sf_dir):
    given = fx.floors(spark, sf_dir)
    rows = _matched(spark, sf_dir)
    return _floor_columns(floors.floor_range(rows, given.statics, given.weekly, MINIS_FLOOR))


def _rules(spark, sf_dir) -> DataFrame:
    return packs.manual_rules(fx.rules_sheet(spark, sf_dir))


@query
def override_match(spark, sf_dir):
    hits = packs.override_matches(_matched(spark, sf_dir), _rules(spark, sf_dir))
    return hits.select("account", "SKUName", "productName", "date", "rulePattern", "ruleMultiplier")


@query
def override_first(spark, sf_dir):
    return packs.first_override_by_window(
        packs.override_matches(_matched(spark, sf_dir), _rules(spark, sf_dir))
    )


@query
def override_apply(spark, sf_dir):
    rows = packs.with_multiplier(_matched(spark, sf_dir))
    first = packs.first_override(packs.override_matches(rows, _rules(spark, sf_dir)))
    return packs.apply_overrides(rows, first).select(
        "account", "productName", "date", "SKUName", "Multiplier", "derivedMultiplier"
    )


@query
def override_rows(spark, sf_dir):
    rows = packs.with_multiplier(_matched(spark, sf_dir))
    return packs.override_rows(rows, _rules(spark, sf_dir)).select(
        "account", "productName", "date", "SKUName", "Multiplier", "derivedMultiplier"
    )


@query
def override_preview(spark, sf_dir):
    hits = packs.override_matches(_matched(spark, sf_dir), _rules(spark, sf_dir))
    first = packs.first_override(hits)
    return first.orderBy("account", "SKUName", "productName").limit(20)


@query
def gap_join(spark, sf_dir):
    return gaps.gap_rows(
        fx.weekly(spark, sf_dir),
        fx.mapping(spark, sf_dir),
        fx.obs(spark, sf_dir),
        MINIS_FLOOR,
        *fx.GAP_WEEK,
    ).withColumnsRenamed({"SKU NAME": "sku", MINIS_FLOOR: "bfp"})


@query
def gap_join_contains(spark, sf_dir):
    return gaps.gap_rows(
        fx.weekly(spark, sf_dir),
        fx.mapping(spark, sf_dir),
        fx.obs(spark, sf_dir),
        MINIS_FLOOR,
        *fx.GAP_WEEK,
        contains=True,
    ).withColumnsRenamed({"SKU NAME": "sku", MINIS_FLOOR: "bfp"})


# --- projections and scalar functions ---------------------------------------
@query
def pack_hint(spark, sf_dir):
    rows = fx.pack_names(spark, sf_dir)
    return rows.withColumn("packHintText", text.pack_hint(F.col("name"), F.col("mappedName")))


@query
def derived_multiplier(spark, sf_dir):
    return match.with_pack_columns(fx.pack_names(spark, sf_dir))


@query
def effective_multiplier(spark, sf_dir):
    rows = match.with_pack_columns(fx.pack_names(spark, sf_dir))
    given = (
        F.when(F.col("mappedName").startswith("Red"), F.lit(2.0))
        .when(F.col("mappedName").startswith("Blue"), F.lit(0.0))
        .when(F.col("mappedName").startswith("Cold"), F.lit(-1.0))
        .when(F.col("mappedName").startswith("New"), F.lit(float("nan")))
    )
    return packs.with_multiplier(rows.withColumn("Multiplier", given)).select("name", "Multiplier")


@query
def below_floor_raw(spark, sf_dir):
    rows = packs.with_multiplier(_priced(spark, sf_dir))
    floor = F.col(f"`{MINIS_FLOOR}`")
    return rows.select(
        "productName",
        "date",
        "finalPrice",
        packs.below_raw(floor, F.col("Multiplier")).alias("per_unit"),
        packs.below_raw(floor).alias("undivided"),
    )


@query
def unit_price(spark, sf_dir):
    rows = packs.with_multiplier(_matched(spark, sf_dir))
    zero = F.when(F.col("location") == "NATION_3", 0.0).otherwise(F.col("Multiplier"))
    return packs.unit_prices(rows.withColumn("Multiplier", zero)).select(
        "productName", "date", "basePrice", "finalPrice"
    )


@query
def below_floor(spark, sf_dir):
    rows = packs.unit_prices(packs.with_multiplier(_priced(spark, sf_dir)))
    flag = packs.below_floor(F.col(f"`{MINIS_FLOOR}`")).alias("belowBfp")
    return rows.select("productName", "date", "finalPrice", F.col(MINIS_FLOOR).alias("bfp"), flag)


@query
def null_placeholders(spark, sf_dir):
    rows = packs.without_packs(fx.obs(spark, sf_dir))
    return rows.select("productName", "date", "packHintText", "derivedMultiplier")


@query
def date_roundtrip(spark, sf_dir):
    days = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    stamp = (
        F.when(F.dayofmonth("day") == 1, "")
        .when(F.dayofmonth("day") == 2, F.concat(F.date_format("day", "yy"), F.lit("0230")))
        .otherwise(F.date_format("day", "yyMMdd"))
    )
    parsed = days.distinct().withColumn("stamp", stamp)
    shown = dates.date_text(dates.file_date(F.col("stamp")))
    return parsed.select("day", shown.alias("shown"), dates.text_date(shown).alias("back"))


@query
def week_year(spark, sf_dir):
    week, year = dates.week_columns(F.col("date"))
    return fx.obs(spark, sf_dir).select("date", week, year).distinct()


def _projected(spark, sf_dir, floor_col=MINIS_FLOOR, has_location=True) -> DataFrame:
    given = fx.floors(spark, sf_dir)
    rows = floors.floor_single_pass(
        _matched(spark, sf_dir), given.statics, given.weekly, floor_col
    )
    flagged = rows.withColumn("belowBfp", packs.below_raw(F.col(f"`{floor_col}`")))
    return track.track_columns(
        track.final_rows(flagged, floor_col), floor_col, has_location=has_location
    )


@query
def track_projection(spark, sf_dir):
    return _projected(spark, sf_dir)


@query
def floor_column_choice(spark, sf_dir):
    return _projected(spark, sf_dir, LMT_FLOOR).select("skuName", "date", "finalPrice", "bfp", "belowBfp")


# --- filters ----------------------------------------------------------------
@query
def price_cap(spark, sf_dir):
    rows = fx.obs(spark, sf_dir).withColumn(
        "finalPrice", F.when(F.col("location") != "NATION_3", F.col("finalPrice"))
    )
    return packs.price_cap(rows, fx.CAP).select("productName", "date", "finalPrice")


@query
def exclude_sku_pack(spark, sf_dir):
    rows = packs.exclude_packs(_matched(spark, sf_dir), fx.PACKS)
    return rows.select("productName", "date", "SKUName", "derivedMultiplier")


@query
def drop_promos(spark, sf_dir):
    return packs.drop_promos(_matched(spark, sf_dir)).select("productName", "date", "packHintText")


@query
def final_view(spark, sf_dir):
    rows = _priced(spark, sf_dir).select("SKUName", "productName", "Status", "date", MINIS_FLOOR)
    return track.final_view(rows, MINIS_FLOOR).withColumnRenamed(MINIS_FLOOR, "bfp")


@query
def final_view_nocomp(spark, sf_dir):
    rows = _priced(spark, sf_dir).select("SKUName", "productName", "Status", "date", MINIS_FLOOR)
    view = track.final_view(rows, MINIS_FLOOR, has_competitor=False)
    return view.withColumnRenamed(MINIS_FLOOR, "bfp")


@query
def period_filter(spark, sf_dir):
    rows = floors.period_filter(fx.obs(spark, sf_dir), fx.PERIODS[1])
    return rows.groupBy("year", "week").agg(F.count("*").alias("rows"))


# --- aggregation, sort, set operations --------------------------------------
@query
def last_date_by_account(spark, sf_dir):
    rows = fx.obs(spark, sf_dir).withColumn(
        "account", F.when(F.col("week") > 20, F.upper("account")).otherwise(F.col("account"))
    )
    return track.last_dates(rows)


@query
def gap_counts(spark, sf_dir):
    rows = gaps.gap_rows(
        fx.weekly(spark, sf_dir),
        fx.mapping(spark, sf_dir),
        fx.obs(spark, sf_dir),
        MINIS_FLOOR,
        *fx.GAP_WEEK,
        contains=True,
    )
    return gaps.gap_counts(rows, MINIS_FLOOR).withColumnsRenamed(
        {"SKU NAME": "sku", MINIS_FLOOR: "bfp"}
    )


def _gap_report(spark, sf_dir, contains: bool) -> DataFrame:
    return gaps.gap_report(
        fx.weekly(spark, sf_dir),
        fx.mapping(spark, sf_dir),
        fx.obs(spark, sf_dir),
        MINIS_FLOOR,
        *fx.GAP_WEEK,
        shop="any shop",
        contains=contains,
    ).withColumnsRenamed({"SKU NAME": "sku", MINIS_FLOOR: "bfp"})


@query
def gap_report(spark, sf_dir):
    return _gap_report(spark, sf_dir, contains=True)


@query
def gap_report_exact(spark, sf_dir):
    return _gap_report(spark, sf_dir, contains=False)


@query
def count_by_account(spark, sf_dir):
    return track.count_by_account(fx.obs(spark, sf_dir))


@query
def dedup_rows(spark, sf_dir):
    return fx.obs(spark, sf_dir).select("account", "productName", "year", "week").dropDuplicates()


@query
def distinct_keys(spark, sf_dir):
    keys = _matched(spark, sf_dir).select("account", "SKUName", "productName").distinct()
    return keys.groupBy("account").agg(
        F.count("*").alias("keys"), F.countDistinct("SKUName").alias("skus")
    )


@query
def row_counts(spark, sf_dir):
    counted, watch = track.observed_rows(fx.obs(spark, sf_dir), "rows of obs")
    by_year = materialise(counted.groupBy("year").agg(F.count("*").alias("rows")), "counts")
    return by_year.withColumn("all_rows", F.lit(watch.get["rows"]))


@query
def track_sorted(spark, sf_dir):
    return track.sort_track(_projected(spark, sf_dir)).select(
        "date", "account", "location", "skuName", "productName", "finalPrice"
    )


@query
def channel_union(spark, sf_dir):
    halves = fx.halves(_projected(spark, sf_dir))
    return track.union_tracks([halves["EAST"], halves["WEST"], halves["EAST"]])


@query
def channel_union_noloc(spark, sf_dir):
    halves = fx.halves(_projected(spark, sf_dir, has_location=False))
    return track.union_tracks([halves["EAST"], halves["WEST"]], keep_location=False)


# --- incremental processing -------------------------------------------------
@query
def resolve_windows(spark, sf_dir):
    regions = fx.table(spark, sf_dir, "region").select(F.col("r_name").alias("account"))
    segments = fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("account"))
    history = track.last_dates(fx.obs(spark, sf_dir))
    return windows.resolve_windows(regions.union(segments), history, None, dt.date(2001, 12, 31))


@query
def clear_window(spark, sf_dir):
    frame = windows.windows_frame(spark, fx.TRACK_WINDOWS)
    rows = fx.existing_track(spark, sf_dir)
    rows = rows.withColumn("date", F.when(F.col("skuName") != "U7", F.col("date")))
    return windows.clear_windows(rows, frame)


@query
def merge_window(spark, sf_dir):
    frame = windows.windows_frame(spark, fx.TRACK_WINDOWS)
    return windows.merge_window(fx.existing_track(spark, sf_dir), fx.new_batch(spark, sf_dir), frame)


@query
def full_refresh(spark, sf_dir):
    sink = _merged_store(spark, sf_dir)
    sink.save(fx.event_track(spark, sf_dir), "overwrite")
    return sink.read()


@query
def empty_window(spark, sf_dir):
    """A window without files has no frame; the channel goes on with the other half."""
    folder = fx.dated_folder(spark, sf_dir)
    nothing = drift.load_scrapes(
        spark, folder, "SHOP", fx.FILE_REGEX, start=dt.date(2030, 1, 1), end=dt.date(2030, 2, 1)
    )
    scrapes = {"EAST": nothing, "WEST": fx.halves(fx.obs(spark, sf_dir))["WEST"]}
    mapping = fx.mapping(spark, sf_dir).drop("Multiplier")
    result = build_channel(
        fx.HABA_TEST, scrapes, {"EAST": mapping, "WEST": mapping}, fx.floors(spark, sf_dir)
    )
    return result.track


# --- channels ---------------------------------------------------------------
def _dcomm(spark, sf_dir, config=fx.DCOMM_TEST) -> ChannelResult:
    return build_channel(
        config,
        {"ALL": fx.obs(spark, sf_dir)},
        {"ALL": fx.mapping(spark, sf_dir)},
        fx.floors(spark, sf_dir),
        _rules(spark, sf_dir),
    )


@query
def raw_track(spark, sf_dir):
    return _dcomm(spark, sf_dir).raw_track


@query
def processed_track(spark, sf_dir):
    """The processed half alone, without manual rules and without a mapping multiplier."""
    return build_channel(
        replace(fx.DCOMM_TEST, keep_raw=False),
        {"ALL": fx.obs(spark, sf_dir)},
        {"ALL": fx.mapping(spark, sf_dir).drop("Multiplier")},
        fx.floors(spark, sf_dir),
    ).track


@query
def channel_dcomm(spark, sf_dir):
    return _dcomm(spark, sf_dir).track


@query
def channel_hsm(spark, sf_dir):
    halves = fx.halves(fx.sales(spark, sf_dir).drop("p_name"))
    return build_channel(
        fx.HSM_TEST,
        halves,
        {
            "EAST": fx.combined_mapping(spark, sf_dir),
            "WEST": fx.mapping(spark, sf_dir).drop("Multiplier"),
        },
        fx.floors(spark, sf_dir),
    ).track


@query
def channel_minis(spark, sf_dir):
    whole = fx.mapping(spark, sf_dir).drop("Multiplier")
    as_sheet = whole.withColumnsRenamed({"ProductName": "Product Name", "SKUName": "SKU name"})
    mappings = sheets.sheet_mappings(
        {"EAST": as_sheet, "WEST": as_sheet.filter("Status <> 'Competitor'")}
    )
    return build_channel(
        fx.MINIS_TEST,
        fx.halves(fx.obs(spark, sf_dir)),
        {code: sheets.mapping_of(mappings, code) for code in ("EAST", "WEST")},
        fx.floors(spark, sf_dir),
    ).track


@query
def channel_haba(spark, sf_dir):
    mapping = fx.mapping(spark, sf_dir).drop("Multiplier")
    return build_channel(
        fx.HABA_TEST,
        fx.halves(fx.obs(spark, sf_dir)),
        {"EAST": mapping, "WEST": mapping},
        fx.floors(spark, sf_dir),
    ).track


# --- whole runs -------------------------------------------------------------
_done: dict[tuple, tuple[JobSettings, list[ChannelResult]]] = {}


def _runs(spark, sf_dir, channel) -> tuple[JobSettings, list[ChannelResult]]:
    """Sheets, floors and the older files in full; then what is new, from the last day on.

    Run once per session and table set, for all queries that look at what it left.
    """
    key = (spark.sparkContext.applicationId, sf_dir, channel.name)
    if key not in _done:
        _done[key] = _run_twice(spark, sf_dir, channel)
    return _done[key]


def _run_twice(spark, sf_dir, channel) -> tuple[JobSettings, list[ChannelResult]]:
    settings = fx.run_settings(spark, sf_dir, channel)
    first = run_job(
        spark, settings, refresh_floor_tables=True, full_refresh=True, today=fx.RUN_TODAY
    )
    settings = replace(settings, folders=fx.run_folders(spark, sf_dir, "all"))
    second = run_job(spark, settings, refresh_mapping_tables=False, today=fx.RUN_TODAY)
    return settings, [first, second]


def _stored(spark, path) -> DataFrame:
    return store.TrackStore(spark, path).read()


@query
def run_dcomm(spark, sf_dir):
    return _stored(spark, _runs(spark, sf_dir, fx.RUN_DCOMM)[0].track)


@query
def run_dcomm_raw(spark, sf_dir):
    return _stored(spark, _runs(spark, sf_dir, fx.RUN_DCOMM)[0].raw_track)


@query
def run_hsm(spark, sf_dir):
    return _stored(spark, _runs(spark, sf_dir, fx.RUN_HSM)[0].track)


@query
def run_minis(spark, sf_dir):
    return _stored(spark, _runs(spark, sf_dir, fx.RUN_MINIS)[0].track)


@query
def run_haba(spark, sf_dir):
    return _stored(spark, _runs(spark, sf_dir, fx.RUN_HABA)[0].track)


@query
def run_summary(spark, sf_dir):
    _, results = _runs(spark, sf_dir, fx.RUN_HSM)
    parts = [
        r.summary_frame(spark).select(F.lit(i).alias("run"), "*").drop("raw_rows", "view_rows")
        for i, r in enumerate(results, 1)
    ]
    return parts[0].unionByName(parts[1])


@query
def run_floors(spark, sf_dir):
    """The weekly floors that a job refreshes from their sheet before its run."""
    settings = fx.run_settings(spark, sf_dir, fx.RUN_HABA)
    refresh_floors(spark, settings, fx.RUN_TODAY)
    return dims.read_dimension(spark, settings.floors["CURRENT"]).withColumnsRenamed(
        {"SKU NAME": "sku", MINIS_FLOOR: "minis", LMT_FLOOR: "lmt"}
    )
