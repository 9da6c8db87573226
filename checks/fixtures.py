"""The library's input tables, derived by Spark from the shared test tables.

Every frame here is built from whole tables, so it grows with them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.config import LMT_FLOOR, MINIS_FLOOR, ChannelConfig, Period, RetailerConfig
from floorwatch.functions.dates import week_columns
from floorwatch.plans.channel import Floors
from floorwatch.plans.channels import DCOMM, HABA, HSM, MINIS
from floorwatch.plans.job import RULES_SHEET, JobSettings
from floorwatch.sources.dims import write_dimension
from floorwatch.sources.files import write_named
from floorwatch.sources.shared import fresh_path, materialise, write_small

PERIODS = (Period("P1", None, 199721), Period("P2", 199721, 199906))
CAP = 60000.0
PACKS = (("RED RING", 2.0),)
GAP_WEEK = (30, 2000)
FIRST_WEEK_DAY, LAST_WEEK_DAY = dt.date(1999, 2, 8), dt.date(2001, 12, 31)
EAST = ("asia", "middle east")

PACK_NAMES = (
    "{}",
    "{} x2",
    "{} isi 3",
    "{} isi 0",
    "{} twinpack",
    "{} twin pack",
    "{} triplepack",
    "{} Triple Pack",
    "buy 2 get 1 {}",
    "beli 3 gratis 1 {}",
    "{} [free mug] buy 2",
    "{} [6 pcs]",
    "{} 6   pcs",
    "{} 6pcsx",
    "sariwangi {} isi 4",
    "{} max 500",
    "BUY 10 GET 2 {} x3",
)

FILE_REGEX = r"SHOP\d*_(\d{6})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(df: DataFrame, columns: str) -> DataFrame:
    return df.selectExpr(*[c.strip() for c in columns.split("|")])


# --- tables and folders written once ----------------------------------------
_staged: dict[tuple, str] = {}


def _stage(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """A folder written once per session and table set."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _staged:
        folder = fresh_path(spark, f"scrapes-{kind}")
        write(folder)
        _staged[key] = folder
    return _staged[key]


def kept(spark: SparkSession, sf_dir: str, kind: str, build) -> DataFrame:
    """A derived table, written once per session and read from then on, as dimensions are."""
    path = _stage(spark, sf_dir, kind, lambda folder: build(spark, sf_dir).write.parquet(folder))
    return spark.read.parquet(path)


# --- observations -----------------------------------------------------------
def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the part name they were made from."""

    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    shops = t("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(shops, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    name = F.col("p_name")
    line = F.col("l_linenumber")
    product = (
        F.when(line == 1, name)
        .when(line == 2, F.concat(name, F.lit(" x2")))
        .when(line == 3, F.concat(name, F.lit(" isi 3")))
        .when(line == 4, F.concat(name, F.lit(" twinpack")))
        .when(line == 5, F.concat(F.lit("buy 2 get 1 "), name))
        .when(line == 6, F.concat(name, F.lit(" 6 pcs")))
        .when(line == 7, F.concat(name, F.lit(" [free mug] buy 2")))
    )
    day = F.col("l_shipdate").cast("date")
    week, year = week_columns(day)
    return lines.select(
        F.lower("r_name").alias("account"),
        F.col("n_name").alias("location"),
        "p_name",
        product.alias("productName"),
        F.concat("n_name", F.lit(" "), product).alias("combinedProductName"),
        F.col("l_extendedprice").alias("basePrice"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("finalPrice"),
        day.alias("date"),
        week,
        year,
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).drop("p_name", "combinedProductName")


def pack_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name in every pack spelling: (name, mappedName), some unmapped."""
    parts = table(spark, sf_dir, "part").select("p_name").distinct()
    spellings = F.explode(F.array(*[F.lit(p) for p in PACK_NAMES])).alias("spelling")
    mapped = F.when(~F.col("p_name").startswith("old "), F.initcap("p_name")).alias("mappedName")
    return parts.select("p_name", spellings).select(
        F.replace(F.col("spelling"), F.lit("{}"), F.upper("p_name")).alias("name"), mapped
    )


# --- dimensions -------------------------------------------------------------
def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "mapping", _mapping)


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (
        table(spark, sf_dir, "part")
        .filter(~F.col("p_name").startswith("old "))
        .select(
            F.upper("p_name").alias("SKUName"),
            F.col("p_name").alias("ProductName"),
            F.when(F.col("p_name").startswith("hot "), "Competitor")
            .otherwise("Top 58")
            .alias("Status"),
            F.when(F.col("p_name").startswith("red "), F.lit(2.0)).alias("Multiplier"),
        )
        .distinct()
    )
    more = spark.sql(
        "SELECT * FROM VALUES ('ANY RING', 'ring', 'Top 58', CAST(NULL AS DOUBLE)), "
        "('OLD LINE', 'old g', 'Competitor', NULL) AS t(SKUName, ProductName, Status, Multiplier)"
    )
    return parts.unionByName(more)


def combined_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "combined", _combined_mapping)


def _combined_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping of the combined names of single packs."""
    base = sales(spark, sf_dir).filter(~F.col("p_name").startswith("old "))
    return base.select(
        F.upper("p_name").alias("SKUName"),
        F.concat("location", F.lit(" "), "p_name").alias("ProductName"),
        F.when(F.col("p_name").startswith("hot "), "Competitor").otherwise("Top 58").alias("Status"),
    ).distinct()


def sku_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (
        table(spark, sf_dir, "part")
        .filter(~F.col("p_name").startswith("hot "))
        .groupBy(F.upper("p_name").alias("SKU NAME"))
        .agg(F.min("p_retailprice").alias("pr"))
    )
    more = spark.sql(
        "SELECT * FROM VALUES ('ANY RING', 900D), ('GHOST SKU', 1D) AS t(`SKU NAME`, pr)"
    )
    return parts.unionByName(more)


def floor_sheet(spark: SparkSession, sf_dir: str, factor: Column | int) -> DataFrame:
    return sku_prices(spark, sf_dir).select(
        "SKU NAME",
        (F.col("pr") * factor).alias(MINIS_FLOOR),
        (F.col("pr") * (factor + 1)).alias(LMT_FLOOR),
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "weekly", _weekly)


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    mondays = F.sequence(
        F.lit(FIRST_WEEK_DAY), F.lit(LAST_WEEK_DAY), F.expr("interval 7 days")
    )
    week, year = week_columns(F.col("monday"))
    factor = F.col("week") % 5 + 20
    return (
        sku_prices(spark, sf_dir)
        .withColumn("monday", F.explode(mondays))
        .select("SKU NAME", "pr", week, year)
        .select(
            "SKU NAME",
            (F.col("pr") * factor).alias(MINIS_FLOOR),
            (F.col("pr") * (factor + 1)).alias(LMT_FLOOR),
            "week",
            "year",
        )
    )


def statics(spark: SparkSession, sf_dir: str) -> list[tuple[Period, DataFrame]]:
    return [
        (period, kept(spark, sf_dir, period.name, lambda s, d, n=n: floor_sheet(s, d, n)))
        for period, n in zip(PERIODS, (20, 22))
    ]


def floors(spark: SparkSession, sf_dir: str) -> Floors:
    return Floors(statics(spark, sf_dir), weekly(spark, sf_dir))


def rules_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "rules", _rules_sheet)


def _rules_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual rules as a sheet has them: text, with blanks, odd case and bad numbers."""
    pairs = sales(spark, sf_dir).select("account", "p_name").distinct()

    def rows(where: str, sku: str, account: str, pattern: str, number: str) -> DataFrame:
        return _rows(
            pairs.filter(where),
            f"{sku} AS `SKU NAME`|{account} AS Account|{pattern} AS ProductPattern|'{number}' AS Multiplier",
        )

    parts = [
        rows("p_name LIKE 'blue %'", "upper(p_name)", "account", "'twinpack'", "4"),
        rows("p_name LIKE 'blue %' AND account = 'asia'", "upper(p_name)", "account", "'twinpack  '", "6"),
        rows("p_name LIKE 'cold %'", "concat(p_name, ' ')", "upper(account)", "' 6 PCS '", "5.5"),
        rows("p_name LIKE 'large %'", "upper(p_name)", "account", "CAST(NULL AS STRING)", "3"),
        rows("p_name LIKE 'small %'", "upper(p_name)", "account", "'x2'", "two"),
        rows("p_name LIKE 'new %'", "upper(p_name)", "'nowhere'", "'x2'", "9"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


REGION_COLUMNS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def wide_sheet(spark: SparkSession, sf_dir: str, rivals: bool = False) -> DataFrame:
    """One product column per region, with blank, empty and 'nan' cells."""
    which = "p_name LIKE 'hot %'" if rivals else "p_name NOT LIKE 'hot %' AND p_name NOT LIKE 'old %'"
    sku = "COMP" if rivals else "TOP 58"
    return _rows(
        table(spark, sf_dir, "part").filter(which).select("p_name").distinct(),
        f"upper(p_name) AS `{sku}`|p_name AS AFRICA"
        "|CASE WHEN p_name NOT LIKE 'blue %' THEN p_name END AS AMERICA"
        "|CASE WHEN p_name LIKE 'cold %' THEN ' ' ELSE p_name END AS ASIA"
        "|CASE WHEN p_name LIKE 'new %' THEN 'nan' ELSE p_name END AS EUROPE"
        "|upper(p_name) AS `MIDDLE EAST`"
        "|CASE WHEN p_name LIKE 'red %' THEN '2' WHEN p_name LIKE 'blue %' THEN 'abc' END AS `ASIA MULTIPLIER`",
    )


def region_retailers() -> list[RetailerConfig]:
    return [
        RetailerConfig(
            code=r,
            account=r.lower(),
            view=r.lower(),
            file_regex="",
            mapping_col=r,
            competitor_col=None if r == "EUROPE" else r,
            multiplier_col="ASIA MULTIPLIER" if r == "ASIA" else None,
        )
        for r in REGION_COLUMNS
    ]


# --- channels ---------------------------------------------------------------
def _retailer(code: str, **more) -> RetailerConfig:
    return RetailerConfig(code=code, account=None, view=code.lower(), file_regex="", **more)


TEST_RULES = {"periods": PERIODS, "price_cap": CAP, "excluded_packs": PACKS}
DCOMM_TEST = replace(DCOMM, retailers=(_retailer("ALL"),), **TEST_RULES)
HSM_TEST = replace(
    HSM,
    retailers=(
        _retailer("EAST", product_col="combinedProductName"),
        _retailer("WEST", floor_col=LMT_FLOOR),
    ),
    **TEST_RULES,
)
MINIS_TEST = replace(MINIS, retailers=(_retailer("EAST"), _retailer("WEST")), **TEST_RULES)
HABA_TEST = replace(
    HABA,
    retailers=(_retailer("EAST", has_competitor=False), _retailer("WEST", has_competitor=False)),
    **TEST_RULES,
)


def halves(df: DataFrame) -> dict[str, DataFrame]:
    east = F.col("account").isin(*EAST)
    return {"EAST": df.filter(east), "WEST": df.filter(~east)}


# --- scrape files -----------------------------------------------------------
def event_scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(
        table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date")),
        "day|event_id|concat(event_type, ' ', user_id) AS productName"
        "|concat(event_type, ' ', user_id, ' @ ', event_type) AS combinedProductName"
        "|event_type AS location|user_id AS plu|event_id * 3 AS sold"
        "|value * 2 AS basePrice|value AS finalPrice|event_type AS status",
    )


def _day_file(df: DataFrame) -> DataFrame:
    name = F.concat(F.lit("SHOP1_"), F.date_format("day", "yyMMdd"), F.lit(".parquet"))
    return df.withColumn("file", name).drop("day")


def dated_folder(spark: SparkSession, sf_dir: str) -> str:
    """All events by day, in one schema, and two names without a real date."""
    base = event_scrapes(spark, sf_dir)

    def write(folder: str) -> None:
        undated = base.filter("location = 'error'").drop("day")
        no_day = base.filter("location = 'click'").drop("day")
        frames = [
            _day_file(base),
            undated.withColumn("file", F.lit("SHOP1_undated.parquet")),
            no_day.withColumn("file", F.lit("SHOP1_250230.parquet")),
        ]
        write_named(reduce(lambda a, b: a.unionByName(b), frames), folder, "file")

    return _stage(spark, sf_dir, "dated", write)


# Day of month -> the columns that a file of that day has.
DRIFT = (
    (
        1,
        6,
        "event_id|productName|combinedProductName|location|plu|sold|basePrice"
        "|CAST(floor(finalPrice) AS BIGINT) AS finalPrice|event_id AS `Unnamed: 0`",
    ),
    (
        7,
        12,
        "event_id|productName|combinedProductName|location|CAST(plu AS STRING) AS plu|basePrice"
        "|CASE WHEN location = 'error' THEN 'n/a' ELSE CAST(finalPrice AS STRING) END AS finalPrice",
    ),
    (
        13,
        18,
        "event_id|plu AS productName|combinedProductName AS concat|location|plu|sold|basePrice|finalPrice",
    ),
    (
        19,
        24,
        "event_id|productName|combinedProductName|location|plu|concat(sold, '.0') AS sold"
        "|basePrice|finalPrice|location AS keyword",
    ),
    (
        25,
        31,
        "event_id|productName|combinedProductName|location|plu|sold|basePrice|finalPrice",
    ),
)


def _write_drifting(spark: SparkSession, sf_dir: str, folder: str) -> None:
    base = event_scrapes(spark, sf_dir)
    for first, last, columns in DRIFT:
        days = base.filter(F.dayofmonth("day").between(first, last))
        write_named(_day_file(_rows(days, f"day|{columns}")), folder, "file")


def drift_folder(spark: SparkSession, sf_dir: str) -> str:
    """All events by day, in five schemas."""
    return _stage(spark, sf_dir, "drift", lambda folder: _write_drifting(spark, sf_dir, folder))


BROKEN = {"SHOP2_240118.parquet": "no parquet at all", "SHOP3_240231.parquet": "PAR1"}


def broken_folder(spark: SparkSession, sf_dir: str) -> str:
    """The same files, and two that nobody can read."""

    def write(folder: str) -> None:
        _write_drifting(spark, sf_dir, folder)
        for name, text in BROKEN.items():
            write_small(spark, f"{folder}/{name}", text)

    return _stage(spark, sf_dir, "broken", write)


# --- an existing track and a new batch --------------------------------------
def event_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(
        table(spark, sf_dir, "events"),
        "concat('U', user_id) AS skuName|props AS url|value AS finalPrice"
        "|event_type AS account|CAST(ts AS DATE) AS date",
    )


def existing_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_track(spark, sf_dir).filter("date < DATE'2024-01-20'")


def new_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = event_track(spark, sf_dir).filter(
        "date >= DATE'2024-01-15' AND account IN ('click', 'view')"
    )
    return later.withColumn("finalPrice", F.col("finalPrice") * 2).drop("url")


TRACK_WINDOWS = {
    "Click": (dt.date(2024, 1, 15), dt.date(2024, 1, 31)),
    "view": (None, dt.date(2024, 1, 31)),
    "purchase": (dt.date(2024, 1, 18), dt.date(2024, 1, 19)),
    "error": (dt.date(2024, 1, 31), dt.date(2024, 1, 15)),
}


# --- whole runs -------------------------------------------------------------
RUN_PERIODS = (Period("P1", None, 200721), Period("P2", 200721, 200906))
RUN_TODAY = dt.date(2011, 12, 30)
RUN_SPLIT = dt.date(2009, 1, 1)
RUN_RULES = TEST_RULES | {"periods": RUN_PERIODS}


def _shop(region: str, **more) -> RetailerConfig:
    return RetailerConfig(
        code=region,
        account=region.lower(),
        view=region.lower().replace(" ", "_"),
        file_regex=region + r"[^/]*_(\d{6})\.parquet",
        **more,
    )


def _column(region: str, **more) -> RetailerConfig:
    return _shop(region, mapping_col=region, competitor_col=region, **more)


RUN_DCOMM = replace(
    DCOMM,
    retailers=(
        _column("AFRICA"),
        _column("ASIA", multiplier_col="ASIA MULTIPLIER"),
        _shop("EUROPE", mapping_col="EUROPE"),
    ),
    **RUN_RULES,
)
RUN_HSM = replace(
    HSM,
    retailers=(
        _column("AFRICA"),
        _column("AMERICA", floor_col=LMT_FLOOR),
        _column(
            "ASIA", product_col="combinedProductName", renames=(("concat", "combinedProductName"),)
        ),
    ),
    **RUN_RULES,
)
RUN_MINIS = replace(
    MINIS,
    retailers=tuple(
        _shop(r, mapping_sheet=f"{r}-Definition") for r in ("EUROPE", "MIDDLE EAST", "AMERICA")
    ),
    **RUN_RULES,
)
RUN_HABA = replace(
    HABA,
    retailers=tuple(
        _shop(r, mapping_col=r, has_competitor=False) for r in ("AFRICA", "MIDDLE EAST")
    ),
    **RUN_RULES,
)


def run_folders(spark: SparkSession, sf_dir: str, part: str) -> dict[str, str]:
    """Scrape files per region: 'first' up to the split, 'all' of them, in two layouts, one of them broken."""

    def write(folder: str) -> None:
        day = F.add_months(F.trunc("date", "quarter"), 120)
        rows = sales(spark, sf_dir).withColumn("day", day).drop("p_name", "date", "week", "year")
        name = F.concat(F.upper("account"), F.lit("_"), F.date_format("day", "yyMMdd"), F.lit(".parquet"))
        rows = rows.withColumn("combinedProductName", F.col("productName")).withColumn("file", name)
        rows = rows.filter(F.col("day") < RUN_SPLIT) if part == "first" else rows
        rows = materialise(rows, "run-rows")
        even = F.quarter("day") % 2 == 0
        for region in REGION_COLUMNS:
            own = rows.filter(F.col("account") == region.lower()).repartition("file")
            new = own.filter(even).drop("day", "account")
            old = own.filter(~even).drop("day", "account").withColumnRenamed("combinedProductName", "concat")
            for layout in (new, old.withColumn("finalPrice", F.col("finalPrice").cast("string"))):
                write_named(layout, f"{folder}/{region}", "file")
        if part == "all":
            write_small(spark, f"{folder}/AMERICA/AMERICA_100215.parquet", "no parquet")

    base = _stage(spark, sf_dir, f"runs-{part}", write)
    return {region: f"{base}/{region}" for region in REGION_COLUMNS}


def run_workbook(spark: SparkSession, sf_dir: str, channel: ChannelConfig) -> str:
    """The worksheets of a channel under the titles that its settings name."""

    def write(folder: str) -> None:
        if channel.mapping_sheet is None:
            whole = mapping(spark, sf_dir).drop("Multiplier")
            sheet = whole.withColumnsRenamed({"ProductName": "Product Name", "SKUName": "SKU name"})
            for r in channel.retailers:
                own = sheet.filter("Status <> 'Competitor'") if r.code == "AMERICA" else sheet
                own.write.parquet(f"{folder}/{r.mapping_sheet}.parquet")
            return
        top = wide_sheet(spark, sf_dir).withColumnRenamed("TOP 58", channel.mapping_sku_col)
        top.write.csv(f"{folder}/{channel.mapping_sheet}.csv", header=True)
        if channel.competitor_sheet:
            rivals = wide_sheet(spark, sf_dir, rivals=True)
            rivals = rivals.withColumnRenamed("COMP", channel.competitor_sku_col)
            rivals.write.parquet(f"{folder}/{channel.competitor_sheet}.parquet")
        rules_sheet(spark, sf_dir).write.parquet(f"{folder}/{RULES_SHEET}.parquet")

    return _stage(spark, sf_dir, f"workbook-{channel.name}", write)


def run_settings(spark: SparkSession, sf_dir: str, channel: ChannelConfig) -> JobSettings:
    """A job whose floors, mappings and tracks are its own, so that runs do not see each other."""
    base = fresh_path(spark, f"run-{channel.name.lower()}")
    paths = {p.name: f"{base}/floors/{p.name}" for p in RUN_PERIODS} | {"CURRENT": f"{base}/floors/weekly"}
    known = weekly(spark, sf_dir).filter("year < 2001").withColumn("year", F.col("year") + 10)
    write_dimension(known, paths["CURRENT"])

    def sheets(folder: str) -> None:
        for title, factor in (("P1", 20), ("P2", 22), ("Weekly", 20)):
            floor_sheet(spark, sf_dir, factor).write.parquet(f"{folder}/{title}.parquet")

    return JobSettings(
        channel,
        run_workbook(spark, sf_dir, channel),
        run_folders(spark, sf_dir, "first"),
        paths,
        f"{base}/mappings",
        f"{base}/track",
        raw_track=f"{base}/raw",
        snapshots=f"{base}/snapshots",
        floor_workbook=_stage(spark, sf_dir, "floor-workbook", sheets),
        floor_sheet="Weekly",
        closed_sheets={"P1": ("P1", "Q1", 2007), "P2": ("P2", "Q2", 2009)},
    )
