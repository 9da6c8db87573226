"""Bring the files of a folder to one schema, as one Spark job into a new folder."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorwatch.functions.text import has_sold_words, is_fraction, sold_count, to_price, to_whole
from floorwatch.operators.joins import dim_join
from floorwatch.sources.drift import inspect, layout_groups, newest_file
from floorwatch.sources.files import list_files, read_folder, scanned_label, write_named

# --- Fixed values -----------------------------------------------------------
PRICE_COLUMNS = ("basePrice", "finalPrice", "discountPercent")
WHOLE_COLUMNS = ("plu", "sold", "stock")
TEXT_COLUMNS = ("location", "productName")
JOIN_NAME = "combinedProductName"
OLD_JOIN_NAMES = ("concat", "CONCAT")
OLD_LAYOUT = {
    "Name": "productName",
    "Price": "finalPrice",
    "Regular Price": "basePrice",
    "Discount (%)": "discountPercent",
    "Image URL": "image",
    "Product URL": "url",
    "Keyword": "keyword",
}
OLD_LAYOUT_SIGNS = ("Name", "Price", "Regular Price", "Discount (%)", "Image URL", "Product URL")
OLD_LAYOUT_SHOP = "Guardian"
OLD_LAYOUT_COLUMNS = (
    "keyword",
    "productName",
    "basePrice",
    "finalPrice",
    "discountPercent",
    "image",
    "url",
    "shop",
    "sold",
)
OLD_LAYOUT_RETAILER = "GUARDIAN"
SOLD_WORDS_RETAILER = "LAZADA"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Normalised:
    report: DataFrame
    """label, status ('fixed', 'ok' or 'error'), fractions (whole-number cells set to NULL), error."""
    summary: DataFrame
    """status, files; with a 'total' row."""


def fix_prices(df: DataFrame) -> DataFrame:
    names = [c for c in PRICE_COLUMNS if c in df.columns]
    return df.withColumns({c: to_price(F.col(c)) for c in names}) if names else df


def fix_whole_numbers(df: DataFrame) -> DataFrame:
    names = [c for c in WHOLE_COLUMNS if c in df.columns]
    return df.withColumns({c: to_whole(F.col(c)) for c in names}) if names else df


def fix_text(df: DataFrame) -> DataFrame:
    names = [c for c in TEXT_COLUMNS if c in df.columns]
    return df.withColumns({c: F.col(c).cast("string") for c in names}) if names else df


def rename_join_name(df: DataFrame) -> DataFrame:
    """Every older spelling into one column; the first one that has a value counts."""
    names = [c for c in (JOIN_NAME, *OLD_JOIN_NAMES) if c in df.columns]
    if not names or names == [JOIN_NAME]:
        return df
    value = F.coalesce(*[F.col(f"`{c}`") for c in names])
    kept = [c for c in df.columns if c not in names]
    return df.select(*[F.col(f"`{c}`") for c in kept], value.alias(JOIN_NAME))


def keep_columns(df: DataFrame, canonical: Sequence[str]) -> DataFrame:
    wanted = {*canonical, JOIN_NAME}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted])


def is_old_layout(columns: Sequence[str]) -> bool:
    return bool(set(columns) & set(OLD_LAYOUT_SIGNS))


def migrate_old_layout(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    renamed = df.withColumnsRenamed({k: v for k, v in OLD_LAYOUT.items() if k in df.columns})
    if "shop" not in renamed.columns:
        renamed = renamed.withColumn("shop", F.lit(OLD_LAYOUT_SHOP))
    if "sold" not in renamed.columns:
        renamed = renamed.withColumn("sold", F.lit(None).cast("bigint"))
    return renamed.select(*[c for c in OLD_LAYOUT_COLUMNS if c in renamed.columns], *also)


def files_with_sold_words(df: DataFrame, label_col: str = "_file") -> DataFrame:
    """Per file: is any sold count written in words?"""
    return df.groupBy(label_col).agg(has_sold_words(F.col("sold")).alias("in_words"))


def drift_report(columns: DataFrame, canonical: Sequence[str]) -> DataFrame:
    """Per file, from its footer: why it needs fixing, if it does."""
    column, kind = F.col("column"), F.col("type")
    text = kind.isin("string", "large_string")
    reasons = {
        "renamable": column.isin(*OLD_JOIN_NAMES),
        "unknown": ~column.isin(*canonical, JOIN_NAME, *OLD_JOIN_NAMES),
        "price_type": column.isin(*PRICE_COLUMNS) & (kind != "double"),
        "text_type": column.isin(*TEXT_COLUMNS) & ~text,
        "whole_type": column.isin(*WHOLE_COLUMNS) & (kind != "int64"),
    }
    flags = columns.groupBy("label").agg(*[F.bool_or(c).alias(n) for n, c in reasons.items()])
    any_reason = F.col("renamable")
    for name in list(reasons)[1:]:
        any_reason = any_reason | F.col(name)
    return flags.withColumn("needs_fix", any_reason)


def _fractions(df: DataFrame) -> DataFrame:
    """Cells per file that a whole-number column cannot hold."""
    lost = F.lit(0)
    for c in WHOLE_COLUMNS:
        if c in df.columns:
            lost = lost + is_fraction(F.col(c)).cast("int")
    return df.groupBy(F.col("_file").alias("label")).agg(F.sum(lost).alias("fractions"))


def normalise_folder(
    spark: SparkSession, folder: str, target: str, retailer: str, file_regex: str = r"_(\d{6})"
) -> Normalised | None:
    """Write every file of ``folder``, repaired, under the same name into ``target``.

    The source folder is never changed. Files that cannot be read are reported
    with their error, and the others are written all the same. None when the
    folder has no files.
    """
    found = inspect(list_files(spark, folder, file_regex))
    newest = newest_file(found.columns)
    if newest is None and found.unreadable.isEmpty():
        return None
    broken = found.unreadable.groupBy("label").agg(F.min("error").alias("error")).select(
        "label", F.lit("error").alias("status"), F.lit(0).cast("bigint").alias("fractions"), "error"
    )
    if newest is None:
        return Normalised(broken, count_statuses(broken))
    if retailer == OLD_LAYOUT_RETAILER:
        canonical = list(OLD_LAYOUT_COLUMNS)
    else:
        canonical = read_folder(spark, newest).columns

    lost: DataFrame | None = None
    migrated: DataFrame | None = None
    for layout, paths in layout_groups(found.columns):
        names = [part["column"] for part in json.loads(layout)]
        df = read_folder(spark, *paths).select("*", scanned_label().alias("_file"))
        pieces = []
        special: DataFrame | None = None
        if retailer == OLD_LAYOUT_RETAILER and is_old_layout(names):
            special = df.select("_file").distinct()
            pieces.append(migrate_old_layout(df, also=["_file"]))
        elif (
            retailer == SOLD_WORDS_RETAILER
            and "sold" in names
            and isinstance(df.schema["sold"].dataType, T.StringType)
        ):
            flags = files_with_sold_words(df)
            flagged = dim_join(df, flags.withColumnRenamed("_file", "_ff"), [("_file", "_ff")])
            special = flags.filter("in_words").select("_file")
            in_words = flagged.filter("in_words").drop("in_words")
            pieces.append(in_words.withColumn("sold", sold_count(F.col("sold"))))
            pieces.append(_generic(flagged.filter("NOT in_words").drop("in_words"), canonical))
        else:
            pieces.append(_generic(df, canonical))
        for piece in pieces:
            write_named(fix_whole_numbers(fix_prices(piece)), target, "_file")
        if special is not None:
            migrated = special if migrated is None else migrated.unionByName(special)
        losses = _fractions(df)
        lost = losses if lost is None else lost.unionByName(losses)

    report = drift_report(found.columns, canonical).select("label", "needs_fix")
    if migrated is not None:
        seen = migrated.select(F.col("_file").alias("label"), F.lit(True).alias("special")).distinct()
        report = report.join(seen, "label", "left")
    else:
        report = report.withColumn("special", F.lit(None).cast("boolean"))
    fixed = F.col("needs_fix") | F.coalesce("special", F.lit(False))
    per_file = lost.groupBy("label").agg(F.sum("fractions").alias("fractions"))
    report = report.join(per_file, "label", "left").select(
        "label",
        F.when(fixed, "fixed").otherwise("ok").alias("status"),
        F.coalesce("fractions", F.lit(0)).alias("fractions"),
        F.lit(None).cast("string").alias("error"),
    )
    report = report.unionByName(broken)
    return Normalised(report, count_statuses(report))


def _generic(df: DataFrame, canonical: Sequence[str]) -> DataFrame:
    return fix_text(keep_columns(rename_join_name(df), [*canonical, "_file"]))


def count_statuses(report: DataFrame) -> DataFrame:
    status = F.coalesce("status", F.lit("total")).alias("status")
    return report.rollup("status").agg(F.count("*").alias("files")).select(status, "files")
