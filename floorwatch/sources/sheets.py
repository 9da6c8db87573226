"""Worksheets, which arrive as CSV or parquet tables, and the dimensions made from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.config import COMPETITOR_STATUS, TOP_STATUS, RetailerConfig
from floorwatch.functions.text import clean_dimension, clean_number, clean_text

# Column names of a sheet that holds one retailer's mapping.
SHEET_NAMES = {"Product Name": "ProductName", "SKU name": "SKUName"}


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A worksheet exported as CSV with a header line (all text), or as parquet."""
    if path.rstrip("/").lower().endswith(".csv"):
        return spark.read.csv(path, header=True)
    return spark.read.parquet(path)


def unpivot_mapping(
    sheet: DataFrame,
    sku_col: str,
    product_cols: Sequence[tuple[str, str, str | None]],
    status: str,
) -> DataFrame:
    """A sheet with one product column per retailer as (retailer, SKUName, ProductName, ...).

    ``product_cols`` are (retailer, product column, multiplier column or None).
    All retailers come out of one pass; blank products are dropped.
    """
    with_multiplier = any(m is not None for _, _, m in product_cols)

    def entry(retailer: str, product: str, multiplier: str | None):
        fields = [
            F.lit(retailer).alias("retailer"),
            clean_text(F.col(f"`{product}`")).alias("ProductName"),
        ]
        if with_multiplier:
            number = (
                F.lit(None).cast("double")
                if multiplier is None
                else clean_number(F.col(f"`{multiplier}`").try_cast("double"))
            )
            fields.append(number.alias("Multiplier"))
        return F.struct(*fields)

    entries = F.explode(F.array(*[entry(*c) for c in product_cols])).alias("e")
    multiplier = ["e.Multiplier"] if with_multiplier else []
    return (
        sheet.select(clean_text(F.col(f"`{sku_col}`")).alias("SKUName"), entries)
        .select("e.retailer", "SKUName", "e.ProductName", *multiplier)
        .dropna(subset=["ProductName"])
        .withColumn("Status", F.lit(status))
    )


def column_pair_mapping(
    sheet: DataFrame,
    sku_col: str,
    retailers: Sequence[RetailerConfig],
    competitor_sheet: DataFrame | None = None,
    competitor_sku_col: str | None = None,
) -> DataFrame:
    """Mappings of all retailers: Top 58 rows, and competitor rows where there are any.

    A competitor row takes its multiplier from the column of the same name in
    the competitor sheet.
    """
    top = unpivot_mapping(
        sheet, sku_col, [(r.code, r.mapping_col, r.multiplier_col) for r in retailers], TOP_STATUS
    )
    rivals = [r for r in retailers if r.competitor_col]
    if competitor_sheet is None or not rivals:
        return top
    columns = [(r.code, r.competitor_col, r.multiplier_col) for r in rivals]
    return top.unionByName(
        unpivot_mapping(competitor_sheet, competitor_sku_col, columns, COMPETITOR_STATUS)
    )


def sheet_mapping(sheet: DataFrame) -> DataFrame:
    """A sheet that is one retailer's mapping already."""
    return clean_dimension(sheet.withColumnsRenamed(SHEET_NAMES))


def sheet_mappings(sheets: dict[str, DataFrame]) -> DataFrame:
    """Mappings of several sheets, keyed by retailer code, in one table."""
    tagged = [
        sheet_mapping(sheet).withColumn("retailer", F.lit(code)) for code, sheet in sheets.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def mapping_of(mappings: DataFrame, code: str) -> DataFrame:
    return mappings.filter(F.col("retailer") == code).drop("retailer")
