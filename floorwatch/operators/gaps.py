"""Which SKUs with a floor in a week have no mapping, or were not seen in a shop?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorwatch.operators.floors import SKU
from floorwatch.operators.joins import dim_join
from floorwatch.operators.match import contains_pairs, distinct_names, mapping_columns
from floorwatch.sources.shared import materialise

# The two messages of the report.
NO_MAPPING = "NO MAPPING IN {}"
NOT_FOUND = "NOT FOUND IN {} STORE (None of the variants)"


def week_rows(df: DataFrame, week: int, year: int) -> DataFrame:
    return df.filter((F.col("week") == week) & (F.col("year") == year))


def seen_pairs(
    facts: DataFrame,
    mapping: DataFrame,
    product_col: str = "productName",
    contains: bool = False,
) -> DataFrame:
    """Distinct (SKUName, name) of the rows given, by any mapped name that fits.

    Works on distinct names, so copies of a listing never travel.
    """
    return pairs_of_names(distinct_names(facts, product_col), mapping, contains)


def pairs_of_names(names: DataFrame, mapping: DataFrame, contains: bool = False) -> DataFrame:
    """`seen_pairs` of names that are distinct already."""
    if contains:
        pairs = contains_pairs(names, mapping)
    else:
        dim = mapping_columns(mapping).filter("mappedName IS NOT NULL")
        pairs = dim_join(names, dim, [("name", "mappedName")], how="inner")
    return pairs.select("SKUName", "name").distinct()


def gap_rows(
    floors: DataFrame,
    mapping: DataFrame,
    facts: DataFrame,
    floor_col: str,
    week: int,
    year: int,
    product_col: str = "productName",
    contains: bool = False,
) -> DataFrame:
    """Floors of the week, with mapped SKU and every name seen for it, NULL where none."""
    asked = week_rows(floors, week, year).select(SKU, "week", "year", floor_col)
    mapped = mapping.select("SKUName").distinct()
    seen = seen_pairs(week_rows(facts, week, year), mapping, product_col, contains)
    known = dim_join(asked, mapped.withColumn("mappedSku", F.col("SKUName")), [(SKU, "SKUName")])
    known = materialise(known, "asked-floors")
    # The names are the long side: each meets its floors, and only floors without any are added.
    found = dim_join(seen, known.filter("mappedSku IS NOT NULL"), [("SKUName", "mappedSku")], how="inner")
    found = found.withColumnRenamed("SKUName", "mappedSku")
    skus = seen.select("SKUName").distinct()
    missed = dim_join(known, skus, [("mappedSku", "SKUName")], how="left_anti")
    columns = [SKU, "week", "year", floor_col, "mappedSku", "name"]
    return found.select(columns).unionByName(
        missed.withColumn("name", F.lit(None).cast("string")).select(columns)
    )


def gap_counts(rows: DataFrame, floor_col: str) -> DataFrame:
    """Distinct mapped SKUs and distinct names per floor.

    Repeated names go first, then both are plain counts: a SKU with very many names is spread by them, and
    reduced in the map tasks before it meets itself. A floor's mapped SKU is its own, so it is there or not.
    """
    keys = [SKU, "week", "year", floor_col]
    mapped = F.when(F.col("mappedSku").isNotNull(), F.lit(1)).otherwise(0).cast("bigint")
    names = rows.groupBy(*keys, "name").agg(F.max(mapped).alias("mapped"))
    return names.groupBy(*keys).agg(
        F.max("mapped").alias("mapping_count"), F.count("name").alias("found_count")
    )


def gap_report(
    floors: DataFrame,
    mapping: DataFrame,
    facts: DataFrame,
    floor_col: str,
    week: int,
    year: int,
    shop: str,
    product_col: str = "productName",
    contains: bool = False,
    names: DataFrame | None = None,
) -> DataFrame:
    """Gaps of one week, ordered; empty when every SKU is mapped and was seen.

    The names are counted per SKU before they meet the floors, so the report
    joins one small row per SKU. ``names`` are the distinct names of the week
    where they are known; then ``facts`` is not read.
    """
    if names is None:
        names = distinct_names(week_rows(facts, week, year), product_col)
    asked = (
        week_rows(floors, week, year)
        .select(SKU, "week", "year", floor_col)
        .distinct()
    )
    mapped = mapping.select(F.col("SKUName").alias("_sku")).distinct()
    seen = (
        pairs_of_names(names, mapping, contains)
        .groupBy("SKUName")
        .agg(F.count("name").alias("found_count"))
    )
    counted = (
        asked.join(mapped, F.col(f"`{SKU}`") == F.col("_sku"), "left")
        .join(seen, F.col("_sku") == F.col("SKUName"), "left")
        .select(
            SKU,
            "week",
            "year",
            floor_col,
            F.when(F.col("_sku").isNotNull(), F.lit(1)).otherwise(0).cast("bigint").alias(
                "mapping_count"
            ),
            F.coalesce("found_count", F.lit(0)).alias("found_count"),
        )
    )
    issue = F.when(F.col("mapping_count") == 0, NO_MAPPING.format(shop)).otherwise(NOT_FOUND.format(shop))
    return (
        counted.filter("mapping_count = 0 OR found_count = 0")
        .withColumn("issue_type", issue)
        .orderBy("issue_type", SKU)
    )
