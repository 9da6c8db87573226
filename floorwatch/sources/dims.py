"""Dimension tables in parquet: writing, reading, registering by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.functions.text import clean_dimension
from floorwatch.operators.joins import BROADCAST_BYTES, fits_broadcast

# View names of the floor tables.
FLOOR_VIEWS = ("bfp_q1_2025", "bfp_q2_2025", "bfp_top58")


def write_dimension(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return clean_dimension(spark.read.parquet(path))


def register_floor_views(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """Each floor table as a temporary view, read once and cached on first use."""
    for name, path in paths.items():
        read_dimension(spark, path).cache().createOrReplaceTempView(name)
    return list(paths)


def mapping_view(
    spark: SparkSession,
    name: str,
    path: str,
    extracted: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The mapping just extracted, else the stored one, as a view.

    Marked for broadcast only when its measured size allows it.
    """
    df = extracted if extracted is not None else read_dimension(spark, path)
    df = F.broadcast(df) if fits_broadcast(df, limit) else df
    df.createOrReplaceTempView(name)
    return df
