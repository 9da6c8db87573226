"""The folder that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, else a folder in the warehouse, which is shared too."""
    context = spark.sparkContext
    folder = context.getConf().get(SETTING) or spark.conf.get(SETTING, None)
    if folder:
        return folder
    set_already = context._jsc.sc().getCheckpointDir()
    if set_already.isDefined():
        return set_already.get()
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise RuntimeError(f"Set {SETTING} to a folder that all executors can reach")
    folder = f"{warehouse.rstrip('/')}/_shared"
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write once, read back: no recomputation, and a size the planner knows. Gone when the session ends.

    ``by`` are columns whose values get folders of their own, so that a reader of one value opens no other.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    fs, where = file_system(df.sparkSession, path)
    fs.deleteOnExit(where)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API, for names and renames only."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small marker file, None without it."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small marker file, complete or not there at all."""
    aside = f"{path}.{uuid.uuid4().hex}"
    fs, where = file_system(spark, aside)
    out = fs.create(where, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = hadoop.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(
        where.toUri(), spark._jsc.hadoopConfiguration()
    ) if where.toUri().getScheme() else hadoop.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    context.rename(where, hadoop.Path(path), options)
