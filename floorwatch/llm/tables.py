"""Reading the given tables, and filters of a fixed size that save shuffling what cannot match."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floorwatch.sources.shared import file_system, materialise, shared_dir

#: Rows of a table that are handed to Python at once; texts are long, so few.
BATCH_ROWS = 1000

#: Bits of a filter over row keys: 2 MB, whatever the number of keys.
KEY_BITS = 24


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Arrow batches are kept small, since one row may hold a whole book."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: cut lineage that outlives executors."""
    return materialise(df, label)


def discard(kept: DataFrame) -> None:
    """Delete a table of keep() that nothing reads any more; what was made of it has to be kept itself."""
    spark = kept.sparkSession
    fs, root = file_system(spark, shared_dir(spark))
    for folder in {name.rpartition("/")[0] for name in kept.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        if where.getParent().toString() == fs.makeQualified(root).toString():  # never a given table
            fs.delete(where, True)


def bit_of(key: Column, bits: int = KEY_BITS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def bitmap_of(df: DataFrame, key: str, bits: int = KEY_BITS) -> np.ndarray:
    """A bitmap of 2**bits bits in which the hash of every key of df is set.

    Its size is fixed, so it may be sent to all tasks at any scale. It never misses a key; with very many
    keys it passes more of the others, which then cost a shuffle but change no result.
    """
    cells = df.select((bit_of(F.col(key), bits) + 1).alias("cell"))
    parts = (
        cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for part in parts:
        at = 4096 * (part["bucket"] - 1)  # buckets of 32,768 values, from 1
        out[at : at + 4096] = np.frombuffer(bytes(part["bits"]), dtype=np.uint8)
    return out


def bits_set(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def has_key(spark: SparkSession, bitmap: np.ndarray, key: Column) -> Column:
    """Whether the bitmap of bitmap_of() may hold the key; never false for a key that it was made from."""
    sent = spark.sparkContext.broadcast(bitmap)
    bits = int(np.log2(len(bitmap) * 8))

    @F.pandas_udf("boolean")
    def found(cell: pd.Series) -> pd.Series:
        return pd.Series(bits_set(sent.value, cell.to_numpy()))

    return found(bit_of(key, bits))
