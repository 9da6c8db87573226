"""Joins of a large side with a dimension whose size is measured, never assumed.

A dimension is broadcast only when its measured width times rows stays under a
limit. Beyond the limit the join shuffles, and keys that hold a large share of
the rows are split over several tasks, with only the dimension rows of those
keys repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
HOT_PARTS = 200
"""A key is hot when it holds more than 1/HOT_PARTS of the rows: at most that many exist."""
SALTS = 64


def width(df: DataFrame) -> Column:
    """Bytes of a row, by its columns' types and the length of its texts."""
    total = F.lit(16 * len(df.columns) + 16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return total


def measured_bytes(df: DataFrame) -> int:
    """Rows times width, from one aggregate over the dimension."""
    return df.agg(F.sum(width(df).cast("bigint")).alias("n")).first()["n"] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def hot_keys(facts: DataFrame, keys: Sequence[str], parts: int = HOT_PARTS) -> DataFrame:
    """Keys with more than 1/parts of all rows; counted with map-side sums.

    Fewer than ``parts`` rows by construction, so they may pass through the driver.
    """
    total = facts.count()
    hot = facts.groupBy(*keys).count().filter(F.col("count") * parts > total).drop("count")
    return facts.sparkSession.createDataFrame(hot.collect(), hot.schema)


def dim_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    also: Column | None = None,
    spread: Column | None = None,
    limit: int = BROADCAST_BYTES,
    fits: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` to ``dim`` on (fact column, dimension column) pairs.

    The dimension's key columns are not in the result. ``also`` is a further
    condition over both sides. ``spread`` decides how the rows of a hot key are
    divided; the default is a hash of the row. Give a row position instead
    (only for rows straight from a scan, where it is stable) when whole copies
    of one row may be very frequent.
    """
    keyed = dim.select(
        *[F.col(f"`{d}`").alias(f"_k{i}") for i, (_, d) in enumerate(on)],
        *[F.col(f"`{c}`") for c in dim.columns if c not in {d for _, d in on}],
    )
    key_names = [f"_k{i}" for i in range(len(on))]
    same = [F.col(f"`{f}`") == F.col(k) for (f, _), k in zip(on, key_names)]
    extra = [also] if also is not None else []

    if fits is None:
        fits = fits_broadcast(dim, limit)
    if fits:
        joined = facts.join(F.broadcast(keyed), [*same, *extra], how)
        return joined.drop(*key_names)

    fact_keys = [f for f, _ in on]
    hot = hot_keys(facts, fact_keys).select(
        *[F.col(f"`{f}`").alias(f"_h{i}") for i, f in enumerate(fact_keys)],
        F.lit(True).alias("_hot"),
    )
    is_hot = [F.col(f"`{f}`") == F.col(f"_h{i}") for i, f in enumerate(fact_keys)]
    no_key = F.lit(False)
    for f in fact_keys:
        no_key = no_key | F.col(f"`{f}`").isNull()
    if spread is None:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    salted = (
        facts.join(F.broadcast(hot), is_hot, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_hot") | no_key, F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0),
        )
        .drop("_hot", *[f"_h{i}" for i in range(len(on))])
    )
    dim_hot = [F.col(k) == F.col(f"_h{i}") for i, k in enumerate(key_names)]
    repeated = (
        keyed.join(F.broadcast(hot), dim_hot, "left")
        .withColumn(
            "_dsalt",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                    F.array(F.lit(0))
                )
            ),
        )
        .drop("_hot", *[f"_h{i}" for i in range(len(on))])
    )
    joined = salted.join(repeated, [*same, F.col("_salt") == F.col("_dsalt"), *extra], how)
    return joined.drop("_salt", "_dsalt", *key_names)
