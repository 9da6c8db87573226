"""Floor prices: which floor holds for an observation of a SKU in a week.

Static floor tables hold for a whole period and are keyed by SKU; the weekly
table is keyed by SKU, week and year. All have a 'SKU NAME' column and one
column per price list.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorwatch.config import FIRST_FLOOR_WEEK, Period
from floorwatch.functions.dates import year_week
from floorwatch.operators.joins import BROADCAST_BYTES, dim_join

SKU = "SKU NAME"


def in_period(period: Period, yw: Column | None = None) -> Column:
    yw = year_week(F.col("year"), F.col("week")) if yw is None else yw
    bounds = []
    if period.from_yw is not None:
        bounds.append(yw >= period.from_yw)
    if period.until_yw is not None:
        bounds.append(yw < period.until_yw)
    return reduce(lambda a, b: a & b, bounds, yw.isNotNull())


def period_filter(facts: DataFrame, period: Period) -> DataFrame:
    return facts.filter(in_period(period))


def static_floors(floors: DataFrame, floor_col: str) -> DataFrame:
    return floors.select(SKU, floor_col)


def weekly_floors(floors: DataFrame, floor_col: str) -> DataFrame:
    return floors.select(SKU, "week", "year", floor_col)


def join_static(
    facts: DataFrame,
    floors: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
    spread: Column | None = None,
) -> DataFrame:
    """Left join on SKU alone."""
    return dim_join(facts, static_floors(floors, floor_col), [(sku_col, SKU)], spread=spread)


def join_weekly(
    facts: DataFrame,
    floors: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
    spread: Column | None = None,
) -> DataFrame:
    """Left join on SKU, week and year."""
    on = [(sku_col, SKU), ("week", "week"), ("year", "year")]
    return dim_join(facts, weekly_floors(floors, floor_col), on, spread=spread)


def floor_union(
    facts: DataFrame,
    statics: Sequence[tuple[Period, DataFrame]],
    weekly: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
) -> DataFrame:
    """One branch per static period plus one weekly branch over all rows.

    The weekly branch has no period filter, so a row of a static period comes
    out twice, once with the static floor and once with the weekly one (mostly
    NULL).
    """
    branches = [
        join_static(period_filter(facts, period), floors, floor_col, sku_col)
        for period, floors in statics
    ]
    branches.append(join_weekly(facts, weekly, floor_col, sku_col))
    return reduce(lambda a, b: a.unionByName(b), branches)


def _branches(periods: Sequence[Period], weekly_branch: int) -> Column:
    """Numbers of the branches that a row belongs to; the weekly one is always among them."""
    weekly = F.lit(weekly_branch)
    ordered = sorted(periods, key=lambda p: p.from_yw or 0)
    apart = all(
        a.until_yw is not None and b.from_yw is not None and a.until_yw <= b.from_yw
        for a, b in zip(ordered, ordered[1:])
    )
    if not apart:
        held = [F.when(in_period(p), F.lit(i)) for i, p in enumerate(periods)]
        return F.array_compact(F.array(*held, weekly))
    # At most one static period holds: constant arrays, chosen by a plain CASE.
    chosen = F.array(weekly)
    for i, period in enumerate(periods):
        chosen = F.when(in_period(period), F.array(F.lit(i), weekly)).otherwise(chosen)
    return chosen


def floor_single_pass(
    facts: DataFrame,
    statics: Sequence[tuple[Period, DataFrame]],
    weekly: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
    spread: Column | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """The rows of `floor_union` from one scan and one join.

    Each row is repeated inside its task for the branches it belongs to, and
    all floor tables form one dimension keyed by branch, SKU and week.
    """
    weekly_branch = len(statics)
    dim = reduce(
        lambda a, b: a.unionByName(b),
        [
            static_floors(floors, floor_col).select(
                F.lit(i).alias("_b"), F.lit(0).alias("_yw"), SKU, floor_col
            )
            for i, (_, floors) in enumerate(statics)
        ]
        + [
            weekly_floors(weekly, floor_col).select(
                F.lit(weekly_branch).alias("_b"),
                year_week(F.col("year"), F.col("week")).cast("int").alias("_yw"),
                SKU,
                floor_col,
            )
        ],
    )
    yw = year_week(F.col("year"), F.col("week")).cast("int")
    periods = [period for period, _ in statics]
    repeated = facts.withColumn("_branch", F.explode(_branches(periods, weekly_branch))).withColumn("_week_key", F.when(F.col("_branch") == weekly_branch, yw).otherwise(0))
    on = [(sku_col, SKU), ("_branch", "_b"), ("_week_key", "_yw")]
    return dim_join(repeated, dim, on, spread=spread, fits=fits).drop("_branch", "_week_key")


def _ordinal(year: Column, week: Column) -> Column:
    """Weeks numbered without gaps but for a missing 53rd: a place in an array."""
    return (year * 53 + week).cast("int")


def _tagged_floors(
    statics: Sequence[tuple[Period, DataFrame]], weekly: DataFrame, floor_col: str
) -> DataFrame:
    """SKU, branch, week number (weekly branch only) and price of every entry of the floor tables."""
    branch = len(statics)
    price = F.col(f"`{floor_col}`").alias("_price")
    tagged = [
        floors.select(SKU, F.lit(i).alias("_branch"), F.lit(None).cast("int").alias("_week"), price)
        for i, (_, floors) in enumerate(statics)
    ]
    dated = weekly.filter("year IS NOT NULL AND week IS NOT NULL")
    week = _ordinal(F.col("year"), F.col("week")).alias("_week")
    tagged.append(dated.select(SKU, F.lit(branch).alias("_branch"), week, price))
    return reduce(lambda a, b: a.unionByName(b), tagged)


def floor_slots(entries: DataFrame, branches: int, unique: bool) -> DataFrame:
    """One row per SKU: the floors of each static period (_s0, _s1...), and those of every week by place.

    `_weeks` starts at the SKU's first week, which is number `_first`. A slot is the floor where every SKU has one
    entry for it (``unique``), else the list of its entries; an entry without a price is an entry.
    """
    if unique:
        slots = entries.withColumn("_slot", F.col("_price"))
    else:
        listed = F.collect_list(F.struct(F.col("_price").alias("floor")))
        slots = entries.groupBy(SKU, "_branch", "_week").agg(listed.alias("_slot"))
    dated = F.when(F.col("_week").isNotNull(), F.struct("_week", "_slot"))
    per_sku = slots.groupBy(SKU).agg(
        *[
            F.first(F.when(F.col("_branch") == i, F.col("_slot")), ignorenulls=True).alias(f"_s{i}")
            for i in range(branches)
        ],
        F.min("_week").alias("_first"),
        F.max("_week").alias("_last"),
        F.map_from_entries(F.collect_list(dated)).alias("_by_week"),
    )
    weeks = F.when(
        F.col("_first").isNotNull(),
        F.transform(F.sequence("_first", "_last"), lambda w: F.try_element_at("_by_week", w)),
    )
    return per_sku.withColumn("_weeks", weeks).drop("_last", "_by_week")


def floor_range(
    facts: DataFrame,
    statics: Sequence[tuple[Period, DataFrame]],
    weekly: DataFrame,
    floor_col: str,
    sku_col: str = "SKUName",
    spread: Column | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Exactly one period per row: the floors that hold in its week, whichever table they come from.

    An equality join on SKU alone meets one dimension row, however many periods and weeks there are, and the week
    is a place in its array. A row whose week has several floors is repeated for each, as a join would; where the
    tables hold none twice and do not overlap, which one small job over them tells, nothing is exploded.
    """
    entries = _tagged_floors(statics, weekly, floor_col)
    names = [f"_s{i}" for i in range(len(statics))]
    shape = (
        entries.groupBy(SKU, "_branch", "_week").agg(F.count("*").alias("n"))
        .groupBy(SKU)
        .agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.min("_week").alias("first"), F.max("_week").alias("last"))
        .agg(
            F.max("most").alias("most"),
            F.min("first").alias("first"),
            F.sum(
                64 + F.coalesce(F.octet_length(F.col(f"`{SKU}`")), F.lit(0)) + 32 * F.col("n")
                + 16 * F.coalesce(F.col("last") - F.col("first"), F.lit(0))
            ).alias("bytes"),
        )
        .first()
    )
    periods = sorted((p for p, _ in statics), key=lambda p: p.from_yw or 0)
    apart = all(
        a.until_yw is not None and b.from_yw is not None and a.until_yw <= b.from_yw
        for a, b in zip(periods, periods[1:])
    )
    if shape["first"] is not None and periods:
        end = periods[-1].until_yw
        apart = apart and end is not None and shape["first"] >= end // 100 * 53 + end % 100
    unique = (shape["most"] or 0) <= 1
    if fits is None:
        fits = (shape["bytes"] or 0) <= BROADCAST_BYTES
    yw = year_week(F.col("year"), F.col("week"))
    place = _ordinal(F.col("year"), F.col("week")) - F.col("_first")
    held = [F.when(in_period(p, yw), F.col(n)) for n, (p, _) in zip(names, statics)]
    held.append(F.when(place >= 0, F.get("_weeks", place)))
    unique = unique and apart
    dim = floor_slots(entries, len(statics), unique)
    joined = dim_join(facts, dim, [(sku_col, SKU)], spread=spread, fits=fits)
    if unique:
        found = joined.withColumn(floor_col, F.coalesce(*held))
    else:
        empty = F.array().cast(f"array<struct<floor:{_kind(statics, weekly, floor_col)}>>")
        every = F.concat(*[F.coalesce(h, empty) for h in held])
        found = joined.withColumn("_held", F.explode_outer(every)).withColumn(floor_col, F.col("_held.floor")).drop("_held")
    return found.drop("_first", "_weeks", *names)


def _kind(statics: Sequence[tuple[Period, DataFrame]], weekly: DataFrame, floor_col: str) -> str:
    tables = [t for _, t in statics] + [weekly]
    union = reduce(lambda a, b: a.unionByName(b), [t.select(floor_col) for t in tables])
    return union.schema[0].dataType.simpleString()


def range_is_exact(
    mapping: DataFrame,
    statics: Sequence[tuple[Period, DataFrame]],
    weekly: DataFrame,
    floor_col: str,
) -> bool:
    """May `floor_range` replace `floor_union` before the final view?

    Yes if no competitor SKU has a floor and the weekly table starts after
    the static periods. Looks at dimensions only.
    """
    ends = [p.until_yw for p, _ in statics]
    if any(e is None for e in ends):
        return False
    yw = year_week(F.col("year"), F.col("week"))
    early = weekly.filter((yw < max(ends)) & F.col(f"`{floor_col}`").isNotNull())
    priced = reduce(
        lambda a, b: a.unionByName(b),
        [t.select(SKU, floor_col) for _, t in statics] + [weekly.select(SKU, floor_col)],
    ).filter(F.col(f"`{floor_col}`").isNotNull())
    rivals = mapping.filter(F.col("Status") == "Competitor").select("SKUName")
    clash = rivals.join(priced, F.col("SKUName") == F.col(f"`{SKU}`"), "left_semi")
    return early.isEmpty() and clash.isEmpty()


def expand_weeks(
    sheet: DataFrame, last_week: int, year: int, first_week: int = FIRST_FLOOR_WEEK
) -> DataFrame:
    """The floor sheet once per week from ``first_week`` on; empty before it."""
    weeks = F.when(
        F.lit(last_week) >= F.lit(first_week), F.sequence(F.lit(first_week), F.lit(last_week))
    )
    return sheet.withColumn("week", F.explode(weeks)).withColumn("year", F.lit(year))


def append_missing_weeks(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Weeks already in the table keep their prices; only absent weeks are added."""
    known = existing.select("year", "week").distinct()
    added = dim_join(new, known, [("year", "year"), ("week", "week")], how="left_anti")
    return existing.unionByName(added, allowMissingColumns=True)


def refresh_weekly(sheet: DataFrame, existing: DataFrame | None, as_of: dt.date) -> DataFrame:
    """The weekly floor table brought up to the ISO week of ``as_of``."""
    year, week, _ = as_of.isocalendar()
    new = expand_weeks(sheet, week, year)
    return new if existing is None else append_missing_weeks(existing, new)


def historical_floors(sheet: DataFrame, quarter: str, year: int) -> DataFrame:
    """A closed period's sheet, tagged with its quarter and year."""
    return sheet.withColumn("Quartal", F.lit(quarter)).withColumn("year", F.lit(year))
