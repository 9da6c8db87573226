"""Multipacks: effective multiplier, unit prices, floor flags, and the rules around them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorwatch.config import EXCLUDED_PACKS, PRICE_CAP, PROMO_WORDS
from floorwatch.functions.text import clean_number, plain
from floorwatch.operators.joins import dim_join


def effective_multiplier(mapping_multiplier: Column | None, derived: Column) -> Column:
    """The mapping's multiplier if positive, else the one derived from the name."""
    if mapping_multiplier is None:
        return derived
    given = clean_number(mapping_multiplier)
    return F.when(given > 0, given).otherwise(derived)


def with_multiplier(df: DataFrame) -> DataFrame:
    given = F.col("Multiplier").cast("double") if "Multiplier" in df.columns else None
    return df.withColumn("Multiplier", effective_multiplier(given, F.col("derivedMultiplier")))


def without_packs(df: DataFrame) -> DataFrame:
    """The pack columns of a channel that sells no multipacks."""
    return df.withColumns(
        {
            "packHintText": F.lit(None).cast("string"),
            "derivedMultiplier": F.lit(None).cast("double"),
        }
    )


def below_raw(floor: Column, multiplier: Column | None = None) -> Column:
    """Price per unit under the floor; False where either is unknown."""
    price = F.col("finalPrice").cast("double")
    if multiplier is not None:
        price = F.try_divide(price, F.coalesce(multiplier, F.lit(1.0)))
    return F.coalesce(price < clean_number(floor), F.lit(False))


def below_floor(floor: Column) -> Column:
    """Final price under the floor; False without a floor."""
    floor = clean_number(floor)
    return F.when(floor.isNotNull(), F.col("finalPrice") < floor).otherwise(F.lit(False))


def unit_prices(df: DataFrame) -> DataFrame:
    """Base and final price divided by the multiplier where there is one."""
    by = F.col("Multiplier")

    def per_unit(name: str) -> Column:
        price = F.col(name)
        return F.when(by.isNotNull(), F.try_divide(price, by)).otherwise(price)

    return df.withColumns({c: per_unit(c) for c in ("basePrice", "finalPrice")})


def price_cap(df: DataFrame, cap: float = PRICE_CAP) -> DataFrame:
    """Keep prices up to the cap; unknown prices go too."""
    return df.filter(F.col("finalPrice") <= cap)


def exclude_packs(
    df: DataFrame,
    packs: Sequence[tuple[str, float]] = EXCLUDED_PACKS,
    sku_col: str = "SKUName",
) -> DataFrame:
    """Drop given (SKU, derived multiplier) pairs, and rows that might be one of them.

    A row whose SKU is unknown but whose multiplier fits is dropped as well.
    """
    if not packs:
        return df
    hits = [(F.col(sku_col) == sku) & (F.col("derivedMultiplier") == size) for sku, size in packs]
    return df.filter(~reduce(lambda a, b: a | b, hits))


def speaks_of_promo(words: Sequence[str] = PROMO_WORDS) -> Column:
    hint = F.lower("packHintText")
    return reduce(lambda a, b: a | b, [hint.contains(w) for w in words])


def drop_promos(df: DataFrame, words: Sequence[str] = PROMO_WORDS) -> DataFrame:
    """Drop hints that speak of a promotion; rows without a hint go too."""
    return df.filter(~speaks_of_promo(words))


def manual_rules(sheet: DataFrame) -> DataFrame:
    """Rules with a pattern and a number: SKU NAME, Account, ProductPattern, Multiplier."""
    return (
        sheet.select(
            "SKU NAME",
            "Account",
            "ProductPattern",
            clean_number(F.col("Multiplier").try_cast("double")).alias("Multiplier"),
        )
        .dropna(subset=["ProductPattern", "Multiplier"])
    )


def _rule_keys(rules: DataFrame) -> DataFrame:
    return rules.select(
        plain(F.col("Account")).alias("_account"),
        plain(F.col("`SKU NAME`")).alias("_sku"),
        plain(F.col("ProductPattern")).alias("_hint"),
        F.length("ProductPattern").alias("_length"),
        F.col("Multiplier").cast("double").alias("ruleMultiplier"),
        F.col("ProductPattern").alias("rulePattern"),
    )


def _with_keys(df: DataFrame, sku_col: str) -> DataFrame:
    return df.withColumns(
        {
            "_fa": plain(F.col("account")),
            "_fs": plain(F.col(sku_col)),
            "_fh": plain(F.col("packHintText")),
        }
    )


_KEYS = [("_fa", "_account"), ("_fs", "_sku"), ("_fh", "_hint")]


def override_matches(df: DataFrame, rules: DataFrame, sku_col: str = "SKUName") -> DataFrame:
    """Rows with each rule that names their account, SKU and whole pack hint."""
    return dim_join(_with_keys(df, sku_col), _rule_keys(rules), _KEYS, how="inner").drop(
        "_fa", "_fs", "_fh"
    )


def first_override(matches: DataFrame, sku_col: str = "SKUName") -> DataFrame:
    """One multiplier per account, SKU and product: that of the longest pattern.

    Repeated (key, rule) rows are reduced before the shuffle; among patterns of
    one length the larger multiplier wins.
    """
    return matches.groupBy("account", sku_col, "productName").agg(
        F.max(F.struct("_length", "ruleMultiplier"))["ruleMultiplier"].alias("manualMultiplier")
    )


def first_override_by_window(matches: DataFrame, sku_col: str = "SKUName") -> DataFrame:
    """`first_override` as a window over the distinct (key, rule) rows."""
    keys = ["account", sku_col, "productName"]
    order = Window.partitionBy(*keys).orderBy(F.desc("_length"), F.desc("ruleMultiplier"))
    return (
        matches.select(*keys, "_length", "ruleMultiplier")
        .distinct()
        .withColumn("manualMultiplier", F.first("ruleMultiplier").over(order))
        .select(*keys, "manualMultiplier")
        .distinct()
    )


def _coalesce_override(df: DataFrame, hit: str | None = None) -> DataFrame:
    manual = F.col("manualMultiplier")
    mark = {} if hit is None else {hit: manual.isNotNull()}
    return df.withColumns(
        {
            "Multiplier": F.coalesce(manual, F.col("Multiplier")),
            "derivedMultiplier": F.coalesce(manual, F.col("derivedMultiplier")),
            **mark,
        }
    ).drop("manualMultiplier")


def apply_overrides(df: DataFrame, overrides: DataFrame, sku_col: str = "SKUName") -> DataFrame:
    """Overrides per (account, SKU, product) put before both multipliers."""
    on = [(c, c) for c in ("account", sku_col, "productName")]
    return _coalesce_override(dim_join(df, overrides, on))


def override_rows(
    df: DataFrame,
    rules: DataFrame,
    sku_col: str = "SKUName",
    spread: Column | None = None,
    fits: bool | None = None,
    hit: str | None = None,
) -> DataFrame:
    """`override_matches`, `first_override` and `apply_overrides` in one join.

    A product name has one pack hint, so the rules can be reduced to one per
    (account, SKU, hint) first and the rows need no grouping at all. ``hit``
    names a column that tells which rows met a rule.
    """
    per_key = (
        _rule_keys(rules)
        .groupBy("_account", "_sku", "_hint")
        .agg(F.max(F.struct("_length", "ruleMultiplier"))["ruleMultiplier"].alias("manualMultiplier"))
    )
    joined = dim_join(_with_keys(df, sku_col), per_key, _KEYS, spread=spread, fits=fits)
    return _coalesce_override(joined.drop("_fa", "_fs", "_fh"), hit)


def raw_rows(
    df: DataFrame,
    floor_col: str,
    rules: DataFrame | None = None,
    cap: float = PRICE_CAP,
    packs: Sequence[tuple[str, float]] = EXCLUDED_PACKS,
    sku_col: str = "SKUName",
    spread: Column | None = None,
    rules_fit: bool | None = None,
    hit: str | None = None,
) -> DataFrame:
    """Rows with multipliers and flag, before any price is divided.

    The flag is set from the multiplier as it was before the manual rules.
    """
    flagged = with_multiplier(df)
    flagged = flagged.withColumn(
        "belowBfp", below_raw(F.col(f"`{floor_col}`"), F.col("Multiplier"))
    )
    kept = exclude_packs(price_cap(flagged, cap), packs, sku_col)
    if rules is None:
        return kept if hit is None else kept.withColumn(hit, F.lit(False))
    return override_rows(kept, rules, sku_col, spread, rules_fit, hit)


def processed_rows(
    raw: DataFrame, floor_col: str, promo_words: Sequence[str] = PROMO_WORDS
) -> DataFrame:
    """Unit prices, the flag set anew from them, promotions dropped."""
    divided = unit_prices(raw).withColumn("belowBfp", below_floor(F.col(f"`{floor_col}`")))
    return drop_promos(divided, promo_words)


def both_outputs(
    raw: DataFrame,
    floor_col: str,
    promo_words: Sequence[str] = PROMO_WORDS,
    output_col: str = "_output",
) -> DataFrame:
    """Raw rows and `processed_rows` of one pass, told apart by ``output_col``: 'raw' or 'processed'.

    A row is repeated inside its task, so whatever made it runs once for both.
    """
    outputs = F.array(F.lit("raw"), F.lit("processed"))
    both = raw.withColumn(output_col, F.explode(outputs))
    done = F.col(output_col) == "processed"
    kept = both.filter(~done | ~speaks_of_promo(promo_words))
    by = F.when(done, F.col("Multiplier"))

    def price(name: str) -> Column:
        return F.when(by.isNotNull(), F.try_divide(F.col(name), by)).otherwise(F.col(name))

    priced = kept.withColumns({c: price(c) for c in ("basePrice", "finalPrice")})
    flag = F.when(done, below_floor(F.col(f"`{floor_col}`"))).otherwise(F.col("belowBfp"))
    return priced.withColumn("belowBfp", flag)
