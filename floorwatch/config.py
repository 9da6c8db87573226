"""Settings of a channel: plain data, no paths baked in, no globals to patch."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# Column types every scrape is brought to, whatever the file stored.
SCRAPE_TYPES = {
    "productName": "string",
    "combinedProductName": "string",
    "location": "string",
    "shop": "string",
    "image": "string",
    "url": "string",
    "plu": "bigint",
    "sold": "bigint",
    "basePrice": "double",
    "finalPrice": "double",
    "discountPercent": "double",
}
FILE_DATE_FORMAT = "yyMMdd"
TEXT_DATE_FORMAT = "M/d/yyyy"
MINIS_FLOOR = "BFP Summary Minis"
LMT_FLOOR = "BFP LMT"
TOP_STATUS = "Top 58"
COMPETITOR_STATUS = "Competitor"
PRICE_CAP = 600000.0
EXCLUDED_PACKS = (("PEPSODENT WHITE RL 12X3X225G", 2.0),)
PROMO_WORDS = ("free", "gratis", "bundle", "brand box", "mystery box")
FIRST_FLOOR_WEEK = 6
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Period:
    """A span of weeks, as year*100+week, lower bound inclusive, upper exclusive."""

    name: str
    from_yw: int | None
    until_yw: int | None


# The two closed floor periods.
STATIC_PERIODS = (
    Period("Q1_2025", None, 202521),
    Period("Q2_2025", 202521, 202606),
)


@dataclass(frozen=True)
class RetailerConfig:
    """One source of observations.

    ``account`` None means that the rows already carry their account.
    """

    code: str
    account: str | None
    view: str
    file_regex: str
    product_col: str = "productName"
    floor_col: str = MINIS_FLOOR
    drop_cols: tuple[str, ...] = ()
    renames: tuple[tuple[str, str], ...] = ()
    has_competitor: bool = True
    mapping_col: str | None = None
    competitor_col: str | None = None
    multiplier_col: str | None = None
    mapping_sheet: str | None = None


@dataclass(frozen=True)
class ChannelConfig:
    name: str
    retailers: tuple[RetailerConfig, ...]
    has_multiplier: bool = False
    contains_match: bool = False
    has_location: bool = True
    """Whether retailer frames carry a store location of their own."""
    keep_location: bool = True
    """Whether the track has a location column at all."""
    keep_raw: bool = False
    sku_col: str = "SKUName"
    periods: tuple[Period, ...] = STATIC_PERIODS
    price_cap: float = PRICE_CAP
    excluded_packs: tuple[tuple[str, float], ...] = EXCLUDED_PACKS
    promo_words: tuple[str, ...] = field(default=PROMO_WORDS)
    mapping_sheet: str | None = None
    mapping_sku_col: str | None = None
    competitor_sheet: str | None = None
    competitor_sku_col: str | None = None
