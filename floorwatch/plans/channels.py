"""The four channels. All names, patterns and sheet titles below are fixed values."""

from __future__ import annotations

from floorwatch.config import LMT_FLOOR, ChannelConfig, RetailerConfig

DCOMM = ChannelConfig(
    name="DCOMM",
    has_multiplier=True,
    contains_match=True,
    has_location=False,
    keep_location=True,
    keep_raw=True,
    mapping_sheet="Mapping",
    mapping_sku_col="TOP 58",
    competitor_sheet="Mapping SPI CPI Dcomm",
    competitor_sku_col="COMP",
    retailers=(
        RetailerConfig(
            code="LAZADA",
            account="lazada",
            view="lazada",
            file_regex=r"LAZADA[^/]*_(\d{6})\.parquet",
            mapping_col="LAZADA",
            competitor_col="LAZADA",
            multiplier_col="LAZADA MULTIPLIER",
        ),
        RetailerConfig(
            code="BLIBLI",
            account="blibli",
            view="blibli",
            file_regex=r"BLIBLI[^/]*_(\d{6})\.parquet",
            drop_cols=("status",),
            mapping_col="BLIBLI",
            competitor_col="BLIBLI",
            multiplier_col="BLIBLI MULTIPLIER",
        ),
        RetailerConfig(
            code="TOKPED",
            account="tokped",
            view="tokped",
            file_regex=r"TOKOPEDIA[^/]*_(\d{6})\.parquet",
            drop_cols=("status",),
            mapping_col="TOKPED",
            competitor_col="TOKOPEDIA",
            multiplier_col="TOKPED MULTIPLIER",
        ),
    ),
)

HSM = ChannelConfig(
    name="HSM",
    mapping_sheet="Mapping",
    mapping_sku_col="TOP 58",
    competitor_sheet="competitor price",
    competitor_sku_col="COMPETITOR",
    retailers=(
        RetailerConfig(
            code="HYP",
            account="HYPERMART",
            view="hypermart",
            file_regex=r"HYPERMART\d*_(\d{6})",
            mapping_col="HYP",
            competitor_col="HYPERMART",
        ),
        RetailerConfig(
            code="TIP_TOP",
            account="TIPTOP",
            view="tiptop",
            file_regex=r"TIPTOP\d*_(\d{6})",
            floor_col=LMT_FLOOR,
            mapping_col="TIP TOP",
            competitor_col="TIPTOP",
        ),
        RetailerConfig(
            code="LSI",
            account="SUPERINDO",
            view="superindo",
            file_regex=r"SUPERINDO\d*_(\d{6})",
            product_col="combinedProductName",
            renames=(("concat", "combinedProductName"), ("CONCAT", "combinedProductName")),
            mapping_col="LSI",
            competitor_col="SUPERINDO",
        ),
    ),
)

MINIS = ChannelConfig(
    name="MINIS",
    retailers=(
        RetailerConfig(
            code="ALF",
            account="ALFAMART",
            view="alfamart",
            file_regex=r"ALFAGIFT\d*_(\d{6})",
            mapping_sheet="ALF-Definition",
        ),
        RetailerConfig(
            code="IDM",
            account="INDOMARET",
            view="indomaret",
            file_regex=r"INDOMARET\d*_(\d{6})",
            mapping_sheet="IDM-Definition",
        ),
        RetailerConfig(
            code="MIDI",
            account="MIDI",
            view="midi",
            file_regex=r"MIDI\d*_(\d{6})",
            mapping_sheet="MIDI-Definition",
        ),
    ),
)

HABA = ChannelConfig(
    name="HABA",
    has_location=False,
    keep_location=False,
    mapping_sheet="Mapping",
    mapping_sku_col="TOP 58",
    retailers=(
        RetailerConfig(
            code="WATSON",
            account="WATSON",
            view="watson",
            file_regex=r"WATSON\d*_(\d{6})",
            has_competitor=False,
            mapping_col="WATSON",
        ),
        RetailerConfig(
            code="GUARDIAN",
            account="GUARDIAN",
            view="guardian",
            file_regex=r"GUARDIAN\d*_(\d{6})",
            has_competitor=False,
            mapping_col="GUARDIAN",
        ),
    ),
)

CHANNELS = {c.name: c for c in (DCOMM, HSM, MINIS, HABA)}
