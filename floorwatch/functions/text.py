"""Text columns: cleaning, pack hints, pack sizes, sold counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
BLANK_WORDS = ("", "nan", "None")
SOLD_PATTERN = r"([\d.]+)\s*([KkMm]?)\s*Terjual"
SOLD_WORD = "terjual"
# Pack size patterns in order of rank, with the capture groups to add up.
PACK_PATTERNS = (
    (r"buy\s+([0-9]+)\s+get\s+([0-9]+)", (1, 2)),
    (r"beli\s+([0-9]+)\s+gratis\s+([0-9]+)", (1, 2)),
    (r"\[free\s+[^\]]+\]\s*buy\s+([0-9]+)", (1,)),
    (r"\[\s*([0-9]+)\s*pcs?\s*\]", (1,)),
    (r"([0-9]+)\s*pcs?\b", (1,)),
    (r"isi\s*([0-9]+)", (1,)),
    (r"x\s*([0-9]+)", (1,)),
)
# A pattern that does not count when the product name matches the second one.
PACK_EXCEPTIONS = {r"isi\s*([0-9]+)": r"sariwangi.*isi"}
PACK_WORDS = (("twinpack", 2.0), ("twin pack", 2.0), ("triplepack", 3.0), ("triple pack", 3.0))
# ----------------------------------------------------------------------------


def plain(col: Column) -> Column:
    """Lower case without outer blanks: the form in which names are compared."""
    return F.lower(F.trim(col))


def clean_text(col: Column) -> Column:
    """Text cells that a sheet export left blank become NULL."""
    text = col.cast("string")
    return F.when(~F.trim(text).isin(*BLANK_WORDS), text)


def clean_number(col: Column) -> Column:
    """NaN is not a number to compare with: it becomes NULL."""
    return F.when(~F.isnan(col), col)


def clean_dimension(df: DataFrame) -> DataFrame:
    """Drop index columns, blank text to NULL, NaN to NULL."""
    kept = [f for f in df.schema.fields if not f.name.startswith("Unnamed")]

    def fix(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            col = clean_text(col)
        elif isinstance(field.dataType, T.FloatType | T.DoubleType):
            col = clean_number(col)
        return col.alias(field.name)

    return df.select(*[fix(f) for f in kept])


def pack_hint(product: Column, mapped: Column) -> Column:
    """What is left of a product name once the mapped name is taken out."""
    name = F.lower(product)
    left_over = F.when(
        F.length(F.trim(mapped)) > 0, F.replace(name, F.lower(mapped), F.lit(" "))
    ).otherwise(name)
    return F.trim(F.regexp_replace(left_over, r"\s+", " "))


def pack_size(hint: Column, product: Column) -> Column:
    """Number of units a hint speaks of; 1 when it speaks of none."""
    text = F.lower(hint)
    cases: list[tuple[Column, Column]] = []
    for pattern, groups in PACK_PATTERNS:
        hit = text.rlike(pattern)
        if pattern in PACK_EXCEPTIONS:
            hit = hit & ~F.lower(product).rlike(PACK_EXCEPTIONS[pattern])
        numbers = [F.regexp_extract(text, pattern, g).try_cast("double") for g in groups]
        cases.append((hit, reduce(lambda a, b: a + b, numbers)))
    cases += [(text.contains(word), F.lit(size)) for word, size in PACK_WORDS]
    chain = F.when(*cases[0])
    for hit, size in cases[1:]:
        chain = chain.when(hit, size)
    return chain.otherwise(F.lit(1.0))


def sold_count(text: Column) -> Column:
    """'140.8K Terjual' as 140800; NULL for anything of another shape."""
    number = F.regexp_extract(text, SOLD_PATTERN, 1).try_cast("double")
    unit = F.upper(F.regexp_extract(text, SOLD_PATTERN, 2))
    factor = F.when(unit == "K", 1e3).when(unit == "M", 1e6).otherwise(1.0)
    return (number * factor).try_cast("bigint")


def has_sold_words(text: Column) -> Column:
    """Aggregate: does any value carry a count in words?"""
    return F.coalesce(F.bool_or(F.lower(text.cast("string")).contains(SOLD_WORD)), F.lit(False))


def to_price(col: Column) -> Column:
    return clean_number(col.try_cast("double"))


def to_whole(col: Column) -> Column:
    """Whole numbers, from whatever type; NULL for text or a fraction."""
    number = col.try_cast("double")
    exact = F.regexp_extract(col.cast("string"), r"^\s*([+-]?\d+)\s*$", 1).try_cast("bigint")
    return F.coalesce(exact, F.when(number == F.floor(number), number.try_cast("bigint")))


def is_fraction(col: Column) -> Column:
    """True where `to_whole` drops a number because it is not whole."""
    number = col.try_cast("double")
    return F.coalesce(~F.isnan(number) & (number != F.floor(number)), F.lit(False))
