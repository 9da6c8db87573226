"""Free-text product names to SKUs.

A mapping has SKUName, ProductName, Status and optionally Multiplier. Matching
adds SKUName, mappedName, Status (and Multiplier) to the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorwatch.functions.text import pack_hint, pack_size, plain
from floorwatch.operators.joins import BROADCAST_BYTES, dim_join, width

GRAM = 6
CELL_BITS = 21
"""At most two million numbers: 32 MB as a broadcast table."""


def mapping_columns(mapping: DataFrame) -> DataFrame:
    """The mapping with its product name under a name no scrape uses."""
    extra = [F.col("Multiplier")] if "Multiplier" in mapping.columns else []
    return mapping.select(F.col("ProductName").alias("mappedName"), "SKUName", "Status", *extra)


def match_exact(
    facts: DataFrame,
    mapping: DataFrame,
    product_col: str = "productName",
    spread: Column | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Case-sensitive equality; a name mapped twice gives two rows, none gives NULLs."""
    dim = mapping_columns(mapping).withColumn("_name", F.col("mappedName"))
    return dim_join(facts, dim, [(product_col, "_name")], spread=spread, fits=fits)


def duplicate_names(mapping: DataFrame) -> DataFrame:
    """Product names that an exact match would fan out."""
    counts = mapping.groupBy("ProductName").agg(F.count("*").alias("entries"))
    return counts.filter(F.col("entries") > 1)


def distinct_names(facts: DataFrame, product_col: str = "productName") -> DataFrame:
    return facts.select(F.col(product_col).alias("name")).filter("name IS NOT NULL").distinct()


def _grams(text: str, size: int) -> str:
    return (
        f"CASE WHEN length({text}) >= {size} "
        f"THEN transform(sequence(1, length({text}) - {size - 1}), i -> substring({text}, i, {size})) "
        f"ELSE cast(array() AS array<string>) END"
    )


def contains_pairs(
    names: DataFrame,
    mapping: DataFrame,
    gram: int = GRAM,
    limit: int = BROADCAST_BYTES,
    keep_unmatched: bool = False,
) -> DataFrame:
    """All (name, mapping row) pairs where the name contains the mapped name.

    Both are compared in lower case without outer blanks; blank mapped names
    match nothing. Each mapped name is looked up by one of its character
    grams, the one that the fewest mapped names share, so the join is an
    equality join and only few pairs reach the `contains` test. Mapped names
    shorter than ``gram`` are looked up as a whole. ``keep_unmatched`` adds
    one row of NULLs to every name, without reading the names a second time.
    """
    dim = (
        mapping_columns(mapping)
        .withColumn("pattern", plain(F.col("mappedName")))
        .filter(F.length("pattern") > 0)
    )
    sized = dim.withColumn("size", F.least(F.length("pattern"), F.lit(gram)))
    # One job over the mapping: its bytes, its gram added, and the gram sizes (at most `gram`).
    seen = sized.agg(
        F.sum((width(sized) + 16 + 4 * gram).cast("bigint")).alias("bytes"),
        F.collect_set("size").alias("sizes"),
    ).first()
    sizes = sorted(seen["sizes"])
    if not sizes:
        kept = names if keep_unmatched else names.filter(F.lit(False))
        return kept.select("*", *[F.lit(None).cast(t).alias(c) for c, t in dim.dtypes])

    pattern_grams = sized.select("pattern", "size").distinct().withColumn(
        "gram",
        F.explode(
            F.expr(
                "array_distinct(transform(sequence(1, length(pattern) - size + 1), "
                "i -> substring(pattern, i, size)))"
            )
        ),
    )
    # Counted in the map tasks first, so a gram that very many names share is no task of its own.
    uses = pattern_grams.groupBy("gram").agg(F.count("*").alias("uses"))
    anchors = (
        pattern_grams.join(uses, "gram")
        .groupBy("pattern")
        .agg(F.min(F.struct("uses", "gram")).alias("best"))
        .select(F.col("pattern").alias("_pattern"), F.col("best.gram").alias("gram"))
    )
    anchored = dim.join(anchors, F.col("pattern") == F.col("_pattern")).drop("_pattern")

    gram_lists = [_grams("plain_name", s) for s in sizes]
    if keep_unmatched:
        # The empty gram leads every name to one entry without a SKU.
        gram_lists.append("array('')")
        nothing = [
            F.lit("").alias(c) if c in ("pattern", "gram") else F.lit(None).cast(t).alias(c)
            for c, t in anchored.dtypes
        ]
        anchored = anchored.unionByName(names.sparkSession.range(1).select(*nothing))
    all_grams = f"concat({', '.join(gram_lists)})"
    name_grams = names.withColumn("plain_name", plain(F.col("name"))).withColumn(
        "name_gram", F.explode(F.expr(f"array_distinct({all_grams})"))
    )
    fits = seen["bytes"] <= limit
    if not fits:
        name_grams = may_be_anchored(name_grams, anchored)
    return dim_join(
        name_grams,
        anchored,
        [("name_gram", "gram")],
        how="inner",
        also=F.col("plain_name").contains(F.col("pattern")),
        spread=F.xxhash64("name"),
        fits=fits,
    ).drop("plain_name", "name_gram")


def may_be_anchored(name_grams: DataFrame, anchored: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """Name grams without nearly all that no mapped name is looked up by, dropped before anything is shuffled.

    The filter holds numbers of at most ``bits`` bits, so it has a bound whatever the mapping's size; a gram that
    shares its number with a chosen one passes and is dropped by the join.
    """

    def cell(gram: str) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(1 << bits)).cast("int")

    cells = anchored.select(cell("gram").alias("_cell")).distinct()
    return name_grams.join(F.broadcast(cells), cell("name_gram") == F.col("_cell"), "left_semi")


def best_match(names: DataFrame, mapping: DataFrame, gram: int = GRAM) -> DataFrame:
    """One row per name: the equal mapped name, else the longest contained one.

    Names without a match keep NULLs. Equal ranks are ordered by SKU and
    mapped name, so that a rerun gives the same answer.
    """
    multiplier = ["Multiplier"] if "Multiplier" in mapping.columns else []
    rank = Window.partitionBy("name").orderBy(
        F.when(plain(F.col("name")) == F.col("pattern"), 0).otherwise(1),
        F.length(F.trim("mappedName")).desc_nulls_last(),
        "SKUName",
        "mappedName",
        "Status",
        *multiplier,
    )
    return (
        contains_pairs(names, mapping, gram, keep_unmatched=True)
        .withColumn("_rank", F.row_number().over(rank))
        .filter("_rank = 1")
        .drop("_rank", "pattern", "size")
    )


def with_pack_columns(matches: DataFrame, name_col: str = "name") -> DataFrame:
    """Pack hint and derived multiplier of each (name, mapped name)."""
    hinted = matches.withColumn("packHintText", pack_hint(F.col(name_col), F.col("mappedName")))
    return hinted.withColumn("derivedMultiplier", pack_size(F.col("packHintText"), F.col(name_col)))


def attach_matches(
    facts: DataFrame,
    matches: DataFrame,
    product_col: str = "productName",
    spread: Column | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Bring the per-name answer back to every row, rows without a name included."""
    return dim_join(facts, matches, [(product_col, "name")], spread=spread, fits=fits)
