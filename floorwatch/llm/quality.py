"""Quality rules, line first: lines that fail a rule go, then documents that lose too much or are poor as a whole.

Only DataFrame functions, row by row: no shuffle, no Python.

Rules of a line that has a word: it fails
- the punctuation rule, if at most 60 % of its words end in a letter, digit or one of .,;:'")]…-, or it ends every
  second word or more with an exclamation mark, or more than 8 % of its characters are of #*$%&|<>;
- the navigation rule, if it has three or more fields cut by | or » or ›, or more than two of its words are web links;
- the boilerplate rule, if it holds one of the phrases of BOILERPLATE (any case).
Lines without a word stay. A document is rejected if failed lines held more than LOST_PERCENT of its words' characters,
if it has under MIN_WORDS words, or if more than REPEAT_PERCENT of its words stand in repeated three-word windows.
A null text counts as having no line and no word, and so is rejected; its cleaned text is null.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorwatch.llm.tables import keep

MIN_WORDS = 50
REPEAT_PERCENT = 50
LOST_PERCENT = 30

#: ASCII white space, symbols.
SPACES = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: What words of prose end in, besides white space; and any character, or start of a link, that rules look for.
ORDINARY = r"\x20\x09-\x0D\p{L}\p{N}.,;:'\")\]…-"
SUSPECT = rf"[^{ORDINARY}]|https?://"

#: Bits for a word's place in the sorted numbers of _with_repeats.
PLACE_BITS = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Phrases of page furniture.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "lorem ipsum", "click here", "sign up for", "subscribe to our", "powered by", "skip to content",
    "log in to", "follow us on",
)


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def _exact_cover(found: Column) -> Column:
    """Places of the windows that repeat, by sorting the windows themselves."""
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(found) - 3),
            lambda i: F.struct(F.slice(found, i + 1, 3).alias("w"), i.cast("long").alias("i")),
        )
    )
    same = lambda order, x, at: F.coalesce(F.get(order, at)["w"] == x["w"], F.lit(False))
    return _let(
        windows,
        lambda order: F.transform(
            F.filter(order, lambda x, i: same(order, x, i - 1) | same(order, x, i + 1)), lambda x: x["i"]
        ),
    )


def _with_repeats(df: DataFrame, found: str, out: str) -> DataFrame:
    """Words that lie in a three-word window found twice or more, in the long column `out`.

    Windows are sorted as numbers, 44 bits of their hash above 20 bits of their place; neighbours of one hash are
    compared word by word. Where those differ, or places need more bits, the windows are sorted in full.
    """
    low = F.lit((1 << PLACE_BITS) - 1)
    words, order, near = F.col(found), F.col("_order"), F.col("_near")
    head = lambda x: F.shiftrightunsigned(x, PLACE_BITS)
    window = lambda x: F.slice(words, x.bitwiseAND(low).cast("int") + 1, 3)
    packed = F.transform(
        words,
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
        .bitwiseAND(F.lit(-1 << PLACE_BITS))
        .bitwiseOR(i),
    )
    twins = F.filter(
        order, lambda x, i: (head(x) == head(F.get(order, i + 1))) | (head(x) == head(F.get(order, i - 1)))
    )
    clash = F.exists(
        F.transform(
            near,
            lambda x, i: (head(x) == head(F.get(near, i + 1)))
            & (window(x) != window(F.get(near, i + 1))),
        ),
        lambda bad: F.coalesce(bad, F.lit(False)),
    )
    places = F.when(
        (F.size(words) > (1 << PLACE_BITS)) | clash, _exact_cover(words)
    ).otherwise(F.transform(near, lambda x: x.bitwiseAND(low)))
    cover = _let(
        F.sort_array(places),
        lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ),
    )
    return (
        df.withColumn("_order", F.sort_array(F.slice(packed, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))))
        .withColumn("_near", twins)
        .withColumn(out, F.when(F.size("_near") > 0, cover).otherwise(F.lit(0).cast("long")))
        .drop("_order", "_near")
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long")


def _furniture(text: Column) -> Column:
    low = F.lower(text)
    return reduce(or_, (F.contains(low, F.lit(x)) for x in BOILERPLATE))


def line_fails(line: Column) -> Column:
    """Whether a line that has a word breaks one of the rules."""

    def broken(c: Column) -> Column:
        punctuation = (
            (c["odd_ends"] * 10 >= c["n"] * 4) | (c["shouts"] * 2 >= c["n"]) | (c["symbols"] * 100 > c["chars"] * 8)
        )
        navigation = ((c["bars"] >= 2) & (c["bars"] * 10 >= c["n"])) | (c["links"] > 2)
        return (c["n"] > 0) & (punctuation | navigation)

    counts = F.struct(
        _count(line, r"[^\x20\x09-\x0D]+").alias("n"),
        _count(line, rf"[^{ORDINARY}](?:[\x20\x09-\x0D]|$)").alias("odd_ends"),
        _count(line, r"!(?:[\x20\x09-\x0D]|$)").alias("shouts"),
        _count(line, r"[|»›]").alias("bars"),
        _count(line, r"https?://").alias("links"),
        _symbols(line).alias("symbols"),
        F.char_length(line).alias("chars"),
    )
    return F.when(line.rlike(SUSPECT), _let(counts, broken)).otherwise(F.lit(False)) | _furniture(line)


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one struct column `quality`: the counts, both verdicts, and the text without failed lines."""
    columns = docs.columns
    whole, found, lines, suspect = (F.col(f"_{c}") for c in ("whole", "found", "lines", "suspect"))
    spoken = F.filter(lines, lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    clean = F.array_join(F.filter(lines, lambda line: ~line_fails(line)), "\n")
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_whole"))
    df = df.withColumns(
        # a text without any suspect character or phrase has no line that fails, and no symbol
        {"_found": words(whole), "_lines": F.split(whole, "\n"), "_suspect": whole.rlike(SUSPECT) | _furniture(whole)}
    )
    df = _with_repeats(df, "_found", "_n_repeat_words")
    df = df.withColumns(
        {
            "_n_words": F.size(found).cast("long"),
            "_word_chars": F.char_length(F.array_join(found, "")).cast("long"),
            "_n_symbols": F.when(suspect, _symbols(whole)).otherwise(F.lit(0).cast("long")),
            "_n_dup_lines": _let(spoken, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")),
            "_clean": F.when(suspect, clean).otherwise(whole),
        }
    )
    n, chars = F.col("_n_words"), F.col("_word_chars")
    left = F.when(suspect, F.char_length(F.regexp_replace("_clean", SPACES, ""))).otherwise(chars)
    df = df.withColumns(
        {
            "_base_failed": (n < MIN_WORDS) | (F.col("_n_repeat_words") * 100 > n * REPEAT_PERCENT),
            "_lost": (chars - left) * 100 > chars * LOST_PERCENT,
        }
    )
    judged = F.struct(
        *(F.col(f"_{c}").alias(c) for c in COUNTS),
        F.col("_base_failed").alias("base_failed"),
        (~F.col("_base_failed") & ~F.col("_lost")).alias("kept"),
        F.when(F.col(f"_row.{text}").isNotNull(), F.col("_clean")).alias("clean_text"),
    )
    return df.select(*(F.col(f"_row.`{c}`").alias(c) for c in columns), judged.alias("quality"))


def keep_good(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The kept documents with their failed lines taken out; the other columns as they are, n_chars counted anew.

    The verdicts are a table before they are filtered: a filter on them would be pushed below the projections and then
    repeat all of the work above it. It holds the cleaned texts of kept documents only, and no original ones.
    """
    columns = docs.columns
    others = [F.col(f"`{c}`") for c in columns if c not in (text, n_chars)]
    named = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), F.col(f"`{text}`").alias("text"))
    kept = F.col("quality.kept")
    clean = F.when(kept, F.col("quality.clean_text"))
    judged = keep(assess(named).select(F.when(kept, F.col("row")).alias("row"), kept.alias("kept"), clean.alias("clean")), "judged")
    clean = F.col("clean")
    changed = {text: clean} | ({n_chars: F.char_length(clean).cast("long")} if n_chars in columns else {})
    return judged.filter("kept").select(*(changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in columns))
