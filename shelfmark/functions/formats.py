"""Book format buckets and the bestseller category they imply."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import first_match, squeeze, strip

# Bucket and its words, in order; no hit is "unknown".
FORMAT_RULES = [
    ("audio", "audible|audiobook|audio|mp3 cd"),
    ("ebook", "e-?book|kindle|nook|digital"),
    ("boxed_set", "box set|boxed set|box-set|book set|hardcover slipcased|slipcased hardcover"),
    ("board_book", "board"),
    ("library_binding", "library binding|turtleback"),
    ("hardcover", "hardcover|hardback|casebound|cloth|capa dura|pasta dura|leather bound"),
    ("mass_market_paperback", "mass market"),
    ("paperback", "paperback|softcover|capa comum|broche|paper"),
    ("spiral_bound", "spiral-bound|spiral bound"),
    ("comic", "comic|comics|graphic novels"),
    ("pamphlet", "pamphlet"),
    ("unbound", "unbound"),
]

# Bestseller list per bucket; any other bucket is a paperback.
CATEGORY_BY_FORMAT = {
    "board_book": "Best Childrens/Middle Grade Books",
    "mass_market_paperback": "Best Mass Market Books",
    "hardcover": "Best Hardcover",
    "ebook": "Best E-Book",
    "audio": "Best Audio",
}
DEFAULT_CATEGORY = "Best Paperback"

LIGATURES = "ﬀﬁﬂﬃﬄﬆ"


def _ascii_part(ch: str) -> str:
    return unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")


@cache
def _single_letters() -> tuple[str, str]:
    """All characters with a one-letter ASCII form, and those letters."""
    single = [ch for ch in map(chr, range(0x80, 0x10000)) if len(_ascii_part(ch)) == 1]
    return "".join(single), "".join(map(_ascii_part, single))


def to_ascii(c: Column) -> Column:
    """Compatibility decomposition, then only ASCII kept (``broché`` to ``broche``).

    Letters with one ASCII base go through one ``translate``; what is left
    outside ASCII is dropped.
    """
    text = F.translate(c, *_single_letters())
    for ligature in LIGATURES:
        text = F.replace(text, F.lit(ligature), F.lit(_ascii_part(ligature)))
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def format_text(c: Column) -> Column:
    """Lower-cased ASCII text with plain quotes and dashes."""
    text = strip(F.lower(F.coalesce(c, F.lit(""))))
    text = F.regexp_replace(F.regexp_replace(text, "[’‘`]", "'"), "[–—]", "-")
    return to_ascii(strip(squeeze(text)))


def format_bucket(text: Column) -> Column:
    return first_match(
        [(text == "mass_market", F.lit("mass_market_paperback"))]
        + [(text.rlike(rf"\b(?:{words})\b"), F.lit(bucket)) for bucket, words in FORMAT_RULES],
        otherwise=F.lit("unknown"))


def normalize_book_format(df: DataFrame, source: str = "bookFormat", target: str = "bookFormat_norm") -> DataFrame:
    return (df.withColumn("_text", format_text(F.col(source)))
            .withColumn(target, format_bucket(F.col("_text"))).drop("_text"))


def bestseller_category(book_format: Column) -> Column:
    return first_match(
        [(book_format == bucket, F.lit(category)) for bucket, category in CATEGORY_BY_FORMAT.items()],
        otherwise=F.lit(DEFAULT_CATEGORY))
