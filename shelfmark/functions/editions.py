"""Edition text to a small set of edition kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import first_match, has_any, strip

# Text that is a catalogue reference and no edition.
NOT_AN_EDITION = ("lcc ", "catalog id", "#v", "isbn")

# Ordinals, then literal replacements, each in order.
ORDINALS = [("1st", "first"), ("2nd", "second"), ("3rd", "third")]
REPLACEMENTS = [
    ("ed.", "edition"), ("ed ", "edition "), ("edtion", "edition"), ("editio", "edition"),
    ("aniv", "anniversary"), ("us/can", "us/canada"), ("u.s.", "us"), ("u.k.", "uk"),
    ("e-book", "ebook"), ("e-audio", "eaudio"),
]

# Edition kind and the pattern that tells it, in order.
# "unabridged" always holds "abridged", so it has no row of its own.
EDITION_RULES = [
    ("First Edition", "first ed|1st edition"),
    ("Second Edition", "(?:second|2nd) edition"),
    ("Third Edition", "(?:third|3rd) edition"),
    ("Later Edition", r"(?:\d+th|fourth|fifth|sixth|seventh|eighth|ninth|tenth) edition"),
    ("Anniversary Edition", "anniversary"),
    ("Media Tie-In", "movie tie|film tie|tv tie"),
    ("Special Edition", "deluxe|collector|limited|special edition"),
    ("Revised/Reprint", "reprint|reissue|revised"),
    ("Large Print", "large print|large-print"),
    ("Abridged", "abridged"),
    ("Audio", "audio"),
    ("Digital", "ebook|kindle|nook|digital"),
    ("Illustrated/Graphic", "graphic novel|illustrated"),
    ("Classic Series", "classic"),
    ("Box Set", "box|volume set"),
    ("Standard", r"\A(?:regular|standard|original)?\z"),
]


def edition_text(c: Column) -> Column:
    """Lower-cased text with ordinals and common short forms written out."""
    text = F.lower(strip(c))
    for ordinal, word in ORDINALS:
        text = F.regexp_replace(text, rf"(?U)\b{ordinal}\b", word)
    for old, new in REPLACEMENTS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def edition_kind(c: Column, text: Column) -> Column:
    """Edition kind; ``Other`` when no rule knows the text, null stays null."""
    raw = F.lower(strip(c))
    return first_match(
        [(c.isNull(), F.lit(None)), (raw.startswith("http") | has_any(raw, NOT_AN_EDITION), F.lit("Other"))]
        + [(text.rlike(pattern), F.lit(kind)) for kind, pattern in EDITION_RULES],
        otherwise=F.lit("Other"))


def normalize_edition(df: DataFrame, source: str = "edition", target: str = "edition_norm") -> DataFrame:
    return (df.withColumn("_text", edition_text(F.col(source)))
            .withColumn(target, edition_kind(F.col(source), F.col("_text"))).drop("_text"))
