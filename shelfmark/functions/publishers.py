"""Publisher names: charset test and house normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import WS, empty_to_null, first_match, has_any, squeeze, strip

LATIN_ONLY = r"(?U)\A[a-zA-Z0-9\s\x1c-\x1f&.',/-]*\z"

# Text steps on the lower-cased name, in order.
BASE_STEPS = [
    ("`", "'"),
    ("[–—]", "-"),
    (rf"{WS}*\(.*?\)", ""),
    (r"\b(uk|usa?|australia|india|canada)\b", ""),
    (r"(?<=\b[a-z])\.(?=[a-z])", ""),
    (r"\b([a-z]{1,3})\.\b", "$1"),
    (r"[.\s\x1c-\x1f]+$", ""),
    (rf"{WS}*&{WS}*", " & "),
    (r"\b(inc|ltd|llc|plc|co|corp|gmbh|sa|pte|pty)\b", ""),
    (rf"{WS}*-{WS}*(au|uk|us|usa|ca|nz)\b", ""),
    (r"\b(pub|publications|publishers)\b", "publishing"),
    (r"\bcompanyy\b", "company"),
    (rf"{WS}+", " "),
    (",+$", ""),
]

# Placeholders that mean "no publisher".
JUNK = r"\bnot\s+avail(?:able)?\b|^(?:s|self|none|n/a|unknown|see notes)$"

# How a self-published name starts.
SELF_PUBLISHED = (r"^(?:self[\s-]?published|independently published|createspace|kindle direct|lulu|smashwords"
                  r"|amazon[\s-]?publishing|author[\s-]?house|xlibris|iuniverse|bookbaby)")

# House name and what marks its names and imprints, in order.
HOUSES = [
    ("penguin random house", ["penguin.*random.*house"]),
    ("harpercollins", [r"harper\s*collins"]),
    ("simon & schuster", [r"simon\s*&?\s*schuster"]),
    ("hachette", ["hachette"]),
    ("macmillan", ["macmillan"]),
    ("penguin", ["penguin"]),
    ("random house", [r"random\s*house"]),
    ("penguin", ["bantam", r"del\s*rey", "ballantine", "viking", "riverhead", "putnam", "doubleday", "knopf",
                 "anchor", "vintage", "berkley", r"ace\s*books", r"roc\b", r"daw\b", "dial", "dutton", "plume",
                 "signet", r"nal\b"]),
    ("harpercollins", ["harper", r"william\s*morrow", "avon", "ecco", "harlequin", r"mira\b", r"mills\s*&\s*boon",
                       "voyager"]),
    ("simon & schuster", ["atria", "gallery", "scribner", r"pocket\s*books", "touchstone"]),
    ("hachette", [r"little\s*,?\s*brown", "orbit", r"grand\s*central", "faithwords"]),
    ("macmillan", [r"tor\b", "forge", r"st\.?\s*martin", "farrar.*straus.*giroux", "picador", "holt"]),
    ("scholastic", ["scholastic"]),
    ("bloomsbury", ["bloomsbury"]),
    ("disney", ["disney"]),
    ("marvel", ["marvel"]),
    ("dc comics", [r"dc\s*comics"]),
    ("oxford university press", [r"oxford\s*university\s*press"]),
    ("cambridge university press", [r"cambridge\s*university\s*press"]),
    ("grove/atlantic", ["grove.*atlantic"]),
    ("orion", ["orion"]),
    ("titan books", [r"titan\s*books"]),
    ("baen", ["baen"]),
    ("tor.com", [r"tor\.com"]),
    ("subterranean press", ["subterranean"]),
    ("tachyon", ["tachyon"]),
    ("night shade books", [r"night\s*shade"]),
    ("angry robot", [r"angry\s*robot"]),
    ("gollancz", ["gollancz"]),
    ("hodder & stoughton", ["hodder"]),
    ("faber & faber", ["faber"]),
    ("pan macmillan", [r"pan\s*macmillan"]),
    ("candlewick", ["candlewick"]),
    ("chronicle books", ["chronicle"]),
    ("abrams", ["abrams"]),
    ("quirk books", ["quirk"]),
    ("sourcebooks", ["sourcebooks"]),
    ("kensington", ["kensington"]),
    ("entangled publishing", ["entangled"]),
    ("montlake", ["montlake"]),
]


def is_latin(c: Column) -> Column:
    """True for null, empty, or letters, digits, space and ``& - . ' , /`` only."""
    return F.coalesce(c, F.lit("")).rlike(LATIN_ONLY)


def folded_houses(houses=None) -> list[tuple[str, list[str]]]:
    """Houses with each name run through the rules after its own.

    A rule replaces the whole name, so later rules see only the house that
    matched: the chain over a column is one first-match ladder with the chain
    over each constant worked out here.
    """
    houses = HOUSES if houses is None else houses
    folded = []
    for i, (house, marks) in enumerate(houses):
        for later, later_marks in houses[i + 1:]:
            if any(re.search(mark, house) for mark in later_marks):
                house = later
        folded.append((house, marks))
    return folded


def publisher_text(c: Column) -> Column:
    """Lower-cased name without countries, company forms and stray punctuation."""
    text = F.lower(strip(F.coalesce(c, F.lit(""))))
    for pattern, replacement in BASE_STEPS:
        text = F.regexp_replace(text, f"(?U){pattern}", replacement)
    return strip(text)


def publisher_house(text: Column) -> Column:
    """Canonical house of a tidied name, or the name; empty for a placeholder."""
    return first_match(
        [(text.rlike(JUNK), F.lit("")), (text.rlike(SELF_PUBLISHED), F.lit("self-published"))]
        + [(has_any(text, marks), F.lit(house)) for house, marks in folded_houses()],
        otherwise=text)


def publisher_name(house: Column) -> Column:
    """Last clean-up of the name; ``unknown`` when nothing is left."""
    name = house
    for pattern in (rf"(?U){WS}+(?=,)", rf"(?U),{WS}*$", r"(?U)[.\s\x1c-\x1f]+$"):
        name = F.regexp_replace(name, pattern, "")
    return F.coalesce(empty_to_null(strip(squeeze(name))), F.lit("unknown"))


def normalize_publisher(df: DataFrame, source: str = "publisher", target: str = "publisher_norm") -> DataFrame:
    """The three steps as columns of their own, so that each runs once per row."""
    return (df.withColumn("_text", publisher_text(F.col(source)))
            .withColumn("_house", publisher_house(F.col("_text")))
            .withColumn(target, publisher_name(F.col("_house")))
            .drop("_text", "_house"))
