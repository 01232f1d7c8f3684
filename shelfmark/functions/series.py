"""Series name, number and box-set flag from the raw series text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfmark.functions.text import WS, normalize_text, strip

SINGLE_VOLUME = rf"(?Ud)^(.*?){WS}*#{WS}*(\d+(?:\.\d+)?)$"
VOLUME_RANGE = rf"(?U)#{WS}*\d+(?:\.\d+)?{WS}*-{WS}*\d+(?:\.\d+)?"
FROM_HASH_ON = rf"(?Ud){WS}*#.*$"
BOX_SET = r"(?U)#\d+-\d+"


def parse_series(c: Column) -> tuple[Column, Column]:
    """(name, number): ``Saga #1.5`` is (saga, 1.5), ``Saga #1-3`` is (saga, null)."""
    text = strip(c)
    volume = F.regexp_extract(text, SINGLE_VOLUME, 2)
    name = normalize_text(
        F.when(volume != "", F.regexp_extract(text, SINGLE_VOLUME, 1))
        .when(text.rlike(VOLUME_RANGE), F.regexp_replace(text, FROM_HASH_ON, ""))
        .otherwise(text))
    return name, F.nullif(volume, F.lit("")).try_cast("decimal(10,2)")


def is_part_of_series(series_name: Column) -> Column:
    return F.coalesce(strip(series_name) != "", F.lit(False))


def boxset_flag(c: Column) -> Column:
    """1 where the raw text has a range such as ``#1-4``, else 0."""
    return F.coalesce(c.rlike(BOX_SET), F.lit(False)).cast("int")
