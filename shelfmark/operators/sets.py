"""Distinct values over several columns and fixed-row tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SLOT_BITS = 6


def slot_values(df: DataFrame, cols: list[str], value: str, pos: str) -> DataFrame:
    """(value, _seen) per present value; ``_seen`` orders by row, then by column.

    One pass over the table in place of one scan per column.
    """
    return slot_array_values(df, F.array(*cols), value, pos)


def slot_array_values(df: DataFrame, values: Column, value: str, pos: str) -> DataFrame:
    slots = df.select(F.col(pos), F.posexplode(values).alias("_slot", value))
    return (slots.filter(F.col(value).isNotNull())
            .select(value, (F.shiftleft(F.col(pos).cast("bigint"), SLOT_BITS) + F.col("_slot")).alias("_seen")))


def distinct_by_appearance(values: DataFrame, value: str) -> DataFrame:
    """Distinct values with the first place they were seen."""
    return values.groupBy(value).agg(F.min("_seen").alias("_seen"))
