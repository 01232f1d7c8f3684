"""First row per key, duplicate reports, distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """One row per key, the first in ``order_by``; a null key is one key.

    The rank filter lets each task drop all but its own first row of a key
    before the shuffle, so a hot key sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_rank", F.row_number().over(first))
            .filter("_rank = 1").drop("_rank"))


def keep_one_per(df: DataFrame, key: str, pos: str = "_src_pos") -> DataFrame:
    """First row per present key; rows without the key are all kept.

    Keyed rows come before the others: ``pos`` stays and ``<key> IS NULL, pos``
    is the new row order.
    """
    keyed = first_per_key(df.filter(F.col(key).isNotNull()), [key], [pos])
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def first_value_per_key(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """``DISTINCT ON (key)`` with the earliest row's value."""
    return df.groupBy(key).agg(F.min_by(value, pos).alias(value))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; null keys are left out."""
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per present value, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.asc(col)))
