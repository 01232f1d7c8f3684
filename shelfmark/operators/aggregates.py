"""Profiles, conditional counts and high-water marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row count and, per column, the rows where it is present."""
    return df.agg(F.count("*").alias("total_records"), *[F.count(c).alias(f"has_{c}") for c in cols])


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``COUNT(*) FILTER (WHERE ...)`` per name."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def distinct_tuples(cols: list[str]) -> Column:
    """``COUNT(DISTINCT (a, b))``: a tuple counts even if a part is null."""
    return F.count_distinct(F.struct(*cols))


def high_water_mark(etl_log: DataFrame, source: str, details: list[str]):
    """Latest run of any of the jobs, or None."""
    mine = etl_log.filter((F.col("source") == source) & F.col("details").isin(details))
    return mine.agg(F.max("run_date").alias("last")).first()["last"]


def mean_of(total: Column, n: Column) -> Column:
    """Average from a sum and a count that were added up beforehand."""
    return F.try_divide(total.cast("double"), n)
