"""Generated keys: dense ids in a stated order, and ids by first appearance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.operators.settle import settle
from shelfmark.operators.skew import salted_lookup

BUCKET_BITS = 16


def assign_ids(df: DataFrame, id_col: str, order_by: list[str], start_after: int = 0, merged: bool = False) -> DataFrame:
    """Dense ids after ``start_after`` in ``order_by`` order.

    The first order column must be a whole number few rows share, such as a
    position or an id. Its high bits cut the rows into buckets of at most 2^16
    values; ids are the rank inside the bucket plus the rows of the buckets
    before it. Only the bucket sizes, one row per bucket, meet in one task.
    The rows are read twice, so settle them first if they are dear to make.
    Ranked rows are sorted by bucket; ``merged`` merges them with the sizes, so
    that beside other jobs no broadcast has to wait for a busy cluster.
    """
    bucketed = df.withColumn("_bucket", F.shiftright(F.col(order_by[0]).cast("bigint"), BUCKET_BITS))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (bucketed.groupBy("_bucket").agg(F.count("*").alias("_rows"))
               .select("_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("_bucket").orderBy(*order_by)
    return (bucketed.withColumn("_rank", F.row_number().over(inside))
            .join(offsets.hint("merge") if merged else offsets, "_bucket")
            .withColumn(id_col, F.col("_before") + F.col("_rank") + F.lit(start_after))
            .drop("_bucket", "_rank", "_before"))


def assign_ids_sorted(df: DataFrame, id_col: str, order_by: list[str], start_after: int = 0) -> DataFrame:
    """Dense ids in the order of any columns, text included.

    A range partitioning picks its bounds by sampling, so the sorted rows are
    written once and numbered from the written table.
    """
    in_order = (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
                .withColumn("_place", F.monotonically_increasing_id()))
    return assign_ids(settle(in_order, "sorted"), id_col, ["_place"], start_after).drop("_place")


def max_id(df: DataFrame, id_col: str) -> int:
    """Highest id in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]


def first_appearance_ids(df: DataFrame, key: Column, id_col: str, count_col: str, pos: str) -> DataFrame:
    """Id per key by first appearance and rows per key, joined back to the rows.

    A null key gets no id and no count. The keys are written once, since the
    id offsets, the ids and the hot-key list all read them.
    """
    keyed = df.withColumn("_key", key)
    per_key = (keyed.filter(F.col("_key").isNotNull()).groupBy("_key")
               .agg(F.min(pos).alias("_first"), F.count("*").alias(count_col)))
    ids = assign_ids(settle(per_key, "keys"), id_col, ["_first"]).drop("_first")
    return salted_lookup(keyed, ids, "_key", rows_per_key=count_col, spread=pos).drop("_key")


def book_identifier(df: DataFrame, pos: str = "_pos") -> DataFrame:
    """``book_key``, dense ``book_uid``, ``edition_count``, ``has_multiple_editions``."""
    author = F.coalesce("primary_author_name", F.lit("None"))
    with_key = df.withColumn("book_key", F.concat("title_norm", F.lit("-"), author))
    with_id = first_appearance_ids(with_key, F.col("book_key"), "book_uid", "edition_count", pos)
    return with_id.withColumn("has_multiple_editions", (F.col("edition_count") > 1).cast("int"))


def series_identifier(df: DataFrame, pos: str = "_pos") -> DataFrame:
    """``series_key``, dense ``series_uid``, ``books_in_series``; null outside a series."""
    present = (F.col("series_name_norm") != "") & (F.col("primary_author_name") != "")
    with_key = df.withColumn(
        "series_key", F.when(present, F.concat("series_name_norm", F.lit("-"), "primary_author_name")))
    return first_appearance_ids(with_key, F.col("series_key"), "series_uid", "books_in_series", pos)
