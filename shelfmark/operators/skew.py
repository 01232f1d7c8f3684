"""Joins to a one-row-per-key side where a few keys hold much of the rows.

Row counts per key are at hand (``salted_lookup``), or hot keys are found by a
sketch (``spread_lookup``). All other lookups are plain joins without hints:
adaptive execution broadcasts a side that turns out small in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.settle import settle

HOT_ROWS = 1_000_000
NULL_KEY_WAYS = 1_000_000
#: A key is hot with over one of so many equal shares of the rows, and is cut into shares of that size.
SHARES = 4096
# Sketches are merged in so many tasks, then in one.
SKETCH_GROUPS = 256
# Items a sketch tracks for each share; with four, no hot key escapes it.
TRACKED_PER_SHARE = 4


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: str, rows_per_key: str, spread: str,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join to ``lookup``, which has one row per key and its row count.

    A key with more than ``hot_rows`` rows is spread over several tasks and its
    lookup row copied to each. At most rows / ``hot_rows`` keys can be hot, and
    the copies add as many rows; whether their list is broadcast is left to
    Spark, by its size. Rows with a null key match nothing and are spread too.
    """
    salts = F.ceil(F.col(rows_per_key) / hot_rows).cast("int")
    hot = lookup.filter(F.col(rows_per_key) > hot_rows).select(on, salts.alias("_salts"))
    ways = F.when(F.col(on).isNull(), F.lit(NULL_KEY_WAYS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_rows = (rows.join(hot, on, "left")
                   .withColumn("_salt", F.pmod(F.xxhash64(spread), ways).cast("int"))
                   .drop("_salts"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return salted_rows.join(copies, [on, "_salt"], "left").drop("_salt")


def key_sketch(rows: DataFrame, columns: list[str], shares: int = SHARES) -> DataFrame:
    """One row, none for no rows: for each column a sketch of its frequent values and the number of its values.

    All columns are sketched in one pass, within each task before the shuffle.
    The row is written, so that all readers find the same keys in it.
    """
    tracked = TRACKED_PER_SHARE * shares
    grouped = rows.select(*columns, F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group"))
    partial = grouped.groupBy("_group").agg(
        *[F.expr(f"approx_top_k_accumulate(`{c}`, {tracked})").alias(c) for c in columns],
        *[F.count(c).alias(f"_rows_{c}") for c in columns])
    # Grouped, since Spark can't merge sketches in a task without any.
    whole = partial.groupBy(F.lit("rows").alias("_of")).agg(*[F.expr(f"approx_top_k_combine(`{c}`, {tracked})").alias(c) for c in columns],
                                                                *[F.sum(f"_rows_{c}").alias(f"_rows_{c}") for c in columns])
    return settle(whole, "key-sketch")


def hot_keys(sketch: DataFrame, on: str, shares: int = SHARES) -> DataFrame:
    """Hot values of a sketched column and the shares each is cut into: at most ``shares`` rows."""
    known = sketch.filter(F.col(f"_rows_{on}") > 0)
    found = known.select(F.expr(f"inline(approx_top_k_estimate(`{on}`, {shares}))"), F.col(f"_rows_{on}").alias("_rows"))
    part = F.col("count") * shares / F.col("_rows")
    return found.filter(F.col("item").isNotNull() & (part > 1)).select(F.col("item").alias(on), F.ceil(part).cast("int").alias("_salts"))


def spread_lookup(rows: DataFrame, lookup: DataFrame, on: str, spread: str | Column, sketch: DataFrame, how: str = "left",
                  shares: int = SHARES) -> DataFrame:
    """Join to ``lookup``, which has one row per key, without a task for all rows of a hot key.

    Only rows of keys that ``sketch`` finds hot are spread, by a hash of
    ``spread``, and only the lookup rows of those keys are copied: at most twice
    ``shares`` copies, however large the tables are. Their list is bounded by
    ``shares`` too, so it is broadcast. The sketch may be one of another frame
    with about the same keys; it decides where rows go, not what they match.
    Rows with a null key match nothing and are spread too.
    """
    hot = F.broadcast(hot_keys(sketch, on, shares))
    ways = F.when(F.col(on).isNull(), F.lit(NULL_KEY_WAYS)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread_rows = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), ways).cast("int")).drop("_salts")
    copies = lookup.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return spread_rows.join(copies, [on, "_salt"], how).drop("_salt")
