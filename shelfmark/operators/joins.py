"""Join shapes Catalyst does not rewrite by itself, and small join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.numbers import weighted_rating
from shelfmark.operators.dedup import first_per_key


def either_key_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Inner join where any of the key pairs is equal; column names must differ.

    One equi-join per pair, each leaving out what an earlier pair has matched,
    so the parts are disjoint and need no duplicate removal. As an OR condition
    the same join would compare every row with every row.
    """
    parts, matched = [], F.lit(False)
    for left_key, right_key in pairs:
        equal = F.col(left_key) == F.col(right_key)
        parts.append(left.join(right, equal & ~matched))
        matched = matched | F.coalesce(equal, F.lit(False))
    return reduce(DataFrame.unionByName, parts)


def membership_rows(fact: DataFrame, id_cols: list[str], id_col: str) -> DataFrame:
    """One row per fact and distinct id held in any of the columns."""
    ids = F.array_distinct(F.array_compact(F.array(*id_cols)))
    return fact.withColumn(id_col, F.explode(ids))


def membership_join(fact: DataFrame, dim: DataFrame, id_cols: list[str], id_col: str) -> DataFrame:
    """``dim.id IN (fact.a1, ..., fact.an)`` as an explode and a hash join."""
    return membership_rows(fact, id_cols, id_col).join(dim, id_col)


def slots_lookup(fact: DataFrame, key: str, slots: dict[str, str], dim: DataFrame, id_col: str,
                 value: str) -> DataFrame:
    """The same lookup for several columns: ``slots`` maps id column to new column.

    The dimension is joined once, on the exploded ids, and its values are
    folded back, however many slots there are. Rows that have the ``key`` and
    all slots in common are looked up once, so a key many rows share keeps
    the rows themselves out of the explode.
    """
    same = fact.select(key, *slots).distinct()
    pairs = F.array(*[F.struct(F.lit(name).alias("_slot"), F.col(slot).alias("_id")) for slot, name in slots.items()])
    own = {c: f"_of_{c}" for c in (key, *slots)}
    long = same.select(*[F.col(c).alias(o) for c, o in own.items()], F.inline(pairs)).filter(F.col("_id").isNotNull())
    wide = (long.join(dim.select(F.col(id_col).alias("_id"), F.col(value).alias("_value")), "_id").groupBy(*own.values())
            .agg(*[F.max(F.when(F.col("_slot") == name, F.col("_value"))).alias(name) for name in slots.values()]))
    alike = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(o)) for c, o in own.items()])
    return fact.join(wide, alike, "left").drop(*own.values())


def pivot_ranks(df: DataFrame, keys: list[str], rank: str, value: str, names: list[str]) -> DataFrame:
    """Rank 1..n to columns, one row per key; higher ranks are left out."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(rank) == i, F.col(value))).alias(name) for i, name in enumerate(names, 1)])


def rating_pivot(isbn_rating: DataFrame) -> DataFrame:
    """One row per ISBN with its five counts, ``count_1`` (five stars) to ``count_5``."""
    return pivot_ranks(isbn_rating, ["book_isbn_id"], "review_type_id", "count",
                       [f"count_{i}" for i in range(1, 6)])


def average_ratings(isbn_rating: DataFrame) -> DataFrame:
    """Weighted average rating per ISBN, null where a class is missing."""
    counts = [F.col(f"count_{i}") for i in range(1, 6)]
    return rating_pivot(isbn_rating).select("book_isbn_id", weighted_rating(counts).alias("avg_rating"))


def missing_rows(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the existing table lacks (insert, keep what is there)."""
    return incoming.join(existing.select(*keys), keys, "left_anti")


def update_from(target: DataFrame, source: DataFrame, key: str, columns: list[str],
                pick_by: str) -> DataFrame:
    """Overwrite ``columns`` where the source has the key.

    The source is first cut to one row per key, the lowest ``pick_by``.
    """
    chosen = first_per_key(source, [key], [pick_by]).select(key, F.struct(*columns).alias("_new"))
    kept = [F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in columns else F.col(c) for c in target.columns]
    return target.join(chosen, key, "left").select(*kept)


def unpivot(df: DataFrame, keys: list[str], columns: dict[str, Column], label: str, value: str) -> DataFrame:
    """Columns to (label, value) rows, one pass; null values are left out."""
    pairs = F.array(*[F.struct(label_value.alias(label), F.col(c).alias(value))
                      for c, label_value in columns.items()])
    return df.select(*keys, F.inline(pairs)).filter(F.col(value).isNotNull())
