"""What changed between two snapshots of a table, and the audit rows for it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def compare(old: DataFrame, new: DataFrame, key: str, run_ts: dt.datetime | None = None, ignore: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """Old and new rows side by side: the key, ``operation`` (null where nothing changed), ``old``, ``new`` and ``stamp``.

    One join of two snapshots serves all that asks what changed. Rows are
    compared null-safe over all columns but the ignored ones. ``stamp`` is the
    new row's ``updated_at``: the run's for a changed row, the old one for an
    unchanged row, its own for an added one; null where a table has none.
    """
    columns = [c for c in new.columns if c not in ignore]

    def side(df: DataFrame, name: str) -> DataFrame:
        stamp = F.col("updated_at") if "updated_at" in df.columns else F.lit(None).cast("timestamp")
        return df.select(F.col(key).alias(f"_{name}_key"), F.struct(*columns).alias(name), stamp.alias(f"_{name}_stamp"))

    operation = (F.when(F.col("old").isNull(), INSERT)
                 .when(F.col("new").isNull(), DELETE)
                 .when(~F.col("old").eqNullSafe(F.col("new")), UPDATE))
    stamp = (F.when(F.col("operation") == UPDATE, F.lit(run_ts).cast("timestamp")).when(F.col("operation").isNull(), F.col("_old_stamp"))
             .otherwise(F.col("_new_stamp")))
    return (side(old, "old").join(side(new, "new"), F.col("_old_key") == F.col("_new_key"), "full")
            .withColumn("operation", operation)
            .select(F.coalesce("_new_key", "_old_key").alias(key), "operation", "old", "new", stamp.alias("stamp")))


def changed(compared: DataFrame, key: str) -> DataFrame:
    """One row per key that was added, removed or changed: the key, ``operation``, and the structs ``old`` and ``new``."""
    return compared.filter(F.col("operation").isNotNull()).select(key, "operation", "old", "new")


def newest(compared: DataFrame, columns: list[str]) -> DataFrame:
    """The new snapshot's rows, with their stamps."""
    there = compared.filter(F.col("operation").isNull() | (F.col("operation") != DELETE))
    return there.select(*[F.col("stamp").alias(c) if c == "updated_at" else F.col("new")[c].alias(c) for c in columns])


def diff(old: DataFrame, new: DataFrame, key: str, ignore: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """What ``changed`` says of a comparison."""
    return changed(compare(old, new, key, ignore=ignore), key)


def touch_updated_at(old: DataFrame, new: DataFrame, key: str, run_ts: dt.datetime) -> DataFrame:
    """New snapshot with ``updated_at`` set to the run for every changed row.

    Unchanged rows keep their old stamp, added rows the one they came with.
    """
    return newest(compare(old, new, key, run_ts), new.columns)


def _entity_log(changes: DataFrame, key: str, name: str, added: str, deleted: str, updated: str,
                run_ts: dt.datetime) -> DataFrame:
    """Null in either name gives a null update message."""
    old_name, new_name = F.col("old")[name], F.col("new")[name]
    message = (F.when(F.col("operation") == INSERT, F.concat(F.lit(added), F.col(key)))
               .when(F.col("operation") == DELETE, F.concat(F.lit(deleted), F.col(key)))
               .otherwise(F.concat(F.lit(updated), old_name, F.lit(" to "), new_name)))
    shown = F.when(F.col("operation") == DELETE, old_name).otherwise(new_name)
    return changes.select(F.col(key), shown.alias(name), message.alias("log_message"),
                          F.lit(run_ts).alias("log_date"))


def book_log(changes: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _entity_log(changes, "book_id", "title", "New Book Added = ", "Book Deleted = ",
                       "Book Updated from ", run_ts)


def author_log(changes: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _entity_log(changes, "author_id", "full_name", "New Author Added = ", "Author Deleted = ",
                       "Name updated from ", run_ts)


def rating_log(changes: DataFrame, review_type: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Count history: an added row logs its count twice, a removed one goes to 0.

    A change that leaves the count alone is not logged. ``review_type`` has
    five fixed rows.
    """
    old, new = F.col("old"), F.col("new")
    deleted, added = F.col("operation") == DELETE, F.col("operation") == INSERT

    def side(c: str) -> Column:
        return F.when(deleted, old[c]).otherwise(new[c])

    logged = changes.filter(F.col("operation").isin(INSERT, DELETE) | (old["count"] != new["count"])).select(
        "isbn_rating_id", side("book_isbn_id").alias("book_isbn_id"),
        side("review_type_id").alias("review_type_id"), F.col("operation").alias("operation_type"),
        F.when(added, new["count"]).otherwise(old["count"]).alias("old_count"),
        F.when(deleted, F.lit(0)).otherwise(new["count"]).alias("new_count"))
    names = review_type.select("review_type_id", F.col("review_type").alias("review_type_name"))
    return (logged.join(F.broadcast(names), "review_type_id")
            .select("isbn_rating_id", "book_isbn_id", "review_type_id", "review_type_name", "operation_type",
                    "old_count", "new_count", F.lit(run_ts).alias("log_date")))
