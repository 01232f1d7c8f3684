"""New snapshots of normalised tables: checked, stamped, logged and published in one switch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators import changes, keys
from shelfmark.operators.settle import settle
from shelfmark.plans import warehouse
from shelfmark.plans.constraints import CONSTRAINTS, check_tables
from shelfmark.sources.tables import StagedTables, TableStore

BOOK_LOGS, AUTHOR_LOGS, RATING_LOGS, ETL_LOG = "book_logs", "author_logs", "isbn_rating_logs", "etl_log"


def log_rows(table: str, diff: DataFrame, review_type: DataFrame | None, run_ts: dt.datetime) -> tuple[str, DataFrame] | None:
    """The audit table of a table, and its rows for a diff; None for tables without one."""
    if table == "book":
        return BOOK_LOGS, changes.book_log(diff, run_ts)
    if table == "author":
        return AUTHOR_LOGS, changes.author_log(diff, run_ts)
    if table == "isbn_rating":
        return RATING_LOGS, changes.rating_log(diff, review_type, run_ts)
    return None


def publish_snapshot(store: TableStore, tables: dict[str, DataFrame], run_ts: dt.datetime) -> None:
    """Replace tables by new snapshots of them.

    A snapshot is hashed by ranges of keys first; ranges with the digest of the
    stored one are neither joined nor rewritten, and keep their files. In the
    others old and new rows are joined once, and written once with what happened
    to each: the stamps and the audit rows come from there. Changed rows are
    stamped with the run. Tables that changed are checked together with the
    stored ones they refer to; a broken rule raises and changes nothing.
    Snapshots and audit rows become current in one switch. Snapshots are read
    twice, so settle those that are dear to make.
    """
    staged, compared = StagedTables(store), {}
    for name, new in tables.items():
        key = CONSTRAINTS[name].key
        parts = staged.differing_parts(name, new, key) if name in store else None
        if parts == []:
            continue
        old = store.read(name, parts) if name in store else new.limit(0)
        differing = new if parts is None else new.filter(staged.label(name, key).isin(parts))
        compared[name] = settle(changes.compare(old, differing, key, run_ts), "compared")
        staged.replace_parts(name, parts, changes.newest(compared[name], new.columns), key)
    if not compared:
        return
    known = {name: staged.read(name) for name in CONSTRAINTS if name in staged}
    children = [name for name in known if set(CONSTRAINTS[name].parents.values()) & set(compared)]
    check_tables(known, run_ts.date(), only=[*compared, *children], strict=True)
    for name, rows in compared.items():
        logged = log_rows(name, changes.changed(rows, CONSTRAINTS[name].key), known.get("review_type"), run_ts)
        if logged is not None:
            staged.append(*logged)
    staged.commit()


def store_publisher_rename(store: TableStore, old: str, new: str, run_ts: dt.datetime) -> None:
    """Rename a publisher: its table, the book dimension's versions and the log row change in one switch.

    Only the ranges of the dimension that hold a version of the publisher's
    current books are rewritten; the new versions follow the highest id.
    """
    staged, dim = StagedTables(store), store.read("book_dim")
    key, houses = "book_dim_id", CONSTRAINTS["publisher"].key
    parts = store.parts_with("book_dim", dim.filter(F.col("current_flag") & (F.col("publisher") == old)), key)
    top = keys.max_id(store.read_last("book_dim"), key)
    touched = settle(store.read("book_dim", parts), "book-dim")
    publisher, versions, log = warehouse.rename_publisher(store.read("publisher"), touched, old, new, run_ts, top)
    if parts:
        staged.replace_parts("book_dim", parts, versions, key)
    renamed = store.parts_with("publisher", store.read("publisher").filter(F.col("publisher") == old), houses)
    if renamed:
        staged.replace_parts("publisher", renamed, publisher.filter(store.label("publisher", houses).isin(renamed)), houses)
    staged.append(ETL_LOG, log)
    staged.commit()
