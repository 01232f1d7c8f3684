"""Deletes in the stored tables, with what hangs from the deleted rows, in one switch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators import changes
from shelfmark.operators.settle import settle
from shelfmark.plans.constraints import CONSTRAINTS
from shelfmark.plans.snapshot import log_rows
from shelfmark.sources.tables import WRITERS, StagedTables, TableStore


def parents_first() -> Iterator[list[str]]:
    """Tables in generations: none refers to another of its own, or of a later one."""
    order = TopologicalSorter({name: set(rules.parents.values()) for name, rules in CONSTRAINTS.items()})
    order.prepare()
    while order.is_active():
        generation = sorted(order.get_ready())
        yield generation
        order.done(*generation)


def mark_rows(name: str, rows: DataFrame, asked: DataFrame | None, gone: dict[str, DataFrame]) -> DataFrame:
    """Rows with ``_doomed``, and ``_cleared``: which of the columns that may lose their parent have lost it."""
    rules = CONSTRAINTS[name]
    marked, doomed, cleared = rows, [F.lit(False)], []
    if asked is not None:
        marked = marked.join(asked.select(rules.key).distinct().withColumn("_asked", F.lit(True)), rules.key, "left")
        doomed.append(F.coalesce("_asked", F.lit(False)))
    for column, parent in rules.parents.items():
        if parent in gone:
            dead = gone[parent].select(F.col(CONSTRAINTS[parent].key).alias(column)).withColumn(f"_dead_{column}", F.lit(True))
            marked = marked.join(dead, column, "left")
            lost = F.coalesce(f"_dead_{column}", F.lit(False))
            if column in rules.cascades:
                doomed.append(lost)
            else:
                cleared.append(F.when(lost, F.lit(column)))
    return marked.select(*rows.columns, F.greatest(F.lit(False), *doomed).alias("_doomed"),
                         F.array_compact(F.array(F.lit(None).cast("string"), *cleared)).alias("_cleared"))


def as_deleted(rows: DataFrame, key: str) -> DataFrame:
    compared = F.struct(*[c for c in rows.columns if c != "updated_at"])
    return rows.select(key, F.lit(changes.DELETE).alias("operation"), compared.alias("old"), F.when(F.lit(False), compared).alias("new"))


def delete_rows(store: TableStore, asked: dict[str, DataFrame], run_ts: dt.datetime) -> dict[str, int]:
    """Delete rows by key from any of the tables; returns how many rows went from each table.

    ``asked`` has, for a table, a frame with its key column. Tables are taken
    parents first, those that don't refer to one another side by side. Rows that refer to a deleted row go with it or lose the
    reference, as the constraint catalogue says; a row that loses one is stamped
    with the run. Deleted books, authors and ratings are logged. Ranges of keys,
    and tables, none of whose rows are touched keep their files. Everything becomes current in one
    switch; keys that aren't there change nothing.
    """
    unknown = set(asked) - set(CONSTRAINTS)
    if unknown:
        raise KeyError(f"no such table: {', '.join(sorted(unknown))}")
    staged, gone, counts = StagedTables(store), {}, {}

    def take(name: str) -> None:
        rules, rows = CONSTRAINTS[name], store.read(name)
        marked = settle(mark_rows(name, rows, asked.get(name), gone), "marked")
        by_part = marked.groupBy(staged.label(name, rules.key).alias("part")).agg(
            F.count_if("_doomed").alias("doomed"), F.count_if(F.size("_cleared") > 0).alias("cleared")).collect()
        touched = sorted(r["part"] for r in by_part if r["doomed"] or r["cleared"])
        if not touched:
            return
        doomed = sum(r["doomed"] for r in by_part)
        if doomed:
            counts[name] = doomed
            gone[name] = marked.filter("_doomed").select(*rows.columns)
            logged = log_rows(name, as_deleted(gone[name], rules.key), store.read("review_type") if "review_type" in store else None, run_ts)
            if logged is not None:
                staged.append(*logged)
        lost = lambda c: F.array_contains("_cleared", c)
        kept = [F.when(lost(c), None).otherwise(F.col(c)).alias(c) if c in rules.parents else
                F.when(F.size("_cleared") > 0, F.lit(run_ts)).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c)
                for c in rows.columns]
        there = marked.filter(staged.label(name, rules.key).isin(touched))
        staged.replace_parts(name, touched, there.filter("NOT _doomed").select(*kept), rules.key)

    with ThreadPoolExecutor(WRITERS) as pool:
        for generation in parents_first():
            list(pool.map(take, [name for name in generation
                                 if name in store and (name in asked or set(CONSTRAINTS[name].parents.values()) & set(gone))]))
    staged.commit()
    return counts
