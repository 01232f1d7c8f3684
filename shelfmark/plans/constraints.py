"""What the normalised tables must hold, as data, and the job that finds the rows that break it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from shelfmark.operators import checks
from shelfmark.operators.checks import RejectedRows
from shelfmark.operators.settle import settle


@dataclass(frozen=True)
class Rules:
    """One table: its id, further unique column sets, required columns, parents by column, and row checks.

    A row goes with its parent where the column is one of ``cascades``; else it loses the reference.
    """

    key: str
    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    parents: dict[str, str] = field(default_factory=dict)
    rows: tuple[str, ...] = ()
    cascades: tuple[str, ...] = ()


#: Parents are named by their table; the column has the same name there.
CONSTRAINTS = {
    "author": Rules("author_id"),
    "language": Rules("language_id", (("language",),)),
    "genre": Rules("genre_id", (("genre",),)),
    "role": Rules("role_id", (("role",),)),
    "publisher": Rules("publisher_id", (("publisher",),)),
    "edition": Rules("edition_id", (("edition",),), ("edition",)),
    "format": Rules("format_id", (("format",),)),
    "series": Rules("series_id", (("series_name",),), ("series_name",)),
    "book": Rules("book_id"),
    "review_type": Rules("review_type_id", (("review_type",),), ("review_type",)),
    "book_isbn": Rules(
        "book_isbn_id", (("isbn13",), ("isbn10",)), ("book_id",),
        {"book_id": "book", "format_id": "format", "edition_id": "edition", "publisher_id": "publisher",
         "language_id": "language", "series_id": "series"}, ("isbn", "publish_date"), ("book_id",)),
    "author_isbn": Rules(
        "author_isbn_id", (("book_isbn_id", "author_id", "role_id"),), ("book_isbn_id", "author_id"),
        {"book_isbn_id": "book_isbn", "author_id": "author", "role_id": "role"}, cascades=("book_isbn_id", "author_id")),
    "isbn_rating": Rules(
        "isbn_rating_id", (("book_isbn_id", "review_type_id"),), ("book_isbn_id", "review_type_id", "count"),
        {"book_isbn_id": "book_isbn", "review_type_id": "review_type"}, ("rating",), ("book_isbn_id", "review_type_id")),
    "book_isbn_genre": Rules(
        "book_isbn_genre_id", (("book_isbn_id", "genre_id"),), ("book_isbn_id", "genre_id"),
        {"book_isbn_id": "book_isbn", "genre_id": "genre"}, cascades=("book_isbn_id", "genre_id")),
}

#: Columns each row check reads.
ROW_CHECKS: dict[str, tuple[list[str], Callable[[dt.date], Column]]] = {
    "isbn": (["isbn10", "isbn13"], lambda run_date: checks.isbn_reason()),
    "publish_date": (["publish_date", "original_publish_date"], checks.publish_date_reason),
    "rating": (["count"], lambda run_date: checks.rating_reason())}
UNIQUE, FOREIGN = "unique ", "foreign "


def _unique_keys(rules: Rules) -> list[Column]:
    """Per unique rule (rule, key, reason); the key is null where one of its columns is, since null never equals null."""
    return [F.struct(F.lit(UNIQUE + ", ".join(keys)).alias("rule"),
                     F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in keys]),
                            F.concat_ws("\x1f", *[F.col(c).cast("string") for c in keys])).alias("key"),
                     F.lit(f"duplicate key ({', '.join(keys)})").alias("reason"))
            for keys in ((rules.key,), *rules.unique)]


def _foreign_keys(columns: list[str]) -> list[Column]:
    return [F.struct(F.lit(FOREIGN + c).alias("rule"), F.col(c).cast("string").alias("key"), F.lit(f"{c} has no parent row").alias("reason"))
            for c in columns]


def _exploded(df: DataFrame, key: str, entries: list[Column]) -> DataFrame:
    """(row_id, rule, key, reason) of every rule in one pass over the rows."""
    return df.select(F.col(key).cast("bigint").alias("row_id"), F.inline(F.array(*entries))).filter(F.col("key").isNotNull())


def _counted(df: DataFrame, columns: tuple[str, ...], entry: Column, there: DataFrame | None = None) -> DataFrame:
    """(rule, key, n) of one rule. Values are counted as they are stored, and become text only then, once each.

    Keys of rows that are ``there`` already count with those of the table's rows.
    """
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    if there is None:
        counts = df.filter(present).groupBy(*columns).agg(F.count("*").alias("n"))
    else:
        alike = dict(df.select(*columns).dtypes) == dict(there.select(*columns).dtypes)
        values = [F.col(c) if alike else F.col(c).cast("string").alias(c) for c in columns]
        both = (df.filter(present).select(*values, F.lit(1).alias("_own"))
                .unionByName(there.filter(present).select(*values, F.lit(0).alias("_own"))))
        counts = both.groupBy(*columns).agg(F.count("*").alias("n"), F.max("_own").alias("_own")).filter("_own = 1")
    return counts.select(entry["rule"].alias("rule"), entry["key"].alias("key"), "n")


def _near(there: DataFrame, df: DataFrame, columns: list[str], bounds: Row) -> DataFrame:
    """Rows that may have one of the keys: those between the lowest and the highest value that ``df`` has in the first column.

    Ids of additions follow the stored ones, so files of stored rows are passed
    over by their own bounds and move nothing. Columns of another type are not cut.
    """
    first, low, high = columns[0], bounds[f"low_{columns[0]}"], bounds[f"high_{columns[0]}"]
    if dict(there.select(*columns).dtypes) != dict(df.select(*columns).dtypes):
        return there
    return there.filter(F.lit(False) if low is None else F.col(first).between(F.lit(low), F.lit(high)))


def _orphans(df: DataFrame, column: str, entry: Column, parents: list[DataFrame]) -> DataFrame:
    """(rule, key, n) of the column's values that no parent has. Distinct values are looked up, so a hot one is looked up once."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    alike = all(p.schema[column].dataType == df.schema[column].dataType for p in parents)
    for parent in parents:
        value = F.col(column) if alike else F.col(column).cast("string")
        known = parent.filter(F.col(column).isNotNull()).select(value.alias("_known"))
        counts = counts.join(known, value == F.col("_known"), "left_anti")
    return counts.select(entry["rule"].alias("rule"), entry["key"].alias("key"), "n")


def broken_keys(name: str, tables: dict[str, DataFrame], stored: dict[str, DataFrame], unique: tuple[tuple[str, ...], ...],
                foreign: list[str]) -> DataFrame:
    """(rule, key) of the table's keys that repeat, are stored already, or have no parent in either set of tables.

    Keys are compared as they are stored, each rule for itself, and only broken
    ones become text and are written. Stored rows are cut down to those that may
    hold one of the keys before they move.
    """
    rules, df = CONSTRAINTS[name], tables[name]
    keys = [(rules.key,), *unique]
    bounds = None
    if stored:
        asked = sorted({columns[0] for columns in keys} | set(foreign))
        bounds = df.agg(*[end(c).alias(f"{label}_{c}") for c in asked for label, end in (("low", F.min), ("high", F.max))]).first()
    counts = []
    for columns, entry in zip(keys, _unique_keys(Rules(rules.key, unique))):
        there = _near(stored[name], df, list(columns), bounds) if name in stored else None
        counts.append(_counted(df, columns, entry, there).filter("n > 1"))
    for column, entry in zip(foreign, _foreign_keys(foreign)):
        parent = rules.parents[column]
        known = {of: t[parent].select(F.col(CONSTRAINTS[parent].key).alias(column)) for of, t in (("new", tables), ("stored", stored)) if parent in t}
        if "stored" in known:
            known["stored"] = _near(known["stored"], df, [column], bounds)
        counts.append(_orphans(df, column, entry, list(known.values())))
    return settle(reduce(DataFrame.unionByName, counts), "keys").select("rule", "key")


def check_table(name: str, tables: dict[str, DataFrame], run_date: dt.date, stored: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, rule, row_id, reason) for each row of a table and each rule it breaks.

    With ``stored`` the rows are additions to the stored table of the name, and
    parents may be in either set of tables. A rule whose columns or parent
    table aren't there is a row of its own, without row_id. Of the table, each
    key rule reads its own columns; all are read once more for the rows of
    broken keys and for the row rules.
    """
    rules, df, stored = CONSTRAINTS[name], tables[name], stored or {}
    absent = [(f"{FOREIGN}{c}", f"table {parent} is not there") for c, parent in rules.parents.items() if parent not in tables and parent not in stored]
    wanted = {FOREIGN + c: [c] for c in rules.parents} | {UNIQUE + ", ".join(k): list(k) for k in rules.unique} | {
        r: ROW_CHECKS[r][0] for r in rules.rows} | {"required": list(rules.required)}
    lacking = {rule: gaps for rule, cols in wanted.items() if (gaps := [c for c in cols if c not in df.columns])}
    absent += [(rule, f"column {', '.join(gaps)} is not there") for rule, gaps in lacking.items()]
    present = Rules(rules.key, tuple(k for k in rules.unique if UNIQUE + ", ".join(k) not in lacking))
    foreign = [c for c, parent in rules.parents.items() if FOREIGN + c not in lacking and (parent in tables or parent in stored)]

    entries = _exploded(df, rules.key, _unique_keys(present) + _foreign_keys(foreign))
    # Written, so that the rows are not shuffled for a few keys, or none.
    broken = settle(broken_keys(name, tables, stored, present.unique, foreign), "broken")
    by_key = entries.join(broken, ["rule", "key"], "left_semi").select("rule", "row_id", "reason")
    required = [c for c in (rules.key, *rules.required) if c in df.columns]
    reasons = [("required", checks.not_null_reason(required)), *[(r, ROW_CHECKS[r][1](run_date)) for r in rules.rows if r not in lacking]]
    by_row = (df.select(F.col(rules.key).cast("bigint").alias("row_id"), F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), reason.alias("reason")) for rule, reason in reasons])))
        .filter(F.col("reason").isNotNull()).select("rule", "row_id", "reason"))
    found = by_key.unionByName(by_row)
    if absent:
        rows = [(rule, None, reason) for rule, reason in absent]
        found = found.unionByName(df.sparkSession.createDataFrame(rows, "rule string, row_id bigint, reason string"))
    return found.select(F.lit(name).alias("table_name"), "rule", "row_id", "reason")


def _judged(rejected: Iterable[DataFrame], strict: bool) -> DataFrame:
    """All rejected rows; ``strict`` looks at one table after the other and raises at the first bad row."""
    found = []
    for rows in rejected:
        bad = rows.first() if strict else None
        if bad is not None:
            raise RejectedRows(f"{bad['table_name']} {bad['row_id']}: {bad['reason']}")
        found.append(rows)
    return reduce(DataFrame.unionByName, found)


def check_tables(tables: dict[str, DataFrame], run_date: dt.date, only: list[str] | None = None,
                 strict: bool = False) -> DataFrame:
    """Rejected rows of all known tables, or of ``only`` some; ``strict`` raises if there are any."""
    names = [n for n in CONSTRAINTS if n in tables and (only is None or n in only)]
    return _judged((check_table(n, tables, run_date) for n in names), strict)


def check_additions(new: dict[str, DataFrame], stored: dict[str, DataFrame], run_date: dt.date, strict: bool = False) -> DataFrame:
    """Rejected rows among those to be added; stored rows are only looked up, not checked again."""
    return _judged((check_table(n, new, run_date, stored) for n in CONSTRAINTS if n in new), strict)
