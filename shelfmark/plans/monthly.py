"""The monthly load over stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators import keys
from shelfmark.operators.aggregates import distinct_tuples, high_water_mark
from shelfmark.operators.checks import check_not_null
from shelfmark.operators.settle import settle
from shelfmark.plans import warehouse
from shelfmark.plans.sums import KEYS as SUMS, sums_of
from shelfmark.plans.constraints import CONSTRAINTS
from shelfmark.schemas import ETL_LOG
from shelfmark.sources.tables import StagedTables, TableStore

LOG, SALES, FACT, UNMATCHED = "etl_log", "synthetic_insert", "sales_fact", "synthetic_unmatched"
# Paths of month parts without rows to load begin so.
CLOSED = "closed-"
#: Keys of the dimensions, which are kept in ranges of them.
DIMENSIONS = {name: f"{name}_id" for name in ("month_year_dim", "author_dim", "book_dim", "nyt_bestseller_dim")}


def month_part(month: int, year: int) -> str:
    return f"{year:04d}-{month:02d}"


def store_sales(store: TableStore, sales: DataFrame, closed: bool = False) -> None:
    """Write sales rows in month parts; the months touched are replaced.

    One write for all months, whose names are read from its folders. The copies
    of year and month that name them leave the columns in the files. ``closed`` tells that all rows are
    loaded already, so that no run opens these months again.
    """
    foldered = sales.withColumns({"part_year": F.col("year"), "part_month": F.col("month")})
    root = store.write(SALES, foldered, ["part_year", "part_month"], CLOSED if closed else "")
    folders = store.spark.read.schema(foldered.schema).parquet(root).select("part_month", "part_year").distinct().collect()
    months = [(r["part_month"], r["part_year"]) for r in folders]
    if not months:
        return
    store.switch({(SALES, month_part(month, year)): [f"{root}/part_year={year}/part_month={month}"]
                  for month, year in months})


def open_months(store: TableStore) -> list[str]:
    """Month parts that may hold rows not loaded yet, as the manifest tells."""
    return sorted({part for (table, part), paths in store.paths().items()
                   if table == SALES and not all(f"/{SALES}/{CLOSED}" in path for path in paths)})


def add_sales(store: TableStore, incoming: DataFrame) -> None:
    """Append sales rows, reading only the months they belong to; a row without month or year is an error."""
    check_not_null(incoming, ["month", "year"], strict=True)
    wanted = {month_part(r["month"], r["year"]) for r in incoming.select("month", "year").distinct().collect()}
    there = [part for table, part in store.paths() if table == SALES and part in wanted]
    existing = store.read(SALES, there) if there else None
    store_sales(store, warehouse.append_sales(existing, incoming))


def unloaded_counts(sales: DataFrame, distinct: Column) -> tuple[int, int]:
    """Rows not loaded yet, and the distinct values among them."""
    row = warehouse.not_loaded(sales).agg(F.count("*").alias("n"), distinct.alias("values")).first()
    return row["n"], row["values"]


class MonthlyRun:
    """One run over staged tables: nothing is current before the run's end.

    Dimensions get only the rows that are missing, as files of their own.
    ``read`` is the number of source rows the step at work has counted.
    """

    def __init__(self, store: TableStore, run_ts: dt.datetime):
        self.store, self.run_ts, self.spark = StagedTables(store), run_ts, store.spark
        self.rows: list[tuple] = []
        self.read = 0

    def log(self, source: str, details: str, inserted: int = 0, failed: int = 0) -> None:
        self.rows.append((self.run_ts, source, details, self.read, inserted, 0, failed))
        self.read = 0

    def log_rows(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, ETL_LOG).coalesce(1)

    def last_run(self, job: str, first_load: str) -> dt.datetime | None:
        """Latest run of the job, else of the first load, else none."""
        if LOG not in self.store:
            return None
        log = self.store.read(LOG)
        return high_water_mark(log, "oltp", [job]) or high_water_mark(log, "oltp", [first_load])

    def add_rows(self, table: str, fresh: DataFrame) -> int:
        """Write new rows beside a table's files; how many there are."""
        fresh = settle(fresh, table)
        added = fresh.count()
        if added:
            self.store.append(table, fresh, DIMENSIONS[table])
        return added

    def month_year_dim(self) -> int:
        months = open_months(self.store)
        if not months:
            return 0
        sales = self.store.read(SALES, months)
        rows, self.read = unloaded_counts(sales, distinct_tuples(["month", "year"]))
        return self.add_rows("month_year_dim", warehouse.new_months(self.store.read("month_year_dim"), sales)) if rows else 0

    def nyt_bestseller_dim(self) -> int:
        months = open_months(self.store)
        if not months:
            return 0
        sales = self.store.read(SALES, months)
        rows, self.read = unloaded_counts(sales, F.count_distinct("nyt_best_selling_category"))
        dim = self.store.read("nyt_bestseller_dim")
        return self.add_rows("nyt_bestseller_dim", warehouse.new_categories(dim, sales)) if rows else 0

    def author_dim(self) -> int:
        """The log counts overwritten names as inserted, like added ones.

        Only ranges of the dimension with a changed author are rewritten.
        """
        last, key = self.last_run("update_author_dim", "load_author_dim"), DIMENSIONS["author_dim"]
        changed = self.store.read_since("author", last)
        self.read = changed.count()
        if self.read:
            dim = self.store.read("author_dim")
            parts = self.store.parts_with("author_dim", dim.join(changed, "author_id", "left_semi"), key)
            renamed = warehouse.renamed_authors(self.store.read("author_dim", parts), changed)
            fresh = settle(warehouse.new_authors(dim, changed, keys.max_id(self.store.read_last("author_dim"), key)), "author_dim")
            if parts:
                self.store.replace_parts("author_dim", parts, renamed.unionByName(fresh), key)
            else:
                self.store.append("author_dim", fresh, key)
        return self.read

    def book_dim(self) -> int:
        last = self.last_run("update_book_dim", "load_book_dim")
        oltp = self.store_tables("book", "publisher", "format", "language") | {"book_isbn": self.store.read_since("book_isbn", last)}
        self.read = oltp["book_isbn"].count()
        if not self.read:
            return 0
        top = keys.max_id(self.store.read_last("book_dim"), DIMENSIONS["book_dim"])
        return self.add_rows("book_dim", warehouse.new_books(self.store.read("book_dim"), oltp, self.run_ts.date(), last, top))

    def store_tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.store.read(name) for name in names}

    def sales(self, month: int, year: int) -> int:
        """Add the month's fact part, its sums and unmatched rows, and mark its sales as loaded.

        Fact ids grow with every load, so the last load holds the highest one.
        A store whose fact came without sums gets those of all its loads first.
        """
        part, paths = month_part(month, year), self.store.paths()
        if part not in open_months(self.store):
            return 0
        star = self.store_tables("book_dim", "author_dim", "month_year_dim", "nyt_bestseller_dim")
        oltp = self.store_tables("book_isbn", "author_isbn", "isbn_rating")
        sales = self.store.read(SALES, [part])
        self.read = warehouse.unloaded(sales, month, year).count()
        if not self.read:
            return 0
        top = keys.max_id(self.store.read_newest(FACT), "sales_fact_id") if FACT in self.store else 0
        fact = self.store.write(FACT, warehouse.monthly_fact(sales, star, oltp, month, year, top))
        lost = self.store.write(UNMATCHED, warehouse.unmatched_sales(sales, star, oltp, month, year, self.run_ts))
        flagged = self.store.write(SALES, warehouse.mark_loaded(sales, month, year), label=CLOSED)
        inserted = self.spark.read.parquet(fact).count()
        parts = {(UNMATCHED, part): [*paths.get((UNMATCHED, part), []), lost], (SALES, part): [flagged]}
        if inserted:
            parts[FACT, part] = [*paths.get((FACT, part), []), fact]
            added = self.spark.read.parquet(fact)
            for table in SUMS:
                known = [] if table in self.store or FACT not in self.store else [sums_of(self.store.read(FACT), table)]
                written = [self.store.write(table, rows) for rows in (*known, sums_of(added, table))]
                parts[table, part] = [*paths.get((table, part), []), *written]
        self.store.switch(parts)
        return inserted


def process_monthly_sales(store: TableStore, month: int, year: int, run_ts: dt.datetime) -> None:
    """Dimensions, then the month's sales, then the master log row; all of it becomes current in one switch.

    A failing step leaves every table as it was, but for two rows of the log:
    one for the step, with the source rows it had counted, and one for the run.
    The error goes on to the caller.
    """
    run = MonthlyRun(store, run_ts)
    steps = [
        ("synthetic", "update_month_year_dim", run.month_year_dim),
        ("synthetic", "update_nyt_bestseller_dim", run.nyt_bestseller_dim),
        ("oltp", "update_author_dim", run.author_dim),
        ("oltp", "update_book_dim", run.book_dim),
        ("synthetic", "load_sales_to_warehouse", lambda: run.sales(month, year)),
    ]
    for source, details, step in steps:
        try:
            run.log(source, details, inserted=step())
        except Exception:
            run.rows.clear()
            run.log(source, details, failed=1)
            run.log("synthetic", "insert_monthly_sales", failed=1)
            store.append(LOG, run.log_rows())
            raise
    run.log("synthetic", "insert_monthly_sales")
    run.store.append(LOG, run.log_rows())
    run.store.commit()


def first_load(store: TableStore, oltp: dict[str, DataFrame], raw_sales: DataFrame, run_ts: dt.datetime) -> None:
    """Star schema from normalised tables and raw sales, staging rows, and the seed log."""
    store.publish(oltp, {name: CONSTRAINTS[name].key for name, rows in oltp.items() if name in CONSTRAINTS and CONSTRAINTS[name].key in rows.columns})
    oltp = {name: store.read(name) for name in oltp}
    store.publish({"sales": warehouse.clean_sales(raw_sales, oltp)})
    sales = store.read("sales")
    store.publish({
        "month_year_dim": warehouse.init_month_year_dim(sales),
        "author_dim": warehouse.init_author_dim(oltp["author"]),
        "book_dim": warehouse.init_book_dim(oltp, run_ts.date()),
        "nyt_bestseller_dim": warehouse.init_nyt_dim(sales),
    }, DIMENSIONS)
    star = {name: store.read(name) for name in ("month_year_dim", "author_dim", "book_dim", "nyt_bestseller_dim")}
    store.publish({FACT: warehouse.init_sales_fact(sales, star, oltp, oltp["isbn_rating"])})
    star[FACT] = store.read(FACT)
    store.publish({table: sums_of(star[FACT], table) for table in SUMS})
    store_sales(store, warehouse.backfill_sales(star), closed=True)
    store.append(LOG, warehouse.seed_etl_log(star, run_ts))


def load_status(store: TableStore, month: int, year: int) -> int:
    """Rows of the month that count as loaded."""
    loaded = F.col("loaded_to_warehouse") & (F.col("month") == month) & (F.col("year") == year)
    return store.read(SALES).filter(loaded).count()

