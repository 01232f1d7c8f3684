"""Staging table to keyed tables, row and key checks, change tracking."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from queries import duck
from queries.registry import query, with_tables
from queries.standins import BOOKS, STAGING, books, for_duckdb, staging
from shelfmark.functions import genres
from shelfmark.operators import changes, checks, keys
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import additions, constraints, deletions, normalise, snapshot
from shelfmark.sources.tables import WRITERS, TableStore

RUN_TS = dt.datetime(2026, 1, 15, 12, 0)
BLANKS = ["isbn10", "isbn13", "title_norm", *[f"author_{i}_role" for i in range(1, 6)], "language", "series_name_norm",
          "description_norm", "edition_norm"]
AUTHORS = ["primary_author_name", "author_2", "author_3", "author_4", "author_5"]


def union_slots(columns: list[str], value: str) -> str:
    return " UNION ALL ".join(f"SELECT {c} AS {value}, _src_pos * 64 + {i} AS seen, _src_pos, {i} AS slot FROM s"
                              for i, c in enumerate(columns))


def numbered(source: str, value: str, id_col: str, where: str = "true") -> str:
    return (f"SELECT row_number() OVER (ORDER BY min(seen)) AS {id_col}, {value} FROM ({source}) "
            f"WHERE {where} GROUP BY {value}")


def lookup(col: str, value: str, id_col: str, null_too: bool = False) -> str:
    where = f"trim({value}) <> ''" + (f" OR {value} IS NULL" if null_too else "")
    return numbered(f'SELECT "{col}" AS {value}, _src_pos AS seen FROM s', value, id_col, where)


GENRE_SLOTS = """SELECT _src_pos, i - 1 AS slot, nullif(trim(replace(parts[i], '''', '')), '') AS genre, _src_pos * 64 + i AS seen
FROM (SELECT _src_pos, string_split(array_to_string(genres_norm, ','), ',') AS parts FROM s), range(1, 11) AS r(i) WHERE i <= len(parts)"""

TABLES = {
    "staging": for_duckdb(STAGING),
    "s": "SELECT * REPLACE (" + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in BLANKS) + ") FROM staging",
    "author": "SELECT author_id, full_name, " + ", ".join(
        f"{fn('full_name')} AS {name}" for name, fn in [("first_name", duck.first_name), ("middle_name", duck.middle_name),
                                                        ("last_name", duck.last_name)])
    + " FROM (" + numbered(union_slots(AUTHORS, "full_name"), "full_name", "author_id", "full_name <> ''") + ")",
    "role": numbered(union_slots([f"author_{i}_role" for i in range(1, 6)], "role"), "role", "role_id", "role IS NOT NULL"),
    "genre": numbered(GENRE_SLOTS, "genre", "genre_id", "genre IS NOT NULL"),
    "language": lookup("language", "language", "language_id", null_too=True),
    "publisher": lookup("publisher_norm", "publisher", "publisher_id"),
    "edition": lookup("edition_norm", "edition", "edition_id"),
    "format": lookup("bookFormat_norm", "format", "format_id"),
    "series": lookup("series_name_norm", "series_name", "series_id"),
    "book": "SELECT book_uid AS book_id, arg_min(title_norm, _src_pos) AS title FROM s GROUP BY 1",
    "book_isbn": """SELECT row_number() OVER (ORDER BY _src_pos) AS book_isbn_id, isbn10, isbn13, book_uid AS book_id, format_id,
        edition_id, publisher_id, language_id, is_boxset = 1 AS is_boxset, "publishDate_norm" AS publish_date,
        "firstPublishDate_norm" AS original_publish_date, series_id,
        CASE WHEN series_name IS NOT NULL THEN series_num END AS series_num, pages_norm AS pages
        FROM s LEFT JOIN format ON format = "bookFormat_norm" LEFT JOIN edition ON edition = edition_norm
        LEFT JOIN publisher ON publisher = publisher_norm LEFT JOIN language USING (language)
        LEFT JOIN series ON series_name = series_name_norm WHERE isbn10 IS NOT NULL OR isbn13 IS NOT NULL""",
    "link": """SELECT _src_pos, book_isbn_id FROM s JOIN book_isbn b ON b.isbn13 = s.isbn13
        UNION SELECT _src_pos, book_isbn_id FROM s JOIN book_isbn b ON b.isbn10 = s.isbn10""",
}


def tables_sql(*names: str) -> dict[str, str]:
    """Common table expressions up to the last of the wanted tables."""
    last = max(list(TABLES).index(n) for n in names)
    kept = list(TABLES)[:last + 1]
    return {n: TABLES[n] if n == "staging" else TABLES[n].replace("{", "{{").replace("}", "}}") for n in kept}


def over(table: str) -> str:
    return with_tables(tables_sql(table), f"SELECT * FROM {table}")


def clean_staging(t):
    return normalise.blanks_to_null(staging(t))


@query("n1_author", over("author"))
def _(t):
    return normalise.build_author(clean_staging(t))


@query("n2_language", over("language"))
def _(t):
    return normalise.build_lookup(clean_staging(t), "language", "language", "language_id", keep_null=True)


@query("n2_publisher", over("publisher"))
def _(t):
    return normalise.build_lookup(clean_staging(t), "publisher_norm", "publisher", "publisher_id")


@query("n2_edition", over("edition"))
def _(t):
    return normalise.build_lookup(clean_staging(t), "edition_norm", "edition", "edition_id")


@query("n2_series", over("series"))
def _(t):
    return normalise.build_lookup(clean_staging(t), "series_name_norm", "series_name", "series_id")


@query("n2_format_keeps_ids", with_tables(tables_sql("format"), """
SELECT 7 AS format_id, 'ebook' AS format UNION ALL
SELECT 7 + row_number() OVER (ORDER BY format_id), format FROM format WHERE format <> 'ebook'"""))
def _(t):
    there = t.spark.createDataFrame([(7, "ebook")], "format_id bigint, format string")
    return normalise.build_lookup(clean_staging(t), "bookFormat_norm", "format", "format_id", existing=there)


@query("n3_genre", over("genre"))
def _(t):
    return normalise.build_genre(clean_staging(t))


@query("n4_role", over("role"))
def _(t):
    return normalise.build_role(clean_staging(t))


@query("n5_book", over("book"))
def _(t):
    return normalise.build_book(clean_staging(t))


def lookups(t):
    return t.stored("lookups", lambda t: {name: settle(table, name) for name, table in build_lookups(t).items()})


def build_lookups(t):
    s = clean_staging(t)
    return {
        "format": normalise.build_lookup(s, "bookFormat_norm", "format", "format_id"),
        "edition": normalise.build_lookup(s, "edition_norm", "edition", "edition_id"),
        "publisher": normalise.build_lookup(s, "publisher_norm", "publisher", "publisher_id"),
        "language": normalise.build_lookup(s, "language", "language", "language_id", keep_null=True),
        "series_name": normalise.build_lookup(s, "series_name_norm", "series_name", "series_id"),
    }


@query("n6_n7_book_isbn", over("book_isbn"))
def _(t):
    return normalise.build_book_isbn(clean_staging(t), lookups(t))


def book_isbn(t):
    return t.stored("book_isbn_made", lambda t: settle(normalise.build_book_isbn(clean_staging(t), lookups(t)), "isbns"))


def linked(t):
    s = clean_staging(t)
    return s, t.stored("link", lambda t: settle(normalise.link_isbn(s, book_isbn(t)), "link"))


@query("j4_link_by_isbn", over("link"))
def _(t):
    return normalise.link_isbn(clean_staging(t), book_isbn(t))


@query("n8_author_isbn", with_tables(tables_sql("link"), f"""
, p AS (SELECT book_isbn_id, full_name, role_id, slot, author_id FROM (
  {" UNION ALL ".join(f"SELECT _src_pos, {c} AS full_name, author_{i}_role AS role, {i} AS slot FROM s" for i, c in enumerate(AUTHORS, 1))})
  JOIN link USING (_src_pos) JOIN author USING (full_name) LEFT JOIN role USING (role)),
q AS (SELECT book_isbn_id, author_id, role_id, min(slot) AS slot FROM p
  GROUP BY book_isbn_id, author_id, role_id, CASE WHEN role_id IS NULL THEN slot END)
SELECT row_number() OVER (ORDER BY slot, book_isbn_id, author_id, role_id) AS author_isbn_id, book_isbn_id, author_id, role_id FROM q""".strip()
    .replace(", p AS", ", p AS", 1)).replace("\n, p AS", ",\np AS", 1))
def _(t):
    s, link = linked(t)
    author = t.stored("author_made", lambda t: settle(normalise.build_author(s), "author"))
    return normalise.build_author_isbn(s, link, author, settle(normalise.build_role(s), "role"))


@query("n9_review_type", with_tables({"r": BOOKS["isbn_rating"]}, """
SELECT review_type, count(*) AS n FROM r JOIN (VALUES (1, '5_star'), (2, '4_star'), (3, '3_star'), (4, '2_star'), (5, '1_star'))
 AS v(id, review_type) ON id = review_type_id GROUP BY 1"""))
def _(t):
    types = F.broadcast(normalise.build_review_type(t.spark))
    return books(t)["isbn_rating"].join(types, "review_type_id").groupBy("review_type").agg(F.count("*").alias("n"))


@query("n10_isbn_rating", with_tables(tables_sql("link"), "SELECT row_number() OVER (ORDER BY review_type_id, book_isbn_id) "
       "AS isbn_rating_id, book_isbn_id, review_type_id, count FROM (" + " UNION ALL ".join(
           f'SELECT _src_pos, {i} AS review_type_id, "{6 - i}_star" AS count FROM s WHERE "{6 - i}_star" IS NOT NULL'
           for i in range(1, 6)) + ") JOIN link USING (_src_pos)"))
def _(t):
    s, link = linked(t)
    return normalise.build_isbn_rating(s, link)


@query("n11_book_isbn_genre", with_tables(tables_sql("link"), f"""
SELECT row_number() OVER (ORDER BY slot, book_isbn_id) AS book_isbn_genre_id, book_isbn_id, genre_id FROM (
 SELECT book_isbn_id, genre_id, min(slot) AS slot FROM ({GENRE_SLOTS}) g JOIN link USING (_src_pos) JOIN genre USING (genre)
 GROUP BY 1, 2)"""))
def _(t):
    s, link = linked(t)
    return normalise.build_book_isbn_genre(s, link, settle(normalise.build_genre(s), "genre"))


PLAIN_TABLES = ("author", "book", "book_isbn", "genre", "role", "language", "publisher", "edition", "format", "series")

CONTRIBUTORS = " UNION ALL ".join(f"SELECT _src_pos, {c} AS full_name, author_{i}_role AS role, {i} AS slot FROM s" for i, c in enumerate(AUTHORS, 1))


@query("n12_normalise_row_counts", with_tables(tables_sql("link"), "SELECT *, TIMESTAMP '2026-01-15 12:00:00' AS updated_at FROM ("
       + " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {name}" for name in PLAIN_TABLES) + f"""
UNION ALL SELECT 'review_type', 5
UNION ALL SELECT 'isbn_rating', sum({" + ".join(f'CAST("{i}_star" IS NOT NULL AS INT)' for i in range(1, 6))}) FROM s JOIN link USING (_src_pos)
UNION ALL SELECT 'author_isbn', count(*) FROM (SELECT DISTINCT book_isbn_id, full_name, role, CASE WHEN role IS NULL THEN slot END
 FROM ({CONTRIBUTORS}) JOIN link USING (_src_pos) WHERE full_name <> '')
UNION ALL SELECT 'book_isbn_genre', count(DISTINCT (book_isbn_id, genre)) FROM ({GENRE_SLOTS}) g JOIN link USING (_src_pos) WHERE genre IS NOT NULL)"""))
def _(t):
    made = normalise.normalise(staging(t), RUN_TS)
    counts = [made[n].groupBy("updated_at").agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in made]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return rows.select("name", "n", "updated_at")


@query("r3_genre_profile", with_tables(tables_sql("s"), "SELECT " + ", ".join(
    f"count(DISTINCT _src_pos) FILTER (WHERE slot = {i - 1} AND genre IS NOT NULL) AS has_genre_{i}" for i in range(1, 11))
    + f" FROM ({GENRE_SLOTS})"))
def _(t):
    from shelfmark.plans.reports import genre_profile
    cols = genres.genre_columns(F.col("genres_norm"))
    return genre_profile(staging(t).select(*[c.alias(n) for n, c in cols.items()]))


# Checks

ISBN_ROWS = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '1234' WHEN 1 THEN '9781234567890' END AS isbn13,
 CASE o_orderkey % 5 WHEN 1 THEN '123' WHEN 2 THEN '1234567890' WHEN 3 THEN '12345678901' END AS isbn10 FROM {orders}"""


@query("v1_check_isbn", with_tables({"i": ISBN_ROWS}, """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'ISBN13 must be exactly 13 characters'
 WHEN o_orderkey % 5 = 4 THEN 'At least one ISBN (ISBN10 or ISBN13) must be provided'
 ELSE 'ISBN10 must be exactly 10 characters' END AS reason FROM i WHERE o_orderkey % 5 <> 2"""))
def _(t):
    return checks.check_isbn(t.sql(ISBN_ROWS))[1].select("o_orderkey", "reason")


@query("v1_valid_isbn", "SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 2")
def _(t):
    return checks.check_isbn(t.sql(ISBN_ROWS))[0].select("o_orderkey")


@query("v2_check_publish_dates", """
SELECT o_orderkey, CASE WHEN o_orderdate > DATE '2000-01-01' THEN 'Publish date cannot be in the future'
 ELSE 'Original publish date cannot be in the future' END AS reason FROM orders
WHERE o_orderdate > DATE '2000-01-01' OR (o_custkey % 2 = 0 AND o_orderdate + INTERVAL 100 DAY > DATE '2000-01-01')""")
def _(t):
    later = F.when(F.col("o_custkey") % 2 == 0, F.date_add(F.to_date("o_orderdate"), 100))
    rows = t.orders.withColumns({"publish_date": F.to_date("o_orderdate"), "original_publish_date": later})
    return checks.check_publish_dates(rows, dt.date(2000, 1, 1))[1].select("o_orderkey", "reason")


@query("v3_check_rating_count", """
SELECT c_custkey, 'Rating count cannot be negative' AS reason FROM customer WHERE c_acctbal < 0""")
def _(t):
    return checks.check_rating_count(t.customer.withColumn("count", F.col("c_acctbal")))[1].select("c_custkey", "reason")


@query("v4_check_unique", """
SELECT l_orderkey, l_linenumber, l_partkey, 'duplicate key (l_orderkey, l_linenumber)' AS reason FROM lineitem
SEMI JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) USING (l_orderkey, l_linenumber)""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return checks.check_unique(rows, ["l_orderkey", "l_linenumber"])[1]


@query("v4_unique_rows", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ANTI JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) USING (l_orderkey, l_linenumber)""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return checks.check_unique(rows, ["l_orderkey", "l_linenumber"])[0]


@query("v5_check_foreign_key", """
SELECT l_orderkey, l_partkey, 'l_partkey has no parent row' AS reason FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def _(t):
    parents = t.part.filter("p_size > 10")
    return checks.check_foreign_key(t.lineitem.select("l_orderkey", "l_partkey"), "l_partkey", parents, "p_partkey")[1]


@query("v6_check_not_null", """
SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'kind must not be null' ELSE 'brand must not be null' END AS reason
FROM part WHERE p_type = 'SMALL' OR p_brand = 'Brand#2'""")
def _(t):
    rows = t.part.select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("kind"),
                         F.nullif("p_brand", F.lit("Brand#2")).alias("brand"))
    return checks.check_not_null(rows, ["kind", "brand"])[1].select("p_partkey", "reason")


@query("v7_duplicate_sales", """
SELECT DISTINCT isbn13, month, year FROM (SELECT concat('', o_custkey) AS isbn13, month(o_orderdate) AS month,
 year(o_orderdate) AS year, o_orderkey FROM orders) i
WHERE EXISTS (SELECT 1 FROM orders e WHERE concat('', e.o_custkey) = isbn13 AND month(e.o_orderdate) = month
 AND year(e.o_orderdate) = year AND e.o_orderkey <> i.o_orderkey)
 OR EXISTS (SELECT 1 FROM customer WHERE concat('', c_custkey) = isbn13 AND month = 1 AND year = 1998)""")
def _(t):
    from shelfmark.plans.warehouse import duplicate_sales
    incoming = t.orders.select(F.col("o_custkey").cast("string").alias("isbn13"), F.month("o_orderdate").alias("month"),
                               F.year("o_orderdate").alias("year"))
    existing = t.customer.select(F.col("c_custkey").cast("string").alias("isbn13"), F.lit(1).alias("month"),
                                 F.lit(1998).alias("year"))
    return duplicate_sales(existing, incoming)


@query("v8_delete_cascade", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 5)")
def _(t):
    gone = t.part.filter("p_size = 5").select(F.col("p_partkey").alias("l_partkey"))
    return checks.delete_cascade(t.lineitem.select("l_orderkey", "l_partkey"), "l_partkey", gone)


@query("v8_delete_set_null", """
SELECT l_orderkey, CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 5) THEN NULL ELSE l_partkey END AS l_partkey
FROM lineitem""")
def _(t):
    gone = t.part.filter("p_size = 5").select(F.col("p_partkey").alias("l_partkey"))
    return checks.delete_set_null(t.lineitem.select("l_orderkey", "l_partkey"), "l_partkey", gone)


# Change tracking: customers against a changed copy of themselves

OLD_NEW = {
    "old": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS seg, TIMESTAMP '2025-01-01 00:00:00' AS updated_at FROM {customer}",
    "new": """SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN concat(c_name, ' jr') ELSE c_name END AS name,
        c_mktsegment AS seg, TIMESTAMP '2025-02-02 00:00:00' AS updated_at FROM {customer} WHERE c_mktsegment <> 'BUILDING'
        UNION ALL SELECT s_suppkey + 100000000, s_name, 'NEW', TIMESTAMP '2025-02-02 00:00:00' FROM {supplier}""",
}


def snapshots(t, key: str, name: str):
    renamed = {"id": key, "name": name}
    return t.sql(OLD_NEW["old"]).withColumnsRenamed(renamed), t.sql(OLD_NEW["new"]).withColumnsRenamed(renamed)


@query("a1_touch_updated_at", with_tables(OLD_NEW, """
SELECT n.id AS book_id, n.name AS title, n.seg, CASE WHEN o.id IS NULL THEN n.updated_at
 WHEN o.name = n.name THEN o.updated_at ELSE TIMESTAMP '2026-01-15 12:00:00' END AS updated_at
FROM new n LEFT JOIN old o ON o.id = n.id"""))
def _(t):
    old, new = snapshots(t, "book_id", "title")
    return changes.touch_updated_at(old, new, "book_id", RUN_TS)


def entity_log_sql(key: str, name: str, added: str, deleted: str, updated: str) -> str:
    return with_tables(OLD_NEW, f"""
SELECT coalesce(n.id, o.id) AS {key}, coalesce(n.name, o.name) AS {name},
 CASE WHEN o.id IS NULL THEN '{added}' || n.id WHEN n.id IS NULL THEN '{deleted}' || o.id
 ELSE '{updated}' || o.name || ' to ' || n.name END AS log_message, TIMESTAMP '2026-01-15 12:00:00' AS log_date
FROM new n FULL JOIN old o ON o.id = n.id WHERE o.id IS NULL OR n.id IS NULL OR o.name <> n.name""")


@query("a2_book_log", entity_log_sql("book_id", "title", "New Book Added = ", "Book Deleted = ", "Book Updated from "))
def _(t):
    old, new = snapshots(t, "book_id", "title")
    return changes.book_log(changes.diff(old, new, "book_id"), RUN_TS)


@query("a3_author_log", entity_log_sql("author_id", "full_name", "New Author Added = ", "Author Deleted = ", "Name updated from "))
def _(t):
    old, new = snapshots(t, "author_id", "full_name")
    return changes.author_log(changes.diff(old, new, "author_id"), RUN_TS)


RATING_CHANGES = {
    "old": BOOKS["isbn_rating"],
    "new": """SELECT isbn_rating_id, book_isbn_id, review_type_id,
        CAST(CASE WHEN review_type_id = 1 THEN count + 1 ELSE count END AS INT) AS count FROM ("""
           + BOOKS["isbn_rating"] + """) r WHERE NOT (review_type_id = 3 AND count < 150)
        UNION ALL SELECT 1000000000 + s_suppkey, s_suppkey, CAST(1 + s_suppkey % 6 AS BIGINT), 9 FROM {supplier}""",
}


@query("a4_rating_log", with_tables(RATING_CHANGES, """
, v AS (SELECT * FROM (VALUES (1, '5_star'), (2, '4_star'), (3, '3_star'), (4, '2_star'), (5, '1_star')) AS x(id, name))
SELECT coalesce(n.isbn_rating_id, o.isbn_rating_id) AS isbn_rating_id, coalesce(n.book_isbn_id, o.book_isbn_id) AS book_isbn_id,
 id AS review_type_id, name AS review_type_name,
 CASE WHEN o.isbn_rating_id IS NULL THEN 'INSERT' WHEN n.isbn_rating_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
 coalesce(o.count, n.count) AS old_count, CASE WHEN n.isbn_rating_id IS NULL THEN 0 ELSE n.count END AS new_count,
 TIMESTAMP '2026-01-15 12:00:00' AS log_date
FROM new n FULL JOIN old o ON o.isbn_rating_id = n.isbn_rating_id JOIN v ON id = coalesce(n.review_type_id, o.review_type_id)
WHERE o.count IS DISTINCT FROM n.count""").replace("\n, v AS", ",\nv AS", 1))
def _(t):
    diff = changes.diff(t.sql(RATING_CHANGES["old"]), t.sql(RATING_CHANGES["new"]), "isbn_rating_id")
    return changes.rating_log(diff, normalise.build_review_type(t.spark), RUN_TS)


#: Keys in a range of the stored tables; small, so that small data have several.
RANGE_ROWS = 200_000


def snapshot_store(t, tables: dict, part_rows: int = RANGE_ROWS) -> TableStore:
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/oltp-{uuid.uuid4().hex}", part_rows=part_rows)
    store.publish(tables, {name: constraints.CONSTRAINTS[name].key for name in tables})
    return store


def stored_book_logs(t) -> TableStore:
    old, new = snapshots(t, "book_id", "title")
    store = snapshot_store(t, {"book": old}, part_rows=2000)
    snapshot.publish_snapshot(store, {"book": new}, RUN_TS)
    return store


@query("a2_book_logs_stored", entity_log_sql("book_id", "title", "New Book Added = ", "Book Deleted = ", "Book Updated from "))
def _(t):
    return stored_book_logs(t).read("book_logs")


@query("a1_book_snapshot_stored", with_tables(OLD_NEW, """
SELECT n.id AS book_id, n.name AS title, n.seg, CASE WHEN o.id IS NULL THEN n.updated_at
 WHEN o.name = n.name THEN o.updated_at ELSE TIMESTAMP '2026-01-15 12:00:00' END AS updated_at
FROM new n LEFT JOIN old o ON o.id = n.id"""))
def _(t):
    return stored_book_logs(t).read("book")


# A snapshot that changes some of the later books and adds a tenth: which ranges of keys keep their files.
GROWN = {"old": """SELECT p_partkey AS book_id, p_name AS title FROM {part} WHERE p_partkey <= (SELECT max(p_partkey) * 0.9 FROM {part})""",
         "new": """SELECT p_partkey AS book_id, CASE WHEN p_size = 1 AND p_partkey > (SELECT max(p_partkey) * 0.7 FROM {part}) THEN concat(p_name, ' ii')
             ELSE p_name END AS title FROM {part}"""}
GROWN_ROWS = 100


@query("a1_ranges_kept", with_tables(GROWN, f"""
SELECT CAST(floor((n.book_id - 1) / {GROWN_ROWS}.0) AS BIGINT) AS key_range, count(*) AS n_rows,
 bool_and(o.book_id IS NOT NULL AND o.title = n.title) AS kept
FROM new n LEFT JOIN old o ON o.book_id = n.book_id GROUP BY 1"""))
def _(t):
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/grown-{uuid.uuid4().hex}", part_rows=GROWN_ROWS)
    store.publish({"book": t.sql(GROWN["old"])}, {"book": "book_id"})
    before = store.paths()
    snapshot.publish_snapshot(store, {"book": t.sql(GROWN["new"])}, RUN_TS)
    ranges = [(part, paths == before.get((name, part))) for (name, part), paths in store.paths().items() if name == "book"]
    rows = store.read("book").withColumn("part", store.label("book", "book_id"))
    return (rows.join(t.spark.createDataFrame(ranges, "part string, kept boolean"), "part")
            .groupBy(F.split("part", "x")[0].cast("long").alias("key_range")).agg(F.count("*").alias("n_rows"), F.bool_and("kept").alias("kept")))


# All 14 tables: ISBNs with editions and dates, some of them wrong.
EDITION = "SELECT CAST(r_regionkey AS BIGINT) AS edition_id, concat('edition ', r_regionkey) AS edition FROM {region}"
REVIEW_TYPE = """SELECT CAST(id AS BIGINT) AS review_type_id, name AS review_type
 FROM (VALUES (1, '5_star'), (2, '4_star'), (3, '3_star'), (4, '2_star'), (5, '1_star')) AS v(id, name)"""
FULL_ISBN = BOOKS["book_isbn"].replace("CAST(NULL AS BIGINT) AS edition_id", "p_partkey % 7 AS edition_id").replace(
    "p_partkey % 10 = 0 AS is_boxset", """p_partkey % 10 = 0 AS is_boxset,
        CASE p_partkey % 3 WHEN 0 THEN DATE '2026-01-14' WHEN 1 THEN DATE '2026-01-15' ELSE DATE '2026-01-16' END AS publish_date,
        CASE WHEN p_partkey % 10 = 5 THEN DATE '2027-01-01' END AS original_publish_date""")
FULL = {**BOOKS, "edition": EDITION, "review_type": REVIEW_TYPE, "book_isbn": FULL_ISBN}


def orphans(table: str, column: str, parent: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'foreign {column}' AS rule, count(*) AS n FROM {table} "
            f"WHERE {column} NOT IN (SELECT {column} FROM {parent}) HAVING count(*) > 0")


def repeats(table: str, *columns: str) -> str:
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (f"SELECT '{table}' AS table_name, 'unique {', '.join(columns)}' AS rule, count(*) AS n FROM ("
            f"SELECT count(*) OVER (PARTITION BY {', '.join(columns)}) AS c FROM {table} WHERE {known}) WHERE c > 1 HAVING count(*) > 0")


def breaches(table: str, rule: str, where: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS n FROM {table} WHERE {where} HAVING count(*) > 0"


BREACHES = [
    *[repeats(t, f"{t}_id") for t in FULL], *[repeats(t, t) for t in ("language", "genre", "role", "publisher", "edition", "format", "review_type")],
    repeats("series", "series_name"), repeats("book_isbn", "isbn13"), repeats("book_isbn", "isbn10"),
    repeats("author_isbn", "book_isbn_id", "author_id", "role_id"), repeats("isbn_rating", "book_isbn_id", "review_type_id"),
    repeats("book_isbn_genre", "book_isbn_id", "genre_id"),
    *[orphans("book_isbn", f"{p}_id", p) for p in ("book", "format", "edition", "publisher", "language", "series")],
    *[orphans(t, "book_isbn_id", "book_isbn") for t in ("author_isbn", "isbn_rating", "book_isbn_genre")],
    orphans("author_isbn", "author_id", "author"), orphans("author_isbn", "role_id", "role"),
    orphans("isbn_rating", "review_type_id", "review_type"), orphans("book_isbn_genre", "genre_id", "genre"),
    breaches("book_isbn", "publish_date", "publish_date > DATE '2026-01-15' OR original_publish_date > DATE '2026-01-15'"),
    breaches("book_isbn", "isbn", "length(isbn13) <> 13 OR length(isbn10) <> 10 OR (isbn10 IS NULL AND isbn13 IS NULL)"),
    breaches("isbn_rating", "rating", "count < 0"), breaches("book_isbn", "required", "book_isbn_id IS NULL OR book_id IS NULL"),
    breaches("isbn_rating", "required", "isbn_rating_id IS NULL OR book_isbn_id IS NULL OR review_type_id IS NULL OR count IS NULL")]


def full_tables(t) -> dict:
    kept = {name: table for name, table in books(t).makers.items() if name != "book_isbn"}
    with ThreadPoolExecutor(WRITERS) as pool:
        made = dict(zip(kept, pool.map(lambda make: make(), kept.values())))
    return made | {name: t.sql(FULL[name]) for name in ("edition", "review_type", "book_isbn")}


@query("v_constraint_catalogue", with_tables({**FULL, "isbn_rating": RATING_CHANGES["new"]}, " UNION ALL ".join(BREACHES)))
def _(t):
    rejected = constraints.check_tables(full_tables(t) | {"isbn_rating": settle(t.sql(RATING_CHANGES["new"]), "ratings")}, RUN_TS.date())
    return rejected.groupBy("table_name", "rule").agg(F.count("*").alias("n"))


@query("v_checked_additions", with_tables({**FULL, "isbn_rating": BOOKS["isbn_rating"]}, """
SELECT 'isbn_rating' AS table_name, 'unique book_isbn_id, review_type_id' AS rule, isbn_rating_id + 1000000000 AS row_id FROM isbn_rating WHERE count >= 150
UNION ALL SELECT 'isbn_rating', 'unique isbn_rating_id', isbn_rating_id FROM isbn_rating WHERE count < 150
UNION ALL SELECT 'isbn_rating', 'foreign book_isbn_id', isbn_rating_id FROM isbn_rating WHERE count < 150"""))
def _(t):
    made, old = full_tables(t), settle(t.sql(BOOKS["isbn_rating"]), "ratings")
    again = old.filter("count >= 150").withColumn("isbn_rating_id", F.col("isbn_rating_id") + 1_000_000_000)
    moved = old.filter("count < 150").withColumn("book_isbn_id", F.col("book_isbn_id") + 1_000_000_000)
    rejected = constraints.check_additions({"isbn_rating": again.unionByName(moved)}, made | {"isbn_rating": old}, RUN_TS.date())
    return rejected.select("table_name", "rule", "row_id")


# Ratings of all parts against changed ones that break no rule; their ISBNs keep all columns and their parents.
VALID_RATINGS = {
    "old": "SELECT r.* FROM (" + BOOKS["isbn_rating"] + ") r WHERE book_isbn_id % 5 <> 0",
    "new": """SELECT isbn_rating_id, book_isbn_id, review_type_id,
        CAST(CASE WHEN review_type_id = 1 THEN count + 1 ELSE count END AS INT) AS count FROM ("""
           + BOOKS["isbn_rating"] + """) r WHERE NOT (review_type_id = 3 AND count < 150)""",
}


@query("a4_rating_logs_stored", with_tables(VALID_RATINGS, """
, v AS (SELECT * FROM (VALUES (1, '5_star'), (2, '4_star'), (3, '3_star'), (4, '2_star'), (5, '1_star')) AS x(id, name))
SELECT coalesce(n.isbn_rating_id, o.isbn_rating_id) AS isbn_rating_id, coalesce(n.book_isbn_id, o.book_isbn_id) AS book_isbn_id,
 id AS review_type_id, name AS review_type_name,
 CASE WHEN o.isbn_rating_id IS NULL THEN 'INSERT' WHEN n.isbn_rating_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
 coalesce(o.count, n.count) AS old_count, CASE WHEN n.isbn_rating_id IS NULL THEN 0 ELSE n.count END AS new_count,
 TIMESTAMP '2026-01-15 12:00:00' AS log_date
FROM new n FULL JOIN old o ON o.isbn_rating_id = n.isbn_rating_id JOIN v ON id = coalesce(n.review_type_id, o.review_type_id)
WHERE o.count IS DISTINCT FROM n.count""").replace("\n, v AS", ",\nv AS", 1))
def _(t):
    store = snapshot_store(t, full_tables(t) | {"isbn_rating": t.sql(VALID_RATINGS["old"])})
    snapshot.publish_snapshot(store, {"isbn_rating": t.sql(VALID_RATINGS["new"])}, RUN_TS)
    return store.read("isbn_rating_logs")


# Authors of the stored tables renamed, removed and added; none that is removed has an ISBN.
AUTHOR_CHANGES = {
    "old": BOOKS["author"].replace("FROM {supplier}", "FROM {supplier} UNION ALL SELECT 100000000 + c_custkey, c_name, TIMESTAMP '2025-06-01 00:00:00' FROM {customer}"),
    "new": BOOKS["author"].replace("concat('author ', s_suppkey % 70)", "CASE WHEN s_acctbal < 0 THEN concat('author ', s_suppkey % 70, ' jr') ELSE concat('author ', s_suppkey % 70) END")
           + " UNION ALL SELECT 200000000 + n_nationkey, n_name, TIMESTAMP '2026-01-12 00:00:00' FROM {nation}"
           + " UNION ALL SELECT 100000000 + c_custkey, c_name, TIMESTAMP '2025-06-01 00:00:00' FROM {customer} WHERE c_acctbal >= 0"}


@query("a3_author_logs_stored", with_tables(AUTHOR_CHANGES, """
SELECT coalesce(n.author_id, o.author_id) AS author_id, coalesce(n.full_name, o.full_name) AS full_name,
 CASE WHEN o.author_id IS NULL THEN 'New Author Added = ' || n.author_id WHEN n.author_id IS NULL THEN 'Author Deleted = ' || o.author_id
 ELSE 'Name updated from ' || o.full_name || ' to ' || n.full_name END AS log_message, TIMESTAMP '2026-01-15 12:00:00' AS log_date
FROM new n FULL JOIN old o ON o.author_id = n.author_id WHERE o.author_id IS NULL OR n.author_id IS NULL OR o.full_name <> n.full_name"""))
def _(t):
    store = t.stored("renamed_authors", store_of_renamed_authors)
    return store.read("author_logs")


def bridge_with_own_ids(bridge):
    """Bridge rows whose id stands once: that of the stand-in leaves room for 100,000 suppliers, here all of them have room."""
    room = max(100_000, keys.max_id(bridge, "author_id"))
    return bridge.withColumn("author_isbn_id", F.col("book_isbn_id") * F.lit(room).cast("bigint") + F.col("author_id") - 1)


def store_of_renamed_authors(t) -> TableStore:
    # Bridges whose id stands once, and roles that are there.
    bridge = bridge_with_own_ids(books(t)["author_isbn"]).withColumn("role_id", F.lit(None).cast("bigint"))
    store = snapshot_store(t, full_tables(t) | {"author": t.sql(AUTHOR_CHANGES["old"]), "author_isbn": bridge})
    snapshot.publish_snapshot(store, {"author": t.sql(AUTHOR_CHANGES["new"])}, RUN_TS)
    return store


@query("a1_author_snapshot_stored", with_tables(AUTHOR_CHANGES, """
SELECT n.author_id, n.full_name, CASE WHEN o.author_id IS NULL THEN n.updated_at WHEN o.full_name = n.full_name THEN o.updated_at
 ELSE TIMESTAMP '2026-01-15 12:00:00' END AS updated_at FROM new n LEFT JOIN old o ON o.author_id = n.author_id"""))
def _(t):
    return t.stored("renamed_authors", store_of_renamed_authors).read("author")


# Deletes in stored tables: the largest books, some publishers, roles and the authors of one balance sign

def row_refs(table: str) -> list[str]:
    return {"book_isbn": ["book_id", "format_id", "edition_id", "publisher_id", "language_id", "series_id"],
            "author_isbn": ["book_isbn_id", "author_id", "role_id"], "isbn_rating": ["book_isbn_id", "review_type_id"],
            "book_isbn_genre": ["book_isbn_id", "genre_id"]}.get(table, [])


def refs_sql(table: str, source: str) -> str:
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in row_refs(table)) or "''"
    return f"SELECT '{table}' AS table_name, {table}_id AS row_id, concat_ws('|', {cells}) AS refs FROM {source}"


def all_refs(read, names) -> object:
    rows = None
    for name in names:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in row_refs(name)] or [F.lit("")]
        part = read(name).select(F.lit(name).alias("table_name"), F.col(f"{name}_id").cast("long").alias("row_id"), F.concat_ws("|", *cells).alias("refs"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


GONE = {"book": "SELECT p_partkey AS book_id FROM {part} WHERE p_size = 5", "publisher": "SELECT CAST(substring(p_brand, 7) AS BIGINT) AS publisher_id FROM {part} WHERE p_size = 7 AND p_retailprice < 1000",
        "role": "SELECT CAST(r_regionkey AS BIGINT) AS role_id FROM {region} WHERE r_name = 'ASIA'", "author": "SELECT s_suppkey + 1 AS author_id FROM {supplier} WHERE s_acctbal < 0",
        "genre": "SELECT CAST(n_nationkey AS BIGINT) AS genre_id FROM {nation} WHERE n_regionkey = 0"}
LEFT_AFTER = {
    **{f"gone_{name}": text for name, text in GONE.items()},
    "left_book_isbn": """SELECT book_isbn_id, book_id, format_id, edition_id, language_id, series_id,
        CASE WHEN publisher_id IN (SELECT publisher_id FROM gone_publisher) THEN NULL ELSE publisher_id END AS publisher_id
        FROM book_isbn WHERE book_id NOT IN (SELECT book_id FROM gone_book WHERE book_id IN (SELECT book_id FROM book))""",
    "gone_isbn": "SELECT book_isbn_id FROM book_isbn WHERE book_isbn_id NOT IN (SELECT book_isbn_id FROM left_book_isbn)",
    "left_author_isbn": """SELECT author_isbn_id, book_isbn_id, author_id,
        CASE WHEN role_id IN (SELECT role_id FROM gone_role) THEN NULL ELSE role_id END AS role_id FROM author_isbn
        WHERE book_isbn_id NOT IN (SELECT book_isbn_id FROM gone_isbn) AND author_id NOT IN (SELECT author_id FROM gone_author)""",
    "left_isbn_rating": "SELECT * FROM isbn_rating WHERE book_isbn_id NOT IN (SELECT book_isbn_id FROM gone_isbn)",
    "left_book_isbn_genre": """SELECT * FROM book_isbn_genre WHERE book_isbn_id NOT IN (SELECT book_isbn_id FROM gone_isbn)
        AND genre_id NOT IN (SELECT genre_id FROM gone_genre)""",
    **{f"left_{name}": f"SELECT * FROM {name} WHERE {name}_id NOT IN (SELECT {name}_id FROM gone_{name})" for name in GONE}}


def store_after_deletes(t) -> TableStore:
    store = snapshot_store(t, full_tables(t))
    deletions.delete_rows(store, {name: t.sql(text) for name, text in GONE.items()}, RUN_TS)
    return store


@query("v8_stored_delete", with_tables({**FULL, **LEFT_AFTER}, " UNION ALL ".join(
    refs_sql(name, f"left_{name}" if f"left_{name}" in LEFT_AFTER else name) for name in FULL)))
def _(t):
    return all_refs(t.stored("after_deletes", store_after_deletes).read, FULL)


@query("v8_stored_delete_logs", with_tables({**FULL, **LEFT_AFTER}, """
SELECT 'book' AS name, book_id AS row_id, title AS said, 'Book Deleted = ' || book_id AS message FROM book WHERE book_id IN (SELECT book_id FROM gone_book)
UNION ALL SELECT 'author', author_id, full_name, 'Author Deleted = ' || author_id FROM author WHERE author_id IN (SELECT author_id FROM gone_author)
UNION ALL SELECT 'isbn_rating', isbn_rating_id, review_type, 'DELETE ' || count || ' to 0' FROM isbn_rating JOIN review_type USING (review_type_id)
 WHERE book_isbn_id IN (SELECT book_isbn_id FROM gone_isbn)"""))
def _(t):
    store = t.stored("after_deletes", store_after_deletes)
    return (store.read("book_logs").select(F.lit("book").alias("name"), F.col("book_id").alias("row_id"), F.col("title").alias("said"), F.col("log_message").alias("message"))
            .unionByName(store.read("author_logs").select(F.lit("author").alias("name"), F.col("author_id").alias("row_id"), F.col("full_name").alias("said"),
                                                          F.col("log_message").alias("message")))
            .unionByName(store.read("isbn_rating_logs").select(
                F.lit("isbn_rating").alias("name"), F.col("isbn_rating_id").alias("row_id"), F.col("review_type_name").alias("said"),
                F.concat("operation_type", F.lit(" "), "old_count", F.lit(" to "), "new_count").alias("message"))))


# A second catalogue that holds the first one: rows up to half the highest position are loaded first, then all, with book numbers of its own.

EARLY = "SELECT *, _src_pos * 2 <= max(_src_pos) OVER () AS early FROM ({s})"


def numbered_twice(source: str, value: str, id_col: str, where: str, pos: str) -> str:
    """Ids by first appearance in the first load, then of what only the second one has."""
    first = f"min(seen) FILTER ({pos} * 2 <= (SELECT max(_src_pos) FROM staging))"
    return (f"SELECT row_number() OVER (ORDER BY {first} IS NULL, coalesce({first}, min(seen))) AS {id_col}, {value} FROM ({source}) "
            f"WHERE {where} GROUP BY {value}")


def lookup_twice(col: str, value: str, id_col: str, null_too: bool = False) -> str:
    where = f"trim({value}) <> ''" + (f" OR {value} IS NULL" if null_too else "")
    return numbered_twice(f'SELECT "{col}" AS {value}, _src_pos AS seen FROM s', value, id_col, where, "seen")


FIRST_NAME = "coalesce(" + ", ".join(f"nullif({c}, '')" for c in AUTHORS) + ")"
TWICE = {
    "staging": TABLES["staging"], "s": TABLES["s"] + "", "e": EARLY.format(s="SELECT * FROM s"),
    "author": numbered_twice(union_slots(AUTHORS, "full_name"), "full_name", "author_id", "full_name <> ''", "(seen // 64)"),
    "role": numbered_twice(union_slots([f"author_{i}_role" for i in range(1, 6)], "role"), "role", "role_id", "role IS NOT NULL", "(seen // 64)"),
    "genre": numbered_twice(GENRE_SLOTS, "genre", "genre_id", "genre IS NOT NULL", "(seen // 64)"),
    "language": lookup_twice("language", "language", "language_id", null_too=True),
    "publisher": lookup_twice("publisher_norm", "publisher", "publisher_id"),
    "edition": lookup_twice("edition_norm", "edition", "edition_id"),
    "format": lookup_twice("bookFormat_norm", "format", "format_id"),
    "series": lookup_twice("series_name_norm", "series_name", "series_id"),
    "named": f"""SELECT DISTINCT first_title AS title, {FIRST_NAME} AS name, book_uid AS book_id
        FROM (SELECT *, first_value(title_norm) OVER (PARTITION BY book_uid ORDER BY _src_pos) AS first_title FROM e WHERE early) WHERE isbn10 IS NOT NULL OR isbn13 IS NOT NULL""",
    "uids": "SELECT book_uid, bool_or(early) AS there, min(_src_pos) AS first FROM e GROUP BY 1",
    "by_name": """SELECT u.book_uid, min(n.book_id) AS book_id FROM uids u JOIN e ON e.book_uid = u.book_uid
        JOIN named n ON n.title IS NOT DISTINCT FROM e.title_norm AND n.name IS NOT DISTINCT FROM nullif(trim(e.primary_author_name), '') WHERE NOT there GROUP BY 1""",
    "ids": """SELECT book_uid, book_uid AS book_id FROM uids WHERE there UNION ALL SELECT * FROM by_name
        UNION ALL SELECT book_uid, (SELECT max(book_uid) FROM uids WHERE there) + row_number() OVER (ORDER BY first)
        FROM uids WHERE NOT there AND book_uid NOT IN (SELECT book_uid FROM by_name)""",
    "book": """SELECT book_uid AS book_id, arg_min(title_norm, _src_pos) AS title FROM e WHERE early GROUP BY 1
        UNION ALL SELECT book_id, arg_min(title_norm, _src_pos) FROM e JOIN ids USING (book_uid)
        WHERE book_id NOT IN (SELECT book_uid FROM uids WHERE there) GROUP BY 1""",
    "book_isbn": """SELECT row_number() OVER (ORDER BY NOT early, _src_pos) AS book_isbn_id, _src_pos, early, isbn10, isbn13, book_id, format_id, edition_id,
        publisher_id, language_id, series_id FROM e JOIN ids USING (book_uid) LEFT JOIN format ON format = "bookFormat_norm" LEFT JOIN edition ON edition = edition_norm
        LEFT JOIN publisher ON publisher = publisher_norm LEFT JOIN language USING (language) LEFT JOIN series ON series_name = series_name_norm
        WHERE isbn10 IS NOT NULL OR isbn13 IS NOT NULL""",
    "people": f"""SELECT book_isbn_id, author_id, role_id, min(slot) AS slot, any_value(early) AS early FROM (
        {" UNION ALL ".join(f"SELECT _src_pos, {c} AS full_name, author_{i}_role AS role, {i} AS slot FROM s" for i, c in enumerate(AUTHORS, 1))})
        JOIN book_isbn USING (_src_pos) JOIN author USING (full_name) LEFT JOIN role USING (role)
        GROUP BY book_isbn_id, author_id, role_id, CASE WHEN role_id IS NULL THEN slot END""",
    "author_isbn": """SELECT row_number() OVER (ORDER BY NOT early, slot, book_isbn_id, author_id, role_id) AS author_isbn_id,
        book_isbn_id, author_id, role_id FROM people""",
    "isbn_rating": "SELECT row_number() OVER (ORDER BY NOT early, review_type_id, book_isbn_id) AS isbn_rating_id, book_isbn_id, review_type_id FROM ("
                   + " UNION ALL ".join(f'SELECT _src_pos, {i} AS review_type_id FROM s WHERE "{6 - i}_star" IS NOT NULL' for i in range(1, 6))
                   + ") JOIN book_isbn USING (_src_pos)",
    "book_isbn_genre": f"""SELECT row_number() OVER (ORDER BY NOT early, slot, book_isbn_id, genre_id) AS book_isbn_genre_id, book_isbn_id, genre_id FROM (
        SELECT book_isbn_id, genre_id, min(slot) AS slot, any_value(early) AS early FROM ({GENRE_SLOTS}) g JOIN book_isbn USING (_src_pos) JOIN genre USING (genre)
        GROUP BY 1, 2)"""}
VALUES = {"author": "full_name", "series": "series_name", "book": "title", **{n: n for n in ("role", "genre", "language", "publisher", "edition", "format")}}


def store_of_two_loads(t) -> TableStore:
    rows = staging(t)
    half = rows.agg(F.max("_src_pos")).first()[0]
    store = snapshot_store(t, normalise.normalise(rows.filter(F.col("_src_pos") * 2 <= half), RUN_TS))
    again = rows.withColumn("book_uid", F.lit(10**9) - F.col("book_uid"))
    additions.add_catalogue(store, again, RUN_TS + dt.timedelta(days=1))
    return store


@query("n_second_load", with_tables({n: v if n == "staging" else v.replace("{", "{{").replace("}", "}}") for n, v in TWICE.items()}, " UNION ALL ".join(
    [f"SELECT '{name}' AS table_name, {name}_id AS row_id, {value} AS refs FROM {name}" for name, value in VALUES.items()]
    + [refs_sql(name, name) for name in ("book_isbn", "author_isbn", "isbn_rating", "book_isbn_genre")])))
def _(t):
    store = t.stored("two_loads", store_of_two_loads)
    values = [store.read(name).select(F.lit(name).alias("table_name"), F.col(f"{name}_id").cast("long").alias("row_id"), F.col(value).alias("refs"))
              for name, value in VALUES.items()]
    rows = all_refs(store.read, ("book_isbn", "author_isbn", "isbn_rating", "book_isbn_genre"))
    for part in values:
        rows = rows.unionByName(part)
    return rows


@query("r20_latest_log_rows", entity_log_sql("book_id", "title", "New Book Added = ", "Book Deleted = ", "Book Updated from ")
       + " ORDER BY book_id LIMIT 10")
def _(t):
    from shelfmark.plans.reports import latest_log_rows
    return latest_log_rows(stored_book_logs(t).read("book_logs"), 10, "book_id")
