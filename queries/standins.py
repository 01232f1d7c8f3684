"""A raw catalogue made from the driver tables, one book per order.

The original files are not at hand. Each order becomes one raw row whose texts
come from its part, its customer key and its date, in every form the cleaning
rules know; the same SQL text runs in both engines.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame

from queries.registry import Inputs
from shelfmark.operators.settle import settle

MONTH_NAME = ("CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March'"
              " WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August'"
              " WHEN 9 THEN 'September' WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END")

# Rows whose order key is a multiple of five share an ISBN in groups of eight.
ISBN_BASE = "(o_orderkey - CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 40 ELSE 0 END)"


def picked(by: str, options: list[str]) -> str:
    """One option per row, by the remainder of a key; options are SQL."""
    whens = " ".join(f"WHEN {i} THEN {option}" for i, option in enumerate(options))
    return f"CASE {by} % {len(options)} {whens} END"


def quoted(values: list[str | None]) -> list[str]:
    return ["CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'" for v in values]


DATE_TEXTS = [
    f"concat({MONTH_NAME}, ' ', day(o_orderdate), 'th ', year(o_orderdate))",
    "concat(lpad(concat('', month(o_orderdate)), 2, '0'), '/', lpad(concat('', day(o_orderdate)), 2, '0'), '/',"
    " lpad(concat('', (o_orderkey % 100)), 2, '0'))",
    "concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))",
    f"concat(day(o_orderdate), ' ', substring({MONTH_NAME}, 1, 3), ' ', year(o_orderdate))",
    "concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate))",
    f"concat({MONTH_NAME}, ' ', year(o_orderdate))",
    "concat('', 900 + o_custkey % 1300)",
    "concat('2/30/', year(o_orderdate))",
    "concat('printed about ', year(o_orderdate), ' or so')",
    "'unknown'",
    "CAST(NULL AS STRING)",
]

PUBLISHERS = [
    "concat('Penguin ', p_type, ' House')", "concat('Pan Macmillan ', p_name)", "concat(p_name, ' Harper Collins Ltd.')",
    "concat(p_type, ' National ', p_name)", "concat('CreateSpace ', p_name)", "concat('W.W. ', p_name, ' & Co.')",
    "'Tor.com'", "concat(p_name, ' Publishers, Inc.')", "concat('Little,  Brown ', p_type)", "'N/A'", "'none'",
    "CAST(NULL AS STRING)", "concat(p_name, ' (UK)')", "concat('Éditions ', p_name)", "concat(p_name, ' Pub. - UK')",
    "concat('St. Martin''s ', p_type)", "concat('Grove ', p_name, ' Atlantic')", "'   '", "concat(p_name, ' not avail')",
    "concat('Night  Shade ', p_name)", "concat(p_name, '  USA')", "concat('Random House ', p_name)",
]

RAW_BOOKS = f"""
SELECT o_orderkey AS _src_pos,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL
       ELSE concat('B', o_orderkey - CASE WHEN o_orderkey % 11 = 1 THEN 1 ELSE 0 END) END AS bookId,
  {picked("o_orderkey", ["concat(upper(p_name), '  ')", "concat(' The  ', p_name)", "concat(p_name, ' café')", "''",
    "CAST(NULL AS STRING)", "p_name", "concat(p_name, ' vol ', o_custkey % 7)", "upper(p_name)", "concat(p_name, ' ')"])} AS title,
  {picked("o_custkey", ["CAST(NULL AS STRING)", "''", "p_brand", "concat(p_name, ' #', o_orderkey % 5)",
    "concat(p_name, ' #1.5')", "concat(upper(p_name), ' #1-', o_orderkey % 9)", "concat(p_name, ' # 1 - 3')", "p_name"])} AS series,
  {picked("o_orderkey", [
    "concat(substring(p_type, 1, 1), '. ', p_name, ' & John ', p_type)",
    "concat('J.K. ', p_name, ' (Goodreads Author), Ana ', p_type, ' (Translator)')",
    "concat(p_name, ' (Editor and Translator); Bob Poe (Cover Art)')",
    "concat('José ', p_type, ', ana (trans), cy (ilustrador)')",
    "CAST(NULL AS STRING)",
    "concat(p_name, ' and ', p_type, ' (illustrations), Zed (Author/Illustrator)')",
    "concat(p_name, ', #1, ), Ann  Lee (chief editor)')",
    "concat('a b, c d (poet), e f (reader), g h (ed.), i j (music), k l, ', p_name)",
    "''", "p_name", "upper(p_name)", "concat(p_name, ' (röle)')", "concat(p_type, ' ', p_name, ' Jr.')"])} AS author,
  {picked("o_orderkey", ["concat('  ', p_name, chr(10), chr(10), p_type, chr(9), ' x ')", "' '", "CAST(NULL AS STRING)",
    "concat(p_name, chr(160), p_type)"])} AS description,
  {picked("o_orderkey", quoted(["English"] * 8 + ["French", None]))} AS language,
  {picked("o_custkey", [f"concat('978-', lpad(concat('', {ISBN_BASE}), 10, '0'))",
    f"concat('978 ', lpad(concat('', {ISBN_BASE}), 10, '0'))", f"concat('979', lpad(concat('', {ISBN_BASE}), 10, '0'))",
    f"concat(lpad(concat('', {ISBN_BASE}), 9, '0'), 'x')", f"concat(' ', lpad(concat('', {ISBN_BASE}), 10, '0'))",
    "'999-9999999999'", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(NULL AS STRING) ELSE '12345' END"])} AS isbn,
  {picked("o_orderkey", quoted(["['Young Adult', 'Fantasy', 'Fiction', '21st Century']", "['Alternate History', 'Novels']",
    "[\"Women's Fiction\", 'Time Travel', 'Martial Arts']", "['own', 'unfinished']", "[]", None,
    "['Historical Romance', 'M M Romance', 'Gay', 'Cozy Mystery', 'Spy Thriller', 'Gothic Horror']",
    "['Naval Historical Fiction', 'Ya Contemporary', 'Kids', 'Memoir', 'American History', 'Tea']",
    "['Sci Fi Fantasy', 'Military Science Fiction', 'Science', 'Christian', 'Food', 'Noir', 'Humor', 'Poems', 'Comics',"
    " 'Dystopian', 'Western', 'Tea']"]))} AS genres,
  {picked("o_orderkey", quoted(["Kindle Edition", "Mass Market Paperback", "Hardcover Boxed Set", "Broché", "Paper",
    "Foo", None, "mass_market", "E-Book", "Audio CD", "Board book", "School & Library Binding", " Leather  Bound",
    "Spiral-bound", "Graphic Novels", "Pamphlet", "Unbound"]))} AS bookFormat,
  {picked("o_orderkey", ["concat(1 + o_custkey % 12, 'th Edition')", "'1st Edition'", "'2nd ed.'", "'3rd edtion'",
    "'Unabridged'", "'25th Aniversary ed '", "'Revised Edition'", "'original'", "'ISBN 01'", "CAST(NULL AS STRING)", "''",
    "concat(p_name, ' movie tie-in')", "'Kindle'", "'Collector''s'", "'Large Print'", "'e-audio'", "'Boxed'",
    "'Illustrated Classics'", "'Penguin Classics'", "'http://x'"])} AS edition,
  {picked("o_orderkey", ["concat('', o_custkey)", "concat('1,', o_custkey, ' pages')", "'unknown'",
    "CAST(NULL AS STRING)"])} AS pages,
  {picked("o_orderkey", PUBLISHERS)} AS publisher,
  {picked("o_orderkey", DATE_TEXTS)} AS publishDate,
  {picked("o_custkey", DATE_TEXTS)} AS firstPublishDate,
  concat('', o_custkey * 3) AS numRatings,
  {picked("o_orderkey", ["concat('[''', o_custkey, ''',''', o_orderkey % 50, ''',''3'',''1'',''0'']')",
    "concat('[''', o_custkey, ''', ''5'']')", "'[]'", "'[''x'',''1'',''1'',''1'',''1'']'",
    "CAST(NULL AS STRING)"])} AS ratingsByStars
FROM {{orders}} JOIN {{part}} ON p_partkey = o_custkey
"""


def stored_standin(inputs: Inputs, name: str, text: str, key: str | None = None):
    """A stand-in as a table in several files, which is what a job would read.

    Rows that a join or a grouping has just shuffled are written as they come, those
    of a mere scan are dealt out by a ``key``.
    """
    def write(t: Inputs):
        files, rows = t.spark.sparkContext.defaultParallelism, t.sql(text)
        return settle(rows if key is None else rows.repartition(files, key), name)
    return inputs.stored(name, write)


def from_orders(inputs: Inputs, name: str, text: str):
    """A stand-in of one row per order; the orders are dealt out before their texts are made, which are much wider."""
    def write(t: Inputs):
        dealt = t.orders.repartition(t.spark.sparkContext.defaultParallelism, "o_orderkey")
        return settle(t.spark.sql(text, orders=dealt, part=t.part), name)
    return inputs.stored(name, write)


def raw_books(inputs: Inputs):
    return from_orders(inputs, "raw_books", RAW_BOOKS)


# A staging table, one row per order, with ISBNs of either kind, up to five
# contributors, roles, genres and star counts.
STAGING = f"""
SELECT o_orderkey AS _src_pos,
  CASE WHEN o_orderkey % 3 = 0 THEN lpad(concat('', o_orderkey), 10, '0') END AS isbn10,
  CASE WHEN o_orderkey % 3 <> 0 THEN concat('978', lpad(concat('', o_orderkey), 10, '0')) END AS isbn13,
  o_custkey + 1 AS book_uid,
  concat(p_name, ' ', o_custkey % 50) AS title_norm,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat(p_name, ' ', p_type, ' ', o_custkey % 20) END AS primary_author_name,
  CASE WHEN o_orderkey % 2 = 0 THEN concat(p_name, ' jr') END AS author_2,
  CASE WHEN o_orderkey % 4 = 0 THEN concat(p_name, ' ', p_type, ' ', o_custkey % 20) END AS author_3,
  CASE WHEN o_orderkey % 8 = 0 THEN 'unknown' END AS author_4,
  CASE WHEN o_orderkey % 16 = 0 THEN '' END AS author_5,
  {picked("o_orderkey", quoted([None, "editor", None, "poet", None]))} AS author_1_role,
  {picked("o_orderkey", quoted(["illustrator", None, " "]))} AS author_2_role,
  {picked("o_orderkey", quoted([None, "editor", "translator", None]))} AS author_3_role,
  CAST(NULL AS STRING) AS author_4_role, CAST(NULL AS STRING) AS author_5_role,
  {picked("o_orderkey", quoted(["English", "English", "English", None]))} AS language,
  {picked("o_custkey", ["'unknown'", "concat(p_brand, ' press')", "''", "'self-published'", "CAST(NULL AS STRING)"])} AS publisher_norm,
  {picked("o_orderkey", quoted(["First Edition", None, " ", "Other"]))} AS edition_norm,
  {picked("o_orderkey", quoted(["hardcover", "ebook", "unknown", "paperback", "audio"]))} AS `bookFormat_norm`,
  {picked("o_custkey", ["concat(p_brand, ' saga')", "''", "CAST(NULL AS STRING)", "concat(p_name, ' cycle')"])} AS series_name_norm,
  CAST(o_orderkey % 9 AS DECIMAL(10,2)) AS series_num,
  CAST(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS is_boxset,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS `publishDate_norm`,
  CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS `firstPublishDate_norm`,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 100 + o_custkey END AS INT) AS pages_norm,
  'a description' AS description_norm,
  split({picked("o_orderkey", ["concat(p_name, '|', p_type)", "concat('children''s|', p_name)", "'a|b, c|d|e|f|g|h|i|j|k|l'",
    "'uncategorized'", "concat(p_type, '|', p_type, 's|', p_name)"])}, '[|]') AS genres_norm,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS `5_star`,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 100 END AS `4_star`,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 50 END AS `3_star`,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 10 END AS `2_star`,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 5 END AS `1_star`
FROM {{orders}} JOIN {{part}} ON p_partkey = o_custkey
"""


def staging(inputs: Inputs):
    return from_orders(inputs, "staging", STAGING)


def for_duckdb(text: str) -> str:
    """The two spellings that differ: quoted names, and the split pattern."""
    return text.replace("`", '"').replace("'[|]'", "'|'")


# Normalised tables straight from the driver tables: parts are ISBNs, suppliers
# are authors, order lines give the bridges, the star counts and the sales.
BOOKS = {
    "author": """SELECT s_suppkey + 1 AS author_id, concat('author ', s_suppkey % 70) AS full_name,
        CASE WHEN s_suppkey % 5 = 0 THEN TIMESTAMP '2026-01-10 00:00:00' ELSE TIMESTAMP '2025-06-01 00:00:00' END AS updated_at
        FROM {supplier}""",
    "publisher": """SELECT DISTINCT CAST(substring(p_brand, 7) AS BIGINT) AS publisher_id, concat('house ', lower(p_brand)) AS publisher
        FROM {part}""",
    "format": """SELECT DISTINCT CAST(p_size % 7 AS BIGINT) AS format_id, CASE p_size % 7 WHEN 0 THEN 'hardcover' WHEN 1 THEN 'ebook'
        WHEN 2 THEN 'audio' WHEN 3 THEN 'board_book' WHEN 4 THEN 'paperback' WHEN 5 THEN 'comic' ELSE 'unknown' END AS format
        FROM {part}""",
    "language": "SELECT CAST(r_regionkey AS BIGINT) AS language_id, concat('language ', r_regionkey) AS language FROM {region}",
    "series": "SELECT CAST(n_nationkey AS BIGINT) AS series_id, concat('series ', n_name) AS series_name FROM {nation}",
    "book": "SELECT p_partkey AS book_id, concat(p_name, ' ', p_partkey % 40) AS title FROM {part}",
    "book_isbn": """SELECT p_partkey + 1 AS book_isbn_id,
        CASE WHEN p_partkey % 11 = 0 THEN lpad(concat('', p_partkey), 10, '0') END AS isbn10,
        CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE concat('978', lpad(concat('', p_partkey), 10, '0')) END AS isbn13,
        p_partkey - p_partkey % 2 AS book_id, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size % 7 AS BIGINT) END AS format_id,
        CAST(NULL AS BIGINT) AS edition_id,
        CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(substring(p_brand, 7) AS BIGINT) END AS publisher_id,
        p_partkey % 5 AS language_id, p_partkey % 10 = 0 AS is_boxset,
        CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 25 END AS series_id,
        CAST(p_size AS DECIMAL(10,2)) AS series_num,
        CASE WHEN p_partkey % 6 = 0 THEN TIMESTAMP '2026-01-10 00:00:00' ELSE TIMESTAMP '2025-06-01 00:00:00' END AS updated_at
        FROM {part}""",
    "author_isbn": """SELECT DISTINCT (l_partkey + 1) * 100000 + l_suppkey AS author_isbn_id, l_partkey + 1 AS book_isbn_id,
        l_suppkey + 1 AS author_id, CASE WHEN l_suppkey % 3 = 0 THEN CAST(NULL AS BIGINT) ELSE l_suppkey % 4 END AS role_id
        FROM {lineitem}""",
    "role": "SELECT CAST(r_regionkey AS BIGINT) AS role_id, concat('role ', r_regionkey) AS role FROM {region}",
    "isbn_rating": """SELECT (l_partkey + 1) * 10 + l_linenumber % 5 AS isbn_rating_id, l_partkey + 1 AS book_isbn_id,
        CAST(1 + l_linenumber % 5 AS BIGINT) AS review_type_id, CAST(sum(CAST(l_quantity AS INT)) AS INT) AS count
        FROM {lineitem} GROUP BY l_partkey, l_linenumber % 5""",
    "genre": "SELECT CAST(n_nationkey AS BIGINT) AS genre_id, concat('genre ', n_nationkey) AS genre FROM {nation}",
    "book_isbn_genre": """SELECT DISTINCT (l_partkey + 1) * 100 + l_linenumber AS book_isbn_genre_id, l_partkey + 1 AS book_isbn_id,
        CAST(l_linenumber AS BIGINT) AS genre_id FROM {lineitem}""",
}

MONTH_ABBR = MONTH_NAME.replace("o_orderdate", "d")

# Raw monthly sales as text: one row per part and month of its order lines,
# some of ISBNs nobody knows.
RAW_SALES = f"""
SELECT CASE WHEN k % 17 = 0 THEN concat('999', lpad(concat('', k), 10, '0')) ELSE concat('978', lpad(concat('', k), 10, '0')) END AS isbn13,
  concat(' ', substring({MONTH_ABBR}, 1, 3), ' ') AS month, concat('', year(d)) AS year,
  concat('', q) AS in_person_sales, concat('', n) AS online_sales, concat('', 2 * n) AS wholesale_sales,
  concat('', q + 3 * n) AS total_sales, concat(' $', n, '.50') AS average_price,
  concat('$', 1 + n, ',', lpad(concat('', q % 1000), 3, '0'), '.25') AS total_revenue,
  concat('', n % 3) AS count_returns, concat('', q + 3 * n - n % 3) AS net_sales
FROM (SELECT l_partkey AS k, CAST(min(l_shipdate) AS DATE) AS d, CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n
      FROM {{lineitem}} GROUP BY l_partkey, year(l_shipdate), month(l_shipdate)) AS per_month
"""


class Made(Mapping):
    """Tables by name, each made when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self.makers, self.made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.makers[name]()
        return self.made[name]

    def __contains__(self, name: object) -> bool:
        return name in self.makers

    def __iter__(self):
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


#: Columns of the order lines that tell the rows of these tables apart.
TOLD_BY = {"author_isbn": ["l_partkey", "l_suppkey"], "book_isbn_genre": ["l_partkey", "l_linenumber"]}
#: Grouped from the order lines, so shuffled already.
GROUPED = (*TOLD_BY, "isbn_rating")


def from_lines(inputs: Inputs, name: str):
    """A stand-in of distinct rows; the keys of the order lines are made distinct, the wider rows are made of these."""
    def write(t: Inputs):
        lines = t.lineitem.select(*TOLD_BY[name]).distinct()
        return settle(t.spark.sql(BOOKS[name].replace("SELECT DISTINCT", "SELECT"), lineitem=lines), name)
    return inputs.stored(name, write)


def books(inputs: Inputs) -> Mapping[str, DataFrame]:
    """The normalised tables, as stand-ins."""
    return Made({name: partial(from_lines, inputs, name) if name in TOLD_BY else
                 partial(stored_standin, inputs, name, text, None if name in GROUPED else f"{name}_id")
                 for name, text in BOOKS.items()})


def raw_sales(inputs: Inputs):
    return stored_standin(inputs, "raw_sales", RAW_SALES)
