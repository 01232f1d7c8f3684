"""Catalogue cleaning over the stand-in catalogue and the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import duck
from queries.registry import query, with_tables
from queries.standins import RAW_BOOKS, raw_books
from shelfmark.functions import dates, editions, formats, genres, isbn, names, numbers, publishers, roles, series, text
from shelfmark.functions.numbers import STARS
from shelfmark.operators import dedup, filters, keys
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import cleaning, reports
from shelfmark.schemas import CATALOGUE_COLUMNS, DROPPED_CATALOGUE_COLUMNS
from shelfmark.sources import files

AS_OF_YEAR = 2026
RAW = {"raw": RAW_BOOKS}


def over_raw(columns: dict[str, str], where: str = "true") -> str:
    listed = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return with_tables(RAW, f"SELECT _src_pos, {listed} FROM raw WHERE {where}")


# Filters

@query("f1_english_only", over_raw({"bookId": "bookId"}, "language = 'English'"))
def _(t):
    return filters.english_only(raw_books(t)).select("_src_pos", "bookId")


@query("f2_ascii_titles", over_raw({"title": "title"}, "title <> '' AND " + duck.ascii_only("title")))
def _(t):
    return filters.ascii_titles(raw_books(t)).select("_src_pos", "title")


@query("f2_ascii_documents", f"SELECT doc_id, n_chars FROM documents WHERE text <> '' AND {duck.ascii_only('text')}")
def _(t):
    return filters.ascii_titles(t.documents, "text").select("doc_id", "n_chars")


@query("f3_latin_publishers", over_raw({"publisher": "publisher"}, duck.latin("publisher")))
def _(t):
    return filters.latin_publishers(raw_books(t)).select("_src_pos", "publisher")


def with_isbns(df):
    isbn10, isbn13 = isbn.split_isbn(F.col("isbn"))
    return df.withColumns({"isbn10": isbn10, "isbn13": isbn13})


ISBNS = {"isbn10": duck.isbn("isbn", 10), "isbn13": duck.isbn("isbn", 13)}


@query("f4_drop_fake_isbn13", over_raw(ISBNS, f"{duck.isbn('isbn', 13)} IS DISTINCT FROM '9999999999999'"))
def _(t):
    return filters.drop_fake_isbn13(with_isbns(raw_books(t))).select("_src_pos", "isbn10", "isbn13")


@query("f5_require_isbn", over_raw(ISBNS, f"{ISBNS['isbn10']} IS NOT NULL OR {ISBNS['isbn13']} IS NOT NULL"))
def _(t):
    return filters.require_isbn(with_isbns(raw_books(t))).select("_src_pos", "isbn10", "isbn13")


@query("f6_books_of_author", over_raw({"author": "author"}, "coalesce(regexp_matches(author, 'J.K. '), false)"))
def _(t):
    return reports.books_of(raw_books(t), "author", "J.K. ").select("_src_pos", "author")


JUNK = {f"author_{i}": duck.no_junk(duck.contributor("author", i, "name")) for i in range(2, 6)}


@query("f11_clear_junk_contributors", over_raw(JUNK))
def _(t):
    split = roles.contributor_columns(raw_books(t), "author")
    return split.select("_src_pos", *[roles.clear_junk(F.col(c)).alias(c) for c in JUNK])


# Columns

@query("c1_normalize_text", f"SELECT doc_id, {duck.normalize_text('text')} AS text_norm FROM documents")
def _(t):
    return t.documents.select("doc_id", text.normalize_text(F.col("text")).alias("text_norm"))


@query("c1_normalize_title", over_raw({"title_norm": duck.normalize_text("title")}))
def _(t):
    return raw_books(t).select("_src_pos", text.normalize_text(F.col("title")).alias("title_norm"))


@query("c2_normalize_author_text", over_raw({"author_text": duck.author_text("author")}))
def _(t):
    return raw_books(t).select("_src_pos", names.normalize_author_text(F.col("author")).alias("author_text"))


AUTHOR_CTES = {
    **RAW,
    "a1": f"SELECT raw.* REPLACE ({duck.author_text('author')} AS author) FROM raw",
    "a2": f"SELECT *, {duck.author_norm('author')} AS author_norm FROM a1",
    "a3": f"SELECT *, {duck.primary_author('author_norm')} AS primary_author,"
          f" {duck.author_roles('author_norm')} AS author_roles_norm FROM a2",
}


def unbraced(ctes: dict[str, str]) -> dict[str, str]:
    """Double the braces of regex counts in all but the stand-in, which names tables in braces."""
    return {k: v if k == "raw" else v.replace("{", "{{").replace("}", "}}") for k, v in ctes.items()}


@query("c3_normalize_author", with_tables(unbraced(AUTHOR_CTES), f"""
SELECT _src_pos, author_norm, primary_author, {duck.primary_name('primary_author')} AS primary_author_name FROM a3"""))
def _(t):
    return cleaning.clean_authors(raw_books(t)).select(
        "_src_pos", "author_norm", "primary_author", "primary_author_name")


@query("c4_normalize_author_roles", with_tables(unbraced(AUTHOR_CTES), "SELECT _src_pos, author_roles_norm FROM a3"))
def _(t):
    return cleaning.clean_authors(raw_books(t)).select("_src_pos", "author_roles_norm")


CONTRIBUTORS = ({f"author_{i}": duck.contributor("author_roles_norm", i, "name") for i in range(2, 6)}
                | {f"author_{i}_role": duck.contributor("author_roles_norm", i, "role") for i in range(1, 6)})


@query("c5_contributor_columns", with_tables(unbraced(AUTHOR_CTES), "SELECT _src_pos, " + ", ".join(
    f"{e} AS {c}" for c, e in CONTRIBUTORS.items()) + " FROM a3"))
def _(t):
    norm = names.author_norm(names.normalize_author_text(F.col("author")))
    return (raw_books(t).withColumn("author_norm", norm)
            .withColumn("author_roles_norm", roles.normalize_author_roles(F.col("author_norm")))
            .transform(roles.contributor_columns).select("_src_pos", *CONTRIBUTORS))


@query("c6_parse_series", over_raw({"series_name": duck.series_name("series"), "series_num": duck.series_num("series")}))
def _(t):
    name, number = series.parse_series(F.col("series"))
    return raw_books(t).select("_src_pos", name.alias("series_name"), number.alias("series_num"))


@query("c6_parse_customer_name", f"SELECT c_custkey, {duck.series_name('c_name')} AS series_name, "
       f"{duck.series_num('c_name')} AS series_num FROM customer")
def _(t):
    name, number = series.parse_series(F.col("c_name"))
    return t.customer.select("c_custkey", name.alias("series_name"), number.alias("series_num"))


@query("c7_is_part_of_series", over_raw({"is_series": f"{duck.series_name('series')} <> ''"}))
def _(t):
    name, _ = series.parse_series(F.col("series"))
    return raw_books(t).withColumn("n", name).select("_src_pos", series.is_part_of_series(F.col("n")).alias("is_series"))


@query("c8_split_isbn", over_raw(ISBNS))
def _(t):
    return with_isbns(raw_books(t)).select("_src_pos", "isbn10", "isbn13")


ITEMS = duck.genre_items("genres")


@query("c9_parse_genres", over_raw({"genre_list": f"array_to_string({ITEMS}, '|')"}))
def _(t):
    return raw_books(t).select("_src_pos", F.array_join(genres.parse_genres(F.col("genres")), "|").alias("genre_list"))


@query("c10_normalize_genres", over_raw({"genre_list": duck.genres_norm(ITEMS)}))
def _(t):
    parsed = raw_books(t).withColumn("genres", genres.parse_genres(F.col("genres")))
    return genres.normalize_genres(parsed).select("_src_pos", F.array_join("genres_norm", "|").alias("genre_list"))


@query("c11_normalize_publishers", over_raw({"publisher_norm": duck.publisher("publisher")}))
def _(t):
    return publishers.normalize_publisher(raw_books(t)).select("_src_pos", "publisher_norm")


@query("c12_normalize_book_format", over_raw({"format_norm": duck.book_format("bookFormat")}))
def _(t):
    return formats.normalize_book_format(raw_books(t), target="format_norm").select("_src_pos", "format_norm")


@query("c13_normalize_edition", over_raw({"edition_norm": duck.edition("edition")}))
def _(t):
    return editions.normalize_edition(raw_books(t)).select("_src_pos", "edition_norm")


def date_columns(prefix: str, source: str) -> dict[str, str]:
    date = duck.publish_date(source, AS_OF_YEAR)
    return {f"{prefix}_date": date, f"{prefix}_year": f"year({date})", f"{prefix}_month": f"month({date})",
            f"{prefix}_day": f"day({date})", f"{prefix}_quality": duck.date_quality(source, date)}


@query("c14_normalize_publish_date", over_raw(date_columns("publish", "publishDate")))
def _(t):
    cols = list(date_columns("publish", "publishDate"))
    return dates.normalize_publish_date(raw_books(t), "publishDate", *cols, as_of_year=AS_OF_YEAR).select("_src_pos", *cols)


@query("c14_normalize_first_publish_date", over_raw(date_columns("first", "firstPublishDate")))
def _(t):
    cols = list(date_columns("first", "firstPublishDate"))
    return dates.normalize_publish_date(raw_books(t), "firstPublishDate", *cols, as_of_year=AS_OF_YEAR).select("_src_pos", *cols)


@query("c14_unreadable_share", over_raw({"publishDate": "publishDate"}).replace(
    "SELECT _src_pos, publishDate AS publishDate FROM raw WHERE true",
    f"SELECT count(publishDate) AS given, count({duck.publish_date('publishDate', AS_OF_YEAR)}) AS parsed FROM raw"))
def _(t):
    parsed = dates.normalize_publish_date(raw_books(t), "publishDate", "d", "y", "m", "dd", "q", as_of_year=AS_OF_YEAR)
    return parsed.agg(F.count("publishDate").alias("given"), F.count("d").alias("parsed"))


@query("c15_normalize_num_ratings", over_raw({"numRatings_norm": "numRatings"}))
def _(t):
    return raw_books(t).select("_src_pos", F.col("numRatings").alias("numRatings_norm"))


STAR_SQL = {f'"{s}"': duck.star("ratingsByStars", i) for i, s in enumerate(STARS, 1)}


@query("c16_ratings_by_stars", over_raw(STAR_SQL))
def _(t):
    return numbers.normalize_ratings_by_stars(raw_books(t)).select("_src_pos", *STARS)


@query("c17_normalize_pages", over_raw({"pages_norm": duck.pages("pages")}))
def _(t):
    return raw_books(t).select("_src_pos", numbers.first_number(F.col("pages")).alias("pages_norm"))


@query("c18_clean_description", over_raw({"description_norm": duck.description("description")}))
def _(t):
    return raw_books(t).select("_src_pos", text.clean_description(F.col("description")).alias("description_norm"))


@query("c18_clean_documents", f"SELECT doc_id, {duck.description('text')} AS text_norm FROM documents")
def _(t):
    return t.documents.select("doc_id", text.clean_description(F.col("text")).alias("text_norm"))


@query("c19_boxset_flag", over_raw({"is_boxset": duck.boxset("series")}))
def _(t):
    return raw_books(t).select("_src_pos", series.boxset_flag(F.col("series")).alias("is_boxset"))


@query("c20_blank_to_null", over_raw({c: f"nullif(trim({c}), '')" for c in ("title", "series", "author", "publisher")}))
def _(t):
    return raw_books(t).select("_src_pos", *[text.blank_to_null(F.col(c)).alias(c)
                                             for c in ("title", "series", "author", "publisher")])


NAME_PARTS = {"first_name": duck.first_name("author"), "middle_name": duck.middle_name("author"),
              "last_name": duck.last_name("author")}


@query("c21_split_person_name", over_raw(NAME_PARTS, "author <> ''"))
def _(t):
    parts = names.person_name_parts(F.col("author"), letters_only=True)
    return raw_books(t).filter("author <> ''").select("_src_pos", *[c.alias(n) for n, c in parts.items()])


@query("c22_fill_person_name", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_name,
       CASE WHEN len(string_split(p_name, ' ')) > 2 THEN split_part(p_name, ' ', 2) END AS middle_name,
       CASE WHEN len(string_split(p_name, ' ')) > 1 THEN string_split(p_name, ' ')[-1] END AS last_name FROM part""")
def _(t):
    none = F.lit(None).cast("string")
    return t.part.select("p_partkey", *[c.alias(n) for n, c in
                                        names.fill_person_name(F.col("p_name"), none, none, none).items()])


# Duplicate removal and the whole job

DEDUP13 = """SELECT _src_pos, isbn13 FROM (SELECT *, row_number() OVER (PARTITION BY isbn13 ORDER BY _src_pos) AS rn
FROM i) WHERE isbn13 IS NULL OR rn = 1"""


def isbn_table() -> dict[str, str]:
    cols = f"{ISBNS['isbn10']} AS isbn10, {ISBNS['isbn13']} AS isbn13"
    return unbraced({**RAW, "i": f"SELECT _src_pos, bookId, {cols} FROM raw"})


@query("d1_keep_one_per_isbn13", with_tables(isbn_table(), DEDUP13))
def _(t):
    return dedup.keep_one_per(with_isbns(raw_books(t)), "isbn13").select("_src_pos", "isbn13")


@query("d2_keep_one_per_isbn10", with_tables(isbn_table(), DEDUP13.replace("isbn13", "isbn10")))
def _(t):
    return dedup.keep_one_per(with_isbns(raw_books(t)), "isbn10").select("_src_pos", "isbn10")


@query("d3_remove_duplicate_book_ids", with_tables(RAW, "SELECT bookId, min(_src_pos) AS _src_pos FROM raw GROUP BY bookId"))
def _(t):
    return dedup.first_per_key(raw_books(t), ["bookId"], ["_src_pos"]).select("bookId", "_src_pos")


@query("d6_duplicate_keys", with_tables(RAW, """
SELECT title, series, count(*) AS n FROM raw WHERE title IS NOT NULL AND series IS NOT NULL
GROUP BY title, series HAVING count(*) > 1"""))
def _(t):
    return dedup.duplicate_keys(raw_books(t), ["title", "series"])


@query("g9_value_counts", with_tables(RAW, "SELECT language, count(*) AS n FROM raw WHERE language IS NOT NULL GROUP BY 1"))
def _(t):
    return dedup.value_counts(raw_books(t), "language")


KEYED = unbraced({**AUTHOR_CTES, "k": f"""
SELECT _src_pos, {duck.normalize_text('title')} AS title_norm, {duck.series_name('series')} AS series_name_norm,
       {duck.primary_name('primary_author')} AS primary_author_name FROM a3"""})


def keyed_books(t):
    df = cleaning.clean_titles(cleaning.clean_authors(raw_books(t)))
    return settle(df.select("_src_pos", "title_norm", "series_name_norm", "primary_author_name"), "keyed")


def uid_sql(key: str, uid: str, n: str) -> str:
    return f"""
, f AS (SELECT {key} AS key, min(_src_pos) AS first, count(*) AS n FROM k GROUP BY 1)
, u AS (SELECT key, n, row_number() OVER (ORDER BY first) AS uid FROM f WHERE key IS NOT NULL)
SELECT _src_pos, {key} AS {uid.replace('uid', 'key')}, uid AS {uid}, n AS {n}"""


@query("k1_book_identifier", with_tables(KEYED, "")[:-1] + uid_sql(
    "title_norm || '-' || coalesce(primary_author_name, 'None')", "book_uid", "edition_count") + """,
CASE WHEN n > 1 THEN 1 ELSE 0 END AS has_multiple_editions
FROM k JOIN u ON u.key = title_norm || '-' || coalesce(primary_author_name, 'None')""")
def _(t):
    return keys.book_identifier(keyed_books(t), "_src_pos").select(
        "_src_pos", "book_key", "book_uid", "edition_count", "has_multiple_editions")


SERIES_KEY = "nullif(series_name_norm, '') || '-' || nullif(primary_author_name, '')"


@query("k2_series_identifier", with_tables(KEYED, "")[:-1] + uid_sql(SERIES_KEY, "series_uid", "books_in_series") + f"""
FROM k LEFT JOIN u ON u.key = {SERIES_KEY}""")
def _(t):
    return keys.series_identifier(keyed_books(t), "_src_pos").select(
        "_src_pos", "series_key", "series_uid", "books_in_series")


def cleaned_ctes() -> dict[str, str]:
    """The whole cleaning job as SQL, from raw rows to staging columns."""
    isbns = f"{ISBNS['isbn10']} AS isbn10, {ISBNS['isbn13']} AS isbn13"
    stars = ", ".join(f"{e} AS {c}" for c, e in STAR_SQL.items())
    slots = ", ".join(f"{duck.no_junk(e) if not c.endswith('role') else e} AS {c}" for c, e in CONTRIBUTORS.items())
    publish, first = date_columns("publish", "publishDate"), date_columns("first_publish", "firstPublishDate")
    dates_sql = ", ".join(f"{e} AS {c}" for c, e in (publish | first).items())
    return unbraced({
        **RAW,
        "e": f"SELECT *, {isbns} FROM raw WHERE language = 'English' AND title <> '' AND {duck.ascii_only('title')}",
        "f": """SELECT *, row_number() OVER (PARTITION BY coalesce(isbn13, isbn10) ORDER BY _src_pos) AS rn FROM e
                WHERE (isbn13 IS NOT NULL OR isbn10 IS NOT NULL) AND isbn13 IS DISTINCT FROM '9999999999999'""",
        "g": f"SELECT *, row_number() OVER (PARTITION BY bookId ORDER BY isbn10 IS NULL, _src_pos) AS rb FROM f"
             f" WHERE rn = 1 AND {duck.latin('publisher')}",
        "a1": f"SELECT g.* REPLACE ({duck.author_text('author')} AS author),"
              f" row_number() OVER (ORDER BY isbn10 IS NULL, _src_pos) AS pos FROM g WHERE rb = 1",
        "a2": AUTHOR_CTES["a2"],
        "a3": AUTHOR_CTES["a3"],
        "c": f"""SELECT _src_pos, pos, bookId, isbn10, isbn13, author, author_norm, primary_author, author_roles_norm,
                 {duck.primary_name('primary_author')} AS primary_author_name, {slots},
                 {duck.normalize_text('title')} AS title_norm,
                 {duck.series_name('series')} AS series_name_norm, {duck.series_num('series')} AS series_num,
                 {duck.boxset('series')} AS is_boxset, {duck.description('description')} AS description_norm,
                 {duck.genres_norm(ITEMS)} AS genre_list, {duck.publisher('publisher')} AS publisher_norm,
                 {duck.book_format('bookFormat')} AS "bookFormat_norm", {duck.edition('edition')} AS edition_norm,
                 {dates_sql}, numRatings AS "numRatings_norm", {stars}, {duck.pages('pages')} AS pages_norm
                 FROM a3""",
        "bk": """SELECT title_norm || '-' || coalesce(primary_author_name, 'None') AS book_key, min(pos) AS first,
                 count(*) AS edition_count FROM c GROUP BY 1""",
        "bu": "SELECT book_key, edition_count, row_number() OVER (ORDER BY first) AS book_uid FROM bk",
        "sk": f"SELECT {SERIES_KEY} AS series_key, min(pos) AS first, count(*) AS books_in_series FROM c GROUP BY 1",
        "su": """SELECT series_key, books_in_series, row_number() OVER (ORDER BY first) AS series_uid FROM sk
                 WHERE series_key IS NOT NULL""",
        "staging": f"""SELECT c.* EXCLUDE (pos), series_name_norm <> '' AS is_series, bu.*,
                 CASE WHEN edition_count > 1 THEN 1 ELSE 0 END AS has_multiple_editions, su.*
                 FROM c JOIN bu ON bu.book_key = title_norm || '-' || coalesce(primary_author_name, 'None')
                 LEFT JOIN su ON su.series_key = {SERIES_KEY}""",
    })


STAGING_COLUMNS = [
    "_src_pos", "bookId", "isbn10", "isbn13", "author", "author_norm", "primary_author", "author_roles_norm",
    "primary_author_name", *CONTRIBUTORS, "title_norm", "series_name_norm", "series_num", "is_boxset",
    "description_norm", "genre_list", "publisher_norm", "bookFormat_norm", "edition_norm",
    *date_columns("publish", ""), *date_columns("first_publish", ""), "numRatings_norm", *STARS, "pages_norm",
    "is_series", "book_key", "book_uid", "edition_count", "has_multiple_editions", "series_key", "series_uid",
    "books_in_series"]


def staging_view(staging):
    """Staging with the names the check SQL uses: array genres as text."""
    renamed = {"publishDate_norm": "publish_date", "publish_date_quality": "publish_quality",
               "firstPublishDate_norm": "first_publish_date"}
    shown = staging.drop("genres").withColumn("genre_list", F.array_join("genres_norm", "|"))
    return shown.withColumnsRenamed(renamed).select(STAGING_COLUMNS)


def cleaned_books(t):
    return t.stored("cleaned", lambda t: settle(cleaning.run_cleaning(raw_books(t), AS_OF_YEAR), "staging"))


@query("run_cleaning", with_tables(
    cleaned_ctes(), "SELECT " + ", ".join(f'"{c}"' for c in STAGING_COLUMNS) + " FROM staging"))
def _(t):
    return staging_view(cleaning.run_cleaning(raw_books(t), AS_OF_YEAR))


@query("choose_rows", with_tables(
    {k: v for k, v in cleaned_ctes().items() if k in ("raw", "e", "f", "g")},
    "SELECT _src_pos, bookId, isbn10, isbn13 FROM g WHERE rb = 1"))
def _(t):
    return cleaning.choose_rows(raw_books(t)).select("_src_pos", "bookId", "isbn10", "isbn13")


@query("c9_nested_genres", """
SELECT p_partkey, CASE WHEN p_size % 12 = 11 THEN '' ELSE lower(trim(p_name)) || '|tea' END AS genre_list FROM part""")
def _(t):
    # Lists in the list, up to ten deep; one bracket too many makes it no list.
    deep = F.concat(F.expr("repeat('[1, ', p_size % 11)"), F.lit("'x', \"]\""), F.expr("repeat(']', p_size % 11)"))
    whole = F.concat(F.lit("['"), "p_name", F.lit("', "), F.when(F.col("p_size") % 11 > 0, F.concat(deep, F.lit(", "))).otherwise(""),
                     F.when(F.col("p_size") % 12 == 11, F.lit("], ")).otherwise(""), F.lit("'Tea']"))
    return t.part.select("p_partkey", F.array_join(genres.parse_genres(whole), "|").alias("genre_list"))


def catalogue_file(t) -> str:
    """The stand-in catalogue as CSV in file form, unused columns included; files and their rows in order of position."""
    import uuid
    path = f"{shared_folder(t.spark)}/catalogue-{uuid.uuid4().hex}"
    whole = raw_books(t).repartitionByRange("_src_pos").sortWithinPartitions("_src_pos").withColumns(
        {c: F.lit("x") for c in DROPPED_CATALOGUE_COLUMNS})
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    whole.select(*CATALOGUE_COLUMNS, *DROPPED_CATALOGUE_COLUMNS).write.options(**options).csv(path)
    return path


# Every row and cell of the loaded file, numbered in the order of its positions.
@query("s1_load_catalogue", with_tables(RAW, "SELECT row_number() OVER (ORDER BY _src_pos) AS place, " + ", ".join(
    f"""CASE WHEN "{c}" NOT IN ({', '.join(f"'{m}'" for m in files.MISSING)}) THEN "{c}" END AS "{c}\"""" for c in CATALOGUE_COLUMNS) + " FROM raw"))
def _(t):
    loaded = files.load_catalogue(t.spark, catalogue_file(t))
    return keys.assign_ids(settle(loaded, "loaded"), "place", ["_src_pos"]).select("place", *CATALOGUE_COLUMNS)


@query("s1_quoted_line_breaks", """
SELECT row_number() OVER (ORDER BY doc_id) AS place, doc_id::VARCHAR AS doc_id, regexp_replace(text, '\\r\\n', chr(10), 'g') AS text, source FROM documents""")
def _(t):
    # Texts with line breaks, quotes and commas, written in order of id.
    import uuid
    path = f"{shared_folder(t.spark)}/texts-{uuid.uuid4().hex}"
    options = {"header": True, "escape": '"', "quoteAll": True, "emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    t.documents.select("doc_id", "text", "source").orderBy("doc_id").write.options(**options).csv(path)
    loaded = settle(files.read_quoted_csv(t.spark, path), "texts")
    return keys.assign_ids(loaded, "place", ["_src_pos"]).select("place", "doc_id", "text", "source")


@query("s2_write_staging", with_tables(cleaned_ctes(), "SELECT " + ", ".join(f'"{c}"' for c in STAGING_COLUMNS) + " FROM staging"))
def _(t):
    import uuid
    path = f"{shared_folder(t.spark)}/staging-{uuid.uuid4().hex}"
    files.write_staging(cleaned_books(t), path)
    return staging_view(t.spark.read.parquet(path))


@query("r22_cleaning_shapes", with_tables(cleaned_ctes(), """
SELECT 'before' AS stage, count(*) AS rows FROM raw UNION ALL SELECT 'after', count(*) FROM staging"""))
def _(t):
    return reports.cleaning_report(raw_books(t), cleaned_books(t))["shapes"]


@query("r22_several_editions", with_tables(cleaned_ctes(), """
SELECT book_uid, count(*) AS n FROM staging GROUP BY 1 HAVING count(*) > 1"""))
def _(t):
    return reports.cleaning_report(raw_books(t), cleaned_books(t))["repeated_books"]


@query("r22_box_sets", with_tables(cleaned_ctes(), """
SELECT title_norm, series_name_norm, author_norm, is_boxset FROM staging WHERE is_boxset = 1"""))
def _(t):
    return reports.cleaning_report(raw_books(t), cleaned_books(t))["box_sets"].select(
        "title_norm", "series_name_norm", "author_norm", "is_boxset")


# The other sections of the report: name, SQL columns, condition.
REPORT_SECTIONS = {
    "titles": ("r.title, s.title_norm", "true"),
    "authors": ("s.author, s.author_norm, s.primary_author, s.author_2, s.author_3, s.author_4, s.author_5", "true"),
    "publish_dates": ('r."publishDate", s.publish_date AS "publishDate_norm"', "true"),
    "several_editions": ("r.title, s.author_norm, r.edition, s.has_multiple_editions", "s.has_multiple_editions = 1"),
}


def report_section(name: str, columns: str, where: str) -> None:
    @query(f"r22_report_{name}", with_tables(cleaned_ctes(), f"SELECT {columns} FROM staging s JOIN raw r USING (_src_pos) WHERE {where}"))
    def _(t):
        return reports.cleaning_report(raw_books(t), cleaned_books(t))[name]


for section, (listed, condition) in REPORT_SECTIONS.items():
    report_section(section, listed, condition)


@query("r22_languages_before", with_tables(RAW, "SELECT language, count(*) AS n FROM raw WHERE language IS NOT NULL GROUP BY 1"))
def _(t):
    return reports.cleaning_report(raw_books(t), cleaned_books(t))["languages_before"]


@query("r22_languages_after", with_tables(cleaned_ctes(), "SELECT r.language, count(*) AS n FROM staging s JOIN raw r USING (_src_pos) GROUP BY 1"))
def _(t):
    return reports.cleaning_report(raw_books(t), cleaned_books(t))["languages_after"]


@query("r22_series", with_tables(cleaned_ctes(), """
SELECT title_norm, series_name_norm, series_num, is_series FROM staging WHERE is_series"""))
def _(t):
    return reports.cleaning_report(raw_books(t), cleaned_books(t))["series"].select(
        "title_norm", "series_name_norm", "series_num", "is_series")


@query("r23_publish_date_pairs", with_tables(cleaned_ctes(), """
SELECT publish_date AS "publishDate_norm", first_publish_date AS "firstPublishDate_norm", count(*) AS count FROM staging
GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST LIMIT 50"""))
def _(t):
    return reports.publish_date_pairs(cleaned_books(t))


@query("r23_odd_date_texts", with_tables(RAW, """
SELECT DISTINCT publishDate FROM raw WHERE publishDate IS NOT NULL AND NOT regexp_full_match(publishDate, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
ORDER BY 1 LIMIT 20"""))
def _(t):
    return reports.odd_date_texts(raw_books(t), "publishDate")
