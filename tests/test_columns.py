"""Expected values derived by reading the rules; see FIXTURES.md."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import (
    dates, editions, formats, genres, isbn, names, numbers, publishers, roles, series, text)


def texts(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, c string").coalesce(1)


def apply(spark, values, column):
    got = texts(spark, values).select("i", column.alias("out")).collect()
    return [r["out"] for r in sorted(got)]


def apply_df(spark, values, transform, *cols):
    got = sorted(texts(spark, values).transform(transform).select("i", *cols).collect())
    return [tuple(r)[1:] if len(cols) > 1 else r[1] for r in got]


C = F.col("c")


def test_normalize_text(spark):
    values = ["  The   Hunger Games ", None, "A \tB\n", "Ärger"]
    assert apply(spark, values, text.normalize_text(C)) == ["the hunger games", "", "a b", "ärger"]


def test_clean_description(spark):
    assert apply(spark, [" a\n\n b\t c ", " \n", None], text.clean_description(C)) == ["a b c", None, None]


def test_author_text(spark):
    values = ["J.K. Rowling & John Smith", "Ann Band; Bo and Cy", "jane (Editor and Translator)", None]
    assert apply(spark, values, names.normalize_author_text(C)) == [
        "jk rowling, john smith", "ann band, bo, cy", "jane (editor, translator)", None]
    kept = apply(spark, values, names.normalize_author_text(C, paren_aware=True))
    assert kept[2] == "jane (editor and translator)"


def test_author_norm_and_primary(spark):
    value = "J. K. Rowling (Goodreads Author), John Doe (Translator)"
    norm = names.author_norm(names.normalize_author_text(C))
    assert apply(spark, [value, ""], norm) == ["j k rowling, john doe (translator)", None]
    first = names.primary_author(norm)
    assert apply(spark, [value, ", x"], first) == ["j k rowling", None]
    assert apply(spark, ["Ann (Ed.), Bo"], names.primary_author_name(first)) == ["ann"]


def test_author_roles(spark):
    values = ["josé saramago, ana (trans), bob (traductor), cy (ilustrador)", "x (author/illustrator), y",
              "a (cover illustration), b (co-editor), c (chief editor), d (röle), e ((editor)", None]
    assert apply(spark, values, roles.normalize_author_roles(C)) == [
        "unknown, ana (translator), bob (translator), cy (translator)",
        "x (author, illustrator), y",
        "a (cover artist), b (co-editor), c (editor), d (unknown), e (editor)", None]


def test_contributor_columns(spark):
    got = apply_df(spark, ["x (author, illustrator)", "a (editor), b, c (poet)", None],
                   lambda df: roles.contributor_columns(df, "c"),
                   "author_2", "author_3", "author_1_role", "author_2_role", "author_3_role")
    assert got == [("illustrator)", None, None, None, None), ("b", "c", "editor", None, "poet"),
                   (None,) * 5]
    whole = apply_df(spark, ["x (author, illustrator)"],
                     lambda df: roles.contributor_columns(df, "c", paren_aware=True), "author_1_role", "author_2")
    assert whole == [("author, illustrator", None)]


def test_clear_junk(spark):
    assert apply(spark, [")", "#1", "ann", None], roles.clear_junk(C)) == [None, None, "ann", None]


SERIES = ["Saga #1", "Saga #1.5", "Saga #1-7", "Saga # 1 - 3", "Saga", None, "A #2 #3"]


def test_series(spark):
    name, number = series.parse_series(C)
    assert apply(spark, SERIES, name) == ["saga", "saga", "saga", "saga", "saga", "", "a #2"]
    assert apply(spark, SERIES, number) == [Decimal("1.00"), Decimal("1.50"), None, None, None, None, Decimal("3.00")]
    assert apply(spark, SERIES, series.boxset_flag(C)) == [0, 0, 1, 0, 0, 0, 0]
    assert apply(spark, ["saga", " ", "", None], series.is_part_of_series(C)) == [True, False, False, False]


def test_split_isbn(spark):
    isbn10, isbn13 = isbn.split_isbn(C)
    values = ["0-439-02348-3", "043902348x", "978-0-439-02348-1", "12345", None]
    assert apply(spark, values, isbn10) == ["0439023483", "043902348X", None, None, None]
    assert apply(spark, values, isbn13) == [None, None, "9780439023481", None, None]


@pytest.mark.parametrize("value,want", [
    ("['Fantasy', 1]", ["fantasy"]), ("['Fantasy', None]", ["fantasy"]), ("['Fantasy', ['Horror', ['x']], 'Art']", ["fantasy", "art"]),
    (r"['caf\xe9', 'na\u00efve', 'it\'s']", ["café", "naïve", "it's"]), ("[\"Children's\", 'a \"b\"']", ["children's", 'a "b"']),
    (r"['back\\x41']", [r"back\x41"]), ("[]", []), ("['a',]", ["a"]), ("Fantasy", []), ("['open", []), (None, []), ("['a] [b', 'c,d']", ["a] [b", "c,d"])])
def test_genre_lists(spark, value, want):
    df = spark.createDataFrame([(value,)], "c string")
    assert df.select(genres.parse_genres(F.col("c"))).first()[0] == want


def test_genres(spark):
    values = ["['Young Adult', 'Fantasy', 'Fiction', '21st Century']", "['Alternate History']", "['Time Travel']",
              "['Martial Arts']", "['own', 'unfinished']", "[]", None, "[\"Women's Fiction\", 'Novels', 'Fiction']",
              "['Sci Fi Fantasy', 'M M Romance', 'Tea']"]
    got = apply_df(spark, values, lambda df: genres.normalize_genres(
        df.withColumn("g", genres.parse_genres(C)), "g", "out"), "out")
    assert got == [["young adult", "fantasy", "fiction"], ["history"], ["travel"], ["art & design"],
                   ["uncategorized"], [], [], ["women's fiction", "fiction"],
                   ["science fiction", "lgbtq+ romance", "tea"]]


def test_genre_columns(spark):
    df = spark.createDataFrame([(["children's", "a, b", "c"],), ([],)], "g array<string>").coalesce(1)
    cols = genres.genre_columns(F.col("g"))
    rows = df.select([c.alias(n) for n, c in cols.items()]).collect()
    assert list(rows[0])[:5] == ["childrens", "a", "b", "c", None]
    assert set(rows[1]) == {None}


@pytest.mark.parametrize("raw, house", [
    ("Penguin Random House", "penguin"), ("Scholastic Press", "scholastic"), ("National Geographic", "penguin"),
    ("Nation Books", "nation books"), ("CreateSpace", "self-published"), ("Tor.com", "torcom"), (None, "unknown"),
    ("Pan Macmillan Ltd.", "macmillan"), ("W.W. Norton & Co.", "ww. norton &"), ("N/A", "unknown"), ("s", "unknown"),
    ("Grove Atlantic", "grove/atlantic"), ("Little,Brown", "hachette"), ("Acme Publishers", "acme publishing"),
    ("Mentor", "macmillan"), ("Zed Books, Inc.", "zed books"),
])
def test_publisher(spark, raw, house):
    assert apply_df(spark, [raw], lambda df: publishers.normalize_publisher(df, "c", "p"), "p") == [house]


def test_publisher_filter(spark):
    assert apply(spark, ["Penguin (UK)", None, "Little, Brown", "", "Zoë", "A: B"], publishers.is_latin(C)) == [
        False, True, True, True, False, False]


def test_folded_houses():
    folded = publishers.folded_houses()
    assert folded[0][0] == "penguin"
    by_mark = {mark: house for house, marks in folded for mark in marks}
    assert by_mark[r"pan\s*macmillan"] == "pan macmillan" and by_mark["macmillan"] == "macmillan"
    assert by_mark["harper"] == "harpercollins"


def test_book_format(spark):
    values = ["Kindle Edition", "Mass Market Paperback", "Hardcover Boxed Set", "Broché", "Paper", "Foo", None,
              "mass_market", "E-Book", "Audio CD", "ﬂoppy cloth", "Board book", "School & Library Binding"]
    assert apply_df(spark, values, lambda df: formats.normalize_book_format(df, "c", "f"), "f") == [
        "ebook", "mass_market_paperback", "boxed_set", "paperback", "paperback", "unknown", "unknown",
        "mass_market_paperback", "ebook", "audio", "hardcover", "board_book", "library_binding"]
    assert apply(spark, ["hardcover", "board_book", "comic", None], formats.bestseller_category(C)) == [
        "Best Hardcover", "Best Childrens/Middle Grade Books", "Best Paperback", "Best Paperback"]


def test_edition(spark):
    values = ["1st Edition", "Unabridged", "25th Anniversary Edition", "Revised Edition", "original", "ISBN 01", None,
              "2nd ed.", "12th edtion", "http://x", "", "Boxed", "Movie tie-in", "Kindle", "odd"]
    assert apply_df(spark, values, lambda df: editions.normalize_edition(df, "c", "e"), "e") == [
        "First Edition", "Abridged", "Anniversary Edition", "Revised/Reprint", "Standard", "Other", None,
        "Second Edition", "Later Edition", "Other", "Standard", "Box Set", "Media Tie-In", "Digital", "Other"]


def test_publish_date(spark):
    values = ["April 27th 2010", "09/14/08", "11/01/76", "11/01/75", "2008", "November 2009", "unknown", None,
              "Published 3 May 2001", "2010-02-30", "27/04/2010", "1651-07-01", "0999", "2050", "about 1999 or so",
              "Sept. 5, 1988", "12345"]
    day = dt.date
    got = apply_df(spark, values, lambda df: dates.normalize_publish_date(
        df, "c", "d", "y", "m", "dd", "q", as_of_year=2026), "d", "q")
    assert got == [(day(2010, 4, 27), 1), (day(2008, 9, 14), 1), (day(1976, 11, 1), 1), (None, 3),
                   (day(2008, 1, 1), 2), (day(2009, 11, 1), 1), (None, 3), (None, 3), (day(2001, 5, 3), 1),
                   (day(2010, 1, 1), 1), (day(2010, 4, 27), 1), (day(1651, 7, 1), 1), (None, 3), (None, 3),
                   (day(1999, 1, 1), 1), (day(1988, 9, 5), 1), (None, 3)]


def test_stars_and_pages(spark):
    values = ["['10','5','3','1','0']", "['10','5']", "[]", "['x','1','1','1','1']", None, "['1','2','3','4','5','x']",
              "[1, 2, 3, 4, 5]"]
    assert apply_df(spark, values, lambda df: numbers.normalize_ratings_by_stars(df, "c"), *numbers.STARS) == [
        (10, 5, 3, 1, 0), (10, 5, 0, 0, 0), (0,) * 5, (None,) * 5, (None,) * 5, (1, 2, 3, 4, 5), (1, 2, 3, 4, 5)]
    assert apply(spark, ["374", "1,024 pages", "unknown", None], numbers.first_number(C)) == [374, 1, None, None]


def test_person_names(spark):
    parts = names.person_name_parts(C, letters_only=True)
    values = ["mary-ann de la cruz 2nd", "plato", "ann lee"]
    assert apply(spark, values, F.struct(*[parts[k] for k in ("first_name", "middle_name", "last_name")])) == [
        ("maryann", "de la cruz", "nd"), ("plato", None, None), ("ann", None, "lee")]
    none = F.lit(None).cast("string")
    filled = names.fill_person_name(C, none, none, none)
    assert apply(spark, ["Test First Middle Last", "Testing_Only_First"],
                 F.struct(*[filled[k] for k in ("first_name", "middle_name", "last_name")])) == [
        ("Test", "First Middle", "Last"), ("Testing_Only_First", None, None)]


def test_months_and_money(spark):
    assert apply(spark, [" Jan ", "Dec", "1", None], dates.month_number(C)) == ["1", "12", None, None]
    assert apply(spark, ["$11,695.50"], numbers.strip_currency(C)) == [Decimal("11695.50")]


def test_weighted_rating(spark):
    df = spark.createDataFrame(
        [(10, 5, 3, 1, 1), (10, 5, 3, 1, None), (0, 0, 0, 0, 0)], "a int, b int, c int, d int, e int").coalesce(1)
    got = [r[0] for r in df.select(numbers.weighted_rating([F.col(x) for x in "abcde"])).collect()]
    assert got == [Decimal("4.10"), None, None]
