"""Genre lists: parsing, canonical genres, and the ten genre columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import empty_to_null, first_match, has_any, strip

# Fixed values: (needles, genre, finer genres). The first row with a needle in
# the text wins, then the first finer genre, else the genre itself. Rows that
# an earlier row always catches ("time travel", "alternate history") are left out.
GENRE_RULES = [
    (("science fiction", "sci fi", "sci-fi", "scifi"), "science fiction", [
        (("romance",), "science fiction romance"),
        (("military",), "military science fiction")]),
    (("fantasy",), "fantasy", [
        (("urban",), "urban fantasy"),
        (("epic", "high fantasy"), "epic fantasy"),
        (("dark",), "dark fantasy"),
        (("historical",), "historical fantasy"),
        (("paranormal",), "paranormal fantasy"),
        (("romance",), "fantasy romance"),
        (("young adult",), "young adult fantasy")]),
    (("romance",), "romance", [
        (("contemporary",), "contemporary romance"),
        (("historical",), "historical romance"),
        (("paranormal",), "paranormal romance"),
        (("erotic",), "erotic romance"),
        (("regency",), "regency romance"),
        (("christian",), "christian romance"),
        (("m m", "gay", "lesbian"), "lgbtq+ romance"),
        (("sports",), "sports romance"),
        (("western",), "western romance"),
        (("military",), "military romance"),
        (("young adult",), "young adult romance")]),
    (("mystery", "whodunit", "detective"), "mystery", [
        (("cozy",), "cozy mystery"),
        (("historical",), "historical mystery"),
        (("paranormal",), "paranormal mystery")]),
    (("thriller", "suspense"), "thriller", [
        (("psychological",), "psychological thriller"),
        (("legal",), "legal thriller"),
        (("spy",), "spy thriller"),
        (("romantic",), "romantic suspense")]),
    (("horror", "splatterpunk"), "horror", [
        (("gothic",), "gothic horror"),
        (("erotic",), "erotic horror")]),
    (("historical",), "historical fiction", [
        (("naval",), "historical fiction"),
        (("christian",), "christian historical fiction"),
        (("young adult",), "young adult historical fiction")]),
    (("young adult", "ya "), "young adult", [
        (("contemporary",), "young adult contemporary"),
        (("paranormal",), "young adult paranormal")]),
    (("middle grade", "chapter books"), "middle grade", []),
    (("childrens", "picture books", "kids"), "children's", []),
    (("biography", "memoir"), "biography & memoir", []),
    (("history",), "history", [
        (("military", "world war"), "military history"),
        (("american",), "american history")]),
    (("philosophy",), "philosophy", []),
    (("psychology", "psychiatry", "psychoanalysis"), "psychology", []),
    (("self help", "self-help", "personal development"), "self-help", []),
    (("business", "entrepreneurship", "management", "leadership"), "business", []),
    (("science", "physics", "biology", "chemistry", "astronomy"), "science", []),
    (("religion", "christian", "islam", "judaism", "buddhism", "spirituality", "theology"),
     "religion & spirituality", []),
    (("travel",), "travel", []),
    (("cookbook", "cooking", "food"), "food & cooking", []),
    (("art", "photography", "design"), "art & design", []),
    (("true crime",), "true crime", []),
    (("classics", "classic literature"), "classics", []),
    (("literary",), "literary fiction", []),
    (("poetry", "poems"), "poetry", []),
    (("graphic novel", "comic", "manga", "manhwa"), "graphic novels & comics", []),
    (("dystopia",), "dystopian", []),
    (("apocalyptic",), "post-apocalyptic", []),
    (("steampunk",), "steampunk", []),
    (("cyberpunk",), "cyberpunk", []),
    (("crime", "noir"), "crime", []),
    (("western",), "western", []),
    (("adventure",), "adventure", []),
    (("humor", "comedy"), "humor", []),
    (("erotic",), "erotica", []),
    (("paranormal", "supernatural"), "paranormal", []),
    (("chick lit", "women's fiction", "womens fiction"), "women's fiction", []),
    (("short stories", "short story"), "short stories", []),
    (("lgbt", "gay", "lesbian", "queer", "bisexual", "transgender", "m m ", "f f "), "lgbtq+", []),
]

# Whole texts with a genre of their own.
EXACT_GENRES = {"fiction": ["fiction", "novels", "adult fiction"], "nonfiction": ["nonfiction", "non-fiction"]}

# An unmatched text with one of these is no genre.
NOT_A_GENRE = ("century", "grade", "own", "mine", "unfinished", "did not finish")

MAX_GENRES = 10


# A quoted text, and what a list text may hold: texts, and numbers or names.
QUOTED = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""
ITEM = rf"(?:{QUOTED}|[\w.+-]++)"
ITEMS = rf"(?s)^\s*+(?:{ITEM}?+\s*+,\s*+)*+{ITEM}?+\s*+$"
LIST = r"(?s)^\s*\[(.*)\]\s*$"
TOKEN = rf"(?s){QUOTED}|[\[\]]|[^\[\]'\"]++|['\"]"


def top_level(items: Column) -> Column:
    """List text without the lists in it, however deep; null where brackets don't close.

    A running count over the tokens tells how many lists are open; what is in
    one is left out, but for a quote that opens nothing.
    """
    state = "struct<depth:int,least:int,kept:array<string>>"

    def step(s: Column, token: Column) -> Column:
        depth = s["depth"] + F.when(token == "[", 1).when(token == "]", -1).otherwise(0)
        here = ~token.isin("[", "]") & ((s["depth"] == 0) | token.isin("'", '"'))
        return F.struct(depth.alias("depth"), F.least(s["least"], depth).alias("least"),
                        F.when(here, F.concat(s["kept"], F.array(token))).otherwise(s["kept"]).alias("kept")).cast(state)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("least"), F.array().cast("array<string>").alias("kept")).cast(state)
    whole = F.aggregate(F.regexp_extract_all(items, F.lit(TOKEN), F.lit(0)), start, step,
                        lambda s: F.when((s["depth"] == 0) & (s["least"] == 0), F.array_join(s["kept"], "")))
    return F.when(items.rlike(r"[\[\]]"), whole).otherwise(items)


def list_texts(c: Column) -> Column:
    """The texts of a list text, at its top level, escapes decoded; null unless it is a list."""
    items = top_level(F.regexp_extract(c, LIST, 1))
    texts = F.concat(F.lit("["), F.array_join(F.regexp_extract_all(items, F.lit(f"(?s){QUOTED}"), F.lit(0)), ","), F.lit("]"))
    # JSON has no two-digit escapes.
    texts = F.regexp_replace(texts, F.lit(r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})"), F.lit(r"$1\\u00$2"))
    listed = F.from_json(texts, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    return F.when(c.rlike(LIST) & items.rlike(ITEMS), listed)


def parse_genres(c: Column) -> Column:
    """Array of trimmed lower-case texts from list text; anything else is empty."""
    listed = list_texts(c)
    return F.coalesce(
        F.transform(F.filter(listed, lambda g: g.isNotNull()), lambda g: F.lower(strip(g))),
        F.array().cast("array<string>"))


def normalize_one(genre: Column) -> Column:
    """Canonical genre of one text; null for a text that is no genre."""
    cases = [
        (has_any(genre, needles),
         first_match([(has_any(genre, n), F.lit(g)) for n, g in finer], F.lit(label)) if finer else F.lit(label))
        for needles, label, finer in GENRE_RULES]
    cases += [(genre.isin(texts), F.lit(label)) for label, texts in EXACT_GENRES.items()]
    cases.append((has_any(genre, NOT_A_GENRE), F.lit(None)))
    return first_match(cases, otherwise=genre)


def normalize_genres(df: DataFrame, source: str = "genres", target: str = "genres_norm") -> DataFrame:
    """Distinct canonical genres in list order; ``uncategorized`` if none is left."""
    genres = F.coalesce(F.col(source), F.array().cast("array<string>"))
    kept = F.array_distinct(F.filter(F.transform(genres, normalize_one), lambda g: g.isNotNull()))
    nothing_left = (F.size("_kept") == 0) & (F.size(source) > 0)
    return (df.withColumn("_kept", kept)
            .withColumn(target, F.when(nothing_left, F.array(F.lit("uncategorized"))).otherwise(F.col("_kept")))
            .drop("_kept"))


def genre_slots(genres: Column) -> Column:
    """Genre texts by position, quotes removed; a comma inside a genre splits it."""
    parts = F.split(F.translate(F.array_join(genres, ","), "\"'", ""), ",")
    return F.transform(parts, lambda g: empty_to_null(F.trim(g)))


def genre_columns(genres: Column, n: int = MAX_GENRES) -> dict[str, Column]:
    slots = genre_slots(genres)
    return {f"genre_{i}": F.get(slots, F.lit(i - 1)) for i in range(1, n + 1)}
