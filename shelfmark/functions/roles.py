"""Contributor roles: ``name (role)`` lists to canonical roles and columns."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.names import OUTSIDE_PARENS
from shelfmark.functions.text import first_match, has_any, is_ascii, strip

# Canonical role and the spellings that stand for it. Spellings
# the substring rules below resolve alike, and roles spelled as the canonical
# one already, need no entry.
ROLE_SPELLINGS = {
    "translator": ["trans", "trn"],
    "editor": ["ed.", "preparation"],
    "co-editor": ["co-editor"],
    "illustrator": ["illustato", "llustrator"],
    "narrator": ["narrated by", "read by", "reader", "reading", "spiritual narrator"],
    "foreword": ["foreward", "forward"],
    "preface": ["preface by", "prologue"],
    "afterword": ["epilogue", "new afterword"],
    "notes": ["noted by", "annotations", "commentary", "commentaries by", "endnotes", "footnotes",
              "chronology and appendix"],
    "artist": ["art", "art by", "digital painter", "digital painting", "storyboards", "vignettes", "visual art"],
    "cover artist": ["cover art", "cover artwork", "cover illustration", "cover illustrator"],
    "colorist": ["color artist", "color", "colors", "colourist", "colours", "cover colourist", "gray-toner",
                 "colourist, cover artist"],
    "writer": ["screenwriter", "screenplay", "script", "teleplay", "dramatist", "scriptwriter/illustrator"],
    "author": ["original author", "primary contributor", "one of the authors", "author notes", "novelist", "text"],
    "co-author": ["joint author"],
    "adapter": ["adaptation", "adaptator", "adapted by", "adaptor", "english adaptation", "retelling", "retold by",
                "comicization"],
    "compiler": ["compiled by", "compilation", "anthologist", "selected by"],
    "contributor": ["contributer", "contribution by", "contributors"],
    "designer": ["design", "book design", "graphic designer", "designed by", "logo designer", "coverpage designer",
                 "fashion designer", "cover and interior designer", "character design", "mechanical design",
                 "layout", "typography"],
    "cover designer": ["cover design", "coverdesign"],
    "photographer": ["photographs", "photography"],
    "penciler": ["penciller", "pencils", "cover penciler"],
    "inker": ["inks", "cover inker"],
    "letterer": ["lettering", "letter", "touch-up artist/ letterer", "touch-up artsist/letterer",
                 "retouch and lettering"],
    "pseudonym": ["pseud.", "pen name", "author's pen name", "nom de plume", "aka.", "heteronym"],
    "creator": ["created by", "original creator", "series creator", "concept by", "original idea"],
    "abridger": ["abridged by"],
    "as told by": ["told by"],
    "based on": ["based on the novels", "based on the tv series", "based on work by"],
    "original story": ["original story by"],
    "story": ["story by"],
    "poet": ["verses"],
    "composer": ["music", "song writer"],
    "calligrapher": ["calligraphy"],
    "producer": ["produced by", "executive producer"],
    "director": ["project director"],
    "reviser": ["revised", "revised by"],
    "essayist": ["essay"],
    "unknown": ["student", "testimony", "topic", "idea"],
    "author, illustrator": ["author and illustrator", "author, illustrator", "author/illustrator"],
    "co-author, illustrator": ["co-author and illustrator"],
    "writer, illustrator": ["writer, illustrator", "writer/illustrator"],
    "adapter, illustrator": ["adapter, illustrator", "adapter/illustrator"],
    "editor, author": ["editor and author"],
    "editor, translator": ["editor and translator", "editor, translator", "editor/translator"],
    "translator, editor": ["translator, editor", "translator/editor"],
    "translator, introduction": ["translator, introduction"],
    "editor, introduction": ["editor, introduction"],
    "author, narrator": ["author/narrator"],
}

# Substrings that decide a role no spelling matched, in order.
ROLE_SUBSTRINGS = [
    (("translat", "trad"), "translator"),
    (("edit",), "editor"),
    (("illustrat",), "illustrator"),
    (("intro",), "introduction"),
]

CANONICAL_ROLES = json.dumps(
    {spelling: canonical for canonical, listed in ROLE_SPELLINGS.items() for spelling in listed})

ROLE_IN_PARENS = r"\(([^)]+)\)$"


def role_text(role: Column) -> Column:
    return strip(F.lower(role))


def canonical_role(text: Column) -> Column:
    """Canonical role of a trimmed lower-case text; ``unknown`` outside ASCII."""
    known = F.try_element_at(F.from_json(F.lit(CANONICAL_ROLES), "map<string,string>"), text)
    return first_match(
        [(~is_ascii(text), F.lit("unknown")), (known.isNotNull(), known)]
        + [(has_any(text, needles), F.lit(canonical)) for needles, canonical in ROLE_SUBSTRINGS],
        otherwise=text)


def split_contributors(c: Column, paren_aware: bool = False) -> Column:
    """Array of (name, role) in list order; role is null without parentheses."""
    comma = "," + (OUTSIDE_PARENS if paren_aware else "")

    def one(part: Column) -> Column:
        role = F.regexp_extract(part, ROLE_IN_PARENS, 1)
        return F.when(
            role == "", F.struct(part.alias("name"), F.lit(None).cast("string").alias("role"))
        ).otherwise(
            F.struct(strip(F.regexp_replace(part, ROLE_IN_PARENS, "")).alias("name"), role.alias("role")))

    return F.transform(F.transform(F.split(F.nullif(c, F.lit("")), comma), strip), one)


def normalize_author_roles(c: Column, paren_aware: bool = False) -> Column:
    """Rewrite each ``name (role)`` with its canonical role.

    A name that is not ASCII becomes ``unknown``.
    """
    def shown(person: Column) -> Column:
        name = person["name"]
        return F.struct(F.when(is_ascii(name), name).otherwise("unknown").alias("name"),
                        role_text(person["role"]).alias("role"))

    def written(person: Column) -> Column:
        name, role = person["name"], person["role"]
        return F.when(role.isNull(), name).otherwise(
            F.concat(name, F.lit(" ("), canonical_role(role), F.lit(")")))

    return F.array_join(F.transform(F.transform(split_contributors(c, paren_aware), shown), written), ", ")


def contributor_columns(df: DataFrame, source: str = "author_roles_norm", max_authors: int = 5,
                        paren_aware: bool = False) -> DataFrame:
    """``author_2..n`` and ``author_1_role..author_n_role`` from the role text.

    The text is split on commas once more, so a canonical role that holds a
    comma is cut in two unless ``paren_aware`` is set.
    """
    people = F.col("_people")
    names = {f"author_{i}": F.get(people, F.lit(i - 1))["name"] for i in range(2, max_authors + 1)}
    roles = {f"author_{i}_role": F.get(people, F.lit(i - 1))["role"] for i in range(1, max_authors + 1)}
    return (df.withColumn("_people", split_contributors(F.col(source), paren_aware))
            .withColumns(names | roles).drop("_people"))


def clear_junk(name: Column) -> Column:
    """Null for a leftover that starts with ``#`` or is a lone ``)``."""
    return F.when(name.startswith("#") | (name == ")"), None).otherwise(name)
