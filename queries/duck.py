"""The cleaning rules once more as DuckDB expressions, for the check SQL.

Rule tables are shared with the library; how they are applied is written here
a second time, e.g. publisher rules run one after the other on each other's
output, where the library folds them into one ladder.
"""

from __future__ import annotations

from shelfmark.functions.editions import EDITION_RULES, NOT_AN_EDITION, ORDINALS, REPLACEMENTS
from shelfmark.functions.formats import CATEGORY_BY_FORMAT, DEFAULT_CATEGORY, FORMAT_RULES
from shelfmark.functions.genres import EXACT_GENRES, GENRE_RULES, NOT_A_GENRE
from shelfmark.functions.publishers import HOUSES, JUNK, SELF_PUBLISHED
from shelfmark.functions.roles import ROLE_SPELLINGS, ROLE_SUBSTRINGS

WS = r"[\s\x0b\x{00A0}]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)}, 'g')"


def hit(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


def group(x: str, pattern: str, i: int) -> str:
    return f"regexp_extract({x}, {lit(pattern)}, {i})"


def strip(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$")


def squeeze(x: str) -> str:
    return sub(x, f"{WS}+", " ")


def null_if_empty(x: str) -> str:
    return f"nullif({x}, '')"


def case(whens: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in whens) + f" ELSE {otherwise} END"


def any_of(x: str, needles) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(n)})" for n in needles) + ")"


def ascii_only(x: str) -> str:
    return f"regexp_full_match({x}, '[\\x00-\\x7F]*')"


def normalize_text(x: str) -> str:
    return f"trim({squeeze(f'lower(coalesce({x}, {lit(str())}))')})"


def description(x: str) -> str:
    return null_if_empty(f"trim({squeeze(x)})")


def author_text(x: str) -> str:
    initials = squeeze(sub(f"lower({x})", r"\b([a-z])\.", r"\1"))
    return strip(sub(initials, r"\s*(?:&|\band\b|;)\s*", ", "))


def author_norm(x: str) -> str:
    """On the output of ``author_text``, which leaves no initials or separators."""
    return null_if_empty(strip(squeeze(sub(x, r"\s*\(goodreads\s+author\)"))))


def primary_author(x: str) -> str:
    return null_if_empty(strip(f"split_part({x}, ',', 1)"))


def primary_name(x: str) -> str:
    return null_if_empty(strip(sub(x, r"\s*\([^)]*\)")))


def role(x: str) -> str:
    text = f"trim(lower({x}))"
    whens = [(f"NOT {ascii_only(text)}", "'unknown'")]
    whens += [(f"{text} IN ({', '.join(map(lit, listed))})", lit(canonical))
              for canonical, listed in ROLE_SPELLINGS.items()]
    whens += [(any_of(text, needles), lit(canonical)) for needles, canonical in ROLE_SUBSTRINGS]
    return case(whens, text)


def part_role(part: str) -> str:
    return null_if_empty(group(f"trim({part})", r"\(([^)]+)\)$", 1))


def part_name(part: str) -> str:
    return f"trim(regexp_replace(trim({part}), '\\(([^)]+)\\)$', ''))"


def author_roles(x: str) -> str:
    name = f"CASE WHEN {ascii_only(part_name('p'))} THEN {part_name('p')} ELSE 'unknown' END"
    shown = f"CASE WHEN {part_role('p')} IS NULL THEN {name} ELSE concat({name}, ' (', {role(part_role('p'))}, ')') END"
    return f"array_to_string([{shown} FOR p IN string_split({x}, ',')], ', ')"


def contributor(x: str, i: int, what: str) -> str:
    part = f"string_split({x}, ',')[{i}]"
    return part_role(part) if what == "role" else part_name(part)


def no_junk(x: str) -> str:
    return f"CASE WHEN starts_with({x}, '#') OR {x} = ')' THEN NULL ELSE {x} END"


SINGLE = r"^(.*?)\s*#\s*(\d+(?:\.\d+)?)$"


def series_name(x: str) -> str:
    text = strip(x)
    return normalize_text(case([
        (hit(text, SINGLE), group(text, SINGLE, 1)),
        (hit(text, r"#\s*\d+(?:\.\d+)?\s*-\s*\d+(?:\.\d+)?"), f"regexp_replace({text}, '\\s*#.*$', '')"),
    ], text))


def series_num(x: str) -> str:
    return f"CAST({null_if_empty(group(strip(x), SINGLE, 2))} AS DECIMAL(10,2))"


def boxset(x: str) -> str:
    return f"CAST(coalesce({hit(x, '#[0-9]+-[0-9]+')}, false) AS INT)"


def isbn(x: str, digits: int) -> str:
    text = sub(x, r"[\s-]")
    if digits == 13:
        return f"CASE WHEN regexp_full_match({text}, '[0-9]{{13}}') THEN {text} END".replace("{{", "{").replace("}}", "}")
    return f"CASE WHEN regexp_full_match({text}, '[0-9]{{9}}[0-9Xx]') THEN upper({text}) END"


def genre_items(x: str) -> str:
    """Texts of a list written with either kind of quote."""
    pattern = lit("'[^']*'|\"[^\"]*\"")
    return f"[lower(trim(substring(g, 2, length(g) - 2))) FOR g IN coalesce(regexp_extract_all({x}, {pattern}), [])]"


def genre(x: str) -> str:
    whens = [(any_of(x, needles), case([(any_of(x, n), lit(g)) for n, g in finer], lit(label)) if finer else lit(label))
             for needles, label, finer in GENRE_RULES]
    whens += [(f"{x} IN ({', '.join(map(lit, texts))})", lit(label)) for label, texts in EXACT_GENRES.items()]
    whens.append((any_of(x, NOT_A_GENRE), "NULL"))
    return case(whens, x)


def genres_norm(items: str) -> str:
    """Canonical genres in order of first appearance, as text with bars."""
    named = f"[{genre('g')} FOR g IN {items}]"
    kept = f"[n FOR n IN {named} IF n IS NOT NULL]"
    distinct = f"list_filter({kept}, lambda n, i: list_position({kept}, n) = i)"
    return (f"CASE WHEN len({items}) = 0 THEN '' WHEN len({kept}) = 0 THEN 'uncategorized' "
            f"ELSE array_to_string({distinct}, '|') END")


def publisher(x: str) -> str:
    text = f"lower({strip(f'coalesce({x}, {lit(str())})')})"
    for pattern, replacement in [
        ("`", "'"), ("[–—]", "-"), (r"\s*\(.*?\)", ""), (r"\b(uk|usa?|australia|india|canada)\b", ""),
        (r"\b([a-z])\.([a-z])", r"\1\2"), (r"\b([a-z]{1,3})\.\b", r"\1"), (r"[.\s]+$", ""), (r"\s*&\s*", " & "),
        (r"\b(inc|ltd|llc|plc|co|corp|gmbh|sa|pte|pty)\b", ""), (r"\s*-\s*(au|uk|us|usa|ca|nz)\b", ""),
        (r"\b(pub|publications)\b", "publishing"), (r"\b(publishers|publishing)\b", "publishing"),
        (r"\bcompanyy\b", "company"), (r"\s+", " "), (r",+$", ""),
    ]:
        text = sub(text, pattern, replacement)
    text = strip(text)
    text = f"CASE WHEN {hit(text, JUNK)} THEN '' ELSE {text} END"
    name = "p0"
    for house, marks in HOUSES:
        name = sub(name, f"^.*(?:{'|'.join(marks)}).*$", house)
    for pattern, replacement in [(r"\s+,", ","), (r",\s*$", ""), (r"[.\s]+$", "")]:
        name = sub(name, pattern, replacement)
    chain = f"coalesce({null_if_empty(strip(squeeze(name)))}, 'unknown')"
    start = f"CASE WHEN {hit('q0', SELF_PUBLISHED)} THEN 'self-published' ELSE q0 END"
    return f"(SELECT {chain} FROM (SELECT {start} AS p0 FROM (SELECT {text} AS q0)))"


def book_format(x: str) -> str:
    text = f"strip_accents({strip(squeeze(f'lower(coalesce({x}, {lit(str())}))'))})"
    whens = [(f"{text} = 'mass_market'", "'mass_market_paperback'")]
    whens += [(hit(text, rf"\b({words})\b"), lit(bucket)) for bucket, words in FORMAT_RULES]
    return case(whens, "'unknown'")


def category(x: str) -> str:
    return case([(f"{x} = {lit(f)}", lit(c)) for f, c in CATEGORY_BY_FORMAT.items()], lit(DEFAULT_CATEGORY))


def edition(x: str) -> str:
    raw = f"lower({strip(x)})"
    text = raw
    for ordinal, word in ORDINALS:
        text = sub(text, rf"\b{ordinal}\b", word)
    for old, new in REPLACEMENTS:
        text = f"replace({text}, {lit(old)}, {lit(new)})"
    whens = [(f"{x} IS NULL", "NULL"), (f"starts_with({raw}, 'http') OR {any_of(raw, NOT_AN_EDITION)}", "'Other'")]
    whens += [(hit("e0", pattern), lit(kind)) for kind, pattern in EDITION_RULES]
    return f"(SELECT {case(whens, lit('Other'))} FROM (SELECT {text} AS e0))"


def publish_date(x: str, as_of_year: int) -> str:
    """Over the date texts of the stand-in catalogue."""
    text = sub(strip(x), r"(\d+)(?:st|nd|rd|th)", r"\1")
    short = r"^(\d{2})/(\d{2})/(\d{2})$"
    yy = f"CAST({group('d0', short, 3)} AS INT)"
    century = as_of_year // 100 * 100
    year = (f"CASE WHEN {yy} + {century} >= {as_of_year + 50} THEN {yy} + {century - 100} "
            f"WHEN {yy} + {century} < {as_of_year - 50} THEN {yy} + {century + 100} ELSE {yy} + {century} END")
    formats = "['%m/%d/%Y', '%B %d %Y', '%d %b %Y', '%Y-%m-%d', '%B %Y']"
    found = case([
        (hit("d0", short), f"TRY_CAST(concat(lpad(concat('', {year}), 4, '0'), '-', {group('d0', short, 1)}, '-', "
                           f"{group('d0', short, 2)}) AS DATE)"),
        (hit("d0", r"^\d{3,4}$"), r"CASE WHEN regexp_matches(d0, '^\d{4}$') THEN CAST(concat(d0, '-01-01') AS DATE) END"),
    ], f"coalesce(CAST(try_strptime(d0, {formats}) AS DATE), "
       f"CAST(concat({null_if_empty(group('d0', '((19|20)[0-9][0-9])', 1))} || '-01-01') AS DATE))")
    found = found.replace("concat(nullif", "(nullif")
    return (f"(SELECT CASE WHEN year(d1) BETWEEN 1000 AND {as_of_year + 2} THEN d1 END FROM "
            f"(SELECT {found} AS d1 FROM (SELECT {text} AS d0)))")


def date_quality(raw: str, date: str) -> str:
    return case([(f"{date} IS NULL", "3"),
                 (f"month({date}) = 1 AND day({date}) = 1 AND {hit(strip(raw), '^[0-9][0-9][0-9][0-9]$')}", "2")], "1")


def star(x: str, i: int) -> str:
    items = f"[try_cast(trim(replace(s, '''', '')) AS BIGINT) FOR s IN string_split(substring({x}, 2, length({x}) - 2), ',')]"
    values = case([(f"{x} IS NULL", "NULL"), (f"{x} = '[]'", "[0, 0, 0, 0, 0]")], items)
    first = f"list_slice({values}, 1, 5)"
    return case([(f"list_contains([s IS NULL FOR s IN {first}], true)", "NULL"), (f"{x} IS NULL", "NULL")],
                f"coalesce({first}[{i}], 0)")


def pages(x: str) -> str:
    return f"CAST({null_if_empty(group(x, '([0-9]+)', 1))} AS INT)"


def latin(x: str) -> str:
    return f"regexp_full_match(coalesce({x}, ''), '[a-zA-Z0-9\\s&.'',/-]*')"


def first_name(x: str) -> str:
    return null_if_empty(sub(f"string_split(trim({squeeze(x)}), ' ')[1]", "[^A-Za-z]"))


def last_name(x: str) -> str:
    parts = f"string_split(trim({squeeze(x)}), ' ')"
    return f"CASE WHEN len({parts}) >= 2 THEN {null_if_empty(sub(f'{parts}[-1]', '[^A-Za-z]'))} END"


def middle_name(x: str) -> str:
    parts = f"string_split(trim({squeeze(x)}), ' ')"
    middle = f"array_to_string({parts}[2:len({parts}) - 1], ' ')"
    return f"CASE WHEN len({parts}) >= 3 THEN {null_if_empty(sub(middle, '[^A-Za-z ]'))} END"
