"""Normalising and taking apart of names, titles, paths and dates."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that decomposition leaves alone (fixed values).
LETTERS = {"ø": "o", "Ø": "O", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "þ": "th", "Þ": "TH", "ð": "d", "Ð": "D", "ı": "i"}
#: Endings of company names in the order in which they are tried, and one name with a short form of its own (fixed values).
COMPANY_ENDINGS = (
    " company$", " consultants", " corp$", r" corp\.$", " corporation$", " creations$", " design$", " designs$", " development$",
    " developments$", " dezign$", " entertainment$", " games$", " gmbh$", " graphics$", " inc$", r" inc\.$", " interactive$",
    " international$", " limited$", " ltd$", " online$", " on-line$", " platinum$", " project$", " projects$", " productions$",
    " publishing$", " soft$", " software$", " studios$", " system$", " systems$", "[^A-Za-z0-9]",
)
SHORT_NAMES = {"International Computer Entertainment": "ice"}
#: Endings of unfinished games, in the order in which they are tried (fixed values).
UNFINISHED = (" - demo", " - preview", " - final", " playable", " demo", " playable preview", " preview", " prev", " beta")
#: Replacements in album titles, in order (fixed values).
ALBUM_RULES = (
    (r"\(.*\)", ""), (" PC$", ""), (" ST$", ""), (" - Falcon$", ""), (" - Jaguar$", ""), (" CD32$", ""), (" AGA$", ""), (" preview$", ""),
    (r" [vV][0-9]+(\.[0-9]+)*\b", ""), (" #(.*)$", " $1"), (" 0([1-9][0-9])$", " $1"), (" 00([0-9])$", " $1"), (" 0([0-9])$", " $1"),
    (" 0$", ""), (" 1$", ""), (" [Ii]$", ""), (" [Ii][Ii]$", " 2"), (" [Ii][Ii][Ii]$", " 3"), (" [Ii][Vv]$", " 4"), (" [Vv]$", " 5"),
    (" [Vv][Ii]$", " 6"), (" [Vv][Ii][Ii]$", " 7"), (" [Vv][Ii][Ii][Ii]$", " 8"), (" [Ii][Xx]$", " 9"), ("^The ", ""), ("^A ", ""), ("^An ", ""),
    ("^[Ff]irst ", "1st "), ("^[Ss]econd ", "2nd "), ("^[Tt]hird ", "3rd "), ("^[Ff]ourth ", "4th "), ("^[Ff]ifth ", "5th "),
    ("^[Ss]ixth ", "6th "), ("^[Ss]eventh ", "7th "), ("^[Ee]ighth ", "8th "), ("^[Nn]inth ", "9th "),
    (" [Ff]irst ", " 1st "), (" [Ss]econd ", " 2nd "), (" [Tt]hird ", " 3rd "), (" [Ff]ourth ", " 4th "), (" [Ff]ifth ", " 5th "),
    (" [Ss]ixth ", " 6th "), (" [Ss]eventh ", " 7th "), (" [Ee]ighth ", " 8th "), (" [Nn]inth ", " 9th "),
    (" PAL/NTSC Selector$", ""), (r" 100% \(\+.*\)$", ""), (r" 100% \+[0-9]+$", ""), (r" \(\+[0-9]+\)$", ""), (r" \+[0-9]+$", ""), (r" \+\+$", ""),
)
#: Endings of previews, kinds that are cracktros, and kinds with a name of their own (fixed values).
PREVIEWS = (" preview", " prev", " demo", " beta", " (preview)", " (demo)", " (beta)", " version)")
CRACKTROS = ("cracktro", "crack intro", "import intro", "trainer")
KINDS = {"": "", "compo": "Compo", "game": "Game"}
FIRST_YEAR, LAST_YEAR = 1985, 2026


def fold_plain(text: str) -> str:
    """Accents off and special Latin letters spelt out; other scripts stay as they are (no ICU here)."""
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return unicodedata.normalize("NFC", "".join(LETTERS.get(c, c) for c in bare))


@F.pandas_udf(T.StringType())
def fold(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Arrow form of :func:`fold_plain`, once per distinct value of a batch; null stays null."""
    for batch in texts:
        known = {t: fold_plain(t) for t in batch.dropna().unique()}
        yield batch.map(known).astype(object).where(batch.notna(), None)


def leet(text: Column) -> Column:
    return F.translate(text, "013457", "oieast")


def normalize_author(name: Column, folded: bool = True) -> Column:
    """Lower case, accents off, a `[2 musicians]` ending and all but letters and digits off, digits read as letters."""
    low = F.regexp_replace(F.lower(name), r" \[[^\]]*\]$", "")
    return leet(F.regexp_replace(fold(low) if folded else low, "[^a-z0-9]", ""))


def strip_endings(text: Column, endings: Sequence[str]) -> Column:
    """Patterns taken off one after the other, each unless nothing would be left (one fold, however many patterns)."""
    def step(acc: Column, pattern: Column) -> Column:
        return F.coalesce(F.nullif(F.trim(F.regexp_replace(acc, pattern, F.lit(""))), F.lit("")), acc)

    return F.aggregate(F.array(*[F.lit(e) for e in endings]), text, step)


def replace_in_turn(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """All (pattern, replacement) rules applied one after the other, as one fold over the table of rules."""
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(r).alias("r")) for p, r in rules])
    return F.aggregate(table, text, lambda acc, rule: F.regexp_replace(acc, rule["p"], rule["r"]))


def normalize_publisher(name: Column, folded: bool = False) -> Column:
    """Lower case, a leading `the ` and company endings off, letters and digits only, digits read as letters; null stays null."""
    low = F.regexp_replace(F.lower(name), "^the ", "")

    def step(acc: Column, pattern: Column) -> Column:
        return F.coalesce(F.nullif(F.regexp_replace(acc, pattern, F.lit("")), F.lit("")), acc)

    plain = F.trim(leet(F.aggregate(F.array(*[F.lit(e) for e in COMPANY_ENDINGS]), fold(low) if folded else low, step)))
    for long, short in SHORT_NAMES.items():
        plain = F.when(name == long, short).otherwise(plain)
    return plain


def normalize_album_simple(title: Column) -> Column:
    """Lower case, bracketed parts and all but letters and digits off."""
    return F.regexp_replace(F.regexp_replace(F.lower(title), r"\(.*\)", ""), "[^a-z0-9]", "")


def normalize_album(title: Column, kind: Column | None = None, publishers: Column | None = None, year: Column | None = None, folded: bool = False) -> Column:
    """A title's key: by kind without the ending of unfinished games or with `[cracktro]`, without its publishers' names in
    front, cut at ` - ` and `: `, numbers and versions made alike, without the year it ends with; letters, digits and dots.

    An empty title is empty, a null one null; kind null or empty, publishers null and year 0 change nothing.
    """
    low_kind = F.lower(F.coalesce(kind, F.lit(""))) if kind is not None else F.lit("")
    low = F.lower(title)
    unfinished = F.lit(None).cast("string")
    for ending in reversed(UNFINISHED):
        unfinished = F.when(low.endswith(ending), F.trim(F.substring(title, F.lit(1), F.length(title) - len(ending)))).otherwise(unfinished)
    plain_game = (low_kind == "game") & ~low.startswith("game ")
    text = F.when(low_kind == "cracktro", F.concat(F.trim(title), F.lit(" [cracktro]"))).otherwise(F.coalesce(F.when(plain_game, unfinished), title))
    if publishers is not None:

        def without(acc: Column, p: Column) -> Column:
            mine = F.lower(F.substring(acc, F.lit(1), F.length(p) + 1)) == F.concat(F.lower(p), F.lit(" "))
            return F.when(mine, F.substring(acc, F.length(p) + 2, F.lit(1 << 30))).otherwise(acc)

        text = F.aggregate(F.coalesce(publishers, F.array().cast("array<string>")), text, without)
    cut = F.regexp_replace(F.regexp_replace(text, " - .*", ""), ": .*", "")
    plain = F.lower(replace_in_turn(cut, ALBUM_RULES))
    if year is not None:
        shown = F.concat(F.lit(" "), year.cast("string"))
        plain = F.when((year > 0) & plain.endswith(shown), F.trim(F.substring(plain, F.lit(1), F.length(plain) - 5))).otherwise(plain)
    return F.when(title == "", "").otherwise(F.trim(F.regexp_replace(fold(plain) if folded else plain, r"[^A-Za-z0-9.]", "")))


def normalize_filename(path: Column) -> Column:
    return F.regexp_replace(F.lower(path), "[^a-z0-9/]", "")


def name_variants(name: Column) -> Column:
    """Short forms of a name of two or more words: `F. Last`, and of three or more also `First Last`; else none."""
    parts = F.filter(F.split(name, " "), lambda p: p != "")
    first, last = F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)
    short = F.concat(F.substring(first, 1, 1), F.lit(". "), last)
    none = F.array().cast("array<string>")
    return F.when(F.size(parts) == 2, F.array(short)).when(F.size(parts) > 2, F.array(short, F.concat_ws(" ", first, last))).otherwise(none)


def real_name(name: Column, handle: Column) -> Column:
    """First and last part of a real name; null if the handle ends with the same part and isn't just these two.

    `Jr.` at the end is passed over; names with `van`, `del` or a dotted part are kept whole.  A dotted name with the
    handle's last part is null too.
    """
    words = F.split(name, " ")
    parts = F.when(F.get(words, F.size(words) - 1) == "Jr.", F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1)))).otherwise(words)
    low = F.transform(parts, lambda p: F.lower(p))
    of_handle = F.split(F.lower(handle), " ")
    ends = F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1))
    dotted = F.exists(parts, lambda p: p.contains("."))
    same = F.get(of_handle, F.size(of_handle) - 1) == F.get(low, F.size(low) - 1)
    refused = same & ((F.length(handle) != F.length(ends)) | dotted)
    long = (F.size(parts) >= 3) & ~F.array_contains(low, "van") & ~F.array_contains(low, "del") & ~dotted
    return F.when(refused, F.lit(None)).when(long, ends).otherwise(name)


def rotate_article(title: Column) -> Column:
    """`Title, The (rest)` as `The Title (rest)`."""
    return F.regexp_replace(title, r"^(.*), (The|A|An)\b(.*)$", "$2 $1$3")


def remove_article(title: Column) -> Column:
    return F.regexp_replace(title, "^(The|A|An) ", "")


def article_variants(title: Column) -> Column:
    return F.array_distinct(F.array(title, remove_article(title), F.concat(F.lit("The "), remove_article(title))))


def author_variants(authors: Column, alias: Column, real: Column) -> Column:
    """Author lists in which one occurrence of ``alias`` at a time is replaced by ``real``, and the list itself."""
    swapped = F.transform(authors, lambda a, i: F.transform(authors, lambda b, j: F.when((i == j) & (b == alias), real).otherwise(b)))
    return F.array_distinct(F.concat(F.array(authors), swapped))


def rotate_name(name: Column) -> Column:
    """`Last, First` as `First Last`."""
    return F.regexp_replace(name, r"^([^,]+), ([^,]+)$", "$2 $1")


def split_people(names: Column) -> Column:
    """People of a list written with commas, `&`, `+` or `and`."""
    return F.filter(F.transform(F.split(names, r"\s*(?:,|&|\+|\band\b)\s*"), lambda n: F.trim(n)), lambda n: n != "")


def capitalize_words(text: Column) -> Column:
    """First letter of each word in upper case, the rest as it is."""
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def first_match(text: Column, patterns: Sequence[tuple[str, int]]) -> Column:
    """Group of the first of the ordered patterns that matches, else null."""
    tries = [F.regexp_extract(text, pattern, group) for pattern, group in patterns]
    return F.coalesce(*[F.when(t != "", t) for t in tries])


def path_year(path: Column) -> Column:
    """Year of a path by four ordered patterns; ranges give their end; 0 if none lies in the known years."""
    patterns = ((r"/(?:19|20)[0-9]{2}-((?:19|20)[0-9]{2})/", 1), (r"/((?:19|20)[0-9]{2})/", 1), (r"\(((?:19|20)[0-9]{2})\)", 1), (r"[-_ ]((?:19|20)[0-9]{2})[-_ /.]", 1))
    years = [F.regexp_extract(path, p, g).try_cast("int") for p, g in patterns]
    return F.coalesce(*[F.when(y.between(FIRST_YEAR, LAST_YEAR), y) for y in years], F.lit(0))


def any_year(text: Column) -> Column:
    return F.coalesce(F.regexp_extract(text, r"\b([12][0-9]{3})\b", 1).try_cast("int"), F.lit(0))


def play_time(text: Column) -> Column:
    """`h:mm:ss`, `m:ss` or `ss` in seconds, else 0."""
    parts = F.split(text, ":")
    seconds = F.aggregate(parts, F.lit(0), lambda n, p: n * 60 + p.try_cast("int"))
    return F.when(F.coalesce(text.rlike(r"^[0-9]{1,4}(:[0-9]{2}){0,2}$"), F.lit(False)), seconds).otherwise(F.lit(0))


def decode_url(text: Column) -> Column:
    """Percent signs decoded, a plus kept; a bad code leaves the text as it is."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(text, r"\+", "%2B")), text)


def url_host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^[a-z]+://([^/:?#]+)", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z]+://[^/]+(/[^?#]*)", 1)


def party_name(name: Column) -> Column:
    """Name of an event without its year and season."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"\b(19|20)[0-9]{2}\b", ""), r"(?i)\b(spring|summer|autumn|fall|winter)\b", ""))


def catalog_name(name: Column) -> Column:
    """Struct of a catalogue name `Title (date)(publisher)...[flags]`."""
    pattern = r"^(.*?) \(([^)]*)\)\(([^)]*)\)(.*)$"
    rest = F.regexp_extract(name, pattern, 4)
    return F.struct(
        F.regexp_extract(name, pattern, 1).alias("title"), any_year(F.regexp_extract(name, pattern, 2)).alias("year"),
        F.regexp_extract(name, pattern, 3).alias("publisher"), rest.contains("(demo)").alias("demo"),
        F.regexp_extract_all(rest, F.lit(r"\[([^\]]*)\]"), 1).alias("flags"),
    )


def author_album_path(path: Column) -> Column:
    """Struct (authors, album) of `format/author[/coop-other][/album]/file`."""
    parts = F.split(path, "/")
    author, second = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    coop = second.startswith("coop-")
    album = F.when(F.size(parts) > F.when(coop, 4).otherwise(3), F.get(parts, F.size(parts) - 2)).otherwise("")
    return F.struct(F.when(coop, F.array(author, F.substring(second, 6, 1 << 30))).otherwise(F.array(author)).alias("authors"), album.alias("album"))


def date_with_precision(date: Column, precision: Column) -> Column:
    """A date cut to its precision letter: y, m, or d."""
    return F.when(precision == "y", F.substring(date, 1, 4)).when(precision == "m", F.substring(date, 1, 7)).otherwise(F.substring(date, 1, 10))


def postgres_array(text: Column) -> Column:
    """Elements of a `{a,"b"}` literal: cut at every comma, quotes off afterwards; NULL is left out."""
    parts = F.split(F.regexp_replace(text, r"^\{|\}$", ""), ",")
    bare = F.transform(parts, lambda p: F.trim(F.regexp_replace(p, '^"|"$', "")))
    return F.filter(bare, lambda p: (p != "") & (p != "NULL"))


def is_preview(title: Column) -> Column:
    """Whether a title ends like a preview; titles that begin with `game ` never do."""
    low = F.lower(title)
    ends = F.lit(False)
    for ending in PREVIEWS:
        ends = ends | low.endswith(ending)
    return ends & ~low.startswith("game ")


def is_cracktro(kind: Column) -> Column:
    return F.lower(kind).isin(*CRACKTROS)


def normalize_type(kind: Column) -> Column:
    """``, `Compo`, `Game`, `Cracktro` or `Other`; null counts as unknown."""
    low = F.lower(F.coalesce(kind, F.lit("")))
    own = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[low]
    return F.coalesce(own, F.when(is_cracktro(low), "Cracktro").otherwise("Other"))
