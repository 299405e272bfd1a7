"""Facts taken out of names, comments and links: companies, people, events, albums, and where a link leads."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Company forms inside a list of companies, in order: what is replaced by a comma, or goes (fixed values).
COMPANY_LIST_RULES = (
    (", Inc.,", ","), (", Inc,", ","), (" Co., LTD.", ","), (" Co., Ltd.,", ","), (" Pty., Ltd.,", ","), (", Pty. Ltd.,", ","), (", Pty Ltd.,", ","), (", Pty Ltd,", ","),
    (", Ltda.,", ","), (", Ltd.,", ","), (", Ltd,", ","), (", Pty.,", ","), (", Pty,", ","), (", S.A.,", ","), (", S.L.,", ","), (", Llc.,", ","), (", LLC,", ","), (", LLC.,", ","),
    (", Inc.$", ""), (", Inc$", ""), (" Pty., Ltd.$", ""), (", Ltd.$", ","), (", Ltd$", ","), (", Pty.$", ","), (", Pty$", ","), (", S.A.$", ","), (", S.L.$", ","), (", Llc.$", ","), (", LLC$", ","), (", LLC.$", ","),
)
#: Company forms at the end of one name, in order; names that keep theirs, and names that stand for none (fixed values).
COMPANY_FORMS = (
    " Co., LTD.$", " Co., Ltd.$", " Pty. Ltd.$", " Pty Ltd$", " Inc.$", " Ltda.$", " Ltd.$", " Ltd$", " LTD$", " Plc$", " PLC$", " plc$", ".SAS$", " S.A.S.$", " GesMBH$",
    " GmbH & Co. Produktions KG$", " GmbH & Co. KG$", " GmbH & Co.$", " GmbH$", " Pty$", " S.A.$", " S.L.$", " Llc.$", " LLC$", " LLC.$", " s.r.o.$", " S.R.L.$", " S.r.l.$", " s.r.l.$",
    " Software Company Limited$", " Limited$", " Software International$", " Europe SA$", " Europe B.V.$", " America Corporation", " of America$", " Electronics Co.", " Entertainment Co.$",
    " Industry Co.$", " Manufacturing Co.$", " Publishing Co.$", " Technology Co.$", " Trading Co.$", " Co. Development Group$", " Software Corp.$", " Entertainment Corp.$",
    " Entertainment Software$", " Leisure Corporation$", " Game Company$", " Co.$", " Corp.$", " Corporation$", " Company$", " Ltd$", " AB$", " CE$", " A/S$", " Multimedia SA$", "^The ",
)
COMPANY_AS_IT_IS, NO_COMPANY = ("The Learning Co.",), ("Freeware", "Unknown")
#: Words of a comment that tell of a competition, and words that tell it isn't about one (fixed values).
EVENT_WORDS = (
    "charted", "disqualified", "unselected", " party ", "gathering", "saturne", "gasp", "trackering ", "assembly", "happening", "rendez-vous", "at hurricane '", " the symposium ",
    " asm '", "south sealand", "music contest", "socad", "one-sample-module", "doom's day", "hackerrence", "1-sample", "the wired '", "amiga convention", "the hurricane", "icing ",
    "kindergarden ", "tcc '93", "primavera", "place 2 be", "silly whinnings", "summit '",
)
NO_EVENT_WORDS = (" demo ", " intro ", "after the ", " report", "planned to be ")
#: Numbers of an event held once a year from 1991 on (fixed values); longer ones are looked for first.
ROMAN_YEARS = (("party v", 1995), ("party iv", 1994), ("party iii", 1993), ("party ii", 1992), ("party i", 1991))


def _in_turn(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(r).alias("r")) for p, r in rules])
    return F.aggregate(table, text, lambda acc, rule: F.regexp_replace(acc, rule["p"], rule["r"]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _grown(state: Column, *stages: Callable[[Column], dict[str, Column]]) -> Column:
    """A struct that gains the fields of each stage in turn, each of which sees the fields before."""
    if not stages:
        return state

    def grow(s: Column) -> Column:
        out = s
        for name, value in stages[0](s).items():
            out = out.withField(name, value)
        return _grown(out, *stages[1:])

    return _let(state, grow)


def company_parts(text: Column) -> Column:
    """Parts of a list of companies, as structs of raw and short: without company forms and a leading `The`; null stays null."""
    bare = F.trim(F.regexp_replace(text, r"\([^)]*\)", ""))
    listed = F.trim(_in_turn(bare, COMPANY_LIST_RULES))

    def part(raw: Column) -> Column:
        short = F.aggregate(F.array(*[F.lit(p) for p in COMPANY_FORMS]), raw, lambda acc, p: F.regexp_replace(acc, p, F.lit("")))
        return F.struct(raw.alias("raw"), F.trim(short).alias("short"))

    return F.transform(F.split(listed, ","), lambda p: part(F.trim(p)))


def company(raw: Column, short: Column) -> Column:
    """The name that a part stands for, or ""."""
    return F.when(short.isin("", *NO_COMPANY), "").when(raw.isin(*COMPANY_AS_IT_IS), raw).otherwise(short)


def companies(text: Column) -> Column:
    """Companies of a list, without bracketed parts, company forms and a leading `The`; null has none."""
    return F.filter(F.transform(company_parts(F.coalesce(text, F.lit(""))), lambda p: company(p["raw"], p["short"])), lambda p: p != "")


def people(text: Column) -> Column:
    """People of `by A and B`, `A & B`, `A + B`, `Ann and Bob Smith` (a shared surname) and `handle-handle`.

    A hyphen parts two people inside a name of several words on both sides and in handles without blanks, and stays in a
    first name before a surname.
    """
    shared = r"^(.+?)\s+and\s+(\S+)\s+(\S+)$"

    def cut(part: Column) -> Column:
        inner = F.split(F.regexp_replace(part, r"(\s\S+)-(\S+\s)", "$1\u0001$2"), "\u0001")
        return F.when(part.rlike(r".*\s\S+-\S+\s.*"), inner).when(part.rlike(r".*-.*\s+.*"), F.array(part)).otherwise(F.split(part, "-"))

    def listed(bare: Column) -> Column:
        surname = F.regexp_extract(bare, shared, 3)
        both = F.array(*[F.concat_ws(" ", F.regexp_extract(bare, shared, i), surname) for i in (1, 2)])
        parts = F.flatten(F.transform(F.split(bare, r"\s*[+&]\s*|\s+and\s+"), lambda p: cut(p)))
        apart = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")
        return F.when(bare == "Full-FX", F.array(bare)).when(surname != "", both).otherwise(apart)

    return _let(F.regexp_replace(F.coalesce(text, F.lit("")), r"^by\s+", ""), listed)


def file_album(path: Column) -> Column:
    """Album inside a file name `mod.(Album).gz`: brackets off, `_` as a blank; "" if there is none or only digits and blanks."""
    name = F.element_at(F.split(path, "/"), -1)
    inner = F.regexp_replace(F.regexp_replace(F.element_at(F.split(name, r"\.\("), -1), r"\).*", ""), r"\(", "")
    album = F.trim(F.regexp_replace(F.translate(inner, "_", " "), r"( \[DFC\]| - DFC| DFC)$", ""))
    kind = F.get(F.split(name, r"\."), F.lit(0))
    usable = name.rlike(r"^\w+\.\([a-zA-Z0-9].*\).*") & (F.length(album) > 1) & ~(album.contains(" ") & F.regexp_replace(album, " ", "").rlike("^[0-9]+$")) & (album != kind)
    return F.when(usable, album).otherwise("")


def event_year(comment: Column) -> Column:
    """Year that a comment's yearly event tells by its number (`party iii`, `the party 4`, ` party-5`), or 0."""
    low = F.lower(comment)
    named = (low.contains(" the party ") | low.contains(" party-")) & ~low.contains(" report")
    digit = F.coalesce(*[F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for p in (r"^.+? the party (.)", r"^.+? party-(.)")])
    by_digit = F.when(digit.rlike("^[0-9]$"), digit.cast("int") + 1990).otherwise(0)
    year = by_digit
    for words, y in reversed(ROMAN_YEARS):
        year = F.when(low.contains(words), y).otherwise(year)
    return F.coalesce(F.when(named, year), F.lit(0))


def tells_of_event(comment: Column) -> Column:
    """Whether a comment tells of a competition or party."""
    low = F.lower(F.coalesce(comment, F.lit("")))
    some = reduce(lambda a, b: a | b, [low.contains(w) for w in EVENT_WORDS], low.contains("compo") & ~low.contains("compose"))
    return some & ~reduce(lambda a, b: a | b, [low.contains(w) for w in NO_EVENT_WORDS])


#: Beginnings of catalogue paths whose people aren't to be trusted (fixed values).
UNSURE_PEOPLE = (
    "Games - AON", "Games - BP", "Games - FRED", "Games - MED", "Games - MOD", "Music - Games - ML", "Music - Games - OKT", "Music - Games - Covers", "Music - Games - Cracktro",
)
#: Formats of demos that tell a PC, signs of a machine that are no publisher, and names with a form of their own (fixed values).
PC_DEMOS = ("Demos - XM", "Demos - 669", "Demos - IT", "Demos - S3M")
_MACHINE = "^(AGA|ECS|OCS|CD32|CDTV)$"
ALBUM_NAMES = {"deathtrap": "Death Trap"}
_NOBODY = "array<string>"


def _sorted(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: F.trim(v) != "")))


def music_path(path: Column) -> Column:
    """Struct (authors, composers, publishers, album, year, type, platform) of a catalogue path of music files.

    Round brackets hold the year (the first that begins with four digits), publishers, and in scene music authors; `A of B`
    is an author and a group; square ones hold `cmp` composers and `seq` authors, who lose `of B` where a publisher is
    named.  The album is the file's name up to ` - ` or a bracket.  Covers tell people only, scene music no album.  Composers
    are the authors where there are none.  A single author that ends with a year is a remix of that year.
    """
    none = F.array().cast(_NOBODY)
    of_group = r"^(.+?)\s+of\s+(.+)$"
    both = r"\[cmp ([^-]+)-\s*seq ([^\]]+)\]"

    def people_of(s: Column, who: Column) -> Column:
        return people(F.when(s["published"], F.regexp_replace(F.trim(who), r"\s+of\s+.+$", "")).otherwise(F.trim(who)))

    def brackets(s: Column) -> dict[str, Column]:
        return {"held": F.when(s["covers"], none).otherwise(F.regexp_extract_all(s["path"], F.lit(r"\(([^)]+)\)"), 1))}

    def years(s: Column) -> dict[str, Column]:
        dated = F.filter(s["held"], lambda g: g.rlike(r"^\d{4}") & ~F.lower(g).contains("x"))
        others = F.filter(s["held"], lambda g: ~g.rlike(r"^(\d{4}|\d{2}xx|\d{3}x)") & ~g.startswith("cmp ") & (g != "-") & ~g.rlike(_MACHINE))
        return {"year": F.coalesce(F.substring(F.get(dated, F.lit(0)), 1, 4).cast("int"), F.lit(0)), "others": others}

    def groups(s: Column) -> dict[str, Column]:
        def publishers(g: Column) -> Column:
            listed = F.transform(F.split(g, r"\s+(?:and|&)\s+|\s+-\s+"), lambda x: F.trim(x))
            return F.when(g.rlike(of_group), F.array(F.regexp_extract(g, of_group, 2))).when(s["scene"], none).when(g == "Share and Enjoy", F.array(g)).otherwise(listed)

        def authors(g: Column) -> Column:
            who = F.when(g.rlike(of_group), F.regexp_extract(g, of_group, 1)).when(s["scene"], g).otherwise("")
            return people(who)

        return {
            "published": F.exists(s["others"], lambda g: ~g.rlike(of_group)),
            "publishers": F.flatten(F.transform(s["others"], lambda g: publishers(g))),
            "authors": F.flatten(F.transform(s["others"], lambda g: authors(g))),
        }

    def composers(s: Column) -> dict[str, Column]:
        singles = F.flatten(F.transform(F.concat(*[F.regexp_extract_all(s["path"], F.lit(p), 1) for p in (r"\[cmp ([^\]]+)\]", r"\(cmp ([^)]+)\)")]), lambda c: people_of(s, c)))
        pair = s["path"].rlike(both)
        first = people_of(s, F.regexp_extract(s["path"], both, 1))
        second = people_of(s, F.regexp_extract(s["path"], both, 2))
        return {"composers": F.when(pair, first).otherwise(singles), "authors": F.when(pair, F.concat(second, s["authors"])).otherwise(s["authors"])}

    def authors(s: Column) -> dict[str, Column]:
        sequenced = people_of(s, F.regexp_extract(s["path"], r"\[seq ([^\]]+)\]", 1))
        return {"authors": F.when(F.size(s["authors"]) > 0, s["authors"]).otherwise(sequenced)}

    def fallback(s: Column) -> dict[str, Column]:
        is_jmp = (F.size(s["publishers"]) == 1) & (F.get(s["publishers"], F.lit(0)) == "JMP")
        some = F.when(F.size(s["authors"]) > 0, s["authors"]).otherwise(s["composers"])
        return {"authors": F.when(is_jmp, F.concat(some, F.array(F.lit("JMP")))).otherwise(some), "publishers": F.when(is_jmp, none).otherwise(s["publishers"])}

    def albums(s: Column) -> dict[str, Column]:
        head = F.regexp_extract(s["file"], r"^(.+?) - ", 1)
        bare = F.trim(F.when(head != "", F.regexp_replace(head, r"[(\[].*$", "")).otherwise(F.regexp_extract(s["file"], r"^([^/]+?)\s*\(", 1)))
        return {"bare": bare, "first": F.when(F.size(s["authors"]) == 1, F.get(s["authors"], F.lit(0))).otherwise("")}

    def shown(s: Column) -> dict[str, Column]:
        title = F.trim(F.regexp_replace(s["bare"], r"^(.+?),\s*(The|A|An|Les?|La|L'|Der)\b(.*)", "$2 $1$3"))
        for plain, own in ALBUM_NAMES.items():
            title = F.when(s["bare"] == plain, own).otherwise(title)
        remix = s["first"].rlike(r"\(\d{4}\)$")
        album = F.when(remix | s["scene"] | s["covers"] | (title == ""), "").when(s["cracktro"], F.concat(title, F.lit(" [cracktro]"))).otherwise(title)
        unsure = reduce(lambda a, b: a | b, [s["path"].startswith(p) for p in UNSURE_PEOPLE], s["file"].startswith("ZZZ"))
        who = F.when(remix, F.array(F.trim(F.regexp_replace(s["first"], r"\(\d{4}\)$", "")))).when(s["first"] == "Fire by HMW", F.array(F.lit("HMW"))).otherwise(s["authors"])
        game = s["path"].contains("Games -") & ~s["scene"] & ~s["covers"] & ~s["cracktro"]
        on_pc = reduce(lambda a, b: a | b, [s["path"].contains(p) for p in PC_DEMOS])
        return {
            "album": album, "year": F.when(remix, F.regexp_extract(s["first"], r"\((\d{4})\)$", 1).try_cast("int")).otherwise(s["year"]),
            "authors": F.when(unsure, none).otherwise(_sorted(who)), "composers": _sorted(s["composers"]), "publishers": F.when(remix, none).otherwise(_sorted(s["publishers"])),
            "type": F.when(game, "Game").when(s["path"].contains("Demos -"), "Demo").otherwise(""),
            "platform": F.when(on_pc, "PC").when(s["path"].contains("Demos - ") | game, "Amiga").otherwise(""),
        }

    begin = F.struct(
        path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("file"),
        *[path.startswith(f"Music - {x}").alias(n) for n, x in (("scene", "Scene"), ("covers", "Games - Covers"), ("cracktro", "Games - Cracktro"))],
    )
    done = _grown(begin, brackets, years, groups, composers, authors, fallback, albums, shown)
    return _let(done, lambda s: F.struct(*[s[f].alias(f) for f in ("authors", "composers", "publishers", "album", "year", "type", "platform")]))


def mined(patterns: Sequence[tuple[str, int]]):
    """Arrow function for long tables of ordered (pattern, group): the first that matches a text gives its group, else "".

    Patterns are compiled once per worker; texts are looked at once per distinct value of a batch.
    """

    @F.pandas_udf(T.StringType())
    def first(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compiled = [(re.compile(p), g) for p, g in patterns]

        def one(text: str) -> str:
            for pattern, group in compiled:
                if found := pattern.search(text):
                    return (found.group(group) or "").strip()
            return ""

        for batch in texts:
            known = {t: one(t) for t in batch.dropna().unique()}
            yield batch.map(known).fillna("").astype(object)

    return first


def routed(links: DataFrame, url: str, kind: str, rules: DataFrame) -> DataFrame:
    """``links`` with index and key: the first rule whose class and pattern a link fits, and what is left of its url.

    ``rules`` (place int, class, pattern, strip, index) are few and asked for first: class "" fits all; strip is taken off
    the decoded url, whose double slashes become single.  Links that fit none have null.
    """
    table = [r.asDict() for r in rules.orderBy("place").collect()]
    if len(table) > 1000:
        raise ValueError("at most 1000 rules, which become part of the plan")
    fits = [((F.col(kind) == r["class"]) if r["class"] else F.lit(True)) & F.col(url).rlike(r["pattern"]) for r in table]
    index = key = F.lit(None).cast("string")
    for fit, r in zip(reversed(fits), reversed(table), strict=True):
        left = F.regexp_replace(F.regexp_replace(F.col(url), r["strip"], ""), "//+", "/")
        index, key = F.when(fit, F.lit(r["index"])).otherwise(index), F.when(fit, left).otherwise(key)
    return links.withColumn("index", index).withColumn("key", key)
