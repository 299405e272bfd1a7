"""What all records of all sources tell together, and filling gaps from it: dependencies, existence, conditional fills.

A record has the fields of :mod:`fusion`.  Facts are told by keys: ``akey`` (normalised album), ``simple`` (letters and
digits of the album without bracketed parts), ``firms`` and ``names`` (normalised publishers and authors, sorted and
distinct) and ``kind`` (normalised type).  Unknown is "", 0 or an empty array, and counts as a value of its own where a
dependency is told.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..plans.storage import store
from .fusion import FIELDS, _filled

#: Oldest years that count by type and platform: below them (or at them, for games) a record is wrong (fixed values).
OLDEST = (("game", "PC", 1992), ("", "PC", 1990), ("", "Atari", 1988))
#: Publishers that are no scene groups whatever they released, and some that always are (fixed values).
NO_SCENE = (
    "Binary Emotions", "Diamond Software", "Edge", "Frontier Software", "Imageworks", "Kalisto", "New Deal", "Ocean", "Ocean Software", "Psygnosis",
    "Rainbow Arts", "Starbyte", "Thalion", "Unique Development Sweden",
)
ALWAYS_SCENE = ("Cultural Productions", "Flash", "Impact Software", "Realms Developments", "Retroguru", "Soy", "Vanquish", "Zonk")
#: Parts of format names that tell a platform; formats and players that tell none (fixed values).
ATARI_FORMATS = (" ST ", "TCB Tracker", "YM2149", " PSG", "Octalyser", "Graoumf", "Digital Tracker", "Megatracker")
AMIGA_FORMATS = (
    "DigiBooster", "DIGI Booster", "OctaMED", "MED ", "Future Composer", "Face The Music", "Symphonie", "UNIC Tracker", "SoundFX", "Images Music System",
    "Ice Tracker", "Game Music Creator", "Startrekker", "IFFMODL", "Slamtilt", "Magnetic Fields Packer", "His Master's Noise", "AMOS Music Bank",
    "Prorunner", "The Player", "ProPacker", "NoisePacker", "Kefrens", "Titanics", "Pha Packer", "Wanton Packer", "Fuchs Tracker", "Eureka Packer",
    "Promizer", "AC1D Packer", "The Dark Demon",
)
SHARED_FORMATS = ("POKEYNoise", "Archimedes Tracker", "Coconizer", "Blade Packer")
SHARED_LOW = ("soundtracker", "noisetracker", "protracker", "oktalyzer")
SHARED_EXACT = ("Jochen Hippel", "Jochen Hippel COSO", "PumaTracker", "TFMX", "TFMX Pro", "Howie Davies", "Special FX")
SHARED_PLAYERS = ("hivelytracker", "ft2play")

_STRINGS = "array<string>"


def _canon(values: Column, normal: Callable[[Column], Column]) -> Column:
    return F.array_sort(F.array_distinct(F.transform(values, lambda v: normal(v))))


def keyed(records: DataFrame) -> DataFrame:
    """``records`` with akey, simple, firms, names and kind; unknown fields are empty values."""
    rows = _filled(records)
    album = text.normalize_album(F.col("album"), F.col("type"), F.col("publishers"), F.col("year"))
    return rows.select(
        "*", album.alias("akey"), text.normalize_album_simple(F.col("album")).alias("simple"),
        _canon(F.col("publishers"), text.normalize_publisher).alias("firms"),
        _canon(F.col("authors"), lambda a: text.normalize_author(a, folded=False)).alias("names"), text.normalize_type(F.col("type")).alias("kind"),
    )


def sane(records: DataFrame) -> DataFrame:
    """Records without those older than their platform, and without those that know one thing only (authors aside)."""
    wrong = F.lit(False)
    for kind, platform, year in OLDEST:
        of_kind = F.lower("type") == kind if kind else F.lit(True)
        wrong = wrong | (of_kind & (F.col("platform") == platform) & (F.col("year") > 0) & (F.col("year") < year))
    facts = [(F.size("publishers") > 0).cast("int"), (F.col("album") != "").cast("int"), (F.col("year") != 0).cast("int")]
    bare = (F.size("authors") == 0) & (reduce(lambda a, b: a + b, facts) <= 1)
    return _filled(records).filter(~wrong & ~bare)


def scrub_unreliable(doubtful: DataFrame, known: DataFrame) -> DataFrame:
    """``doubtful`` (keyed) without years and publishers that ``known`` (keyed) records of the same album contradict.

    A year goes if some record of the album shares a publisher but has another known year; publishers go if some record
    of the album lacks one of them.  Only records with album and publishers are compared; both tests see the given values.
    """
    facts = known.filter((F.size("publishers") > 0) & (F.col("album") != "")).groupBy("akey").agg(F.collect_set(F.struct("firms", "year")).alias("__facts"))
    rows = doubtful.join(facts, "akey", "left").select(*doubtful.columns, "__facts")
    able = (F.col("album") != "") & (F.size("publishers") > 0) & F.col("__facts").isNotNull()
    other_year = F.exists("__facts", lambda f: F.arrays_overlap(f["firms"], F.col("firms")) & (f["year"] != F.col("year")) & (f["year"] != 0))
    other_firm = F.exists("__facts", lambda f: F.size(F.array_except("firms", f["firms"])) > 0)
    no_year, no_firms = able & (F.col("year") != 0) & other_year, able & other_firm
    none = F.array().cast(_STRINGS)
    new = {"year": F.when(no_year, 0).otherwise(F.col("year")), "publishers": F.when(no_firms, none).otherwise(F.col("publishers")), "firms": F.when(no_firms, none).otherwise(F.col("firms"))}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in doubtful.columns])


def knowledge_base(reliable: DataFrame, doubtful: DataFrame | None = None) -> DataFrame:
    """Distinct records of all sources without their hashes, keyed: doubtful ones scrubbed first, none that can't be."""
    base = keyed(reliable.select(*FIELDS).distinct()).distinct()
    if doubtful is not None:
        base = base.union(scrub_unreliable(keyed(doubtful.select(*FIELDS).distinct()), base).select(*base.columns)).distinct()
    return sane(base)


def scene_groups(base: DataFrame) -> DataFrame:
    """(publisher): publishers of dated kinds that are no games, but for known companies; some always."""
    mine = base.filter((F.col("type") != "") & (F.lower("type") != "game") & (F.col("album") != "")).select(F.explode("publishers").alias("publisher"))
    always = base.sparkSession.createDataFrame([(p,) for p in ALWAYS_SCENE], "publisher string")
    return mine.filter(~F.col("publisher").isin(*NO_SCENE)).union(always).distinct()


def blank_compilations(records: DataFrame, least: int = 5) -> DataFrame:
    """``records`` where a publishers and album that ``least`` or more authors share lose publishers, album, type, platform, year.

    So do those that as many records share without naming an author.  Records without publishers and album stay.
    """
    rows = _filled(records).withColumn("__p", F.array_join(F.array_sort("publishers"), ","))
    named = rows.filter((F.col("__p") != "") | (F.col("album") != ""))
    authors = named.select("__p", "album", F.explode("authors").alias("__a")).filter("__a <> ''").groupBy("__p", "album").agg(F.count_distinct("__a").alias("__n"))
    many = named.groupBy("__p", "album").agg(F.count("*").alias("__rows")).join(authors, ["__p", "album"], "left")
    bad = many.filter((F.coalesce("__n", F.lit(0)) >= least) | (F.col("__n").isNull() & (F.col("__rows") >= least))).select("__p", "album", F.lit(True).alias("__bad"))
    blank = {"publishers": F.array().cast(_STRINGS), "album": F.lit(""), "type": F.lit(""), "platform": F.lit(""), "year": F.lit(0)}
    joined = rows.join(bad, ["__p", "album"], "left")
    return joined.select(*[F.when(F.col("__bad"), blank[c]).otherwise(F.col(c)).alias(c) if c in blank else F.col(c) for c in records.columns])


@dataclass(frozen=True)
class Relation:
    """``value`` is told by album and ``key`` where only one value occurs; ``steady``: and only one year does."""

    name: str
    key: tuple[str, ...]
    value: str
    needs: tuple[str, ...]
    steady: bool = False
    games: bool = False
    cracktros: bool = False


#: What depends on what; each is told once by the full album key and once by the simple one.
RELATIONS = (
    Relation("type", (), "type", ("type",)),
    Relation("platform", (), "platform", ("platform",)),
    Relation("year", ("kind", "platform"), "year", ("type", "platform", "year")),
    Relation("year_of_firms", ("kind", "platform", "firms"), "year", ("type", "platform", "publishers", "year")),
    Relation("publishers", ("kind", "platform", "year"), "publishers", ("type", "platform", "year")),
    Relation("authors_of_firms", ("firms", "platform", "kind"), "authors", ("publishers", "platform", "type"), cracktros=True),
    Relation("authors_of_year", ("year", "platform", "kind"), "authors", ("year", "platform", "type"), cracktros=True),
    Relation("platform_of_type", ("kind",), "platform", ("type", "platform"), steady=True, cracktros=True),
    Relation("type_of_platform", ("platform",), "type", ("type", "platform"), steady=True, cracktros=True),
    Relation("year_of_game", (), "year", ("year",), games=True, cracktros=True),
)


def _known(field: str) -> Column:
    return F.size(field) > 0 if field in ("publishers", "authors") else (F.col(field) > 0 if field == "year" else F.col(field) != "")


def dependency_map(base: DataFrame, relation: Relation, simple: bool = False) -> DataFrame:
    """(key columns, value) of one relation over a keyed knowledge base; set values give their longest form."""
    album = "simple" if simple else "akey"
    rows = base.filter(reduce(lambda a, b: a & b, [_known(f) for f in relation.needs], F.col("album") != ""))
    if relation.games:
        rows = rows.filter("kind = 'Game'")
    if not relation.cracktros:
        rows = rows.filter(~text.is_cracktro(F.col("type")))
    v = {"publishers": F.col("firms"), "authors": F.array_sort(F.array_distinct("authors"))}.get(relation.value, F.col(relation.value))
    longest = F.aggregate(relation.value, F.lit(0), lambda n, x: n + F.length(x)) if relation.value in ("publishers", "authors") else F.lit(0)
    shown = F.col("kind") if relation.name == "type_of_platform" else F.col(relation.value)
    told = rows.groupBy(album, *relation.key).agg(
        F.min(v).alias("__lo"), F.max(v).alias("__hi"), F.min("year").alias("__ylo"), F.max("year").alias("__yhi"),
        F.min(F.struct((-longest).alias("n"), shown.alias("v"))).alias("__m"),
    )
    one = F.col("__lo") == F.col("__hi")
    return told.filter(one & (F.col("__ylo") == F.col("__yhi")) if relation.steady else one).select(album, *relation.key, F.col("__m.v").alias(relation.value))


def dependency_maps(base: DataFrame) -> dict[tuple[str, bool], DataFrame]:
    """All relations by (name, simple): twenty maps of ten relations and two album keys."""
    return {(r.name, simple): dependency_map(base, r, simple) for r in RELATIONS for simple in (False, True)}


def platform_of_formats(formats: Column, players: Column) -> Column:
    """Platform that a hash's format and player names (arrays) tell, or ""."""

    def some(test: Callable[[Column], Column]) -> Column:
        return F.exists(formats, test)

    def held(parts: Sequence[str], low: bool = False) -> Callable[[Column], Column]:
        return lambda f: reduce(lambda a, b: a | b, [(F.lower(f) if low else f).contains(p) for p in parts])

    atari = some(lambda f: f.endswith("ST") | held(ATARI_FORMATS)(f))
    amiga = some(lambda f: held(AMIGA_FORMATS)(f) | F.lower(f).contains("chiptracker"))
    shared = some(lambda f: held(SHARED_LOW, True)(f) | f.endswith("SID") | held(SHARED_FORMATS)(f) | f.isin(*SHARED_EXACT)) | F.exists(players, lambda p: p.isin(*SHARED_PLAYERS))
    by_player = F.when(F.array_contains(players, "uade"), "Amiga").when(F.exists(players, lambda p: p != ""), "PC").otherwise("")
    return F.when(atari, "Atari").when(amiga, "Amiga").when(shared, "").otherwise(by_player)


def impute(records: DataFrame, base: DataFrame, scene: Sequence[str] = (), again: bool = True) -> DataFrame:
    """``records`` (with formats and players, arrays) with unknown fields deduced from a knowledge base, in a fixed order.

    Platform by formats, by (album, type), by album; type by (album, platform), by album; year by (album, type, platform)
    or, of games, by album, unless the publishers known for it are others; year with publishers; publishers; authors with
    publishers, then with the year.  Each map is asked by the full album key first and by the simple one next.  Without
    ``again`` only games that no scene group published get platform and year.
    """
    maps = {name: store(table, "map") for name, table in dependency_maps(base).items()}
    groups = F.array(*[F.lit(g) for g in scene]).cast(_STRINGS)
    rows = keyed(records).withColumn("__known_firms", F.col("firms"))
    game = (F.col("kind") == "Game") & ((F.size("publishers") == 0) | F.exists("publishers", lambda p: ~F.array_contains(groups, p)))
    rows = rows.withColumn("__game", game).withColumn("__allowed", F.lit(again) | game)
    by_formats = platform_of_formats(F.coalesce("formats", F.array().cast(_STRINGS)), F.coalesce("players", F.array().cast(_STRINGS)))
    rows = rows.withColumn("platform", F.when((F.col("platform") == "") & F.col("__allowed"), by_formats).otherwise(F.col("platform")))

    def unknown(field: str) -> Column:
        return F.size(field) == 0 if field in ("publishers", "authors") else (F.col(field) == 0 if field == "year" else F.col(field) == "")

    def ask(rows: DataFrame, name: str, simple: bool, when: Column, into: str | None = None) -> DataFrame:
        """``rows`` with the relation's value where it is unknown, or with it as column ``into``."""
        relation = next(r for r in RELATIONS if r.name == name)
        album = "simple" if simple else "akey"
        known = maps[name, simple].withColumnsRenamed({c: f"__k{i}" for i, c in enumerate((album, *relation.key))}).withColumnRenamed(relation.value, "__told")
        on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k{i}") for i, c in enumerate((album, *relation.key))])
        joined = rows.join(known, on & when & (F.col("album") != ""), "left")
        if into:
            return joined.select(*rows.columns, F.col("__told").alias(into))
        value = F.when(unknown(relation.value) & F.col("__told").isNotNull(), F.col("__told")).otherwise(F.col(relation.value))
        return joined.select(*[value.alias(c) if c == relation.value else F.col(c) for c in rows.columns])

    def rekinded(rows: DataFrame) -> DataFrame:
        return rows.withColumn("kind", text.normalize_type(F.col("type")))

    for name, when in (("platform_of_type", F.col("type") != ""), ("platform", F.lit(True))):
        for simple in (False, True):
            rows = ask(rows, name, simple, (F.col("platform") == "") & F.col("__allowed") & when)
    if again:
        for name, when in (("type_of_platform", F.col("platform") != ""), ("type", F.lit(True))):
            for simple in (False, True):
                rows = ask(rows, name, simple, (F.col("type") == "") & when)
    rows = rekinded(rows)
    both = (F.col("type") != "") & (F.col("platform") != "")
    for simple in (False, True):
        open_ = (F.col("year") == 0) & F.col("__allowed") & ((F.col("type") != "") | (F.col("platform") != ""))
        rows = rows.withColumn("__open", open_)
        rows = ask(rows, "year", simple, F.col("__open") & both)
        rows = ask(rows, "year_of_game", simple, F.col("__open") & (F.col("year") == 0) & (F.col("type") != "") & F.col("__game"))
        rows = ask(rows, "publishers", simple, F.col("__open") & (F.col("year") != 0) & both, "__firms_of_year")
        theirs = F.transform(F.coalesce("__firms_of_year", F.array().cast(_STRINGS)), lambda p: text.normalize_publisher(p))
        agree = (F.size("firms") == 0) | (F.size(theirs) == 0) | F.arrays_overlap(theirs, "firms")
        rows = rows.withColumn("year", F.when(F.col("__open") & ~agree, 0).otherwise(F.col("year"))).drop("__firms_of_year", "__open")
    for simple in (False, True):
        rows = ask(rows, "year_of_firms", simple, (F.col("year") == 0) & both & (F.size("publishers") > 0))
    for simple in (False, True):
        rows = ask(rows, "publishers", simple, (F.size("publishers") == 0) & (F.col("year") != 0) & both)
    rows = rows.withColumn("firms", _canon(F.col("publishers"), text.normalize_publisher))
    for simple in (False, True):
        rows = ask(rows, "authors_of_firms", simple, (F.size("authors") == 0) & both & (F.size("publishers") > 0))
    for simple in (False, True):
        rows = ask(rows, "authors_of_year", simple, (F.size("authors") == 0) & both & (F.col("year") != 0))
    return rows.select(*records.columns)


#: Existence relations: distinct tuples of known fields; ``no album``: of records without one.
EXISTENCE = {
    "year_album_firms": (("year", "akey", "firms"), ("year", "album", "publishers"), False),
    "year_album": (("year", "akey"), ("year", "album"), False),
    "album_firms": (("akey", "firms"), ("album", "publishers"), False),
    "names_album_firms": (("names", "akey", "firms"), ("authors", "album", "publishers"), False),
    "names_album_year": (("names", "akey", "year"), ("authors", "album", "year"), False),
    "names_year_firms": (("names", "year", "firms"), ("authors", "year", "publishers"), False),
    "names_year": (("names", "year"), ("authors", "year"), True),
    "names_firms": (("names", "firms"), ("authors", "publishers"), True),
}


def existence(base: DataFrame, name: str) -> DataFrame:
    """Distinct tuples of one existence relation over a keyed knowledge base.

    ``steady_year`` is (year, akey, kind, platform) of albums with one year and at most one set of publishers per kind and platform.
    """
    if name == "steady_year":
        rows = base.filter(_known("album") & _known("year") & _known("type") & _known("platform") & ~text.is_cracktro(F.col("type")))
        firms = F.when(F.size("firms") > 0, F.col("firms"))
        told = rows.groupBy("akey", "kind", "platform").agg(F.min("year").alias("year"), F.max("year").alias("__y"), F.min(firms).alias("__lo"), F.max(firms).alias("__hi"))
        return told.filter((F.col("year") == F.col("__y")) & (F.col("__lo").isNull() | (F.col("__lo") == F.col("__hi")))).select("year", "akey", "kind", "platform")
    columns, needs, no_album = EXISTENCE[name]
    rows = base.filter(reduce(lambda a, b: a & b, [_known(f) for f in needs], F.col("album") == "" if no_album else F.lit(True)))
    return rows.select(*columns).distinct()


_STEADY = "struct<year:int,kind:string,platform:string>"
_RECORD_TYPE = "struct<publishers:array<string>,album:string,year:int,type:string,platform:string,firms:array<string>,akey:string>"


def _record() -> Column:
    return F.struct(*[F.col(f).cast("int").alias(f) if f == "year" else F.col(f) for f in ("publishers", "album", "year", "type", "platform", "firms", "akey")])


def _token(kind: str, *parts: Column) -> Column:
    """A tuple as a string that no other has: all parts but the last are led by their length."""
    *first, last = (p.cast("string") for p in parts)
    led = [x for p in first for x in (F.length(p).cast("string"), F.lit(":"), p)]
    return F.concat(F.lit(kind), *led, last)


def _tuples(years: Column, firms: Column, names: Column) -> Column:
    """Tokens of each year (y), firm (f), year and firm (b), name and firm (p), year and name (m)."""
    one = [F.transform(years, lambda y: _token("y", y)), F.transform(firms, lambda x: _token("f", x))]
    two = [F.transform(years, lambda y: F.transform(firms, lambda x: _token("b", y, x))), F.transform(names, lambda n: F.transform(firms, lambda x: _token("p", n, x)))]
    return F.array_distinct(F.concat(*one, *[F.flatten(t) for t in (*two, F.transform(years, lambda y: F.transform(names, lambda n: _token("m", y, n))))]))


def _told(base: DataFrame) -> DataFrame:
    """(key, tokens, steady): tuples of year, firm and name that the base has of an album (key a...) or of a name (n...).

    Of a name, years and firms alone count in records without an album.
    """
    year, none = F.array(F.col("year").cast("int").cast("string")), F.array().cast(_STRINGS)
    albums = base.filter(_known("album")).select("akey", F.explode(_tuples(year, F.col("firms"), F.col("names"))).alias("t")).groupBy("akey").agg(F.collect_set("t").alias("tokens"))
    steady = existence(base, "steady_year").groupBy("akey").agg(F.collect_set(F.struct(F.col("year").cast("int").alias("year"), "kind", "platform")).alias("steady"))
    of_albums = albums.join(steady, "akey", "left").select(F.concat(F.lit("a"), "akey").alias("key"), "tokens", F.coalesce("steady", F.array().cast(f"array<{_STEADY}>")).alias("steady"))
    mine = F.filter(_tuples(year, F.col("firms"), none), lambda t: (F.col("album") == "") | t.startswith("b"))
    by_name = base.filter(_known("authors")).select(F.explode("names").alias("n"), mine.alias("ts")).select("n", F.explode("ts").alias("t"))
    of_names = by_name.groupBy("n").agg(F.collect_set("t").alias("tokens")).select(F.concat(F.lit("n"), "n").alias("key"), "tokens", F.array().cast(f"array<{_STEADY}>").alias("steady"))
    return of_albums.union(of_names)


def _asked() -> list[Column]:
    """Keys, tokens and years that a hash's own records can ask for."""
    years = F.array_distinct(F.concat(F.transform("__all", lambda r: r["year"]), F.array(F.col("year").cast("int"))))
    firms = F.array_distinct(F.concat(F.flatten(F.transform("__all", lambda r: r["firms"])), F.col("firms")))
    keys = F.concat(F.transform("__all", lambda r: r["akey"]), F.array(F.col("akey")))
    every = F.array_distinct(F.concat(F.transform(keys, lambda k: F.concat(F.lit("a"), k)), F.transform("names", lambda n: F.concat(F.lit("n"), n))))
    return [every.alias("__keys"), _tuples(F.transform(years, lambda y: y.cast("string")), firms, F.col("names")).alias("__asked"), years.alias("__years")]


def _kept_of_hashes(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(hash, __known): of the albums and names of a hash's records, the tuples that its own years, firms and names ask for."""
    met = rows.select("hash", *_asked()).select("hash", "__asked", "__years", F.explode("__keys").alias("key")).join(known, "key")
    kept = F.struct("key", F.array_intersect("tokens", "__asked").alias("tokens"), F.filter("steady", lambda f: F.array_contains("__years", f["year"])).alias("steady"))
    return met.select("hash", kept.alias("k")).groupBy("hash").agg(F.collect_list("k").alias("__known"))


def fill_conditionally(held: DataFrame, sources: DataFrame, base: DataFrame) -> DataFrame:
    """``held`` (one record per hash) with gaps filled from the hash's own ``sources`` where the knowledge base has met the result.

    Seventeen rules run one after the other, each over the hash's sources in order of priority: year and album together,
    album and publishers, album alone, publishers, year, and so on.  What a rule may take depends on tuples that occur in
    the base: an album brings the (year, firms, names) it occurs with, a hash its authors' (year, firms).  Rules on
    publishers don't trust competitions and parties.  All is one fold per hash over at most one record per source.

    A base's tuples are told once by album and by name, and a hash keeps those only that its own years, firms and names ask for.
    """
    known = store(_told(base), "told")
    given = keyed(sources).groupBy("hash").agg(F.array_sort(F.collect_list(F.struct("priority", _record().alias("r")))).alias("__all"))
    no_records = F.array().cast(f"array<struct<priority:int,r:{_RECORD_TYPE}>>")
    rows = keyed(held).join(given, "hash", "left").withColumn("__all", F.transform(F.coalesce("__all", no_records), lambda x: x["r"]))
    of_hash = _kept_of_hashes(rows, known)
    joined = rows.join(of_hash, "hash", "left")
    no_steady, no_tokens = F.array().cast(f"array<{_STEADY}>"), F.array().cast(_STRINGS)

    def with_facts(r: Column) -> Column:
        """A record with the tokens and the steady years of its album, as far as the hash asks for them."""
        mine = F.get(F.filter("__known", lambda k: k["key"] == F.concat(F.lit("a"), r["akey"])), F.lit(0))
        added = [F.coalesce(mine["tokens"], no_tokens).alias("facts"), F.coalesce(mine["steady"], no_steady).alias("steady")]
        return F.struct(*[r[f].alias(f) for f in fields[:-2]], *added)

    fields = ("publishers", "album", "year", "type", "platform", "firms", "facts", "steady")
    told = F.coalesce(F.flatten(F.transform(F.filter("__known", lambda k: k["key"].startswith("n")), lambda k: k["tokens"])), no_tokens)

    def firm(r: Column) -> Column:
        return F.size(r["publishers"]) > 0

    def trusted(s: Column) -> Column:
        return firm(s) & (s["type"] != "Compo") & ~F.get(s["publishers"], F.lit(0)).endswith(" Party")

    def dated_by(of: Column, year: Column, r: Column) -> Column:
        return F.exists(r["firms"], lambda x: F.array_contains(of, _token("b", year, x)))

    def in_year(of: Column, year: Column) -> Column:
        return F.array_contains(of, _token("y", year))

    def shares(of: Column, r: Column) -> Column:
        return F.exists(r["firms"], lambda x: F.array_contains(of, _token("f", x)))

    def names_share(of: Column, r: Column) -> Column:
        return F.exists("names", lambda n: F.exists(r["firms"], lambda x: F.array_contains(of, _token("p", n, x))))

    def names_in(of: Column, year: Column) -> Column:
        return F.exists("names", lambda n: F.array_contains(of, _token("m", year, n)))

    def like(s: Column, m: Column, field: str) -> Column:
        a, b = s[field], m[field]
        same = F.lower(a) == F.lower(b) if field == "platform" else text.normalize_type(a) == text.normalize_type(b)
        return ((a != "") & ((b == "") | same)) | ((b != "") & ((a == "") | same))

    def either(s: Column, m: Column, field: str) -> Column:
        return F.when(s[field] != "", s[field]).otherwise(m[field])

    def steady(of: Column, year: Column, s: Column, m: Column) -> Column:
        return F.exists(of, lambda f: (f["year"] == year) & (f["kind"] == text.normalize_type(either(s, m, "type"))) & (f["platform"] == either(s, m, "platform")))

    has_names = F.size("authors") > 0
    album, firms_of, dated = ("album", "facts", "steady", "type", "platform"), ("publishers", "firms"), ("year",)
    both = lambda m: (m["year"] != 0) & (m["album"] != "")
    rules = [
        (lambda s, m: (s["year"] == 0) & (s["album"] == "") & both(m) & trusted(s) & dated_by(m["facts"], m["year"], s), (*album, *dated)),
        (lambda s, m: (s["year"] == 0) & (s["album"] == "") & both(m) & ~firm(s) & in_year(m["facts"], m["year"]), (*album, *dated)),
        (lambda s, m: (s["album"] == "") & ~firm(s) & (m["album"] != "") & firm(m) & (s["year"] != 0) & dated_by(m["facts"], s["year"], m), (*album, *firms_of)),
        (lambda s, m: (s["album"] == "") & ~firm(s) & (m["album"] != "") & firm(m) & (s["year"] == 0) & shares(m["facts"], m), (*album, *firms_of)),
        (lambda s, m: (s["album"] == "") & (m["album"] != "") & (s["year"] != 0) & trusted(s) & dated_by(m["facts"], s["year"], s), album),
        (lambda s, m: (s["album"] == "") & (m["album"] != "") & (s["year"] == 0) & trusted(s) & shares(m["facts"], s), album),
        (lambda s, m: (s["album"] == "") & (m["album"] != "") & ~firm(s) & (s["year"] != 0) & like(s, m, "type") & like(s, m, "platform") & steady(m["steady"], s["year"], s, m), ("album", "facts", "steady", "+type", "+platform")),
        (lambda s, m: ~firm(s) & firm(m) & (s["year"] != 0) & (s["album"] != "") & dated_by(s["facts"], s["year"], m), firms_of),
        (lambda s, m: ~firm(s) & firm(m) & (s["year"] == 0) & (s["album"] != "") & shares(s["facts"], m), firms_of),
        (lambda s, m: (s["year"] == 0) & (m["year"] != 0) & (s["album"] != "") & trusted(s) & dated_by(s["facts"], m["year"], s), dated),
        (lambda s, m: (s["year"] == 0) & (m["year"] != 0) & (s["album"] != "") & ~firm(s) & like(s, m, "type") & like(s, m, "platform") & steady(s["steady"], m["year"], s, m), (*dated, "+type", "+platform")),
        (lambda s, m: (s["album"] == "") & (m["album"] != "") & has_names & (s["year"] != 0) & trusted(s)
            & dated_by(told, s["year"], s) & names_share(m["facts"], s) & names_in(m["facts"], s["year"]), album),
        (lambda s, m: (s["album"] == "") & ~firm(s) & (m["album"] != "") & ~firm(m) & has_names & (s["year"] == m["year"]) & (s["year"] != 0) & names_in(m["facts"], s["year"]), album),
        (lambda s, m: (s["album"] == "") & (m["album"] != "") & (m["year"] == s["year"]) & has_names & trusted(s) & names_share(m["facts"], s), album),
        (lambda s, m: (s["year"] == 0) & ~firm(s) & (s["album"] == "") & (m["year"] != 0) & firm(m) & has_names & (m["album"] == "") & dated_by(told, m["year"], m), (*dated, *firms_of)),
        (lambda s, m: (s["year"] == 0) & (s["album"] == "") & (m["year"] != 0) & has_names & (m["album"] == "") & in_year(told, m["year"]), dated),
        (lambda s, m: ~firm(s) & (s["album"] == "") & firm(m) & (m["year"] == s["year"]) & has_names & (m["album"] == "") & shares(told, m), firms_of),
    ]

    def apply(state: Column, rule) -> Column:
        test, taken = rule

        def step(s: Column, m: Column) -> Column:
            ok = F.coalesce(test(s, m), F.lit(False))
            new = [F.when(ok, either(s, m, f) if f"+{f}" in taken else m[f]).otherwise(s[f]).alias(f) if f in taken or f"+{f}" in taken else s[f].alias(f) for f in fields]
            return F.struct(*new)

        return F.aggregate(F.col("__candidates"), state, step)

    prepared = joined.withColumn("__candidates", F.transform("__all", with_facts)).withColumn("__state", with_facts(_record()))
    for rule in rules:
        prepared = prepared.withColumn("__state", apply(F.col("__state"), rule))
    return prepared.select(*[F.col(f"__state.{c}").alias(c) if c in fields else F.col(c) for c in held.columns])


def present(records: DataFrame, handles: DataFrame | None = None) -> DataFrame:
    """``records`` as they are shown: cracktros' albums end with `[cracktro]`, other games' lose the endings of previews.

    ``handles`` (real, handle) gives games their authors' real names and all others their handles; names without an entry
    stay.  A name that stands for several people stays too.
    """
    rows = _filled(records)
    kind = text.normalize_type(F.col("type"))
    bare = F.regexp_replace("album", r"(?i)( - )?\s?\(?(playable )?(preview|prev|demo|beta)\)?$", "")
    cut = F.when((kind == "Game") & text.is_preview(F.col("album")) & (F.trim(bare) != ""), F.trim(bare)).otherwise(F.col("album"))
    album = F.when((kind == "Cracktro") & (F.col("album") != "") & ~F.lower("album").endswith("[cracktro]"), F.concat("album", F.lit(" [cracktro]"))).otherwise(cut)
    rows = rows.withColumn("album", album)
    if handles is None:
        return rows.select(*records.columns)

    def single(key: str, value: str) -> DataFrame:
        one = handles.select(F.col(key).alias("__from"), F.col(value).alias("__to")).distinct().groupBy("__from").agg(F.min("__to").alias("__to"), F.count("*").alias("__n"))
        return one.filter("__n = 1").drop("__n")

    games = F.col("kind_") == "Game"
    parts = rows.withColumn("kind_", kind).withColumn("__row", F.struct(*records.columns)).select("__row", "kind_", F.posexplode_outer("authors").alias("__i", "__a"))
    real = single("handle", "real").toDF("__h", "__real")
    own = single("real", "handle").toDF("__r", "__handle")
    named = parts.join(real, (F.col("__a") == F.col("__h")) & games, "left").join(own, (F.col("__a") == F.col("__r")) & ~games, "left")
    shown = F.struct("__i", F.coalesce("__real", "__handle", "__a").alias("a"))
    # equal rows stay as many: they are counted, not merged
    back = named.groupBy("__row").agg(F.array_sort(F.collect_list(F.when(F.col("__a").isNotNull(), shown))).alias("__as"), F.sum(F.when(F.coalesce("__i", F.lit(0)) == 0, 1)).alias("__n"))
    authors = F.array_distinct(F.transform("__as", lambda x: x["a"]))
    many = back.withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    return many.select(*[authors.alias(c) if c == "authors" else F.col(f"__row.{c}").alias(c) for c in records.columns])


def fill_by_album(records: DataFrame, peers: DataFrame) -> DataFrame:
    """``records`` with unknown publishers and year taken from ``peers`` of the same album whose nearest agree.

    Peers have publishers, are games as the record is or not as it isn't, and lie within a year of its year if that is known.
    Of them those stay that are nearest in turn: by year, platform, kind, publishers, simple album, authors; each test
    counts only if something passes it.  Publishers and year are taken where all that stay tell the same.  Distinct kinds of
    records meet distinct kinds of peers, so a common album costs its kinds.
    """
    rows = keyed(records)
    kind = ("akey", "simple", "firms", "names", "year", "kind", "platform")
    open_ = (F.col("album") != "") & ((F.size("publishers") == 0) | (F.col("year") == 0))
    targets = rows.filter(open_).select(*kind).distinct().alias("t")
    others = keyed(peers).filter((F.col("album") != "") & (F.size("publishers") > 0)).select(*kind, "publishers").distinct().alias("p")
    t, p = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"p.{c}"))
    apart = F.abs(t("year") - p("year"))
    met = targets.join(others, (t("akey") == p("akey")) & ((t("year") == 0) | (apart <= 1)) & ((t("kind") == "Game") == (p("kind") == "Game")))
    close = F.when(t("year") == 0, p("year") != 0).otherwise((p("year") != 0) & ((apart == 0) | ((apart <= 1) & (F.size(t("firms")) > 0))))
    tests = [
        close, F.lower(t("platform")) == F.lower(p("platform")), t("kind") == p("kind"), (F.size(t("firms")) > 0) & F.arrays_overlap(t("firms"), p("firms")),
        t("simple") == p("simple"), (F.size(t("names")) == 0) | (F.size(p("names")) == 0) | F.arrays_overlap(t("names"), p("names")),
    ]
    scored = met.select(*[t(c).alias(f"__{c}") for c in kind], F.struct(*[F.coalesce(x, F.lit(False)).cast("int").alias(f"t{i}") for i, x in enumerate(tests)]).alias("__near"), p("firms").alias("__of"), p("publishers").alias("__publishers"), p("year").alias("__told"))
    scored = store(scored, "near")
    mine = [f"__{c}" for c in kind]
    best = scored.groupBy(*mine).agg(F.max("__near").alias("__most"))
    left = scored.join(best, mine).filter(F.col("__near") == F.col("__most"))
    known = F.when(F.col("__told") > 0, F.col("__told"))
    told = left.groupBy(*mine).agg(F.min("__of").alias("__flo"), F.max("__of").alias("__fhi"), F.min("__publishers").alias("__firms_told"), F.min(known).alias("__ylo"), F.max(known).alias("__yhi"))
    joined = rows.join(told, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in kind]), "left")
    publishers = F.when((F.size("publishers") == 0) & (F.col("album") != "") & (F.col("__flo") == F.col("__fhi")), F.col("__firms_told")).otherwise(F.col("publishers"))
    year = F.when((F.col("year") == 0) & (F.col("album") != "") & (F.col("__ylo") == F.col("__yhi")), F.col("__ylo")).otherwise(F.col("year"))
    new = {"publishers": publishers, "year": year}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in records.columns])


def fill_authors(records: DataFrame, peers: DataFrame) -> DataFrame:
    """``records`` without authors with those of all ``peers`` of the same album, publishers, year, kind and platform, if they are the same."""
    key = ("akey", "firms", "year", "kind", "platform")
    whole = _known("album") & _known("publishers") & _known("year") & _known("type") & _known("platform")
    authors = F.array_sort(F.array_distinct("authors"))
    told = keyed(peers).filter(whole & _known("authors")).groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.min(authors).alias("__lo"), F.max(authors).alias("__hi"))
    rows = keyed(records)
    joined = rows.join(told.filter("__lo = __hi"), reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in key]) & whole, "left")
    new = F.when((F.size("authors") == 0) & F.col("__lo").isNotNull(), F.col("__lo")).otherwise(F.col("authors"))
    return joined.select(*[new.alias(c) if c == "authors" else F.col(c) for c in records.columns])


def final_passes(records: DataFrame, base: DataFrame, passes: int = 2) -> DataFrame:
    """``records`` after the last passes: publishers and years by album, then authors, then type and platform, from each other and ``base``.

    Every pass sees what the one before has filled; it reads a table of that state, so records filled alike don't depend on order.
    """
    facts = store(base.select(*FIELDS), "facts")
    for _ in range(passes):
        state = store(_filled(records), "state")
        everything = state.select(*FIELDS).union(facts)
        filled = store(fill_by_album(state, everything), "filled")
        named = store(fill_authors(filled, filled.select(*FIELDS).union(facts)), "named")
        known = store(keyed(named.select(*FIELDS).union(facts)), "known")
        rows = keyed(named)
        for name, value in (("type_of_platform", "type"), ("platform_of_type", "platform")):
            relation = next(r for r in RELATIONS if r.name == name)
            told = dependency_map(known, relation).withColumnsRenamed({"akey": "__a", relation.key[0]: "__b", value: "__told"})
            on = (F.col("akey") == F.col("__a")) & (F.col(relation.key[0]) == F.col("__b")) & (F.col("album") != "")
            given = F.when((F.col(value) == "") & F.col("__told").isNotNull(), F.col("__told")).otherwise(F.col(value))
            rows = rows.join(told, on, "left").select(*[given.alias(c) if c == value else F.col(c) for c in rows.columns])
            rows = rows.withColumn("kind", text.normalize_type(F.col("type")))
        records = rows.select(*records.columns)
    return records
