"""Knowledge told by all sources together, as queries on the driver's tables: records as in the fusion queries, eight years older."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fusion_queries import _RECORDS, _plain, _records
from .operators import knowledge
from .plans.storage import store
from .registry import query

_OLD = f"""{_RECORDS}, a AS (SELECT hash, priority, author, publisher, album, CASE WHEN year > 0 THEN year - 8 ELSE 0 END AS year, type,
CASE WHEN platform = 'Amiga' AND hash % 2 = 0 THEN 'PC' ELSE platform END AS platform FROM r),
t AS (SELECT *, translate(publisher, '013457', 'oieast') AS firm, translate(author, '013457', 'oieast') AS name,
CASE WHEN type IN ('Game', 'Compo', '') THEN type ELSE 'Other' END AS kind FROM a)"""
_SANE = """NOT ((platform = 'PC' AND year > 0 AND year < CASE WHEN type = 'Game' THEN 1992 ELSE 1990 END) OR (platform = 'Atari' AND year > 0 AND year < 1988))
AND NOT (author = '' AND (publisher <> '')::INT + (album <> '')::INT + (year <> 0)::INT <= 1)"""
_BASE = f"""{_OLD}, g AS (SELECT DISTINCT author, publisher, album, year, type, platform, firm, name, kind FROM t WHERE priority < 5),
d AS (SELECT DISTINCT author, publisher, album, year, type, platform, firm, name, kind FROM t WHERE priority = 5),
f AS (SELECT *, album <> '' AND publisher <> '' AND year <> 0 AND EXISTS (SELECT 1 FROM g WHERE g.album = d.album AND g.firm = d.firm AND g.publisher <> '' AND g.year <> d.year AND g.year <> 0) AS no_year,
album <> '' AND publisher <> '' AND EXISTS (SELECT 1 FROM g WHERE g.album = d.album AND g.publisher <> '' AND g.firm <> d.firm) AS no_firm FROM d),
u AS (SELECT * FROM g UNION SELECT author, CASE WHEN no_firm THEN '' ELSE publisher END, album, CASE WHEN no_year THEN 0 ELSE year END, type, platform, CASE WHEN no_firm THEN '' ELSE firm END, name, kind FROM f),
kb AS (SELECT * FROM u WHERE {_SANE})"""


def _old(spark, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir)
    pc = (F.col("platform") == "Amiga") & (F.col("hash") % 2 == 0)
    return rows.withColumn("year", F.when(F.col("year") > 0, F.col("year") - 8).otherwise(0)).withColumn("platform", F.when(pc, "PC").otherwise(F.col("platform")))


def _base(spark, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    rows = _old(spark, sf_dir) if rows is None else rows
    return store(knowledge.knowledge_base(rows.filter("priority < 5"), rows.filter("priority = 5")), "base")


@query(sql=f"WITH {_BASE} SELECT author, publisher, album, year, type, platform FROM kb")
def knowledge_base(spark, sf_dir):
    """Distinct records of four sources, and those of the fifth without what the others contradict."""
    return _plain(_base(spark, sf_dir).select("authors", "publishers", "album", "year", "type", "platform"))


def _relation_sql(relation: knowledge.Relation, simple: bool) -> str:
    column = {"publishers": "publisher", "authors": "author", "firms": "firm"}
    key = ["album", *[column.get(k, k) for k in relation.key]]
    needs = ["album <> ''", *[f"{column.get(n, n)} <> {0 if n == 'year' else chr(39) * 2}" for n in relation.needs], *(["kind = 'Game'"] if relation.games else [])]
    value = {"publishers": "firm", "authors": "author"}.get(relation.value, relation.value)
    shown = "min(kind)" if relation.name == "type_of_platform" else f"min({column.get(relation.value, relation.value)})"
    steady = " AND min(year) = max(year)" if relation.steady else ""
    return f"""SELECT '{relation.name}' AS relation, {simple} AS simple, concat_ws('|', {", ".join(k + "::VARCHAR" for k in key)}) AS key, {shown}::VARCHAR AS value
FROM kb WHERE {" AND ".join(needs)} GROUP BY {", ".join(key)} HAVING min({value}) = max({value}){steady}"""


@query(sql=f"WITH {_BASE} " + " UNION ALL ".join(_relation_sql(r, s) for r in knowledge.RELATIONS for s in (False, True)))
def dependency_maps(spark, sf_dir):
    """All twenty maps: ten relations by the full and by the simple album key."""
    parts = None
    for (name, simple), table in knowledge.dependency_maps(_base(spark, sf_dir)).items():
        relation = next(r for r in knowledge.RELATIONS if r.name == name)

        def shown(c: str) -> Column:
            return F.array_join(c, "~") if c in ("firms", "publishers", "authors") else F.col(c).cast("string")

        key = F.concat_ws("|", *[shown(c) for c in ("simple" if simple else "akey", *relation.key)])
        part = table.select(F.lit(name).alias("relation"), F.lit(simple).alias("simple"), key.alias("key"), shown(relation.value).alias("value"))
        parts = part if parts is None else parts.union(part)
    return parts


_EXISTENCE = {
    "year_album_firms": ("year|album|firm", "year > 0 AND album <> '' AND publisher <> ''"), "year_album": ("year|album", "year > 0 AND album <> ''"),
    "album_firms": ("album|firm", "album <> '' AND publisher <> ''"), "names_album_firms": ("name|album|firm", "author <> '' AND album <> '' AND publisher <> ''"),
    "names_album_year": ("name|album|year", "author <> '' AND album <> '' AND year > 0"), "names_year_firms": ("name|year|firm", "author <> '' AND year > 0 AND publisher <> ''"),
    "names_year": ("name|year", "author <> '' AND year > 0 AND album = ''"), "names_firms": ("name|firm", "author <> '' AND publisher <> '' AND album = ''"),
}


def _existence_sql() -> str:
    parts = [f"SELECT DISTINCT '{n}' AS relation, concat_ws('|', {', '.join(c + '::VARCHAR' for c in key.split('|'))}) AS key FROM kb WHERE {where}" for n, (key, where) in _EXISTENCE.items()]
    parts.append("""SELECT 'steady_year', concat_ws('|', min(year)::VARCHAR, album, kind, platform) FROM kb WHERE album <> '' AND year > 0 AND type <> '' AND platform <> ''
GROUP BY album, kind, platform HAVING min(year) = max(year) AND count(DISTINCT nullif(firm, '')) <= 1""")
    return " UNION ALL ".join(parts)


@query(sql=f"WITH {_BASE} " + _existence_sql())
def existence_relations(spark, sf_dir):
    """The nine existence relations as distinct tuples."""
    base, parts = _base(spark, sf_dir), None
    for name in (*knowledge.EXISTENCE, "steady_year"):
        table = knowledge.existence(base, name)
        key = F.concat_ws("|", *[F.array_join(c, "~") if c in ("names", "firms") else F.col(c).cast("string") for c in table.columns])
        part = table.select(F.lit(name).alias("relation"), key.alias("key"))
        parts = part if parts is None else parts.union(part)
    return parts


_GROUPS = ", ".join(f"('{g}')" for g in knowledge.ALWAYS_SCENE)


@query(sql=f"WITH {_BASE} SELECT DISTINCT publisher FROM (SELECT publisher FROM kb WHERE type <> '' AND type <> 'Game' AND album <> '' AND publisher <> '' UNION ALL SELECT * FROM (VALUES {_GROUPS}))")
def scene_groups(spark, sf_dir):
    return knowledge.scene_groups(_base(spark, sf_dir))


@query(sql=f"""WITH {_BASE}, m AS (SELECT publisher, album FROM t WHERE publisher <> '' OR album <> '' GROUP BY 1, 2
HAVING count(DISTINCT nullif(author, '')) >= 3 OR (count(*) >= 3 AND count(nullif(author, '')) = 0))
SELECT hash, priority, author, CASE WHEN m.album IS NULL THEN t.publisher ELSE '' END AS publisher, CASE WHEN m.album IS NULL THEN t.album ELSE '' END AS album,
CASE WHEN m.album IS NULL THEN year ELSE 0 END AS year, CASE WHEN m.album IS NULL THEN type ELSE '' END AS type, CASE WHEN m.album IS NULL THEN platform ELSE '' END AS platform
FROM t LEFT JOIN m USING (publisher, album)""")
def blank_compilations(spark, sf_dir):
    return _plain(knowledge.blank_compilations(_old(spark, sf_dir), least=3))


def _held(rows: DataFrame) -> DataFrame:
    """One record per hash: its first source's, without one of its fields by turns."""
    first = rows.groupBy("hash").agg(F.min_by(F.struct("authors", "publishers", "album", "year", "type", "platform"), "priority").alias("r")).select("hash", "r.*")
    none = F.array().cast("array<string>")
    turn = F.col("hash") % 4
    return first.select(
        "hash", "authors", F.when(turn.isin(0, 3), none).otherwise(F.col("publishers")).alias("publishers"), F.when(turn.isin(1, 3), "").otherwise(F.col("album")).alias("album"),
        F.when(turn == 2, 0).otherwise(F.col("year")).alias("year"), F.when(F.col("hash") % 3 == 0, "").otherwise(F.col("type")).alias("type"), "platform",
    )


@query()
def fill_conditionally(spark, sf_dir):
    """Seventeen conditional fills in turn, from each hash's own sources."""
    rows = store(_old(spark, sf_dir), "records")
    return _plain(knowledge.fill_conditionally(_held(rows), rows, _base(spark, sf_dir, rows)))


@query()
def impute_chain(spark, sf_dir):
    """Platform, type, year, publishers and authors deduced from the twenty maps, in order."""
    held = _held(_old(spark, sf_dir))
    formats = F.when(F.col("hash") % 5 == 0, F.array(F.lit("OctaMED Pro"))).when(F.col("hash") % 5 == 1, F.array(F.lit("ProTracker"))).otherwise(F.array(F.lit("XM")))
    players = F.when(F.col("hash") % 7 == 0, F.array(F.lit("uade"))).otherwise(F.array(F.lit("")))
    blank = F.when(F.col("hash") % 2 == 0, "").otherwise(F.col("platform"))
    held = held.withColumn("platform", blank).withColumn("formats", formats).withColumn("players", players)
    return _plain(knowledge.impute(held, _base(spark, sf_dir), scene=["firm3"]).drop("formats", "players"))


@query(sql=f"""WITH {_BASE}, h AS (SELECT *, CASE hash % 4 WHEN 0 THEN 'trainer' ELSE type END AS shown, album || CASE hash % 3 WHEN 0 THEN ' preview' WHEN 1 THEN ' - demo' ELSE '' END AS title FROM t WHERE album <> '')
SELECT hash, priority, CASE WHEN shown = 'trainer' THEN title || ' [cracktro]' WHEN shown = 'Game' THEN album ELSE title END AS album,
CASE WHEN shown = 'Game' AND author = 'author1' THEN 'Real One' WHEN shown <> 'Game' AND author = 'Real Two' THEN 'author2' ELSE author END AS author FROM h""")
def present_records(spark, sf_dir):
    """Albums and authors as they are shown."""
    rows = _old(spark, sf_dir).filter("album <> ''")
    title = F.concat("album", F.when(F.col("hash") % 3 == 0, " preview").when(F.col("hash") % 3 == 1, " - demo").otherwise(""))
    rows = rows.withColumn("album", title).withColumn("type", F.when(F.col("hash") % 4 == 0, "trainer").otherwise(F.col("type")))
    handles = spark.createDataFrame([("Real One", "author1"), ("Real Two", "author2"), ("Real Three", "author3"), ("Other Three", "author3")], "real string, handle string")
    return _plain(knowledge.present(rows, handles)).select("hash", "priority", "album", "author")


@query()
def final_passes(spark, sf_dir):
    """The last two passes over albums: publishers and years, authors, type and platform."""
    return _plain(knowledge.final_passes(_held(_old(spark, sf_dir)), _base(spark, sf_dir)))
