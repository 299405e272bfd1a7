"""The operators of record fusion as queries on the driver's tables: orders stand for records that ranked sources give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators import fusion, graph, joins, ordered
from .queries import _table
from .registry import query

_RECORDS = """o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1),
r AS (SELECT o_custkey AS hash, substr(o_orderpriority, 1, 1)::INT AS priority, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'author' || (o_custkey % 5) END AS author,
CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'firm' || (o_custkey % 7 + o_orderkey % 2) END AS publisher, CASE WHEN o_orderkey % 7 < 2 THEN '' ELSE 'album' || (o_custkey % 11) END AS album,
CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE year(o_orderdate)::INT END AS year, CASE o_orderkey % 6 WHEN 0 THEN 'Game' WHEN 1 THEN 'Compo' WHEN 2 THEN 'Tool' WHEN 3 THEN 'Game' ELSE '' END AS type,
CASE o_orderkey % 3 WHEN 0 THEN 'Amiga' WHEN 1 THEN 'Atari' ELSE '' END AS platform FROM o)"""


def _score(least: str) -> str:
    return f"""(CASE WHEN publisher <> '' OR type = 'Tool' THEN 10 ELSE 0 END + CASE WHEN album <> '' OR type = 'Compo' THEN 1000 ELSE 0 END + CASE WHEN year > 0 THEN 10000 ELSE 0 END
+ CASE WHEN platform = 'Amiga' OR type = 'Compo' THEN 1 ELSE 0 END + CASE WHEN type = 'Game' THEN 1 ELSE 0 END + CASE WHEN year > 0 AND year <= {least} THEN 1 ELSE 0 END)"""


def _flat(spark, sf_dir: str) -> DataFrame:
    """hash, priority, author, publisher, album, year, type, platform; one row per hash and priority."""
    key, owner = F.col("o_orderkey"), F.col("o_custkey")

    def unless(test: Column, value: Column) -> Column:
        return F.when(test, F.lit("")).otherwise(value)

    first = _table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.min_by(F.struct("o_orderkey", "o_orderdate"), "o_orderkey").alias("o"))
    rows = first.select("o_custkey", "o_orderpriority", "o.*")
    kind = F.when(key % 6 == 0, "Game").when(key % 6 == 1, "Compo").when(key % 6 == 2, "Tool").when(key % 6 == 3, "Game").otherwise("")
    return rows.select(
        owner.alias("hash"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        unless(key % 3 == 0, F.concat(F.lit("author"), (owner % 5).cast("string"))).alias("author"),
        unless(key % 5 == 0, F.concat(F.lit("firm"), (owner % 7 + key % 2).cast("string"))).alias("publisher"),
        unless(key % 7 < 2, F.concat(F.lit("album"), (owner % 11).cast("string"))).alias("album"),
        F.when(key % 4 == 0, 0).otherwise(F.year("o_orderdate")).alias("year"), kind.alias("type"),
        F.when(key % 3 == 0, "Amiga").when(key % 3 == 1, "Atari").otherwise("").alias("platform"),
    )


def _records(spark, sf_dir: str) -> DataFrame:
    """The same with authors and publishers as arrays."""

    def listed(c: str) -> Column:
        return F.filter(F.array(c), lambda x: x != "")

    return _flat(spark, sf_dir).select("hash", "priority", listed("author").alias("authors"), listed("publisher").alias("publishers"), "album", "year", "type", "platform")


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(c, "~").alias(c[:-1]) if c in {"authors", "publishers"} else F.col(c) for c in df.columns])


@query(sql=f"""WITH {_RECORDS}, k AS (SELECT *, coalesce(min(CASE WHEN year > 0 THEN year END) OVER (PARTITION BY hash), 0) AS least FROM r WHERE publisher <> '' OR album <> '' OR year <> 0),
s AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY {_score("least")} DESC, priority) AS rn FROM k WHERE least = 0 OR year <= least + CASE WHEN type = 'Compo' THEN 2 ELSE 1 END)
SELECT hash, priority, album, year, {_score("least")} AS score FROM s WHERE rn = 1""")
def best_field_pick(spark, sf_dir):
    entry = F.struct("priority", *fusion.FIELDS)
    gathered = _records(spark, sf_dir).groupBy("hash").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    best = gathered.select("hash", fusion.best_of(F.col("all"), fusion.least_year(F.col("all"))).alias("b")).filter("b is not null")
    return best.select("hash", "b.record.priority", "b.record.album", "b.record.year", (-F.col("b.cost")).alias("score"))


@query()
def fuse_sources(spark, sf_dir):
    return _plain(fusion.fuse_sources(_records(spark, sf_dir), scene_groups=["firm3"]))


@query(sql=f"""WITH {_RECORDS}, t AS (SELECT DISTINCT album, author, type FROM r WHERE publisher = '' OR year = 0),
p AS (SELECT t.album, t.author, t.type, q.publisher, q.year, q.type AS qt FROM t JOIN r q USING (album, author) WHERE q.publisher <> '' OR q.year <> 0),
n AS (SELECT *, max((qt = type)::INT) OVER (PARTITION BY album, author, type) AS a FROM p), f AS (SELECT * FROM n WHERE CASE WHEN type = '' THEN true WHEN a = 1 THEN qt = type ELSE qt = '' END),
v AS (SELECT album, author, type, publisher, row_number() OVER (PARTITION BY album, author, type ORDER BY count(*) DESC, publisher) AS rn FROM f WHERE publisher <> '' GROUP BY album, author, type, publisher),
y AS (SELECT album, author, type, min(year) AS y FROM f WHERE year <> 0 GROUP BY album, author, type HAVING count(DISTINCT year) = 1)
SELECT hash, priority, CASE WHEN r.publisher = '' THEN coalesce(v.publisher, '') ELSE r.publisher END AS publisher, CASE WHEN r.year = 0 THEN coalesce(y.y, 0) ELSE r.year END AS year
FROM r LEFT JOIN (SELECT * FROM v WHERE rn = 1) v USING (album, author, type) LEFT JOIN y USING (album, author, type)""")
def fill_from_peers(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    return fusion.fill_from_peers(flat, flat, ["album", "author"], ["type"]).select("hash", "priority", "publisher", "year")


@query(sql=f"""WITH {_RECORDS}, g AS (SELECT *, hash % 40 AS component FROM r),
l AS (SELECT *, coalesce(min(CASE WHEN year > 0 THEN year END) OVER (PARTITION BY component), 0) AS least FROM g),
s AS (SELECT *, {_score("least")} + CASE WHEN author <> '' THEN 1 ELSE 0 END AS score, (publisher <> '' OR album <> '' OR year <> 0) AS facts FROM l),
c AS (SELECT *, rank() OVER (PARTITION BY component ORDER BY score DESC, CASE WHEN year = 0 THEN 9999 ELSE year END, author = '', publisher = '') AS rk FROM s
WHERE facts AND (least = 0 OR (year > 0 AND year <= least + CASE WHEN type = 'Compo' THEN 2 ELSE 1 END))),
v AS (SELECT *, count(*) OVER (PARTITION BY component, publisher, album) AS n FROM c WHERE rk = 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY n DESC, priority, hash) AS rn FROM v) WHERE rn = 1),
j AS (SELECT s.*, b.hash AS bh, b.author AS ba, b.publisher AS bp, b.album AS bb, b.year AS byr, b.score AS bs,
coalesce(b.hash IS NOT NULL AND (NOT s.facts OR b.score > s.score OR (b.score = s.score AND b.year > 0 AND b.year < s.year)), false) AS taken FROM s LEFT JOIN b USING (component))
SELECT hash, priority, CASE WHEN taken AND author = '' THEN ba ELSE author END AS author, CASE WHEN taken THEN bp ELSE publisher END AS publisher,
CASE WHEN taken THEN bb ELSE album END AS album, CASE WHEN taken THEN byr ELSE year END AS year FROM j""")
def spread_in_components(spark, sf_dir):
    rows = _records(spark, sf_dir).withColumn("component", F.col("hash") % 40)
    return _plain(fusion.spread(rows)).select("hash", "priority", "author", "publisher", "album", "year")


@query(sql=f"""WITH {_RECORDS}, d AS (SELECT *, hash % 50 AS k FROM r), x AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN year > 0 THEN year ELSE 9999 END, author = '', hash, author, publisher, album, year, type, platform) AS rn,
first_value(author) OVER (PARTITION BY k ORDER BY author = '', hash, author) AS longest FROM d)
SELECT k AS short_key, hash, CASE WHEN author = '' THEN longest ELSE author END AS author, publisher, album, year FROM x WHERE rn = 1""")
def merge_colliding(spark, sf_dir):
    rows = _records(spark, sf_dir).withColumn("short_key", F.col("hash") % 50)
    return _plain(fusion.merge_colliding(rows, "short_key")).select("short_key", "hash", "author", "publisher", "album", "year")


@query(sql=f"""WITH {_RECORDS}, d AS (SELECT *, priority = 3 OR type = 'Tool' AS variant FROM r),
m AS (SELECT *, row_number() OVER (PARTITION BY album, publisher, variant ORDER BY CASE WHEN year > 0 THEN year ELSE 9999 END, hash * 10 + priority) AS rn FROM d),
f AS (SELECT *, max(CASE WHEN NOT variant THEN 1 ELSE 0 END) OVER w AS has_own, max(CASE WHEN NOT variant THEN year ELSE 0 END) OVER w AS own_year, max(CASE WHEN variant THEN year ELSE 0 END) OVER w AS variant_year FROM m WINDOW w AS (PARTITION BY album, publisher))
SELECT hash, priority, album, publisher, year FROM f WHERE rn = 1 AND NOT (variant AND has_own = 1 AND (own_year > 0 OR variant_year = 0))""")
def originals_and_variants(spark, sf_dir):
    rows = _flat(spark, sf_dir).withColumn("place", F.col("hash") * 10 + F.col("priority"))
    kept = fusion.originals_and_variants(rows, ["album", "publisher"], (F.col("priority") == 3) | (F.col("type") == "Tool"), "year", "place")
    return kept.select("hash", "priority", "album", "publisher", "year")


@query(sql="""WITH s AS (SELECT p_brand, p_size, list_sort(list_distinct(string_split(p_name, ' '))) AS canon, p_name, length(replace(p_name, ' ', '')) AS n FROM part)
SELECT p_brand, p_size, canon AS words FROM (SELECT p_brand, p_size, array_to_string(min(canon), '~') AS canon FROM s GROUP BY 1, 2 HAVING min(canon) = max(canon))""")
def set_dependency_map(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select("p_brand", "p_size", F.split("p_name", " ").alias("words"))
    found = fusion.set_dependency_map(part, ["p_brand", "p_size"], "words")
    return found.select("p_brand", "p_size", F.array_join(F.array_sort(F.array_distinct("words")), "~").alias("words"))


@query(sql=f"""WITH {_RECORDS}, v AS (SELECT album, publisher, count(*) AS votes, min(priority) AS p FROM r GROUP BY 1, 2)
SELECT album, publisher, votes FROM (SELECT *, row_number() OVER (PARTITION BY album ORDER BY votes DESC, p, publisher) AS rn FROM v) WHERE rn = 1""")
def majority_by_priority(spark, sf_dir):
    return fusion.majority_by_priority(_flat(spark, sf_dir), ["album"], "publisher", "priority")


@query(sql=f"""WITH {_RECORDS}, rules(rule, ry, rt) AS (VALUES (1, 1997, 'Demo'), (2, 0, 'Game'), (3, 1999, ''), (4, 1996, 'Demo')), j AS (SELECT hash, year, ry, rt FROM r LEFT JOIN rules ON rule = priority),
e AS (SELECT c_custkey AS hash, 1995 + c_nationkey AS y FROM customer), y AS (SELECT hash, ry AS y FROM j UNION ALL SELECT hash, year FROM j UNION ALL SELECT * FROM e),
t AS (SELECT hash, CASE WHEN min(rt) = max(rt) AND count(rt) > 1 THEN min(rt) END AS type FROM j WHERE rt <> '' GROUP BY 1)
SELECT hash, min(CASE WHEN y > 0 THEN y END) AS cap, any_value(type) AS type FROM y LEFT JOIN t USING (hash) GROUP BY 1""")
def year_caps(spark, sf_dir):
    rules = spark.createDataFrame([(1, 1997, "Demo"), (2, 0, "Game"), (3, 1999, ""), (4, 1996, "Demo")], "rule int, year int, type string")
    extras = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("hash"), (F.col("c_nationkey") + 1995).alias("year"))
    paths = _flat(spark, sf_dir).select("hash", F.col("year").alias("path_year"), F.col("priority").alias("rule"))
    return fusion.year_caps(paths, rules, extras)


@query(sql=f"""WITH {_RECORDS}, c AS (SELECT album, publisher, year FROM r WHERE type = 'Compo' AND year > 0), g AS (SELECT * FROM r WHERE type = 'Game'),
j AS (SELECT g.hash, g.priority, g.year, max(c.year) AS m, coalesce(bool_or(c.year + 1 < g.year), false) AS before, coalesce(bool_or(c.year BETWEEN g.year AND g.year + 1), false) AS after
FROM g LEFT JOIN c ON g.album = c.album AND g.publisher = c.publisher GROUP BY ALL)
SELECT hash, priority, CASE WHEN year > 0 AND before AND NOT after AND year - m <= 1 THEN 0 ELSE year END AS year FROM j""")
def blank_years_after(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    earlier = flat.filter("type = 'Compo'").select("album", "publisher", F.col("year").alias("other_year"))
    return fusion.blank_years_after(flat.filter("type = 'Game'"), "year", ["album", "publisher"], earlier, "other_year").select("hash", "priority", "year")


@query(sql="""WITH RECURSIVE w AS (SELECT DISTINCT p_size, p_partkey, unnest(string_split(p_name, ' ')) AS v FROM part),
l AS (SELECT DISTINCT a.p_partkey AS a, b.p_partkey AS b FROM w a JOIN w b USING (p_size, v)), reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a AS p_partkey, min(b) AS component FROM reach GROUP BY 1)
SELECT p_size, count(*) AS sets, count(DISTINCT component) AS components FROM (SELECT DISTINCT p_size, p_partkey FROM w) JOIN c USING (p_partkey) GROUP BY 1""")
def linked_groups(spark, sf_dir):
    return graph.linked_groups(_table(spark, sf_dir, "part").select("p_size", "p_partkey", F.split("p_name", " ").alias("ws")), "p_size", "p_partkey", "ws")


@query(sql="SELECT doc_id, count(*) OVER (PARTITION BY lang ORDER BY n_chars RANGE UNBOUNDED PRECEDING) AS n_shorter FROM documents")
def not_longer(spark, sf_dir):
    return graph.not_longer(_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "lang", "n_chars").select("doc_id", F.col("n_shorter").cast("long").alias("n_shorter"))


@query(sql="""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS v FROM events)
SELECT event_id, coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS v FROM e""")
def fill_whole(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("v"))
    return ordered.fill_whole(events, ["user_id"], [F.col("ts"), F.col("event_id")], "v").select("event_id", "v")


@query(sql="""WITH e AS (SELECT event_id, user_id, event_type AS n, event_id % 3 + 1 AS d FROM events),
a AS (SELECT *, last_value(CASE WHEN d = 1 THEN n END IGNORE NULLS) OVER w AS p1, last_value(CASE WHEN d = 2 THEN n END IGNORE NULLS) OVER w AS p2 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, CASE d WHEN 1 THEN n WHEN 2 THEN concat_ws('/', p1, n) ELSE concat_ws('/', p1, p2, n) END AS path FROM a""")
def path_stack(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("n"), (F.col("event_id") % 3 + 1).cast("int").alias("d"))
    return ordered.path_stack(events, ["user_id"], [F.col("event_id")], "d", "n", 3).select("event_id", "path")


@query(sql="""WITH f AS (SELECT DISTINCT p_partkey AS item, unnest([p_partkey * 3, p_partkey + p_size, p_partkey]) AS other FROM part)
SELECT item, other FROM f WHERE item <> other AND other IN (SELECT p_partkey FROM part)""")
def reference_join(spark, sf_dir):
    key = F.col("p_partkey")
    return joins.reference_join(_table(spark, sf_dir, "part").select("p_partkey", F.array(key * 3, key + F.col("p_size"), key).alias("refs")), "p_partkey", "refs")


@query(sql="SELECT page_id, array_to_string(list_slice(string_split(url, '/'), 1, 4), '/') AS first_key, array_to_string(list_slice(string_split(url, '/'), -2, -1), '/') AS last_key FROM pages")
def path_keys(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", joins.path_key(url, first=4).alias("first_key"), joins.path_key(url, last=2).alias("last_key"))
