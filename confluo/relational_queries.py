"""The shapes of the reference's SQL statements, its path and key joins, blacklists and shards, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import text
from .operators import joins, records
from .queries import _table
from .registry import query


def _listed(column: Column | str) -> Column:
    """Distinct values of a group in order, parted by `~`."""
    return F.array_join(F.array_sort(F.collect_set(column)), "~")


@query(sql="""SELECT DISTINCT o.o_orderkey, c.c_name, n.n_name, r.r_name, string_agg(DISTINCT p.p_name, '~' ORDER BY p.p_name) AS parts, string_agg(DISTINCT p.p_brand, '~' ORDER BY p.p_brand) AS brands,
string_agg(DISTINCT s.s_name, '~' ORDER BY s.s_name) AS suppliers, string_agg(DISTINCT sn.n_name, '~' ORDER BY sn.n_name) AS supplier_nations, string_agg(DISTINCT l.l_returnflag, '~' ORDER BY l.l_returnflag) AS flags
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey LEFT JOIN events e ON e.event_id = o.o_orderkey
WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_name LIKE '%ring') AND (p.p_size > 45 OR s.s_acctbal > 9000 OR e.event_type = 'purchase' OR l.l_returnflag = 'R' OR r.r_name LIKE 'A%')
GROUP BY o.o_orderkey, c.c_name, n.n_name, r.r_name""")
def music_productions(spark, sf_dir):
    """Two inner and many left joins, an uncorrelated IN with LIKE, a filter of many ORs, several distinct lists by group."""
    t = lambda name: _table(spark, sf_dir, name)
    ring = t("lineitem").join(t("part").filter(F.col("p_name").like("%ring")), F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_orderkey").alias("wanted"))
    nations = t("nation").select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    rows = (
        t("orders").join(ring, F.col("o_orderkey") == F.col("wanted"), "left_semi")
        .join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"), "left").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t("part"), F.col("p_partkey") == F.col("l_partkey"), "left").join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .join(nations, F.col("sn_key") == F.col("s_nationkey"), "left").join(t("events").select("event_id", "event_type"), F.col("event_id") == F.col("o_orderkey"), "left")
    )
    some = (F.col("p_size") > 45) | (F.col("s_acctbal") > 9000) | (F.col("event_type") == "purchase") | (F.col("l_returnflag") == "R") | F.col("r_name").like("A%")
    lists = {"parts": "p_name", "brands": "p_brand", "suppliers": "s_name", "supplier_nations": "sn_name", "flags": "l_returnflag"}
    return rows.filter(some).groupBy("o_orderkey", "c_name", "n_name", "r_name").agg(*[_listed(c).alias(n) for n, c in lists.items()])


_NOT_LIKE = ("1%", "%X%", "small%", "%z%", "qq%", "%9999%", "gold n%", "%  %", "iron q%", "%ww%")


@query(sql=f"""SELECT p.p_partkey, p.p_name, p.p_brand, string_agg(DISTINCT s.s_name, '~' ORDER BY s.s_name) FILTER (WHERE l.l_returnflag = 'R') AS returned_by, count(DISTINCT l.l_suppkey) AS suppliers
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
WHERE {" AND ".join(f"p.p_name NOT LIKE '{x}'" for x in _NOT_LIKE)} AND (o.o_totalprice > 250000) IS TRUE AND c.c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')
GROUP BY p.p_partkey, p.p_name, p.p_brand""")
def other_productions(spark, sf_dir):
    """NOT LIKE by the dozen, IS TRUE, a distinct list with a filter."""
    t = lambda name: _table(spark, sf_dir, name)
    parts = t("part")
    for pattern in _NOT_LIKE:
        parts = parts.filter(~F.col("p_name").like(pattern))
    rows = (
        parts.join(t("lineitem"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey"), "left").join(t("customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
        .filter(F.coalesce(F.col("o_totalprice") > 250000, F.lit(False)) & F.col("c_mktsegment").isin("MACHINERY", "HOUSEHOLD"))
    )
    returned = _listed(F.when(F.col("l_returnflag") == "R", F.col("s_name")))
    return rows.groupBy("p_partkey", "p_name", "p_brand").agg(F.nullif(returned, F.lit("")).alias("returned_by"), F.count_distinct("l_suppkey").alias("suppliers"))


@query(sql="""SELECT c.c_custkey, any_value(c.c_name) AS c_name, any_value(c.c_mktsegment) AS c_mktsegment, string_agg(DISTINCT o.o_orderpriority, '~' ORDER BY o.o_orderpriority) AS priorities
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY c.c_custkey""")
def authors_with_names(spark, sf_dir):
    """Group by a primary key, with the columns that depend on it."""
    t = lambda name: _table(spark, sf_dir, name)
    rows = t("customer").join(t("orders"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return rows.groupBy("c_custkey").agg(F.any_value("c_name").alias("c_name"), F.any_value("c_mktsegment").alias("c_mktsegment"), F.nullif(_listed("o_orderpriority"), F.lit("")).alias("priorities"))


@query(sql="""SELECT p.p_partkey, p.p_name, string_agg(DISTINCT o.o_orderkey::VARCHAR, '~' ORDER BY o.o_orderkey::VARCHAR) AS orders, string_agg(DISTINCT c.c_name, '~' ORDER BY c.c_name) AS customers
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY p.p_partkey, p.p_name""")
def soundtracks(spark, sf_dir):
    """Two inner and two left joins with lists."""
    t = lambda name: _table(spark, sf_dir, name)
    rows = t("part").join(t("lineitem"), F.col("l_partkey") == F.col("p_partkey")).join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.join(t("customer"), F.col("c_custkey") == F.col("o_custkey"), "left").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return rows.groupBy("p_partkey", "p_name").agg(_listed(F.col("o_orderkey").cast("string")).alias("orders"), _listed("c_name").alias("customers"))


_LINKS = """l AS (SELECT page_id, url, CASE WHEN url LIKE 'https://m.%' THEN 'mobile' WHEN url LIKE '%.org/%' THEN 'org' WHEN url LIKE '%.net/%' THEN 'net' WHEN url LIKE '%?%' THEN 'query' ELSE 'other' END AS class FROM pages)"""


def _classed(spark, sf_dir) -> DataFrame:
    url = F.col("url")
    kind = F.when(url.like("https://m.%"), "mobile").when(url.like("%.org/%"), "org").when(url.like("%.net/%"), "net").when(url.like("%?%"), "query").otherwise("other")
    return _table(spark, sf_dir, "pages").select("page_id", "url", kind.alias("class"))


@query(sql=f"""WITH {_LINKS} SELECT DISTINCT 'mobile' AS export, concat(page_id::VARCHAR, ':', url) AS link FROM l WHERE class = 'mobile'
UNION ALL SELECT DISTINCT 'org', concat('https://example.org/', page_id::VARCHAR) FROM l, documents d WHERE l.page_id = d.doc_id AND class = 'org' AND NOT (d.lang = 'en' OR d.n_chars < 100)
UNION ALL SELECT DISTINCT 'net', url FROM l WHERE class = 'net' AND page_id IN (SELECT doc_id FROM labels WHERE quality = 1)
UNION ALL SELECT DISTINCT 'query', concat(class, '/', d.source) FROM l, documents d WHERE l.page_id = d.doc_id AND class = 'query'
UNION ALL SELECT DISTINCT 'other', lower(url) FROM l WHERE class = 'other' AND url LIKE '%/en/%'
UNION ALL SELECT DISTINCT 'rest', url FROM l WHERE NOT (class = 'mobile' OR class = 'org' OR class = 'net' OR class = 'query' OR url LIKE '%/en/%')""")
def link_exports(spark, sf_dir):
    """Six exports by class of link: comma joins, IN, CONCAT, DISTINCT and a NOT over ORs."""
    links, docs, labels = _classed(spark, sf_dir), _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    kind, url = F.col("class"), F.col("url")
    on_docs = links.join(docs, F.col("page_id") == F.col("doc_id"))
    good = labels.filter("quality = 1").select("doc_id")
    parts = [
        links.filter(kind == "mobile").select(F.lit("mobile").alias("export"), F.concat(F.col("page_id").cast("string"), F.lit(":"), url).alias("link")),
        on_docs.filter((kind == "org") & ~((F.col("lang") == "en") | (F.col("n_chars") < 100))).select(F.lit("org"), F.concat(F.lit("https://example.org/"), F.col("page_id").cast("string"))),
        links.filter(kind == "net").join(good, F.col("page_id") == F.col("doc_id"), "left_semi").select(F.lit("net"), url),
        on_docs.filter(kind == "query").select(F.lit("query"), F.concat(kind, F.lit("/"), F.col("source"))),
        links.filter((kind == "other") & url.like("%/en/%")).select(F.lit("other"), F.lower(url)),
        links.filter(~(kind.isin("mobile", "org", "net", "query") | url.like("%/en/%"))).select(F.lit("rest"), url),
    ]
    out = parts[0].distinct()
    for part in parts[1:]:
        out = out.union(part.distinct())
    return out


@query(sql=f"""WITH p AS (SELECT p_partkey FROM part WHERE {" AND ".join(f"p_name NOT LIKE '{x}'" for x in _NOT_LIKE)})
SELECT DISTINCT 'brand' AS export, p.p_brand AS value FROM part p, lineitem l WHERE l.l_partkey = p.p_partkey AND p.p_partkey IN (SELECT p_partkey FROM p)
UNION ALL SELECT DISTINCT 'supplier', s.s_name FROM supplier s, lineitem l WHERE l.l_suppkey = s.s_suppkey AND l.l_partkey IN (SELECT p_partkey FROM p) AND s.s_acctbal > 5000
UNION ALL SELECT DISTINCT 'priority', o.o_orderpriority FROM orders o, lineitem l WHERE o.o_orderkey = l.l_orderkey AND l.l_partkey IN (SELECT p_partkey FROM p)
UNION ALL SELECT DISTINCT 'nation', n.n_name FROM nation n, customer c WHERE n.n_nationkey = c.c_nationkey AND c.c_acctbal < 0
UNION ALL SELECT DISTINCT 'order', o.o_orderkey::VARCHAR FROM orders o, customer c WHERE o.o_custkey = c.c_custkey AND c.c_acctbal < -900""")
def production_exports(spark, sf_dir):
    """Five exports with comma joins and a subquery of many NOT LIKEs."""
    t = lambda name: _table(spark, sf_dir, name)
    wanted = t("part")
    for pattern in _NOT_LIKE:
        wanted = wanted.filter(~F.col("p_name").like(pattern))
    lines = t("lineitem").join(wanted.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    parts = [
        wanted.join(lines.select("l_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi").select(F.lit("brand").alias("export"), F.col("p_brand").alias("value")),
        t("supplier").filter("s_acctbal > 5000").join(lines.select("l_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select(F.lit("supplier"), "s_name"),
        t("orders").join(lines.select("l_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(F.lit("priority"), "o_orderpriority"),
        t("nation").join(t("customer").filter("c_acctbal < 0"), F.col("n_nationkey") == F.col("c_nationkey"), "left_semi").select(F.lit("nation"), "n_name"),
        t("orders").join(t("customer").filter("c_acctbal < -900"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.lit("order"), F.col("o_orderkey").cast("string")),
    ]
    out = parts[0].distinct()
    for part in parts[1:]:
        out = out.union(part.distinct())
    return out


@query(sql="""WITH i AS (SELECT lower(regexp_extract(upper(url), '^[A-Z]+://[^/]+(/[^?#]*)', 1)) AS path, min(page_id) AS first FROM pages GROUP BY 1)
SELECT page_id, first FROM (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://[^/]+(/[^?#]*)', 1)) AS path FROM pages) JOIN i USING (path)""")
def path_index_join(spark, sf_dir):
    """Paths met without regard to case through an index of paths."""
    pages = _table(spark, sf_dir, "pages").select("page_id", text.url_path(F.col("url")).alias("path"))
    index = pages.groupBy(F.upper("path").alias("path")).agg(F.min("page_id").alias("first"))
    return joins.path_index_join(pages, "path", index, "path").select("page_id", "first")


@query(sql="""WITH d AS (SELECT doc_id, md5(text) AS h, n_chars FROM documents) SELECT a.doc_id, b.doc_id AS other FROM d a JOIN d b ON substr(a.h, 1, 8) = substr(b.h, 1, 8) AND a.n_chars = b.n_chars AND a.doc_id < b.doc_id""")
def checksum_size_join(spark, sf_dir):
    """A composite key of a checksum and a size."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.substring(F.md5(F.col("text").cast("binary")), 1, 8).alias("sum"), "n_chars")
    return docs.join(docs.withColumnRenamed("doc_id", "other"), ["sum", "n_chars"]).filter("doc_id < other").select("doc_id", "other")


@query(sql="""SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key FROM orders a JOIN orders b ON a.o_orderkey < b.o_orderkey AND abs(a.o_totalprice - b.o_totalprice) <= a.o_totalprice * 0.00025 AND abs(date_diff('day', a.o_orderdate, b.o_orderdate)) <= 3.5""")
def size_length_join(spark, sf_dir):
    """Relative size and absolute length within tolerances at once."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    a, b = orders.toDF("a_key", "x", "p"), orders.toDF("b_key", "y", "q")
    return joins.size_length_join(a, ("x", "p"), b, ("y", "q"), 0.00025, 3.5).filter("a_key < b_key").select("a_key", "b_key")


_RANKS = 6


def _strategies() -> list[tuple[str, str]]:
    """Ranked conditions between a part (p) and a supplier (s), in Spark's and DuckDB's SQL alike."""
    return [
        ("p.p_size = s.s_nationkey AND p.p_partkey % 11 = s.s_suppkey % 11 AND p.p_partkey % 3 = s.s_suppkey % 3", "1"),
        ("p.p_size = s.s_nationkey AND p.p_partkey % 7 = s.s_suppkey % 7", "2"),
        ("p.p_size % 25 = s.s_nationkey AND p.p_partkey % 5 = s.s_suppkey % 5", "3"),
        ("p.p_partkey % 97 = s.s_suppkey", "4"),
        ("p.p_partkey % 13 = s.s_suppkey % 13 AND p.p_size = s.s_suppkey % 50", "5"),
        ("p.p_partkey = s.s_suppkey", "6"),
    ]


@query(sql=f"""WITH c AS ({" UNION ALL ".join(f"SELECT p.p_partkey AS id, s.s_suppkey AS m, {rank} AS r FROM part p JOIN supplier s ON {on}" for on, rank in _strategies())}),
u AS (SELECT id, r, min(m) AS m FROM c GROUP BY id, r HAVING min(m) = max(m)), b AS (SELECT id, min(r) AS r FROM u GROUP BY id)
SELECT p_partkey, u.m AS match, u.r::INT AS rank FROM part LEFT JOIN b ON b.id = p_partkey LEFT JOIN u ON u.id = b.id AND u.r = b.r""")
def ranked_cascade(spark, sf_dir):
    """Six ranked strategies; the first that finds exactly one match decides."""
    part, supplier = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "supplier")
    tables = [part.alias("p").join(supplier.alias("s"), F.expr(on)).select("p.p_partkey", "s.s_suppkey") for on, _ in _strategies()]
    return joins.cascade_join(part, "p_partkey", tables)


@query(sql="""WITH m AS (SELECT p_brand AS archive, p_partkey AS member, p_name || '.' || lower(p_type) AS file FROM part WHERE p_size <= 2), t AS (SELECT p_partkey AS probe, p_brand AS archive, split_part(p_name, ' ', 1) AS title, lower(p_type) AS author FROM part WHERE p_size = 3),
j AS (SELECT probe, member, contains(file, title) AS by_title, contains(file, author) AS by_author, author, count(*) OVER (PARTITION BY probe) AS n FROM t JOIN m USING (archive)),
k AS (SELECT *, sum(by_title::INT) OVER w AS titles, sum((by_title AND by_author)::INT) OVER w AS boths, sum(by_author::INT) OVER w AS authors FROM j WINDOW w AS (PARTITION BY probe)),
c AS (SELECT *, CASE WHEN titles = 0 THEN by_author WHEN titles = 1 THEN by_title ELSE by_title AND by_author END AS chosen, CASE WHEN titles = 0 THEN authors WHEN titles = 1 THEN 1 ELSE boths END AS many FROM k)
SELECT probe, member, CASE WHEN n = 1 OR (many = 1 AND chosen) THEN author ELSE '' END AS author FROM c""")
def archive_members(spark, sf_dir):
    """Members of an archive for a title: the author goes to the single match, or the single member, only."""
    part = _table(spark, sf_dir, "part")
    members = part.filter("p_size <= 2").select(F.col("p_brand").alias("archive"), F.col("p_partkey").alias("member"), F.concat("p_name", F.lit("."), F.lower("p_type")).alias("file"))
    titles = part.filter("p_size = 3").select(F.col("p_partkey").alias("probe"), F.col("p_brand").alias("archive"), F.substring_index("p_name", " ", 1).alias("title"), F.lower("p_type").alias("author"))
    return joins.match_members(titles, members, ["archive"], "probe", "title", "author", "file").select("probe", "member", "author")


@query(sql="""WITH b(kind, v) AS (VALUES ('prefix', 'http://th'), ('prefix', 'https://m.an'), ('title', 'ECONOMY')) SELECT page_id FROM pages WHERE NOT EXISTS (SELECT 1 FROM b WHERE kind = 'prefix' AND starts_with(lower(url), v))""")
def blacklisted_paths(spark, sf_dir):
    """Rows whose path begins with none of the blacklisted prefixes, whatever their case."""
    black = spark.createDataFrame([("http://th",), ("https://m.an",)], "prefix string")
    return records.without_prefixes(_table(spark, sf_dir, "pages").select("page_id", "url"), "url", black, "prefix").select("page_id")


@query(sql="""SELECT c_custkey, c_mktsegment = 'MACHINERY' AS machine, c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) AS rich_nation, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') AS urgent FROM customer""")
def membership_flags(spark, sf_dir):
    """Flags by membership in sets."""
    rich = _table(spark, sf_dir, "supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("k"))
    urgent = _table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").like("1%")).select(F.col("o_custkey").alias("k"))
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", (F.col("c_mktsegment") == "MACHINERY").alias("machine"))
    rows = records.flag_members(rows, "c_nationkey", rich, "k", "rich_nation")
    return records.flag_members(rows, "c_custkey", urgent, "k", "urgent").select("c_custkey", "machine", "rich_nation", "urgent")


@query(sql="""SELECT substr(md5(text), 1, 1) AS shard, count(*) AS n, count(DISTINCT md5(text)) AS hashes, min(n_chars) AS shortest, max(n_chars) AS longest FROM documents WHERE n_chars BETWEEN 300 AND 1500 GROUP BY 1""")
def sharded_scan(spark, sf_dir):
    """A table in shards by the first digit of a hash, with the length filter in the scan."""
    from .plans.storage import new_path

    docs = _table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("hash"), "n_chars")
    path = new_path(spark, "shards")
    docs.withColumn("shard", F.substring("hash", 1, 1)).repartition("shard").write.partitionBy("shard").parquet(path)
    rows = spark.read.option("partitionOverwriteMode", "dynamic").schema("hash string, n_chars long, shard string").parquet(path).filter(F.col("n_chars").between(300, 1500))
    return rows.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("hash").alias("hashes"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


@query(sql="""SELECT source, md5(text) AS hash, count(*) AS n, min(doc_id) AS first, max(n_chars) AS longest FROM documents GROUP BY 1, 2""")
def rows_by_hash(spark, sf_dir):
    """Rows of a source by hash."""
    return _table(spark, sf_dir, "documents").groupBy("source", F.md5(F.col("text").cast("binary")).alias("hash")).agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("n_chars").alias("longest")
    )


@query(sql="""WITH s AS (SELECT md5(text) AS hash, doc_id % 4 AS worker FROM documents) SELECT hash, row_number() OVER (ORDER BY hash) - 1 AS place FROM (SELECT DISTINCT hash FROM s)""")
def sorted_unique_concat(spark, sf_dir):
    """Outputs of several workers as one sorted list without repeats."""
    docs = _table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("hash"), (F.col("doc_id") % 4).alias("worker"))
    return records.sorted_unique([docs.filter(F.col("worker") == w).select("hash") for w in range(4)], "hash", "place")


@query(sql="""WITH k AS (SELECT DISTINCT md5(text) AS long, substr(md5(text || 'x'), 1, 8) || lpad(lower(to_hex(n_chars & 65535)), 4, '0') AS short FROM documents)
SELECT long, short FROM k WHERE short IN (SELECT short FROM k GROUP BY 1 HAVING count(*) = 1)""")
def key_translation(spark, sf_dir):
    """Long keys as short ones of a checksum and the low bits of a size; short keys that stand for several are left out."""
    body = F.col("text")
    short = F.concat(F.substring(F.md5(F.concat(body, F.lit("x")).cast("binary")), 1, 8), F.lpad(F.lower(F.hex(F.col("n_chars").bitwiseAND(65535))), 4, "0"))
    return records.unique_translation(_table(spark, sf_dir, "documents").select(F.md5(body.cast("binary")).alias("long"), short.alias("short")), "long", "short")


@query(sql="""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_totalprice > 200000 DESC, year(o_orderdate), o_orderpriority DESC, o_totalprice, o_orderkey) AS place FROM orders""")
def candidate_order(spark, sf_dir):
    """Candidates of a key in the order of a tuple of many keys, some of them falling."""
    key = [F.desc(F.col("o_orderstatus") == "F"), F.desc(F.col("o_totalprice") > 200000), F.year("o_orderdate"), F.desc("o_orderpriority"), F.col("o_totalprice"), F.col("o_orderkey")]
    return records.ranked(_table(spark, sf_dir, "orders"), ["o_custkey"], F.lit(0), key).select("o_orderkey", F.col("rank").alias("place"))


@query(sql="""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY concat(o_orderstatus, chr(1), CASE WHEN o_totalprice > 100000 THEN '0' ELSE '~' END, chr(1), year(o_orderdate)::VARCHAR, chr(1), (10 - o_orderkey % 7)::VARCHAR, chr(1), o_orderkey::VARCHAR)) AS place FROM orders""")
def joined_key_order(spark, sf_dir):
    """Order by one string of parts with a separator below all letters; numbers stand as strings."""
    parts = [F.col("o_orderstatus"), F.when(F.col("o_totalprice") > 100000, "0").otherwise("~"), F.year("o_orderdate"), 10 - F.col("o_orderkey") % 7, F.col("o_orderkey")]
    return records.ranked(_table(spark, sf_dir, "orders"), ["o_custkey"], F.lit(0), [records.joined_key(parts)]).select("o_orderkey", F.col("rank").alias("place"))


@query(sql="""WITH s(source, p) AS (VALUES ('F', 2), ('O', 1), ('P', 3)), r AS (SELECT o_custkey, o_orderstatus AS source, max(CASE WHEN o_totalprice > 300000 THEN o_orderpriority END) AS v FROM orders GROUP BY 1, 2)
SELECT o_custkey, v AS picked FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY p) AS rn FROM r JOIN s USING (source) WHERE v IS NOT NULL) WHERE rn = 1""")
def preferred_source(spark, sf_dir):
    """The value of the first source in a ranked list that has any."""
    best = F.max(F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority"))).alias("picked")
    rows = _table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderstatus").alias("source")).agg(best)
    return records.first_source(rows, ["o_custkey"], "source", "picked", ["O", "F", "P"])


@query(sql="""SELECT p_partkey, n.v AS name, t.v AS kind FROM part, unnest([p_name, 'The ' || p_name]) n(v), unnest([p_type, lower(p_type), p_brand]) t(v)""")
def variant_product(spark, sf_dir):
    """Every combination of two lists of variants."""
    part = _table(spark, sf_dir, "part")
    return part.select("p_partkey", F.explode(F.array("p_name", F.concat(F.lit("The "), "p_name"))).alias("name"), F.array("p_type", F.lower("p_type"), "p_brand").alias("ks")).select(
        "p_partkey", "name", F.explode("ks").alias("kind")
    )


@query(sql="""SELECT vec_id, score, more FROM (SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rn, count(*) OVER () > 30 AS more FROM
(SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS score FROM embeddings WHERE round(embedding[1]::DOUBLE, 6) >= 0.05)) WHERE rn <= 30""")
def topk_more(spark, sf_dir):
    """The best thirty of a score, and whether there are others."""
    from .operators.recordings import _best

    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("file"), F.lit(0).alias("part"), F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("score"))
    return _best(rows.filter("score >= 0.05"), 30).select(F.col("file").alias("vec_id"), "score", "more")
