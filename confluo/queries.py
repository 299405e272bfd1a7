"""Every operator as a query on the driver's tables, with the DuckDB SQL that it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codec, text
from .functions.fingerprint import hamming_similarity
from .operators import graph, joins, ordered, records
from .registry import query
from .sources import export


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str = "text"):
    return F.col(column).cast("binary")


@query(sql="SELECT doc_id, substr(md5(text), 1, 12) AS content_key FROM documents")
def content_hash48(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.substring(F.md5(_text()), 1, 12).alias("content_key"))


@query(sql="SELECT content_key, doc_id, source FROM (SELECT md5(text) AS content_key, doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def exact_dedup_first(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.md5(_text()).alias("content_key"), "doc_id", "source")
    return records.keep_first(docs, ["content_key"], ["doc_id"])


_SCORE = "(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END + CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END + CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END)"


def _order_tests():
    return [F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000, F.col("o_orderpriority").startswith("1")]


@query(sql=f"SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {_SCORE} DESC, o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def best_record_score(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return records.best_record(orders, ["o_custkey"], _order_tests(), [F.col("o_orderpriority"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(sql=f"SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {_SCORE} DESC, o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn > 1")
def best_record_leftovers(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return records.leftovers(orders, ["o_custkey"], _order_tests(), [F.col("o_orderpriority"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(sql="SELECT o_custkey, o_orderkey, y AS order_year FROM (SELECT o_custkey, o_orderkey, year(o_orderdate)::INT AS y, min(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE y <= m + 1")
def min_year_window(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("order_year"))
    return records.near_minimum(orders, ["o_custkey"], "order_year")


@query(sql="WITH v AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type) SELECT user_id, event_type, n AS votes FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM v) WHERE rn = 1")
def majority_with_min_tie(spark, sf_dir):
    return records.majority(_table(spark, sf_dir, "events").select("user_id", "event_type"), ["user_id"], "event_type")


@query(sql="SELECT md5(text) AS content_key, min(source) AS source FROM documents GROUP BY md5(text) HAVING count(DISTINCT source) = 1")
def fd_unique_map(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.md5(_text()).alias("content_key"), "source")
    return records.dependency_map(docs, ["content_key"], "source")


@query(sql="""WITH d AS (SELECT doc_id, md5(text) AS content_key, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS lang FROM documents),
m AS (SELECT content_key, min(lang) AS l FROM d WHERE lang IS NOT NULL GROUP BY 1 HAVING count(DISTINCT lang) = 1)
SELECT doc_id, coalesce(d.lang, m.l) AS lang FROM d LEFT JOIN m USING (content_key)""")
def impute_from_fd(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.md5(_text()).alias("content_key"), F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    known = records.dependency_map(docs, ["content_key"], "lang")
    return records.impute(docs, "lang", [(["content_key"], known)]).select("doc_id", "lang")


@query(sql="SELECT md5(text) AS content_key, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1")
def source_counts(spark, sf_dir):
    return records.source_counts(_table(spark, sf_dir, "documents").select(F.md5(_text()).alias("content_key"), "source"), ["content_key"], "source")


@query(sql="SELECT md5(text) AS content_key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def uniqueness_violations(spark, sf_dir):
    return records.duplicates(_table(spark, sf_dir, "documents").select(F.md5(_text()).alias("content_key")), ["content_key"])


@query(sql="SELECT md5(text) AS content_key, count(DISTINCT (lang, source)) AS kinds FROM documents GROUP BY 1 HAVING count(DISTINCT (lang, source)) > 1")
def strict_equality_violations(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.md5(_text()).alias("content_key"), "lang", "source")
    return records.strict_differences(docs, ["content_key"], ["lang", "source"])


@query(sql="SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '~' ORDER BY o_orderpriority) AS priorities, coalesce(string_agg(DISTINCT o_orderstatus, '~' ORDER BY o_orderstatus) FILTER (WHERE o_totalprice > 150000), '') AS dear_statuses FROM orders GROUP BY 1")
def array_agg_distinct_filter(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    dear = F.when(F.col("o_totalprice") > 150000, F.col("o_orderstatus"))
    return orders.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "~").alias("priorities"), F.array_join(F.array_sort(F.collect_set(dear)), "~").alias("dear_statuses")
    )


@query(sql="SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type NOT LIKE '%BRASS%' AND p_size < 10)")
def in_subquery_notlike(spark, sf_dir):
    part = _table(spark, sf_dir, "part").filter(~F.col("p_type").like("%BRASS%") & (F.col("p_size") < 10))
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return items.join(part, items.l_partkey == part.p_partkey, "left_semi")


@query(sql="SELECT DISTINCT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_nationkey = n_nationkey WHERE c_acctbal > 9000 OR s_acctbal > 9000")
def or_join_distinct(spark, sf_dir):
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    # an OR over two joined tables is the union of two semi joins: no product of customers and suppliers
    rich = _table(spark, sf_dir, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).union(
        _table(spark, sf_dir, "supplier").filter("s_acctbal > 9000").select("s_nationkey"))
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return named.join(rich.distinct(), named.n_nationkey == F.col("k"), "left_semi").select("n_name", "r_name").distinct()


_RULES = [(1, "https://site1", "one"), (2, "https://site", "any site"), (3, "", "default")]


@query(sql="""WITH rules(ord, prefix, label) AS (VALUES (1, 'https://site1', 'one'), (2, 'https://site', 'any site'), (3, '', 'default'))
SELECT page_id, label FROM (SELECT page_id, label, row_number() OVER (PARTITION BY page_id ORDER BY CASE WHEN prefix = '' THEN 999 ELSE ord END) AS rn
FROM pages JOIN rules ON starts_with(lower(url), lower(prefix))) WHERE rn = 1""")
def prefix_rule_first_match(spark, sf_dir):
    rules = spark.createDataFrame(_RULES, "ord int, prefix string, label string")
    return records.first_prefix_rule(_table(spark, sf_dir, "pages").select("page_id", "url"), "url", rules, "prefix", "ord").select("page_id", F.col("rule.label").alias("label"))


@query(sql="""WITH p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://[^/]+(/[^?#]*)', 1) AS path FROM pages),
a AS (SELECT DISTINCT regexp_extract(path, '^(/[^/]+)/', 1) AS archive FROM p WHERE regexp_matches(path, '^/[^/]+/'))
SELECT page_id, archive FROM p JOIN a ON starts_with(path, archive || '/')""")
def archive_prefix_join(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", text.url_path(F.col("url")).alias("path"))
    archives = pages.select(F.regexp_extract("path", "^(/[^/]+)/", 1).alias("archive")).filter("archive <> ''").distinct()
    return joins.prefix_join(pages, "path", archives, "archive").select("page_id", "archive")


@query(sql="SELECT a.doc_id AS a_id, b.doc_id AS b_id FROM documents a JOIN documents b ON a.n_chars BETWEEN b.n_chars - 3 AND b.n_chars + 3 AND a.doc_id < b.doc_id AND a.lang = b.lang")
def band_join_length(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    a = docs.select(F.col("doc_id").alias("a_id"), F.col("n_chars").alias("x"), F.col("lang").alias("a_lang"))
    b = docs.select(F.col("doc_id").alias("b_id"), F.col("n_chars").alias("y"), F.col("lang").alias("b_lang"))
    return joins.band_join(a, "x", b, "y", 3).filter("a_id < b_id and a_lang = b_lang").select("a_id", "b_id")


@query(sql="SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key FROM orders a JOIN orders b ON a.o_orderkey < b.o_orderkey AND abs(a.o_totalprice - b.o_totalprice) <= a.o_totalprice * 0.00001 AND a.o_totalprice > 0 AND b.o_totalprice > 0")
def relative_tolerance_join(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    a = orders.select(F.col("o_orderkey").alias("a_key"), F.col("o_totalprice").alias("x"))
    b = orders.select(F.col("o_orderkey").alias("b_key"), F.col("o_totalprice").alias("y"))
    return joins.ratio_join(a, "x", b, "y", 0.00001).filter("a_key < b_key").select("a_key", "b_key")


@query(sql="""WITH c AS (SELECT p_partkey AS id, s_suppkey AS m, 1 AS r FROM part JOIN supplier ON p_size = s_nationkey AND p_partkey % 7 = s_suppkey % 7
UNION ALL SELECT p_partkey, s_suppkey, 2 FROM part JOIN supplier ON p_partkey % 97 = s_suppkey),
u AS (SELECT id, r, min(m) AS m FROM c GROUP BY id, r HAVING min(m) = max(m)), b AS (SELECT id, min(r) AS r FROM u GROUP BY id)
SELECT p_partkey, u.m AS match, u.r::INT AS rank FROM part LEFT JOIN b ON b.id = p_partkey LEFT JOIN u ON u.id = b.id AND u.r = b.r""")
def cascade_join(spark, sf_dir):
    part, supplier = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "supplier")
    first = part.join(supplier, (part.p_size == supplier.s_nationkey) & (part.p_partkey % 7 == supplier.s_suppkey % 7)).select("p_partkey", "s_suppkey")
    second = part.join(supplier, part.p_partkey % 97 == supplier.s_suppkey).select("p_partkey", "s_suppkey")
    return joins.cascade_join(part, "p_partkey", [first, second])


@query(sql="""SELECT p_partkey, v AS brand_size FROM (SELECT p_partkey, k.v, row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS rn
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part) x
JOIN (SELECT split_part(p_name, ' ', 1) AS w, max(p_size) AS v FROM part WHERE p_size > 30 GROUP BY 1) k USING (w)) WHERE rn = 1
UNION ALL SELECT p_partkey, NULL FROM part WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(string_split(p_name, ' ')) AS w) y
JOIN (SELECT DISTINCT split_part(q.p_name, ' ', 1) AS w FROM part q WHERE q.p_size > 30) z USING (w))""")
def first_key_join(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    known = part.filter("p_size > 30").groupBy(F.substring_index("p_name", " ", 1).alias("w")).agg(F.max("p_size").alias("brand_size"))
    return joins.first_key_join(part.withColumn("ws", F.split("p_name", " ")), "ws", known, "w", "brand_size").select("p_partkey", "brand_size")


@query(sql="""WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS t FROM benchmark)
SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS t FROM documents) JOIN w USING (t) WHERE length(t) > 8""")
def overlap_semi(spark, sf_dir):
    long_words = F.filter(F.split("text", " "), lambda w: F.length(w) > 8)
    docs = _table(spark, sf_dir, "documents").select("doc_id", long_words.alias("ws"))
    items = _table(spark, sf_dir, "benchmark").select(long_words.alias("bs"))
    return joins.overlap_semi(docs, "ws", items, "bs").select("doc_id").distinct()


@query(sql="SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND abs(year(a.o_orderdate) - year(b.o_orderdate)) <= 1 AND a.o_orderkey < b.o_orderkey")
def year_tolerance_join(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    a = orders.select("o_custkey", F.col("o_orderkey").alias("a_key"), F.year("o_orderdate").alias("y"))
    b = orders.select("o_custkey", F.col("o_orderkey").alias("b_key"), F.year("o_orderdate").alias("z"))
    return joins.year_join(a, b, ["o_custkey"], "y", "z").filter("a_key < b_key").select("a_key", "b_key")


@query(sql="""WITH al(n, a) AS (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT n_name AS nm, n_name AS v FROM nation UNION SELECT n, a FROM al)
SELECT DISTINCT p.nm AS a_name, q.nm AS b_name FROM x p JOIN x q ON p.v = q.v""")
def alias_join(spark, sf_dir):
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    aliases = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_name", "r_name")
    return joins.alias_join(nation, nation, "n_name", aliases)


@query(sql="SELECT a.p_partkey AS a_key, b.p_partkey AS b_key FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND (contains(a.p_type, split_part(b.p_type, ' ', 1)) OR contains(split_part(b.p_type, ' ', 1), a.p_type))")
def containment_join(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    a = part.select("p_brand", "p_size", F.col("p_partkey").alias("a_key"), F.col("p_type").alias("a_type"))
    b = part.select("p_brand", "p_size", F.col("p_partkey").alias("b_key"), F.substring_index("p_type", " ", 1).alias("b_type"))
    return joins.containment_join(a, b, ["p_brand", "p_size"], "a_type", "b_type").filter("a_key < b_key").select("a_key", "b_key")


@query(sql="SELECT source, lang, count(DISTINCT doc_id % 11) AS authors, count(*) AS records FROM documents GROUP BY ALL HAVING count(DISTINCT doc_id % 11) >= 5")
def compilation_filter(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("source", "lang", (F.col("doc_id") % 11).alias("author"))
    return records.compilations(docs, ["source", "lang"], "author")


@query(sql="""WITH a AS (SELECT event_id, user_id, event_type, value, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS h FROM events),
b AS (SELECT * FROM a WHERE event_type = 'purchase' OR h = 0), c AS (SELECT *, max(CASE WHEN value > 90 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS g FROM b)
SELECT event_id, user_id FROM c WHERE value > 90 OR g = 0""")
def progressive_filter(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return records.progressive_filter(events, ["user_id"], [F.col("event_type") == "purchase", F.col("value") > 90]).select("event_id", "user_id")


@query(sql="""WITH caps AS (SELECT c_custkey, 1996 + c_nationkey % 3 AS cap FROM customer), o AS (SELECT o_orderkey, o_custkey, o_orderstatus, year(o_orderdate)::INT AS y FROM orders)
SELECT o_orderkey, CASE WHEN y > cap + CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END THEN NULL ELSE y END AS order_year,
CASE WHEN y > cap + CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM o LEFT JOIN caps ON c_custkey = o_custkey""")
def constraint_cap(spark, sf_dir):
    caps = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") % 3 + 1996).alias("cap"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("order_year"))
    return records.cap_years(orders, caps, "o_custkey", "order_year", ["o_orderstatus"], F.col("o_orderstatus") == "F").select("o_orderkey", "order_year", "o_orderstatus")


@query(sql="SELECT o_orderkey, CASE WHEN y = max(y) OVER (PARTITION BY o_custkey, o_orderpriority) THEN y END AS order_year FROM (SELECT *, year(o_orderdate)::INT AS y FROM orders)")
def conflict_year_repair(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("order_year"))
    return records.blank_outlier_years(orders, ["o_custkey", "o_orderpriority"], "order_year").select("o_orderkey", "order_year")


@query(sql=r"""SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host, coalesce(nullif(regexp_extract(url, '/([0-9]+)[^/]*$', 1), ''), nullif(regexp_extract(url, '([0-9]+)', 1), '')) AS number,
regexp_extract(url, '^[A-Za-z]+://[^/]+(/[^?#]*)', 1) AS path FROM pages""")
def url_path(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", text.url_host(url).alias("host"), text.first_match(url, [(r"/([0-9]+)[^/]*$", 1), ("([0-9]+)", 1)]).alias("number"), text.url_path(url).alias("path"))


@query(sql=r"""SELECT p_partkey, coalesce(CASE WHEN y1 BETWEEN 1985 AND 2026 THEN y1 END, CASE WHEN y2 BETWEEN 1985 AND 2026 THEN y2 END, CASE WHEN y3 BETWEEN 1985 AND 2026 THEN y3 END, CASE WHEN y4 BETWEEN 1985 AND 2026 THEN y4 END, 0) AS path_year
FROM (SELECT p_partkey, try_cast(nullif(regexp_extract(p, '/(?:19|20)[0-9]{2}-((?:19|20)[0-9]{2})/', 1), '') AS INT) AS y1, try_cast(nullif(regexp_extract(p, '/((?:19|20)[0-9]{2})/', 1), '') AS INT) AS y2,
try_cast(nullif(regexp_extract(p, '\(((?:19|20)[0-9]{2})\)', 1), '') AS INT) AS y3, try_cast(nullif(regexp_extract(p, '[-_ ]((?:19|20)[0-9]{2})[-_ /.]', 1), '') AS INT) AS y4
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '/a/' || (1970 + p_size) || '/x' WHEN 1 THEN '/a/1990-' || (1970 + p_size) || '/x' WHEN 2 THEN '/a/t (' || (1970 + p_size) || ').zip' ELSE '/a/t_' || (1970 + p_size) || '.zip' END AS p FROM part))""")
def path_year(spark, sf_dir):
    year = (F.col("p_size") + 1970).cast("string")
    kinds = [F.concat(F.lit("/a/"), year, F.lit("/x")), F.concat(F.lit("/a/1990-"), year, F.lit("/x")), F.concat(F.lit("/a/t ("), year, F.lit(").zip")), F.concat(F.lit("/a/t_"), year, F.lit(".zip"))]
    path = F.when(F.col("p_partkey") % 4 == 0, kinds[0]).when(F.col("p_partkey") % 4 == 1, kinds[1]).when(F.col("p_partkey") % 4 == 2, kinds[2]).otherwise(kinds[3])
    return _table(spark, sf_dir, "part").select("p_partkey", text.path_year(path).alias("path_year"))


def _in_turn(start: str, steps: list[str]) -> str:
    """SQL that applies expressions of ``x`` one after the other."""
    out = f"SELECT k, {start} AS x FROM n"
    for step in steps:
        out = f"SELECT k, {step} AS x FROM ({out})"
    return out


def _quoted(words: str) -> str:
    return "'" + words.replace("'", "''") + "'"


_FIRMS = [e.replace("\\.", ".").rstrip("$") for e in text.COMPANY_ENDINGS[:-1]]
_FIRM_STEPS = [f"coalesce(nullif(regexp_replace(x, {_quoted(p)}, '', 'g'), ''), x)" for p in text.COMPANY_ENDINGS]


@query(sql=f"""WITH n AS (SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'The ' ELSE '' END || p_type || ' ' || p_brand || [{", ".join(_quoted(e.title()) for e in _FIRMS)}][p_partkey % {len(_FIRMS)} + 1]
|| CASE p_partkey % 2 WHEN 0 THEN '' ELSE [{", ".join(_quoted(e) for e in _FIRMS)}][p_partkey * 7 % {len(_FIRMS)} + 1] END AS name FROM part UNION ALL SELECT -1, 'International Computer Entertainment' UNION ALL SELECT -2, ' Software')
SELECT r.k AS p_partkey, CASE WHEN name = 'International Computer Entertainment' THEN 'ice' ELSE trim(translate(x, '013457', 'oieast')) END AS publisher
FROM ({_in_turn("regexp_replace(lower(name), '^the ', '')", _FIRM_STEPS)}) r JOIN n ON n.k = r.k""")
def normalize_publisher(spark, sf_dir):
    """All company endings, single and doubled, with the table of the SQL being the reference's."""
    key, n = F.col("p_partkey"), len(_FIRMS)
    first = F.get(F.array(*[F.lit(e.title()) for e in _FIRMS]), (key % n).cast("int"))
    second = F.when(key % 2 == 0, "").otherwise(F.get(F.array(*[F.lit(e) for e in _FIRMS]), (key * 7 % n).cast("int")))
    name = F.concat(F.when(key % 3 == 0, "The ").otherwise(""), "p_type", F.lit(" "), "p_brand", first, second)
    rows = _table(spark, sf_dir, "part").select(key, name.alias("name"))
    more = spark.createDataFrame([(-1, "International Computer Entertainment"), (-2, " Software")], "p_partkey long, name string")
    return rows.union(more).select("p_partkey", text.normalize_publisher(F.col("name")).alias("publisher"))


@query(sql=r"SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' (' || p_type || ') II'), '\(.*\)', '', 'g'), '[^a-z0-9]', '', 'g') AS album FROM part")
def normalize_album(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", text.normalize_album_simple(F.concat("p_name", F.lit(" ("), "p_type", F.lit(") II"))).alias("album"))


#: Ends of titles, one for each kind of rule.
_ENDS = (
    "", " (x)", " PC", " ST", " - Falcon", " - Jaguar", " CD32", " AGA", " preview", " v1.2", " V3", " #4", " 012", " 007", " 05", " 0", " 1", " I", " II", " iii", " IV", " v", " VI", " vii",
    " VIII", " ix", " PAL/NTSC Selector", " 100% (+7)", " 100% +12", " (+5)", " +9", " ++", " - demo", " demo", " playable", " playable preview", " prev", " beta", " - final", ": part", " 1991",
)
_BEGINS = ("", "The ", "A ", "An ", "First ", "second ", "Third ", "fourth ", "Fifth ", "sixth ", "Seventh ", "eighth ", "Ninth ", "Game ", "Ocean ", "my second ", "big Ninth ")


def _album_sql() -> str:
    title = f"[{', '.join(map(_quoted, _BEGINS))}][p_partkey // {len(_ENDS)} % {len(_BEGINS)} + 1] || p_name || [{', '.join(map(_quoted, _ENDS))}][p_partkey % {len(_ENDS)} + 1]"
    ends = " ".join(f"WHEN ends_with(lower(t), {_quoted(e)}) THEN trim(left(t, len(t) - {len(e)}))" for e in text.UNFINISHED)
    start = f"CASE WHEN ty = 'Cracktro' THEN trim(t) || ' [cracktro]' WHEN ty = 'Game' AND NOT starts_with(lower(t), 'game ') THEN CASE {ends} ELSE t END ELSE t END"
    steps = ["regexp_replace(x, '^(?i)ocean ', '')", "regexp_replace(x, ' - .*', '', 'g')", "regexp_replace(x, ': .*', '', 'g')"]
    steps += [f"regexp_replace(x, {_quoted(p)}, {_quoted(r.replace('$1', chr(92) + '1'))}, 'g')" for p, r in text.ALBUM_RULES]
    steps += ["lower(x)", "CASE WHEN ends_with(x, ' 1991') THEN trim(left(x, len(x) - 5)) ELSE x END", "trim(regexp_replace(x, '[^A-Za-z0-9.]', '', 'g'))"]
    return f"""WITH n AS (SELECT p_partkey AS k, {title} AS t, ['Game', 'Cracktro', 'Demo', ''][p_partkey % 4 + 1] AS ty FROM part)
SELECT k AS p_partkey, x AS album FROM ({_in_turn(start, steps)})"""


@query(sql=_album_sql())
def normalize_album_full(spark, sf_dir):
    """All rules of album titles, by type, publishers and year."""
    key = F.col("p_partkey")
    begin = F.get(F.array(*[F.lit(b) for b in _BEGINS]), (F.floor(key / len(_ENDS)) % len(_BEGINS)).cast("int"))
    end = F.get(F.array(*[F.lit(e) for e in _ENDS]), (key % len(_ENDS)).cast("int"))
    kind = F.get(F.array(*[F.lit(t) for t in ("Game", "Cracktro", "Demo", "")]), (key % 4).cast("int"))
    title = F.concat(begin, "p_name", end)
    return _table(spark, sf_dir, "part").select(key, text.normalize_album(title, kind, F.array(F.lit("Ocean")), F.lit(1991)).alias("album"))


_KINDS = ("", "Compo", "game", "CRACKTRO", "Crack Intro", "import intro", "Trainer", "Demo", "fix/patch intro", "Tool")


@query(sql=f"""WITH n AS (SELECT p_partkey, CASE p_partkey // 50 % 2 WHEN 1 THEN 'Game ' ELSE '' END || p_name || [{", ".join(map(_quoted, [*text.PREVIEWS, "", " demos", "preview"]))}][p_partkey % {len(text.PREVIEWS) + 3} + 1] AS t,
[{", ".join(map(_quoted, _KINDS))}][p_partkey % {len(_KINDS)} + 1] AS k FROM part)
SELECT p_partkey, NOT starts_with(lower(t), 'game ') AND regexp_matches(lower(t), '( preview| prev| demo| beta| \\(preview\\)| \\(demo\\)| \\(beta\\)| version\\))$') AS preview,
CASE lower(k) WHEN '' THEN '' WHEN 'compo' THEN 'Compo' WHEN 'game' THEN 'Game' ELSE CASE WHEN lower(k) IN ('cracktro', 'crack intro', 'import intro', 'trainer') THEN 'Cracktro' ELSE 'Other' END END AS kind FROM n""")
def previews_and_kinds(spark, sf_dir):
    """Whether a title is a preview's, and the kind of a type."""
    key, ends = F.col("p_partkey"), [*text.PREVIEWS, "", " demos", "preview"]
    title = F.concat(F.when(F.floor(key / 50) % 2 == 1, "Game ").otherwise(""), "p_name", F.get(F.array(*[F.lit(e) for e in ends]), (key % len(ends)).cast("int")))
    kind = F.get(F.array(*[F.lit(k) for k in _KINDS]), (key % len(_KINDS)).cast("int"))
    return _table(spark, sf_dir, "part").select(key, text.is_preview(title).alias("preview"), text.normalize_type(kind).alias("kind"))


@query(sql=r"""WITH n AS (SELECT c_custkey, c_mktsegment || CASE c_custkey % 3 WHEN 0 THEN ' de' WHEN 1 THEN ' van' ELSE '' END || ' ' || n_name || CASE WHEN c_custkey % 5 = 0 THEN ' Jr.' ELSE '' END AS name,
CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN 'DJ ' || n_name WHEN 2 THEN c_mktsegment || ' ' || n_name ELSE 'Zap' END AS handle FROM customer JOIN nation ON n_nationkey = c_nationkey),
q AS (SELECT *, CASE WHEN ends_with(name, ' Jr.') THEN left(name, len(name) - 4) ELSE name END AS bare FROM n),
z AS (SELECT *, string_split(bare, ' ') AS w, string_split(name, ' ') AS v FROM q)
SELECT c_custkey, CASE WHEN lower(string_split(handle, ' ')[-1]) = lower(w[-1]) AND len(handle) <> len(w[1] || ' ' || w[-1]) THEN NULL WHEN len(w) >= 3 AND NOT list_contains(w, 'van') THEN w[1] || ' ' || w[-1] ELSE name END AS real_name,
CASE WHEN len(v) = 2 THEN left(v[1], 1) || '. ' || v[2] ELSE left(v[1], 1) || '. ' || v[-1] || '~' || v[1] || ' ' || v[-1] END AS variants FROM z""")
def real_names(spark, sf_dir):
    """Real names beside their handles, and short forms of names."""
    key = F.col("c_custkey")
    middle = F.when(key % 3 == 0, " de").when(key % 3 == 1, " van").otherwise("")
    name = F.concat("c_mktsegment", middle, F.lit(" "), "n_name", F.when(key % 5 == 0, " Jr.").otherwise(""))
    handle = F.when(key % 4 == 0, F.col("n_name")).when(key % 4 == 1, F.concat(F.lit("DJ "), "n_name")).when(key % 4 == 2, F.concat_ws(" ", "c_mktsegment", "n_name")).otherwise("Zap")
    rows = _table(spark, sf_dir, "customer").join(_table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(key, name.alias("n"), handle.alias("h"))
    return rows.select("c_custkey", text.real_name(F.col("n"), F.col("h")).alias("real_name"), F.array_join(text.name_variants(F.col("n")), "~").alias("variants"))


@query(sql=r"SELECT doc_id, translate(regexp_replace(strip_accents(replace(regexp_replace(lower(text), ' \[2 musicians\]$', ''), 'ß', 'ss')), '[^a-z0-9]', '', 'g'), '013457', 'oieast') AS author FROM documents")
def normalize_author(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.normalize_author(F.col("text")).alias("author"))


@query(sql=r"SELECT p_partkey, 'The ' || p_name || ' (' || p_brand || ')' AS title, p_name || ' (' || p_brand || ')' AS bare FROM part")
def article_rotation(spark, sf_dir):
    rotated = text.rotate_article(F.concat("p_name", F.lit(", The ("), "p_brand", F.lit(")")))
    title = F.regexp_replace(rotated, r" {2,}", " ")
    return _table(spark, sf_dir, "part").select("p_partkey", title.alias("title"), text.remove_article(title).alias("bare"))


@query(sql="""SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value
FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""")
def locf(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return ordered.carry_forward(events, ["user_id"], [F.col("ts"), F.col("event_id")], "value").select("event_id", "value")


@query(sql="SELECT user_id, event_id, event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS delta FROM events")
def delta_encode(spark, sf_dir):
    return ordered.delta_encode(_table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id")


@query(sql="SELECT user_id, event_id, event_id AS decoded FROM events")
def delta_round_trip(spark, sf_dir):
    coded = ordered.delta_encode(_table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id")
    return ordered.delta_decode(coded, ["user_id"], [F.col("event_id")], "delta", "decoded").drop("delta")


@query(sql="""SELECT o_orderkey, CASE WHEN lag(o_orderstatus) OVER w = o_orderstatus THEN chr(127) ELSE o_orderstatus END AS o_orderstatus,
CASE WHEN lag(o_orderpriority) OVER w = o_orderpriority THEN chr(127) ELSE o_orderpriority END AS o_orderpriority FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def repeat_marker(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return ordered.mark_repeats(orders, ["o_custkey"], [F.col("o_orderkey")], ["o_orderstatus", "o_orderpriority"]).drop("o_custkey")


@query(sql="SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def repeat_round_trip(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    values = ["o_orderstatus", "o_orderpriority"]
    return export.decode_repeats(export.encode_repeats(orders, ["o_custkey"], ["o_orderkey"], values), ["o_custkey"], ["o_orderkey"], values)


@query(sql="SELECT o_orderkey, chr((45 + ((o_orderkey >> 18) & 63))::INT) || chr((45 + ((o_orderkey >> 12) & 63))::INT) || chr((45 + ((o_orderkey >> 6) & 63))::INT) || chr((45 + (o_orderkey & 63))::INT) AS code, o_orderkey AS decoded FROM orders")
def base64_24(spark, sf_dir):
    code = codec.base64_digits(F.col("o_orderkey"), 4)
    return _table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"), codec.base64_value(code).alias("decoded"))


@query(sql="SELECT DISTINCT k AS key, k AS decoded FROM (SELECT ('0x' || substr(md5(text), 1, 12))::BIGINT AS k FROM documents)")
def key_index_round_trip(spark, sf_dir):
    keys = _table(spark, sf_dir, "documents").select(codec.content_key(F.md5(_text())).alias("k"))
    return export.decode_keys(export.encode_keys(keys, "k")).select("key", "decoded")


@query(sql="SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS idx FROM customer")
def rank_index(spark, sf_dir):
    return ordered.rank_index(_table(spark, sf_dir, "customer").select("c_name", "c_custkey"), ["c_name", "c_custkey"]).select("c_custkey", "idx")


_DIGIT = "chr((45 + ((steps >> {0}) & 63))::INT)"


@query(sql=f"""WITH t AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'player' WHEN 'assistant' THEN 'loop+volume' ELSE 'silence' END AS e, length(text) // 300 * 300 AS ms, turn % 3 = 2 AS dup FROM conversations),
q AS (SELECT *, CASE WHEN ms > 0 AND ms < 20 THEN 1 ELSE (ms + 10) // 20 END AS steps FROM t),
c AS (SELECT *, CASE WHEN steps = 0 THEN '-' ELSE ltrim({" || ".join(_DIGIT.format(k) for k in (18, 12, 6, 0))}, '-') END || CASE e WHEN 'player' THEN '' WHEN 'loop+volume' THEN ',L' ELSE ',s' END AS told FROM q),
l AS (SELECT *, lag(told) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM c)
SELECT conv_id, min(turn) AS minsubsong, string_agg(CASE WHEN told = before THEN CASE WHEN dup THEN '!' ELSE '' END ELSE told || CASE WHEN dup THEN ',!' ELSE '' END END, ' ' ORDER BY turn) AS line,
string_agg((steps * 20)::VARCHAR || e || dup::VARCHAR, ' ' ORDER BY turn) AS back FROM l GROUP BY conv_id""")
def subsong_array(spark, sf_dir):
    """Lengths of a file's parts as one compact line, and read back from it."""
    end = F.when(F.col("role") == "user", "player").when(F.col("role") == "assistant", "loop+volume").otherwise("silence")
    part = F.struct("turn", (F.floor(F.length("text") / 300) * 300).cast("long").alias("length"), end.alias("end"), (F.col("turn") % 3 == 2).alias("duplicate"))
    kept = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min("turn").alias("minsubsong"), F.array_sort(F.collect_list(part)).alias("parts"))
    lines = kept.select("conv_id", "minsubsong", codec.lengths_line(F.col("parts")).alias("line"))
    told = F.transform(codec.parse_lengths(F.col("line")), lambda e: F.concat(e["length"].cast("string"), e["end"], e["duplicate"].cast("string")))
    return lines.withColumn("back", F.array_join(told, " "))


@query(sql="""WITH g AS (SELECT conv_id, role, max((role = 'user')::INT) AS p, count(DISTINCT turn) AS m, floor(sum(length(text)) / count(*))::BIGINT AS a FROM conversations GROUP BY ALL)
SELECT conv_id, role, m AS numbers, a AS average FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p DESC, m DESC, a DESC, role) AS rn FROM g) WHERE rn = 1""")
def longest_entry(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "role", "turn", F.length("text").alias("chars"))
    return records.longest_entry(turns, ["conv_id"], F.col("role") == "user", "role", "turn", "chars").drop("lengths")


def _signs(spark, sf_dir):
    """Signs of the 64 components as two words of 32 bits."""
    word = lambda a: F.aggregate(F.slice("embedding", a, 32), F.lit(0).cast("long"), lambda n, x: n * 2 + (x > 0).cast("long"))
    return _table(spark, sf_dir, "embeddings").select("vec_id", "label", F.array(word(1), word(33)).alias("words"))


_BITS = "(SELECT vec_id, label, list_transform(range(1, 65), lambda i: (embedding[i] > 0)::INT) AS bits FROM embeddings)"


@query(sql=f"""WITH e AS {_BITS}, s AS (SELECT p.vec_id AS probe, e.vec_id, 1 - (SELECT sum(abs(e.bits[i] - p.bits[i])) FROM range(1, 65) t(i)) / 64.0::DOUBLE AS score FROM e, e p WHERE p.vec_id % 50 = 0 AND e.vec_id <> p.vec_id)
SELECT probe, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, vec_id) AS rn FROM s) WHERE rn <= 20""")
def hamming_topk(spark, sf_dir):
    """The 20 nearest rows of every row whose id is divisible by 50, among all rows."""
    signs = _signs(spark, sf_dir).select("vec_id", "words")
    probes = signs.filter("vec_id % 50 = 0").toDF("probe", "wanted")
    scored = signs.join(probes, F.col("vec_id") != F.col("probe")).select("probe", "vec_id", hamming_similarity(F.col("words"), F.col("wanted"), 64).alias("score"))
    return records.ranked(scored, ["probe"], F.col("score"), [F.col("vec_id")]).filter("rank <= 20").drop("rank")


@query(sql=f"""WITH e AS {_BITS}, x AS (SELECT label, i, sum(bits[i] * 2 - 1) AS s FROM e, range(1, 65) t(i) GROUP BY ALL)
SELECT label, string_agg(CASE WHEN s > 0 THEN '1' ELSE '0' END, '' ORDER BY i) AS simhash FROM x GROUP BY label""")
def simhash_block(spark, sf_dir):
    bits = _table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    votes = bits.groupBy("label", "i").agg(F.sum(F.when(F.col("x") > 0, 1).otherwise(-1)).alias("s"))
    ordered_bits = F.array_sort(F.collect_list(F.struct("i", F.when(F.col("s") > 0, "1").otherwise("0").alias("b"))))
    return votes.groupBy("label").agg(F.array_join(F.transform(ordered_bits, lambda x: x["b"]), "").alias("simhash"))


@query(sql=f"""WITH e AS {_BITS} SELECT a.vec_id AS a_id, b.vec_id AS b_id FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id
WHERE (SELECT sum(abs(a.bits[i] - b.bits[i])) FROM range(1, 65) t(i)) <= 22""")
def fingerprint_band_match(spark, sf_dir):
    """Pairs of a label within 22 of 64 bits: a third of the bits apart leaves no key that loses no pair, so a label's rows meet in blocks."""
    near = hamming_similarity(F.col("a.words"), F.col("b.words"), 64) >= 1 - 22 / 64
    pairs = joins.pairs_in_blocks(_signs(spark, sf_dir), "label", "vec_id", near)
    return pairs.select(F.col("a.vec_id").alias("a_id"), F.col("b.vec_id").alias("b_id"))


_TEXT_COMPONENTS = """e AS (SELECT DISTINCT doc_id, md5(l) AS k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE length(l) > 40
UNION SELECT doc_id, md5(text) FROM documents WHERE text IS NOT NULL), s AS (SELECT k, min(doc_id) AS m FROM e GROUP BY k), g AS (SELECT DISTINCT e.doc_id AS a, s.m AS b FROM e JOIN s USING (k) WHERE e.doc_id <> s.m),
u AS (SELECT a, b FROM g UNION SELECT b, a FROM g), r(x, y) AS (SELECT DISTINCT a, a FROM u UNION SELECT u.a, r.y FROM u JOIN r ON u.b = r.x),
c AS (SELECT doc_id, coalesce((SELECT min(y) FROM r WHERE x = doc_id), doc_id) AS component FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL))"""


def _text_components(docs: DataFrame) -> DataFrame:
    """(doc_id, component) of every document with an id: documents are joined that share their whole text or a line of over 40 characters.

    Shorter lines (headings, braces, blanks) make no link, as unrelated documents share them.  Empty texts are equal to each
    other; a null text equals no other.
    """
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("l")).filter("length(l) > 40")
    whole = docs.filter("text is not null").select("doc_id", F.col("text").alias("l"))
    keys = lines.union(whole).select("doc_id", F.md5(F.col("l").cast("binary")).alias("k"))
    found = graph.shared_key_components(keys, "doc_id", "k")
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    return ids.join(found, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))


@query(sql=f"WITH RECURSIVE {_TEXT_COMPONENTS} SELECT doc_id, component FROM c")
def components(spark, sf_dir):
    """Components of documents by shared texts and long lines, a row for each document."""
    return _text_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(sql=f"""WITH RECURSIVE {_TEXT_COMPONENTS}, m AS (SELECT component AS cluster, doc_id, lang, row_number() OVER (PARTITION BY component ORDER BY n_chars DESC, doc_id, lang NULLS FIRST) AS rn, count(*) OVER (PARTITION BY component) AS n FROM documents JOIN c USING (doc_id))
SELECT cluster, n AS n_members, doc_id AS best_doc_id, lang AS best_lang FROM m WHERE rn = 1""")
def duplicate_clusters(spark, sf_dir):
    """Documents joined by an equal text or a shared long line, with the longest document of each cluster."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    found = _text_components(docs.select("doc_id", "text"))
    members = docs.select("doc_id", "lang", "n_chars").join(found, "doc_id", "left").withColumn("cluster", F.coalesce("component", "doc_id"))
    size = members.groupBy("cluster").agg(F.count("*").alias("n_members"), F.min(F.struct((-F.col("n_chars")).alias("c"), "doc_id", "lang")).alias("best"))
    return size.select("cluster", "n_members", F.col("best.doc_id").alias("best_doc_id"), F.col("best.lang").alias("best_lang"))


@query(sql="""WITH s AS (SELECT DISTINCT conv_id AS w, role AS part FROM conversations), m AS (SELECT DISTINCT text AS t, conv_id, turn FROM conversations)
SELECT DISTINCT x.conv_id AS whole FROM conversations x JOIN conversations y ON x.conv_id = y.conv_id AND x.turn < y.turn WHERE length(x.text) <> length(y.text)""")
def medley(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    subset = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("part"), F.col("conv_id").alias("whole"), "n")
    x, y = subset.alias("x"), subset.alias("y")
    same = x.join(y, (F.col("x.whole") == F.col("y.whole")) & (F.col("x.n") == F.col("y.n"))).select(F.col("x.part").alias("a"), F.col("y.part").alias("b"))
    return graph.medleys(subset.select("part", "whole"), same)


@query(sql="""SELECT d.doc_id, d.n_chars, l.quality FROM (SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25) d LEFT JOIN labels l USING (doc_id)""")
def topk_with_meta(spark, sf_dir):
    top = ordered.top_k(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), F.col("n_chars"), [F.col("doc_id")], 25)
    return top.join(_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "n_chars", "quality")


@query(sql="SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def anti_join(spark, sf_dir):
    rich = _table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return nation.join(rich, nation.n_nationkey == rich.s_nationkey, "left_anti")


@query(sql="SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 0 UNION SELECT s_nationkey FROM supplier")
def set_union(spark, sf_dir):
    return _table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_nationkey").alias("k")).union(_table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query(sql="SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9900 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def set_intersect(spark, sf_dir):
    return _table(spark, sf_dir, "customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")).intersect(_table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select("s_nationkey"))


@query(sql="SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def multiset_except(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).exceptAll(_table(spark, sf_dir, "supplier").select("s_nationkey"))


@query(sql="SELECT w AS value, string_agg(DISTINCT p_partkey::VARCHAR, '~' ORDER BY p_partkey::VARCHAR) AS records FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def inverted_index(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("p"), F.split("p_name", " ").alias("ws"))
    return records.inverted_index(part, "ws", "p").select("value", F.array_join("records", "~").alias("records"))


@query(sql="SELECT o_orderkey, p // 20 AS steps FROM (SELECT o_orderkey, (floor(o_totalprice)::BIGINT + 10) AS p FROM orders)")
def quantised_lengths(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", codec.quantise(F.floor("o_totalprice")).alias("steps"))


@query(sql=r"""WITH d AS (SELECT doc_id, md5(text) AS h, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT * 11025 AS b FROM documents), k AS (SELECT doc_id, 'p-h-' || h AS tag FROM d
UNION ALL SELECT doc_id, unnest(list_distinct(['p-l-' || ((b + 5512) // 22050)::VARCHAR, 'p-l-' || ((b - 5512) // 22050)::VARCHAR])) FROM d WHERE b > 198450)
SELECT tag, count(*) AS n, min(doc_id) AS first FROM k GROUP BY tag""")
def blocking_tags(spark, sf_dir):
    """Tags by hash and by whole seconds a quarter second either way, of recordings without a grouped hash."""
    from .operators.recordings import tags_of

    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    every, _ = tags_of(F.lit("p"), words * 11025, F.md5(F.col("text").cast("binary")), F.lit(None).cast("int"))
    tags = _table(spark, sf_dir, "documents").select("doc_id", F.explode(every).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
