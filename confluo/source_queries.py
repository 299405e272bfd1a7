"""Readers and writers as queries: small files are written from the driver's tables to the shared folder and read back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .plans.storage import new_path
from .queries import _table
from .registry import query
from .sources import export, listings


def _written(df: DataFrame, label: str, value: str = "value", folders: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> str:
    """Path of text files with the column ``value``, one folder for each of ``folders``, in order of ``order`` inside a file."""
    path = new_path(df.sparkSession, label)
    if folders:
        df = df.repartition(*folders)
    if order:
        df = df.sortWithinPartitions(*folders, *order)
    writer = df.select(F.col(value).alias("value"), *folders).write
    (writer.partitionBy(*folders) if folders else writer).text(path)
    return path


def _tabbed(*columns) -> F.Column:
    return F.concat_ws("\t", *columns)


@query(sql="""WITH t AS (SELECT conv_id, turn, role, text, 'src' || conv_id % 3 AS source, md5('c' || conv_id) AS md5, min(turn) OVER (PARTITION BY conv_id) AS first FROM conversations)
SELECT source, md5, turn + 1 AS subsong, length(text) AS songlength, role AS songend, 'player' || conv_id % 2 AS player, CASE WHEN turn = first THEN 'F' || conv_id % 4 END AS format, CASE WHEN turn = first THEN 4 ELSE 0 END AS channels FROM t""")
def read_listing(spark, sf_dir):
    """Ragged listings in folders by source: full rows, short rows that go on, subsongs that begin at 0 moved to 1."""
    c = F.col("conv_id")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("string").alias("n"), F.concat(F.lit("src"), (c % 3).cast("string")).alias("source"), F.md5(F.concat(F.lit("c"), c.cast("string"))).alias("md5"))
    first = turns.groupBy(F.col("conv_id").alias("__c")).agg(F.min("turn").alias("first"))
    rows = turns.join(first, c == F.col("__c"))
    short = _tabbed("md5", F.col("turn").cast("string"), "n", "role")
    full = _tabbed(short, F.concat(F.lit("player"), (c % 2).cast("string")), F.concat(F.lit("F"), (c % 4).cast("string")), F.lit("4"), F.lit("10"), F.lit("x"), F.lit("y"), F.lit("a/b.mod"))
    path = _written(rows.withColumn("value", F.when(F.col("turn") == F.col("first"), full).otherwise(short)), "listing", folders=("source",), order=("conv_id", "turn"))
    read = listings.shifted_subsongs(listings.read_listing(spark, path))
    return read.select("source", "md5", F.col("subsong").cast("long").alias("subsong"), F.col("songlength").cast("long").alias("songlength"), "songend", "player", "format", "channels")


@query(sql="SELECT n_name AS name, n_regionkey::BIGINT AS region, 'T' || n_nationkey || ' (1991)(' || n_name || ')(demo)[cr]' AS title, 1991 AS year, true AS demo FROM nation")
def read_catalog(spark, sf_dir):
    """An XML catalogue of games, their names taken apart."""
    path = new_path(spark, "catalog")
    nation = _table(spark, sf_dir, "nation")
    title = F.concat(F.lit("T"), F.col("n_nationkey").cast("string"), F.lit(" (1991)("), "n_name", F.lit(")(demo)[cr]"))
    nation.select(title.alias("_name"), F.col("n_regionkey").alias("region"), F.col("n_name").alias("maker")).write.format("xml").option("rowTag", "game").option("rootTag", "datafile").save(path)
    rows = spark.read.format("xml").option("rowTag", "game").schema("_name string, region long, maker string").load(path)
    parts = text.catalog_name(F.col("_name"))
    return rows.select(parts["publisher"].alias("name"), "region", F.col("_name").alias("title"), parts["year"].alias("year"), parts["demo"].alias("demo"))


@query(sql="""SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN s_name WHEN 1 THEN s_name || '~x' ELSE '' END AS authors FROM supplier""")
def read_yaml(spark, sf_dir):
    """YAML documents with a field that is a single value, a list or missing."""
    key = F.col("s_suppkey")
    authors = F.when(key % 3 == 0, F.concat(F.lit("\nauthors: "), "s_name")).when(key % 3 == 1, F.concat(F.lit("\nauthors: ["), "s_name", F.lit(", x]"))).otherwise("")
    path = _written(_table(spark, sf_dir, "supplier").withColumn("value", F.concat(F.lit("---\nid: "), key.cast("string"), authors)), "yaml")
    docs = listings.read_yaml(spark, path)
    read = docs.select(F.get_json_object("json", "$.id").cast("long").alias("id"), F.get_json_object("json", "$.authors").alias("a"))
    return read.select("id", F.array_join(listings.as_list("a"), "~").alias("authors"))


def _workbooks(rows: DataFrame) -> DataFrame:
    """(path, content): a workbook per brand with eleven sheets, the parts in the last one."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        import io
        import zipfile

        part = part.sort_values("p_partkey")
        out = io.BytesIO()
        names = sorted(set(part["p_name"]))
        space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/sharedStrings.xml", f"<sst {space}>" + "".join(f"<si><t>{n}</t></si>" for n in names) + "</sst>")
            for sheet in range(1, 12):
                mine = part.to_dict("records") if sheet == 11 else []
                cells = "".join(f'<row r="{i}"><c r="A{i}"><v>{r["p_partkey"]}</v></c><c r="C{i}" t="s"><v>{names.index(r["p_name"])}</v></c></row>' for i, r in enumerate(mine, 1))
                z.writestr(f"xl/worksheets/sheet{sheet}.xml", f"<worksheet {space}><sheetData>{cells}</sheetData></worksheet>")
        return pd.DataFrame({"path": [part["p_brand"].iloc[0]], "content": [out.getvalue()]})

    return rows.groupBy("p_brand").applyInPandas(build, "path string, content binary")


@query(sql="""SELECT p_brand AS path, 11 AS sheet, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)::INT AS row, p_partkey::VARCHAR || '||' || p_name AS cells FROM part""")
def read_workbooks(spark, sf_dir):
    """Workbooks of several sheets, with shared strings and empty cells."""
    books = _workbooks(_table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name"))
    return listings.parse_xlsx(books).select("path", "sheet", "row", F.array_join("cells", "|").alias("cells"))


@query(sql="SELECT c_custkey, c_name || ' é' AS name, c_acctbal FROM customer")
def read_semicolons(spark, sf_dir):
    """Semicolon-separated ISO-8859-1."""
    path = new_path(spark, "semicolons")
    _table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(" é")).alias("name"), "c_acctbal").write.csv(path, sep=";", encoding="ISO-8859-1")
    return listings.read_semicolon(spark, path, "c_custkey long, name string, c_acctbal double")


@query(sql="SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority, '\"' || o_orderstatus AS status FROM orders")
def read_tabs(spark, sf_dir):
    """Tab-separated without quotes, null as nothing."""
    path = new_path(spark, "tabs")
    priority = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
    export.write_tabs(_table(spark, sf_dir, "orders").select("o_orderkey", priority.alias("priority"), F.concat(F.lit('"'), "o_orderstatus").alias("status")), path)
    return listings.read_tabs(spark, path, "o_orderkey long, priority string, status string")


@query(sql="""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '' ELSE replace(p_name, ' ', '~') || CASE WHEN p_size % 4 = 2 THEN '' ELSE '~' || p_brand END END AS listed FROM part""")
def read_array_literals(spark, sf_dir):
    """Array literals of a database dump, some quoted, with NULLs."""
    words = F.array_join(F.split("p_name", " "), ",")
    literal = F.when(F.col("p_size") % 4 == 0, "{NULL}").when(F.col("p_size") % 4 == 2, F.concat(F.lit("{"), words, F.lit(",NULL}"))).otherwise(F.concat(F.lit("{"), words, F.lit(',"'), "p_brand", F.lit('"}')))
    path = _written(_table(spark, sf_dir, "part").withColumn("value", _tabbed(F.col("p_partkey").cast("string"), literal)), "dump")
    rows = listings.read_tabs(spark, path, "p_partkey long, literal string")
    return rows.select("p_partkey", F.array_join(text.postgres_array(F.col("literal")), "~").alias("listed"))


@query(sql="SELECT p_brand AS section, p_name AS title, p_size::INT AS minutes, p_partkey AS id FROM part")
def read_sections(spark, sf_dir):
    """A listing of fixed format in sections: a header line, then lines of a title, dots and numbers."""
    part = _table(spark, sf_dir, "part")
    lines = part.select("p_brand", F.col("p_partkey").alias("k"), F.concat(F.rpad("p_name", 40, "."), F.lpad(F.col("p_size").cast("string"), 4, " "), F.lit("  #"), F.col("p_partkey").cast("string")).alias("value"))
    heads = part.select("p_brand").distinct().select("p_brand", F.lit(-1).cast("long").alias("k"), F.concat(F.lit("== "), "p_brand", F.lit(" ==")).alias("value"))
    path = _written(lines.union(heads).withColumn("folder", F.col("p_brand")), "sections", folders=("folder",), order=("k",))
    read = spark.read.text(path).select("folder", F.monotonically_increasing_id().alias("place"), "value")
    placed = listings.section_lines(read, "folder", "place", "value", r"^== (.*) ==$")
    rows = listings.fixed_records(placed, "value", r"^(.*?)\.* *([0-9]+)  #([0-9]+)$", ["title", "minutes", "id"])
    return rows.select("section", "title", F.col("minutes").cast("int").alias("minutes"), F.col("id").cast("long").alias("id"))


@query(sql="""SELECT 'Customer ' || o_custkey AS title, 0 AS number, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INT AS row, o_orderkey || '~' || o_orderpriority || ' (' || o_orderstatus || ')' AS cells FROM orders""")
def read_wiki(spark, sf_dir):
    """A wiki dump with a table on each page: rows, attributes of cells, lines that go on."""
    row = F.concat(F.lit("|-\n| align=right | "), F.col("o_orderkey").cast("string"), F.lit(" || "), "o_orderpriority", F.lit("\n ("), "o_orderstatus", F.lit(")\n"))
    table = F.concat(F.lit("Intro | text\n{| class=wikitable\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("r")))), lambda x: x["r"]), ""), F.lit("|}\nOutro"))
    pages = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(table.alias("text"))
    path = new_path(spark, "wiki")
    pages.select(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("title"), F.struct("text").alias("revision")).write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    return listings.read_wiki(spark, path).select("title", "number", "row", F.array_join("cells", "~").alias("cells"))


@query(sql="""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) <> '' AS titled, len(regexp_extract_all(html, '<li><a href="[^"]*">')) AS links, regexp_extract(html, '<li><a href="([^"]*)">', 1) AS first_link, regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang FROM pages""")
def read_pages(spark, sf_dir):
    """Fields of HTML pages by selectors."""
    fields = listings.html_fields({"title": "head title", "links": "li a@href", "lang": "html@lang"})
    read = _table(spark, sf_dir, "pages").select("page_id", fields("html").alias("f"))
    first = F.coalesce(F.get(F.col("f")["links"], F.lit(0)), F.lit(""))
    return read.select("page_id", (F.size(F.col("f")["title"]) > 0).alias("titled"), F.size(F.col("f")["links"]).cast("long").alias("links"), first.alias("first_link"), F.get(F.col("f")["lang"], F.lit(0)).alias("lang"))


@query(sql="""WITH r AS (SELECT r_name, sum(strlen(n_name) + 1)::BIGINT AS bytes FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1) SELECT r_name AS folder, bytes AS size, bytes + length(r_name) % 2 AS expected, length(r_name) % 2 = 1 AS wrong FROM r""")
def directory_sizes(spark, sf_dir):
    """Files as data: a folder's name carries a field, the size is checked against what was pinned."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("value"), F.col("r_name").alias("folder"))
    path = _written(rows, "sizes", folders=("folder",))
    folder = F.regexp_replace(F.regexp_extract("path", "folder=([^/]*)/", 1), "%20", " ")
    listed = listings.directory_listing(spark, path, "*.txt").select(F.element_at(F.split("path", "/"), -1).alias("file"), folder.alias("folder"), F.col("length").alias("size"))
    expected = listed.select("file", "folder", "size", (F.col("size") + F.length("folder") % 2).cast("long").alias("expected"))
    files = spark.read.text(path)
    wrong = listings.check_sizes(files, expected.select("file", "expected", F.col("folder").alias("of_folder"))).select(F.col("of_folder").alias("w"))
    return expected.join(wrong, F.col("folder") == F.col("w"), "left").select("folder", "size", "expected", F.col("w").isNotNull().alias("wrong"))


@query(sql="""SELECT o_orderkey::VARCHAR AS hash, o_orderstatus AS authors, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority || '~x' END AS publishers, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'album' || o_custkey END AS album, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE year(o_orderdate)::INT END AS year FROM orders""")
def pretty_metadata(spark, sf_dir):
    """Metadata lines written and read back."""
    key = F.col("o_orderkey")
    none = F.array().cast("array<string>")
    rows = _table(spark, sf_dir, "orders").select(
        key.cast("string").alias("hash"), F.array("o_orderstatus").alias("authors"), F.when(key % 3 == 0, none).otherwise(F.array("o_orderpriority", F.lit("x"))).alias("publishers"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("album"), F.col("o_custkey").cast("string"))).alias("album"), F.when(key % 5 == 0, 0).otherwise(F.year("o_orderdate")).alias("year"),
    )
    path = _written(export.pretty_metadata(rows), "metadata")
    return export.read_metadata(spark, path).select("hash", F.array_join("authors", "~").alias("authors"), F.array_join("publishers", "~").alias("publishers"), "album", "year")


@query(sql="SELECT p_partkey::VARCHAR AS hash, CASE WHEN p_size % 7 = 0 THEN '' ELSE p_type END AS format, CASE WHEN p_size % 2 = 0 THEN 0 ELSE p_size::INT END AS channels FROM part")
def pretty_modinfos(spark, sf_dir):
    """Format lines written and read back."""
    part = _table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").cast("string").alias("hash"), F.when(F.col("p_size") % 7 == 0, "").otherwise(F.col("p_type")).alias("format"), F.when(F.col("p_size") % 2 == 0, 0).otherwise(F.col("p_size")).alias("channels"))
    return export.parse_modinfos(spark.read.text(_written(export.pretty_modinfos(rows), "modinfos")))


@query(sql="SELECT conv_id AS hash, turn AS subsong, length(text) AS length, CASE role WHEN 'user' THEN 'player' ELSE role END AS end FROM conversations")
def pretty_lengths(spark, sf_dir):
    """Song lengths as lines and read back."""
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("hash"), F.col("turn").alias("subsong"), F.length("text").cast("long").alias("length"), F.when(F.col("role") == "user", "player").otherwise(F.col("role")).alias("end"))
    return export.parse_lengths_lines(export.pretty_lengths(turns))


@query(sql="SELECT o_orderkey AS idx, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS status, o_orderpriority AS priority, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE year(o_orderdate)::VARCHAR END AS year FROM orders")
def encoded_metadata(spark, sf_dir):
    """Records in the compact file (indices, repeats, differences) and read back from it."""
    key = F.col("o_orderkey")
    rows = _table(spark, sf_dir, "orders").select(key.alias("idx"), F.when(key % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"), F.when(key % 2 == 0, "").otherwise(F.year("o_orderdate").cast("string")).alias("year"))
    values = ["status", "priority", "year"]
    return export.decode_records(export.encode_records(rows, "idx", values), "idx", values)


@query(sql="SELECT count(*) AS n_lines, sum(CASE WHEN rn > 1 THEN 1 ELSE 0 END)::BIGINT AS n_alone FROM (SELECT row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders)")
def encoded_lines(spark, sf_dir):
    """How the compact file shrinks records that repeat: one full line for each value, differences for the rest."""
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"), F.col("o_orderstatus").alias("status"))
    lines = export.encode_records(rows, "idx", ["status"])
    shards = lines.groupBy("shard").agg(F.sum((F.instr("line", "\t") > 0).cast("long")).alias("full"))
    values = rows.select("status").distinct().count()
    told = lines.agg(F.count("*").alias("n_lines"), F.sum((F.instr("line", "\t") == 0).cast("long")).alias("alone"))
    # a value that goes over several shards has a full line in each
    extra = shards.agg((F.sum("full") - values).alias("extra"))
    return told.join(extra, F.lit(True)).select("n_lines", (F.col("alone") + F.col("extra")).alias("n_alone"))
