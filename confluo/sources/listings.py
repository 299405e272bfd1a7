"""Listings, catalogues and markup as tables."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = ("md5", "subsong", "songlength", "songend", "player", "format", "channels", "filesize", "xxh32", "crc32", "path")
_INTS = {"subsong", "songlength", "channels", "filesize"}


def read_listing(spark: SparkSession, path: str, source: DataFrame | None = None) -> DataFrame:
    """Ragged tab-separated listings: full rows of 11 fields, and short rows of 4 that go on with their hash's player.

    Adds file and, from (file, source), source; folder columns (`source=x`) are kept.  Rows keep their place in the file;
    missing numbers are 0.
    """
    text = spark.read.text(path)
    folders = [c for c in text.columns if c != "value"]
    lines = text.select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"), F.split("value", "\t").alias("f"), *folders)
    cells = [F.coalesce(F.get("f", F.lit(i)).try_cast("int"), F.lit(0)).alias(n) if n in _INTS else F.get("f", F.lit(i)).alias(n) for i, n in enumerate(ROW)]
    rows = lines.filter("size(f) >= 4").select("file", "place", *folders, *cells)
    w = Window.partitionBy("file", "md5").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("player", F.last("player", ignorenulls=True).over(w))
    return rows if source is None else rows.join(source, "file", "left")


def shifted_subsongs(rows: DataFrame) -> DataFrame:
    """subsong + 1 from where a (md5, player) has had a subsong 0, so that numbering starts at 1."""
    w = Window.partitionBy("md5", "player").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("subsong", F.col("subsong") + F.max((F.col("subsong") == 0).cast("int")).over(w))


def check_sizes(files: DataFrame, expected: DataFrame) -> DataFrame:
    """(file, expected, size) of files whose size isn't the one pinned; empty if all are right."""
    found = files.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    return expected.join(found, "file", "left").filter(F.col("size").isNull() | (F.col("size") != F.col("expected")))


def read_catalog_xml(spark: SparkSession, path: str, row: str = "game") -> DataFrame:
    return spark.read.format("xml").option("rowTag", row).load(path)


def read_semicolon(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.csv(path, sep=";", encoding="ISO-8859-1", schema=schema, header=False)


def read_tabs(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.csv(path, sep="\t", quote="", schema=schema, header=False)


class _Cells(HTMLParser):
    """Rows of cells of all tables, and the links of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.links: list[str] = []
        self._cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self._cell = []
        elif tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v]

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self._cell).split()))
            self._cell = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


_PAGE = T.StructType(
    [T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("links", T.ArrayType(T.StringType()))]
)


@F.pandas_udf(_PAGE)
def html_tables(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Table rows and link targets of HTML pages; null pages have none."""
    for batch in pages:
        out = []
        for html in batch:
            parser = _Cells()
            parser.feed(html or "")
            parser.close()
            out.append(([r for r in parser.rows if r], parser.links))
        yield pd.DataFrame(out, columns=["rows", "links"])


def section_lines(lines: DataFrame, key: str, place: str, text: str, header: str) -> DataFrame:
    """Lines with the section whose header (first group of the pattern) came last before them; headers are left out."""
    found = F.regexp_extract(F.col(text), header, 1)
    w = Window.partitionBy(key).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("__head", F.when(found != "", found))
    return marked.withColumn("section", F.last("__head", ignorenulls=True).over(w)).filter("__head is null").drop("__head")


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """(path, json) of each YAML document; needs PyYAML on the executors."""
    import yaml  # noqa: F401  fails early where it is missing

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def documents(texts: pd.Series) -> pd.Series:
        import json

        import yaml

        return texts.map(lambda t: [json.dumps(d, default=str) for d in yaml.safe_load_all(t)])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.explode(documents("value")).alias("json"))


def parse_xlsx(files: DataFrame) -> DataFrame:
    """(path, sheet, row, cells) of workbooks (path, content), with the standard library's zip and XML alone.

    Sheets are numbered as in their file names, 10 after 9.
    """
    schema = "path string, sheet int, row int, cells array<string>"

    def sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import re
        import xml.etree.ElementTree as ET
        import zipfile

        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    shared = []
                    if "xl/sharedStrings.xml" in z.namelist():
                        shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
                    numbered = [(int(m.group(1)), m.group()) for m in (re.fullmatch(r"xl/worksheets/sheet(\d+)\.xml", n) for n in z.namelist()) if m]
                    for number, sheet in sorted(numbered):
                        for row in ET.fromstring(z.read(sheet)).iter(f"{ns}row"):
                            cells: list[str] = []
                            for c in row.iter(f"{ns}c"):
                                column = 0
                                for ch in re.match(r"[A-Z]*", c.get("r", "")).group():
                                    column = column * 26 + ord(ch) - 64
                                cells += [""] * max(0, column - 1 - len(cells))
                                value = c.findtext(f"{ns}v") or "".join(t.text or "" for t in c.iter(f"{ns}t"))
                                cells.append(shared[int(value)] if c.get("t") == "s" else value)
                            rows.append((name, number, int(row.get("r", 0)), cells))
            yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells"])

    return files.select("path", "content").mapInPandas(sheets, schema)


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    return parse_xlsx(spark.read.format("binaryFile").load(path))


def directory_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Names and sizes of files as data; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")


def fixed_records(lines: DataFrame, text: str, pattern: str, fields: list[str]) -> DataFrame:
    """Lines that match a fixed format, with the pattern's groups as trimmed columns; other lines are left out."""
    found = F.regexp_extract(F.col(text), pattern, 0)
    groups = [F.trim(F.regexp_extract(F.col(text), pattern, i)).alias(f) for i, f in enumerate(fields, 1)]
    return lines.filter(found != "").select(*[c for c in lines.columns if c != text], *groups)


def as_list(value: str) -> Column:
    """A JSON value that is a list, a single value or missing, as an array of strings."""
    many = F.from_json(value, "array<string>")
    single = F.when(F.col(value).startswith("["), F.lit(None)).otherwise(F.array(F.regexp_replace(value, '^"|"$', "")))
    return F.coalesce(F.when(F.col(value).startswith("["), many), single, F.array().cast("array<string>"))


_TABLES = T.ArrayType(T.StructType([T.StructField("number", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType()))]))


@F.pandas_udf(_TABLES)
def wiki_rows(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Rows of the tables of wiki texts: `{|` opens one, `|-` begins a row, `|` and `!` begin cells (several with `||`, `!!`), `|}` ends it.

    A cell's attributes, before a single `|`, go; a line without a sign goes on with the cell before it.  Row 0 holds what
    comes before the first `|-`; empty rows are left out.  Tables inside tables are not told apart.
    """

    def cells_of(line: str, sign: str) -> list[str]:
        out = []
        for part in line[1:].replace("!!", "||").split("||") if sign == "!" else line[1:].split("||"):
            head, bar, rest = part.partition("|")
            out.append((rest if bar and "[[" not in head and "{{" not in head else part).strip())
        return out

    def tables(text: str | None) -> list[dict]:
        found, number, row, cells, inside = [], -1, 0, [], False

        def close() -> None:
            if cells:
                found.append({"number": number, "row": row, "cells": list(cells)})
                cells.clear()

        for raw in (text or "").split("\n"):
            line = raw.strip()
            if line.startswith("{|"):
                close()
                number, row, inside = number + 1, 0, True
            elif not inside:
                continue
            elif line.startswith("|}"):
                close()
                inside = False
            elif line.startswith("|-"):
                close()
                row += 1
            elif line[:1] in ("|", "!") and not line.startswith("|+"):
                cells.extend(cells_of(line, line[0]))
            elif line and cells:
                cells[-1] = f"{cells[-1]} {line}".strip()
        close()
        return found

    for batch in pages:
        yield batch.map(tables)


def read_wiki(spark: SparkSession, path: str) -> DataFrame:
    """(title, number, row, cells) of all tables in a MediaWiki dump's pages."""
    schema = "title string, revision struct<text string>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.select("title", F.explode(wiki_rows("revision.text")).alias("t")).select("title", "t.*")


class _Tree(HTMLParser):
    """Elements of a page with what is around them, for simple selectors."""

    _EMPTY = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})

    def __init__(self, wanted: list[tuple[str, list[tuple[str, str, str]], str]]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.found: dict[str, list[str]] = {name: [] for name, _, _ in wanted}
        self._stack: list[tuple[str, set[str], str]] = []
        self._open: list[tuple[str, int, list[str]]] = []

    def _fits(self, steps: list[tuple[str, str, str]]) -> bool:
        chain = list(self._stack)
        for at, (tag, css, ident) in enumerate(reversed(steps)):
            while chain:
                t, classes, i = chain.pop()
                if (not tag or t == tag) and (not css or css in classes) and (not ident or i == ident):
                    break
                if not at:
                    return False
            else:
                return False
        return True

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        self._stack.append((tag, set((given.get("class") or "").split()), given.get("id") or ""))
        for name, steps, attribute in self.wanted:
            if self._fits(steps):
                if attribute:
                    self.found[name] += [given[attribute]] if given.get(attribute) else []
                else:
                    self._open.append((name, len(self._stack), []))
        if tag in self._EMPTY:
            self._close(len(self._stack))

    def _close(self, depth: int) -> None:
        for name, at, parts in [o for o in self._open if o[1] >= depth]:
            self.found[name].append(" ".join("".join(parts).split()))
        self._open = [o for o in self._open if o[1] < depth]
        del self._stack[depth - 1 :]

    def handle_endtag(self, tag):
        for depth in range(len(self._stack), 0, -1):
            if self._stack[depth - 1][0] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        for _, _, parts in self._open:
            parts.append(data)


def html_fields(selectors: dict[str, str]):
    """Arrow function: a map of each named selector to what it finds in a page, in order.

    A selector is steps parted by blanks (`tag`, `tag.class`, `tag#id`), each inside the one before; `@name` at the end asks
    for an attribute instead of the text.
    """
    wanted = []
    for name, selector in selectors.items():
        path, _, attribute = selector.partition("@")
        steps = []
        for step in path.split():
            rest, _, ident = step.partition("#")
            tag, _, css = rest.partition(".")
            steps.append((tag.lower(), css, ident))
        wanted.append((name, steps, attribute))

    @F.pandas_udf(T.MapType(T.StringType(), T.ArrayType(T.StringType())))
    def fields(pages: pd.Series) -> pd.Series:
        def one(html: str | None) -> dict:
            tree = _Tree(wanted)
            tree.feed(html or "")
            tree.close()
            tree._close(1)
            return tree.found

        return pages.map(one)

    return fields
