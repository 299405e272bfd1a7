"""Facts taken out of paths, lists and comments, case by case."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from confluo.functions import extract


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("Games - TFMX/Turrican, The - Level 1 (1990)(Rainbow Arts)[cmp Chris H.].mod", (["Chris H."], ["Chris H."], ["Rainbow Arts"], "The Turrican", 1990, "Game", "Amiga")),
        ("Games - TFMX/Title (19xx)(Ocean & Imagine)[cmp Ann of Duo- seq Bob of Trio].mod", (["Bob"], ["Ann"], ["Imagine", "Ocean"], "Title", 0, "Game", "Amiga")),
        ("Games - TFMX/Title (1991-05-06)(Zap of Crew)(AGA)(-)[seq Who].mod", (["Zap"], [], ["Crew"], "Title", 1991, "Game", "Amiga")),
        ("Music - Scene - MOD/tune (1993)(Ann & Bob).mod", (["Ann", "Bob"], [], [], "", 1993, "", "")),
        ("Music - Games - Covers - MOD/tune - x (1993)(Firm)[cmp Ann].mod", ([], ["Ann"], [], "", 0, "", "")),
        ("Music - Games - Cracktro - MOD/deathtrap (1990)(Crew).mod", ([], [], ["Crew"], "Death Trap [cracktro]", 1990, "", "")),
        ("Demos - XM/Name - part (1996)(Group - Other)(cmp Cid + Dan).xm", (["Cid", "Dan"], ["Cid", "Dan"], ["Group", "Other"], "Name", 1996, "Demo", "PC")),
        ("Demos - TFMX/ZZZ-x (Share and Enjoy)[cmp Ann].mod", ([], ["Ann"], ["Share and Enjoy"], "ZZZ-x", 0, "Demo", "Amiga")),
        ("Demos - TFMX/x (1991)(JMP).mod", (["JMP"], [], [], "x", 1991, "Demo", "Amiga")),
        ("Demos - TFMX/x (1995)(Firm)[cmp Merci (1991) ].mod", (["Merci"], ["Merci (1991)"], [], "", 1991, "Demo", "Amiga")),
        ("nothing.mod", ([], [], [], "", 0, "", "")),
    ],
)
def test_music_path(spark, path, expected):
    assert tuple(one(spark, extract.music_path(F.lit(path)))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("by Ann and Bob Smith", ["Ann Smith", "Bob Smith"]), ("Chorus-Sid", ["Chorus", "Sid"]), ("Jean-Luc Picard", ["Jean-Luc Picard"]), ("Ann One-Bob Two", ["Ann One", "Bob Two"]),
        ("A + B&C and D", ["A", "B", "C", "D"]), ("Full-FX", ["Full-FX"]), ("", []), (None, []),
    ],
)
def test_people(spark, text, expected):
    assert one(spark, extract.people(F.lit(text).cast("string"))) == expected


def test_companies(spark):
    cases = {"The Bitmap Brothers (UK) Ltd.": ["Bitmap Brothers"], "Acme, Inc., Other GmbH & Co. KG": ["Acme", "Other"], "Freeware": [], "": [], "The Learning Co.": ["The Learning Co."]}
    assert {t: one(spark, extract.companies(F.lit(t))) for t in cases} == cases and one(spark, extract.companies(F.lit(None).cast("string"))) == []


def test_routes_and_mining(spark):
    links = spark.createDataFrame([("a", "http://h//x//y?q"), ("b", "http://h/x"), ("c", None)], "kind string, url string")
    rules = spark.createDataFrame([(2, "", "^http", "^http://h/+", "rest"), (1, "a", "[?]", r"^http://h/+|\?.*$", "asked")], "place int, class string, pattern string, strip string, index string")
    got = {r["kind"]: (r["index"], r["key"]) for r in extract.routed(links, "url", "kind", rules).collect()}
    assert got == {"a": ("asked", "x/y"), "b": ("rest", "x"), "c": (None, None)}
    df = spark.createDataFrame([("by ann of crew",), ("crew",), (None,)], "t string")
    assert [r[0] for r in df.select(extract.mined([("by (\\w+) of", 1), ("^(c)", 1)])("t")).collect()] == ["ann", "c", ""]


def test_company_names_as_in_sql(spark, tmp_path):
    """A key that two lists have is one row, a list without names is null, a null list is none."""
    import duckdb

    from confluo import extract_queries, registry

    rows = [(1_000_000, "SMALL"), (5, "Freeware"), (12, "The One"), (12, "Two, Three"), (2, None), (1, "x"), (None, "y")]
    spark.createDataFrame(rows, "p_partkey long, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")

    def plain(found):  # places of one key and equal places are ties in the SQL
        return sorted((k, None if v is None else sorted(v.split("~"))) for k, v in found)

    got = [tuple(r) for r in extract_queries.company_names(spark, str(tmp_path)).collect()]
    assert plain(got) == plain(con.execute(registry.oracle_sql()["company_names"]).fetchall())
    assert dict(got)[1_000_000] == "The Learning Co.~SMALL~The Learning Co.~Learning~Two" and len(got) == 4 and dict(got)[5] is None
