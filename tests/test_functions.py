from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from confluo.functions import codec, fingerprint, text
from confluo.operators import graph, joins, ordered, records
from confluo.plans.components import components
from confluo.sources import export, listings


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: text.normalize_author(F.lit("Mahoney [2 musicians]")), "mahoney"),
        (lambda: text.normalize_author(F.lit("Łukasz Ø 3")), "lukaszoe"),
        (lambda: text.normalize_publisher(F.lit("The Bitmap Brothers Software")), "bitmapbrothers"),
        (lambda: text.normalize_publisher(F.lit("Software")), "software"),
        (lambda: text.normalize_album_simple(F.lit("Turrican (preview) II")), "turricanii"),
        (lambda: text.normalize_album(F.lit("Turrican II: The Final Fight")), "turrican2"),
        (lambda: text.normalize_album(F.lit("Alien Breed v1.2")), "alienbreed"),
        (lambda: text.rotate_article(F.lit("Settlers, The (1993)")), "The Settlers (1993)"),
        (lambda: text.rotate_name(F.lit("Hülsbeck, Chris")), "Chris Hülsbeck"),
        (lambda: text.split_people(F.lit("A & B, C and D")), ["A", "B", "C", "D"]),
        (lambda: text.capitalize_words(F.lit("the mcCoy band")), "The McCoy Band"),
        (lambda: text.path_year(F.lit("/demos/1990-1994/x")), 1994),
        (lambda: text.path_year(F.lit("/demos/1970/x")), 0),
        (lambda: text.any_year(F.lit("released in 1992.")), 1992),
        (lambda: text.play_time(F.lit("1:02:03")), 3723),
        (lambda: text.play_time(F.lit("soon")), 0),
        (lambda: text.decode_url(F.lit("a%20b+c")), "a b+c"),
        (lambda: text.decode_url(F.lit("100%")), "100%"),
        (lambda: text.party_name(F.lit("Easter Party 1994 Spring")), "Easter Party"),
        (lambda: text.postgres_array(F.lit('{a,"b",NULL}')), ["a", "b"]),
        (lambda: text.name_variants(F.lit("Rob Hubbard")), ["R. Hubbard"]),
        (lambda: text.name_variants(F.lit("Rob  J Hubbard")), ["R. Hubbard", "Rob Hubbard"]),
        (lambda: text.name_variants(F.lit("Hubbard")), []),
        (lambda: text.real_name(F.lit("John Quin Public Jr."), F.lit("Zap")), "John Public"),
        (lambda: text.real_name(F.lit("John Public"), F.lit("DJ Public")), None),
        (lambda: text.real_name(F.lit("John Public"), F.lit("John Public")), "John Public"),
        (lambda: text.real_name(F.lit("Jan van Public"), F.lit("Zap")), "Jan van Public"),
        (lambda: text.real_name(F.lit("J. R. Public"), F.lit("Zap")), "J. R. Public"),
        (lambda: text.is_preview(F.lit("Turrican (demo)")), True),
        (lambda: text.is_preview(F.lit("Game Demo")), False),
        (lambda: text.is_preview(F.lit("Demolition")), False),
        (lambda: text.normalize_publisher(F.lit("Core Design")), "core"),
        (lambda: text.normalize_album(F.lit("Turrican - Demo"), F.lit("Game")), "turrican"),
        (lambda: text.normalize_album(F.lit("Turrican"), F.lit("Cracktro")), "turricancracktro"),
        (lambda: text.normalize_album(F.lit("Ocean Turrican 1991"), None, F.array(F.lit("OCEAN")), F.lit(1991)), "turrican"),
        (lambda: text.normalize_album(F.lit("")), ""),
        (lambda: text.normalize_type(F.lit(None).cast("string")), ""),
        (lambda: text.article_variants(F.lit("The Sentinel")), ["The Sentinel", "Sentinel"]),
        (lambda: text.author_variants(F.array(F.lit("a"), F.lit("b")), F.lit("a"), F.lit("z")), [["a", "b"], ["z", "b"]]),
        (lambda: text.catalog_name(F.lit("Game (1991)(Firm)(demo)[cr][a]"))["flags"], ["cr", "a"]),
        (lambda: text.author_album_path(F.lit("mod/Jogeir/coop-Muffler/Album/x.mod"))["authors"], ["Jogeir", "Muffler"]),
        (lambda: text.date_with_precision(F.lit("1994-05-06"), F.lit("m")), "1994-05"),
        (lambda: text.normalize_type(F.lit("Cracked game")), "Other"),
        (lambda: text.normalize_type(F.lit("GAME")), "Game"),
        (lambda: text.normalize_type(F.lit("Trainer")), "Cracktro"),
        (lambda: codec.base64_digits(F.lit(0).cast("long"), 4, True), "-"),
        (lambda: codec.base64_value(codec.base64_digits(F.lit(123456789012).cast("long"), 8)), 123456789012),
        (lambda: codec.quantise(F.lit(5)), 1),
        (lambda: codec.quantise(F.lit(0)), 0),
        (lambda: codec.ending_name(codec.ending_code(F.lit("loop+silence"))), "loop+silence"),
        (lambda: codec.ending_code(F.lit("silence")), "s"),
        (lambda: codec.ending_code(F.lit("player+volume")), "P"),
    ],
)
def test_scalar(spark, column, expected):
    assert one(spark, column()) == expected


def test_lengths_line(spark):
    entry = lambda n, e, d=False: F.struct(F.lit(n).alias("length"), F.lit(e).alias("end"), F.lit(d).alias("duplicate"))
    entries = F.array(entry(100, "player"), entry(100, "player"), entry(100, "player", True), entry(7, "loop"), entry(0, "error", True), entry(7, None))
    line = one(spark, codec.lengths_line(entries))
    assert line == "2  ! .,l -,e,! ."
    back = one(spark, codec.parse_lengths(F.lit(line)))
    assert [tuple(e) for e in back] == [(100, "player", False), (100, "player", False), (100, "player", True), (20, "loop", False), (0, "error", True), (20, "player", False)]


def test_fingerprint_round_trip_and_errors():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 500):
        words = rng.integers(0, 2**32, n, dtype=np.uint32)
        assert (fingerprint.decode(fingerprint.encode(words))[1] == words).all()
    for bad in ("", "AQAA", fingerprint.encode(words)[:40]):
        with pytest.raises(ValueError):
            fingerprint.decode(bad)


def walk(seed: int, n: int) -> np.ndarray:
    """Words that change by four bits each, as those of a sound do."""
    rng = np.random.default_rng(seed)
    flips = [np.bitwise_or.reduce(np.uint32(1) << rng.choice(32, 4, replace=False).astype(np.uint32)) for _ in range(n)]
    return np.bitwise_xor.accumulate(np.array(flips, np.uint32))


def test_similarity():
    words = walk(2, 400)
    assert fingerprint.similarity(words, words) == 1.0
    assert fingerprint.similarity(words[2:], words) == 1.0
    assert fingerprint.sliding_similarity(words, words[100:250]) == 1.0
    assert fingerprint.sliding_similarity(words[:100], words) == 0.0
    assert fingerprint.content_bounds(np.zeros(200, np.uint32)) == (0, 0)
    assert len(fingerprint.block_hashes(words, 4)) == 4 and fingerprint.hashes_wanted(198_450) == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(1, 2), (2, 1), (5, 5), (None, 3)], "a long, b long")
    found = dict(components(links).collect())
    assert {found[n] for n in range(100, 161)} == {100} and found[2] == 1 and 5 not in found
    assert components(links.limit(0)).count() == 0


def test_medleys(spark):
    subset = spark.createDataFrame([(1, 9), (2, 9), (3, 8), (4, 8)], "part long, whole long")
    same = spark.createDataFrame([(4, 3)], "a long, b long")
    assert [r[0] for r in graph.medleys(subset, same).collect()] == [9]


def test_majority_and_impute_with_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "k int, v string")
    assert [tuple(r) for r in records.majority(df, ["k"], "v").collect()] == [(1, "a", 1)]
    known = spark.createDataFrame([(2, "z")], "k int, v string")
    assert ("z",) in [tuple(r) for r in records.impute(df, "v", [(["k"], known)]).filter("k = 2").select("v").collect()]


def test_prefix_join_has_no_nested_loop(spark):
    members = spark.createDataFrame([("/a/b/c",), ("/ab/c",), ("/a",)], "path string")
    archives = spark.createDataFrame([("/a",), ("/a/b",)], "archive string")
    joined = joins.prefix_join(members, "path", archives, "archive")
    assert sorted(map(tuple, joined.collect())) == [("/a/b/c", "/a"), ("/a/b/c", "/a/b")]
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_rank_index_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = ordered.rank_index(df, ["v"]).orderBy("v").collect()
    assert [r["idx"] for r in got] == list(range(1000))


def test_listing_with_short_rows(spark, tmp_path):
    full = "h1\t0\t1000\tplayer\tuade\tProTracker\t4\t10\tx\tc\tdir/a.mod"
    (tmp_path / "one.tsv").write_text(full + "\nh1\t1\t2000\tloop\nh2\t1\t5\tplayer\tft2play\tXM\t\t7\tx\tc\tdir/b.xm\n")
    rows = listings.read_listing(spark, f"file://{tmp_path}/one.tsv")
    assert [r["player"] for r in rows.orderBy("place").collect()] == ["uade", "uade", "ft2play"]
    assert [r["subsong"] for r in listings.shifted_subsongs(rows).orderBy("place").collect()] == [1, 2, 1]


def test_html_tables(spark):
    page = "<table><tr><th>A</th><td>b &amp; c</td></tr></table><a href='/x'>x</a>"
    got = spark.createDataFrame([(page,), (None,)], "h string").select(listings.html_tables("h").alias("t")).collect()
    assert got[0]["t"]["rows"] == [["A", "b & c"]] and got[0]["t"]["links"] == ["/x"] and got[1]["t"]["rows"] == []


def test_metadata_round_trip(spark):
    df = spark.createDataFrame([("h", ["a", "b"], [], "T", 1990), ("g", [], [], "", 0)], "hash string, authors array<string>, publishers array<string>, album string, year int")
    back = export.parse_metadata(export.pretty_metadata(df))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert export.console_table(df.select("hash", "year")).splitlines()[0] == "hash  year"
