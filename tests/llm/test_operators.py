"""Each operator against a brute-force version or an exact round trip, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from confluo.llm import decontaminate, language, lattice, licenses, lines, mixing, simhash, simple8b, tokens, toxicity
from confluo.llm.vocabulary import read_spec, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, hits int"
ODD = ["", None, " ", "\n\n", "a", "  a  b \n c", "a   ", " \n x \t y　z", "<|endoftext|>b <|endoftext|>", "é ü 漢字 １２３ ½", "x\x1c y\x85 z", "word " * 3000]


@pytest.fixture(scope="module")
def texts() -> list[str | None]:
    rng = random.Random(11)
    words = [a + b for a in ("th", "an", "er", "on", "re") for b in ("", "he", "ti", "ou", "ing", "a")]
    made: list[str | None] = []
    for i in range(160):
        text = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) + "." for _ in range(rng.randint(1, 5)))
        if i % 5 == 4 and made[-1]:
            text = made[-1].replace("the", "a", 1)
        made.append(text)
    return made + ODD + [made[0], made[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "de", None)[i % 3], None if i % 7 == 0 else f"s{i % 4}", None, 0.5, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "some text", None, None, None, None, None), rows[3]], SCHEMA)


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 239, 240, 241, 5000):
        for high in (1, 2, 300, 50_257, 2**40, 2**64 - 1):
            values = rng.integers(0, high, n, dtype=np.uint64)
            values[n // 3 : n // 2] = 0
            words, offsets = simple8b.encode(values)
            assert (simple8b.decode(words, n) == values).all()
            for b in range(len(offsets) - 1):
                assert (simple8b.decode_block(words, offsets, b, n) == values[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]).all()


def test_encoding_equals_the_library(texts):
    known = vocabulary(read_spec(tokens.tokenizer_path()))
    plain = [t or "" for t in texts]
    expected = [e.ids for e in known.tokenizer.encode_batch(plain, add_special_tokens=False)]
    assert [x.tolist() for x in known.encode([t.encode() for t in plain])] == expected
    assert known.count(plain).tolist() == list(map(len, expected))


def test_segment_rejects_a_cut_file():
    data = tokens.pack_segment([1, None], [np.array([1, 2, 3], np.uint32), np.zeros(0, np.uint32)])
    ids, values = tokens.unpack_segment(data)
    assert ids == [1, None] and [v.tolist() for v in values] == [[1, 2, 3], []]
    with pytest.raises(ValueError):
        tokens.unpack_segment(data[:-1])


def test_token_files(spark, docs, tmp_path):
    path = f"file://{tmp_path}/ids"
    tokens.write_token_files(docs, path, tokens.tokenizer_path())
    got = sorted(tokens.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    rows = docs.withColumn("h", F.xxhash64("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    known, start = vocabulary(read_spec(tokens.tokenizer_path())), 0
    for r, g in zip(rows, got, strict=True):
        ids = [*known.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        assert (g["doc_id"], g["start"], g["n_tokens"]) == (r["doc_id"], start, len(ids))
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_counts_keep_columns(docs):
    got = tokens.count_tokens(docs, tokens.tokenizer_path())
    assert got.count() == docs.count() and set(docs.columns) < set(got.columns)
    assert got.filter("text is null and n_tokens = 0 and n_bytes = 0").count() == docs.filter("text is null").count()


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups(docs):
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == docs.count()
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    low = {f: f for _, f in rows}
    for _ in rows:
        for f in low:
            for g in low:
                if (f ^ g).bit_count() <= 4:
                    low[f] = low[g] = min(low[f], low[g])
    least: dict[int, int] = {}
    for d, f in rows:
        if d is not None:
            least[low[f]] = min(least.get(low[f], d), d)
    expected = sorted(((d, f"{f:016x}", least.get(low[f])) for d, f in rows), key=repr)
    assert sorted(map(tuple, got), key=repr) == expected
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_linked_fingerprints_lose_nothing(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for f in list(prints):
        prints.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    table = spark.createDataFrame([(f,) for f in signed], "f long")
    got = sorted(map(tuple, simhash.linked_fingerprints(table).collect()))
    assert got == sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)


def test_keep_one_per_group(docs):
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    groups = simhash.simhash_groups(docs.filter("doc_id is not null")).collect()
    assert {r[0] for r in kept.select("doc_id").collect()} - {None} == {g["component_id"] for g in groups}


@pytest.mark.parametrize("seed", range(40))
def test_automaton_equals_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(30):
        window, letters = rng.choice([2, 3, 10]), [bytes([97 + i]) for i in range(rng.choice([2, 4]))]
        items = [(str(i % 3), [rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 4, 12]))]) for i in range(rng.randint(0, 5))]
        words = [rng.choice([*letters, b"zz"]) for _ in range(rng.randint(0, 40))]
        hit, names = set(), set()
        for name, item in items:
            k = min(window, len(item))
            wins = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if item else set()
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in wins:
                    hit |= set(range(i, i + k))
                    names.add(name)
        spans, found = decontaminate.Automaton(items, window).match(words)
        assert {i for a, b in spans for i in range(a, b)} == hit and found == names


def test_decontaminate(spark, docs):
    passage = " ".join(f"w{i}" for i in range(14))
    bench = spark.createDataFrame([(1, passage), (2, None), (3, ""), (None, "some text"), (4, "lone")], "item_id long, text string")
    rows = [(1, f"Before it, {passage.upper()}! " + "after that more. " * 20), (2, passage), (3, None), (4, "clean"), (4, "clean")]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.find_leaks(own, bench).collect()}
    assert [tuple(h) for h in found[1]["hits"]] == [(2, 16)] and found[1]["hit_items"] == ["1"] and found[3]["n_words"] == 0
    kept = decontaminate.decontaminate(own, bench).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 4, 4]
    assert next(r["text"] for r in kept if r["doc_id"] == 1).startswith("Before it, ! after that")
    assert decontaminate.items_digest([]) == hashlib.sha256(b"").hexdigest()
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns


def test_several_automata_agree_with_one(spark, docs, monkeypatch):
    texts = [(i, r["text"]) for i, r in enumerate(docs.filter("length(text) between 60 and 400").limit(12).collect())]
    bench = spark.createDataFrame(texts, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.find_leaks(docs.select("doc_id", "text"), bench).select("doc_id", "n_words", "hits", "hit_items").collect()), key=repr)
    monkeypatch.setattr(decontaminate, "MAX_ITEM_WORDS", 100)
    many = sorted(map(tuple, decontaminate.find_leaks(docs.select("doc_id", "text"), bench).select("doc_id", "n_words", "hits", "hit_items").collect()), key=repr)
    assert one == many


def test_mixing(docs, monkeypatch):
    drawn = mixing.with_copies(docs).collect()
    assert len(drawn) == docs.count()
    by_source = {r["source"]: (r["source_size"], r["target"]) for r in drawn}
    sizes = sum(s for s, _ in by_source.values())
    assert sum(t for _, t in by_source.values()) == pytest.approx(1.5 * sizes)
    assert all(t <= 2 * s + 1e-9 for s, t in by_source.values()) and all(r["copies"] <= 2 for r in drawn)
    order = sorted([s for s in by_source if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free = {s for s in order if by_source[s][1] < 2 * by_source[s][0] - 1e-6}
    assert len({round(by_source[s][1] / weight[s], 6) for s in free}) <= 1
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    key = lambda r: repr(tuple(r))
    assert sorted(mixing.with_copies(docs).collect(), key=key) == sorted(drawn, key=key)
    assert mixing.mix(docs).count() == sum(r["copies"] for r in drawn)
    assert mixing.with_copies(docs.limit(0)).count() == 0


def test_licenses(spark):
    rows = [(1, "x " * 9 + "Licensed under the Apache License, Version 2.0."), (2, "released UNDER the mit license!"), (3, None), (4, "the license"), (None, "Released under the MIT License")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["license_id"], r["containment"]) for r in got), key=repr) == [(1, "apache-2.0", 1.0), (2, "mit", 1.0), (None, "mit", 1.0)]
    with pytest.raises(ValueError):
        licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), {"short": "two words"})


def test_license_bands_meet_their_promise():
    for length in range(5, 60):
        stride, window, bands = licenses.plan_of(length)
        mine = length - 4
        shared = -(-mine * 8 // 10)
        alike = shared / (mine + window - 4 - shared)
        assert window >= length + stride - 1 and (1 - alike) ** bands <= licenses.MISS


def test_language(spark):
    en, de = "the cat and the dog are in the house with a bird", "der hund und die katze sind in dem haus mit einem vogel"
    rows = [(i, en if i % 2 else de, ("de", "en")[i % 2]) for i in range(60)] + [(900, None, "en"), (901, "123 !", None), (902, "unddie katzehaus", None), (903, "", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table)
    got = {r["doc_id"]: r for r in language.identify(table, model).collect()}
    assert all(got[i]["lang_pred"] == ("de", "en")[i % 2] for i in range(60))
    assert {got[i]["lang_pred"] for i in (900, 901, 903)} == {"und"} and got[902]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = language.fit(table.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify(table, none).collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(2)
    plain = ["house", "tree", "river", "stone", "cloud", "green", "you", "walk"]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(40)]
        if i % 4 == 0:
            words[5] = rng.choice(["idiot", "st*pid", "l0ser", "moron,"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(999, None), (None, "you idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 1) for r in rows] + [(None, 1, 1), (5000, 1, 1)], "doc_id long, toxic int, quality int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert held and sum(got[d]["predicted"] == y for d, _, y in held) >= 0.97 * len(held)
    assert got[999]["predicted"] == 0 and got[None]["predicted"] == 1
    assert toxicity.drop_toxic(docs, labels).filter("doc_id is null or doc_id % 4 = 0").count() <= 5
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    x = rng.standard_normal(500)
    xs, ys = toxicity.isotonic(x, (rng.random(500) < 1 / (1 + np.exp(-x))).astype(int))
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all()


def test_lattice_points():
    x = np.random.default_rng(0).standard_normal((300, 8)) * 2
    points = lattice.decode_e8(x)
    assert ((points.sum(1) % 2) == 0).all() and (((x - points) ** 2).sum(1) <= 1 + 1e-9).all()
    steps = lattice._neighbours()
    assert len(steps) == 240 and (((x[:, None] - points[:, None] - steps) ** 2).sum(2).min(1) >= ((x - points) ** 2).sum(1) - 1e-9).all()


def test_lattice_recall():
    rng = np.random.default_rng(3)
    a = lattice._unit(rng.standard_normal((3000, 64)))
    other = rng.standard_normal((3000, 64))
    other = lattice._unit(other - (other * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * other
    met = lattice._met(lattice.lattice_keys(a).reshape(3000, -1), lattice.lattice_keys(b).reshape(3000, -1))
    assert met.any((1, 2)).mean() > 0.99  # at the threshold itself, where it is least


def test_embedding_links(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((40, 16))
    rows = [(i, [float(x) for x in base[i % 40] + rng.standard_normal(16) * (0, 0.02, 0.2)[i % 3]], None if i % 17 == 0 else i % 3) for i in range(500)]
    rows += [(700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] + [1.0] * 15, 1), (703, [None] + [1.0] * 15, 1), (704, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows[:500]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 - r[0] if r[2] is None else r[2] for r in rows[:500]])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label) & ~np.eye(500, dtype=bool)
    low = np.arange(500)
    for _ in range(30):
        low = np.minimum(low, np.where(linked, low, 500).min(1))
    expected = [(i, int(linked[i].sum()), int(low[i]), bool(low[i] == i)) for i in range(500)] + [(i, 0, i, True) for i in range(700, 705)]
    assert sorted(map(tuple, lattice.embedding_links(table).collect())) == expected
    assert lattice.embedding_links(table.limit(0)).count() == 0


def test_line_dedup(spark, docs):
    got = {(r["doc_id"], i) for r in lines.line_report(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect() for i in r["removed_lines"]}
    every = []
    for r in docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text").collect():
        every += [(r[0], i, frozenset(s.split())) for i, s in enumerate((r[1] or "").encode().lower().split(b"\n")) if s.split()]
    every.sort(key=lambda x: x[:2])
    expected = {b[:2] for k, b in enumerate(every) if any(len(a[2] & b[2]) >= 0.8 * len(a[2] | b[2]) - 1e-9 for a in every[:k])}
    assert got == expected
    cut = lines.dedup_lines(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert lines.line_report(docs.limit(0)).count() == 0


def test_prefix_length():
    sizes = np.arange(1, 60)
    n = lines.prefix_length(sizes, 0.8)
    assert (n[:3] == 0).all() and n[3] == 1 and n[44] == 45 - 36 + 1
