"""Awkward rows of each training-data operator and pipeline stage: nulls, repeated ids, empty tables, ties, long texts, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from confluo.llm import decontaminate, language, lattice, licenses, lines, mixing, nearcopies, simhash, tokens, toxicity
from confluo.llm.vocabulary import read_spec, vocabulary

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, schema=COLUMNS):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


# language


def test_language_reads_whole_runs(spark):
    one, other = "あいうえお" * 12, "かきくけこ" * 1000
    rows = [(i, one if i % 2 else other[: 60 + i], "xx" if i % 2 else "yy") for i in range(60)]
    model = language.fit(table(spark, rows))
    assert model.predict(one + other)[0] == "yy" and model.predict(one)[0] == "xx"


def test_language_without_sampled_rows_is_never_predicted(spark):
    rows = [(i, "the house and the tree are here", "en") for i in range(400)] + [(1000 + i, "das haus und der baum sind hier", "de") for i in range(300)]
    rows += [(5000, None, "zz"), (5001, "123 456", "qq")]
    docs = table(spark, rows)
    model = language.fit(docs, max_docs=100, least_docs=5)
    assert model.langs == ["de", "en"] and model.predict("der baum und das haus " * 8)[0] == "de"


def test_rare_languages_are_learned(spark):
    rows = [(i, "common words of all the big corpus here", "en") for i in range(3000)] + [(9000 + i, "seltene worte einer kleinen sprache", "de") for i in range(9)]
    model = language.fit(table(spark, rows), max_docs=50)
    assert "de" in model.langs and model.predict("kleine worte der sprache")[0] == "de"


def test_many_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [letters[i // 26 % 26] + letters[i % 26] + letters[i // 676] for i in range(1100)]
    rows = [(i * 10 + k, f"{n * 3} {n[::-1] * 2} {n * 3}", n) for i, n in enumerate(names) for k in range(3)]
    assert len(language.fit(table(spark, rows)).langs) > 1000


def test_language_edges(spark):
    docs = table(spark, [(1, "the house", "en"), (1, "the house", "en"), (None, "the house", None), (3, "12 34", None), (4, None, "en"), (6, "a" * 70_000, None), (2, "das haus das haus", "de")])
    model = language.fit(docs)
    found = language.identify(docs.withColumn("lang_pred", F.lit("x")).withColumn("SCORE", F.lit(9)), model).collect()
    assert len(found) == 7 and sum(r["lang_pred"] == "und" and r["score"] == 0.0 for r in found) == 2
    assert all(0 <= r["score"] <= 1 for r in found)
    empty = language.fit(docs.limit(0))
    assert empty.predict("the house") == ("und", 0.0) and language.identify(docs.limit(0), empty).count() == 0


def plain_language(rows, max_docs=None):
    """Word-first backoff written out over dictionaries, learned from all rows."""
    find = lambda t: re.findall(r"[^\W\d_]{1,32}", (t or "").lower())
    grams = lambda w, n: list(w) if n == 1 else [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]
    counts: dict = {}
    docs_of: dict = {}
    for text, lang in rows:
        if text is not None:
            docs_of[lang] = docs_of.get(lang, 0) + 1
        for w in find(text):
            counts.setdefault((0, w), {}).setdefault(lang, 0)
            counts[0, w][lang] += 1
            for n in range(1, 6):
                for g in grams(w, n):
                    counts.setdefault((n, g), {}).setdefault(lang, 0)
                    counts[n, g][lang] += 1
    counts = {k: v for k, v in counts.items() if sum(v.values()) >= (2 if k[0] == 0 else 3)}
    langs = sorted({x for v in counts.values() for x in v})
    sums = {n: {x: sum(v.get(x, 0) + 0.5 for k, v in counts.items() if k[0] == n) for x in langs} for n in range(6)}
    log = lambda key, x: np.log((counts[key].get(x, 0) + 0.5) / sums[key[0]][x])

    def predict(text):
        scores = {x: np.log(docs_of[x] / sum(docs_of[y] for y in langs)) for x in langs}
        for w in find(text):
            for x in langs:
                if (0, w) in counts:
                    scores[x] += log((0, w), x)
                    continue
                for n in range(5, 0, -1):
                    known = [g for g in grams(w, n) if (n, g) in counts]
                    if known:
                        scores[x] += np.mean([log((n, g), x) for g in known])
                        break
        best = max(langs, key=lambda x: (scores[x], -langs.index(x)))
        return best, 1 / sum(np.exp(scores[x] - scores[best]) for x in langs)

    return predict


def test_language_against_a_plain_version(spark):
    rng = random.Random(4)
    make = {"en": "the of and house tree river stone".split(), "de": "der die und haus baum fluss stein".split(), "fr": "le la et maison arbre pierre".split()}
    rows = [(i, " ".join(rng.choice(make[x]) + rng.choice(["", "s", "e"]) for _ in range(6)), x) for i in range(150) for x in [rng.choice(sorted(make))]]
    docs = table(spark, rows)
    learned = [(r["text"], r["lang"]) for r in docs.filter(~language.held_out(F.col("doc_id"))).collect()]
    plain, model = plain_language(learned), language.fit(docs)
    for text in ["haus und tree", "maisons arbre", "riverstone", "unbekannt", "x", *[r[1] for r in rows[:40]]]:
        lang, score = plain(text)
        got = model.predict(text)
        assert got[0] == lang and got[1] == pytest.approx(score, rel=1e-9)


# tokens


def test_bad_utf8(spark):
    bad = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.unhex(F.lit("61FF62")).cast("string").alias("text"))
    row = tokens.count_tokens(bad, tokens.tokenizer_path()).first()
    known = vocabulary(read_spec(tokens.tokenizer_path()))
    assert row["n_bytes"] == 3 and row["n_tokens"] == len(known.tokenizer.encode("a�b", add_special_tokens=False).ids)


def test_tokens_of_an_empty_table(spark, tmp_path):
    none = table(spark, [(1, "x")]).limit(0)
    assert tokens.count_tokens(none, tokens.tokenizer_path()).count() == 0
    tokens.write_token_files(none, f"file://{tmp_path}/none", tokens.tokenizer_path())
    assert tokens.read_token_files(spark, f"file://{tmp_path}/none").count() == 0


# decontamination


def plain_leaks(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    mine, hit, names = cut(text), set(), set()
    for name, body in items:
        theirs = cut(body)
        size = min(window, len(theirs))
        for i in range(len(theirs) - size + 1) if theirs else []:
            for j in range(len(mine) - size + 1):
                if mine[j : j + size] == theirs[i : i + size]:
                    hit |= set(range(j, j + size))
                    names.add(name)
    return len(mine), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def write(spark, tmp_path, docs, items):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return f"file://{tmp_path}"


@pytest.mark.parametrize("most", [decontaminate.MAX_ITEM_WORDS, 20])
def test_decontamination_query(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MAX_ITEM_WORDS", most)  # 20: several automata
    rng = random.Random(5)
    items = [(str(i), words(rng, rng.choice([3, 10, 14, 30]))) for i in range(12)] + [("12", None), ("13", " .. "), (None, words(rng, 12)), ("14", "One, two"), ("1", "repeated id of an item")]
    docs = [(i, f"{words(rng, 5)} {items[i % 12][1][: rng.randint(20, 400)]} {words(rng, 4)} {items[(i + 1) % 12][1].upper()}") for i in range(30)]
    docs += [(100, None), (101, ""), (102, "one two"), (102, "one two"), (None, items[3][1]), (103, words(rng, 40))]
    known = [x for x in items if x[0] is not None]
    folder = write(spark, tmp_path, table(spark, docs), spark.createDataFrame(items, "item_id string, text string"))
    got = sorted(map(tuple, decontaminate.op4_decontamination(spark, folder).collect()), key=repr)
    assert got == sorted([(d, *plain_leaks(t, known)) for d, t in docs], key=repr)
    assert sum(r[-1] for r in got) > 20
    kept = decontaminate.decontaminate(table(spark, docs), spark.createDataFrame(items, "item_id string, text string"), max_coverage=1.0).collect()
    assert len(kept) == len(docs) and not any(plain_leaks(r["text"], known)[1] for r in kept if len((r["text"] or "").split()) < 12)


def test_decontamination_of_nothing(spark):
    docs, items = table(spark, [(1, "a b"), (None, None)]), spark.createDataFrame([("1", "a b c d e f g h i j k")], "item_id string, text string")
    clash = docs.withColumn("hits", F.lit(1)).withColumn("N_WORDS", F.lit(2))
    found = decontaminate.find_leaks(clash, items.limit(0))
    assert sorted(found.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "n_words", "hits", "hit_items"]) and found.filter("size(hits) > 0").count() == 0
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0 and decontaminate.decontaminate(docs, items.limit(0)).count() == 2


# mixing


def test_mix_of_null_ids(spark):
    rng = random.Random(6)
    rows = [(None, words(rng, 5) + f" w{i}", None, ("a", "b", "c")[i % 3]) for i in range(1500)]
    got = mixing.with_copies(table(spark, rows)).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    assert all(abs(r["n"] - r["t"]) < 0.1 * r["t"] for r in got)
    assert mixing.mix(table(spark, rows).limit(0)).count() == 0
    same = table(spark, [(1, "a b", None, None)] * 4).withColumn("target", F.lit(1))
    assert len({r["copies"] for r in mixing.with_copies(same).collect()}) == 1 and mixing.mix(same).columns == same.columns


# licences


def test_licences_of_long_texts(spark):
    rng, notice = random.Random(7), licenses.TEMPLATES["mit-grant"]

    def scan(n: int) -> float:
        docs = table(spark, [(1, words(rng, n) + " " + notice)]).cache()
        docs.count()
        begun = time.time()
        assert [(r["doc_id"], r["license_id"], r["containment"]) for r in licenses.scan_licenses(docs).collect()] == [(1, "mit-grant", 1.0)]
        return time.time() - begun

    scan(1000)
    small, large = scan(40_000), scan(80_000)
    assert large < 3 * small + 3  # linear: the square would take four times as long, and far longer


def test_licences_edges(spark):
    notice = licenses.TEMPLATES["mpl-2.0"]
    docs = table(spark, [(1, notice), (1, notice), (None, notice), (2, None), (3, ""), (4, "words")]).withColumnRenamed("text", "words")
    got = {(r["doc_id"], r["license_id"], r["n_windows"]) for r in licenses.scan_licenses(docs, text_col="words").collect()}
    assert {g[:2] for g in got} == {(1, "mpl-2.0"), (None, "mpl-2.0")}
    assert licenses.scan_licenses(docs.limit(0), text_col="words").count() == 0


# toxicity


def test_toxicity_edges(spark):
    rows = [(i, "you stupid idiot" if i % 3 == 0 else "a calm and sunny day") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    docs = table(spark, rows).withColumn("score", F.lit("x")).withColumn("PREDICTED", F.lit(7))
    got = toxicity.toxicity(docs, labels).collect()
    assert len({round(r["score"], 12) for r in got if r["doc_id"] % 3 == 0}) == 1  # ties score alike
    assert {r["predicted"] for r in got if r["doc_id"] % 3 == 0} == {1} and {r["predicted"] for r in got if r["doc_id"] % 3} == {0}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 80
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.drop_toxic(docs.limit(0), labels.limit(0)).count() == 0


def test_shouting_and_masks():
    known = toxicity.Classes({})
    names = toxicity.FEATURES
    some = dict(zip(names, toxicity.features("STOP THIS NOW " + "quiet words " * 500, known), strict=True))
    assert some["shouted"] > 0
    for text in ("you f***", "you $hit", "what an *diot", "you i d i o t here"):
        assert dict(zip(names, toxicity.features(text, known), strict=True))["masked"] == 1, text


# SimHash


def test_one_row_of_each_group(spark):
    rng = random.Random(8)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, c), (None, b), (None, b), (7, None), (8, ""), (7, None)]
    docs = table(spark, rows).withColumn("root", F.lit(1)).withColumn("hash", F.lit(2))
    kept = simhash.keep_one_per_group(docs)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, a), (2, b), (3, c)], key=repr) + [(7, None)] or sorted(map(repr, got)) == sorted(map(repr, [(1, a), (2, b), (3, c), (7, None)]))
    assert kept.columns == docs.columns and simhash.keep_one_per_group(docs.limit(0)).count() == 0
    only_null = table(spark, [(None, a), (None, a)])
    assert simhash.keep_one_per_group(only_null).count() == 1


def test_shared_groups_do_not_change_links(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60)
    prints = {int(x) for x in base} | {int(x ^ (1 << int(i)) ^ (1 << int(j))) for x in base for i, j in [rng.integers(0, 62, 2)]}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = [{(r["src"], r["dst"]) for r in simhash.linked_fingerprints(df, 4, s).collect()} for s in (2, 3, 5)]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 50
    assert [simhash.groups_for(n, 4) for n in (10, 10**6, 10**9, 10**12)] == sorted(simhash.groups_for(n, 4) for n in (10, 10**6, 10**9, 10**12))


def test_near_copies_row_by_row(spark):
    rng = random.Random(9)
    a, b = words(rng, 60), words(rng, 60)
    near = a.rsplit(" ", 1)[0] + " changed"
    docs = table(spark, [(1, a), (2, near), (2, b), (None, near + " x"), (5, None)])
    got = sorted(((r["doc_id"], r["text"]) for r in nearcopies.drop_near_copies(docs).collect()), key=repr)
    assert sorted(map(repr, got)) == sorted(map(repr, [(1, a), (2, b), (5, None)]))
    assert nearcopies.drop_near_copies(docs.limit(0)).count() == 0


# embeddings


def test_embeddings_with_repeated_ids(spark):
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal(16), rng.standard_normal(16)
    near = (x + 0.01 * rng.standard_normal(16)).tolist()
    rows = [(5, x.tolist(), 1), (5, y.tolist(), 2), (6, near, 1), (9, y.tolist(), 3), (9, (y + 0.01).tolist(), 3), (None, y.tolist(), 3)]
    table_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit(1)).withColumn("rep", F.lit(2))
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in lattice.embedding_links(table_).collect())
    assert got == [(-1, 0, None), (5, 0, 5), (5, 1, 5), (6, 1, 5), (9, 1, 9), (9, 1, 9)]


# lines


def plain_lines(rows):
    every = [((d is not None, d or 0, n), d, t, frozenset(s.lower().split())) for d, t in rows for n, s in enumerate((t or "").encode().split(b"\n")) if s.split()]
    every.sort(key=lambda x: x[0])
    gone: dict = {}
    for at, d, t, s in every:
        if any(a < at and len(s & o) >= 0.8 * len(s | o) - 1e-9 for a, _, _, o in every):
            gone.setdefault((d, t), set()).add(at[2])
    return gone


def check_lines(spark, rows, **options):
    got = {}
    removed, every = lines.line_flags(table(spark, rows), **options)
    for r in removed.collect():
        got.setdefault((r["doc"], r["hash"]), set()).add(r["line"])
    hashed = {(r["doc_id"], r["h"]): r["text"] for r in table(spark, rows).withColumn("h", F.xxhash64("text")).collect()}
    assert {(k[0], hashed[k]): v for k, v in got.items()} == plain_lines(rows)
    assert every.count() == len(rows)


def line_rows(seed, vocabulary_size, n, most=40):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary_size)]
    made: list[str] = []
    for _ in range(n):
        if made and rng.random() < 0.5:
            ws = rng.choice(made).split()
            for _ in range(rng.randint(0, max(1, len(ws) // 6))):
                ws[rng.randrange(len(ws))] = rng.choice(vocab)
            made.append(" ".join(ws))
        else:
            made.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, most))))
    rng.shuffle(made)
    return [(i, "\n".join(made[i * 4 : i * 4 + 4])) for i in range(n // 4)]


@pytest.mark.parametrize(("seed", "vocabulary_size", "frequent", "most"), [(1, 3000, 4096, 40), (2, 60, 20, 25), (3, 200, 3, 60), (4, 5000, 4096, 400)])
def test_lines_are_exact(spark, seed, vocabulary_size, frequent, most):
    check_lines(spark, line_rows(seed, vocabulary_size, 240, most), frequent=frequent)


def test_lines_of_null_and_repeated_ids(spark):
    rows = line_rows(5, 400, 80)
    rows = [(None if i % 7 == 0 else d // 3, t) for i, (d, t) in enumerate(rows)]
    check_lines(spark, list(dict.fromkeys(rows)) + [(50, None), (51, ""), (52, "\n \n")])


def test_a_group_of_near_copies_that_asks_on(spark, monkeypatch):
    """Lines that share rare words but stop at candidates that fail still find the one that holds."""
    monkeypatch.setattr(lines, "ASKED", 2)
    rng = random.Random(6)
    core = [f"rare{i}" for i in range(12)]
    rows = [(i, " ".join(rng.sample(core, 9) + [f"x{i}y{k}" for k in range(rng.randint(0, 4))])) for i in range(60)]
    check_lines(spark, rows + [(100, rows[30][1] + " z"), (101, rows[7][1])])


def test_long_words_do_not_collide(spark):
    """Words whose polynomial hashes modulo 2**64 are equal whatever the base."""
    word = "a"
    other = "b"
    for _ in range(11):
        word, other = word + other, other + word
    rows = [(1, word), (2, other), (3, f"{word} b c d e f g"), (4, f"{other} b c d e f g"), (5, f"{word} b c d e f g")]
    check_lines(spark, rows)


def test_a_text_of_megabytes(spark):
    rng = random.Random(10)
    lines_of = [words(rng, 12) for _ in range(60_000)]
    text = "\n".join([*lines_of, lines_of[5], lines_of[777]])
    docs = table(spark, [(1, text), (2, lines_of[42]), (3, "w" * 3_000_000), (4, " ".join(f"u{i}" for i in range(100_000)))])
    assert len(text) > 3_000_000
    got = {r["doc_id"]: (r["n_lines"], set(r["removed_lines"])) for r in lines.line_report(docs).collect()}
    assert got[1][0] == 60_002 and {60_000, 60_001} <= got[1][1] and got[2] == (1, {0}) and got[3] == (1, set()) and got[4] == (1, set())


def test_dedup_lines_gives_texts(spark, tmp_path):
    rows = [(1, "one two three four five\nsix"), (2, "Six\nseven eight nine ten\n\none two three four five"), (3, None), (3, "")]
    docs = table(spark, rows).withColumn("removed_lines", F.lit(1))
    got = {(r["doc_id"], r["text"]) for r in lines.dedup_lines(docs).collect()}
    assert got == {(1, "one two three four five\nsix"), (2, "seven eight nine ten\n"), (3, None), (3, "")}
    docs.drop("removed_lines").write.parquet(f"{tmp_path}/documents.parquet")
    digest = {r["doc_id"]: tuple(r)[1:] for r in lines.op10_line_dedup(spark, f"file://{tmp_path}").filter("doc_id < 3").collect()}
    assert digest == {1: (2, 0, zlib.crc32(b"")), 2: (3, 2, zlib.crc32(b"0,3"))}


# pipeline stages


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(12)
    item = words(rng, 30)
    toxic = "you stupid worthless idiot shut up you moron"
    rows = [(i, words(rng, rng.randint(15, 80)), "en", f"s{i % 3}") for i in range(80)]
    rows += [(200 + i, f"{toxic} {words(rng, 3)} {toxic}", "en", "s0") for i in range(20)]
    rows += [(300, rows[4][1], "en", None), (300, words(rng, 50), None, "s1"), (None, words(rng, 50), None, None), (None, rows[5][1], None, None), (301, None, None, None), (302, "", None, "s2")]
    rows += [(400, f"{words(rng, 300)} {item} tail", "en", "s1"), (401, item, "en", "s1")]
    spark.createDataFrame([(i, int(200 <= i < 220), 1) for i in range(220)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("0", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return table(spark, rows), f"file://{tmp_path}", item, rows


def test_stages_on_awkward_rows(spark, corpus):
    docs, folder, item, rows = corpus
    given = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, folder)
    toxic = {r[:2] for r in rows if r[0] and 200 <= r[0] < 220}
    assert not toxic & set(given(clean)) and set(given(clean)) <= {r[:2] for r in rows} and clean.count() >= 0.95 * (len(rows) - len(toxic))
    kept = given(stages["simhash_dedup"](spark, docs, folder))
    assert (300, rows[4][1]) not in kept and sum(d == 300 for d, _ in kept) == 1 and (None, rows[5][1]) not in kept
    assert sum(d is None for d, _ in kept) == 1 and sum(d in (301, 302) for d, _ in kept) == 1
    cut = dict(x for x in given(stages["decontamination"](spark, docs, folder)) if x[0] is not None and x[0] != 300)
    assert 401 not in cut and item not in cut[400] and cut[400].endswith("tail") and cut[301] is None and cut[302] == ""
    mixed = stages["mixing"](spark, docs, folder)
    assert mixed.columns == docs.columns and set(given(mixed)) <= {r[:2] for r in rows}
    written = stages["token_files"](spark, docs, folder)
    assert written.count() == len(rows) and written.agg(F.sum("n_tokens")).first()[0] > 0


def test_stages_on_an_empty_table(spark, corpus):
    docs, folder, _, _ = corpus
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
