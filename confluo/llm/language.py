"""Language identification: known words by per-language log frequency, else shorter and shorter character n-grams.

The model is learned from a bounded sample of labelled documents (about ``MAX_TRAIN_DOCS``, chosen by a hash of the id,
and some ``LEAST_DOCS`` of each language at least), so what is broadcast doesn't grow with the corpus.  Words that the
sample has once only are left to the n-grams.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.shipping import ship
from ..plans.storage import discard, store
from .textio import add_columns, texts_of

#: Documents that are learned from at most, besides so many of each rare language; occurrences of a known word and n-gram.
MAX_TRAIN_DOCS, LEAST_DOCS, LEAST_WORD, LEAST_GRAM = 6_000, 100, 2, 3
#: Longest n-gram, smoothing, and unseen words whose scores a worker remembers.
LONGEST, ALPHA, KEPT = 5, 0.5, 400_000
UNKNOWN = "und"
#: Runs of letters; longer ones, as in scripts without spaces, are cut into words of this length.
LONGEST_WORD = 32
_WORDS = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between boundary signs (single characters without them)."""
    if n == 1:
        return list(word)
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """log frequencies by language, one row per known word or n-gram; prior by language."""

    langs: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    _rows: dict[str, int] = field(default_factory=dict)
    _logs: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self):
        return self.__dict__ | {"_rows": {}, "_logs": []}

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest n-grams that are known at all; zeros if not even a character is."""
        for n in range(LONGEST, 0, -1):
            known = [self.grams[g] for g in grams(word, n) if g in self.grams]
            if known:
                return self.gram_logs[known].mean(0)
        return np.zeros(len(self.langs))

    def predict(self, text: str) -> tuple[str, float]:
        words = _WORDS.findall(text.lower())
        if not self.langs or not words or not (words[0][0].isalpha() or any(map(str.isalpha, text))):
            return UNKNOWN, 0.0
        rows = list(map(self.words.get, words))
        total = self.prior.copy()
        known = [r for r in rows if r is not None]
        if known:
            total += self.word_logs[known].sum(0)
        if len(known) < len(words):
            if len(self._rows) > KEPT:
                self._rows.clear()
                self._logs.clear()
            mine = []
            for word, row in zip(words, rows):
                if row is None:
                    at = self._rows.get(word)
                    if at is None:
                        at = self._rows[word] = len(self._logs)
                        self._logs.append(self.unseen(word))
                    mine.append(at)
            total += np.sum([self._logs[i] for i in mine], axis=0) if len(mine) < 64 else self._many(mine)
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum())

    def _many(self, mine: list[int]) -> np.ndarray:
        seen = Counter(mine)
        return np.array(list(seen.values()), np.float64) @ np.array([self._logs[i] for i in seen])


def _emit(rows: list[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    types = {"kind": pa.int32(), "lang": pa.string(), "piece": pa.string(), "n": pa.int64()}
    for at in range(0, len(rows), 50_000):
        part = list(zip(*rows[at : at + 50_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, types[n]) for c, n in zip(part, names, strict=True)], names=names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            totals.update(zip([lang] * (len(text) + 1), _WORDS.findall(text.decode("utf-8", "replace").lower())))
        yield from _emit([(lang, word, n) for (lang, word), n in totals.items()], ["lang", "piece", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for size in range(1, LONGEST + 1):
                for g in grams(word, size):
                    totals[size, lang, g] += n
        yield from _emit([(*k, n) for k, n in totals.items()], ["kind", "lang", "piece", "n"])


def _logs(pieces: list[str], langs: list[int], n: np.ndarray, of: np.ndarray, many: int) -> np.ndarray:
    """Smoothed log frequencies by language from the counts ``n`` of piece ``of`` in language ``langs``."""
    counts = np.full((len(pieces), many), ALPHA)
    np.add.at(counts, (of, langs), n)
    return np.log(counts / counts.sum(0))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_TRAIN_DOCS, least_docs: int = LEAST_DOCS) -> Model:
    """Learn from the labelled documents that are not held out: about ``max_docs`` of them by a hash of the id.

    Of each language at least some ``least_docs`` are read, or all if it has fewer, so a rare language is known too.
    Rows with a null text or language teach nothing, nor do texts without letters; a language that teaches nothing is
    never predicted.  Without any language the model answers ``und`` throughout.  Rows with a null id are drawn together.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("body"))
    labelled = source.filter(F.col("lang").isNotNull() & F.col("body").isNotNull() & ~held_out(F.col("id")))
    by_lang = store(labelled.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    total = by_lang.agg(F.sum("n")).first()[0] or 0
    wanted = F.greatest(F.lit(max_docs / max(total, 1)), F.lit(float(least_docs)) / F.col("n"))
    shares = by_lang.select("lang", (F.least(F.lit(1.0), wanted) * (1 << 30)).cast("long").alias("below"))
    some = labelled.join(shares, "lang").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("below"))
    by_word = store(
        some.select("lang", "body").mapInArrow(_count_words, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")),
        "words",
    )
    by_gram = by_word.mapInArrow(_count_grams, "kind int, lang string, piece string, n long")
    pieces = by_word.select(F.lit(0).alias("kind"), "lang", "piece", "n").union(by_gram)
    counted = (
        pieces.groupBy("kind", "piece", "lang").agg(F.sum("n").alias("n"))
        .groupBy("kind", "piece").agg(F.collect_list(F.struct("lang", "n")).alias("by"), F.sum("n").alias("n"))
        .filter(F.col("n") >= F.when(F.col("kind") == 0, LEAST_WORD).otherwise(LEAST_GRAM))
        .select("kind", "piece", F.explode("by").alias("one")).select("kind", "piece", "one.lang", "one.n")
    )
    found = counted.toArrow()
    kinds, n = found.column("kind").to_numpy(), found.column("n").to_numpy()
    coded = found.column("lang").combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    langs = sorted(names)
    of_lang = np.array([langs.index(x) for x in names], np.int64)[coded.indices.to_numpy()] if names else np.zeros(0, np.int64)
    docs_of = {r["lang"]: r["n"] for r in by_lang.filter(F.col("lang").isin(langs)).collect()} if langs else {}
    discard(by_word, by_lang)
    if not langs:
        return Model([], np.zeros(0), {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    prior = np.log(np.array([docs_of[x] for x in langs]) / sum(docs_of.values()))
    index: dict[int, dict[str, int]] = {}
    logs: dict[int, np.ndarray] = {}
    for kind in range(LONGEST + 1):
        mine = np.flatnonzero(kinds == kind)
        piece = found.column("piece").take(pa.array(mine)).combine_chunks().dictionary_encode()
        texts = piece.dictionary.to_pylist()
        index[kind] = {p: i for i, p in enumerate(texts)}
        logs[kind] = _logs(texts, of_lang[mine], n[mine], piece.indices.to_numpy(), len(langs))
    begun = np.cumsum([0, *(len(logs[k]) for k in range(1, LONGEST + 1))]).tolist()
    of_grams = {p: i + begun[k - 1] for k in range(1, LONGEST + 1) for p, i in index[k].items()}
    return Model(langs, prior, index[0], logs[0], of_grams, np.concatenate([logs[k] for k in range(1, LONGEST + 1)]))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the language's share of the odds) of the whole text.

    ``und`` and 0.0 if the text is null or has no letter.  Input columns of these names are replaced; all others, repeated
    rows and null ids are kept; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        one = shared.value

        def score(texts: list[bytes]) -> list[pa.Array]:
            found = [one.predict(t.decode("utf-8", "replace")) for t in texts]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return score

    return add_columns(docs, text_col, [("lang_pred", T.StringType()), ("score", T.DoubleType())], make)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
