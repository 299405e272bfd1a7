"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton (words as letters) is built by every worker from the benchmark's items, whose size is checked first: up to
``MAX_ITEM_WORDS`` words they are broadcast.  Beyond, the items are dealt into groups by a hash of their id, each with an
automaton of its own, and only texts that hold a hash of a group's windows are sent to it.  Words are streamed through the
automaton, which holds the length of the longest match that ends at each word; stretches of words that can hold no window
(a pair of neighbours that no item has) are passed over, which changes nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.shipping import ship
from ..plans.storage import store
from .lines import word_hashes
from .textio import TEXT, give_back, texts_of

WINDOW = 10
#: Words of one automaton; some 600 bytes each.
MAX_ITEM_WORDS = 200_000
_WORD_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PAIRS = 1 << 22


def words_of(text: bytes) -> list[bytes]:
    """Words after lower-casing A-Z: runs of digits, letters and non-ASCII characters."""
    return text.translate(_WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the items that hold each matched window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        coded = []
        for name, words in items:
            if words:
                codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append((name, codes))
                self.shortest = min(self.shortest, len(codes))
                last = 0
                for c in codes:
                    last = self._extend(last, c)
        n = len(self.go)
        self.holders: list[set[str]] = [set() for _ in range(n)]  # items of >= window words that hold a state's strings
        self.whole: list[dict[int, set[str]]] = [{} for _ in range(n)]  # shorter items that are a string of the state
        for name, codes in coded:
            state = 0
            for c in codes:
                state = self.go[state][c]
                if len(codes) >= window:
                    self.holders[state].add(name)
            if len(codes) < window:
                self.whole[state].setdefault(len(codes), set()).add(name)
        for state in sorted(range(1, n), key=self.length.__getitem__, reverse=True):
            self.holders[self.link[state]] |= self.holders[state]
        self.holders[0] = set()
        pairs = [(a, b) for _, codes in coded for a, b in zip(codes, codes[1:])]
        self._pairs = np.zeros(_PAIRS, bool)
        if pairs:
            a, b = np.array(pairs, np.int64).T
            self._pairs[(a * 1_000_003 + b) % _PAIRS] = True

    def _extend(self, last: int, c: int) -> int:
        go, link, length = self.go, self.link, self.length
        if c in go[last]:
            q = go[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = self._state(length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p != -1:
            q = go[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _state(self, length: int, go: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.go.append(go)
        self.link.append(link)
        return len(self.go) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.go[q]), self.link[q])
        self.link[q] = twin
        while p != -1 and self.go[p].get(c) == q:
            self.go[p][c] = twin
            p = self.link[p]
        return twin

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [first, end) of words in occurring windows, merged and in order, and the items that have them."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.vocabulary or len(words) < self.shortest:
            return spans, items
        codes = np.fromiter(map(self.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
        joined = (codes[:-1] >= 0) & (codes[1:] >= 0)
        joined &= self._pairs[(codes[:-1] * 1_000_003 + codes[1:]) % _PAIRS]
        cuts = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        runs = [(int(a), int(b) + 1) for a, b in zip(cuts[::2], cuts[1::2]) if b + 1 - a >= self.shortest]
        if self.shortest == 1:
            alone = codes >= 0
            alone[:-1] &= ~joined
            alone[1:] &= ~joined
            runs = sorted(runs + [(int(i), int(i) + 1) for i in np.flatnonzero(alone)])
        for a, b in runs:
            self._stream(codes[a:b].tolist(), a, spans, items)
        return spans, items

    def _stream(self, codes: list[int], at: int, spans: list[tuple[int, int]], items: set[str]) -> None:
        go, link, length, window = self.go, self.link, self.length, self.window
        state = matched = 0
        for i, c in enumerate(codes, at + 1):  # i: words read up to here
            while state and c not in go[state]:
                state = link[state]
                matched = length[state]
            if c in go[state]:
                state = go[state][c]
                matched += 1
            longest, s = 0, state
            while s:
                reach = min(matched, length[s])
                if reach >= window:
                    if length[link[s]] < window:  # the state of the last ``window`` words
                        if self.holders[s]:
                            longest = max(longest, window)
                            items |= self.holders[s]
                for size, names in self.whole[s].items():
                    if size <= reach:
                        longest = max(longest, size)
                        items |= names
                s = link[s]
            if longest:
                first = i - longest
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i))


def _items_of(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, body) as strings; null or wordless texts and rows with a null id have no windows."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("body"))
    return items.filter("item is not null and body is not null")


def _groups(items: DataFrame) -> int:
    """Into how many automata the items go; their size is asked for before anything is gathered."""
    n = items.agg(F.sum(F.length("body"))).first()[0] or 0
    return max(1, -(-int(n) // (6 * MAX_ITEM_WORDS)))


def _gathered(items: DataFrame) -> list[tuple[str, bytes]]:
    """The items of a benchmark that fits one automaton."""
    return [(r["item"], r["body"].encode()) for r in items.toLocalIterator()]


_OWN = [("n_words", T.LongType()), ("hits", T.ArrayType(T.ArrayType(T.LongType()))), ("hit_items", T.ArrayType(T.StringType()))]
_AUTOMATA: dict[int, Automaton] = {}


def _automaton(items: list[tuple[str, bytes]], window: int) -> Automaton:
    key = zlib.crc32(repr((window, items)).encode())
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Automaton([(name, words_of(text)) for name, text in items], window)
    return _AUTOMATA[key]


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, hits (spans of words in occurring windows, [first, end) and merged) and hit_items.

    Null texts have no words.  Input columns of these names are replaced; all others and repeated rows are kept.  An empty
    table gives an empty table, an empty benchmark no hits.
    """
    spark = docs.sparkSession
    ship(spark)
    names = {n for n, _ in _OWN}
    kept = [c for c in docs.columns if c.lower() not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(TEXT))
    items = _items_of(benchmark, "item_id", "text")
    groups = _groups(items)
    if groups > 1:
        return _find_in_groups(source, kept, store(items.withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int")), "items"), window)
    shared = spark.sparkContext.broadcast(_gathered(items))
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, t) for n, t in _OWN)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value, window)
        for batch in batches:
            n, hits, items_of = [], [], []
            for text in texts_of(batch):
                words = words_of(text)
                n.append(len(words))
                spans, found = automaton.match(words)
                hits.append(_merged(spans))
                items_of.append(sorted(found))
            columns = [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.list_(pa.int64()))), pa.array(items_of, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


#: Bits of the filter of windows at most (32 MB), for each window, and where its three places begin in a hash.
FILTER_BITS, BITS_PER_WINDOW, PLACES = 28, 64, (0, 18, 36)
#: Documents that one copy of an automaton reads.
READERS = 20_000
_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64) | 1 for i in range(64)], np.uint64)


def window_hashes(text: bytes, lengths: list[int]) -> tuple[int, np.ndarray]:
    """(words, 64-bit hashes of all runs of so many words), for each of ``lengths`` one after the other."""
    marked = text.translate(_WORD_BYTES)
    edges = np.flatnonzero(np.diff(np.frombuffer(b" " + marked + b" ", np.uint8) != 32))
    starts, ends = edges[::2], edges[1::2]
    words = word_hashes(marked + bytes(16), starts, ends, 0)
    out = []
    for length in lengths:
        n = len(words) - length + 1
        if n > 0:
            total = np.full(n, length, np.uint64)
            for k in range(length):
                total = (total ^ (total >> np.uint64(31))) * _ODD[k % 64] + words[k : k + n]
            out.append(total ^ (total >> np.uint64(29)))
    return len(words), np.concatenate(out) if out else np.zeros(0, np.uint64)


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(grp, length, h) of the windows of (grp, body) items."""
    for batch in batches:
        for grp, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            length = min(window, len(words_of(body)))
            _, hashes = window_hashes(body, [length] if length else [])
            n = len(hashes)
            yield pa.RecordBatch.from_arrays([pa.array([grp] * n, pa.int32()), pa.array([length] * n, pa.int32()), pa.array(hashes.view(np.int64))], names=["grp", "length", "h"])


def _find_in_groups(source: DataFrame, kept: list[str], items: DataFrame, window: int) -> DataFrame:
    """:func:`find_leaks` for a benchmark of several automata, of which the driver holds a filter of fixed size only.

    Texts run past a filter of all windows' hashes; those that pass it are few and are written with numbers of their own.
    Their hashes meet the windows by a join, which tells the groups whose automata have to read them; a group that very
    many texts ask for is copied, and each text goes to one copy.
    """
    spark = source.sparkSession
    windows = store(items.select("grp", "body").mapInArrow(lambda b: _windows(b, window), "grp int, length int, h long").distinct(), "windows")
    told = windows.agg(F.count("*").alias("n"), F.collect_set("length").alias("lengths")).first()
    lengths, bits = sorted(told["lengths"]), min(FILTER_BITS, max(20, int(told["n"] * BITS_PER_WINDOW).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned("h", p).bitwiseAND((1 << bits) - 1) for p in PLACES]))
    cells = windows.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("v")).toArrow()
    full = np.zeros(1 << (bits - 6), np.uint64)
    full[cells.column("cell").to_numpy()] = cells.column("v").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(full)
    schema = T.StructType([*source.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("__cf_seen", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = shared.value, np.uint64((1 << bits) - 1)
        for batch in batches:
            n, seen = [], []
            for text in texts_of(batch):
                many, hashes = window_hashes(text, lengths)
                for place in PLACES:
                    cell = (hashes >> np.uint64(place)) & mask
                    hashes = hashes[(known[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1]
                n.append(many)
                seen.append(np.unique(hashes).view(np.int64))
            columns = [*batch.columns, pa.array(n, pa.int64()), pa.array(seen, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    sifted = source.mapInArrow(sift, schema)
    none_hits, none_items = F.array().cast("array<array<bigint>>"), F.array().cast("array<string>")
    own = [F.col(f"`{c}`") for c in kept]
    clean = sifted.filter(F.size("__cf_seen") == 0).select(*own, "n_words", none_hits.alias("hits"), none_items.alias("hit_items"))
    some = store(sifted.filter(F.size("__cf_seen") > 0).withColumn("__cf_row", F.monotonically_increasing_id()), "some")  # written, so numbers stay
    asked = some.select("__cf_row", F.explode("__cf_seen").alias("h")).join(windows.select("h", "grp"), "h").select("__cf_row", "grp").distinct()
    asked = store(asked, "asked")
    copies = asked.groupBy("grp").agg(F.ceil(F.count("*") / READERS).alias("n"))
    read = some.select("__cf_row", TEXT).join(asked.join(copies, "grp").select("__cf_row", "grp", F.pmod(F.xxhash64("__cf_row"), F.col("n")).alias("copy")), "__cf_row")
    texts = read.select("grp", "copy", F.col("__cf_row").alias("row"), F.lit(None).cast("string").alias("item"), F.col(TEXT).alias("body"))
    books = items.join(copies, "grp").select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"), F.lit(None).cast("long").alias("row"), "item", "body")
    dealt = books.union(texts).repartition("grp", "copy").sortWithinPartitions("grp", "copy", F.col("row").isNotNull())

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, book, automaton = None, [], None
        for batch in batches:
            rows, spans_of, names_of = [], [], []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for grp, copy, row, item, body in zip(*columns, texts_of(batch), strict=True):
                if (grp, copy) != now:
                    now, book, automaton = (grp, copy), [], None
                if row is None:
                    book.append((item, body))
                    continue
                if automaton is None:
                    automaton = _automaton(book, window)
                spans, found = automaton.match(words_of(body))
                rows.append(row)
                spans_of.append(_merged(spans))
                names_of.append(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(spans_of, pa.list_(pa.list_(pa.int64()))), pa.array(names_of, pa.list_(pa.string()))], names=["row", "hits", "hit_items"])
        give_back()

    found = dealt.mapInArrow(match, "row long, hits array<array<long>>, hit_items array<string>")
    by_row = found.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"))

    def joined(done, span):
        last = F.get(done, F.size(done) - 1)
        meets = (F.size(done) > 0) & (span[0] <= last[1])
        return F.when(meets, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.array(last[0], F.greatest(last[1], span[1]))))).otherwise(F.concat(done, F.array(span)))

    merged = by_row.select("row", F.aggregate("spans", none_hits, joined).alias("hits"), "hit_items")
    dirty = some.join(merged, F.col("__cf_row") == F.col("row"), "left")
    return clean.union(dirty.select(*own, "n_words", F.coalesce("hits", none_hits).alias("hits"), F.coalesce("hit_items", none_items).alias("hit_items")))


def _without(text: bytes, spans: list[list[int]]) -> bytes:
    """``text`` without the bytes from each span's first word to its last."""
    marked = text.translate(_WORD_BYTES)
    at = np.flatnonzero(np.diff(np.frombuffer(b" " + marked + b" ", np.uint8) != 32))
    starts, ends = at[::2], at[1::2]
    out, kept_to = [], 0
    for a, b in spans:
        out.append(text[kept_to : starts[a]])
        kept_to = int(ends[b - 1])
    return b"".join([*out, text[kept_to:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    max_words: int = WINDOW - 1,
    max_coverage: float = 0.5,
) -> DataFrame:
    """``docs`` without benchmark passages: spans of over ``max_words`` hit words are cut out of the texts, and documents
    of which over ``max_coverage`` of the words are hit are removed.  Spans shorter than a window are whole short items and are
    cut out whatever ``max_words`` is.  Clean documents are returned as they are; null texts stay null, repeated rows and
    other columns are kept, an empty table or benchmark changes nothing.
    """
    spark, columns = docs.sparkSession, docs.columns
    ship(spark)
    items = _items_of(benchmark, "item_id", "text")
    arrow, text_at = to_arrow_schema(docs.schema), columns.index(text_col)
    several = _groups(items) > 1
    if several:  # spans of all groups first
        hits = F.col("hits").alias("__cf_hits")
        source = find_leaks(docs, benchmark, text_col, window).select(*[F.col(f"`{c}`") for c in columns], hits)
    else:
        source = docs
    shared = spark.sparkContext.broadcast([] if several else _gathered(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None if several else _automaton(shared.value, window)
        for batch in batches:
            texts, kept = batch.column(text_at).cast(pa.binary()).to_pylist(), []
            found = batch.column(len(columns)).to_pylist() if several else None
            for i, text in enumerate(texts):
                words = words_of(text or b"")
                spans = found[i] if several else _merged(automaton.match(words)[0])
                kept.append(sum(b - a for a, b in spans) <= max_coverage * len(words))
                long = [s for s in spans if s[1] - s[0] > max_words or s[1] - s[0] < window]
                if long and kept[-1]:
                    texts[i] = _without(text, long)
            cut = pa.array(texts, pa.binary()).view(pa.string())  # bytes that are no UTF-8 stay as they are
            out = [*batch.columns[:text_at], cut, *batch.columns[text_at + 1 : len(columns)]]
            out = [c if c.type == f.type else c.cast(f.type) for c, f in zip(out, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(out, schema=arrow).filter(pa.array(kept, pa.bool_()))

    return source.mapInArrow(run, docs.schema)


def items_digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
