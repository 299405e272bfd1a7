"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

At most about ``MAX_TRAIN_ROWS`` labelled rows, chosen by a hash of their id, are learned from: one half gives weights to
words and beginnings of words that toxic texts have more often (for languages that the built-in lexicon lacks), the other
half the trees.  The sample's ids are broadcast to the texts and scoring is one pass, so texts are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.shipping import ship
from ..plans.storage import store
from .textio import add_columns, texts_of

MAX_TRAIN_ROWS = 20_000
#: Documents that must have a learned piece; odds at least; shortest and longest beginning of a word.
LEAST_DOCS, LEAST_ODDS, BEGIN, END = 5, 4.0, 5, 9
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.2, 32, 5
#: Words apart at which an insult counts as near a second person.
NEAR = 6
#: Token classes that a worker remembers.
KEPT = 150_000

#: Insults and abuse (fixed values).
LEXICON = frozenset(
    """asshole bastard bitch brainless bullshit clown coward crap cretin cunt damn degenerate despicable dickhead dimwit
    dipshit disgrace disgusting douche dumb dumbass dunce dirtbag failure fascist filth filthy fool freak fuck fucker
    fucking garbage halfwit hate hateful hideous idiot idiotic idiots ignorant imbecile jackass jerk kill loathsome loser
    losers lowlife maggot moron moronic morons motherfucker nazi nitwit pathetic pig piss prick psycho rat repulsive retard
    retarded scum scumbag shit shitty shut sickening simpleton slime slut stupid stupidity suck sucks swine terrible trash
    twat ugly useless vermin vile wanker whore worthless wretch arschloch blöd blödmann dumm dummkopf idioten abschaum
    trottel hurensohn schwein verlierer wertlos connard crétin débile imbécile merde ordure salaud stupide salope cabrón
    estúpido estúpida gilipollas idiota imbécil mierda basura patético pendejo puta perdedor""".split()
)
#: Second person (fixed values).
SECOND = frozenset("you your yours yourself youre u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti usted ustedes vosotros".split())
_LEET = str.maketrans("0134578@$!|+", "oleastbasiit")
_EDGE = ".,;:!?\"'()[]{}<>*#&%$-_/\\|~`"
#: Signs around a word that never stand for its letters.
_AROUND = ".,;:!?\"'()[]{}<>"
_MASKED = re.compile(r"[*#.\-_]")
#: Single letters parted by blanks, and two capitals side by side (no word is shouted without).
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:\s[^\W\d_]){2,}(?!\S)")
_CAPITALS = re.compile(r"[A-Z\u00c0-\u00d6\u00d8-\u00de]{2}")
_SIGNS = re.compile(r"[!?]")
FEATURES = (
    "words", "insults", "insult_rate", "distinct_insults", "masked", "masked_rate", "second_rate", "near", "near_rate", "capitals",
    "shouted", "signs", "runs_of_signs", "odd_tokens", "learned", "learned_rate", "learned_distinct", "weight", "weight_rate", "heaviest",
)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _masked_insult(token: str) -> bool:
    """An insult with letters replaced by look-alikes or stars, or with signs put between its letters."""
    if token.isalpha() or len(token) < 3:
        return False
    plain = token.translate(_LEET)
    if plain in LEXICON or _MASKED.sub("", plain) in LEXICON or re.sub(r"(.)\1+", r"\1", plain) in LEXICON:
        return True
    if "*" in token and len(token) >= 4 and token.replace("*", "").isalpha():
        shape = re.compile(re.escape(token).replace(r"\*", "."))
        return any(shape.fullmatch(w) for w in LEXICON)
    return False


class Classes(dict):
    """Of each token: 1 insult, 2 second person, 3 masked insult, 4 letters mixed with other signs, 0 any other; from 5 on
    the place of the longest learned piece that the token is or begins with."""

    def __init__(self, pieces: dict[str, float]):
        self.places = {piece: i for i, piece in enumerate(pieces, 5)}
        self.weights = np.array([0.0] * 5 + list(pieces.values()))

    def __missing__(self, token: str) -> int:
        outer = token.strip(_AROUND)
        found = 3 if outer != outer.strip(_EDGE) and _masked_insult(outer) else self._find(token.strip(_EDGE))
        if len(self) >= KEPT:
            self.clear()
        self[token] = found
        return found

    def _find(self, word: str) -> int:
        if word in LEXICON:
            return 1
        if word.replace("'", "") in SECOND:
            return 2
        for piece in pieces_of(word):
            if piece in self.places:
                return self.places[piece]
        if not word or word.isalpha():
            return 0
        return 3 if _masked_insult(word) else 4


def pieces_of(word: str) -> list[str]:
    """The word itself (with an end sign) and its beginnings, longest first."""
    return [word + "$", *(word[:k] for k in range(min(END, len(word)), BEGIN - 1, -1))]


_KNOWN: dict[int, Classes] = {}


def classes(pieces: dict[str, float]) -> Classes:
    """The worker's token classes for these learned pieces."""
    key = hash(tuple(pieces.items()))
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Classes(pieces)
    return _KNOWN[key]


def features(text: str, known: Classes) -> list[float]:
    """The dense features of a whole text; an empty text has zeros.  Letters parted by blanks that spell an insult count as masked."""
    low = text.lower().split()
    n = len(low)
    if not n:
        return [0.0] * len(FEATURES)
    codes = np.fromiter(map(known.__getitem__, low), np.int64, n)
    counts = np.bincount(np.minimum(codes, 5), minlength=6)
    learned = codes[codes >= 5]
    weights = known.weights[learned]
    total = float(weights.sum())
    insults, second, masked = int(counts[1]), int(counts[2]), int(counts[3])
    distinct = near = 0
    if insults + masked:  # spelt ones have no place of their own
        at = np.flatnonzero((codes == 1) | (codes == 3))
        distinct = len({low[i].strip(_EDGE) for i in at.tolist()})
        if second:
            persons = np.flatnonzero(codes == 2)
            after = np.searchsorted(persons, at)
            left = at - persons[np.maximum(after - 1, 0)]
            right = persons[np.minimum(after, len(persons) - 1)] - at
            near = int(((np.abs(left) <= NEAR) | (np.abs(right) <= NEAR)).sum())
    letters = len(text)
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(text.encode().translate(None, _NOT_UPPER))
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if _CAPITALS.search(text) else 0
    masked += sum("".join(m.split()) in LEXICON for m in _SPACED.findall(text.lower()))
    signs = len(_SIGNS.findall(text))
    runs = text.count("!!") + text.count("??") + text.count("!?") if signs else 0
    return [
        np.log1p(n), insults, insults / n, distinct, masked, masked / n, second / n, near, near / n, upper / letters,
        shouted / n, signs / n, runs / n, counts[4] / n, len(learned), len(learned) / n, len(np.unique(learned)),
        total, total / n, float(weights.max()) if len(learned) else 0.0,
    ]


_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)


def _matrix(texts: list[bytes], pieces: dict[str, float]) -> np.ndarray:
    known = classes(pieces)
    return np.array([features(t.decode("utf-8", "replace"), known) for t in texts], np.float64).reshape(-1, len(FEATURES))


def with_features(docs: DataFrame, pieces: dict[str, float], text_col: str = "text") -> DataFrame:
    """``docs`` and column toxic_features (array<double>, see FEATURES); null texts are empty."""

    def make():
        return lambda texts: [pa.array(list(_matrix(texts, pieces)), pa.list_(pa.float64()))]

    return add_columns(docs, text_col, [("toxic_features", T.ArrayType(T.DoubleType()))], make)


@dataclass
class Trees:
    """Boosted trees of equal depth as arrays: (trees, inner nodes) features and cuts, (trees, leaves) values."""

    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.features.shape[1]
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Gradient boosting for log loss, with Newton leaves, on histograms of at most ``BINS`` quantile bins."""
    positive = min(max(y.mean(), 1e-4), 1 - 1e-4)
    base = float(np.log(positive / (1 - positive)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    for f in range(x.shape[1]):  # rare values above a common one still get cuts
        tail = np.unique(x[x[:, f] > edges[f][-1], f])
        edges[f] = np.unique(np.concatenate([edges[f], tail[:: max(1, len(tail) // 8)][:8]]))
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    width = max(map(len, edges)) + 1
    inner, ends = 2**depth - 1, 2**depth
    out_f, out_c, out_v, score = [], [], [], np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = node - first
            gain, best = np.full(many, 1e-9), [(-1, 0)] * many
            for f in range(x.shape[1]):
                slot = at * width + binned[:, f]
                hg, hh, hn = (np.bincount(slot, w, many * width).reshape(many, width).cumsum(1) for w in (g, h, None))
                left_g, left_h, left_n = hg[:, :-1], hh[:, :-1], hn[:, :-1]
                all_g, all_h, all_n = hg[:, -1:], hh[:, -1:], hn[:, -1:]
                won = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                won[(left_n < LEAF) | (all_n - left_n < LEAF)] = -1
                top = won.argmax(1)
                for m in range(many):
                    if top[m] < len(edges[f]) and won[m, top[m]] > gain[m]:
                        gain[m], best[m] = won[m, top[m]], (f, int(top[m]))
            for m, (f, b) in enumerate(best):
                if f >= 0:
                    feature[first + m], cut[first + m] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, ends) / (np.bincount(leaf, h, ends) + 1)
        score += value[leaf]
        out_f.append(feature)
        out_c.append(cut)
        out_v.append(value)
    return Trees(base, np.array(out_f), np.array(out_c), np.array(out_v))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising (score, share) points; shares are drawn a little towards the mean."""
    order = np.argsort(score, kind="stable")
    s, first = np.unique(score[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), first)
    sizes = np.diff(np.append(first, len(y))).astype(float)
    blocks: list[list[float]] = []  # sum, size, lowest score, highest score
    for value, total, size in zip(s, sums, sizes, strict=True):
        blocks.append([total, size, value, value])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    mean = float(y.mean())
    xs = np.array([v for b in blocks for v in (b[2], b[3])])
    return xs, np.maximum.accumulate(np.repeat([(b[0] + mean) / (b[1] + 1) for b in blocks], 2))


@dataclass
class Model:
    pieces: dict[str, float]
    trees: Trees | None
    xs: np.ndarray
    ys: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.prior)
        raw = self.trees.raw(x)
        # a hair of the raw score keeps the order inside a calibrated step
        return np.clip(np.interp(raw, self.xs, self.ys) * (1 - 1e-3) + 1e-3 / (1 + np.exp(-raw)), 0.0, 1.0)


def fit(x: np.ndarray, y: np.ndarray, pieces: dict[str, float], folds: int = 4) -> Model:
    """Trees on all rows; calibration on scores that each row gets from trees learned without its fold.

    With no rows or one class only, the score is that class's share (0 without rows).
    """
    if not len(y) or y.min() == y.max():
        return Model(pieces, None, np.zeros(0), np.zeros(0), float(y.mean()) if len(y) else 0.0)
    fold = np.random.default_rng(7).permutation(len(y)) % folds
    crossed = np.zeros(len(y))
    for k in range(folds):
        crossed[fold == k] = boost(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(pieces, boost(x, y), *isotonic(crossed, y), float(y.mean()))


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, toxic documents, other documents) of a task's texts."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for toxic, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
            words = {w.strip(_EDGE) for w in text.decode("utf-8", "replace").lower().split()}
            counts[toxic].update({p for w in words for p in pieces_of(w) if len(p) > 3})
        pieces = [p for p in counts[1]] + [p for p in counts[0] if p not in counts[1]]
        for at in range(0, len(pieces), 50_000):
            some = pieces[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), pa.array([counts[1][p] for p in some], pa.int64()), pa.array([counts[0][p] for p in some], pa.int64())],
                names=["piece", "toxic", "other"],
            )


def learn_pieces(train: DataFrame) -> dict[str, float]:
    """Log odds of the pieces that toxic texts have clearly more often, from (toxic, body) rows."""
    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {}
    counted = train.select("toxic", "body").mapInArrow(_count_pieces, "piece string, toxic long, other long")
    odds = ((F.col("toxic") + 0.5) / (n[1] + 1)) / ((F.col("other") + 0.5) / (n[0] + 1))
    best = (
        counted.groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(F.col("toxic") >= LEAST_DOCS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.log("odds") * F.col("toxic")), "piece")
    )
    return {r["piece"]: float(np.log(r["odds"])) for r in best.collect()}


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on labelled rows that are not held out; null labels and ids teach nothing, null texts are empty."""
    ship(docs.sparkSession)
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    share = min(1.0, max_rows / max(known.count(), 1))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    some = known.filter(drawn < F.lit(int(share * (1 << 30)))).withColumn("half", drawn % 2)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("body"))
    train = store(texts.join(F.broadcast(some), "id").select("id", "toxic", "half", "body"), "labelled")
    pieces = learn_pieces(train.filter("half = 0"))
    rows = with_features(train.filter("half = 1").select("id", "toxic", "body"), pieces, "body").select("id", "toxic", "toxic_features").collect()
    rows.sort(key=lambda r: (r["id"], r["toxic"], r["toxic_features"]))
    x = np.array([r["toxic_features"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["toxic"] for r in rows], np.int64), pieces)


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score and predicted; input columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            scores = shared.value.score(_matrix(texts, shared.value.pieces))
            return [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]

        return score

    return add_columns(docs, text_col, [("score", T.DoubleType()), ("predicted", T.IntegerType())], make)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``; scores depend on the texts alone.

    Null and empty texts get the score of a text without words; null ids are scored like any other.  Equal texts score
    alike, repeated rows are kept, an empty table gives an empty table, and without labels the score is 0.
    """
    narrow = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__cf_body"))
    scored = score_texts(narrow, learn(docs, labels, id_col, text_col), "__cf_body")
    return scored.select(id_col, held_out(F.col(f"`{id_col}`")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those predicted toxic; decided row by row from the text, so null and repeated ids need no join."""
    model = learn(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [pa.array(shared.value.score(_matrix(texts, shared.value.pieces)) >= THRESHOLD)]

    judged = add_columns(docs, text_col, [("__cf_toxic", T.BooleanType())], make)
    return judged.filter("not __cf_toxic").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
