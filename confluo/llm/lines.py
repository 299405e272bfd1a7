"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased, cut at white space).  Words are ordered by rarity: occurrences over the
whole corpus in 2**20 hash buckets (a table of fixed size), then the hash; any one order makes the join exact, rarity makes
it small.  Two sets with Jaccard similarity of at least t share a word among their first n - ceil(t n) + 1 words, so only
those prefixes meet.  If the first word that two sets share is a frequent one, all that they share are, and so is the second:
a frequent word of a prefix is keyed by pairs with the words after it, so groups of one word stay small however large the
corpus is.

Prefixes travel as packed blocks of columns (key, place, size, position, 64 to 256 parities of words by the line's length),
dealt by key; a task meets groups of one key.  Pairs must pass the length filter, the positional filter and a bound by the parities.  A line asks first
the earliest few lines of its group; at the first that passes it stops, so groups of many similar lines cost their size, not
its square.  All pairs are compared word by word on the lines themselves.  Lines that stopped at candidates which all fail
then meet the rest of those groups.
A line is removed if an earlier line (by document id, then place) of the corpus is equal or similar to it.
"""

from __future__ import annotations

import secrets
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shipping import ship
from ..plans.storage import discard, store
from .textio import give_back

THRESHOLD = 0.8
#: Hash buckets of word counts (fixed), and parts of that table that are added up apart.
BUCKETS, SLICES = 1 << 20, 64
#: A word is frequent if its bucket holds more occurrences than this.
FREQUENT = 4096
#: Prefix words of a block before it is dealt out, and of one part on average.
BLOCK_WORDS, PART_WORDS = 1_000_000, 400_000
#: Words of a line above which its parities are 128 and 256 instead of 64: enough to tell unlike lines of that length apart.
MORE_PARITIES = (64, 160)
#: Earliest lines of a group that a line asks one by one.
ASKED = 8
#: Bytes of a table up to which it is broadcast; beyond, it is joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Bytes of text handled at a time; a longer text is handled alone.
TEXT_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NEWLINE = 10
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: Where a null id stands in the order of ids; the least long stands there too.
_FIRST = -(1 << 63)


def _mixed(x: np.ndarray, odd: np.uint64) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= odd
    x ^= x >> np.uint64(29)
    x *= _ODD[2]
    return x ^ (x >> np.uint64(32))


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of stretches of ``data``, which 16 bytes follow that belong to none.

    Words of up to 8 bytes and one length never collide; up to 64 bytes are folded 8 at a time, longer words go to XXH3.
    """
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    lengths = ends - starts
    masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
    key = np.uint64(seed)
    out = _mixed((eight[starts] & masks[np.minimum(lengths, 8)]) ^ key, _ODD[0]) + lengths.astype(np.uint64) * _ODD[1]
    for at in range(8, 64, 8):
        more = np.flatnonzero((lengths > at) & (lengths <= 64))
        if not len(more):
            break
        piece = eight[starts[more] + at] & masks[np.minimum(lengths[more] - at, 8)]
        out[more] = _mixed(out[more] ^ _mixed(piece ^ key, _ODD[3]), _ODD[0])
    for i in np.flatnonzero(lengths > 64).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]], seed)
    return out


class _Lines:
    """The lines with words of some texts: text and line number, and the 64-bit hashes of their words."""

    def __init__(self, texts: list[bytes], seed: int):
        data = b"\n".join([*texts, bytes(16)]).lower()  # of bytes: A-Z only
        block = np.frombuffer(data, np.uint8, max(len(data) - 17, 0))
        blank = _SPACE[block]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        before = np.cumsum(block == _NEWLINE, dtype=np.int32)  # newlines up to each byte
        line = before[starts]
        first = np.flatnonzero(np.diff(line, prepend=-1))
        self.counts = np.diff(np.append(first, len(line)))  # words, repeats included
        self.firsts = first
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.zeros(0, np.int64)
        lines = line[first]
        self.text = np.searchsorted(begins, starts[first], side="right") - 1
        self.number = lines - np.where(begins > 0, before[np.maximum(begins, 1) - 1], 0)[self.text] if len(first) else lines
        self.hashes = word_hashes(data, starts, ends, seed)

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(lines, word hashes in order, which are the first of their kind), for lines of like length at a time."""
        widths = 1 << np.ceil(np.log2(np.maximum(self.counts, 1))).astype(np.int64)
        for width in np.unique(widths).tolist():
            every = np.flatnonzero(widths == width)
            step = max(1, (1 << 20) // width)
            for at in range(0, len(every), step):
                mine = every[at : at + step]
                places = np.arange(width)
                inside = places < self.counts[mine][:, None]
                where = np.minimum(self.firsts[mine][:, None] + places, len(self.hashes) - 1)
                words = np.sort(np.where(inside, self.hashes[where], _NONE), axis=1)
                distinct = words != _NONE
                distinct[:, 1:] &= words[:, 1:] != words[:, :-1]
                yield mine, words, distinct


def _keys(words: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k1, k2, size) of sets: two sums of word hashes, scrambled apart."""
    zero = np.uint64(0)
    k1 = np.where(distinct, words, zero).sum(1, dtype=np.uint64)
    k2 = np.where(distinct, _mixed(words, _ODD[1]), zero).sum(1, dtype=np.uint64)
    return k1.view(np.int64), k2.view(np.int64), distinct.sum(1)


def _slices(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with their texts, some megabytes of text at a time."""
    for whole in batches:
        texts = [t or b"" for t in whole.column(text_at).cast(pa.binary()).to_pylist()]
        start = size = 0
        for i, text in enumerate(texts):
            if i > start and size + len(text) > TEXT_BYTES:
                yield whole.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(text)
        if len(texts) > start:
            yield whole.slice(start), texts[start:]


_SCAN = "kind int, doc long, hash long, line int, k1 long, k2 long, counts binary"
_ZSTD = pa.Codec("zstd")


def _scan(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: lines with words; 1: one per document, with the number of its lines; 2: word counts of the task.

    Counts are those of the buckets of one slice (line), packed and compressed; k1 is the bytes of one count.
    """
    counts = np.zeros(BUCKETS, np.int64)
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def rows(kind: int, *columns) -> pa.RecordBatch:
        columns = [np.full(len(columns[0]), kind, np.int32), *columns]
        if len(columns) < len(types):
            columns.append(pa.nulls(len(columns[0]), pa.binary()))
        done = [c if isinstance(c, pa.Array) else pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(done, names=["kind", "doc", "hash", "line", "k1", "k2", "counts"])

    for batch, texts in _slices(batches, 2):
        docs, hashed = batch.column(0), batch.column(1)
        found = _Lines(texts, seed)
        zeros = np.zeros(len(texts), np.int64)
        yield rows(1, docs, hashed, np.bincount(found.text, minlength=len(texts)), zeros, zeros)
        for mine, words, distinct in found.rows():
            k1, k2, _ = _keys(words, distinct)
            counts += np.bincount((words[distinct] & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            taken = pa.array(found.text[mine])
            yield rows(0, docs.take(taken), hashed.take(taken), found.number[mine], k1, k2)
    for i, part in enumerate(counts.reshape(SLICES, -1)):
        if most := int(part.max()):
            small = part.astype(np.min_scalar_type(most))
            none = pa.nulls(1, pa.int64())
            packed = _ZSTD.compress(small.tobytes(), asbytes=True)
            yield rows(2, none, none, np.array([i]), np.array([small.itemsize]), np.zeros(1), pa.array([packed], pa.binary()))
    give_back()


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, counts) summed over (slice, bytes of one count, packed counts)."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, size, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n = BUCKETS // SLICES
            part = np.frombuffer(_ZSTD.decompress(packed, n * size, asbytes=True), f"<u{size}").astype(np.int64)
            sums[i] = sums[i] + part if i in sums else part
    yield pa.RecordBatch.from_pydict({"slice": pa.array(list(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})


class _Order:
    """The order of words: place of each bucket by its count, and from which place on buckets are met at all or frequent."""

    def __init__(self, parts: list, frequent: int):
        counts = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
        for r in parts:
            counts[r["slice"]] = np.frombuffer(r["counts"], np.int64)
        counts = counts.reshape(-1)
        order = np.argsort(counts, kind="stable")
        self.ranks = np.empty(BUCKETS, np.uint32)
        self.ranks[order] = np.arange(BUCKETS, dtype=np.uint32)
        met, often = np.searchsorted(counts[order], [1, frequent], side="right").tolist()
        self.met, self.frequent = np.uint64(met), np.uint64(often)
        self.words = int(counts.sum())


def prefix_length(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Words of which two similar sets must share one; 0 for sets too small to be similar to any other."""
    length = sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1
    return np.where(sizes >= threshold * (sizes + 1) - 1e-9, length, 0)


_COLUMNS = ("code", "doc", "line", "size", "place", "check", "sig", "sig1", "sig2", "sig3")
#: Columns that lines up to so many words don't have: zeros there.
_LONG_ONLY = {"sig1": MORE_PARITIES[0], "sig2": MORE_PARITIES[1], "sig3": MORE_PARITIES[1]}
_HEAD = struct.Struct(f"<Iq{len(_COLUMNS)}B")
_CODE_BITS = np.uint64(48)


def parities(words: np.ndarray, distinct: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Parities of each set's words in 256 slots, folded to 64 (sig), and what longer lines need to unfold them.

    With s0 to s3 the four words of 64 slots: sig is the XOR of all, sig1 = s1 ^ s3, sig2 = s2, sig3 = s3; 128 slots are
    (sig ^ sig1, sig1).
    """
    slots = words >> np.uint64(56)
    bits = np.where(distinct, np.uint64(1) << (slots & np.uint64(63)), np.uint64(0))
    folds = [np.bitwise_xor.reduce(np.where(slots >> np.uint64(6) == np.uint64(k), bits, np.uint64(0)), axis=1) for k in range(4)]
    out = {"sig": folds[0] ^ folds[1] ^ folds[2] ^ folds[3], "sig1": folds[1] ^ folds[3], "sig2": folds[2], "sig3": folds[3]}
    return {c: np.where(sizes > _LONG_ONLY[c], v, np.uint64(0)) if c in _LONG_ONLY else v for c, v in out.items()}


def pack(rows: dict[str, np.ndarray]) -> bytes:
    """Columns of a block in as few bytes a number as each needs; codes must rise, and go as differences."""
    n, low = len(rows["code"]), int(rows["doc"].min())
    plain = rows | {"code": np.diff(rows["code"], prepend=np.uint64(0)), "doc": rows["doc"].view(np.uint64) - np.int64(low).view(np.uint64)}
    plain |= {c: rows[c][rows["size"] > least] for c, least in _LONG_ONLY.items()}
    small = [plain[c].astype(np.min_scalar_type(int(plain[c].max(initial=0)))) for c in _COLUMNS]
    return b"".join([_HEAD.pack(n, low, *(c.itemsize for c in small)), *(c.tobytes() for c in small)])


def unpack(data: bytes) -> dict[str, np.ndarray]:
    n, low, *sizes = _HEAD.unpack_from(data)
    at, rows = _HEAD.size, {}
    for name, size in zip(_COLUMNS, sizes, strict=True):
        held = np.flatnonzero(rows["size"] > np.uint64(_LONG_ONLY[name])) if name in _LONG_ONLY else np.arange(n)
        rows[name] = np.zeros(n, np.uint64)
        rows[name][held] = np.frombuffer(data, f"<u{size}", len(held), at)
        at += len(held) * size
    rows["code"] = np.cumsum(rows["code"], dtype=np.uint64)
    rows["doc"] = (rows["doc"] + np.int64(low).view(np.uint64)).view(np.int64)
    for name in ("line", "size", "place"):
        rows[name] = rows[name].astype(np.int64)
    return rows


def _prefix_rows(found: _Lines, order: _Order, threshold: float, docs: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """Prefix words of all lines: key, and what the filters need of the line.

    Words in a bucket without another occurrence meet nothing and are left out.
    """
    for mine, words, distinct in found.rows():
        k1, _, size = _keys(words, distinct)
        parity = parities(words, distinct, size)
        ranked = (order.ranks[(words & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(44)) | (words >> np.uint64(20))
        ranked = np.sort(np.where(distinct, ranked, _NONE), axis=1)
        taken = prefix_length(size, threshold)
        width = int(taken.max(initial=0))
        if not width:
            continue
        rank = ranked[:, :width] >> np.uint64(44)
        inside = np.arange(width) < taken[:, None]
        which, place = np.nonzero(inside & (rank >= order.met) & (rank < order.frequent))
        code = _mixed(ranked[which, place], _ODD[3])
        often, begin = np.nonzero(inside & (rank >= order.frequent))
        if len(often):  # pairs of a frequent word at ``begin`` and each word after it, up to one past the prefix
            many = taken[often] - begin
            after = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1
            often, begin = np.repeat(often, many), np.repeat(begin, many)
            pair = _mixed(_mixed(ranked[often, begin], _ODD[1]) + ranked[often, begin + after], _ODD[3])
            code, which, place = np.append(code, pair), np.append(which, often), np.append(place, begin + after - 1)
        lines = mine[which]
        yield {
            "code": code >> (np.uint64(64) - _CODE_BITS),
            "doc": docs[found.text[lines]],
            "line": found.number[lines].astype(np.int64),
            "size": size[which].astype(np.int64),
            "place": place.astype(np.int64),
            "check": k1.view(np.uint64)[which] & np.uint64(0xFFFFFFFF),
            **{c: v[which] for c, v in parity.items()},
        }


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) for c in _COLUMNS} if parts else {}


def _in_order(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Rows by key, then place in the corpus; of equal sets of one key only the first."""
    if not len(rows["code"]):
        return rows
    at = np.lexsort((rows["line"], rows["doc"]))
    at = at[np.argsort(rows["code"][at], kind="stable")]
    same = _mixed(_mixed(rows["code"], _ODD[0]) ^ rows["sig"], _ODD[1]) + (rows["check"] | (rows["size"].astype(np.uint64) << np.uint64(32))) * _ODD[3]
    first = np.sort(np.unique(same[at], return_index=True)[1])
    return {c: rows[c][at[first]] for c in _COLUMNS}


def _prefixes(batches: Iterator[pa.RecordBatch], order: _Order, parts: int, threshold: float, seed: int) -> Iterator[pa.RecordBatch]:
    """(part, rows): the prefix words of whole blocks of lines, dealt by key."""
    held: list[dict[str, np.ndarray]] = []
    waiting = 0

    def flush() -> pa.RecordBatch:
        rows = _in_order(_joined(held))
        part = (rows["code"].astype(np.float64) * (parts / 2.0 ** float(_CODE_BITS))).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
        packed = [pack({c: v[a:b] for c, v in rows.items()}) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_pydict({"part": pa.array(part[cuts[:-1]], pa.int64()), "rows": pa.array(packed, pa.binary())})

    for batch, texts in _slices(batches, 1):
        docs = batch.column(0).fill_null(_FIRST).to_numpy(zero_copy_only=False)
        for rows in _prefix_rows(_Lines(texts, seed), order, threshold, docs):
            if len(rows["code"]):
                held.append(rows)
                waiting += len(rows["code"])
            if waiting > BLOCK_WORDS:
                yield flush()
                held.clear()
                waiting = 0
    if waiting:
        yield flush()
    held.clear()
    give_back()


class _Groups:
    """Groups of one key, in the order of :func:`_in_order`, and the filters on pairs of rows."""

    def __init__(self, rows: dict[str, np.ndarray], threshold: float):
        code = rows["code"]
        starts = np.flatnonzero(np.diff(code, prepend=code[:1] ^ np.uint64(1)))
        lengths = np.diff(np.append(starts, len(code)))
        keep = np.repeat(lengths > 1, lengths)
        self.rows = {c: v[keep] for c, v in rows.items()}
        lengths = lengths[lengths > 1]
        self.start = np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.index = np.arange(len(self.start)) - self.start
        self.threshold = threshold

    def pass_filters(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs (row, earlier row) may be similar: length, position, parities."""
        r, t = self.rows, self.threshold
        na, nb = r["size"][a], r["size"][b]
        need = np.ceil((na + nb) * (t / (1 + t)) - 1e-9).astype(np.int64)
        fits = (np.minimum(na, nb) >= np.maximum(na, nb) * t - 1e-9) & (na - r["place"][a] >= need) & (nb - r["place"][b] >= need)
        near = np.flatnonzero(fits)
        apart = na + nb - 2 * need
        near = near[np.bitwise_count(r["sig"][a[near]] ^ r["sig"][b[near]]) <= apart[near]]
        for level, least in enumerate(MORE_PARITIES):
            long = np.minimum(na, nb)[near] > least
            x, y = a[near[long]], b[near[long]]
            diff = {c: r[c][x] ^ r[c][y] for c in ("sig", "sig1", "sig2", "sig3")}
            halves = (diff["sig"] ^ diff["sig1"], diff["sig1"])
            words = halves if not level else (halves[0] ^ diff["sig2"], diff["sig2"], halves[1] ^ diff["sig3"], diff["sig3"])
            far = sum(np.bitwise_count(w).astype(np.int64) for w in words) > apart[near[long]]
            near = np.delete(near, np.flatnonzero(long)[far])
        before = (r["doc"][a[near]] != r["doc"][b[near]]) | (r["line"][a[near]] != r["line"][b[near]])  # rows of one place don't count
        return near[before]

    def every(self, askers: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of each asker with the lines of its group from the ``first``-th up to itself that pass."""
        many = np.maximum(self.index[askers] - first, 0)
        for at in _runs(many, 1 << 20):
            n = many[at]
            a = np.repeat(askers[at], n)
            b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[askers[at]] + first, n)
            kept = self.pass_filters(a, b)
            yield a[kept], b[kept]


def _runs(many: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of ``many`` with a sum of some ``most`` each; a larger number is alone."""
    ends = np.cumsum(many)
    at = 0
    while at < len(many):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield slice(at, to)
        at = to


_PAIRS = "part long, doc long, line int, other_doc long, other_line int, open boolean, rows binary"


def _batch(part: int, rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    columns = [
        pa.array(np.full(n, part)), pa.array(rows["doc"][a]), pa.array(rows["line"][a].astype(np.int32)),
        pa.array(rows["doc"][b]), pa.array(rows["line"][b].astype(np.int32)), pa.array(open_), pa.nulls(n, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PAIRS.split(", ")])


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """Rows of one part after the other; the parts come in order."""
    now, held = None, []
    for batch in batches:
        parts = batch.column(0).to_pylist()
        for row in zip(parts, *(c.to_pylist() for c in batch.columns[1:]), strict=True):
            if row[0] != now and held:
                yield now, held
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield now, held


def _meet(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of each part; open ones have more candidates than given, and the rows of their groups follow."""
    for part, held in _by_part(batches):
        rows = _joined([unpack(blob) for (blob,) in held])
        held.clear()
        groups = _Groups(_in_order(rows), threshold)
        alive = np.arange(len(groups.index))
        crowded: list[np.ndarray] = []
        for rank in range(ASKED):
            alive = alive[groups.index[alive] > rank]
            if not len(alive):
                break
            hit = groups.pass_filters(alive, groups.start[alive] + rank)
            asker = alive[hit]
            more = groups.index[asker] > rank + 1
            crowded.append(np.unique(groups.start[asker[more]]))
            yield _batch(part, groups.rows, asker, groups.start[asker] + rank, more)
            alive = np.delete(alive, hit)
        for a, b in groups.every(alive, ASKED):
            yield _batch(part, groups.rows, a, b, np.zeros(len(a), bool))
        crowd = np.unique(np.concatenate(crowded)) if crowded else np.zeros(0, np.int64)
        if len(crowd):
            inside = np.flatnonzero(np.isin(groups.start, crowd))
            cuts = np.flatnonzero(groups.index[inside] == 0)
            for at in _runs(np.diff(np.append(cuts, len(inside))), 50_000):
                some = inside[cuts[at][0] : cuts[at.stop] if at.stop < len(cuts) else len(inside)]
                blob = pack({c: v[some] for c, v in groups.rows.items()})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part]), *(pa.nulls(1, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_())), pa.array([blob], pa.binary())],
                    names=[c.split()[0] for c in _PAIRS.split(", ")],
                )
    give_back()


def _place_key(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return _mixed(doc.view(np.uint64) + line.astype(np.uint64) * _ODD[0], _ODD[1])


def _meet_rest(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """All candidate pairs of the lines (doc, line) of each part in its rows, which come after them."""
    for part, held in _by_part(batches):
        asking = [(doc, line) for doc, line, blob in held if blob is None]
        wanted = _place_key(*(np.array(c, np.int64) for c in zip(*asking, strict=True))) if asking else np.zeros(0, np.uint64)
        for _, _, blob in held:
            if blob is not None and len(wanted):
                groups = _Groups(unpack(blob), threshold)
                askers = np.flatnonzero(np.isin(_place_key(groups.rows["doc"], groups.rows["line"]), wanted))
                for a, b in groups.every(askers, 0):
                    yield _batch(part, groups.rows, a, b, np.zeros(len(a), bool))
    give_back()


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, line, body) of the wanted lines of each text."""
    for batch in batches:
        docs, numbers, bodies = [], [], []
        for doc, text, lines in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            split = (text or b"").split(b"\n")
            lines = [n for n in lines if n < len(split)]
            docs += [doc] * len(lines)
            numbers += lines
            bodies += [split[n] for n in lines]
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), pa.array(bodies, pa.binary())], names=["doc", "line", "body"])


def _similar(batches: Iterator[pa.RecordBatch], threshold: float, seed: int) -> Iterator[pa.RecordBatch]:
    """(doc, line, k1, k2) of the lines that are similar to the other line beside them, word by word."""
    for batch in batches:
        kept = []
        mine, others = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for i, (x, y) in enumerate(zip(mine, others, strict=True)):
            a, b = set(x.lower().split()), set(y.lower().split())
            shared = len(a & b)
            if shared >= threshold * (len(a) + len(b) - shared) - 1e-9 and shared:
                kept.append(i)
        found = _Lines([mine[i] for i in kept], seed)  # a line is a text here
        for at, words, distinct in found.rows():
            k1, k2, _ = _keys(words, distinct)
            rows = pa.array(np.array(kept, np.int64)[found.text[at]])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(k1), pa.array(k2)], names=["doc", "line", "k1", "k2"])


def _if_small(table: DataFrame, size: int) -> DataFrame:
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def line_flags(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, frequent: int = FREQUENT
) -> tuple[DataFrame, DataFrame]:
    """(removed, documents): the lines to remove as (doc, hash, line), and one row (doc, hash, n_lines) per row of ``docs``.

    hash is the XXH64 of the text and tells rows of one id apart; lines at one place of rows that share an id don't remove
    each other, so rows that repeat id and text are treated alike.  Rows with a null id (or the least long) come first.
    Null and empty texts and blank lines have no lines; an empty table gives empty tables.  Equal sets of words are told by
    128 bits of hashes under a seed of the run's own, similar ones are compared word by word.
    """
    spark = docs.sparkSession
    ship(spark)
    seed = secrets.randbits(63)
    body = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(body).alias("hash"), body.alias("body"))
    scanned = store(texts.mapInArrow(lambda batches: _scan(batches, seed), _SCAN), "lines")
    lines, slices = scanned.filter("kind = 0"), scanned.filter("kind = 2").select(F.col("line").alias("slice"), "k1", "counts")
    order = _Order(slices.repartition("slice").mapInArrow(_added, "slice int, counts binary").collect(), frequent)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), order.words // (4 * PART_WORDS))
    known = spark.sparkContext.broadcast(order)
    placed = F.coalesce("doc", F.lit(_FIRST)).alias("doc")
    blocks = texts.select("doc", "body").mapInArrow(lambda batches: _prefixes(batches, known.value, parts, threshold, seed), "part long, rows binary")
    blocks = blocks.repartition("part").sortWithinPartitions("part")
    met = store(blocks.mapInArrow(lambda batches: _meet(batches, threshold), _PAIRS), "met")

    def verified(pairs: DataFrame) -> DataFrame:
        """(doc, line, k1, k2) of the lines of ``pairs``, a stored table, for which some other line is similar."""
        ends = pairs.select("doc", "line").union(pairs.select("other_doc", "other_line"))
        wanted = store(ends.groupBy(F.col("doc").alias("of_doc")).agg(F.collect_set("line").alias("wanted")), "wanted")
        size = wanted.agg(F.sum(32 + 4 * F.size("wanted"))).first()[0] or 0
        found = texts.select(placed, "body").join(_if_small(wanted, size), F.col("doc") == F.col("of_doc")).select("doc", "body", "wanted")
        found = store(found.mapInArrow(_fetch, "doc long, line int, body binary").distinct(), "bodies")
        both = pairs.join(found.withColumnRenamed("body", "x"), ["doc", "line"]).join(found.toDF("other_doc", "other_line", "y"), ["other_doc", "other_line"])
        alike = both.select("doc", "line", "x", "y").mapInArrow(lambda batches: _similar(batches, threshold, seed), "doc long, line int, k1 long, k2 long")
        done = store(alike.distinct(), "similar")
        discard(wanted, found)
        return done

    ends = ["doc", "line", "other_doc", "other_line"]
    pairs = store(met.filter("rows is null").select(*ends).distinct(), "pairs")
    similar = verified(pairs)
    # lines that stopped at candidates which all fail: the rest of those groups
    stopped = met.filter("open").select("part", "doc", "line").distinct().join(similar.select("doc", "line"), ["doc", "line"], "left_anti")
    stopped = store(stopped.select("part", "doc", "line", F.lit(None).cast("binary").alias("rows")), "stopped")
    if not stopped.isEmpty():
        asked = stopped.union(met.filter("rows is not null").join(stopped.select("part").distinct(), "part", "left_semi").select(*stopped.columns))
        asked = asked.repartition("part").sortWithinPartitions("part", F.col("rows").isNotNull())
        rest = asked.select("part", "doc", "line", "rows").mapInArrow(lambda batches: _meet_rest(batches, threshold), _PAIRS)
        rest = store(rest.select(*ends).distinct().join(pairs, ends, "left_anti"), "rest")
        similar = store(similar.union(verified(rest)).distinct(), "similar")
        discard(rest)
    discard(met, pairs, stopped)

    least, most, longest = (x or 0 for x in lines.agg(F.min("doc"), F.max("doc"), F.max("line")).first())
    small = least > -(1 << 41) and most < 1 << 41 and longest < 1 << 20

    def place_of(doc: Column, line: Column) -> Column:
        """A line's place in the corpus, null ids first: one number where ids and lines are small, else a pair."""
        if small:
            return F.greatest(F.coalesce(doc, F.lit(_FIRST)), F.lit(-(1 << 41))) * F.lit(1 << 20) + line
        return F.struct(F.coalesce(doc, F.lit(_FIRST)).alias("doc"), line.alias("line"))

    at = place_of(F.col("doc"), F.col("line"))
    classes = lines.groupBy("k1", "k2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    ends_of = similar.select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), at.alias("held"))
    ends_of = _if_small(ends_of, 32 * ends_of.count())
    limits = classes.join(ends_of, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")) & (F.col("first") == F.col("held")), "left")
    limits = store(limits.filter(F.col("held").isNotNull() | (F.col("first") < F.col("last"))).select("k1", "k2", "first", F.col("held").isNotNull().alias("held")), "limits")
    removed = lines.join(_if_small(limits, 40 * limits.count()), ["k1", "k2"]).filter(F.col("held") | (at > F.col("first"))).select("doc", "hash", "line")
    return removed, scanned.filter("kind = 1").select("doc", "hash", F.col("line").cast("long").alias("n_lines"))


def _removed(lines: DataFrame) -> DataFrame:
    return lines.groupBy("doc", "hash").agg(F.array_sort(F.collect_set("line")).alias("removed_lines"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_lines, removed_lines) of every row of ``docs``: its lines with words, and those removed by number from 0."""
    removed, every = line_flags(docs, id_col, text_col, threshold)
    mine = _removed(removed).withColumnsRenamed({"doc": "of_doc", "hash": "of_hash"})
    return every.join(mine, F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_hash")), "left").select(
        F.col("doc").alias(id_col), "n_lines", F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with its texts rid of the removed lines; all else as it is, null texts stay null."""
    removed, _ = line_flags(docs, id_col, text_col, threshold)
    gone = _removed(removed).select(F.col("doc").alias("__cf_doc"), F.col("hash").alias("__cf_hash"), F.col("removed_lines").alias("__cf_gone"))
    body = F.col(f"`{text_col}`").cast("string")
    joined = docs.join(gone, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__cf_doc")) & (F.xxhash64(body) == F.col("__cf_hash")), "left")
    kept: Column = F.array_join(F.filter(F.split(body, "\n"), lambda _, i: ~F.array_contains("__cf_gone", i)), "\n")
    text = F.when(F.col("__cf_gone").isNull(), body).otherwise(kept)
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return report.select(
        "doc_id",
        "n_lines",
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.crc32(F.array_join(F.col("removed_lines").cast("array<string>"), ",").cast("binary")).alias("removed_crc32"),
    )


__all__ = ["dedup_lines", "line_flags", "line_report", "op10_line_dedup", "prefix_length"]
