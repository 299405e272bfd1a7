"""A public tokenizer in the Python workers, and pieces of text it already knows.

The tokenizer file (1.5 MB, a fixed size) is read on the driver and travels in the
closure; workers never open a path.  A worker keeps at most ``KEPT`` known strings and
starts afresh beyond that, so its memory is bounded whatever the corpus holds.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import Counter

import numpy as np
import regex
from tokenizers import Tokenizer

from .wordtable import LONGEST, WordTable

#: Known pre-tokens that one Python worker keeps.
KEPT = 400_000

#: Pre-token pattern of byte-level BPE (a fixed value, as in public_tokenizers.PATTERN).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Up to here the pattern's classes agree between the regex module and the tokenizers library; beyond, the library cuts.
_PLAIN = re.compile("[^\u0000-ɏ‐-‧‰-⁞€]")

_CACHE: dict[str, Vocabulary] = {}


def read_spec(path: str) -> str:
    """The tokenizer file's content, on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def vocabulary(spec: str) -> Vocabulary:
    """The worker's one instance for this tokenizer."""
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Vocabulary(spec)
    return _CACHE[key]


class Vocabulary:
    """Byte-level BPE without normaliser, where pre-tokens are encoded each by itself."""

    def __init__(self, spec: str):
        shape = json.loads(spec)
        pre, model = shape.get("pre_tokenizer") or {}, shape["model"]
        if shape.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model["type"] != "BPE":
            raise ValueError("only byte-level BPE without normaliser or prefix space is supported")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._model = self.tokenizer.model
        self.special = {t["content"]: t["id"] for t in shape.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in shape.get("added_tokens", [])):
            raise ValueError("added tokens that take in neighbouring text are not supported")
        self._split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._words = regex.compile(PATTERN)
        self._pieces: dict[str, int] = {}
        self._table = WordTable(self._word, 1 << 20)
        self._tails: dict[str, bytes] = {}

    def _sections(self, text: str) -> list[str]:
        """Text between special strings, and the special strings themselves at odd places."""
        return self._split_special.split(text) if self._split_special and any(s in text for s in self.special) else [text]

    def _pre_tokens(self, text: str) -> list[str]:
        if _PLAIN.search(text) is None:
            return self._words.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text: pieces of each distinct pre-token, counted once, times its frequency in the text."""
        frequencies, specials = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self._sections(text)
            specials[i] = len(parts) // 2
            seen: Counter = Counter()
            for part in parts[::2]:
                seen.update(self._pre_tokens(part))
            frequencies.append(seen)
        if len(self._pieces) > KEPT:
            self._pieces.clear()
        pieces = self._pieces
        new = list({w for seen in frequencies for w in seen if w not in pieces})
        for at in range(0, len(new), 50_000):
            block = new[at : at + 50_000]
            encoded = self.tokenizer.encode_batch_fast(block, add_special_tokens=False)
            pieces.update(zip(block, map(len, encoded), strict=True))
        for i, seen in enumerate(frequencies):
            if seen:
                n = np.fromiter(map(pieces.__getitem__, seen), np.int64, len(seen))
                specials[i] += int(n @ np.fromiter(seen.values(), np.int64, len(seen)))
        return specials

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text (UTF-8).

        A space before a character that is no white space always starts a pre-token, so texts are cut there; each
        distinct stretch between cuts is encoded once while a worker remembers it, and looked up for all texts together.
        Texts with special strings, with white space after a space or with very long words are encoded whole.
        """
        out: list[np.ndarray | None] = [None] * len(texts)
        data = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        block = np.frombuffer(data, np.uint8)
        spaces = np.flatnonzero(block == 32)
        firsts = (ends - sizes)[sizes > 0]
        word_starts = np.sort(np.concatenate([firsts, spaces + 1]), kind="stable")
        # a space that ends a text gives an empty word at the text's end, which is where the next text's first one starts
        word_ends = np.sort(np.concatenate([ends[sizes > 0], spaces]), kind="stable")
        whole = np.zeros(len(texts), bool)
        doc_of_space = np.searchsorted(ends, spaces, side="right")
        whole[doc_of_space[_blank_after(block, spaces)]] = True
        whole[doc_of_space[spaces + 1 == ends[doc_of_space]]] = True
        special = [s.encode() for s in self.special]
        if any(s in data for s in special):
            whole |= np.fromiter((any(s in t for s in special) for t in texts), bool, len(texts))
        docs = np.searchsorted(ends, word_starts, side="right")
        docs = np.minimum(docs, len(texts) - 1)
        long = word_ends - word_starts > LONGEST
        whole[docs[long]] = True
        good = ~whole[docs]
        word_starts, word_ends, docs = word_starts[good], word_ends[good], docs[good]
        heads = word_starts == (ends - sizes)[docs]
        ids, counts, doubtful = self._table.look_up(data, word_starts, word_ends, heads)
        whole[docs[doubtful]] = True
        stops = np.cumsum(np.bincount(docs, counts, len(texts)).astype(np.int64))
        begun = 0
        for i, stop in enumerate(stops.tolist()):
            out[i] = self._by_sections(texts[i].decode("utf-8", "replace")) if whole[i] else ids[begun:stop]
            begun = stop
        return out

    def _by_sections(self, text: str) -> np.ndarray:
        parts = self._sections(text)
        return np.frombuffer(b"".join(_packed([self.special[p]]) if k % 2 else self._whole(p) for k, p in enumerate(parts)), "<u4")

    def _word(self, word: bytes, head: bool) -> bytes:
        """Ids of a word, with a space before it unless it is a text's first."""
        text = word.decode("utf-8", "replace")
        plain = None if head else _WORD.fullmatch(text)
        if plain is None:
            return self._whole(text if head else " " + text)
        letters, rest = plain.groups()
        mapped = letters if letters.isascii() else "".join(map(_BYTE_SIGNS.__getitem__, letters.encode()))
        ids = _packed([t.id for t in self._model.tokenize(_SPACE + mapped)])
        return ids + self._tail(rest) if rest else ids

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids) if text else b""

    def _tail(self, rest: str) -> bytes:
        if rest not in self._tails:
            if len(self._tails) > 10_000:
                self._tails.clear()
            self._tails[rest] = self._whole(rest)
        return self._tails[rest]


def _blank_after(block: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Which of the spaces have white space after them, by the UTF-8 bytes that follow."""
    padded = np.concatenate([block, np.zeros(3, np.uint8)])
    a, b, c = (padded[spaces + k] for k in (1, 2, 3))
    blank = ((a >= 9) & (a <= 13)) | ((a >= 28) & (a <= 32)) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
    blank |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    blank |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    blank |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    return blank | ((a == 0xE3) & (b == 0x80) & (c == 0x80))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _byte_signs() -> list[str]:
    """The printable sign that byte-level BPE uses for each byte: itself, or the next free one from U+0100."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


_BYTE_SIGNS = _byte_signs()
_SPACE = _BYTE_SIGNS[32]
#: A run of letters (also with accents), then signs that start a pre-token of their own after a letter.
_WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?)\\]}\"%&$*#]*)")
