"""Token ids of words by hash, looked up for a whole block of text at once.

Words are told apart by two 64-bit polynomial hashes with random bases, taken from prefix sums over the block's bytes;
the first finds the slot, the second confirms it.  Words of over ``LONGEST`` bytes are left to the caller.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np

#: Slots of the table, words it holds at most before it starts afresh, and bytes of a word at most.
SLOT_BITS, KEPT, LONGEST = 21, 1_400_000, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hash:
    """Polynomial hash modulo 2**64 of any stretch of a block."""

    def __init__(self, size: int):
        base = random.SystemRandom().getrandbits(64) | 1
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.size = 0
        self.grow(size)

    def grow(self, size: int) -> None:
        if size > self.size:
            self.size = size
            self.powers, self.inverses = _powers(self.base, size), _powers(self.inverse, size)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self.grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.inverses[starts]
        found ^= found >> np.uint64(32)
        found *= _MIX
        return found ^ (found >> np.uint64(29))


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


class WordTable:
    """Ids of words: an open-addressed table of slots over a pool of ids."""

    def __init__(self, find: Callable[[bytes, bool], bytes], block_bytes: int):
        self._find = find
        self._hashes = (_Hash(block_bytes), _Hash(block_bytes))
        self._clear()

    def _clear(self) -> None:
        n = 1 << SLOT_BITS
        self._keys, self._checks = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self._starts, self._counts = np.zeros(n, np.uint32), np.zeros(n, np.uint16)
        self._pool, self._used, self._words = np.zeros(1 << 16, "<u4"), 0, 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or the free slot where the search for it ended."""
        slots = (keys * _MIX >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            held = self._keys[slots[todo]]
            todo = todo[(held != keys[todo]) & (held != 0)]
            slots[todo] = (slots[todo] + 1) & ((1 << SLOT_BITS) - 1)
        return slots

    def _insert(self, keys: np.ndarray, checks: np.ndarray, found: list[bytes]) -> None:
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        while self._used + len(ids) > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros_like(self._pool)])
        self._pool[self._used : self._used + len(ids)] = ids
        starts = self._used + np.cumsum(counts) - counts
        self._used += len(ids)
        self._words += len(keys)
        todo = np.arange(len(keys))
        while len(todo):  # of several keys that end at one free slot one takes it, the others search on
            slots = self._slots(keys[todo])
            _, first = np.unique(slots, return_index=True)
            at, who = slots[first], todo[first]
            self._keys[at], self._checks[at] = keys[who], checks[who]
            self._starts[at], self._counts[at] = starts[who], counts[who]
            todo = np.setdiff1d(todo, who, assume_unique=True)

    def look_up(self, data: bytes, starts: np.ndarray, ends: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, counts, doubtful): the ids of all words one after the other and their number by word.

        ``heads`` are words without a space before them.  Doubtful words share a slot's hash but not its check.
        """
        if self._words > KEPT:
            self._clear()
        block = np.frombuffer(data, np.uint8)
        keys, checks = (h.of(block, starts, ends) for h in self._hashes)
        keys ^= heads.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        keys[keys == 0] = 1
        slots = self._slots(keys)
        missing = np.flatnonzero(self._keys[slots] == 0)
        if len(missing):
            _, first = np.unique(keys[missing], return_index=True)
            new = missing[first]
            find = self._find
            found = [find(data[a:b], h) for a, b, h in zip(starts[new].tolist(), ends[new].tolist(), heads[new].tolist(), strict=True)]
            self._insert(keys[new], checks[new], found)
            slots[missing] = self._slots(keys[missing])
        counts = self._counts[slots].astype(np.int64)
        after = np.cumsum(counts)
        where = np.repeat(self._starts[slots].astype(np.int64) - (after - counts), counts)
        where += np.arange(len(where))
        return self._pool[where], counts, self._checks[slots] != checks
