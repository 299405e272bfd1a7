"""Simple-8b word-aligned coding of token ids, in numpy.

A 64-bit word holds a selector in its top four bits and up to 240 values in the other 60.
Values are coded in blocks of ``BLOCK`` values with an offset per block, so all blocks are
packed side by side and any block can be decoded alone.  Selector 15 is the escape: the
next word is one raw 64-bit value, for values that need over 60 bits.
"""

from __future__ import annotations

import numpy as np

BLOCK = 240
#: Values per word and bits per value by selector (fixed values of the coding); selector 15 is the escape.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 1, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 60, 64])
ESCAPE = 15


_SMALL = np.array([n.bit_length() for n in range(1 << 16)], np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return _SMALL[values]
    high = values >> np.uint64(32)
    upper = np.frexp(high.astype(np.float64))[1]  # exact below 2**53
    lower = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, upper + 32, lower).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): 64-bit words, and the first word of each block of ``BLOCK`` values, with the end as last.

    Takes any unsigned integers below 2**64; no values give no words and the offsets [0].
    """
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    padded = np.full(blocks * BLOCK, 255, np.uint8)
    padded[:n] = _bit_lengths(values)
    width = padded.reshape(blocks, BLOCK)
    widest = {1: np.pad(width, ((0, 0), (0, BLOCK)), constant_values=255)}  # widest of the next k values
    k = 1
    while k < BLOCK:
        w = widest[k]
        widest[2 * k] = np.maximum(w, np.pad(w[:, k:], ((0, 0), (0, k)), constant_values=255))
        k *= 2
    choice = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    for s in range(ESCAPE - 1, -1, -1):
        count, base = int(COUNTS[s]), 1 << (int(COUNTS[s]).bit_length() - 1)
        run = np.maximum(widest[base][:, :BLOCK], widest[base][:, count - base : count - base + BLOCK])
        fits = run <= WIDTHS[s]
        if fits.any():
            choice[fits] = s
    flat = choice.reshape(-1)
    first = np.arange(blocks) * BLOCK
    end = np.minimum(first + BLOCK, n)
    at, live, chain = first.copy(), np.arange(blocks), []
    while len(live):  # one word of every block a round: at most BLOCK rounds whatever the size
        chain.append((live, at[live]))
        at[live] += COUNTS[flat[at[live]]]
        live = live[at[live] < end[live]]
    block = np.concatenate([b for b, _ in chain])
    start = np.concatenate([p for _, p in chain])
    start.sort()
    selector = flat[start]
    words_each = 1 + (selector == ESCAPE)
    place = np.cumsum(words_each) - words_each
    words = np.zeros(int(words_each.sum()), np.uint64)
    words[place] = selector.astype(np.uint64) << np.uint64(60)
    for s in range(2, ESCAPE):
        mine = selector == s
        if mine.any():
            gathered = values[start[mine][:, None] + np.arange(COUNTS[s])]
            shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            words[place[mine]] |= np.bitwise_or.reduce(gathered << shifts, axis=1)
    raw = selector == ESCAPE
    words[place[raw] + 1] = values[start[raw]]
    per_block = np.bincount(block, minlength=blocks)
    if raw.any():
        per_block += np.bincount(start[raw] // BLOCK, minlength=blocks)
    return words, np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of ``words``, all words at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == ESCAPE).any():
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(selector == ESCAPE):  # rare: a raw word may look like any selector
            if not raw[i]:
                raw[i + 1] = True
        kept = np.flatnonzero(~raw)
    else:
        kept = np.arange(len(words))
    selector = selector[kept]
    counts = COUNTS[selector]
    start = np.cumsum(counts) - counts
    for s in range(2, ESCAPE):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            out[start[mine][:, None] + np.arange(COUNTS[s])] = (words[kept[mine]][:, None] >> shifts) & np.uint64((1 << int(WIDTHS[s])) - 1)
    mine = np.flatnonzero(selector == ESCAPE)
    out[start[mine]] = words[kept[mine] + 1]
    return out


def decode_block(words: np.ndarray, offsets: np.ndarray, block: int, n: int) -> np.ndarray:
    """One block of the ``n`` values, by its offset."""
    size = min(BLOCK, n - block * BLOCK)
    return decode(words[offsets[block] : offsets[block + 1]], size)
