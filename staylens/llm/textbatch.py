"""Vectorised words of an Arrow batch of texts.

A word is a maximal run of the characters ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after lower-casing A-Z: ASCII digits and letters and every code point above
127.  In UTF-8 that is a property of single bytes, so one table look-up per
byte finds the words of a whole batch without a loop over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.zeros(256, dtype=np.uint8)  # the lower-cased byte, 0 outside words
for _b in range(256):
    if 0x30 <= _b <= 0x39 or 0x61 <= _b <= 0x7A or _b >= 0x80:
        _LOWER[_b] = _b
    elif 0x41 <= _b <= 0x5A:
        _LOWER[_b] = _b + 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Powers for windows of up to 63 words.
_POWERS = np.array([pow(int(_BASE), i, 1 << 64) for i in range(64)], dtype=np.uint64)
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]]
    return raw, at - at[0]


@dataclass
class Words:
    """Words of a batch in text order: byte spans, hashes, and each row's slice."""

    raw: np.ndarray        # bytes of all rows
    rows: np.ndarray       # byte offset of each row, one more than rows
    start: np.ndarray      # byte offset of each word
    end: np.ndarray
    hash: np.ndarray       # uint64 of each lower-cased word
    first: np.ndarray      # index of each row's first word, one more than rows

    def text(self, k: int) -> bytes:
        return _LOWER[self.raw[self.start[k]:self.end[k]]].tobytes()


def words_of(column: pa.Array) -> Words:
    raw, rows = text_bytes(column)
    low = _LOWER[raw]
    inside = low != 0
    n = len(raw)
    edge = np.empty(n + 1, dtype=bool)
    edge[0] = n > 0 and inside[0]
    edge[n] = False
    cut = rows[(rows > 0) & (rows < n)]
    if n:
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[cut] = inside[cut]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:]
        stop[cut - 1] = inside[cut - 1]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    else:
        start = end = np.zeros(0, np.int64)
    return Words(raw, rows, start, end, _hash_words(low, start, end),
                 np.searchsorted(start, rows).astype(np.int64))


def _hash_words(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span, eight bytes a round; later rounds hold only the longer words."""
    out = np.zeros(len(start), dtype=np.uint64)
    if not len(start):
        return out
    # Byte i of the view is the 64-bit value of bytes i to i+7.
    wide = np.ndarray(len(low) + 1, dtype="<u8", strides=(1,),
                      buffer=np.concatenate([low, np.zeros(8, np.uint8)]))
    length = end - start
    live, at, left = slice(None), start, length
    while True:
        value = wide[at] & _MASK[np.minimum(left, 8)]
        out[live] = mix64(out[live] * _BASE + value + np.uint64(1))
        more = np.flatnonzero(left > 8)
        if not len(more):
            return mix64(out + length.astype(np.uint64))
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's windows of ``size`` words, and each row's slice of them.

    A row with fewer words, but at least one, has one window of all of them.
    """
    count = np.diff(words.first)
    n = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    slot = np.concatenate([[0], np.cumsum(n)])
    rolled = np.zeros(max(0, len(words.hash) - size + 1), dtype=np.uint64)
    for j in range(size):
        rolled += words.hash[j:j + len(rolled)] * _POWERS[size - j]
    out = np.zeros(slot[-1], dtype=np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    place = words.first[row] + (np.arange(len(out)) - slot[row])
    full = count[row] >= size
    out[full] = rolled[place[full]]
    for r in np.flatnonzero((count > 0) & (count < size)):
        own = words.hash[words.first[r]:words.first[r + 1]]
        out[slot[r]] = (own * _POWERS[1:len(own) + 1][::-1]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix64(out), slot
