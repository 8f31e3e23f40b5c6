"""Vectorised word and byte helpers for the tasks of this subpackage.

All functions work on one Arrow column at a time (a record batch inside a
task); nothing here knows about Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3 * 2 + 1  # odd, so that it has an inverse modulo 2**64
_BLOCK = 1 << 16

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (a finaliser of multiply and xor-shift steps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


_POW = _powers(_BASE, _BLOCK + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), _BLOCK + 1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty. offsets has one entry more than rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                          else b"").cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), equal for equal bytes; spans of any length.

    A polynomial over mixed byte codes from running sums; the sums start anew
    every 64 KB and a longer or crossing span adds its parts up.
    """
    out = np.zeros(len(start), np.uint64)
    if not len(start):
        return out
    n = len(data)
    with np.errstate(over="ignore"):
        blocks = -(-n // _BLOCK)
        sums = np.zeros(n + blocks, np.uint64)  # for each block: 0, then its running sums
        for b in range(blocks):
            lo, hi = b * _BLOCK, min(n, (b + 1) * _BLOCK)
            np.cumsum(_BYTE_CODE[data[lo:hi]] * _POW[:hi - lo], out=sums[lo + b + 1:hi + b + 1])
        at, done = start.astype(np.int64), np.zeros(len(start), np.int64)
        left = np.flatnonzero(end > start)
        while len(left):
            s = at[left]
            b = s // _BLOCK
            e = np.minimum(end[left], (b + 1) * _BLOCK)
            part = (sums[e + b] - sums[s + b]) * _INV[s - b * _BLOCK]
            out[left] += part * _power_at(done[left])
            done[left] += e - s
            at[left] = e
            left = left[e < end[left]]
        out = mix(out ^ (end - start).astype(np.uint64) * _MUL)
    return out


def _power_at(k: np.ndarray) -> np.ndarray:
    """_BASE ** k modulo 2**64 for any k."""
    out = _POW[k % _BLOCK]
    high = k // _BLOCK
    if high.any():
        big = pow(_BASE, _BLOCK, 1 << 64)
        out = out * np.array([pow(big, int(h), 1 << 64) for h in high], np.uint64)
    return out


_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As ``span_hashes``, but fast for many short spans: eight bytes of all words at a time."""
    length = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        h = length.astype(np.uint64) * _MUL
        at, own = start, slice(None)
        for j in range(32):
            x = eight[at] & _MASK[np.minimum(length[own] - 8 * j, 8)]
            y = (h[own] ^ x) * np.uint64(0xD6E8FEB86659FD93)
            h[own] = y ^ (y >> np.uint64(32))
            own = np.flatnonzero(length > 8 * (j + 1)) if j == 0 else own[length[own] > 8 * (j + 1)]
            if not len(own):
                break
            at = start[own] + 8 * (j + 1)
        else:
            h[own] = span_hashes(data, start[own], end[own])
        return mix(h)


class Words:
    """Words of a column: lower case, maximal runs of ASCII letters, digits and non-ASCII characters.

    ``start``/``end`` are byte positions in ``data`` (lower-cased texts, one
    after the other), ``row`` the row of each word, ``first`` the index of
    each row's first word (one entry more than rows), ``hash`` 64 bits each.
    """

    def __init__(self, column: pa.Array, lower: bool = True):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        self.data, self.offsets = utf8(pc.utf8_lower(column.cast(pa.large_string())) if lower else column)
        n = len(self.data)
        word = _WORD_BYTE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[0] = n > 0 and word[0]
        if n:
            edge[1:n] = word[1:] != word[:-1]
            edge[n] = word[n - 1]
            cut = self.offsets[1:-1]
            cut = cut[(cut > 0) & (cut < n)]
            both = cut[word[cut] & word[cut - 1]]  # a word on either side of a row's end
        else:
            both = np.zeros(0, np.int64)
        at = np.flatnonzero(edge)
        if len(both):
            at = np.sort(np.concatenate([at, np.unique(both), np.unique(both)]))
        self.start, self.end = at[0::2], at[1::2]
        self.first = np.searchsorted(self.start, self.offsets)
        self.row = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))
        self.hash = word_hashes(self.data, self.start, self.end)

    def text(self, i: int) -> str:
        return bytes(self.data[self.start[i]:self.end[i]]).decode("utf-8", "replace")


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first) of the runs of k words of each row; a row of 1 to k-1 words has one shingle, its whole."""
    h, n = words.hash, len(words.hash)
    count = np.diff(words.first)
    m = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(m)])
    row = np.repeat(np.arange(len(count)), m)
    pos = words.first[:-1][row] + np.arange(first[-1]) - first[:-1][row]
    with np.errstate(over="ignore"):
        out = np.zeros(len(pos), np.uint64)
        end = words.first[1:][row]
        for j in range(k):
            at = pos + j
            own = at < end
            out = out * _MUL + np.where(own, h[np.minimum(at, max(n - 1, 0))], 0).astype(np.uint64) if n else out
        out = mix(out)
    return out, row, first
