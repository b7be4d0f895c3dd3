"""Words of whole texts as numpy arrays: spans, 64-bit hashes and k-word hashes.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``. These bytes never
occur inside a UTF-8 sequence, so spans found on bytes are spans of the text. All
functions work on one Arrow batch inside a task; :func:`pieces` keeps the arrays that are
alive at a time near ``PIECE_BYTES`` times a small constant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (in place)."""
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _byte_table(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
    if lower:
        t[65:91] = t[97:123]
    return t


_EXACT, _LOWER = _byte_table(False), _byte_table(True)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 4096), base, dtype=_U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty row."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    offsets = offsets.astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row has a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words and, per row, its first word's index.

    ``gaps``: a table of the bytes that are in no word; only ASCII bytes may be in it.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~gaps[data]
    edge = np.empty(n + 1, dtype=bool)
    edge[0], edge[n] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:n])
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < n)])
    cut = cut[word[cut] & word[cut - 1]]
    if len(cut):  # a row ends and the next one begins inside a run of word bytes
        at = np.sort(np.concatenate([np.flatnonzero(edge), cut, cut]))
    else:
        at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    ``lower`` folds A-Z only. Bytes are read in stretches of about ``PIECE_BYTES`` cut
    between words, so that memory does not follow the longest text.
    """
    table, out, i, n = (_LOWER if lower else _EXACT), np.empty(len(starts), dtype=_U), 0, len(starts)
    inverse = pow(_P, -1, 1 << 64)
    while i < n:
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + PIECE_BYTES, side="right")))
        b = int(ends[j - 1])
        sums = np.empty(b - a + 1, dtype=_U)
        sums[0] = 0
        np.multiply(table[data[a:b]], _power(_P, b - a), out=sums[1:])
        np.cumsum(sums, out=sums)
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * _power(inverse, b - a)[s]
        i = j
    return mix(out)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive entries of ``words`` (row ends are the caller's matter)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out, step = words[:n].copy(), 1
    for j in range(1, k):
        step = step * 0xDA942042E4DD58B5 & _MASK
        out += words[j:j + n] * _U(step)
    return mix(out)
