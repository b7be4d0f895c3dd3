"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Texts are compared as UTF-8 bytes with A-Z folded and every run of ASCII characters that are neither
letters nor digits read as one space. A document is contaminated by an item when some
stretch of it is within k edits of the whole item, k = min(rate * length, what the lemma
still sees) (:func:`budget`).

1. *Hits*: every q-gram of the document that an item also has, from a bit table of the
   items' q-gram hashes first and the sorted hashes next.
2. *Diagonal bands*: an alignment with k edits stays within k + 1 neighbouring diagonals
   (document position less item position), so it lies whole in one of the bands of 2 (k + 1)
   diagonals that overlap by half. By the q-gram lemma it shares at least
   ``m - q + 1 - k q`` q-grams with the item; bands with fewer distinct item positions go.
3. *Verification*: banded alignment of the item against the region of each remaining band; a
   verbatim copy needs no alignment.

Documents are read once for each block of the benchmark; a block holds about
``ITEM_BYTES`` of items, which bounds what is collected and broadcast at a time. Nothing is shuffled,
and a passage that a third of all documents holds costs its own documents only.

Defined cases: null or empty texts have no hits; items that are null or shorter than ``q`` after
folding cannot be told from chance and are left out; equal items are reported each; repeated rows
are reported each; a stretch is reported once for each item and place; very long texts are read
whole, in pieces that end with a document; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._tables import blocks

Q, RATE, SEEN = 10, 0.08, 0.15
ITEM_BYTES, BLOCK_BYTES, BITS = 8 << 20, 4 << 20, 24
_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 32


def folded(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, row offsets, position of each folded byte in ``data``)."""
    x = _FOLD[data]
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    starts = off[:-1][off[:-1] < len(x)]
    keep[starts] = True
    at = np.flatnonzero(keep)
    return x[at], np.searchsorted(at, off), at


def grams(x: np.ndarray, q: int) -> np.ndarray:
    """Hash of every q consecutive bytes."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    sums = np.zeros(len(x) + 1, dtype=_U)
    np.cumsum(W._EXACT[x] * W._power(W._P, len(x)), out=sums[1:])
    return W.mix((sums[q:] - sums[:n]) * W._power(pow(W._P, -1, 1 << 64), n))


def budget(m: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed to an item of m characters: as the rate says, while a share ``SEEN`` of m q-grams must stay."""
    return max(0, min(int(rate * m), int((m - q + 1 - SEEN * m) // q)))


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        self.q, self.ids, self.items, self.k = q, [], [], []
        for key, text in items:
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            x, _, _ = folded(raw, np.array([0, len(raw)]))
            x = np.frombuffer(x.tobytes().strip(b" "), dtype=np.uint8)
            if len(x) >= q:
                self.ids.append(key)
                self.items.append(x)
                self.k.append(budget(len(x), q, rate))
        all_ = [grams(x, q) for x in self.items]
        h = np.concatenate(all_) if all_ else np.zeros(0, _U)
        item = np.repeat(np.arange(len(all_)), [len(g) for g in all_])
        pos = np.concatenate([np.arange(len(g)) for g in all_]) if all_ else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.pos = h[order], item[order], pos[order]
        self.table = np.zeros(1 << BITS, dtype=bool)
        self.table[(self.hash >> _U(64 - BITS)).astype(np.int64)] = True
        self.m = np.array([len(x) for x in self.items], dtype=np.int64)
        self.k = np.array(self.k, dtype=np.int64)
        self.least = self.m - q + 1 - self.k * q

    def regions(self, x: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, first diagonal) of the bands that pass the lemma; diagonals count from the piece's start."""
        g = grams(x, self.q)
        at = np.flatnonzero(self.table[(g >> _U(64 - BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(self.hash, g[at], side="left"), np.searchsorted(self.hash, g[at], side="right")
        row = np.searchsorted(off, at, side="right") - 1
        fine = (hi > lo) & (at + self.q <= off[row + 1])  # a q-gram of one document
        at, lo, hi, row = at[fine], lo[fine], hi[fine], row[fine]
        n = hi - lo
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(n) else lo
        item, pos = self.item[entry], self.pos[entry]
        step = self.k[item] + 1
        band = (np.repeat(at, n) - pos) // step
        item, pos, row, band = (np.concatenate([v, w]) for v, w in ((item, item), (pos, pos), (np.repeat(row, n),) * 2, (band, band - 1)))
        order = np.lexsort((pos, band, item, row))
        item, pos, row, band = item[order], pos[order], row[order], band[order]
        new = np.ones(len(item), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (band[1:] != band[:-1])
        once = new.copy()
        once[1:] |= pos[1:] != pos[:-1]
        start = np.flatnonzero(new)
        if not len(start):
            return []
        count = np.add.reduceat(once.astype(np.int64), start)
        ok = start[count >= self.least[item[start]]]
        return list(zip(row[ok].tolist(), item[ok].tolist(), (band[ok] * (self.k[item[ok]] + 1)).tolist(), strict=True))


def banded(item: np.ndarray, x: np.ndarray, low: int, high: int, anchored: bool = False) -> np.ndarray:
    """Edits of ``item`` against stretches of ``x`` along the diagonals low..high, by where they end.

    Entry i is the distance of the best stretch that ends before ``x[len(item) + low + i]``;
    stretches start anywhere, or at 0 if ``anchored``.
    """
    width, m = high - low + 1, len(item)
    far = m + width + 1
    left, right = max(0, -low), max(0, m + high - len(x))
    padded = np.concatenate([np.full(left, 255, np.uint8), x, np.full(right, 255, np.uint8)])
    index = np.arange(width)
    row = np.where(index + low == 0, 0, far) if anchored else np.where((index + low >= 0) & (index + low <= len(x)), 0, far)
    if anchored:
        row = np.minimum(row, np.where(index + low >= 0, index + low, far))
    for i in range(m):
        at = i + low + left
        step = row + (padded[at:at + width] != item[i])
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - index) + index
    return row


def align(item: np.ndarray, x: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best stretch of ``x`` for ``item`` near the diagonals low..high, if within k edits."""
    lo, hi = max(0, low), min(len(x), high + len(item) + k)
    at = x[lo:hi].tobytes().find(item.tobytes())
    if at >= 0:
        return lo + at, lo + at + len(item), 0
    low, high = low - k, high + k
    row = banded(item, x, low, high)
    ends = len(item) + low + np.arange(len(row))
    row = np.where((ends >= 0) & (ends <= len(x)), row, len(item) + 1)
    best = int(row.argmin())
    edits, end = int(row[best]), int(ends[best])
    if edits > k:
        return None
    back = banded(item[::-1], x[:end][::-1], -k, k, anchored=True)
    length = len(item) - k + np.arange(len(back))
    fits = np.flatnonzero((back <= edits) & (length >= 0) & (length <= end))
    return end - int(length[fits[0]]), end, edits


def _leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The columns of :func:`leaks` and ``_hash``, the hash of the document's text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(total) // item_bytes))
    schema = pa.schema([("doc", pa.int64()), ("hash", pa.int64()), ("item", pa.int64()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])

    def search(index):
        def run(batches):
            ix = index.value
            for b in blocks(batches, "text", BLOCK_BYTES):
                data, off = W.buffers(b.column(b.schema.get_field_index("text")))
                found = []
                for lo, hi in W.pieces(off) if ix.items else ():
                    x, at, place = folded(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                    seen = set()
                    for row, item, diagonal in ix.regions(x, at):
                        a, e = int(at[row]), int(at[row + 1])
                        k = int(ix.k[item])
                        hit = align(ix.items[item], x[a:e], diagonal - a, diagonal - a + 2 * k + 1, k)
                        if hit and (row, item, hit[1]) not in seen:
                            seen.add((row, item, hit[1]))
                            begin = int(off[lo + row] - off[lo])
                            last = int(place[a + hit[1] - 1]) + 1 if hit[1] > hit[0] else int(place[a + hit[0]])
                            found.append((lo + row, ix.ids[item], hit[2], int(place[a + hit[0]]) - begin, last - begin))
                if found:
                    r, i, d, s, e = zip(*found, strict=True)
                    doc, text_hash = (b.column(b.schema.get_field_index(c)).take(pa.array(r)) for c in ("doc", "hash"))
                    yield pa.record_batch([doc, text_hash, pa.array(i, pa.int64()), pa.array(d, pa.int32()), pa.array(s, pa.int64()),
                                           pa.array(e, pa.int64())], schema=schema)

        return run

    out = None
    for n in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == n) if n_blocks > 1 else items
        index = Index([(r["item"], r["text"]) for r in mine.orderBy("item", "text").collect()], q, rate)
        part = rows.mapInArrow(search(spark.sparkContext.broadcast(index)), "doc long, hash long, item long, edits int, start long, end long")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("doc").alias(key), F.col("item").alias(item_key), "edits", "start", "end", F.col("hash").alias("_hash"))


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(key, item_key, edits, start, end) of every contaminated stretch; start and end are bytes of the UTF-8 text.

    ``options`` are those of :func:`_leaks`: q, rate, key, text, item_key, item_text, item_bytes.
    """
    return _leaks(docs, benchmark, **options).drop("_hash")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    A document is known by its key and its text, so documents with a null or repeated key go
    only if they hold an item themselves.
    """
    bad = _leaks(docs, benchmark, key=key, text=text, **options).select(F.col(key).alias("_bad"), "_hash").distinct()
    same = docs[key].eqNullSafe(bad["_bad"]) & (F.xxhash64(docs[text]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
