"""Substring dedup: words covered by a window of ``WINDOW`` words that also starts in an earlier document.

1. *Sketch*. Every window has a content-defined key, the smallest hash of its 8-word shingles; equal
   windows have equal keys, and neighbouring windows mostly share one, so a document adds one
   count for each run of windows with the same key. Partitions build count-min sketches (``ROWS``
   rows of ``2 ** width`` cells) as sparse stripes, and stripes are merged. A window's estimate, the
   least count of its key's cells, is never below the number of places where the window starts. All
   that is needed of the merged sketch is which cells reach 2: ``ROWS * 2 ** width / 8`` bytes, which
   are broadcast. ``width`` follows the bytes of the corpus, from 26 (16 MB) to 29 (128 MB).
2. *Exact pass*. Windows with an estimate of 2 or more go by their 64-bit hash to partitions, where
   the smallest document id of every window is found exactly; the starts in other documents
   are sent back. A block of documents sends each distinct window once, for its smallest
   document, so that a passage that a third of the corpus shares is one entry for each block.
3. *Removal*. Starts become runs, are joined to their documents and the covered words go.

A corpus too large for the widest sketch fills it and lets more windows through to the exact
pass; the result does not change.

Defined cases: null, empty or wordless text: no words, nothing removed, kept text empty; a null
id comes after all ids and is no earlier document for another null; rows with equal ids
never remove words from each other, and a repeated row loses what the row loses; windows are
judged on the input; an empty table stays empty; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._tables import blocks, written

WINDOW, GRAM = 50, 8
ROWS, STRIPE = 2, 20
#: Bounds of the sketch's width, its cells for each expected run, and bytes of words: 6 with their space.
LEAST_WIDTH, MOST_WIDTH, CELLS_PER_RUN, WORD_BYTES = 26, 29, 4, 6
BLOCK_BYTES, BUCKET_BYTES = 12 << 20, 16 << 20
_U = np.uint64
LAST = np.iinfo(np.int64).max


def fitting_width(total: int, window: int = WINDOW) -> int:
    """Width of the sketch for a corpus of ``total`` bytes.

    A run of windows with the same smallest shingle is about (shingles of a window + 1) / 2 words long.
    """
    runs = total / WORD_BYTES * 2 / (window - min(GRAM, window) + 2)
    return min(MOST_WIDTH, max(LEAST_WIDTH, int(np.ceil(np.log2(max(1, CELLS_PER_RUN * runs))))))


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive entries."""
    have, out = 1, x
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = n - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def windows(data: np.ndarray, off: np.ndarray, window: int):
    """(hashes of the words, key of every window, start index of every window, its row, first word of each row)."""
    s, e, first = W.spans(data, off)
    h = W.hashes(data, s, e)
    gram = min(GRAM, window)
    n = np.diff(first)
    if len(h) < window:
        return h, np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64), first
    key = sliding_min(W.shingles(h, gram), window - gram + 1)
    row = np.repeat(np.arange(len(n)), n)
    start = np.flatnonzero((np.arange(len(h)) + window <= first[row + 1])[:len(key)])
    return h, key[start], start, row[start], first


def cells(key: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of every key in each row of the sketch."""
    return [(W.mix(key + _U((r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> _U(64 - width)).astype(np.int64) for r in range(ROWS)]


def _column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


def _partial(window: int, width: int, stripe: int, parts: int, block_bytes: int):
    """Each block's sketch as sparse stripes: cells and their counts (2: two or more)."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % parts
        for b in blocks(batches, "text", block_bytes):
            data, off = W.buffers(_column(b, "text"))
            keys = []
            for lo, hi in W.pieces(off):
                _, key, start, row, _ = windows(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], window)
                if len(key):
                    new = np.ones(len(key), dtype=bool)
                    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
                    keys.append(key[new])
            if not keys:
                continue
            at = np.concatenate([c + (r << width) for r, c in enumerate(cells(np.concatenate(keys), width))])
            at, count = np.unique(at, return_counts=True)
            which, first = np.unique(at >> stripe, return_index=True)
            ends = np.append(first, len(at)).astype(np.int32)
            yield pa.record_batch([
                pa.array(which.astype(np.int32)), pa.array(np.full(len(which), part, dtype=np.int32)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array((at & ((1 << stripe) - 1)).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.minimum(count, 2).astype(np.int8)))],
                names=["stripe", "part", "cell", "count"])

    return run


def _merge(stripe: int):
    """Adds sparse stripes: one bit for cells that have 1 or more, one for those that have 2 or more."""

    def run(key, t):
        flat = lambda c: pa.concat_arrays([x.flatten() for x in t.column(c).chunks]).to_numpy()
        total = np.bincount(flat("cell"), weights=flat("count"), minlength=1 << stripe)
        return pa.table([[key[0].as_py()], [np.packbits(total >= 1).tobytes()], [np.packbits(total >= 2).tobytes()]],
                        names=["stripe", "one", "two"]).cast(pa.schema([("stripe", pa.int32()), ("one", pa.binary()), ("two", pa.binary())]))

    return run


def _merge_bits(key, t):
    one, two = 0, 0
    for a, b in zip(t.column("one").to_pylist(), t.column("two").to_pylist(), strict=True):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        two = two | b | (one & a)
        one = one | a
    return pa.table([[key[0].as_py()], [two.tobytes()]], names=["stripe", "two"]).cast(pa.schema([("stripe", pa.int32()), ("two", pa.binary())]))


def repeated_cells(rows: DataFrame, window: int, width: int, stripe: int, parts: int, block_bytes: int) -> list[np.ndarray]:
    """For each sketch row, a bit for every cell whose merged count is 2 or more."""
    sparse = rows.mapInArrow(_partial(window, width, stripe, parts, block_bytes), "stripe int, part int, cell array<int>, count array<tinyint>")
    some = sparse.groupBy("stripe", "part").applyInArrow(_merge(stripe), "stripe int, one binary, two binary")
    merged = some.groupBy("stripe").applyInArrow(_merge_bits, "stripe int, two binary")
    bits = np.zeros(ROWS << (width - 3), dtype=np.uint8)
    size = 1 << (stripe - 3)
    for r in merged.toLocalIterator():
        bits[r["stripe"] * size:(r["stripe"] + 1) * size] = np.frombuffer(r["two"], np.uint8)
    return list(bits.reshape(ROWS, -1))


def _candidates(bits, n_buckets: int, window: int, width: int, block_bytes: int):
    """Windows that the sketch takes for repeated, to partitions by hash; what the block itself decides stays with it."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc", pa.list_(pa.int64())), ("tk", pa.list_(pa.int64())),
                        ("who", pa.list_(pa.int32())), ("pos", pa.list_(pa.int32())), ("h", pa.list_(pa.int64()))])

    def likely(key):
        out = np.ones(len(key), dtype=bool)
        for plane, at in zip(bits.value, cells(key, width), strict=True):
            out &= (plane[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return out

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 16
        for i, b in enumerate(blocks(batches, "text", block_bytes)):
            data, off = W.buffers(_column(b, "text"))
            docs = _column(b, "doc").fill_null(LAST).to_numpy()
            who, pos, hashes = [], [], []
            for lo, hi in W.pieces(off):
                h, key, start, row, first = windows(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], window)
                if not len(key):
                    continue
                keep = np.flatnonzero(likely(key))
                hashes.append(W.shingles(h, window)[start[keep]])
                who.append(row[keep] + lo)
                pos.append(start[keep] - first[row[keep]])
            who, pos, hashes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, pos, hashes))
            hashes = hashes.astype(_U)
            # The smallest document of every window speaks for the block; later ones lose the window here.
            order = np.lexsort((pos, docs[who], hashes))
            who, pos, hashes = who[order], pos[order], hashes[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = hashes[1:] != hashes[:-1]
            least = docs[who][new][np.cumsum(new) - 1] if len(new) else docs[:0]
            lost = docs[who] > least
            # A document may hold the window several times, and rows may share an id: all go.
            bucket = ((hashes >> _U(32)) * _U(n_buckets) >> _U(32)).astype(np.int64)
            send = np.flatnonzero(~lost)
            have, at = np.unique(bucket[send], return_index=True)
            gone = np.flatnonzero(lost)
            take = np.concatenate([gone, send])
            cut = np.concatenate([[0, len(gone)], len(gone) + np.append(at, len(send))[1:]]).astype(np.int32)
            rows = len(have) + 1
            all_docs = np.concatenate([[0], np.full(rows, len(docs))]).astype(np.int32)
            lists = lambda v, t, c: pa.ListArray.from_arrays(pa.array(c), pa.array(v.astype(t)))
            # Each row to a bucket names the ids of its documents, by the number that `who` has.
            sent_ids = docs[who[take]]
            no_hash = np.concatenate([[0, 0], cut[2:] - len(gone)]).astype(np.int32)
            ids = np.concatenate([docs, sent_ids[len(gone):]])
            yield pa.record_batch([
                pa.array(np.full(rows, base + i, dtype=np.int64)),
                pa.array(np.concatenate([[-1 - (base + i) % n_buckets], have]).astype(np.int32)),
                lists(ids, np.int64, (np.concatenate([[0, len(docs)], len(docs) + no_hash[2:]])).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(all_docs), _column(b, "tk")),
                lists(who[take], np.int32, cut), lists(pos[take], np.int32, cut),
                lists(hashes[send].view(np.int64), np.int64, no_hash)], schema=schema)

    return run


FOUND = "block long, doc array<long>, tk array<long>, who array<int>, pos array<int>"


def _first_documents(key, t):
    """One partition of windows: the smallest document id of each; later starts go back to their blocks."""
    if key[0].as_py() < 0:
        return t.select(["block", "doc", "tk", "who", "pos"])
    flat = lambda c: pa.concat_arrays([x.flatten() for x in t.column(c).chunks]).to_numpy()
    h, doc, who, pos = flat("h"), flat("doc"), flat("who"), flat("pos")
    length = np.concatenate([np.diff(x.offsets.to_numpy()) for x in t.column("h").chunks])
    source = np.repeat(np.arange(len(t)), length)
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[order][1:] != h[order][:-1]
    start = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[order], start)[np.cumsum(new) - 1] if len(h) else doc
    lost = np.zeros(len(h), dtype=bool)
    lost[order] = doc[order] > least
    cut = np.concatenate([[0], np.cumsum(np.bincount(source[lost], minlength=len(t)))]).astype(np.int32)
    none = pa.ListArray.from_arrays(pa.array(np.zeros(len(t) + 1, np.int32)), pa.array([], pa.int64()))
    return pa.table([t.column("block"), none, none, pa.ListArray.from_arrays(pa.array(cut), pa.array(who[lost].astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(pos[lost].astype(np.int32)))],
                    names=["block", "doc", "tk", "who", "pos"])


def _runs(window: int):
    """One block's starts to runs of removed words (from, to) for each of its documents that loses any."""

    def run(key, t):
        flat = lambda c: pa.concat_arrays([x.flatten() for x in t.column(c).chunks])
        docs, tks, who, pos = flat("doc"), flat("tk"), flat("who").to_numpy(), flat("pos").to_numpy()
        order = np.lexsort((pos, who))
        who, pos = who[order].astype(np.int64), pos[order].astype(np.int64)
        new = np.ones(len(who), dtype=bool)
        new[1:] = (who[1:] != who[:-1]) | (pos[1:] > pos[:-1] + window)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(who))[:len(at)] - 1
        rows, first = np.unique(who[at], return_index=True)
        cut = np.append(first, len(at)).astype(np.int32) if len(rows) else np.zeros(1, np.int32)
        lists = lambda v: pa.ListArray.from_arrays(pa.array(cut), pa.array(v.astype(np.int32)))
        ids = docs.to_numpy()[rows]
        return pa.table([pa.array(ids, mask=ids == LAST), tks.take(pa.array(rows)), lists(pos[at]), lists(pos[last] + window)],
                        names=["doc", "tk", "lo", "hi"])

    return run


def _kept(batches):
    schema = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    for b in batches:
        n, gone, kept = [], [], []
        texts, los, his = (_column(b, c) for c in ("text", "lo", "hi"))
        for i in range(len(b)):
            words = (texts[i].as_py() or "").encode().split()
            n.append(len(words))
            if los[i].is_valid:
                at, out = 0, []
                for lo, hi in zip(los[i].as_py(), his[i].as_py(), strict=True):
                    out += words[at:lo]
                    at = hi
                words = out + words[at:]
            gone.append(n[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.record_batch([_column(b, "doc"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], schema=schema)


def removed_runs(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", width: int | None = None,
                 stripe: int = STRIPE, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc, tk, lo, hi): runs of removed words of every document that loses any; tk is the hash of its text."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n_buckets = max(1, -(-int(total) // bucket_bytes))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("tk"), F.col(text).alias("text"))
    width = fitting_width(int(total), window) if width is None else width
    stripe = min(stripe, width)
    bits = docs.sparkSession.sparkContext.broadcast(
        repeated_cells(rows.select("text"), window, width, stripe, n_buckets // 64 + 1, block_bytes))
    asked = rows.mapInArrow(_candidates(bits, n_buckets, window, width, block_bytes),
                            "block long, bucket int, doc array<long>, tk array<long>, who array<int>, pos array<int>, h array<long>")
    found = written(asked.groupBy("bucket").applyInArrow(_first_documents, FOUND), "dedup-found")
    runs = found.groupBy("block").applyInArrow(_runs(window), "doc long, tk long, lo array<int>, hi array<int>")
    return runs.dropDuplicates(["doc", "tk"])


def dedup(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """(key, n_words, n_removed, kept): every document without the words of repeated windows, joined by one space."""
    runs = removed_runs(docs, window, key, text, **sizes).select(F.col("doc").alias("_d"), F.col("tk").alias("_t"), "lo", "hi")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("tk"), F.col(text).alias("text"))
    joined = rows.join(runs.hint("shuffle_hash"), rows["doc"].eqNullSafe(runs["_d"]) & (rows["tk"] == runs["_t"]), "left")
    kept = joined.select("doc", "text", "lo", "hi").mapInArrow(_kept, "doc long, n_words long, n_removed long, kept string")
    return kept.withColumnRenamed("doc", key)
