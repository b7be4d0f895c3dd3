"""N-gram Jaccard join by universe partition: exact links and components.

A document's set holds its distinct k-word shingles (lower-cased words; fewer words than k:
the whole sequence as one shingle). Two documents link when ``100 * |A and B| >= t * |A or B|``.

Filter. Sizes are cut into bands; linked sets of which the smaller has a size in a band differ in
at most H shingles, H from the band's largest size. Shingles are hashed into m segments. A
segment's key is a hash of the shingles in it; d of the segments also get the keys of their
one-deletion neighbourhoods, so they match when they differ by one shingle. Segments
weigh 1, those with deletions 2, and the weights sum to H + 1 + e: by the pigeonhole principle
the segments in which linked sets match weigh more than e. :func:`allocate` picks m and d for
each band by cost: index rows against segments that hold too little to be selective. A set
publishes keys for its own band and, as the larger side, for the bands below that it can link to.

The e spare units make frequent keys harmless, and keys of (nearly) empty segments, which sets share that have nothing else in
common: e grows with the sets, so that nearly all of them need not publish these. All keys have one order, by the number of documents that
have them; each set leaves out its most frequent keys, as long as these and its (nearly) empty segments weigh no more
than e. The rarest key that two linked sets match in is left out by neither: all their other matches
come before it in the order, so leaving it out would leave out more than e. A key that more
than ``HOT`` blocks' documents have is hot.

Verification. Documents with equal sets are one class. Each class has a parity sketch: ``SKETCH`` longs whose bits are flipped by
the shingles. Two sets differ in no fewer shingles than their sketches in bits, so most candidates that do not link go
by an exact bound; for the others the sets are built from their texts. A pair first gets a sketch of each set that is as wide as
the set is large, and only where these allow a link both sets, which are compared, exactly, on 64-bit shingle hashes.
In each group of classes that share a key the smallest is compared with the others. Pairs inside a
component need no comparison, so copies and near copies of one text are settled there. What is left:

* Hot groups. Their sets meet again, in other groups: all shingles have one order, by the number of these sets that have them
  (counted in ``CELLS`` cells), and linked sets share one of their first shingles, so each set gives only these (prefix
  filter), once, in however many hot groups it is. Where the first common shingle stands bounds what two sets share.
* These and the small groups go on with further hubs, eight times as many each round, until no group
  holds two components with members that were not compared.

Hubs, groups and components are tables; no group is gathered in one task.

Defined cases: null, empty or wordless text: empty set, linked with nothing, own component; a
null key is no candidate for the smallest key of a component (a component of null keys only
has a null id); repeated rows are copies; an empty table stays empty; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as SparkWindow
from pyspark.sql import functions as F

from . import _words as W
from ._graph import components
from ._pack import column, unpack
from ._tables import blocks, written

K, PERCENT = 4, 85
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
HOT, SPARE = 32, 10
#: Cost of a segment with less than two shingles, in index rows.
THIN_COST = 50.0
#: Longs of a parity sketch.
SKETCH = 8
#: Texts to fetch (four longs each) that are broadcast at most; beyond, texts are shuffled to them.
FETCH_ROWS = 1 << 18
#: Bits of a wide sketch for each shingle, at least.
WIDE = 4
#: Cells in which the shingles of open hot groups are counted, up to ``MOST``; they are summed in slices.
CELLS, SLICE, MOST = 1 << 24, 1 << 16, (1 << 16) - 1
#: Cells in which a bucket's keys of 32 bits are counted before they are sorted.
MEET = 1 << 24
_CELL = np.uint32((1 << 32) // MEET)
_U = np.uint64
_SEED = 0xC2B2AE3D27D4EB4F


@lru_cache(maxsize=None)
def allocate(lo: int, hi: int, percent: int) -> tuple[int, int, int]:
    """(m, d, e) for the sizes lo..hi: segments, those with deletions, spare weight.

    The spare weight covers the thin segments: a set in which they weigh more publishes the keys of its empty segments, which
    all such sets of the band share.
    """
    h = hi * (100 - percent) // percent
    if h == 0:
        return 0, 0, 0  # only equal sets link: they are one class already
    most = max(0, 2 * max(1, lo // 4) - h - 1)
    e = min(SPARE, most)
    while True:
        best = None
        for d in range((h + 1 + e) // 2 + 1):
            m = h + 1 + e - d
            load = lo / m
            cost = m - d + d * (load + 1) + THIN_COST * m * exp(-load) * (1 + load)
            if best is None or cost < best[0]:
                best = (cost, m, d)
        _, m, d = best
        need = ceil(thin_weight(lo / m, m, d))
        if need <= e or e == most:
            return m, d, e
        e = min(need, most)


def thin_weight(load: float, m: int, d: int) -> float:
    """What the thin segments of nearly every set weigh: the mean and four standard deviations."""
    mean = exp(-load) * (m - d + 2 * d * (1 + load))
    return mean + 4 * sqrt(2 * mean)


def band_edges(upto: int, percent: int) -> np.ndarray:
    """Smallest sizes of the bands; a band ends where a set could no longer link to its smallest."""
    out, lo = [], 1
    while lo <= upto:
        out.append(lo)
        lo = max(lo, lo * 100 // percent) + 1
    return np.array([*out, lo], dtype=np.int64)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, number of each row)."""
    s, e, first = W.spans(data, off)
    h = W.hashes(data, s, e, lower=True)
    grams = W.shingles(h, k)
    rows, size = [], np.zeros(len(off) - 1, dtype=np.int64)
    for i in range(len(off) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            got = np.sort(grams[a:b - k + 1])
            keep = np.empty(len(got), dtype=bool)
            keep[0] = True
            np.not_equal(got[1:], got[:-1], out=keep[1:])
            got = got[keep]
        elif b > a:
            got = W.shingles(h[a:b] + _U(b - a), b - a)
        else:
            continue
        rows.append(got)
        size[i] = len(got)
    return (np.concatenate(rows) if rows else np.zeros(0, dtype=_U)), size


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by index, modulo 2**64."""
    low = np.bincount(at, weights=(values & _U(0xFFFFFFFF)).astype(np.float64), minlength=n)
    high = np.bincount(at, weights=(values >> _U(32)).astype(np.float64), minlength=n)
    return low.astype(_U) + (high.astype(_U) << _U(32))


def sketches(grams: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``SKETCH`` longs for each of n rows: every shingle flips one bit."""
    place = at * (SKETCH * 64) + (W.mix(grams ^ _U(0x6A09E667F3BCC908)) >> _U(55)).astype(np.int64) % (SKETCH * 64)
    place, count = np.unique(place, return_counts=True)
    odd = place[count % 2 == 1]
    return _sums(odd >> 6, _U(1) << (odd & 63).astype(_U), n * SKETCH)


def wide_sketches(grams: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longs of all rows, longs of each row): parity sketches of at least ``WIDE`` bits a shingle.

    Their lengths are powers of two times ``SKETCH``: the longer of two folds to the length of the shorter.
    """
    length = SKETCH << np.ceil(np.log2(np.maximum(1, size * WIDE / (SKETCH * 64)))).astype(np.int64)
    first = np.cumsum(length) - length
    bit = (W.mix(grams ^ _U(0x3C6EF372FE94F82B)) & (length[at] * 64 - 1).astype(_U)).astype(np.int64)
    place, count = np.unique(first[at] * 64 + bit, return_counts=True)
    odd = place[count % 2 == 1]
    return _sums(odd >> 6, _U(1) << (odd & 63).astype(_U), int(length.sum())), length


def keys_of(grams: np.ndarray, size: np.ndarray, percent: int):
    """(key, row * 4 + own * 2 + heavy) of all published keys, and the slack of each row.

    ``own``: published for the set's own band; ``heavy``: of a segment with deletions, which weighs 2. The
    slack is e less the weight of thin segments, (in the own band, the least in lower bands).
    """
    n = len(size)
    slack = np.full((2, n), SPARE, dtype=np.int64)
    if not len(grams):
        return np.zeros(0, _U), np.zeros(0, np.int64), slack
    edges = band_edges(int(size.max()), percent)
    own = np.searchsorted(edges, size, side="right") - 1
    least = -(-size * percent // 100)  # the smallest size that can link
    down = np.searchsorted(edges, np.maximum(least, 1), side="right") - 1
    place = W.mix(grams + _U(_SEED)) >> _U(32)
    value = W.mix(grams ^ _U(_SEED))
    plan = np.array([(*allocate(int(lo), int(hi) - 1, percent),) for lo, hi in zip(edges[:-1], edges[1:], strict=True)],
                    dtype=np.int64)
    out_key, out_who = [], []
    for below in range(int((own - down)[size > 0].max()) + 1):
        rows = np.flatnonzero((size > 0) & (own - below >= down) & (plan[own - below, 0] > 0))
        if not len(rows):
            continue
        band = own[rows] - below
        m, d, e = plan[band].T
        first = np.concatenate([[0], np.cumsum(m)])
        used = np.zeros(n, dtype=bool)
        used[rows] = True
        at = np.flatnonzero(np.repeat(used, size))
        mine = np.repeat(np.arange(len(rows)), size[rows])
        seg = ((place[at] * m[mine].astype(_U)) >> _U(32)).astype(np.int64)
        slot = first[mine] + seg
        total = int(first[-1])
        sums, count = _sums(slot, value[at], total), np.bincount(slot, minlength=total)
        owner = np.repeat(np.arange(len(rows)), m)
        index = np.arange(total) - first[owner]
        salt = W.mix((band[owner] * (1 << 32) + index).astype(_U) + _U(_SEED))
        near = index < d[owner]  # with one-deletion neighbourhood
        thin = (count == 0) | (near & (count == 1))
        weak = np.bincount(owner[thin], weights=(1 + near[thin]), minlength=len(rows)).astype(np.int64)
        all_keys = weak > e  # such a set publishes the keys of its empty segments, too
        low = int(below > 0)
        slack[low, rows] = np.minimum(slack[low, rows], e - weak)
        keep = (count > 0) | all_keys[owner]
        out_key.append(W.mix(sums[keep] + salt[keep]))
        out_who.append(rows[owner[keep]] * 4 + (1 - low) * 2 + near[keep])
        gone = near[slot] & ((count[slot] > 1) | all_keys[mine])
        out_key.append(W.mix(sums[slot[gone]] - value[at[gone]] + salt[slot[gone]]))
        out_who.append(rows[mine[gone]] * 4 + (1 - low) * 2 + 1)
    if not out_key:
        return np.zeros(0, _U), np.zeros(0, np.int64), slack
    return np.concatenate(out_key), np.concatenate(out_who), slack


def _publish(n_buckets: int, k: int, percent: int, block_bytes: int):
    """Documents to rows for the buckets of their keys, and one row with what is known of the block's documents."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())),
                        ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("slack", pa.list_(pa.int32())), ("low", pa.list_(pa.int32())), ("bits", pa.list_(pa.int64())), ("tk", pa.list_(pa.int64())),
                        ("key", pa.binary()), ("who", pa.binary())])

    def lists(v, offsets, kind):
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(v.astype(kind)))

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 16
        for i, b in enumerate(blocks(batches, "text", block_bytes)):
            data, off = W.buffers(b.column(b.schema.get_field_index("text")))
            size, a, c, bits, slack, keys, who, done = [], [], [], [], [], [], [], 0
            for lo, hi in W.pieces(off):
                grams, n = shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], k)
                at = np.repeat(np.arange(len(n)), n)
                set_a = _sums(at, W.mix(grams + _U(11)), len(n))
                set_b = _sums(at, W.mix(grams ^ _U(0x5555555555555555)), len(n))
                key, code, free = keys_of(grams, n, percent)
                size.append(n)
                a.append(set_a)
                c.append(set_b)
                bits.append(sketches(grams, at, len(n)))
                slack.append(free)
                keys.append(key)
                who.append(code + done * 4)
                done += len(n)
            size, a, c, bits = map(np.concatenate, (size, a, c, bits))
            slack, low = np.concatenate(slack, axis=1)
            keys, who = np.concatenate(keys), np.concatenate(who)
            # Copies inside the block publish once; they have the same class.
            _, first, inv = np.unique(np.stack([a, c], axis=1), axis=0, return_index=True, return_inverse=True)
            lead = first[inv.ravel()] == np.arange(len(a))
            keep = lead[who >> 2]
            keys, who = keys[keep], who[keep]
            bucket = (keys >> _U(32)) * _U(n_buckets) >> _U(32)
            keys &= _U(0xFFFFFFFF)
            order = np.argsort(bucket << _U(32) | keys, kind="stable")
            keys, who, bucket = keys[order].astype(np.int64), who[order], bucket[order]
            have, start = np.unique(bucket, return_index=True)
            # The keys of a bucket rise: their steps take fewer bytes than they do.
            step = np.diff(keys, prepend=0)
            step[start] = keys[start]
            cut = lambda v: [v[:0], *np.split(v, start[1:])[:len(have)]]
            rows = len(have) + 1
            none = np.zeros(rows, dtype=np.int64)
            meta = lambda v, kind: lists(v, np.concatenate([[0], none + len(v)]), kind)
            docs = b.column(b.schema.get_field_index("doc"))
            yield pa.record_batch([
                pa.array(np.full(rows, base + i, dtype=np.int64)),
                pa.array(np.concatenate([[-1 - (base + i) % n_buckets], have.astype(np.int64)]).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], none + len(docs)]).astype(np.int32)), docs),
                meta(size, np.int32), meta(a.view(np.int64), np.int64), meta(c.view(np.int64), np.int64), meta(slack, np.int32),
                meta(low, np.int32), meta(bits.view(np.int64), np.int64), meta(b.column(b.schema.get_field_index("tk")).to_numpy(), np.int64),
                column(cut(step)), column(cut(who))], schema=schema)

    return run


META, GROUP = 0, 1
FOUND = "kind int, x long, y long, n int, a long, b long, slack int, low int, tk long, bits array<long>"


def _meet():
    """One bucket: documents that share a key.

    Rows of groups: x group, y document, n documents in the group, slack and low what the group's keys weigh in the
    document's own band and in lower ones.
    """
    names = ["kind", "x", "y", "n", "a", "b", "slack", "low", "tk", "bits"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]

    def frame(kind, x, **cols):
        cols = {"kind": np.full(len(x), kind), "x": x, **cols}
        have = [cols.get(c) for c in names]
        return pa.table([pa.nulls(len(x), t) if c is None else c if isinstance(c, pa.Array) else pa.array(c).cast(t)
                         for c, t in zip(have, types, strict=True)], names=names)

    def flat(t, name):
        col = t.column(name).combine_chunks()
        col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
        return col.flatten(), np.diff(col.offsets.to_numpy())

    def shared(t):
        """(keys, who, number of each block) without keys that only one entry has, as far as ``MEET`` cells tell."""
        count, parts = np.zeros(MEET, dtype=np.uint8), []
        for steps, who in zip(t.column("key"), t.column("who"), strict=True):
            k = np.cumsum(unpack(steps.as_py())).astype(np.uint32)  # they rise
            cell = k // _CELL
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            held = count[cell[start]] + np.diff(start, append=len(cell))
            count[cell[start]] = np.minimum(held, 2)
            parts.append((k, unpack(who.as_py()).astype(np.uint32)))
        for i, (k, who) in enumerate(parts):
            often = count[k // _CELL] > 1
            parts[i] = k[often], who[often]
        length = np.array([len(k) for k, _ in parts], dtype=np.int64)
        keys, who = (np.concatenate(v) for v in zip(*parts, strict=True))
        return keys.astype(np.int64), who.astype(np.int64), length

    def run(key, t):
        block = t.column("block").to_numpy()
        if key[0].as_py() < 0:
            docs, length = flat(t, "doc")
            ref = np.repeat(block << 24, length) + np.concatenate([np.arange(x) for x in length])
            bits = pa.ListArray.from_arrays(pa.array(np.arange(len(ref) + 1, dtype=np.int32) * SKETCH), flat(t, "bits")[0])
            return frame(META, ref, y=docs, bits=bits, **{c: flat(t, c)[0] for c in ("n", "a", "b", "slack", "low", "tk")})
        keys, who, length = shared(t)
        ref = np.repeat(block << 24, length) + (who >> 2)
        order = np.lexsort((ref, keys))
        keys, ref, own, weight = keys[order], ref[order], (who[order] >> 1 & 1).astype(bool), 1 + (who[order] & 1)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        group = np.cumsum(new) - 1
        once = new.copy()
        once[1:] |= ref[1:] != ref[:-1]
        size = np.bincount(group[once])
        live = (size > 1) & (np.bincount(group, weights=own) > 0)  # two larger sides alone need not meet here
        keep = once & live[group]
        group, ref, own, weight = group[keep], ref[keep], own[keep], weight[keep]
        if not len(group):
            return frame(GROUP, np.zeros(0, np.int64))
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        count = np.diff(np.append(start, len(group)))
        # Keys with the same documents are one group, here and in other buckets.
        name = np.repeat(np.add.reduceat(W.mix(ref.view(_U) + _U(3)), start).view(np.int64), count)
        count = np.repeat(count, count)
        order = np.lexsort((ref, name))
        name, ref, count, own, weight = name[order], ref[order], count[order], own[order], weight[order]
        start = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (ref[1:] != ref[:-1])]))
        return frame(GROUP, name[start], y=ref[start], n=count[start], slack=np.add.reduceat(weight * own, start),
                     low=np.add.reduceat(weight * ~own, start))

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for b in blocks(iter([batch]), "text", W.PIECE_BYTES):
                data, off = W.buffers(b.column(b.schema.get_field_index("text")))
                grams, n = shingle_sets(data, off, k)
                at = np.repeat(np.arange(len(n)), n)
                a = _sums(at, W.mix(grams + _U(11)), len(n)).view(np.int64)
                lists = lambda v, length: pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(v.view(np.int64)))
                ok = pa.array(a == b.column(b.schema.get_field_index("a")).to_numpy())
                yield pa.record_batch([b.column(b.schema.get_field_index("node")), lists(grams, n), lists(*wide_sketches(grams, at, n))],
                                      names=["node", "grams", "wide"]).filter(ok)

    return run


def _grams(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(shingles of all rows, number of each row)."""
    col = b.column(b.schema.get_field_index("grams"))
    return col.flatten().to_numpy(), np.diff(col.offsets.to_numpy())


def _cells(batches):
    """One task's sets: how many of them have a shingle in each cell, in slices."""
    count = np.zeros(CELLS, dtype=np.uint16)
    for b in batches:
        at, n = np.unique(_grams(b)[0] & (CELLS - 1), return_counts=True)
        count[at] = np.minimum(count[at] + n, MOST)
    parts = count.reshape(-1, SLICE)
    have = np.flatnonzero(parts.any(axis=1))
    yield pa.record_batch([pa.array(have.astype(np.int32)), column(list(parts[have]))], names=["slice", "counts"])


def _summed(key, t):
    total = sum(unpack(x.as_py()) for x in t.column("counts"))
    return pa.table([pa.array([key[0].as_py()], pa.int32()), column([total])], names=["slice", "counts"])


def _prefixes(counts, percent: int):
    """The first shingles of each set, rarest first, of which linked sets share one.

    What two sets have in common begins with its first shingle in the order; at ``place`` in a set of n it leaves room for
    n - place + 1. A linked set needs percent of n, the smaller of two (``own``) twice percent of (100 + percent). A shingle
    that is alone in its cell is in no other set.
    """

    def run(batches):
        count = counts.value
        for b in batches:
            grams, n = _grams(b)
            row = np.repeat(np.arange(len(n)), n)
            c = count[grams & (CELLS - 1)]
            order = np.lexsort((grams, c, row))
            size = n[row].astype(np.int64)
            place = np.arange(len(row)) - (np.cumsum(n) - n)[row] + 1
            keep = (place <= size - -(-size * percent // 100) + 1) & (c[order] > 1)
            own = place <= size - -(-2 * percent * size // (100 + percent)) + 1
            yield pa.record_batch([pa.array(grams[order][keep]), b.column(b.schema.get_field_index("node")).take(pa.array(row[keep])),
                                   pa.array(size[keep].astype(np.int32)), pa.array(place[keep].astype(np.int32)), pa.array(own[keep].astype(np.int32))],
                                  names=["t", "node", "size", "place", "own"])

    return run


def classes(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
            block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, links, labels): (ref, doc, n, node, tk) of every row, (a, b) links between the nodes of different
    sets, and (node, component) of every node that has links.

    The links hold every component together; pairs that an earlier link already joins are left out.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n_buckets = max(1, -(-int(total) // bucket_bytes))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("tk"), F.col(text).alias("text"))
    published = rows.mapInArrow(
        _publish(n_buckets, k, percent, block_bytes), "block long, bucket int, doc array<long>, n array<int>, a array<long>, "
        "b array<long>, slack array<int>, low array<int>, bits array<long>, tk array<long>, key binary, who binary")
    found = written(published.groupBy("bucket").applyInArrow(_meet(), FOUND), "join-found")

    meta = found.where(F.col("kind") == META).select(F.col("x").alias("ref"), F.col("y").alias("doc"), "n", "a", "b", "slack", "low", "tk", "bits")
    class_ = meta.where("n > 0").groupBy("n", "a", "b").agg(F.min("ref").alias("node"))
    known = written(meta.join(class_, ["n", "a", "b"], "left").withColumn("node", F.coalesce("node", "ref"))
                    .select("ref", "doc", "n", "a", "node", "slack", "low", "tk", F.when(F.col("ref") == F.col("node"), F.col("bits")).alias("bits")),
                    "join-classes")

    # Each document leaves out its most frequent keys, as far as its slack goes, in its own band and in the lower ones.
    of_ref = known.select(F.col("ref").alias("y"), "node", F.col("n").alias("size"), "slack", "low")
    weighed = (found.where(F.col("kind") == GROUP).select(F.col("x").alias("g"), "y", F.col("n").alias("c"), F.col("slack").alias("w_own"),
                                                         F.col("low").alias("w_low"))
               .repartition("y").groupBy("y", "g").agg(F.max("c").alias("c"), F.sum("w_own").alias("w_own"), F.sum("w_low").alias("w_low")))
    upto = SparkWindow.partitionBy("y").orderBy(F.desc("c"), "g").rowsBetween(SparkWindow.unboundedPreceding, 0)
    member = (weighed.withColumn("own", F.sum("w_own").over(upto)).withColumn("below", F.sum("w_low").over(upto)).join(of_ref, "y")
              .where(((F.col("w_own") > 0) & (F.col("own") > F.col("slack"))) | ((F.col("w_low") > 0) & (F.col("below") > F.col("low"))))
              .groupBy("g", "node").agg(F.max("size").alias("size"), F.max((F.col("c") > hot).cast("int")).alias("many")))
    member = written(member.withColumn("c", F.count(F.lit(1)).over(SparkWindow.partitionBy("g"))).where("c > 1").drop("c"), "join-groups")
    sketch = known.where("ref = node").select("node", "bits")

    # Sizes and sketches of a pair that may link.
    apart = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(SKETCH)), F.lit(0))
    near_size = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    near_bits = (100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]

    def likely(pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose sizes and sketches allow a link."""
        pairs = pairs.where((F.col("a") != F.col("b")) & near_size).select(*ordered, F.least("na", "nb").alias("na"), F.greatest("na", "nb").alias("nb"))
        of = lambda c: sketch.select(F.col("node").alias(c), F.col("bits").alias(f"bits_{c}"))
        return pairs.distinct().join(of("a"), "a").join(of("b"), "b").where(near_bits).select("a", "b")

    nodes = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    repeated = not known.groupBy("doc", "tk").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()
    built: list[DataFrame] = []

    def few(table: DataFrame, most: int = FETCH_ROWS) -> DataFrame:
        """A written table, broadcast unless it has many rows."""
        return F.broadcast(table) if table.count() <= most else table.hint("shuffle_hash")

    def sets_of(need: DataFrame) -> DataFrame:
        """(node, grams, wide) of the nodes in ``need``; sets that were not needed before are built from their texts."""
        need = written(need, "join-need")
        fresh = need
        for table in built:
            fresh = fresh.join(table.select("node"), "node", "left_anti")
        reps = written(known.where("ref = node").join(fresh, "node", "left_semi")
                       .select("node", F.col("doc").alias("rep"), F.col("tk").alias("rep_tk"), "a"), "join-fetch")
        if not reps.isEmpty():
            same_row = rows["doc"].eqNullSafe(reps["rep"]) & (rows["tk"] == reps["rep_tk"])  # ids alone may be null or repeated
            texts = rows.join(few(reps), same_row).select("node", "a", "text")
            sets = texts.mapInArrow(_sets(k), "node long, grams array<long>, wide array<long>")
            built.append(written(sets.dropDuplicates(["node"]) if repeated else sets, "join-sets"))  # a repeated row stands for its node once
        have = built[0]
        for table in built[1:]:
            have = have.union(table)
        return have.join(few(need), "node", "left_semi")

    folded = lambda c: (f"aggregate(sequence(0, int(size({c}) div w) - 1), array_repeat(0L, w), "  # noqa: E731
                        f"(s, j) -> zip_with(s, slice({c}, j * w + 1, w), (p, q) -> p ^ q))")
    wide_apart = f"aggregate(zip_with({folded('wa')}, {folded('wb')}, (p, q) -> bit_count(p ^ q)), 0, (s, x) -> s + x)"

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that link: the wide sketches of both go to a pair first, whole sets only to those they leave."""
        sets = sets_of(nodes(pairs))
        wide = lambda c: sets.select(F.col("node").alias(c), F.col("wide").alias(f"w{c}"), F.size("grams").alias(f"n{c}"))
        near = written(pairs.join(wide("a"), "a").join(wide("b"), "b").withColumn("w", F.expr("least(size(wa), size(wb))"))
                       .where((100 + percent) * F.expr(wide_apart) <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b"), "join-near")
        if near.isEmpty():
            return near
        sets = sets_of(nodes(near))
        left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
        right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
        both = F.size(F.array_intersect("ga", "gb"))
        return written(near.join(left, "a").join(right, "b")
                       .where(100 * both >= percent * (F.size("ga") + F.size("gb") - both)).select("a", "b"), "join-links")

    def labelled(table: DataFrame, labels: DataFrame) -> DataFrame:
        return table.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs between different components."""
        end = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        return (pairs.join(end("a"), "a", "left").join(end("b"), "b", "left")
                .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))

    def unfinished(table: DataFrame, hubs: int = 1) -> DataFrame:
        """The rows of ``table`` in groups that still hold several components, and members that no hub was compared with."""
        more = table.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"))
        return table.join(more.where((F.col("lo") < F.col("hi")) & (F.col("c") > hubs + 1)).select("g"), "g", "left_semi")

    # First round: the smallest of every group against the others.
    hub = member.groupBy("g").agg(F.min(F.struct("node", "size")).alias("h")).select(
        "g", F.col("h.node").alias("a"), F.col("h.size").alias("na"))
    hub = written(hub, "join-hubs")
    first = member.join(hub, "g").select("a", "na", F.col("node").alias("b"), F.col("size").alias("nb"))
    done = pairs = written(likely(first), "join-pairs")
    # One partner of each first: most others are inside a component then.
    lead = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "join-pairs")
    links = pairs if lead.isEmpty() else verified(lead)
    labels = components(links)
    pairs = written(across(pairs.join(lead, ["a", "b"], "left_anti"), labels), "join-pairs")
    if not pairs.isEmpty():
        links = links.unionByName(verified(pairs))
        labels = components(links)

    # Hot groups: their sets meet again, in the shingles that the fewest of them have (prefix filter).
    groups = member.where("many = 0").select("g", "node", "size", F.lit(1).alias("place"))
    hot_nodes = written(unfinished(labelled(member.where("many = 1"), labels)).select("node").distinct(), "join-hot")
    if not hot_nodes.isEmpty():
        sets = sets_of(hot_nodes).select("node", "grams")
        counts = np.zeros(CELLS, dtype=np.uint16)
        cells = sets.mapInArrow(_cells, "slice int, counts binary").groupBy("slice").applyInArrow(_summed, "slice int, counts binary")
        for part in cells.toLocalIterator():
            counts[part.slice * SLICE:(part.slice + 1) * SLICE] = np.minimum(unpack(part.counts), MOST)
        shared = docs.sparkSession.sparkContext.broadcast(counts)
        token = written(sets.mapInArrow(_prefixes(shared, percent), "t long, node long, size int, place int, own int"), "join-prefixes")
        # Shingles with the same sets are one group; the first of them has the least places.
        same = (token.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.max("own").alias("own"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                       F.sum(F.hash("node").cast("long")).alias("y"))
                .where("c > 1 and own = 1").select("t", F.xxhash64("c", "x", "y").alias("g")))
        groups = groups.union(token.join(same, "t").groupBy("g", "node").agg(F.max("size").alias("size"), F.min("place").alias("place")))

    # Open groups: pairs between components, with more hubs each round.
    groups = written(groups, "join-small-groups")
    near_place = (100 + percent) * (F.expr("least(na - pa, nb - pb)") + 1) >= percent * (F.col("na") + F.col("nb"))
    hubs = (0, 4)
    while True:
        rank = F.row_number().over(SparkWindow.partitionBy("g").orderBy("node"))
        groups = written(unfinished(labelled(groups.select("g", "node", "size", "place"), labels), hubs[0]).withColumn("rank", rank)
                         .join(sketch, "node"), "join-open")
        h = groups.where((F.col("rank") > hubs[0]) & (F.col("rank") <= hubs[1])).select(
            "g", F.col("node").alias("a"), F.col("size").alias("na"), F.col("place").alias("pa"), F.col("rank").alias("ra"),
            F.col("component").alias("ca"), F.col("bits").alias("bits_a"))
        if h.isEmpty():
            return known.select("ref", "doc", "n", "node", "tk"), links, labels
        o = groups.select("g", F.col("node").alias("b"), F.col("size").alias("nb"), F.col("place").alias("pb"), F.col("rank").alias("rb"),
                          F.col("component").alias("cb"), F.col("bits").alias("bits_b"))
        # The sketches and places decide inside the join: what they exclude is never a row.
        again = h.join(o, "g").where(F.expr("rb > ra and ca <> cb") & near_size & near_place & near_bits).select(*ordered).distinct()
        pairs = written(again.join(done, ["a", "b"], "left_anti"), "join-pairs")
        if not pairs.isEmpty():
            new = verified(pairs)
            done = done.unionByName(pairs)
            if not new.isEmpty():
                links = links.unionByName(new)
                labels = components(links)
        hubs = (hubs[1], 8 * hubs[1])


def grouped(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """(doc, tk, n, component) of every document: key, hash of its text, set size and the component's node."""
    known, _, labels = classes(docs, k, percent, key, text, **sizes)
    return known.join(labels, "node", "left").select("doc", "tk", "n", F.coalesce("component", "node").alias("component"))


def join(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """(key, n_shingles, component_id) of every document."""
    at = grouped(docs, k, percent, key, text, **sizes)
    least = at.groupBy("component").agg(F.min("doc").alias("least"))
    return at.join(least, "component").select(F.col("doc").alias(key), F.col("n").cast("long").alias("n_shingles"),
                                              F.col("least").alias("component_id"))


def representatives(docs: DataFrame, k: int = K, percent: int = PERCENT, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest key (nulls last, then by a hash of the text)."""
    at = written(grouped(docs, k, percent, key, text, **sizes), "join-grouped")
    best = at.groupBy("component").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "tk")).alias("m"))
    keep = best.select(F.col("m.doc").alias("_doc"), F.col("m.tk").alias("_tk")).distinct().hint("shuffle_hash")
    kept = docs.withColumn("_text", F.xxhash64(text)).join(
        keep, F.col(key).eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_tk")), "left_semi")
    if not at.groupBy("doc", "tk").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        kept = kept.dropDuplicates([key, "_text"])  # repeated rows are copies, too
    return kept.drop("_text")
