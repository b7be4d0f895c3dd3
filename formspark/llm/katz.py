"""Language-model scoring with Katz backoff (bigram to unigram to the unknown word).

Tokens are lower-cased words and one end token for each document. Counts up to ``K`` are
discounted by Good-Turing; a context gives what its discounts free to the words not seen
behind it, in proportion to their unigram probability, with the exact weight

    alpha(v) = (1 - sum of P(w|v) over seen w) / (1 - sum of P(w) over seen w)

so that the probabilities behind every context sum to 1. Unigrams leave their freed mass to
one unknown word. Every token is evaluated by the recursion P(w|v), else alpha(v) P(w), else
alpha(v) P(unknown).

Everything is counted over the whole corpus and nothing is gathered in one place:

1. *Blocks*: a task turns documents into blocks of about ``BLOCK_BYTES`` of text, with the
   tokens as indices into the block's own sorted list of distinct words. Blocks are written
   as a table bucketed by block, so that later steps find them without shuffling them again.
2. *Words*: each block sends its distinct words with training counts to partitions by word
   hash; a partition adds the counts, numbers its words and answers every block.
3. *Bigrams*: each block sends its distinct (context, word) pairs with counts to partitions
   by context; a partition adds them and answers with each pair's count and, for every
   context, what its backoff weight needs. A context counted more than ``SPLIT`` times is
   split by word into as many parts as its count asks for; the block adds up the parts.
4. *Scores*: a block with both answers evaluates its tokens.

A word that a third of all tokens are is one entry for each block and is split as a context,
so no partition gathers a hot key. Partitions follow the bytes of the corpus. Words are known by 64-bit hashes.
Steps 2 and 3 are written tables in the shared folder, so a lost executor costs its tasks only.

Defined cases: a null text is empty (its only token is the end); a null key counts as the
empty text for the split; repeated rows are separate documents; without training documents
every score is 0; an empty table stays empty; other columns are not read.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._pack import column, flat, unpack
from ..session import scratch_path
from ._tables import PARQUET, blocks, written

K = 5
BLOCK_BYTES = 6 << 20
#: Bytes of text for each partition of words or bigrams; training counts of a context part.
BUCKET_BYTES, SPLIT = 8 << 20, 1 << 19
END = np.uint64(1)
ANSWER = "block long, kind int, bucket int, a binary, b binary, x binary"


def _katz(n: list[float], k: int) -> list[float] | None:
    """Good-Turing factors of counts 1..k by Katz, if all lie between 0 and 1."""
    if not all(n[1:k + 2]) or (k + 1) * n[k + 1] >= n[1]:
        return None
    q = (k + 1) * n[k + 1] / n[1]
    d = [((r + 1) * n[r + 1] / (r * n[r]) - q) / (1 - q) for r in range(1, k + 1)]
    return d if all(0 < x < 1 for x in d) else None


def smoothed(n: list[int]) -> list[float]:
    """Counts of counts on the line fitted to their logarithms (least squares)."""
    points = [(math.log(r), math.log(n[r])) for r in range(1, len(n)) if n[r]]
    if len(points) < 2:
        return [0.0] * len(n)
    mx, my = (sum(c) / len(points) for c in zip(*points, strict=True))
    slope = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
    return [0.0] + [math.exp(my + slope * (math.log(r) - mx)) for r in range(1, len(n))]


def discounts(n: list[int]) -> list[float]:
    """d[0..K] for counts 0..K from the counts of counts n[1..K+1]: what a count keeps.

    Good-Turing by Katz for the counts up to k, k being the largest one from K down to 2 for which all factors lie
    between 0 and 1; larger counts are kept whole. Where the counts of counts are too rough
    for any k, their log-linear fit takes their place. A corpus without that pattern (fewer than two
    different counts, or more pairs than singles) has nothing Good-Turing could be read from: absolute discounting.
    """
    for counts in (n, smoothed(n)):
        for k in range(K, 1, -1):
            if d := _katz(counts, k):
                return [1.0, *d, *[1.0] * (K - k)]
    off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return [1.0, *[(r - off) / r for r in range(1, K + 1)]]


NONE_I, NONE_F = np.zeros(0, np.int64), np.zeros(0)


def _encode(n_buckets: int, block_bytes: int):
    """Documents to block rows (bucket -1) and word requests (bucket 0 ..)."""
    edges = np.array([(i << 64) // n_buckets for i in range(1, n_buckets)], dtype=np.uint64)
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc", pa.list_(pa.int64())), ("held", pa.binary()),
                        ("n", pa.binary()), ("tok", pa.binary()), ("word", pa.binary()), ("cnt", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        for i, b in enumerate(blocks(batches, "text", block_bytes)):
            data, off = W.buffers(b.column(b.schema.get_field_index("text")))
            held = b.column(b.schema.get_field_index("held")).to_numpy(zero_copy_only=False).astype(bool)
            parts, sizes = [], []
            for lo, hi in W.pieces(off):
                s, e, first = W.spans(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                h = W.hashes(data[off[lo]:off[hi]], s, e, lower=True)
                n = np.diff(first)
                tok = np.full(len(h) + hi - lo, END, dtype=np.uint64)
                tok[np.arange(len(h)) + np.repeat(np.arange(hi - lo), n)] = h
                parts.append(tok)
                sizes.append(n + 1)
            tok, n = np.concatenate(parts), np.concatenate(sizes)
            words, at = np.unique(tok, return_inverse=True)
            cnt = np.bincount(at[np.repeat(~held, n)], minlength=len(words))
            cut = np.concatenate([[0], np.searchsorted(words, edges, side="left"), [len(words)]])
            keep = np.flatnonzero(np.diff(cut))
            docs = b.column(b.schema.get_field_index("doc"))
            none, rest = [NONE_I] * len(keep), [slice(cut[j], cut[j + 1]) for j in keep]
            yield pa.record_batch([
                pa.array(np.full(len(keep) + 1, base + i, dtype=np.int64)),
                pa.array(np.concatenate([[-1], keep]).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array([0] + [len(docs)] * (len(keep) + 1), pa.int32()), docs),
                column([held, *none]), column([n, *none]), column([at, *none]),
                column([NONE_I, *(words[x] for x in rest)]), column([NONE_I, *(cnt[x] for x in rest)])], schema=schema)

    return run


def _answers(rows: list[tuple]) -> pa.Table:
    block, kind, bucket, a, b, x = zip(*rows, strict=True)
    return pa.table([pa.array(block, pa.int64()), pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), column(a), column(b),
                     column(x)], names=["block", "kind", "bucket", "a", "b", "x"])


def _count_words(key, t):
    """Adds up one partition of words; answers (number in the partition, count) in each block's order."""
    words, length = flat(t.column("word"), np.uint64)
    cnt, _ = flat(t.column("cnt"))
    _, at = np.unique(words, return_inverse=True)
    c = np.bincount(at, weights=cnt).astype(np.int64)
    bucket = key[0].as_py()
    stats = [len(c), int((c > 0).sum()), int(c.sum())] + [int((c == r).sum()) for r in range(1, K + 2)]
    rows = [(-1, 0, bucket, np.array(stats), NONE_I, NONE_F)]
    ends = np.cumsum(length)
    for block, lo, hi in zip(t.column("block").to_pylist(), ends - length, ends, strict=True):
        rows.append((block, 0, bucket, at[lo:hi].astype(np.int64), c[at[lo:hi]], NONE_F))
    return _answers(rows)


class _Model:
    """Corpus-wide numbers: a few for each partition, whatever the corpus holds."""

    def __init__(self, stats: list, docs: int, n_buckets: int, split: int):
        size = np.zeros(n_buckets, dtype=np.int64)
        total = np.zeros(K + 3, dtype=np.int64)
        for bucket, a in stats:
            size[bucket] = a[0]
            total += np.array(a[1:], dtype=np.int64)
        self.n_buckets, self.docs, self.split = n_buckets, docs, split
        self.offset = np.concatenate([[0], np.cumsum(size)])
        self.begin = int(self.offset[-1])  # the number of the start of a document as a context
        self.vocabulary, self.tokens = int(total[0]), int(total[1])
        n = [0, *(int(x) for x in total[2:])]
        self.keep = np.array(discounts(n))
        freed = sum((1 - self.keep[r]) * r * n[r] for r in range(1, K + 1))
        # Where no count is discounted, one count is added for the unknown word.
        self.total = float(self.tokens + (not freed))
        self.unknown = (freed or 1.0) / self.total

    def kept(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return np.where(c <= K, self.keep[np.minimum(c, K)], 1.0) * c

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.kept(c) / self.total, self.unknown)


def _pairs(m: _Model, t: pa.Table, words: pa.Table):
    """A block's contexts and pairs in the order of their partitions; the same in steps 3 and 4.

    Returns (tok, prev, c, ctx, ctx_of, ctx_bucket, pair_of_token, w, n, length): tokens and the
    tokens before them as block numbers, counts by block number, context parts, their block
    number and partition, each token's pair (or -1), and the pairs' words, training counts
    and number for each context part.
    """
    rows = {b: i for i, b in enumerate(words.column("bucket").to_pylist())}
    words = words.take(pa.array([rows[b] for b in sorted(rows)]))
    a, length = flat(words.column("a"))
    c, _ = flat(words.column("b"))
    ids = a + np.repeat(m.offset[sorted(rows)], length)
    ids, c = np.append(ids, m.begin), np.append(c, m.docs)
    n, _ = flat(t.column("n"))
    tok, _ = flat(t.column("tok"))
    held, _ = flat(t.column("held"))
    tok = tok.astype(np.int64)
    prev = np.empty_like(tok)
    prev[1:] = tok[:-1]
    prev[np.concatenate([[0], np.cumsum(n)[:-1]])] = len(ids) - 1
    # Context parts: (context, part) for every context of the block that training has.
    used = np.zeros(len(ids), dtype=bool)
    used[prev] = True
    v = np.flatnonzero(used & (c > 0))
    split = c[v] // m.split + 1
    first = np.concatenate([[0], np.cumsum(split)])
    ctx_of = np.repeat(v, split)
    part = np.arange(len(ctx_of)) - np.repeat(first[:-1], split)
    ctx = ids[ctx_of] * (1 << 20) + part
    bucket = (W.mix(ctx.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)) % np.uint64(m.n_buckets)).astype(np.int64)
    sort = np.lexsort((ctx, bucket))
    place = np.empty_like(sort)
    place[sort] = np.arange(len(sort))
    at = np.zeros(len(ids), dtype=np.int64)
    at[v] = first[:-1]
    parts = np.ones(len(ids), dtype=np.int64)
    parts[v] = split
    ask = (c[prev] > 0) & (c[tok] > 0)
    pv, pw = prev[ask], tok[ask]
    which = at[pv]
    if (split > 1).any():
        which = which + (W.mix(ids[pw].view(np.uint64) + np.uint64(0)) % parts[pv].view(np.uint64)).astype(np.int64)
    pair, inv = np.unique(place[which] * len(ids) + pw, return_inverse=True)
    train = np.repeat(~held.astype(bool), n)[ask]
    cnt = np.bincount(inv[train], minlength=len(pair))
    pair_of = np.full(len(tok), -1, dtype=np.int64)
    pair_of[ask] = inv
    w = pair % len(ids)
    count = np.bincount(pair // len(ids), minlength=len(ctx))
    return tok, prev, c, ids, ctx[sort], ctx_of[sort], bucket[sort], pair_of, w, cnt, count


def _ask_pairs(m: _Model):
    names = ["block", "bucket", "ctx", "len", "w", "n", "c"]
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((x, pa.binary()) for x in names[2:])])

    def run(key, t, words):
        if not len(t):
            return schema.empty_table()
        _, _, c, ids, ctx, _, bucket, _, w, n, length = _pairs(m, t, words)
        keep, start = np.unique(bucket, return_index=True)
        at = np.append(start, len(bucket))
        ends = np.concatenate([[0], np.cumsum(length)])[at]
        cut = lambda v, x: column([v[lo:hi] for lo, hi in zip(x[:-1], x[1:], strict=True)])
        return pa.table([pa.array(np.full(len(keep), key[0].as_py(), dtype=np.int64)), pa.array(keep.astype(np.int32)), cut(ctx, at),
                         cut(length, at), cut(ids[w], ends), cut(n, ends), cut(np.where(n > 0, c[w], 0), ends)], names=names)

    return run


def _count_pairs(m: _Model):
    def run(key, t):
        """Adds up one partition of pairs; answers each pair's count and each context's sums."""
        ctx, ctxs = flat(t.column("ctx"))
        length, _ = flat(t.column("len"))
        w, pairs = flat(t.column("w"))
        n, _ = flat(t.column("n"))
        c, _ = flat(t.column("c"))
        _, local = np.unique(ctx, return_inverse=True)
        n_ctx = int(local.max()) + 1 if len(local) else 0
        pair, at = np.unique(np.repeat(local, length) * np.int64(m.begin + 1) + w, return_inverse=True)
        count = np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)
        cw = np.zeros(len(pair), dtype=np.int64)
        np.maximum.at(cw, at, c)
        of, seen = pair // (m.begin + 1), count > 0
        low = np.stack([np.bincount(of[count == r], minlength=n_ctx) for r in range(1, K + 1)], axis=1)
        mass = np.bincount(of[seen], weights=m.kept(cw[seen]), minlength=n_ctx)
        bucket = key[0].as_py()
        rows = [(-1, 1, bucket, np.array([(count == r).sum() for r in range(1, K + 2)]), NONE_I, NONE_F)]
        pe, ce = np.cumsum(pairs), np.cumsum(ctxs)
        for block, plo, phi, clo, chi in zip(t.column("block").to_pylist(), pe - pairs, pe, ce - ctxs, ce, strict=True):
            mine = local[clo:chi]
            rows.append((block, 1, bucket, count[at[plo:phi]], low[mine].ravel(), mass[mine]))
        return _answers(rows)

    return run


def _score(m: _Model, keep2: np.ndarray):
    schema = pa.schema([("doc", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(key, t, answers):
        if not len(t):
            return schema.empty_table()
        kind = answers.column("kind").to_numpy()
        words = answers.filter(pa.array(kind == 0))
        tok, prev, c, _, ctx, ctx_of, bucket, pair_of, w, _, _ = _pairs(m, t, words)
        got = answers.filter(pa.array(kind == 1))
        got = got.take(pa.array(np.argsort(got.column("bucket").to_numpy(), kind="stable")))
        count, _ = flat(got.column("a"))
        low, _ = flat(got.column("b"))
        mass, _ = flat(got.column("x"), np.float64)
        low = low.reshape(-1, K)
        if len(count) != len(w) or len(mass) != len(ctx):
            raise RuntimeError("answers do not fit the block")
        # What the discounts of each context free, and what its seen words take of the unigrams.
        r = np.arange(1, K + 1)
        freed = np.bincount(ctx_of, weights=low @ ((1 - keep2[1:]) * r), minlength=len(c))
        taken = np.bincount(ctx_of, weights=mass, minlength=len(c)) / m.total
        plus = (freed <= 0) & (c > 0)  # no count is discounted: one count is added for the rest
        total = c + plus
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(c > 0, np.where(plus, 1.0, freed) / np.maximum(total, 1) / np.maximum(1 - taken, m.unknown), 1.0)
        lp = np.log10(alpha)[prev] + np.log10(m.unigram(c[tok]))
        has = pair_of >= 0
        cc = np.zeros(len(tok), dtype=np.int64)
        cc[has] = count[pair_of[has]]
        seen = cc > 0
        kept = np.where(cc <= K, keep2[np.minimum(cc, K)], 1.0) * cc
        lp[seen] = np.log10(kept[seen] / total[prev[seen]])
        base = np.log10((c[tok] + 1) / (m.tokens + m.vocabulary + 1))
        n, _ = flat(t.column("n"))
        held, _ = flat(t.column("held"))
        at = np.repeat(np.arange(len(n)), n)
        add = lambda x: np.bincount(at, weights=x, minlength=len(n))
        docs = t.column("doc").combine_chunks()
        docs = docs.flatten() if not isinstance(docs, pa.ChunkedArray) else pa.concat_arrays([x.flatten() for x in docs.chunks])
        return pa.table([docs, pa.array(held.astype(bool)), pa.array(n.astype(np.int64)),
                         pa.array(add(c[tok] > 0).astype(np.int64)), pa.array(add(base)), pa.array(add(lp))], schema=schema)

    return run


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
          bucket_bytes: int = BUCKET_BYTES, split: int = SPLIT) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of all texts.

    The model learns from the documents where ``held_out`` is false (null counts as false).
    """
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n_buckets = max(1, -(-int(total) // bucket_bytes))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text"))
    encoded = rows.mapInArrow(
        _encode(n_buckets, block_bytes), "block long, bucket int, doc array<long>, held binary, n binary, tok binary, word binary, cnt binary")
    name = f"formspark_blocks_{uuid.uuid4().hex}"
    place = scratch_path(spark, "katz-blocks")  # in the shared folder, not in the warehouse
    encoded.write.format("parquet").options(**PARQUET).option("path", place).bucketBy(n_buckets, "block").saveAsTable(name)
    try:
        table = spark.table(name)
        asked = table.where("bucket >= 0").select("block", "bucket", "word", "cnt")
        words = written(asked.groupBy("bucket").applyInArrow(_count_words, ANSWER), "katz-words")
        mine = table.where("bucket < 0").select("block", "doc", "held", "n", "tok")
        train = rows.where("not held").count()
        stats = [(r["bucket"], unpack(bytes(r["a"]))) for r in words.where("block = -1").select("bucket", "a").collect()]
        m = _Model(stats, train, n_buckets, split)
        words = words.where("block >= 0")
        asked = mine.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(
            _ask_pairs(m), "block long, bucket int, ctx binary, len binary, w binary, n binary, c binary")
        pairs = written(asked.groupBy("bucket").applyInArrow(_count_pairs(m), ANSWER), "katz-pairs")
        n = sum((unpack(bytes(r["a"])) for r in pairs.where("block = -1").select("a").collect()), np.zeros(K + 1, np.int64))
        keep2 = np.array(discounts([0, *(int(x) for x in n)]))
        answers = words.unionByName(pairs.where("block >= 0"))
        scored = mine.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            _score(m, keep2), "doc long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        scored = scored.select(F.col("doc").alias(key), "held_out", "n_tokens", "n_known",
                               F.lit(m.tokens).cast("long").alias("train_tokens"), "base_score", "score")
        return written(scored, "katz-scores")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
