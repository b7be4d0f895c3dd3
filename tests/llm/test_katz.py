"""Katz scores against a plain dictionary model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from formspark.llm import katz
from formspark.llm.queries import remainder

SF = "/root/testdata/sf0.001/documents.parquet"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def good_turing(counts):
    """What counts 0..K keep, from the adjusted count r* = (r + 1) N(r + 1) / N(r) in Katz's normalisation:
    d = (r* / r - A) / (1 - A), A = (k + 1) N(k + 1) / N(1), for the largest k whose factors are proper.
    None of the tables here is too rough for every k unless it is tiny."""
    n = Counter(counts.values())
    for k in range(katz.K, 1, -1):
        if any(not n[r] for r in range(1, k + 2)):
            continue
        a = (k + 1) * n[k + 1] / n[1]
        star = {r: (r + 1) * n[r + 1] / n[r] for r in range(1, k + 1)}
        d = {r: (star[r] / r - a) / (1 - a) for r in star} if a < 1 else {}
        if d and all(0 < x < 1 for x in d.values()):
            return [1.0] + [d.get(r, 1.0) for r in range(1, katz.K + 1)]
    return katz.discounts([0] + [n[r] for r in range(1, katz.K + 2)])


@pytest.mark.parametrize("n", [
    [0, 1000, 300, 150, 90, 60, 40],            # proper for every count
    [0, 1000, 300, 150, 90, 100, 40],           # too rough at 4: the cut-off goes down
    [0, 100, 60, 70, 20, 30, 9],                # too rough throughout: smoothed
])
def test_factors_are_good_turing(n):
    d = katz.discounts(n)
    off = n[1] / (n[1] + 2 * n[2])
    assert d[0] == 1 and all(0 < x <= 1 for x in d) and d[1] < 1
    assert d[1:] != [(r - off) / r for r in range(1, katz.K + 1)]
    kept = [r for r in range(1, katz.K + 1) if d[r] < 1]
    k = max(kept)
    assert kept == list(range(1, k + 1))
    counts = n if n[5] != 30 else katz.smoothed(n)
    a = (k + 1) * counts[k + 1] / counts[1]
    for r in kept:
        assert d[r] == pytest.approx(((r + 1) * counts[r + 1] / (r * counts[r]) - a) / (1 - a))


def test_tables_are_scored_by_good_turing(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    uni, bi = Counter(), Counter()
    for k, t in rows:
        if zlib.crc32(str(k).encode()) % 7 != 2:
            toks = tokens(t)
            uni.update(toks)
            bi.update(zip(["<s>", *toks], toks))
    for c in (uni, bi):
        n = Counter(c.values())
        n = [0] + [n[r] for r in range(1, katz.K + 2)]
        d = katz.discounts(n)
        off = n[1] / (n[1] + 2 * n[2])
        assert d[1] < 1 and d[1:] != [(r - off) / r for r in range(1, katz.K + 1)]


def brute(rows):
    """{row number: (held_out, n_tokens, n_known, N, base, score)}, and the probability function."""
    held = [zlib.crc32(str("" if k is None else k).encode()) % 7 == 2 for k, _ in rows]
    toks = [tokens(t) for _, t in rows]
    uni, bi, follow = Counter(), Counter(), defaultdict(set)
    for h, t in zip(held, toks):
        if not h:
            uni.update(t)
            for v, w in zip(["<s>", *t], t):
                bi[v, w] += 1
                follow[v].add(w)
    docs = held.count(False)
    big_n, vocab = sum(uni.values()), len(uni)
    ns = lambda c: [0] + [sum(x == r for x in c.values()) for r in range(1, katz.K + 2)]
    d1, d2 = good_turing(uni), good_turing(bi)
    keep = lambda d, c: (d[c] if c <= katz.K else 1.0) * c
    freed = sum(c - keep(d1, c) for c in uni.values())
    total = big_n + (0 if freed else 1)
    unknown = (freed or 1.0) / total
    p1 = lambda w: keep(d1, uni[w]) / total if uni[w] else unknown
    ctx = {}
    for v, ws in follow.items():
        n = docs if v == "<s>" else uni[v]
        free = sum(bi[v, w] - keep(d2, bi[v, w]) for w in ws)
        plus = 0 if free > 1e-12 else 1
        ctx[v] = (n + plus, (1.0 if plus else free) / (n + plus) / (1 - sum(p1(w) for w in ws)))

    def p(v, w):
        if v not in ctx:
            return p1(w)
        n, alpha = ctx[v]
        return keep(d2, bi[v, w]) / n if bi[v, w] else alpha * p1(w)

    out = []
    for (k, _), h, t in zip(rows, held, toks):
        base = sum(math.log10((uni[w] + 1) / (big_n + vocab + 1)) for w in t)
        out.append((k, h, len(t), sum(uni[w] > 0 for w in t), big_n, base, sum(math.log10(p(v, w)) for v, w in zip(["<s>", *t], t))))
    return out, p, uni, ctx


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_small_blocks_buckets_and_split_contexts(llm):
    df = llm.read.parquet(SF).repartition(3)
    want, p, uni, ctx = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    same(katz.score(df, remainder("doc_id", 7) == 2, block_bytes=50_000, bucket_bytes=40_000, split=50).collect(), want)
    # Behind every context the probabilities of all words and the unknown one sum to 1.
    for v in list(ctx)[:5] + ["<s>"]:
        assert sum(p(v, w) for w in uni) + p(v, "never seen") == pytest.approx(1, abs=1e-9)


def test_defined_cases(docs):
    rows = [(1, "A b a B\tc"), (2, None), (3, ""), (4, "  "), (5, "a b a b"), (5, "a b a b"), (None, "x A"), (9, "é É ü" * 50),
            (12, "w" * 5000)]
    same(katz.score(docs(rows), remainder("doc_id", 7) == 2).collect(), brute(rows)[0])
    assert katz.score(docs([]), remainder("doc_id", 7) == 2).count() == 0


def test_extra_columns_and_all_held_out(docs):
    from pyspark.sql import functions as F

    df = docs([(1, "a b")]).withColumns({"held": F.lit("x"), "doc": F.lit(1), "score": F.lit(2), "block": F.lit(0)})
    got = katz.score(df, F.lit(True)).collect()
    assert got[0].score == 0 and got[0].train_tokens == 0 and got[0].n_known == 0
