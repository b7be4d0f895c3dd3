"""Ranked search against a plain version that scores every document for every query."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from formspark.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def plain(docs, queries, k):
    """docs, queries: lists of (id, text); [(query id, rank, doc id, score)]."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in held if c)
    n_terms = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for q, text in queries:
        scores = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t, times in Counter(plain_terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + 75 * n * n_docs // n_terms
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out.append((q, r, i, -s))
    return out


def run(spark, docs, queries, k=10, parts=3):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    q = spark.createDataFrame(queries, "item_id long, text string").coalesce(1)
    return [tuple(r) for r in ranked.search(d, q, k).select("item_id", "rank", "doc_id", "score").collect()]


def order(rows):
    return sorted(rows, key=str)


def corpus(seed, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "THE", "the", "x9"]
    p = 1 / np.arange(1, len(words) + 1)
    texts = [", ".join(rng.choice(words, size=rng.integers(1, 60), p=p / p.sum())) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)], [(i, " ".join(rng.choice(words, size=rng.integers(1, 12)))) for i in range(25)]


@pytest.mark.parametrize("seed, step", [(1, 1), (2, 16), (3, 4)])
def test_same_as_scoring_everything(spark, monkeypatch, seed, step):
    monkeypatch.setattr(ranked, "STEP", step)
    docs, queries = corpus(seed)
    assert order(run(spark, docs, queries)) == order(plain(docs, queries, 10))


def test_ties_copies_nulls_and_repeated_ids(spark):
    docs = [(i, "same text here") for i in range(50, 0, -1)] + [(None, "same text here"), (7, None), (8, ""), (9, "... !"), (3, "same text here")]
    queries = [(1, "Same"), (1, "text text"), (None, "HERE"), (2, None), (3, "?"), (4, "absent")]
    assert order(run(spark, docs, queries)) == order(plain(docs, queries, 10))
    few = [(None, "a b"), (5, "a c"), (None, "a d")]
    assert order(run(spark, few, [(1, "a")])) == order(plain(few, [(1, "a")], 10))


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_clashing_columns(spark):
    d = spark.sql("SELECT 1L AS doc_id, 'a b' AS text, 9L AS query, 1 AS rank, 2 AS score, 3 AS item_id, 4 AS term")
    q = spark.sql("SELECT 1L AS item_id, 'a' AS text, 1 AS doc_id, 2 AS rank")
    assert ranked.search(d, q).count() == 1


def test_more_queries_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ranked, "QUERY_ROWS", 4)
    docs, queries = corpus(5, 60)
    assert order(run(spark, docs, queries, 3)) == order(plain(docs, queries, 3))


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(0)
    n, v = 5000, 3
    doc, term = np.repeat(np.arange(n), v), np.tile(np.arange(v), n)
    quality = np.sort(rng.integers(1, 1000, n))[::-1] ** 2
    lists = ranked.Lists(doc, term, np.repeat(quality, v) + rng.integers(0, 50, n * v), n, v)
    accesses = []
    top = lists.search(np.arange(v), np.ones(v, np.int64), list(range(n)), 10, [], accesses)
    total = (np.repeat(quality, v)).reshape(n, v).sum(axis=1)
    assert len(top) == 10 and sum(a for a, _ in accesses) < n * v / 10
    assert {e[2] for e in top} <= set(np.argsort(-total, kind="stable")[:40].tolist())


def test_very_long_text(spark):
    docs = [(1, "needle " + "hay " * 700_000), (2, "needle hay"), (3, "hay")]
    assert order(run(spark, docs, [(1, "needle hay")])) == order(plain(docs, [(1, "needle hay")], 10))
