"""Substring dedup against all windows in a dictionary."""

import random

import numpy as np
import pytest
from formspark.llm import substring

SF = "/root/testdata/sf0.001/documents.parquet"


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    order = lambda k: float("inf") if k is None else k
    least = {}
    for (k, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            x = tuple(w[i:i + window])
            least[x] = min(least.get(x, float("inf")), order(k))
    out = []
    for (k, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < order(k):
                gone.update(range(i, i + window))
        out.append((k, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 99, 50)
    for n in (1, 2, 3, 5, 8, 43):
        assert (substring.sliding_min(x, n) == [x[i:i + n].min() for i in range(51 - n)]).all()


@pytest.mark.parametrize(("window", "width", "block"), [(50, 26, 1 << 20), (10, 4, 2000), (5, 12, 700)])
def test_passages(docs, window, width, block):
    r = random.Random(window)
    word = lambda: "w%d" % r.randrange(60)
    shared = [[word() for _ in range(r.choice([window - 1, window, window + 1, 3 * window]))] for _ in range(4)]
    rows = []
    for i in range(60):
        t = [word() for _ in range(r.randrange(0, 3 * window))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(t) + 1)
            t[at:at] = r.choice(shared)
        rows.append((i * 7 % 60, r.choice([" ", "\n", " \t"]).join(t)))
    rows += [(61, rows[3][1]), (61, rows[4][1]), (62, rows[3][1]), (62, rows[3][1]), (None, rows[3][1]), (None, rows[5][1])]
    df = docs(rows).repartition(3)
    assert got(substring.dedup(df, window, width=width, block_bytes=block, bucket_bytes=9000)) == brute(rows, window)


def test_table(llm):
    df = llm.read.parquet(SF)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert got(substring.dedup(df)) == brute(rows, 50)


def test_defined_cases(docs):
    long = " ".join("w%d" % i for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \t\x0b"), (4, "a " * 60), (5, "a " * 60), (5, "a " * 60), (None, "a " * 60), (7, long), (8, "É " + long)]
    assert got(substring.dedup(docs(rows))) == brute(rows, 50)
    assert substring.dedup(docs([])).count() == 0


def test_extra_columns(docs):
    from pyspark.sql import functions as F

    df = docs([(1, "a b"), (2, "a b")]).withColumns({c: F.lit(0) for c in ("doc", "tk", "lo", "hi", "kept")})
    assert got(substring.dedup(df, 2)) == [(1, 2, 0, "a b"), (2, 2, 2, "")]


def test_sketch_follows_the_corpus(docs, monkeypatch):
    r, made, of = random.Random(8), [], substring.repeated_cells
    rows = [(i, " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(400))) for i in range(60)]
    rows.append((99, rows[3][1]))

    def watched(text, window, width, *a):
        made.append((width, of(text, window, width, *a)))
        return made[-1][1]

    monkeypatch.setattr(substring, "repeated_cells", watched)
    monkeypatch.setattr(substring, "LEAST_WIDTH", 8)
    assert got(substring.dedup(docs(rows), 50)) == brute(rows, 50)
    (width, bits), = made
    full = [np.unpackbits(x).mean() for x in bits]
    assert width == 13 and max(full) < 0.1
    assert [substring.fitting_width(int(x)) for x in (1e8, 1e10, 1e13)] == [22, 29, 29]
