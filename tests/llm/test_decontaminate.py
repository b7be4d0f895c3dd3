"""Decontamination against full alignment of every item with every document."""

import random

import pytest
from formspark.llm import decontaminate as D
from pyspark.sql import functions as F

from .plain import leaks as brute

SF = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"


def got(df):
    out = {}
    for r in df.collect():
        out[r.doc_id, r.item_id] = min(r.edits, out.get((r.doc_id, r.item_id), 99))
    return out


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8))) for _ in range(n))


def edited(r, text, n):
    t = list(text)
    for _ in range(n):
        i = r.randrange(len(t))
        t[i:i + 1] = r.choice([[], [r.choice("xyz")], [t[i], r.choice("xyz")]])
    return "".join(t)


@pytest.mark.parametrize("seed", [1, 2])
def test_edits(llm, docs, seed):
    r = random.Random(seed)
    items = [(i, sentence(r, r.choice([3, 6, 12, 25, 60]))) for i in range(12)]
    rows = []
    for i in range(60):
        t = sentence(r, r.randrange(0, 80))
        if r.random() < 0.8:
            item = r.choice(items)[1]
            part = edited(r, item, r.randrange(0, 2 + len(item) // 9))
            t = r.choice(["", t + ".\n"]) + r.choice([part, part.upper(), part.replace(" ", " \n-")]) + r.choice(["", " " + t])
        rows.append((i, t))
    want = brute(rows, items)
    assert len(want) > 15
    bench = llm.createDataFrame(items, ITEMS)
    assert got(D.leaks(docs(rows).repartition(3), bench)) == want
    assert got(D.leaks(docs(rows), bench, item_bytes=500)) == want  # several blocks of items
    kept = {x.doc_id for x in D.clean(docs(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {k for k, _ in want}


def test_table(llm):
    df, bench = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = ([tuple(x) for x in t.collect()] for t in (df.select("doc_id", "text"), bench.select("item_id", "text")))
    short = [x for x in rows if len(x[1]) < 6000]
    want = brute(short, items)
    all_ = got(D.leaks(df, bench))
    assert {k: v for k, v in all_.items() if k[0] in {i for i, _ in short}} == want
    verbatim = {(i, j) for i, t in rows for j, x in items if x in t}
    assert verbatim <= {k for k, v in all_.items() if v == 0}


def test_spans_and_defined_cases(llm, docs):
    item = "Was it the Éclair, or the cat? Nobody in the house could say."
    rows = [(1, None), (2, ""), (3, item), (4, "é " + item + " ü"), (4, "é " + item + " ü"), (None, "x" * 100_000 + " " + item), (6, "no"),
            (7, item + "\n\n" + item)]
    bench = llm.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "no"), (6, " . ")], ITEMS)
    out = D.leaks(docs(rows), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in out) == sorted([(k, i) for k in (0, 3, 4, 4, 7, 7) for i in (1, 2)])
    for r in out:
        text = dict(rows)[r.doc_id].encode()[r.start:r.end].decode()
        assert r.edits == 0 and text.strip(" .") == item.rstrip(".")
    assert D.leaks(docs([]), bench).count() == 0
    assert D.leaks(docs(rows), bench.limit(0)).count() == 0


def test_extra_columns(llm, docs):
    item = "one two three four five six seven"
    df = docs([(1, item), (2, "clean")]).withColumns({c: F.lit("z") for c in ("doc", "item", "item_id", "start", "_x")})
    assert [x.doc_id for x in D.clean(df, llm.createDataFrame([(1, item)], ITEMS)).collect()] == [2]


def test_clean_knows_documents_by_id_and_text(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    rows = [(None, f"clean text number {i} of some words") for i in range(5)] + [(None, f"so {item} then"), (None, None), (1, item), (1, "other words"), (2, item), (2, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    from formspark.llm import decontaminate

    got = sorted(map(tuple, decontaminate.clean(docs, bench).collect()), key=str)
    assert got == sorted([r for r in rows if not r[1] or item not in r[1]], key=str)
