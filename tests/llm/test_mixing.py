"""Mixing: targets, budget fitting and selection."""

import itertools
import random
from collections import Counter

import pytest
from formspark.llm import mixing
from formspark.llm.queries import op7_mix
from pyspark.sql import functions as F

from . import plain

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(4))
def test_targets(llm, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 1, 10, 1000, 100_000]) * r.randrange(1, 9) for i in range(r.randrange(1, 30))} | {None: 77}
    got = mixing.targets(llm.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {x.source: x.target for x in got} == pytest.approx(plain.targets(sizes))


@pytest.mark.parametrize("dp", [0, 5, 1000])
def test_fit_is_close_and_within_counts(dp):
    r = random.Random(dp)
    for _ in range(60):
        counts = {r.randrange(1, 40): r.randrange(1, 5) for _ in range(r.randrange(1, 5))}
        budget = r.randrange(0, 1 + sum(n * c for n, c in counts.items()))
        take = mixing.fit(dict(counts), budget, dp)
        got = sum(n * c for n, c in take.items())
        assert all(0 <= c <= counts[n] for n, c in take.items()) and got <= budget
        if dp == 1000 and all(c * budget // sum(n * k for n, k in counts.items()) == 0 for c in counts.values()):
            sums = {sum(n * c for n, c in zip(counts, x)) for x in itertools.product(*(range(c + 1) for c in counts.values()))}
            assert got == max(s for s in sums if s <= budget)


def test_exact_budgets_with_many_lengths():
    r = random.Random(9)
    counts = Counter(r.randrange(1, 3000) for _ in range(5000))
    total = sum(n * c for n, c in counts.items())
    for share in (0.001, 0.3, 0.77):
        take = mixing.fit(dict(counts), int(total * share))
        assert sum(n * c for n, c in take.items()) == int(total * share)


def test_table(llm):
    got = op7_mix(llm, SF).collect()
    docs = {r.doc_id: r for r in llm.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    size = {k: len((d.text or "").encode().split()) for k, d in docs.items()}
    by = Counter()
    for k, d in docs.items():
        by[d.source] += size[k]
    want = plain.targets(by)
    taken = Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == by[docs[r.doc_id].source] and r.taken in (0, r.size, 2 * r.size)
        assert r.target == pytest.approx(want[docs[r.doc_id].source])
        taken[docs[r.doc_id].source] += r.taken
    assert all(abs(taken[s] - t) <= 1 for s, t in want.items())
    assert sorted(got) == sorted(op7_mix(llm, SF).collect())


def test_defined_cases(docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y", "en", None), (3, "x y", "en", None), (4, " one\ttwo three\x0b", "en", "b"),
            (None, "w " * 30000, "en", "a"), (6, "É è", "en", "é")]
    df = docs(rows).withColumns({c: F.lit(0) for c in ("size", "target", "w", "_u", "copies")})
    got = {(r.doc_id, r.size): r.taken for r in mixing.mix(df).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 2), (4, 3), (None, 30000), (6, 2)}
    assert got[1, 0] == got[2, 0] == 0 and all(t <= 2 * n for (_, n), t in got.items())
    assert mixing.mix(docs([])).count() == 0
    alike = docs([(i, "a b", "en", "s") for i in range(999)])  # one length holds all rows
    assert sum(r.taken for r in mixing.mix(alike).collect()) in (2996, 2997, 2998)


def test_rows_of_null_and_repeated_ids_are_documents(spark):
    rows = [(None, f"word{i} b c", "x") for i in range(6)] + [(1, "a b", "x"), (1, "a b", "x"), (1, "c d e", "y"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_row", F.lit(1)).withColumn("size", F.lit(2))
    mixed = mixing.mix(docs)
    taken = {tuple(r): n for r, n in Counter(mixing.repeated(docs).collect()).items()}
    assert mixed.count() == len(rows)
    assert sum(taken.values()) == mixed.agg(F.sum("copies")).first()[0]
    for r, n in Counter((*r, 1, 2) for r in rows).items():
        assert taken.get(r, 0) <= 2 * n
