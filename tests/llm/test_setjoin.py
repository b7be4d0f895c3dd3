"""Jaccard join against all pairs."""

import random

import pytest
from formspark.llm import setjoin

from .plain import groups as brute

SF = "/root/testdata/sf0.001/documents.parquet"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, families=12, alphabet=400):
    """Families of edited copies with between 0 and 30 % of the words changed, sizes 1 to 300."""
    r = random.Random(seed)
    word = lambda: "w%d" % r.randrange(alphabet)
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(r.choice([1, 3, 5, 8, 12, 20, 40, 90, 200, 300]))]
        if r.random() < 0.4:
            base[len(base) // 2:len(base) // 2] = passage
        for _ in range(r.randrange(1, 12)):
            t = list(base)
            for _ in range(r.randrange(0, 1 + len(t) // 12)):
                i = r.randrange(len(t))
                t[i:i + 1] = r.choice([[], [word()], [word(), word()]])
            texts.append(" ".join(t))
    r.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "hot", "block"), [(1, 32, 1 << 20), (2, 2, 3000), (3, 1, 1000)])
def test_families(docs, seed, hot, block):
    rows = corpus(seed)
    df = docs(rows).repartition(3)
    assert got(setjoin.join(df, block_bytes=block, bucket_bytes=20_000, hot=hot)) == brute(rows)


def test_lower_threshold(docs):
    rows = corpus(5, families=8)
    assert got(setjoin.join(docs(rows), percent=70, hot=3)) == brute(rows, percent=70)


def test_table(llm):
    df = llm.read.parquet(SF)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert got(setjoin.join(df, hot=4)) == brute(rows)


def test_defined_cases(docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (5, "one two"), (None, "one two three four five"),
            (None, "one two three four five"), (7, "one two three four five"), (8, "É é ü"), (9, "é é ü"), (10, "x" * 20000), (11, "x" * 20000)]
    assert got(setjoin.join(docs(rows))) == brute(rows)
    assert setjoin.join(docs([])).count() == 0


def test_extra_columns(docs):
    from pyspark.sql import functions as F

    df = docs([(1, "a b c d e"), (2, "a b c d e")]).withColumns({c: F.lit(0) for c in ("doc", "node", "component", "n", "a", "ref")})
    assert got(setjoin.join(df)) == [(1, 2, 1), (2, 2, 1)]


def test_representatives(docs):
    rows = corpus(7, families=6) + [(900, "lone words that nobody else has"), (900, "lone words that nobody else has"), (901, "")]
    rows += [(0, "a second text under a key that is taken already")]
    df = docs(rows)
    parts = {r[0]: r[2] for r in brute(rows[:-1])}
    want = sorted({k for k, c in parts.items() if k == c} | {0}, key=str)
    got_rows = setjoin.representatives(df).select("doc_id", "text").collect()
    assert sorted({r.doc_id for r in got_rows}, key=str) == want
    assert len(got_rows) == len(want) + 1 and df.columns == setjoin.representatives(df).columns


@pytest.fixture()
def tables(monkeypatch):
    """Rows of the tables that a join writes, by name."""
    rows, write = {}, setjoin.written

    def recorded(df, name):
        out = write(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(setjoin, "written", recorded)
    return rows


def test_long_sets_go_by_wide_sketches(docs, tables):
    """Long texts with a common part are candidates that a sketch of fixed length cannot tell; no whole set goes to them."""
    r = random.Random(3)
    words = lambda n: ["w%d" % r.randrange(10 ** 6) for _ in range(n)]
    common = words(2400)
    rows = [(i, " ".join(common + words(600))) for i in range(5)]
    assert got(setjoin.join(docs(rows), k=5, percent=80)) == brute(rows, k=5, percent=80)
    assert sum(tables["join-pairs"]) > 0 and sum(tables["join-near"]) == 0


def test_hot_groups_give_each_set_once(docs, tables):
    """Texts around a common passage are in many hot groups; they give the first of their shared shingles, once."""
    r = random.Random(9)
    words = lambda n: ["w%d" % r.randrange(10 ** 6) for _ in range(n)]
    common, rows = words(50), []
    for i in range(24):
        own = words(14)
        rows += [(2 * i, " ".join(common + own)), (2 * i + 1, " ".join(common + own[:-1]))]
    assert got(setjoin.join(docs(rows), hot=1)) == brute(rows)
    assert "join-differences" not in tables and tables["join-hot"] == [48]
    reach = 61 - -(-61 * 85 // 100) + 1
    assert 0 < tables["join-prefixes"][0] <= 48 * reach


def test_prefixes_hold_every_link():
    """Linked sets share a first shingle that is in the smaller one's own part, at places that leave room for the rest."""
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    r = random.Random(5)
    for percent in (50, 80, 85, 99):
        base = [r.randrange(1 << 60) for _ in range(60)]
        sets = [set(r.sample(base, r.randrange(40, 61))) | {r.randrange(1 << 60) for _ in range(r.randrange(6))} for _ in range(60)]
        batch = pa.record_batch([pa.array(range(60), pa.int64()), pa.array([sorted(s) for s in sets], pa.list_(pa.int64()))], names=["node", "grams"])
        (cells,) = setjoin._cells([batch])
        counts = np.zeros(setjoin.CELLS, dtype=np.int32)
        for part, v in zip(cells["slice"].to_pylist(), cells["counts"], strict=True):
            counts[part * setjoin.SLICE:(part + 1) * setjoin.SLICE] = setjoin.unpack(v.as_py())
        (out,) = setjoin._prefixes(SimpleNamespace(value=counts), percent)([batch])
        first = {(x["node"], x["t"]): (x["place"], x["own"]) for x in out.to_pylist()}
        for a in range(60):
            for b in range(60):
                x, y, both = sets[a], sets[b], sets[a] & sets[b]
                if a != b and len(x) <= len(y) and 100 * len(both) >= percent * len(x | y):
                    shared = [t for t in both if (a, t) in first and (b, t) in first]
                    assert any(first[a, t][1] and (100 + percent) * (min(len(x) - first[a, t][0], len(y) - first[b, t][0]) + 1)
                               >= percent * (len(x) + len(y)) for t in shared)


def test_wide_sketches_fold():
    import numpy as np

    r = np.random.default_rng(1)
    grams = r.integers(0, 1 << 63, 3000).astype(np.uint64)
    for n, m in ((100, 120), (500, 520), (600, 1100), (2000, 3000)):
        both = np.concatenate([grams[:n], grams[:m]])
        longs, length = setjoin.wide_sketches(both, np.repeat([0, 1], [n, m]), np.array([n, m]))
        a, b = longs[:length[0]], longs[length[0]:]
        assert length[0] * 64 >= setjoin.WIDE * n and len(b) % len(a) == 0
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
        assert 0 < sum(int(x).bit_count() for x in a ^ b) <= m - n


def test_long_sets_without_common_shingles_share_no_key():
    """Their empty segments weigh no more than the spare units, so no key stands for one."""
    import numpy as np

    r = np.random.default_rng(2)
    for percent in (80, 85):
        for n in (2000, 3400, 6000, 10000):
            key, who, slack = setjoin.keys_of(r.integers(0, 1 << 63, 40 * n).astype(np.uint64), np.full(40, n), percent)
            assert len(np.unique(np.stack([key, (who >> 2).astype(np.uint64)]), axis=1)[0]) == len(np.unique(key))
            assert slack.min() >= 0


def test_long_texts_without_links_are_no_candidates(docs, tables):
    """Pairs do not grow with the square of the long texts of one size, which no sketch of fixed length tells apart."""
    r = random.Random(11)
    rows = [(i, " ".join("w%d" % r.randrange(10 ** 6) for _ in range(3600 + i))) for i in range(60)]
    assert got(setjoin.join(docs(rows), k=5, percent=80)) == brute(rows, k=5, percent=80)
    assert sum(tables["join-pairs"]) <= 60
