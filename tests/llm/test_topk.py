"""Top-k against all inner products."""

import math
import random

import pytest
from formspark.llm import topk
from pyspark.sql import functions as F

VEC = "vec_id long, embedding array<float>"


def brute(rows, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in ok:
        if q % 20 == 0:
            hits = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(y) == len(x))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize(("n", "dim", "spread"), [(300, 6, 3.0), (120, 1, 50.0), (9, 3, 0.1)])
def test_random(llm, n, dim, spread, monkeypatch):
    r = random.Random(n)
    half = lambda: r.randrange(-16, 17) / 16 * spread  # noqa: E731  exact as float, with many ties
    rows = [(i, [half() for _ in range(dim)]) for i in range(n)]
    rows += [(n + 1 + i, list(rows[0][1])) for i in range(4)]  # equal vectors
    monkeypatch.setattr(topk, "ROW_BLOCK", 70)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    got = topk.top_k(llm.createDataFrame(rows, VEC).repartition(3), F.col("vec_id") % 20 == 0, k=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7)


def test_defined_cases(llm):
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [1.0, float("inf")]),
            (None, [1.0, 1.0]), (1, [3.0, -1.0]), (2, [1.0, 2.0, 3.0]), (120, []), (140, [1e6, -1e6]), (3, [1e6, 1e6])]
    df = llm.createDataFrame(rows, VEC).withColumns({"id": F.lit(1), "x": F.lit(2), "rank": F.lit(3)})
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)
    assert topk.top_k(llm.createDataFrame([], VEC), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_keep_their_values(spark):
    rows = [(0, [1.0]), (1, [5e6]), (2, [9e6]), (3, [-7e9]), (4, [1e300])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 4).collect()
    top = {r["vec_id"]: (r["rank"], r["score"]) for r in got}
    assert top == {4: (1, (1 << 63) - 1), 2: (2, 36864000000), 1: (3, 20480000000), 3: (4, -64 * 64 * 7 * 10**9)}
