"""Exact top-k search by inner product: pivot-table elimination.

For integer vectors ``2 <q, x> = |q|^2 + |x|^2 - d(q, x)^2``, and for every pivot p the
triangle inequality gives ``d(q, x) >= |d(q, p) - d(x, p)|``. The distances of all rows to
all pivots are computed once and kept as a written table. The largest lower bound over the
pivots bounds each score from above; candidates are evaluated in bands of falling bound
until the next bound is below the k-th best score (an equal bound is still evaluated, as a
tie may go to a smaller id). The result is exact whatever the pivots are.

Queries and rows meet in cells of one query block and one row block, both of bounded size,
so no side is broadcast or gathered whole; each cell returns its k best for every query and
a ranked window keeps the k best of all. Pivots come from a sample of ``SAMPLE`` vectors
(those with the smallest hashes of their ids), spread by farthest-first choice.

Defined cases: vectors that are null, or hold null or non-finite components, and rows with
a null id take no part; vectors of another length than the query's are not its candidates;
zero vectors and ties are ordinary; a repeated candidate row counts as often as it occurs;
equal repeated queries are answered once; scores are exact while the absolute products of a pair add up to less than 2 ** 63, and a score
beyond a long is held at its end; vectors without components take no part; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ._tables import written

#: Vectors that the pivots are chosen from, and pivots.
SAMPLE, PIVOTS = 512, 16
QUERY_BLOCK, ROW_BLOCK = 2048, 8192
SCALE = 64
#: Scores are held to the range of a long.
LONG = np.longdouble((1 << 63) - 1)


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as double; null where the vector takes no part."""
    fine = vector.isNotNull() & F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))
    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole numbers

    scaled = F.transform(vector, whole)
    return F.when(fine, scaled)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots: each next one is farthest from those before."""
    if not len(sample):
        return sample
    sample = sample.astype(np.longdouble)  # squares of any double
    chosen, near = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen].astype(np.float64)


def pivot_table(vectors: DataFrame, n_pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """``vectors`` (id, x) with ``pivots``: the distances to the pivots of the row's dimension."""
    some = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("x").collect()
    by_dim: dict[int, list] = {}
    for r in some:
        by_dim.setdefault(len(r["x"]), []).append(r["x"])
    chosen = {d: choose_pivots(np.array(v, dtype=np.float64).reshape(len(v), d), n_pivots) for d, v in by_dim.items()}

    def distances(batches):
        for pdf in batches:
            out = []
            for x in pdf["x"]:
                x = np.asarray(x, dtype=np.float64)
                p = chosen.get(len(x))
                out.append(np.sqrt(((p.astype(np.longdouble) - x) ** 2).sum(1)).astype(np.float64) if p is not None else np.zeros(0))
            yield pdf.assign(pivots=out)

    return vectors.mapInPandas(distances, "id long, x array<double>, pivots array<double>")


def _best(q: np.ndarray, x: np.ndarray, pq: np.ndarray, px: np.ndarray, qid: np.ndarray, xid: np.ndarray, k: int):
    """(query index, row index, score) of the k best rows for each query, with bands of falling bound."""
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] >= 2.0**53:
        q, x = q.astype(np.longdouble), x.astype(np.longdouble)  # sums beyond what a double holds exactly
    nq2, nx2 = (q * q).sum(1), (x * x).sum(1)
    for lo in range(0, len(q), 64):
        rows = slice(lo, min(lo + 64, len(q)))
        low = np.zeros((rows.stop - lo, len(x)), dtype=x.dtype)
        for p in range(pq.shape[1]):
            a, b = pq[rows, p, None], px[None, :, p]
            np.maximum(low, np.abs(a - b) - 1e-14 * (a + b), out=low)  # less than the rounding of far distances
        bound = (nq2[rows, None] + nx2[None, :] - low * low) / 2
        bound += 1e-9 * (nq2[rows, None] + nx2[None, :]) + 1e-3  # more than the rounding of the distances
        bound[qid[rows, None] == xid[None, :]] = -np.inf  # the query's own row
        score = np.full(bound.shape, -np.inf, dtype=x.dtype)
        worst = np.full(len(bound), -np.inf, dtype=x.dtype)  # the k-th best score so far
        open_, band = np.arange(len(bound)), 256
        while len(open_):
            band = min(band, len(x))
            if band < len(x):
                edge = -np.partition(-bound[open_], band - 1, axis=1)[:, band - 1]
            else:
                edge = np.full(len(open_), -np.inf)
            least = np.maximum(edge, worst[open_])
            todo = (bound[open_] >= least[:, None]) & np.isneginf(score[open_]) & ~np.isneginf(bound[open_])
            cols = np.flatnonzero(todo.any(axis=0))
            if len(cols):
                part = q[rows][open_] @ x[cols].T
                part[~todo[:, cols]] = -np.inf
                score[np.ix_(open_, cols)] = np.maximum(score[np.ix_(open_, cols)], part)
            if len(x) >= k:
                worst[open_] = -np.partition(-score[open_], k - 1, axis=1)[:, k - 1]
            # Exact stop: every row not yet evaluated has a bound below the k-th best score.
            open_ = open_[(edge >= worst[open_]) & ~np.isneginf(edge)]
            band *= 8
        for i in range(len(bound)):
            live = np.flatnonzero(~np.isneginf(score[i]) & (score[i] >= worst[i]))
            first = live[np.lexsort((xid[live], -score[i, live]))][:k]
            for j in first:
                yield lo + i, j, score[i, j]


def _cell(k: int):
    out = ["query_id", "query_no", "vec_id", "score"]

    def run(key, queries, rows):
        if not len(queries) or not len(rows):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in out})
        q, x, pq, px = (np.array(v.tolist(), dtype=np.float64).reshape(len(v), -1)
                        for v in (queries["x"], rows["x"], queries["pivots"], rows["pivots"]))
        qid, xid = queries["id"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        hits = list(_best(q, x, pq, px, qid, xid, k))
        at = np.array([h[0] for h in hits], dtype=np.int64)
        return pd.DataFrame({"query_id": qid[at], "query_no": queries["no"].to_numpy(np.int64)[at],
                             "vec_id": xid[np.array([h[1] for h in hits], dtype=np.int64)],
                             "score": np.clip(np.array([h[2] for h in hits], dtype=np.longdouble), -LONG, LONG).astype(np.int64)}, columns=out)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row where ``is_query`` holds."""
    base = (vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"),
                                                       integers(F.col(vector), scale).alias("x"), is_query.alias("_q"))
            .where("x is not null and size(x) > 0"))
    rows = base.select("id", "x")
    flags = written(pivot_table(rows).withColumn("dim", F.size("x")), "pivots")
    asked = base.where("_q").select("id", "x").distinct()
    queries = flags.join(asked, ["id", "x"], "left_semi").dropDuplicates(["id", "x"])
    queries = written(queries.withColumn("no", F.monotonically_increasing_id()), "pivot-queries")
    n_q, n_x = max(1, -(-queries.count() // QUERY_BLOCK)), max(1, -(-flags.count() // ROW_BLOCK))
    q = (queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_q)))
         .withColumn("xb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_x - 1).cast("long")))))
    x = (flags.withColumn("xb", F.pmod(F.xxhash64(F.lit("row"), F.col("id")), F.lit(n_x)))
         .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long")))))
    on = ["dim", "qb", "xb"]
    cells = q.groupBy(*on).cogroup(x.groupBy(*on)).applyInPandas(
        _cell(k), "query_id long, query_no long, vec_id long, score long")
    w = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return (cells.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
