"""Ranked lexical search with the Best Position Algorithm.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with
only A-Z lower-cased. Scores are the integers of :func:`impacts`; each query gets its ``k``
best documents, equal scores by ascending id.

1. *Index*: documents are read once for each block of queries. Every block of documents becomes one row of a
   written table: ids, lengths and (document, term, frequency) postings of the query terms.
   Counts of documents, terms and documents by term are sums over that table.
2. *Impact lists*: a task reads the rows of its partition one after the other. Each row's
   postings get their impacts and are ordered twice: by falling impact inside each term (the
   lists of sorted access) and by document (direct access).
3. *Best positions*: a query reads the next positions of all its lists, looks the documents
   that it sees first up in all other lists, and marks every position it has seen either way.
   The best position of a list is the end of its contiguous seen positions; the
   sum of the scores there bounds every document not seen. That bound is never looser than
   the one at the last position read. The search of a row ends when the bound lies strictly
   below the k-th best score so far; the k-th score is carried from row to row of a task, so later rows
   end sooner.
4. The k best of every task meet by query, and the k best of those stay.

Queries come in blocks of at most ``QUERY_ROWS`` rows and ``QUERY_BYTES`` of text, which bounds what the
driver collects and the tasks hold. A document larger than a block is a row of its own.

Defined cases: documents and queries without terms (null, empty, punctuation only) are not counted and
match nothing; every row of ``queries`` is a query of its own, also with a null or repeated id;
documents with a null id rank behind all others of the same score, repeated rows are
ranked each; empty tables give an empty result; other columns are not read. Terms are compared by
64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _pack as P
from . import _words as W
from ._tables import blocks, written

BLOCK_BYTES = 8 << 20
QUERY_ROWS, QUERY_BYTES = 4096, 8 << 20
#: Positions that a query reads of each list in its first step; each further step reads twice as many.
STEP = 16

_GAP = np.zeros(256, dtype=bool)
_GAP[:128] = True
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = False


def terms(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, first term of each row and the end, term hashes) of the texts, piece by piece."""
    data, offsets = W.buffers(col)
    for lo, hi in W.pieces(offsets):
        part, off = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        starts, ends, first = W.spans(part, off, _GAP)
        yield lo, first, W.hashes(part, starts, ends, lower=True)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of every term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one occurrence of a term in a query adds to the score of a document."""
    if len(length) and 75 * int(length.max()) * n_docs >= 1 << 63:
        m = np.array([25 + 75 * int(x) * n_docs // n_terms for x in length], dtype=np.int64)
    else:
        m = 100 - 75 + 75 * length * n_docs // max(n_terms, 1)
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class _Queries:
    """A block of queries: their ids and, for each, distinct terms (indices of ``vocab``) and frequencies."""

    def __init__(self, rows: list) -> None:
        self.ids = [r[0] for r in rows]
        found: list[np.ndarray] = []
        for _, first, h in terms(pa.array([r[1] for r in rows], pa.string())):
            found += [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.vocab = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        counted = [np.unique(h, return_counts=True) for h in found]
        self.terms = [(np.searchsorted(self.vocab, h), n.astype(np.int64)) for h, n in counted]


def _query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[_Queries]:
    held: list = []
    size = 0
    for row in queries.select(id_col, text_col).toLocalIterator():
        n = len(row[1].encode()) if row[1] else 0
        if held and (len(held) >= QUERY_ROWS or size + n > QUERY_BYTES):
            yield _Queries(held)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    if held:
        yield _Queries(held)


_INDEX = "n_docs bigint, n_terms bigint, length binary, doc binary, term binary, tf binary, id array<{id}>"


def _index(docs: DataFrame, id_col: str, text_col: str, vocab: np.ndarray) -> DataFrame:
    """One row for each block of documents: its counts and the postings of the terms in ``vocab``."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            keys, tfs, lengths = [], [], []
            for lo, first, h in terms(block.column("text")):
                lengths.append(np.diff(first))
                at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
                hit = np.flatnonzero(vocab[at] == h)
                doc = np.searchsorted(first, hit, side="right") - 1 + lo
                key, tf = np.unique(doc * len(vocab) + at[hit], return_counts=True)
                keys.append(key)
                tfs.append(tf)
            length = np.concatenate(lengths)
            key, tf = np.concatenate(keys), np.concatenate(tfs)
            rows, doc = np.unique(key // len(vocab), return_inverse=True)
            ids = block.column("id").take(pa.array(rows))
            cols = [pa.array([int((length > 0).sum())]), pa.array([int(length.sum())])]
            cols += [P.column([v]) for v in (length[rows], doc, key % len(vocab), tf)]
            cols.append(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
            yield pa.RecordBatch.from_arrays(cols, names=["n_docs", "n_terms", "length", "doc", "term", "tf", "id"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(index, _INDEX.format(id=id_type)), "postings")


def _document_frequencies(index: DataFrame, n: int) -> np.ndarray:
    """Documents of each term: summed in every task, then by term; as many rows as the block of queries has terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for x in batch.column("term"):
                total += np.bincount(P.unpack(x.as_py()), minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    df = np.zeros(n, np.int64)
    for t, c in index.select("term").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
        df[t] = c
    return df


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All integers of the ranges lo[i] .. hi[i] - 1, one behind the other."""
    n = hi - lo
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - ends + n, n)


class Lists:
    """Impact lists of one block of documents, for sorted and for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> None:
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.term_of, self.impact_of = term, impact
        self.place = np.empty(len(doc), np.int64)
        self.place[order] = np.arange(len(doc))
        self.of_doc = np.searchsorted(doc, np.arange(n_docs + 1))
        self.wanted = np.zeros(n_terms, np.int64)

    def _best(self, seen: np.ndarray, at: int, end: int) -> int:
        """The first position from ``at`` on that was not seen."""
        width = 64
        while at < end:
            part = seen[at:min(at + width, end)]
            j = int(part.argmin())
            if not part[j]:
                return at + j
            at += len(part)
            width *= 2
        return end

    def search(self, query: np.ndarray, times: np.ndarray, ids: list, k: int, top: list, accesses: list | None = None) -> list:
        """``top`` (sorted keys (-score, id is null, id), at most k) with the documents of these lists.

        ``accesses`` gets, for each step, (positions read by sorted access, documents looked up).
        """
        self.wanted[query] = times
        lo, end = self.start[query], self.start[query + 1]
        best, seen, known = lo.copy(), np.zeros(len(self.doc), bool), np.zeros(len(self.of_doc) - 1, bool)
        step = STEP
        while (lo < end).any():
            hi = np.minimum(lo + step, end)
            read = self.doc[_ranges(lo, hi)]
            new = np.unique(read[~known[read]])
            known[new] = True
            if len(new):
                a, b = self.of_doc[new], self.of_doc[new + 1]
                postings, owner = _ranges(a, b), np.repeat(np.arange(len(new)), b - a)
                mine = self.wanted[self.term_of[postings]] > 0
                postings, owner = postings[mine], owner[mine]
                seen[self.place[postings]] = True
                gain = self.wanted[self.term_of[postings]] * self.impact_of[postings]
                score = np.add.reduceat(gain, np.searchsorted(owner, np.arange(len(new))))
                least = -top[-1][0] if len(top) == k else 1
                good = np.flatnonzero(score >= least)
                found = [(-int(score[i]), ids[new[i]] is None, ids[new[i]]) for i in good]
                top = heapq.nsmallest(k, top + found, key=_key)
            if accesses is not None:
                accesses.append((int((hi - lo).sum()), len(new)))
            lo, step = hi, step * 2
            bound = 0
            for i, (t, n) in enumerate(zip(query, times, strict=True)):
                best[i] = self._best(seen, int(best[i]), int(end[i]))
                if best[i] < end[i]:  # a list seen whole holds no unseen document
                    bound += int(n) * int(self.impact[best[i] - 1] if best[i] > self.start[t] else self.impact[best[i]])
            if len(top) == k and bound < -top[-1][0]:
                break
        self.wanted[query] = 0
        return top


def _key(entry: tuple) -> tuple:
    return entry if not entry[1] else (entry[0], True)


def _best_of_tasks(index: DataFrame, q: _Queries, n_docs: int, n_terms: int, weight: np.ndarray, k: int) -> DataFrame:
    """The k best documents of every query in each task's rows of the index."""
    queries = q.terms

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list] = [[] for _ in queries]
        id_type = None
        for batch in batches:
            id_type = batch.column("id").type.value_type
            for r in range(len(batch)):
                length, doc, term, tf = (P.unpack(batch.column(c)[r].as_py()) for c in ("length", "doc", "term", "tf"))
                if not len(doc):
                    continue
                ids = batch.column("id")[r].as_py()
                lists = Lists(doc, term, impacts(weight[term], tf, length[doc], n_docs, n_terms), len(length), len(weight))
                for i, (query, times) in enumerate(queries):
                    if len(query):
                        tops[i] = lists.search(query, times, ids, k, tops[i])
        at = [i for i, top in enumerate(tops) for _ in top]
        if at:
            yield pa.RecordBatch.from_arrays([
                pa.array(at, pa.int64()), pa.array([e[2] for top in tops for e in top], id_type),
                pa.array([-e[0] for top in tops for e in top], pa.int64())], names=["query", "doc_id", "score"])

    id_type = index.schema["id"].dataType.elementType.simpleString()
    return index.mapInArrow(search, f"query bigint, doc_id {id_type}, score bigint")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): the ``k`` best documents of every row of ``queries``."""
    spark = docs.sparkSession
    doc_type, query_type = docs.schema[id_col].dataType, queries.schema[query_id].dataType
    out = T.StructType([T.StructField(query_id, query_type), T.StructField("rank", T.IntegerType()),
                        T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())])
    result = spark.createDataFrame([], out)
    for q in _query_blocks(queries, query_id, query_text):
        if not len(q.vocab):
            continue
        index = _index(docs, id_col, text_col, q.vocab)
        n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            continue
        weight = weights(n_docs, _document_frequencies(index, len(q.vocab)))
        found = _best_of_tasks(index, q, n_docs, n_terms, weight, k)
        by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(q.ids)), T.StructType([
            T.StructField("query", T.LongType()), T.StructField(query_id, query_type)]))
        result = result.unionByName(ranked.join(names, "query").select(query_id, "rank", "doc_id", "score"))
    return result
