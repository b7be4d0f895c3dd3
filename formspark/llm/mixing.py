"""Mixing sources to target weights: subset-sum budget fitting.

Sources in code point order (null last) get the weights 5, 2, 1, repeating, and share
``share`` times all tokens. A source's target stops at ``cap`` times its size; the excess
goes to the others by weight until none is above (:func:`targets`).

A target of ``c * size + rest`` takes every document ``c`` times and a subset once more
whose sizes come as close to ``rest`` as the lengths allow, never above. Documents are
counted by exact token length, so a source is a table of (length, count). Each length first gives its
proportional share, then long lengths fill what is left down to ``DP_TOKENS``, and a
bounded-knapsack dynamic program over the remaining counts fits the rest (:func:`fit`).
Within a length the documents with the smallest seeded hashes are taken.

The length table of a source is the only thing that meets in one task; it has a row for
each distinct length, however many documents the source has. Ranks inside a length are
counted in hash buckets, so a length that a third of all rows share is split.

Defined cases: a null text has size 0; documents of size 0 are never taken (``taken`` 0);
a null source is a source; repeated rows are separate documents; an empty table stays empty;
other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.structs import column
from ._tables import gapless, written

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
#: Tokens of a budget that the dynamic program fits, besides one document.
DP_TOKENS = 20_000
BUCKETS = 4096


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(F.length(flat) == 0, F.lit(0)).otherwise(spaces + 1).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row for each source.

    A source is capped when its cap is below its weight times the level that the uncapped
    ones share. In the order of cap / weight the capped sources come first, so the level
    follows from running sums. Only the list of sources is sorted in one task.
    """
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_open = F.first(F.when(F.col("cap") / F.col("w") >= F.col("level"), F.col("level")), ignorenulls=True)
    s = s.withColumn("level", first_open.over(whole))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("w")))
    return s.select("source", "source_size", target.alias("target"))


def fit(counts: dict[int, int], budget: int, dp_tokens: int = DP_TOKENS) -> dict[int, int]:
    """How many of each length to take so that the sum comes closest to ``budget`` from below."""
    counts = {n: c for n, c in counts.items() if n > 0 and c > 0}
    total = sum(n * c for n, c in counts.items())
    if budget >= total:
        return counts
    take = {n: c * budget // total for n, c in counts.items()}
    rest = budget - sum(n * c for n, c in take.items())
    order = sorted(counts, reverse=True)
    for n in order:
        more = min(counts[n] - take[n], max(0, (rest - dp_tokens) // n))
        take[n] += more
        rest -= more * n
    # Bounded knapsack on bit sets: bit s of `reach` says that the sum s can be made. Counts
    # are split into powers of two; each step keeps the set before it for the way back.
    reach, steps, full = 1, [], (1 << (rest + 1)) - 1
    for n in order:
        left = min(counts[n] - take[n], rest // n)
        part = 1
        while left > 0 and not reach >> rest & 1:
            part = min(part, left)
            steps.append((reach, n, part))
            reach |= (reach << (n * part)) & full
            left -= part
            part *= 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for was, n, part in reversed(steps):
        if not was >> at & 1:
            take[n] += part
            at -= n * part
    return take


def _fit_source(rows):
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    whole = int(target // size) if size else 0
    rest = round(target - whole * size)
    take = fit(dict(zip(rows["size"].astype(int).tolist(), rows["n"].astype(int).tolist(), strict=True)), rest)
    out = rows[["source", "size", "source_size", "target"]].copy()
    out["whole"] = whole
    out["extra"] = [take.get(int(n), 0) for n in rows["size"]]
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 7,
        key: str = "doc_id", text: str = "text", source: str = "source", whole: bool = False) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) of every document.

    Documents are rows: keys may be null or repeated. With ``whole``, ``_row`` holds the document's row.
    """
    own = [F.col(key), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
           F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("_u")]
    sized = written(docs.select(*own), "mix-sizes")
    hist = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    per = targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap)
    mine = per.withColumnRenamed("source", "_s")
    lengths = hist.join(mine, hist["source"].eqNullSafe(mine["_s"])).drop("_s")
    plan = lengths.groupBy("source").applyInPandas(
        _fit_source, "source string, size long, source_size long, target double, whole long, extra long")
    plan = written(plan, "mix-plan").select(F.col("source").alias("_s"), F.col("size").alias("_n"), "source_size", "target",
                                            "whole", "extra")
    rows = docs.select(*own, F.struct(*[column(c) for c in docs.columns]).alias("_row")) if whole else sized
    ranked = gapless(rows, ["source", "size"], F.pmod(F.col("_u"), F.lit(BUCKETS)), [F.col("_u"), F.col(key)], "_at", BUCKETS)
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("whole") + (F.col("_at") < F.col("extra")).cast("long"))
    return (ranked.join(plan, ranked["source"].eqNullSafe(plan["_s"]) & (ranked["size"] == plan["_n"]))
            .withColumn("copies", copies.cast("long"))
            .select(key, "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), *(["_row"] if whole else [])))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each copy. ``options`` are those of :func:`mix`.

    Each row goes through the mix itself and is not looked up by its key, so null and repeated keys count as the
    documents they are.
    """
    taken = mix(docs, whole=True, **options).where(F.col("copies") > 0)
    each = taken.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return each.select(*[column("_row", c).alias(c) for c in docs.columns])
