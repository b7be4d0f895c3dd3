"""Sharding by a hierarchical weighted hash tree (native).

A tree has regions, a region has racks, a rack has shards with weights; a node weighs what
is below it. A row descends from the root: at each level every child draws
``ln(u) / weight`` with ``u`` from a hash of the key and the child's name, and the largest
draw wins. A child's draw depends on its own weight only, so when weights change rows move
between the children of the nodes whose weights change and nowhere else; a new region
(:func:`grown`) takes rows only into itself.

Law: ``key``. The shard follows from the key and the tree alone. ``slot`` numbers the rows
of a shard without gaps, in the order of a hash of the key, then key, checksum and size. It
is counted in 4,096 hash buckets of each shard, so no shard passes through one task.

Defined cases: a null key is hashed as the empty text; a null text has no bytes (size 1,
checksum 0), as an empty one; equal rows get neighbouring slots; an empty table stays
empty; columns named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import gapless

BUCKETS = 4096

#: region -> rack -> shard -> weight.
Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(regions: int, racks: int, shards: int) -> Tree:
    """``regions * racks * shards`` shards of weight 1, numbered from 0."""
    n = iter(range(regions * racks * shards))
    return {f"region{i}": {f"rack{i}.{j}": {next(n): 1.0 for _ in range(shards)} for j in range(racks)}
            for i in range(regions)}


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {f"region-of-{new}": {f"rack-of-{new}": {new: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def hash52(text: Column) -> Column:
    """The first 52 bits of the MD5 of a text, as a long."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def draw(key: Column, name: str, weight: float) -> Column:
    """ln(u) / weight, u between 0 and 1 from the key and the child's name."""
    u = (hash52(F.concat(key, F.lit(f"|{name}"))) + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.log(u) / F.lit(weight)


def choose(key: Column, names: list[str], weights: list[float], then: list[Column]) -> Column:
    """The entry of ``then`` whose child draws most (ties: the first)."""
    live = [(n, w, t) for n, w, t in zip(names, weights, then, strict=True) if w > 0]
    if len(live) == 1:
        return live[0][2]
    out = None
    draws = [draw(key, n, w) for n, w, _ in live]
    best = F.greatest(*draws)
    for d, (_, _, t) in reversed(list(zip(draws, live, strict=True))):
        out = t if out is None else F.when(d == best, t).otherwise(out)
    return out


def place(df: DataFrame, key: Column, tree: Tree, out: str) -> DataFrame:
    """``df`` with the shard of ``key`` under ``tree``: one projection for each level."""
    names, weights = list(tree), [_weight(x) for x in tree.values()]
    df = df.withColumn("_key", key).withColumn("_region", choose(F.col("_key"), names, weights, [F.lit(n) for n in names]))
    rack, shard = None, None
    for region, racks in tree.items():
        pick = choose(F.col("_key"), list(racks), [_weight(x) for x in racks.values()], [F.lit(r) for r in racks])
        rack = F.when(F.col("_region") == region, pick) if rack is None else rack.when(F.col("_region") == region, pick)
        for name, shards in racks.items():
            leaf = choose(F.col("_key"), [f"shard{s}" for s in shards], [float(w) for w in shards.values()],
                          [F.lit(s) for s in shards])
            at = F.col("_rack") == name
            shard = F.when(at, leaf) if shard is None else shard.when(at, leaf)
    return df.withColumn("_rack", rack).withColumn(out, shard.cast("int")).drop("_key", "_region", "_rack")


def shard(docs: DataFrame, tree: Tree, more: Tree | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).cast("long").alias("text_crc32"), F.lit("key").alias("law"))
    rows = place(rows, k, tree, "shard")
    rows = place(rows, k, more if more is not None else grown(tree), "grown_shard")
    bucket = F.pmod(hash52(F.concat(F.lit("slot|"), k)), F.lit(BUCKETS))
    return gapless(rows, ["shard"], bucket, [F.col(key), F.col("text_crc32"), F.col("size")], "slot", BUCKETS)
