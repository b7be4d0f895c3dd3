"""Chat formatting: cumulative-snapshot collapse, then rendering.

Logs often hold the same conversation several times, each snapshot one or more turns
longer. Turns of a conversation are ordered by turn number, and a rolling hash over them
gives one hash for every prefix: two independent 64-bit XORs of hashes of (position, role,
text), as window sums. A conversation whose full hash is a proper prefix hash of another
one, or equals the full hash of one with a smaller id, is a snapshot of it and goes (anti
and semi joins on (length, hash)). The rest are maximal and are rendered.

Prefix hashes are made distinct before they meet the join and equal conversations are
reduced to their smallest id, so a first turn or a conversation that a third of the log
shares is one row on either side. Windows stream over a conversation's turns and spill.

A conversation of more than ``LONG_TURNS`` turns or ``LONG_BYTES`` bytes is dealt out in ranges of its
turns: positions and hashes are computed in each range and shifted by what the ranges before
hold, and it is rendered range by range (``parts``). ``format_chats`` joins the parts, so the text of a
kept conversation is one row and cannot pass 2 GB; ``parts`` has no such bound. Turns that share
number, role and the first ``KEY`` characters of a longer text stay in one range.

Defined cases: turns with equal numbers are ordered by role and text, nulls first; null
role or text hash apart from empty ones and render as empty; rows with a null conversation
id form one conversation with a null id, which sorts after all ids; repeated rows are repeated
turns; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


#: Longer conversations are dealt out in ranges of about half this size.
LONG_TURNS, LONG_BYTES = 1 << 14, 1 << 24
KEY = 64


def _order() -> list[Column]:
    """Turns by number, role and text."""
    return [F.asc_nulls_first(c) for c in ("turn", "role", "text")]


def split(turns: DataFrame, most: int = LONG_TURNS, most_bytes: int = LONG_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """The turns of ordinary conversations, and those of long ones with their ``_range``; None if there are none.

    Ranges rise with the order of turns. Equal turns may be in several, as they can change places.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    size = turns.groupBy(F.col("conv_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("_bytes"))
    long = written(size.where((F.col("_n") > most) | (F.col("_bytes") > most_bytes)), "chat-long")
    ranges = long.agg(F.sum(F.ceil(F.greatest(F.col("_n") * 2 / most, F.col("_bytes") * 2 / most_bytes)))).first()[0]
    if ranges is None:
        return turns, None
    ids, same = F.broadcast(long.select("_id")), F.col("conv_id").eqNullSafe(F.col("_id"))
    # Written before they are dealt, so that a turn's salt is the same however often a task runs.
    theirs = written(turns.join(ids, same, "left_semi").withColumn("_salt", F.monotonically_increasing_id()), "chat-turns")
    salt = F.when(F.coalesce(F.length("text") <= KEY, F.lit(True)), F.col("_salt")).otherwise(F.lit((1 << 63) - 1))
    dealt = theirs.repartitionByRange(int(ranges), F.asc_nulls_first("conv_id"), *_order()[:2], F.asc_nulls_first(F.substring("text", 1, KEY)), salt)
    ranged = written(dealt.drop("_salt").withColumn("_range", F.spark_partition_id()), "chat-ranges")
    return turns.join(ids, same, "left_anti"), ranged


def _turn_hashes(df: DataFrame) -> DataFrame:
    """``_a`` and ``_b``: the two hashes of a turn at its position."""
    parts = ("pos", F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit("")))
    return df.withColumn("_a", F.xxhash64(F.lit(1), *parts)).withColumn("_b", F.xxhash64(F.lit("second"), *parts))


def _by_range(ranged: DataFrame, sums: DataFrame) -> DataFrame:
    """``ranged`` with the row of its conversation and range in ``sums``, a few rows for each range."""
    sums = sums.withColumnsRenamed({"conv_id": "_id", "_range": "_at"})
    on = F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("_range") == F.col("_at"))
    return ranged.join(F.broadcast(sums), on).drop("_id", "_at")


def prefix_hashes(ordinary: DataFrame, ranged: DataFrame | None = None) -> DataFrame:
    """(conv_id, pos, hash_a, hash_b, n): every turn's position from 1, the two hashes of the prefix that it ends, and the number of turns."""
    own = Window.partitionBy("conv_id")
    run = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    one = _turn_hashes(ordinary.withColumn("pos", F.row_number().over(own.orderBy(*_order())).cast("long")))
    out = one.select("conv_id", "pos", F.bit_xor("_a").over(run).alias("hash_a"), F.bit_xor("_b").over(run).alias("hash_b"),
                     F.max("pos").over(own).alias("n"))
    if ranged is None:
        return out
    before, mine = own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv_id", "_range")
    count = ranged.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    count = count.select("conv_id", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(own).alias("n"))
    placed = _by_range(ranged, count).withColumn("pos", F.col("_before") + F.row_number().over(mine.orderBy(*_order())))
    one = _turn_hashes(placed).select("conv_id", "_range", "pos", "_a", "_b", "n")
    carry = one.groupBy("conv_id", "_range").agg(F.bit_xor("_a").alias("_a"), F.bit_xor("_b").alias("_b"))
    carry = carry.select("conv_id", "_range", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")).alias(f"{c}0") for c in ("_a", "_b")])
    run = mine.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return out.unionByName(_by_range(one, carry).select(
        "conv_id", "pos", F.bit_xor("_a").over(run).bitwiseXOR(F.col("_a0")).alias("hash_a"),
        F.bit_xor("_b").over(run).bitwiseXOR(F.col("_b0")).alias("hash_b"), "n"))


def maximal(ordinary: DataFrame, ranged: DataFrame | None = None) -> DataFrame:
    """(conv_id, n_turns, n_snapshots) of the conversations that no other one continues.

    ``n_snapshots`` counts the conversations equal to it, itself included.
    """
    each = prefix_hashes(ordinary, ranged)
    full = (each.where(F.col("pos") == F.col("n"))
            .groupBy("pos", "hash_a", "hash_b")
            .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_snapshots")))
    proper = each.where(F.col("pos") < F.col("n")).select("pos", "hash_a", "hash_b").distinct()
    return (full.join(proper, ["pos", "hash_a", "hash_b"], "left_anti")
            .select("conv_id", F.col("pos").alias("n_turns"), "n_snapshots"))


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(CLOSE + "\n"))


def _rendered(turns: DataFrame, kept: DataFrame, *by: str) -> DataFrame:
    """The turns of the ``kept`` conversations as one text for each of them and of ``by``."""
    mine = kept.withColumnRenamed("conv_id", "_id")
    one = F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("t"), F.col("turn").isNotNull().alias("k"),
                   F.struct(F.col("role"), F.col("text")).alias("body"))
    whole = (turns.join(F.broadcast(mine) if by else mine, turns["conv_id"].eqNullSafe(mine["_id"]))
             .groupBy("conv_id", "n_turns", "n_snapshots", *by).agg(F.sort_array(F.collect_list(one)).alias("all")))
    chat = F.array_join(F.transform("all", lambda x: rendered(x["body"]["role"], x["body"]["text"])), "")
    return whole.select("conv_id", "n_turns", "n_snapshots", *by, chat.alias("chat"))


def _parts(turns: DataFrame, most: int, most_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """The kept ordinary conversations, and the parts of the kept long ones."""
    ordinary, ranged = split(turns, most, most_bytes)
    kept = maximal(ordinary, ranged)
    if ranged is None:
        return _rendered(ordinary, kept), None
    kept = written(kept, "chat-kept")
    ids = ranged.select(F.col("conv_id").alias("_long")).distinct()
    theirs = kept.join(F.broadcast(ids), F.col("conv_id").eqNullSafe(F.col("_long")), "left_semi")
    return _rendered(ordinary, kept), _rendered(ranged, theirs, "_range").withColumnRenamed("_range", "part")


def parts(turns: DataFrame, most: int = LONG_TURNS, most_bytes: int = LONG_BYTES) -> DataFrame:
    """(conv_id, n_turns, n_snapshots, part, chat): the maximal conversations, long ones in parts of rising number."""
    whole, cut = _parts(turns, most, most_bytes)
    whole = whole.withColumn("part", F.lit(0)).select("conv_id", "n_turns", "n_snapshots", "part", "chat")
    return whole if cut is None else whole.unionByName(cut)


def format_chats(turns: DataFrame, most: int = LONG_TURNS, most_bytes: int = LONG_BYTES) -> DataFrame:
    """(conv_id, n_turns, n_snapshots, chat): the maximal conversations, rendered."""
    whole, cut = _parts(turns, most, most_bytes)
    if cut is None:
        return whole
    joined = cut.groupBy("conv_id", "n_turns", "n_snapshots").agg(F.sort_array(F.collect_list(F.struct("part", "chat"))).alias("all"))
    return whole.unionByName(joined.withColumn("chat", F.array_join(F.col("all.chat"), "")).drop("all"))
