"""Sharding by the hash tree."""

import zlib
from collections import Counter

from formspark.llm import sharding
from pyspark.sql import functions as F


def placed(llm, tree, n=4000):
    df = sharding.place(llm.range(n).withColumn("k", F.col("id").cast("string")), F.col("k"), tree, "shard")
    return {r.id: r.shard for r in df.collect()}


def test_weights_and_movement(llm):
    tree = sharding.even_tree(2, 2, 2)
    before = placed(llm, tree)
    assert set(before.values()) == set(range(8)) and max(Counter(before.values()).values()) < 1.25 * 500
    after = placed(llm, sharding.grown(tree))
    assert {after[k] for k in before if after[k] != before[k]} == {8} and 300 < Counter(after.values())[8] < 600
    # A heavier shard draws rows to its rack and region; rows stay where no weight on their way changes.
    heavy = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    heavy["region0"]["rack0.0"][0] = 4.0
    moved = placed(llm, heavy)
    other = {s for k, s in moved.items() if moved[k] != before[k]}
    assert other <= {0, 1, 2, 3} and Counter(moved.values())[0] > 1000
    assert placed(llm, {"a": {"b": {0: 0.0, 1: 1.0}}}, 50) == dict.fromkeys(range(50), 1)


def test_shards_and_slots(docs):
    rows = [(i, "text é %d" % (i % 7)) for i in range(500)] + [(None, None), (None, None), (3, "text é 3"), (501, ""), (502, "w" * 200_000)]
    df = docs(rows).withColumns({c: F.lit("z") for c in ("size", "shard", "slot", "_key", "_bucket", "law")})
    got = sharding.shard(df, sharding.even_tree(2, 2, 4)).collect()
    want = sorted((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows if k is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == want and len(got) == len(rows)
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    by = {}
    for r in got:
        assert by.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard) and r.grown_shard in (r.shard, 16) and r.law == "key"
    assert sharding.shard(docs([]), sharding.even_tree(2, 2, 4)).count() == 0
