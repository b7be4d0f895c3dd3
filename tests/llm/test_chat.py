"""Chat snapshots against comparing all conversations."""

import random

from formspark.llm import chat
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"
first = lambda x: (x is not None, x if x is not None else 0)  # noqa: E731  nulls first


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t, role, text))
    body = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: (first(y[0]), y[1] is not None, y[1] or "", y[2] is not None, y[2] or ""))]
            for c, v in convs.items()}
    out = []
    for c, b in body.items():
        equal = [d for d, x in body.items() if x == b]
        longer = any(len(x) > len(b) and x[:len(b)] == b for x in body.values())
        ids = [d for d in equal if d is not None]
        if not longer and c == (min(ids) if ids else None):
            out.append((c, len(b), len(equal), "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in b)))
    return sorted(out, key=str)


def test_snapshots(llm):
    r = random.Random(2)
    rows = []
    for i in range(60):
        n = r.randrange(1, 6)
        rows += [(i, t, "user" if t % 2 else "assistant", r.choice("ab")) for t in range(n)]
    got = chat.format_chats(llm.createDataFrame(rows, TURNS).repartition(4))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_defined_cases(llm):
    rows = [(1, 0, "user", "a"), (1, 1, None, None), (2, 0, "user", "a"), (2, 1, "", ""), (3, 0, "user", "a"), (None, 0, "user", "z"),
            (None, 1, "bot", "y"), (4, 0, "user", "z"), (5, None, "x", "1"), (5, 0, "x", "2"), (6, 0, "x", "2"), (6, 0, "x", "1"),
            (7, 3, "x", "1"), (7, 9, "x", "2"), (8, 0, "u", "w" * 100_000), (9, 0, "u", "q"), (9, 0, "u", "q")]
    df = llm.createDataFrame(rows, TURNS).withColumns({c: F.lit("z") for c in ("pos", "n", "chat", "_a", "hash_a")})
    assert sorted(map(tuple, chat.format_chats(df).collect()), key=str) == brute(rows)
    assert chat.format_chats(llm.createDataFrame([], TURNS)).count() == 0


def test_long_conversations_are_dealt_out(llm):
    r = random.Random(4)
    body = [(r.choice([None, 0, 1, *range(40)]), r.choice([None, "u", "b"]), r.choice([None, "", "x", "y", "w" * 70, "w" * 70 + "z"])) for _ in range(400)]
    body += [(7, "u", "again")] * 200
    rows = [(c, *x) for c in (None, 3, 5) for x in body] + [(9, i, "u", str(i % 7)) for i in range(300)]
    rows += [(8, i, "u", str(i % 7)) for i in range(290)] + [(2, i, "u", str(i % 7)) for i in range(12)]
    rows += [(100 + i, t, "u", str(r.randrange(3))) for i in range(30) for t in range(r.randrange(1, 5))]
    df = llm.createDataFrame(rows, TURNS).repartition(4)
    assert sorted(map(tuple, chat.format_chats(df, most=16).collect()), key=str) == brute(rows)
    assert sorted(map(tuple, chat.format_chats(df, most_bytes=2000).collect()), key=str) == brute(rows)
    ordinary, ranged = chat.split(df, most=16)
    assert ordinary.groupBy("conv_id").count().agg(F.max("count")).first()[0] <= 16
    assert ranged.groupBy("conv_id", "_range").count().agg(F.max("count")).first()[0] < 100
    cut = {}
    for x in sorted(chat.parts(df, most=16).collect(), key=lambda x: x.part):
        cut.setdefault((x.conv_id, x.n_turns, x.n_snapshots), []).append(x.chat)
    assert sorted(((*k, "".join(v)) for k, v in cut.items()), key=str) == brute(rows)
    assert max(map(len, cut.values())) > 20
