"""Language ID: gradients, pooling and held-out accuracy."""

import numpy as np
import pytest
from formspark.llm import langid
from formspark.llm.queries import op3_language_id
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def loss(net, seq, label):
    p = net.probabilities(net.states(np.stack([seq, seq[:, ::-1]])))
    return -np.log(p[:, np.arange(len(label)), label]).mean()


def test_gradient_by_differences():
    r = np.random.default_rng(3)
    net = langid.Network(["a", "b", "c"], hidden=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    seq, label = r.integers(97, 104, (5, 9)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    g = net.gradient(seq, label)
    for name, x in net.p.items():
        for _ in range(6):
            at = tuple(r.integers(s) for s in x.shape)
            if name == "x":
                at = (at[0], int(r.integers(97, 104)), at[2])
            was = x[at]
            x[at] = was + 1e-2
            up = loss(net, seq, label)
            x[at] = was - 1e-2
            down = loss(net, seq, label)
            x[at] = was
            assert g[name][at] == pytest.approx((up - down) / 2e-2, rel=2e-2, abs=2e-5)


def test_pooled_reads_every_byte_of_every_row():
    net = langid.Network(["a", "b"], seed=2)
    r = np.random.default_rng(4)
    rows = [bytes(r.integers(97, 123, n).astype(np.uint8)) for n in (0, 1, 7, 16, 17, 100, 3, 33)]
    data, off = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0] + [len(x) for x in rows])
    got = net.pooled(data, off, segment=16, lanes=3)
    for row, p in zip(rows, got):
        parts = -(-len(row) // 16)
        cuts = [len(row) * i // max(parts, 1) for i in range(parts + 1)]
        total = np.zeros(2)
        for a, b in zip(cuts, cuts[1:]):
            seq = np.frombuffer(row[a:b], np.uint8)[None]
            total += net.probabilities(net.states(np.stack([seq, seq[:, ::-1]]))).sum(axis=(0, 1))
        assert p == pytest.approx(total / max(len(row), 1), abs=1e-5)


def test_held_out_accuracy(llm):
    got = op3_language_id(llm, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = llm.read.parquet(f"{SF}/documents.parquet").where("lang is not null and length(text) > 60").select("doc_id", "lang")
    hit = got.where("held_out").join(truth, "doc_id").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert hit[1] > 100 and hit[0] > 0.95
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_defined_cases(docs):
    english, german = "the cat and the dog were there with her " * 5, "der hund und die katze sind nicht dort " * 5
    rows = [(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(20)]
    rows += [(90, None, "en"), (91, "", None), (92, "123 ... !", "de"), (None, english, None), (94, german * 400, None), (None, None, None)]
    df = docs(rows).withColumns({"held_out": F.lit(1), "l": F.lit("x"), "score": F.lit("x")})
    net = langid.fit(df, F.lit(True), steps=60)
    assert net.labels == ["de", "en"]
    got = {(r.doc_id, (r.text or "")[:3]): (r.lang_pred, r.score) for r in langid.predict(df, net).collect()}
    assert got[90, ""] == got[91, ""] == got[92, "123"] == got[None, ""] == ("und", 0.0)
    assert got[None, "the"][0] == "en" and got[94, "der"][0] == "de" and 0.5 < got[94, "der"][1] <= 1
    none = langid.fit(docs([(1, english, None)]), F.lit(True))
    assert none is None and langid.predict(docs(rows), none).first().lang_pred == "und"
    assert langid.predict(docs([]), net).count() == 0


def test_every_label_is_learned(docs):
    names = [f"l{i:02d}" for i in range(70)]
    letters = [chr(97 + i % 26) + chr(97 + (i % 26 + 1 + i // 26) % 26) for i in range(70)]
    rows = [(i, letters[i % 70] * 40, names[i % 70]) for i in range(70 * 4) if i % 70 < 60 or i < 70]
    df = docs(rows)
    drawn = [r["l"] for r in langid.training_rows(df, F.lit(True), "doc_id", "text", "lang", all_languages=140)]
    assert sorted(set(drawn)) == names and max(drawn.count(x) for x in names) == 2
    net = langid.fit(df, F.lit(True))
    assert net.labels == names
    got = langid.predict(df, net).select("lang", "lang_pred", "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.9
    assert np.mean([r.lang == r.lang_pred for r in got if r.lang >= "l60"]) >= 0.8


def test_many_labels_in_small_batches(monkeypatch):
    net = langid.Network(["a", "b", "c"], seed=2)
    text = "".join(chr(97 + i * i % 26) for i in range(900)).encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, 0, 5, 300, 301, 900])
    want = net.best(data, off)
    monkeypatch.setattr(langid, "LANE_CELLS", 4)
    monkeypatch.setattr(langid, "ROW_CELLS", 6)
    got = net.best(data, off)
    assert want[0].tolist() == got[0].tolist() and want[1] == pytest.approx(got[1], abs=1e-6)
