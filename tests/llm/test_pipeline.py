"""The pipeline's stages against plain versions, each on what the stage before kept."""

import zlib
from collections import Counter

import corpus_pipeline
import pytest
from formspark.llm import langid
from formspark.llm._tables import written
from formspark.llm.queries import remainder
from pyspark.sql import functions as F

from . import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(llm):
    docs, out = llm.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, written(stage(llm, docs, SF), "test-stage")))
        docs = out[-1][1]
    return out


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_follow_the_plan():
    words = ("language", "jaccard", "decontamination", "mixing", "sharding")
    assert [w in name.lower() for w, (name, _) in zip(words, corpus_pipeline.STAGES, strict=True)] == [True] * 5


def test_language_keeps_what_the_network_accepts(kept):
    before, after = kept[0]
    net = langid.fit(before, remainder("doc_id", 5) != 0)
    want = langid.predict(before, net).where("lang_pred <> 'und' and score >= 0.5")
    assert sorted(pairs(want)) == sorted(pairs(after)) and before.columns == after.columns
    assert after.count() > 0.9 * before.count()


def test_one_document_of_each_group_stays(kept):
    before, after = kept[1]
    groups = plain.groups(pairs(before), 5, 80)
    assert sorted(k for k, _ in pairs(after)) == sorted({c for _, _, c in groups}) and before.columns == after.columns


def test_contaminated_documents_go(llm, kept):
    before, after = kept[2]
    items = [tuple(r) for r in llm.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {k for k, _ in plain.leaks(pairs(before), items)}
    assert sorted(k for k, _ in pairs(after)) == sorted(k for k, _ in pairs(before) if k not in bad)


def test_mix_repeats_rows(kept):
    before, after = kept[3]
    assert before.columns == after.columns
    words = {k: len((t or "").encode().split()) for k, t in pairs(before)}
    source = {r.doc_id: r.source for r in before.collect()}
    copies = Counter(k for k, _ in pairs(after))
    target = plain.targets(Counter({s: sum(words[k] for k in words if source[k] == s) for s in set(source.values())}))
    assert set(copies) <= set(words) and max(copies.values()) <= 2
    for s, t in target.items():
        mine = [words[k] for k in words if source[k] == s]
        whole = int(t // sum(mine)) if sum(mine) else 0
        reach = 1  # all sums of subsets, as bits
        for n in mine:
            reach |= reach << n
        rest = round(t - whole * sum(mine))
        best = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
        assert sum(words[k] * copies[k] for k in words if source[k] == s) == whole * sum(mine) + best


def test_shards_hold_every_row(kept):
    before, after = kept[4]
    assert Counter(r.doc_id for r in after.collect()) == Counter(k for k, _ in pairs(before))
    per = after.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.countDistinct("slot"), F.count("*")).collect()
    assert all(r[1] == 0 and r[2] + 1 == r[3] == r[4] for r in per)


def test_run_gives_the_same(llm, kept):
    got = corpus_pipeline.run(llm, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept[-1][1].collect()))
    assert zlib.crc32(b"") == 0


def test_every_clean_document_stays(llm, docs):
    whole = [tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    by = {lang: [t for _, t, x in whole if x == lang and len(t) > 400] for lang in sorted({x for _, _, x in whole})}
    short = [" ".join(t.split()[:n]) for texts in by.values() for t in texts[:8] for n in (1, 2, 3)]
    short = [t for t in short if any(c.isalpha() for c in t)]
    mixed = ["\n".join(texts[i][:300] for texts in list(by.values())[k:k + n])
             for n in (2, 3, 4) for k in range(len(by) - n + 1) for i in range(min(map(len, by.values())))]
    digits = [f"{t[:40]} " + "0123456789 " * 60 for texts in by.values() for t in texts[:4]]
    clean = whole + [(10**6 + i, t, next(iter(by))) for i, t in enumerate(short + mixed + digits)]
    none = [(-1, None, "en"), (-2, "", "en"), (-3, "12 -- 3 !", "en")]
    got = corpus_pipeline.language(llm, docs(clean + none), SF)
    assert len(by) == 4 and len(mixed) >= 6 and sorted(pairs(got)) == sorted(x[:2] for x in clean)
    assert langid.predict(docs(clean), langid.fit(docs(whole), F.lit(True))).where("score < 0.5").count() > 0


def test_nothing_is_rejected_for_want_of_labels(llm, docs):
    got = corpus_pipeline.language(llm, docs([(1, "some words", None), (2, "12", None), (3, None, None)]), SF)
    assert pairs(got) == [(1, "some words")]
