import math
import os
import random
from collections import Counter

import numpy as np
import pytest

from tracequarry.llm import lm_scoring as lm


def plain_words(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\f\r" else c for c in text or "").split(" ") if w]


def test_tokens_are_words():
    texts = ["A b", None, "", "  a\tb  c", "x" * 200 + " é", "a"]
    hashes, text = lm.tokens(texts)
    want = [(i, w) for i, t in enumerate(texts) for w in plain_words(t)]
    assert text.tolist() == [i for i, _ in want]
    by = {}
    for h, (_, w) in zip(hashes.tolist(), want):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    assert lm.tokens([])[0].tolist() == []


def brute(rows, target):
    """The model's formulas on plain dictionaries: equal as long as no slots collide."""
    def count(texts):
        uni, bi = Counter(), Counter()
        for t in texts:
            w = plain_words(t)
            uni.update(w)
            bi.update(zip(w, w[1:]))
        return uni, bi

    back, tgt = count(t for _, t in rows), count(t for i, t in rows if i in target)
    n_b, n_t = sum(back[0].values()), sum(tgt[0].values())
    out = {}
    for i, t in rows:
        w, losses = plain_words(t), []
        for (uni, bi), by in ((tgt, 1.0), (back, n_t / n_b)):
            total = 0.0
            for k, x in enumerate(w):
                pooled = (back[0][x] + 1) / (n_b + lm.WORD_SLOTS)
                p = (uni[x] * by + lm.POOLED * pooled) / (n_t + lm.POOLED)
                if k:
                    c = bi[w[k - 1], x] * by
                    p = (c + lm.BACKOFF * p) / (max(uni[w[k - 1]] * by, c) + lm.BACKOFF)
                total -= math.log(p)
            losses.append(total / len(w) if w else None)
        out[i] = (len(w), losses[0], losses[1])
    return out


@pytest.mark.parametrize("run", [lm.RUN_BYTES, 40])
def test_scores_against_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(lm, "RUN_BYTES", run)  # with 40 bytes most texts are cut into runs
    pick = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(pick.choices(vocab[:30] if i % 3 else vocab[20:], k=pick.randint(1, 60)))) for i in range(90)] + [(900, None), (901, ""), (902, "Qq " * 3000)]
    target = {i for i in range(0, 90, 3)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as slot", "2 as n")
    ids = spark.createDataFrame([(i,) for i in target] + [(0,), (12345,), (None,)], "doc_id long")
    want = brute(rows, target)
    got = {r.doc_id: r for r in lm.score(docs, ids).collect()}
    assert len(got) == len(rows)
    for i, (n, t, b) in want.items():
        assert got[i].n_tokens == n
        if n:
            assert abs(got[i].target_loss - t) < 1e-4 and abs(got[i].background_loss - b) < 1e-4
            assert abs(got[i].score - (t - b)) < 1e-4
        else:
            assert got[i].target_loss is None and got[i].score is None
    mean = lambda keep: np.mean([got[i].score for i in range(90) if keep(i)])
    assert mean(lambda i: i in target) < mean(lambda i: i not in target)


def test_without_target(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    got = lm.score(docs, docs.select("doc_id").limit(0)).collect()
    assert len(got) == 3 and all(abs(r.score) < 1e-12 for r in got)
    assert lm.score(docs.limit(0), docs).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query(spark):
    from tracequarry.llm.queries import op3_cross_entropy_difference

    got = op3_cross_entropy_difference(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.score is not None for r in got if r.n_tokens)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark, monkeypatch):
    from tracequarry.llm.queries import op3_cross_entropy_difference

    monkeypatch.setattr(lm, "CHUNK_BYTES", 300_000)  # several chunks, which share words
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    want = brute(rows, target)
    got = op3_cross_entropy_difference(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        n, t, b = want[r.doc_id]
        assert r.n_tokens == n
        assert r.score is None if not n else abs(r.target_loss - t) < 1e-6 and abs(r.background_loss - b) < 1e-6


def test_more_words_than_any_table_of_slots(spark):
    vocab = [" ".join(f"a{k}_{i}" for i in range(1000)) for k in range(300)]  # 300,000 words, each once
    docs = spark.createDataFrame(list(enumerate(vocab)), "doc_id long, text string").repartition(4)
    got = lm.score(docs, docs.where("doc_id < 30").select("doc_id")).collect()
    want = brute(list(enumerate(vocab)), set(range(30)))
    assert all(abs(r.target_loss - want[r.doc_id][1]) < 1e-6 and abs(r.background_loss - want[r.doc_id][2]) < 1e-6 for r in got)


def test_long_words_do_not_share_a_hash():
    a, b = "x" + "a" * 63 + "y" + "b" * 63, "y" + "a" * 63 + "x" + "b" * 63
    assert len(set(lm.tokens([a, b])[0].tolist())) == 2


def test_very_long_texts_take_bounded_memory():
    import pyarrow as pa
    import tracemalloc

    text = " ".join(f"word{i % 5000}" for i in range(4_000_000))  # 37 MB
    part = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
    tracemalloc.start()
    runs = lm._runs(part, 7)
    peak = 0
    for r in runs:
        lm.grams(r.column("text").to_pylist(), r.column("lead").to_numpy(zero_copy_only=False))
        peak = max(peak, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert len(runs) > 30 and peak < 200_000_000
    counted = sum(int(lm.grams(r.column("text").to_pylist(), r.column("lead").to_numpy(zero_copy_only=False))[5].sum()) for r in runs)
    assert counted == 4_000_000


def test_very_long_words():
    a = "x" * 5_000_000
    hashes, text = lm.tokens([f"{a} b {a}y", a, "b"])
    assert text.tolist() == [0, 0, 0, 1, 2]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3
