import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tracequarry.llm import bpe, mapped  # noqa: E402
from tracequarry.llm import word_transducer as wt  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL = bpe.read_model(PATH)
OWN = tokenizers.Tokenizer.from_file(PATH)
CASES = [
    "", " ", "  ", "a", "Hello World's don't  we'll", "x  y", "x  y", "été É é 北京 🙂🙂 ‍", "<|endoftext|>", "a<|endoftext|>B <|startoftext|><|endoftext|>c",
    "<|endoftext", "J̌ ẞ İ K ΣΣ ΑΣ", "-" * 37, "aaaa " * 9, "\t\t x\t", "0123456789 12 3", "word,\nWord. x", "\x0b a\x1c b\x0cz", "a﻿ b", "\x85 a\x85b", "́ a ́",
    "x y", "ﬁ Ⅷ ①②", "\0 a\0b", "'S 's' ''s", "q" * 3000,
]


def noise(n):
    pick = random.Random(5)
    pool = ["a", "b", " ", "  ", "\n", " ", "é", "É", "-", "--", "'s", "1", "🙂", "the", " The", ".", "\t", "aa", "́", "İ", "<|endoftext|>", "<|", "Σ"]
    return ["".join(pick.choice(pool) for _ in range(pick.randint(0, 40))) for _ in range(1500)]


def entries(words):
    ids, n = wt.Words.of(MODEL).merge(words)
    cuts = np.concatenate([[0], np.cumsum(n)])
    return [(w.encode(), tuple(ids[a:b].tolist())) for w, a, b in zip(words, cuts, cuts[1:])]


def test_minimal_and_exact():
    words = sorted({a + b for a in ["walk", "talk", "stalk", "jump", "é"] for b in ["", "s", "ing", "ings", "ed"]}, key=str.encode)
    told = entries(words)
    lex = wt.compile_words(told)
    held, ids, n = wt.look_up(lex, pa.array([*words, "wal", "walkx", "", "zz"], pa.large_string()))
    assert held.tolist() == [True] * len(words) + [False] * 4
    cuts = np.concatenate([[0], np.cumsum(n)])
    assert [tuple(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:])][: len(words)] == [i for _, i in told]
    # no two states go on alike: every state's arcs, ids and end are its own
    sides = {}
    for key, target, out in zip(lex["keys"].tolist(), lex["target"].tolist(), lex["out"].tolist()):
        sides.setdefault(key // 256, []).append((key % 256, target, out))
    alike = [(lex["end"][s], tuple(sides.get(s, ()))) for s in range(len(lex["end"]))]
    assert len(set(alike)) == len(alike) < len({w[:k] for w, _ in told for k in range(len(w) + 1)})
    assert (np.diff(lex["keys"]) > 0).all()
    none = wt.compile_words([])
    assert not wt.look_up(none, pa.array(["a", ""], pa.large_string()))[0].any()


@pytest.mark.parametrize("share", [0, 2, 1])
def test_same_ids_as_the_library(tmp_path, share):
    texts = pa.array([*CASES, *noise(5), None], pa.string())
    model = wt.Words.of(MODEL)
    flat, _ = model.split(wt._chunks(texts)[0].unique())
    words = sorted({w for w in flat if not w.startswith("\0")}, key=str.encode)[:: share or 10**9]
    path = tmp_path / "lexicon"
    path.write_bytes(mapped.packed(wt.compile_words(entries(words) if share else [])))
    enc = wt.Encoder(model, mapped.opened(str(path)))
    ids, bounds = enc.encode(texts)
    data, edges = wt._decoded(enc, ids, bounds)
    for i, t in enumerate(texts.to_pylist()):
        want = OWN.encode(t or "", add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want, repr(t)
        assert data[slice(*edges[i])].decode() == OWN.decode(want, skip_special_tokens=False)
    assert enc.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_frequent_words_are_counted_over_all_rows(spark):
    rows = [("b a",), ("A  a\nb",), (None,), ("",), ("c " * 50,), ("<|endoftext|> a <|endoftext|>",)]
    counts = wt.word_counts(spark.createDataFrame(rows, "text string").repartition(3), MODEL)
    assert {r.word: r.n for r in counts.collect()} == {"a": 4, "b": 2, "c": 50, "\0<|endoftext|>": 2}
    assert wt.frequent_words(counts) == ["a", "b", "c"]
    assert wt.frequent_words(counts, 2) == ["a", "c"] and wt.frequent_words(counts, 1) == ["c"]
    assert wt.frequent_words(counts, 0) == []


def test_digests_and_encode(spark):
    rows = [("x", t, 1) for t in [*CASES, None, "Hello", "Hello"]]
    docs = spark.createDataFrame(rows, "doc_id string, text string, ids int")
    coded = wt.encode(docs, MODEL).collect()
    want = [OWN.encode(t or "", add_special_tokens=False).ids for _, t, _ in rows]
    assert sorted((r.ids, r.decoded) for r in coded) == sorted((w, OWN.decode(w, skip_special_tokens=False)) for w in want)
    got = sorted((r.n_tokens, r.ids_sha256) for r in wt.digests(docs, MODEL).collect())
    assert got == sorted((len(w), hashlib.sha256(np.array(w, "<u4").tobytes()).hexdigest()) for w in want)
    assert wt.digests(docs.limit(0), MODEL).count() == 0
    assert wt.digests(docs.withColumn("doc_id", docs.ids), MODEL).schema["doc_id"].dataType.simpleString() == "int"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op12_word_transducer

    got = {r.doc_id: r for r in op12_word_transducer(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = OWN.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(OWN.decode(ids, skip_special_tokens=False).encode()).hexdigest()
