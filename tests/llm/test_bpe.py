import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from tracequarry.llm import bpe  # noqa: E402

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
MODEL = bpe.model_from_ranks(RANKS, public_tokenizers.PATTERN)
TIK = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CASES = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n  b", "\n\n a", "don't  we'll", "x\u00a0 y", "x \u2003y", "été 北京 🙂🙂 \u200d",
    "<|endoftext|>", "a <|endoftext|> b", "-" * 37, "aaaa " * 9, "  " * 17 + "x", "\t\t x\t", "0123456789 12 3", "word,\nWord. x", "\x0b a\x1c b", "a\ufeff b", "\x85 a",
]


def noise(n):
    pick = random.Random(5)
    pool = ["a", "b", " ", "  ", "\n", "\u00a0", "é", "-", "--", "'s", "1", "🙂", "the", " the", ".", "\t", "\u2028", "aa", "   "]
    return ["".join(pick.choice(pool) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def check(texts):
    ids, bounds = bpe.Codec(MODEL).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == TIK.encode_ordinary(t or ""), repr(t)


def test_same_ids_as_the_rank_library():
    check(CASES + noise(3000))
    check([])


def test_json_model_gives_the_librarys_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    texts = CASES + noise(500)
    ids, bounds = bpe.Codec(bpe.read_model(path)).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == own.encode(t, add_special_tokens=False).ids, repr(t)


def test_offsets_and_decoding(spark):
    rows = [(i, t, "x") for i, t in enumerate([*CASES, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode(docs, MODEL)
    for row in coded.collect():
        text = rows[row.doc_id][1] or ""
        raw = text.encode()
        assert row.ids == TIK.encode_ordinary(text)
        at = 0
        for tid, start, char in zip(row.ids, row.byte_starts, row.char_starts):
            assert start == at
            assert len(raw[: start + 1].decode("utf-8", "ignore")) in (char, char + 1)
            at += len(TIK.decode_single_token_bytes(tid))
    for row in bpe.decode(coded, MODEL).collect():
        assert row.text == (rows[row.doc_id][1] or "")
        assert bytes(row.data).decode() == row.text


def test_split_character_decodes_to_replacement_only_when_alone(spark):
    ids = TIK.encode_ordinary("🙂")
    df = spark.createDataFrame([(1, ids), (2, ids[:1]), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(df, MODEL).collect()}
    assert got[1] == "🙂" and "�" in got[2] and got[3] == ""


def test_digests(spark):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (None, None), (2, ""), (3, "long " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    got = bpe.digests(docs, MODEL).collect()
    want = []
    for doc, text in rows:
        ids = TIK.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: (r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe.digests(docs.limit(0), MODEL).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op1_byte_bpe

    got = {r.doc_id: r for r in op1_byte_bpe(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = TIK.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
