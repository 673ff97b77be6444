import hashlib
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")
pytest.importorskip("tokenizers")

from tracequarry.llm import alignment, bpe  # noqa: E402

A = bpe.read_model(public_tokenizers.path("byte_bpe_50k.json"))
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    B = f.read()
A_BYTES, B_BYTES = alignment.a_bytes(A), alignment.b_bytes(B)
MODELS = alignment.Aligner(A, B)
CASES = ["", " ", "  ", " a", "a ", "▁", "x▁ y", "a ▁", "<|endoftext|>", "a▁ ▁b", " ▁a", "été 北京 🙂🙂", "<s> <0x41> \0 b", "a\nb  c", "-" * 50, "word " * 300, "z" * 5000]


def groups(text):
    """Ids of A and B of each group, by going through both texts byte by byte."""
    if not text:
        return []
    a, b = MODELS.a.encode(" " + text, add_special_tokens=False).ids, MODELS.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(A_BYTES[i] for i in a) != raw or b"".join(B_BYTES[i] for i in b) != raw:
        return []
    out, now = [], ([], [])
    i = j = at_a = at_b = 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            now[0].append(a[i])
            at_a, i = at_a + len(A_BYTES[a[i]]), i + 1
        else:
            now[1].append(b[j])
            at_b, j = at_b + len(B_BYTES[b[j]]), j + 1
        if at_a == at_b:
            out.append(now)
            now = ([], [])
    return out


def answer(rows):
    """The query's rows by brute force."""
    found = [(doc, groups(text)) for doc, text in rows]
    count = Counter((g[0][-1], g[1][-1]) for _, gs in found for g in gs)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for doc, gs in found:
        links = [(g[0][-1], g[1][-1]) for g in gs]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((
            doc, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(gs), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if gs else "",
        ))
    return out


def noise(n):
    pick = random.Random(5)
    pool = ["a", "b", " ", "  ", "\n", " ", "é", "-", "--", "'s", "1", "🙂", "the", " the", ".", "\t", " ", "aa", "   ", "▁"]
    return ["".join(pick.choice(pool) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def test_groups_of_any_text():
    texts = [*CASES, *noise(1500), None]
    found = MODELS.align(pa.array(texts, pa.string()))
    keys, bounds = found.links()
    for i, (text, shown) in enumerate(zip(texts, found.shown())):
        want = groups(text)
        assert bytes(shown).decode() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want), repr(text)
        assert keys[bounds[i] : bounds[i + 1]].tolist() == [a[-1] << 32 | b[-1] for a, b in want]
    assert found.sums("n_a").tolist() == [sum(len(a) for a, _ in groups(t)) for t in texts]


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    own = alignment.Aligner(A, B)
    for a in range(0, 300, 60):
        texts = [f"w{i} common w{i + 1}" for i in range(a, a + 60)]
        got = own.align(pa.array(texts, pa.string()))
        assert got.sums("groups").tolist() == [len(groups(t)) for t in texts]
        assert len(own.memo) <= 50
    assert "common" in own.memo.column("word").to_pylist()


def test_no_more_pairs_than_suffixes_allow():
    assert alignment.most_pairs([b"a", b"ba"], [b"a", b"cba"]) == 4  # a-a, ba-a, a-cba, ba-cba
    assert 300_000 < alignment.most_pairs(A_BYTES, B_BYTES) < 350_000


def test_pair_counts_and_table(spark):
    pick = np.random.default_rng(1)
    rows = [([int(k) for k in pick.integers(0, 50, 30)], [int(n) for n in pick.integers(1, 9, 30)]) for _ in range(40)]
    want = Counter()
    for ks, ns in rows:
        for k, n in zip(ks, ns):
            want[k << 32 | k % 7] += n
    df = spark.createDataFrame([([k << 32 | k % 7 for k in ks], ns) for ks, ns in rows], "__keys array<long>, __times array<long>")
    table = alignment.count_table(alignment.pair_counts(df, 4))
    assert dict(zip(table["keys"].tolist(), table["n"].tolist())) == want and (np.diff(table["keys"]) > 0).all()
    top = {b: max(n for k, n in want.items() if k & 0xFFFFFFFF == b) for b in range(7)}
    assert table["best"].tolist() == [int(n == top[k & 0xFFFFFFFF]) for k, n in zip(table["keys"].tolist(), table["n"].tolist())]


def test_small_rows(spark):
    rows = [(str(i), t) for i, t in enumerate(CASES)] + [(None, "the end"), ("d", "the end"), ("d", "the end"), ("n", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, n_a int").repartition(3)
    got = alignment.align(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(answer(rows), key=str)
    assert alignment.align(docs.limit(0), A, B).count() == 0
    assert alignment.align(docs.where("text is null"), A, B).collect()[0].n_links == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op11_pair_counts

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, op11_pair_counts(spark, "/root/testdata/sf0.01").collect())) == sorted(answer(map(tuple, docs)))
