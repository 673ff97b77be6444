import os
import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tracequarry.llm import simhash
from tracequarry.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps):
    ids = sorted(fps, key=lambda x: (x is None, x))
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                parent[max(a, b, key=ids.index)] = min(a, b, key=ids.index)
    return {i: root(i) for i in ids}


def test_fingerprint_against_the_definition():
    cases = [None, "", " \n\t", "one", "One two", "a b c", "A  B\nc d", "é É x y", "x y", "same same same same same", "w " * 70000]
    for c in cases:
        assert simhash.fingerprint(c) == plain(c), c


def test_golay_decoding():
    code = simhash.Golay()
    pick = random.Random(3)
    for _ in range(300):
        w = np.array([pick.randrange(1 << 23)])
        index = code.index(w)[0]
        assert int(code.error[code.syndrome(w)][0]).bit_count() <= 3
        flips = pick.sample(range(23), 1)[0]
        assert code.index(w ^ (1 << flips))[0] in code.near(w, 23)[1]
    index = code.index(np.arange(1 << 23))
    assert np.bincount(index).tolist() == [2048] * 4096


def test_keys_meet_for_up_to_three_bits():
    pick = random.Random(4)
    base = np.array([pick.getrandbits(64) for _ in range(400)], np.uint64)
    other = base.copy()
    for i in range(len(other)):
        for b in pick.sample(range(64), pick.randint(0, 3)):
            other[i] ^= np.uint64(1 << b)
    stored = {(int(k), int(f)) for k, f in zip(*simhash.keys(base.view(np.int64), False))}
    found = set()
    for k, f in zip(*simhash.keys(other.view(np.int64), True)):
        found.add((int(k), int(f)))
    for x, y in zip(base.view(np.int64).tolist(), other.view(np.int64).tolist()):
        assert {k for k, f in stored if f == x} & {k for k, f in found if f == y}


@pytest.mark.parametrize("hub", [500, 3])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr("tracequarry.llm.components.HUB_ROWS", hub)
    pick = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, 500 + i) for i in range(1, 150)] + [(pick.randrange(1000, 1400), pick.randrange(1000, 1400)) for _ in range(250)]
    edges += [(7, 7), (5, 4), (4, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(spark):
    long = "word " * 5 + " ".join(f"w{i}" for i in range(30000))
    rows = [(5, "same text here"), (3, "SAME text\nhere"), (None, "same text here"), (8, None), (9, ""), (9, ""), (1, long), (2, long + " tail"), (None, "alone it stands")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as component_id")
    got = simhash.cluster(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == sorted([(5, 3), (3, 3), (-1, 3), (8, 8), (9, 8), (9, 8), (1, 1), (2, 1), (-1, -1)])
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in got)
    assert simhash.cluster(docs.limit(0)).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 8]


def test_one_row_of_each_component_stays(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcde"}
    rows = [(None, "a"), (None, "b"), (None, "b"), (7, "c"), (7, "d"), (9, "d"), (None, "e"), (4, "e"), (4, "e")]
    docs = spark.createDataFrame([(i, texts[k], k) for i, k in rows], "doc_id long, text string, k string")
    kept = sorted((r.k, r.doc_id) for r in simhash.keep_first(docs).collect())
    assert kept == [("a", None), ("b", None), ("c", 7), ("d", 7), ("e", 4)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op9_golay_simhash

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    fps = {d.doc_id: plain(d.text) for d in docs}
    want = brute(fps)
    got = op9_golay_simhash(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    assert all(r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == want[r.doc_id] for r in got)
