import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from tracequarry.llm import prefix_trie


def answer(rows):
    """All nodes by listing every beginning of every rebuilt conversation."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + said[h:])
    nodes = {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            nodes.setdefault(said[:d], []).append(c)
    children = {s: [q for q in nodes if len(q) == len(s) + 1 and q[: len(s)] == s] for s in nodes}
    out = []
    for s, members in nodes.items():
        below = [q for q in nodes if q[: len(s)] == s]
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(s))
        out.append((
            min(members), len(s), min(nodes[s[:-1]]) if s else None, len(members), len(children[s]), sum(not children[q] for q in below), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def table(ids, most, texts, seed=3):
    pick, rows = random.Random(seed), []
    for c in ids:
        for t in range(pick.randint(1, most)):
            rows.append((c, None if pick.random() < 0.03 else t, None if pick.random() < 0.1 else "user", pick.choice(texts)))
    pick.shuffle(rows)
    return rows


def trie(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    return sorted(map(tuple, prefix_trie.trie(df, **how).collect()), key=str)


@pytest.mark.parametrize(
    "rows",
    [
        table(range(60), 6, ["a", "b c"]),
        table([*range(40), 1000, 2020, 2021], 14, ["x"]),  # long common beginnings
        table(range(50), 5, [None, "", "q r s"]) + [(None, 1, "user", "z"), (3, 1, "user", "q"), (3, 1, "user", "q")],
        [(c, 0, "user", "same") for c in range(80)],  # a group of copies over many blocks
        [(c, t, "user", f"{c} {t}") for c in (5, 6) for t in range(30)],  # nothing in common
    ],
)
def test_nodes_against_brute_force(spark, rows):
    """Small blocks and runs, so that intervals span many blocks and equal runs go on."""
    assert trie(spark, rows, block=4, run=2) == answer(rows)


def test_edges(spark):
    for rows in ([], [(None, 0, "u", "x")], [(7, 0, "user", "hi there")], [(20, 0, "a", "x"), (21, None, None, None)]):
        assert trie(spark, rows) == answer(rows)


def test_nearest_smaller_values():
    pick = np.random.default_rng(2)
    for n in (0, 1, 40):
        v = pick.integers(0, 6, n)
        want = [max([j for j in range(i) if v[j] < v[i]], default=-1) for i in range(n)]
        assert prefix_trie._nearest_smaller(v).tolist() == want
    a = pick.integers(0, 30, 20)
    b = a + pick.integers(1, 10, 20)
    v = pick.integers(0, 99, 40)
    assert prefix_trie._least(v, a, b).tolist() == [v[x:y].min() for x, y in zip(a, b)]


def test_rebuilt_and_numbered(spark):
    rows = [(20, t, "u", f"s{t}") for t in range(5)] + [(c, t, "u", f"o{t}") for c in range(20, 40) if c != 20 for t in range(2)]
    turns, lens = prefix_trie.rebuilt(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(20, 40)}
    assert {r.conv_id: r.len for r in lens.collect()} == {c: h[c] + max(0, (5 if c == 20 else 2) - h[c]) for c in h}
    assert turns.count() == sum(r.len for r in lens.collect())
    got = prefix_trie.numbered(spark.range(1000).selectExpr("id * 7 % 1000 as v").repartition(8), "v").collect()
    assert all(r.v == r.pos for r in got)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op13_prefix_trie

    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, op13_prefix_trie(spark, "/root/testdata/sf0.01").collect()), key=str) == answer(map(tuple, rows))
