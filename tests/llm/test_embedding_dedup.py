import os

import numpy as np
import pytest

from tracequarry.llm import embedding_dedup as ed


def brute(rows, threshold=0.93):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) and lab is not None for _, v, lab in rows]
    unit = [np.array(v, float) / np.linalg.norm(v) if g else None for (_, v, _), g in zip(rows, ok)]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(root(i), []).append(r[0])
    least = lambda i: min((x for x in ids[root(i)] if x is not None), default=None)
    return sorted(((r[0] if r[0] is not None else -1), n[i], least(i) if least(i) is not None else -1, r[0] == least(i)) for i, r in enumerate(rows))


def rows_of(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id if r.component_id is not None else -1, r.kept) for r in df.collect())


def test_count_is_calibrated():
    gen = np.random.default_rng(5)
    need, lines = ed.needed_count(), ed.directions(64)
    a = gen.normal(size=(20000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    t = gen.normal(size=a.shape)
    t -= (t * a).sum(1, keepdims=True) * a
    t /= np.linalg.norm(t, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * t
    half = ed.HALF_WINDOW * np.sqrt(2 * 0.07)
    counts = (np.abs(a @ lines - b @ lines) <= half).sum(1)
    assert (counts >= need).mean() > 0.9995


@pytest.mark.parametrize("n", [1, 63, 64, 200])
def test_windows_are_counted_like_one_by_one(n):
    gen = np.random.default_rng(n)
    known, points = gen.normal(size=(n, 24)).round(1), gen.normal(size=(37, 24)).round(1)  # many equal places
    hits = ((known[None] >= points[:, None] - 0.5) & (known[None] <= points[:, None] + 0.5)).sum(2)
    for need in (1, 5, 8, 17, 24):
        i, j = ed.SortedLines(known).reached(points, 0.5, need)
        assert sorted(map(list, zip(i.tolist(), j.tolist()))) == np.argwhere(hits >= need).tolist()


def test_small_rows(spark):
    gen = np.random.default_rng(7)
    rows = []
    for c in range(12):
        centre = gen.normal(size=16)
        for _ in range(c * 3 + 1):
            rows.append((len(rows), [float(x) for x in (centre + gen.normal(size=16) * 0.18).astype(np.float32)], c % 3))
    rows += [(500, rows[40][1], rows[40][2]), (501, rows[40][1], rows[40][2]), (501, rows[40][1], rows[40][2]), (None, rows[40][1], rows[40][2])]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [1.0] * 15 + [float("nan")], 1), (603, [1.0] * 15 + [None], 1), (604, rows[3][1], None), (605, rows[3][1][:8], 0)]
    rows += [(606, [float("inf")] + [1.0] * 15, 1), (607, [], 1), (None, None, None), (608, [2.0 * x for x in rows[3][1]], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as key", "2 as block", "'x' as data")
    assert rows_of(ed.cluster(df)) == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
    assert ed.cluster(df.limit(0)).count() == 0


def test_many_blocks(spark, monkeypatch):
    gen = np.random.default_rng(8)
    rows = [(i, [float(x) for x in gen.normal(size=6).astype(np.float32)], i % 2) for i in range(700)]
    monkeypatch.setattr(ed, "BLOCK", 64)
    monkeypatch.setattr(ed, "SORTED", 48)
    monkeypatch.setattr(ed, "TILE", 10)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute(rows)
    got = rows_of(ed.cluster(df))
    assert sum(r[1] for r in want) > 200
    assert got == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op2_collision_counting

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows_of(op2_collision_counting(spark, "/root/testdata/sf0.01")) == brute(rows)
