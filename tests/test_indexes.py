import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracequarry.operators import keyword_index, scoring, vector_index

QUERIES = "sub_problem_id string, keywords array<string>, query_vectors array<array<double>>"
WORDS = [f"w{i}" for i in range(40)]


def texts(n, seed=1):
    """Few rows have the rare words; some rows have none, repeated or null tokens."""
    pick = random.Random(seed)
    rows = [(i, [pick.choice(WORDS[: 5 + pick.randint(0, 35) * (pick.random() < 0.1)]) for _ in range(pick.randint(0, 6))]) for i in range(n)]
    rows[:5] = [(i, ["rare", "w2"]) for i in range(5)]
    return [*rows, (n, None), (n + 1, ["W1", "w1", "W39"])]


def bm25(rows, queries, top):
    df = Counter(t for _, ts in rows for t in {t.lower() for t in ts or []})
    out = {}
    for name, words, _ in queries:
        scores = []
        for ident, ts in rows:
            tf = Counter(t.lower() for t in ts or [])
            s = sum(n * math.log((len(rows) - df[w] + 0.5) / (df[w] + 0.5) + 1) * tf[w] * 2.2 / (tf[w] + 1.2) for w, n in Counter(w.lower() for w in words or []).items() if tf[w])
            if s > 0:
                scores.append((-round(s, 9), ident))
        out[name] = [(ident, -s) for s, ident in sorted(scores)[:top]]
    return out


def got_from(hits, score):
    out = {}
    for r in hits.orderBy("sub_problem_id", "rank").collect():
        out.setdefault(r.sub_problem_id, []).append((r.ident, round(r[score], 9)))
    return out


def same(got, want):
    for name, rows in want.items():
        assert [d for d, _ in got.get(name, [])] == [d for d, _ in rows], name
        assert [s for _, s in got.get(name, [])] == pytest.approx([s for _, s in rows])


def test_keyword_index_after_several_writes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyword_index, "SPAN", 16)
    monkeypatch.setattr(keyword_index, "FIRST", 2)
    rows, old = texts(300), [(i, ["w1", "w30", "old"]) for i in range(1000, 1040)]
    asked = [("a", ["w1", "W1", "w36"], None), ("b", ["w38", "w2"], None), ("c", [], None), ("d", None, None), ("e", ["none"], None), ("f", ["w30", "old"], None), ("g", ["rare", "w2"], None)]
    queries = spark.createDataFrame(asked, QUERIES)
    index = keyword_index.KeywordIndex(spark, str(tmp_path / "index"))
    assert index.search(queries).count() == 0
    table = lambda some: spark.createDataFrame(some, "ingest_seq long, bm25_tokens array<string>")
    index.append(table(rows[:100] + old))
    same(got_from(index.search(queries, 7), "bm25"), bm25(rows[:100] + old, asked, 7))
    index.append(table(rows[100:]))
    index.remove(table(old))
    same(got_from(index.search(queries, 7), "bm25"), bm25(rows, asked, 7))
    one = index.search(queries.where("sub_problem_id = 'g'"), 3)
    same(got_from(one, "bm25"), {"g": bm25(rows, asked, 3)["g"]})
    assert 0 < index.scored < index.asked  # blocks that can't reach the last hit aren't scored


def test_a_write_without_its_count_is_not_there(spark, tmp_path):
    path = str(tmp_path / "index")
    index = keyword_index.KeywordIndex(spark, path)
    index.append(spark.createDataFrame([(1, ["a"])], "ingest_seq long, bm25_tokens array<string>"))
    index.append(spark.createDataFrame([(2, ["a"])], "ingest_seq long, bm25_tokens array<string>"))
    import shutil

    shutil.rmtree(tmp_path / "index" / "documents" / "write=2")  # as if the second writer had died
    hits = index.search(spark.createDataFrame([("q", ["a"], None)], QUERIES))
    assert [r.ident for r in hits.collect()] == [1]


def cosines(rows, queries, top):
    out = {}
    for name, _, vectors in queries:
        scores = []
        for ident, v in rows:
            if v is None or not all(x is not None and math.isfinite(x) for x in v) or not any(v):
                continue
            some = [float(np.dot(v, q) / np.linalg.norm(v) / np.linalg.norm(q)) for q in vectors or [] if len(q) == len(v) and any(q)]
            if some and max(some) > 0:
                scores.append((-round(max(some), 9), ident))
        out[name] = [(ident, -s) for s, ident in sorted(scores)[:top]]
    return out


def test_vector_index_reads_near_cells_only(spark, tmp_path):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in middles[i % 12] + 0.1 * rng.normal(size=16)]) for i in range(900)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [1.0, 2.0]), (904, rows[3][1]), (905, rows[3][1])]
    asked = [("a", None, [rows[3][1]]), ("b", None, [rows[5][1], rows[8][1]]), ("c", None, None), ("d", None, [[0.0] * 16]), ("e", None, [[1.0, 1.0], [1.0]]), ("f", None, [[-1.0] * 16])]
    queries = spark.createDataFrame(asked, QUERIES)
    index = vector_index.VectorIndex(spark, str(tmp_path / "index"))
    assert index.search(queries).count() == 0
    table = lambda some: spark.createDataFrame(some, "ingest_seq long, embedding array<double>")
    index.append(table(rows[:500]))
    same(got_from(index.search(queries, 9), "cosine"), cosines(rows[:500], asked, 9))
    index.append(table(rows[500:] + odd))  # a length that no centre has, and vectors that aren't usable
    same(got_from(index.search(queries, 9), "cosine"), cosines(rows + odd, asked, 9))
    index.search(queries.where("sub_problem_id = 'a'"), 5)
    assert index.rows == 903 and 5 <= index.scored <= index.read < 0.4 * index.rows


def test_heaps_meet_and_ranks_are_counted(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [f"w{int(x)}" for x in rng.integers(0, 4, 2)], [float(x) for x in rng.integers(-3, 4, 2)], [0, 1] if i % 5 else [1]) for i in range(400)]
    df = spark.createDataFrame(rows, "ident long, tokens array<string>, vector array<double>, who array<int>").repartition(7)
    scorer = scoring.Scorer([{"w0": 1, "w1": 2}, {"w3": 1}], {"w0": 0.5, "w1": 0.7, "w3": 0.2}, [[[1.0, 0.5]], [[0.0, 1.0], [1.0, 0.0]]])
    best = scoring.met(scoring.heaps(df, scorer, 30, 5), 30).collect()
    import pyarrow as pa

    every = {c: scorer.keywords(pa.array([r[1] for r in rows])) if c == 0 else scorer.vectors(pa.array([r[2] for r in rows])) for c in (0, 1)}
    for kind in (0, 1):
        for i in (0, 1):
            order = sorted((-every[kind][k, i], r[0]) for k, r in enumerate(rows) if i in r[3] and every[kind][k, i] > 0)
            assert [r.ident for r in sorted((r for r in best if r.kind == kind and r.i == i), key=lambda r: r.rank)] == [d for _, d in order[:30]]
            some = [(i, kind, d, -s) for s, d in order[::17]]
            got = {r.ident: r["rank"] for r in scoring.counted(df, scorer, some).collect()}
            assert got == {d: order.index((-s, d)) + 1 for _, _, d, s in some}
    assert scoring.heaps(df.limit(0), scorer, 30, 5).count() == 0
    assert df.select(F.count("*")).first()[0] == 400


def test_scores_of_common_words_take_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    words = [f"w{k:03d}" for k in range(100)]
    gen = np.random.default_rng(3)
    asked = [{w: int(gen.integers(1, 3)) for w in words if gen.random() < (0.9 if i else 1)} | ({"rare": 1} if i % 50 == 0 else {}) for i in range(150)]
    weights = {w: float(gen.random() * 5) for w in words} | {"rare": 7.5}
    rows = [[w for w in words if gen.random() < 0.9] + (["w001"] * 3 + ["rare"] if r % 7 == 0 else []) for r in range(1500)]
    scorer, tokens = scoring.Scorer(asked, weights, [[] for _ in asked]), pa.array(rows, pa.list_(pa.string()))
    tracemalloc.start()
    got = scorer.keywords(tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000  # over 800 MB when each word of each row was spread over its sub-problems at once
    for r, i in ((0, 0), (7, 50), (8, 3), (1499, 149)):
        tf = {w: rows[r].count(w) for w in rows[r]}
        assert abs(got[r, i] - sum(n * weights[w] * tf[w] * 2.2 / (tf[w] + 1.2) for w, n in asked[i].items() if w in tf)) < 1e-9
    assert (scorer.keywords(pa.array([rows[3], rows[3][::-1]], pa.list_(pa.string()))) == got[3]).all()


def test_postings_of_a_batch_are_counted_before_they_are_dealt():
    """One row for a word and block, not one for every word of every row; repeated and null words, ids below zero."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([5, -1, 17, 4]), pa.array([["a", "b", "a"], ["a"], ["a", None], ["b"]], pa.list_(pa.string()))], ["ident", "tokens"])
    got = [r for b in keyword_index._fragments(16)(iter([rows, rows.slice(0, 0)])) for r in b.to_pylist()]
    told = {(r["token"], r["block"]): [(p["ident"], p["tf"]) for p in r["postings"]] for r in got}
    assert len(got) == 4 and told == {("a", -1): [(-1, 1)], ("a", 0): [(5, 2)], ("a", 1): [(17, 1)], ("b", 0): [(4, 1), (5, 1)]}


def test_a_block_tells_its_best_rows_only(spark, tmp_path, monkeypatch):
    """Scores of a block meet in one task, which tells as many rows as are wanted; a row written twice in one write is one."""
    monkeypatch.setattr(keyword_index, "SPAN", 64)
    rows = [(i, ["w"] * (1 + i % 5)) for i in range(300)]
    index = keyword_index.KeywordIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame([*rows, (7, ["w"] * 9)], "ingest_seq long, bm25_tokens array<string>"))
    queries = spark.createDataFrame([("q", ["w"], None)], QUERIES)
    assert [r.ident for r in index.search(queries, 3).orderBy("rank").collect()] == [7, 4, 9]
    told = index.postings(["w"]).selectExpr("sum(n) n", "max(max_tf) m").first()
    assert (told.n, told.m) == (300, 12)


def test_vector_index_works_in_tiles(spark, tmp_path, monkeypatch):
    """Batches are compared with the centres, and scored, a few rows at a time; the result is that of scoring all rows."""
    monkeypatch.setattr(vector_index, "TILE", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(150)]
    asked = [("a", None, [rows[3][1]]), ("b", None, [rows[5][1], rows[8][1]])]
    index = vector_index.VectorIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame(rows, "ingest_seq long, embedding array<double>").coalesce(1))
    same(got_from(index.search(spark.createDataFrame(asked, QUERIES), 9), "cosine"), cosines(rows, asked, 9))
