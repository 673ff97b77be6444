import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracequarry.operators import dedup, merging, selection, taxonomy, view

SCORED = "sub_problem_id string, trajectory_id string, slice_index int, relevance double, judge_match boolean, spans array<struct<start_step:int,end_step:int>>, capability array<string>, seq long"


def test_merge(spark):
    rows = [
        ("b", "t", 0, 0.4, True, [(2, 3), (0, 1)], ["x"], 1),
        ("a", "t", 0, 0.9, True, [(0, 1)], ["y", "x"], 2),
        ("b", "t", 0, 0.5, True, [(4, 4)], [], 3),
        ("a", "u", 1, 0.1, True, [(5, 6), (1, 2), (1, 2)], ["z"], 4),
    ]
    got = {r.trajectory_id: r for r in merging.merge_by_slice(spark.createDataFrame(rows, SCORED)).collect()}
    t, u = got["t"], got["u"]
    assert t.sub_problem_ids == ["b", "a"] and t.relevance_by_problem == {"b": 0.5, "a": 0.9} and t.relevance == 0.9
    assert [tuple(s) for s in t.spans] == [(0, 1), (2, 3), (4, 4)] and t.capability == ["x", "y"] and t.seq == 1
    assert [tuple(s) for s in u.spans] == [(5, 6), (1, 2), (1, 2)]


def test_absorb(spark):
    rows = [("a", "t", 0, 0.4, True, [(2, 3)], ["x"], 1), ("b", "u", 0, 0.9, True, [(0, 1), (2, 3)], ["y", "x"], 2), ("a", "v", 0, 0.5, True, [(9, 9)], [], 3)]
    merged = merging.merge_by_slice(spark.createDataFrame(rows, SCORED))
    out = merging.absorb(merged, spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "seq long, survivor long"))
    got = {r.trajectory_id: r for r in out.collect()}
    assert set(got) == {"t", "v"}
    assert got["t"].sub_problem_ids == ["a", "b"] and got["t"].relevance_by_problem == {"a": 0.4, "b": 0.9} and got["t"].relevance == 0.9
    assert [tuple(s) for s in got["t"].spans] == [(0, 1), (2, 3)] and got["t"].capability == ["x", "y"]


def greedy(items, similar):
    kept, out = [], {}
    for i in items:
        hit = next((k for k in kept if similar(k, i)), None)
        out[i] = i if hit is None else hit
        if hit is None:
            kept.append(i)
    return out


def test_survivors_are_greedy(spark):
    pick = random.Random(9)
    pairs = {(a, b) for a, b in ((pick.randrange(60), pick.randrange(60)) for _ in range(70)) if a < b} | {(100, 101), (101, 102), (102, 103)}
    items = [*range(60), 100, 101, 102, 103]
    got = dedup.survivors(spark.createDataFrame([(i,) for i in items], "seq long"), spark.createDataFrame(sorted(pairs), "a long, b long"))
    assert {r.seq: r.survivor for r in got.collect()} == greedy(items, lambda a, b: (a, b) in pairs)


def test_pairs_against_all(spark):
    pick = random.Random(4)
    base = [[f"w{pick.randrange(40)}" for _ in range(20)] for _ in range(12)]
    rows = []
    for i in range(90):
        words = list(pick.choice(base))
        if pick.random() < 0.5:
            words[0] = f"n{i}"
        rows.append((i, words if i % 17 else []))
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(2).normal(size=(120, 5)))] + [(500, [0.0] * 5), (501, None), (502, [1.0])]
    pairs, sets = dedup.token_pairs(spark.createDataFrame(rows, "seq long, bm25_tokens array<string>"))
    first = {r.seq: r.first for r in sets.collect()}
    uniq = {i: set(w) for i, w in rows if w and first[i] == i}
    assert all(set(rows[i][1]) == uniq[f] for i, f in first.items())
    want = {(a, b) for a in uniq for b in uniq if a < b and len(uniq[a] & uniq[b]) / len(uniq[a] | uniq[b]) >= 0.9}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want
    got = {(r.a, r.b) for r in dedup.cosine_pairs(spark.createDataFrame(vectors, "seq long, embedding array<float>"), 0.9).collect()}
    unit = {i: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for i, v in vectors[:120]}
    assert got == {(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] > 0.9} and got


def test_token_sets_meet_by_parts(spark):
    """Frequent tokens bring nobody together: 400 sets out of 60 words, and near copies of some; all sizes from 1 token on."""
    pick = random.Random(6)
    rows = [{f"w{pick.randrange(60)}" for _ in range(1 + i % 45)} for i in range(400)]
    rows += [(set(rows[i]) | {f"n{i}"}) - set(sorted(rows[i])[: i % 3]) for i in range(0, 400, 3)]
    items = spark.createDataFrame([(i, sorted(r)) for i, r in enumerate(rows)], "seq long, bm25_tokens array<string>")
    for least in (0.9, 0.75):
        pairs, sets = dedup.token_pairs(items, least)
        uniq = {r.first: rows[r.first] for r in sets.collect()}
        every = [(a, b) for a in uniq for b in uniq if a < b]
        assert sorted(map(tuple, pairs.collect())) == sorted((a, b) for a, b in every if len(uniq[a] & uniq[b]) / len(uniq[a] | uniq[b]) >= least)
    keys = dedup._part_keys(dedup.materialize(items.selectExpr("seq as first", "bm25_tokens as t")), 0.9)
    other = keys.selectExpr("first as other", "key")
    assert keys.join(other, "key").where("first < other").select("first", "other").distinct().count() < len(every) / 20


def test_metric_join_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    seeds = rng.normal(size=(9, 6))
    x = np.concatenate([seeds[rng.integers(0, 9, 700)] + rng.normal(size=(700, 6)) * rng.choice([0.01, 0.2, 1.0], (700, 1)), np.repeat(seeds[:1], 60, axis=0)])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 6), (902, [float("nan")] * 6), (903, [1.0, None]), (904, []), (905, [2.0]), (906, [3.0])]
    items = spark.createDataFrame(rows, "seq long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T
    monkeypatch.setattr(dedup, "BLOCK", 32)  # rings of many parts, parts of many tables
    monkeypatch.setattr(dedup, "CELL", 50)
    for above in (0.95, 0.6, -0.2):
        want = {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near > above))) if a < b} | {(905, 906)}
        got = [(r.a, r.b) for r in dedup.cosine_pairs(items, above).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    pairs, sets = dedup.vector_pairs(items)
    assert sum(r.first != r.seq for r in sets.collect()) == 59
    assert dedup.cosine_pairs(items.limit(0)).count() == 0


def test_metric_join_compares_less_than_all_pairs(spark):
    share = []
    for n in (4_000, 16_000, 64_000):
        rng = np.random.default_rng(3)
        seeds = rng.normal(size=(n // 250, 16))
        x = (seeds[rng.integers(0, len(seeds), n)] + rng.normal(size=(n, 16)) * 0.05).astype(np.float32)
        items = spark.createDataFrame(pd.DataFrame({"seq": np.arange(n), "embedding": x.astype(float).tolist()}))
        met, every = dedup.MetricJoin(items, 0.95, "seq", "embedding").work()
        assert every == n * (n - 1) // 2
        share.append(met / every)
    assert share[0] > 2 * share[1] > 3 * share[2] and share[2] < 0.06, share


@pytest.mark.parametrize("most", [0, 100_000])
def test_survivors_of_sets_are_greedy(spark, monkeypatch, most):
    monkeypatch.setattr(dedup, "MOST_LOCAL", most)  # rounds only, or one task only
    pick = random.Random(11)
    items = list(range(70))
    words, looks = ({i: f(pick.randrange(k)) for i in items if pick.random() < 0.9} for f, k in ((int, 25), (int, 40)))
    channels, similar = [], set()
    for of in (words, looks):
        first = {s: min(i for i in of if of[i] == s) for s in set(of.values())}
        kinds = sorted(first.values())
        pairs = {tuple(sorted(pick.sample(kinds, 2))) for _ in range(8)}
        rows = [(i, first[s]) for i, s in of.items()]
        channels.append((spark.createDataFrame(sorted(pairs), "a long, b long"), spark.createDataFrame(rows, "seq long, first long")))
        same = dict(rows)
        similar |= {(a, b) for a in same for b in same if a < b and (same[a] == same[b] or tuple(sorted((same[a], same[b]))) in pairs)}
    got = dedup.survivors_of_sets(spark.createDataFrame([(i,) for i in items], "seq long"), channels)
    assert {r.seq: r.survivor for r in got.collect()} == greedy(items, lambda a, b: (a, b) in similar)


def row(subs, vec=()):
    return list(subs), dict(subs), np.array(vec, float)


def test_selection_rules():
    cfg = selection.SelectionConfig
    items = [row({"p1": 0.9}), row({"p1": 0.8}), row({"p2": 0.1})]
    assert selection.choose(items, ["p1", "p2"], cfg(n=2, coverage_cap_per_problem=0.9, lam=0.01)) == [0, 2]
    assert selection.choose(items, ["p1", "p2"], cfg(n=9)) == [0, 1, 2]
    assert selection.choose([row({"p1": 0.9}), row({"p1": 0.8})], ["p1"], cfg(n=2, cap_per_problem=1)) == [0]
    assert selection.choose(items, [], cfg(n=0)) == [] == selection.choose([], ["p"], cfg(n=3))
    shared = [row({"p1": 0.9, "p2": 0.9}), row({"p2": 0.2}), row({"p1": 0.8})]
    assert selection.choose(shared, ["p1", "p2"], cfg(n=3, min_per_problem=1)) == [0, 1, 2]
    far = [row({"p": 0.5}, [0, 0]), row({"p": 0.5}, [0, 0.1]), row({"p": 0.5}, [9, 9])]
    assert selection.choose(far, ["p"], cfg(n=2, lam=0.1)) == [0, 2]


@pytest.mark.parametrize("seed", range(5))
def test_selection_keeps_budget_and_caps(seed):
    pick = random.Random(seed)
    items = [row({p: pick.random() for p in pick.sample("abcd", pick.randint(1, 3))}, [pick.random(), pick.random()]) for _ in range(25)]
    got = selection.choose(items, list("abcd"), selection.SelectionConfig(n=12, min_per_problem=1, cap_per_problem=4))
    assert len(got) == len(set(got)) <= 12
    assert all(sum(p in items[i][0] for i in got) <= 4 for p in "abcd")


def test_select_set(spark):
    rows = [("r", 2, ["p1"], {"p1": 0.8}, [1.0]), ("r", 1, ["p1"], {"p1": 0.9}, [0.0]), ("s", 3, ["p2"], {"p2": 0.1}, None)]
    df = spark.createDataFrame(rows, "run_id string, seq long, sub_problem_ids array<string>, relevance_by_problem map<string,double>, embedding array<float>")
    got = selection.select_set(df, selection.SelectionConfig(n=1), ["p1", "p2"]).collect()
    assert sorted((r.run_id, r.seq, r.pick) for r in got) == [("r", 1, 0), ("s", 3, 0)]


def test_taxonomy_rules(spark):
    labels = [{"label": "root", "parent": None, "vector": [1.0, 0.0]}, {"label": "leaf", "parent": "root", "vector": [0.8, 0.6]}]
    proposals = [{"label": n, "vector": v} for n, v in (("dup", [0.81, 0.59]), ("kid", [0.8, -0.6]), ("new", [-1.0, 0.1]), ("again", [-1.0, 0.12]))]
    after, found = taxonomy.ingest_proposals(proposals, labels, "now")
    assert [(f["kind"], f["target"]) for f in found] == [("duplicate", "leaf"), ("new_leaf", "root"), ("new_root", None), ("duplicate", "new")]
    assert [x["label"] for x in after] == ["root", "leaf", "kid", "new"]
    known = spark.createDataFrame([("root", None, [1.0, 0.0], 0), ("leaf", "root", [0.8, 0.6], 1)], "label string, parent string, vector array<double>, ord long")
    asked = spark.createDataFrame([(p["label"], p["vector"]) for p in proposals], "proposal string, vector array<double>")
    got = {r.proposal: (r.kind, r.target) for r in taxonomy.resolve(asked, known).collect()}
    assert got == {"dup": ("duplicate", "leaf"), "kid": ("new_leaf", "root"), "new": ("new_root", None), "again": ("new_root", None)}
    assert [r.label for r in taxonomy.leaves(known).collect()] == ["leaf"]


def test_queue():
    q = taxonomy.JobQueue()
    for name, p in (("a", 1), ("b", 3), ("c", 3), ("gone", 9)):
        q.enqueue(name, p)
    assert q.claim()["label"] == "gone" and q.reset_stale() == 1
    done = []

    def work(label):
        if label == "c":
            raise RuntimeError("boom")
        done.append(label)

    assert q.drain(work, {"a", "b", "c"}) == {"done": 2, "failed": 2} and done == ["b", "a"]
    assert q.jobs[2]["error"] == "boom" and q.jobs[3]["error"] == "label not found" and q.jobs[3]["attempts"] == 2


def test_label_merge(spark):
    sig = spark.createDataFrame([(1, None), (2, ["a", "b"]), (3, ["z"])], "k int, capability_labels array<string>")
    new = spark.createDataFrame([(1, ["x"]), (2, ["b", "c"]), (9, ["q"])], "k int, labels array<string>")
    assert {r.k: r.capability_labels for r in taxonomy.update_labels(sig, new, ["k"]).collect()} == {1: ["x"], 2: ["a", "b", "c"], 3: ["z"]}


def test_view(spark):
    scored = spark.createDataFrame([("p", "t", 0, True, [(0, 1)], 0.5, 1), ("p", "t", 0, True, [(0, 1)], 0.7, 2), ("p", "u", 0, False, [(0, 1)], 0.9, 3), ("p", "v", 0, True, [], 0.9, 4)], "sub_problem_id string, trajectory_id string, slice_index int, judge_match boolean, spans array<struct<start_step:int,end_step:int>>, relevance double, seq long")
    got = view.inspector(spark.createDataFrame([("p",), ("q",)], "sub_problem_id string"), scored, spark.createDataFrame([("t", 0)], "trajectory_id string, slice_index int")).collect()
    assert [(r.trajectory_id, r.relevance, r.selected) for r in got] == [("t", 0.5, True)]
    colors = view.color_index(spark.range(25).select(F.format_string("%02d", "id").alias("label"))).collect()
    assert {r.label: r.color for r in colors}["13"] == 3


def test_vectors_that_cells_do_not_prune_meet_in_blocks(spark):
    """At a low threshold nearly every vector is a guest of every earlier cell: blocks that all meet take fewer copies; copies of vectors are expanded."""
    gen = np.random.default_rng(8)
    x = gen.normal(size=(6000, 16)).astype(np.float32)
    x[5990:] = x[:10]
    items = spark.createDataFrame(pd.DataFrame({"seq": range(6000), "embedding": x.tolist()}), "seq long, embedding array<float>")
    join = dedup.MetricJoin(items, 0.7, "seq", "embedding")
    parts = -(-5990 // join.whole[16])
    assert join.told.selectExpr("sum(size(rings)) n").first().n == 5990 and parts == dedup.LEAST_BLOCKS
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(u @ u.T > 0.7, 1))
    got = sorted((r.a, r.b) for r in dedup.cosine_pairs(items, 0.7).collect())
    assert got == list(zip(a.tolist(), b.tolist()))
    some = items.withColumn("seq", F.format_string("%04d", "seq"))
    assert sorted((int(r.a), int(r.b)) for r in dedup.cosine_pairs(some, 0.7).collect()) == got
