import math
import random

import pytest
from pyspark.sql import functions as F

from tracequarry.functions import vectors as vx
from tracequarry.operators import ranking, recall

CORPUS = "ingest_seq long, bm25_tokens array<string>, embedding array<float>, languages array<string>, tools_used array<string>, verified boolean"
QUERIES = "sub_problem_id string, keywords array<string>, query_vectors array<array<double>>, filters struct<languages:array<string>,tools_used:array<string>,has_verification_step:boolean>"
COND = recall.passes


def run(spark, rows, queries, top=20):
    corpus, asked = spark.createDataFrame(rows, CORPUS), spark.createDataFrame(queries, QUERIES)
    cond = lambda q: COND(F.col("languages"), F.col("tools_used"), F.col("verified"), q["filters"])
    out = {}
    for r in recall.recall(corpus, asked, cond, top_n=top).orderBy("sub_problem_id", "rank").collect():
        out.setdefault(r.sub_problem_id, []).append((r.ingest_seq, r.rrf))
    return out


def plain(rows, query, top):
    _, words, vecs, (langs, tools, checked) = query
    n, df = len(rows), {}
    for r in rows:
        for t in {t.lower() for t in r[1]}:
            df[t] = df.get(t, 0) + 1
    cand = [r for r in rows if (langs is None or set(langs) & set(r[3])) and (tools is None or set(tools) & set(r[4])) and checked in (None, r[5])]
    bm, vec = {}, {}
    for r in cand:
        low = [t.lower() for t in r[1]]
        s = sum(math.log((n - df[w] + 0.5) / (df[w] + 0.5) + 1) * low.count(w) * 2.2 / (low.count(w) + 1.2) for w in map(str.lower, words) if w in low)
        if s > 0:
            bm[r[0]] = s
        norm = lambda v: math.sqrt(sum(x * x for x in v))
        cos = [sum(a * b for a, b in zip(r[2], q)) / norm(r[2]) / norm(q) for q in vecs or [] if r[2] and norm(r[2]) and norm(q) and len(q) == len(r[2])]
        if cos and max(cos) > 0:
            vec[r[0]] = max(cos)
    r1 = {d: k + 1 for k, d in enumerate(sorted(bm, key=lambda d: (-round(bm[d], 9), d)))}
    r2 = {d: k + 1 for k, d in enumerate(sorted(vec, key=lambda d: (-round(vec[d], 6), d)))}
    score = {r[0]: 1.0 if not r1 and not r2 else (1 / (60 + r1[r[0]]) if r[0] in r1 else 0) + (1 / (60 + r2[r[0]]) if r[0] in r2 else 0) for r in cand}
    order = sorted(score, key=lambda d: (-score[d], r1.get(d, 1e9), r2.get(d, 1e9), d))
    return [(d, score[d]) for d in order[:top]]


def test_against_plain_rules(spark):
    pick = random.Random(3)
    words = ["Alpha", "alpha", "beta", "gamma", "delta", "eps"]
    vec = lambda: [round(pick.gauss(0, 1), 3) for _ in range(3)]
    rows = [(i, sorted(set(pick.choices(words, k=3))), pick.choice([None, [], [0.0, 0.0, 0.0], [1.0, 2.0], vec(), vec()]), [pick.choice(["python", "go"])], [pick.choice(["Bash", "Read"])], pick.random() < 0.5) for i in range(70)]
    none = (None, None, None)
    queries = [
        ("a", ["alpha", "ALPHA", "beta"], [vec(), vec()], none), ("b", [], [vec()], (["go"], None, None)), ("c", ["gamma"], None, (["python"], ["Read"], True)),
        ("d", [], None, none), ("e", ["zzz"], [[0.0, 0.0, 0.0]], none), ("f", ["eps"], None, ([], None, None)), ("g", ["beta"], [[1.0, 0.5]], (None, None, False)),
    ]
    got = run(spark, rows, queries, 15)
    for q in queries:
        want = plain(rows, q, 15)
        assert [d for d, _ in got.get(q[0], [])] == [d for d, _ in want], q
        assert [s for _, s in got.get(q[0], [])] == pytest.approx([s for _, s in want])


def test_overlap_with_nulls(spark):
    df = spark.sql("select array('a', null) v, array(cast(null as string)) n, cast(null as array<string>) w, array('a') a, cast(array() as array<string>) e")
    row = df.select(recall.overlap(F.col("v"), F.col("w")), recall.overlap(F.col("v"), F.col("a")), recall.overlap(F.col("v"), F.col("e")), recall.overlap(F.col("v"), F.col("n"))).first()
    assert tuple(row) == (True, True, False, False)


def test_vectors(spark):
    df = spark.sql("select array(3.0, 4.0) a, array(0.0, 0.0) z, array(4.0, 3.0) b")
    a, z, b = F.col("a"), F.col("z"), F.col("b")
    row = df.select(vx.cosine(a, b), vx.cosine(a, z), vx.l2(a, b), vx.usable(z), vx.usable(F.lit(None).cast("array<double>")), vx.ensure_dimension(a, 3), vx.ensure_dimension(a, 1)).first()
    assert row[0] == pytest.approx(0.96) and row[1] == 0 and row[2] == pytest.approx(2**0.5) and row[3] is False and row[4] is False
    assert row[5] == pytest.approx([0.6, 0.8, 0.0]) and row[6] == [1.0]


def test_inheritance(spark):
    kind = "id int, capability_labels array<string>, target_label string, family array<string>, rrf double"
    rows = [(1, ["x"], "x", ["p", "y"], 0.5), (2, ["y"], "x", ["p", "y"], 0.9), (3, None, "x", ["p", "y"], 0.4), (4, ["q"], "x", ["p", "y"], 0.3), (5, ["p", "x"], "x", ["p", "y"], 0.2)]
    got = ranking.rerank_with_inheritance(spark.createDataFrame(rows, kind), [F.col("id")]).orderBy("rank").collect()
    assert [r.id for r in got] == [1, 3, 4, 2, 5]
