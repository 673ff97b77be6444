from pyspark.sql import functions as F

from tracequarry.operators import evaluation as ev
from tracequarry.plans import compiling, curation


def test_scores(spark):
    expected = spark.createDataFrame([("1", ["a"], "pass"), ("1", ["b"], "pass"), ("2", ["__NEW__"], "drop"), ("3", ["z"], "pass")], "case_id string, labels array<string>, route string")
    actual = spark.createDataFrame([("1", ["a", "c"], False, "pass"), ("2", ["n"], True, "pass"), ("3", [], True, "drop")], "case_id string, labels array<string>, is_new boolean, route string")
    assert sorted((r.case_id, r.labels[0]) for r in ev.label_hits(expected, actual).collect()) == [("1", "a"), ("2", "__NEW__")]
    scores = ev.route_score(expected, actual)
    assert {r.case_id: (r.agreed, r.expected) for r in scores.collect()} == {"1": (1, 2), "2": (0, 1), "3": (0, 1)}
    assert tuple(ev.totals(scores).first()) == (1, 4, 0.25) and tuple(ev.totals(scores.limit(0)).first()) == (0, 0, 0.0)
    runs = spark.createDataFrame([("1", "x")] * 3 + [("1", "y")], "case_id string, signature string")
    assert ev.drift(runs).first().stability == 0.75


def test_retained(spark):
    runs = spark.range(60).select(F.col("id").cast("string").alias("run_id"), F.when(F.col("id") > 0, F.col("id")).alias("finished_at"))
    got = {int(r.run_id) for r in ev.retained_runs(runs).collect()}
    assert got == {0, *range(10, 60)}


def test_manifest_ingest(spark, tmp_path):
    def ask(name, payload):
        if payload.get("question") == "bad":
            return None
        return '{"sub_problems": []}' if name == "decompose" else "[]"

    embed = lambda texts: [[float(len(t)), 1.0 if "x" in t else 40.0] for t in texts]
    questions = [("xxxxxxxx", None), ("xxxxxxx ", None), ("y", "p"), ("bad", None)]
    seen = []
    compiler = compiling.Compiler(ask)
    counts = curation.ingest_manifest(spark, str(tmp_path), questions, compiler, lambda t: embed(t) if t != ["bad"] else [[-1.0, -1.0]], evidence=lambda p: seen.append(p))
    assert counts == {"added": 2, "skipped_dup": 1, "failed": 1} and seen == ["p"]
    find = curation.nearest_problem(spark, str(tmp_path), embed)
    assert find("xxxxxxxx")[1] > 0.999
    assert curation.ingest_manifest(spark, str(tmp_path), [("y", None)], compiler, embed)["skipped_dup"] == 1
