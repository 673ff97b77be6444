import random

import pytest

from tracequarry.functions import text as tx
from tracequarry.operators import signatures as sg
from tracequarry.operators import slicing

KIND = "trajectory_id string, step_index int, role string, content string, tool_call_name string, tool_call_args string, tool_result string"


def plain_scores(steps):
    out = []
    for i, (role, content, tool, args, _) in enumerate(steps):
        kind = {"Read": 1, "Grep": 1, "Glob": 1, "WebFetch": 1, "WebSearch": 1, "Write": 2, "Edit": 2, "Bash": 3}
        s = 0
        if i:
            s += 10 * (role == "user")
            if role == "assistant" and tool:
                before = next((t for r, _, t, _, _ in reversed(steps[:i]) if r == "assistant" and t), None)
                s += 5 * (kind.get(tool) is not None and kind.get(before) is not None and kind[tool] != kind[before])
            s += 4 * (role == "assistant" and "Now I" in content[:200])
            s += 3 * (tool == "Bash" and any(w in (args or "") for w in ("test", "run")))
        out.append(s)
    return out


def plain_cuts(scores):
    n, cuts = len(scores), [0]
    while n > 10:
        pos = cuts[-1]
        window = [i for i in range(pos + 4, min(pos + 10, n - 1) + 1) if scores[i] > 0]
        if window:
            cuts.append(max(window, key=lambda i: (scores[i], -i)))
        elif pos + 10 < n:
            cuts.append(pos + 10)
        else:
            break
    return cuts


def test_scores_and_cuts_against_plain_rules(spark):
    pick = random.Random(1)
    rows, want = [], {}
    for t in range(60):
        steps = []
        for _ in range(pick.choice([1, 6, 10, 11, 14, 40, 90])):
            role = pick.choices(["user", "assistant", "tool"], [1, 12, 4])[0]
            tool = pick.choice([None, "Read", "Edit", "Bash", "Agent", ""]) if role == "assistant" else None
            steps.append((role, pick.choice(["", "Now I go", "x" * 250 + "Now I"]), tool, pick.choice([None, "ls", "run tests"]), None))
        rows += [(f"t{t}", i, *s) for i, s in enumerate(steps)]
        want[f"t{t}"] = plain_scores(steps)
    df = spark.createDataFrame(rows, KIND)
    got = {}
    for r in slicing.boundary_scores(df).orderBy("trajectory_id", "step_index").collect():
        got.setdefault(r.trajectory_id, []).append(r.boundary_score)
    assert got == want
    bounds = {}
    for r in slicing.slice_bounds(df).orderBy("trajectory_id", "slice_index").collect():
        bounds.setdefault(r.trajectory_id, []).append((r.start_step, r.end_step))
    for t, scores in want.items():
        cuts = plain_cuts(scores)
        assert bounds[t] == list(zip(cuts, [c - 1 for c in cuts[1:]] + [len(scores) - 1]))
        assert all(b - a + 1 <= 10 for a, b in bounds[t])


def test_unknown_tool_blocks_the_type(spark):
    rows = [("t", 0, "assistant", "", "Read", None, None), ("t", 1, "assistant", "", "Agent", None, None), ("t", 2, "assistant", "", "Edit", None, None), ("t", 3, "assistant", "", "Read", None, None)]
    got = slicing.boundary_scores(spark.createDataFrame(rows, KIND)).orderBy("step_index").collect()
    assert [r.boundary_score for r in got] == [0, 0, 0, 5]


def test_signature(spark):
    rows = [
        ("t", 0, "user", "fix it", None, None, None),
        ("t", 1, "assistant", "Now open src/app.py", "Bash", "pytest tests/test_x.py", None),
        ("t", 2, "tool", "res", None, None, "Traceback (most recent call last)\nMyError: x"),
        ("t", 3, "assistant", "def parse_it(self)", "Edit", "", None),
        ("t", 4, "tool", "", None, None, "3 passed\nOK\r\n"),
    ]
    r = sg.signatures(slicing.slices(spark.createDataFrame(rows, KIND))).first()
    assert (r.step_count, r.turn_count, r.tools_used) == (5, 1, ["Bash", "Edit"])
    assert r.languages == ["python"] and r.has_error_pattern and r.has_success_pattern and r.has_verification_step
    assert {"bash", "edit", "Traceback", "Error", "MyError", "src/app.py", "tests/test_x.py", "parse_it", "fix"} <= set(r.bm25_tokens)
    assert "self" not in r.bm25_tokens and r.bm25_tokens == sorted(set(r.bm25_tokens))
    line = spark.createDataFrame(rows, KIND).select(tx.summary_line(tx.F.struct(*[c for c in KIND_COLUMNS])).alias("l")).collect()
    assert line[1].l == 'Step 1: [assistant] Now open src/app.py → call Bash("pytest tests/test_x.py")'
    assert line[2].l == "Step 2: [result] Traceback (most recent call last)\\nMyError: x" and line[0].l == "Step 0: [user] fix it"
    text = spark.createDataFrame([(r.steps,)], f"steps array<{slice_kind()}>").select(tx.embedding_text(tx.F.col("steps")).alias("t")).first().t
    assert text == "pytest tests/test_x.py Now open src/app.py Bash Traceback (most recent call last)\nMyError: x def parse_it(self) Edit 3 passed\nOK\r\n"


KIND_COLUMNS = ["step_index", "role", "content", "tool_call_name", "tool_call_args", "tool_result"]


def slice_kind():
    from tracequarry.schemas import STEP

    return STEP


def test_success_at_line_end(spark):
    got = spark.createDataFrame([("OK",), ("OK\nx",), ("OK\r\nx",), ("OKAY",), ("passed",), ("2 PASSED",)], "t string").select(tx.is_success(tx.F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [True, True, False, False, False, True]


def test_embedding_batches(spark):
    rows = [(f"t{i}", 0, "user", f"text {i}", None, None, None) for i in range(80)]
    signed = sg.signatures(slicing.slices(spark.createDataFrame(rows, KIND)))
    vectors = {r.trajectory_id: r.embedding for r in sg.with_embeddings(signed, sg.hash_embedder(8), 7).collect()}
    assert len(vectors) == 80 and all(len(v) == 8 for v in vectors.values())
    with pytest.raises(Exception, match="vectors for"):
        sg.with_embeddings(signed, lambda texts: [[1.0]]).collect()


def test_small_functions(spark):
    row = spark.sql("select '1.2.9' a, 'v1' b, repeat('x', 9) c").select(tx.bump_patch(tx.F.col("a")), tx.bump_patch(tx.F.col("b")), tx.estimated_tokens(tx.F.col("c"))).first()
    assert tuple(row) == ("1.2.10", "v1", 2)
    assert tx.normalized_question("  é  a\n b ") == "é a b"
