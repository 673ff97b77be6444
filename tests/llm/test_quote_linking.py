import duckdb
import pytest

from tracequarry.llm import quote_linking as ql

TALK = [
    (1, 0, "user", "Hello  there\nHow are you?"),
    (1, 1, "assistant", "> how ARE you?\nFine."),
    (1, 2, "user", "no quote here"),
    (1, 3, "user", ">> hello there\n> Fine.\n\nGood to hear"),
    (1, 4, "assistant", ">hello there\n> how are you?\n> fine.\nboth"),
    (1, 7, "user", "after a gap"),
    (2, 0, "user", "> nothing known\n"),
    (2, 1, "user", None),
    (2, 2, "user", ">"),
]
KIND = "conv_id long, turn long, role string, text string"


def test_links(spark):
    got = {(r.conv_id, r.turn): r for r in ql.link(spark.createDataFrame(TALK, KIND)).collect()}
    parent = {k: (r.parent_turn, r.by_quote) for k, r in got.items()}
    assert parent == {
        (1, 0): (None, False), (1, 1): (0, True), (1, 2): (1, False), (1, 3): (1, True), (1, 4): (0, True), (1, 7): (4, False),
        (2, 0): (None, False), (2, 1): (0, False), (2, 2): (1, False),
    }
    assert [got[1, t].depth for t in (0, 1, 2, 3, 4, 7)] == [0, 1, 2, 2, 1, 2]
    assert [got[1, t].thread_turn for t in (0, 1, 2, 3, 4, 7)] == [0, 0, 0, 0, 0, 0]
    assert got[1, 3].own_text == "\nGood to hear" and got[1, 3].max_level == 2 and got[1, 3].n_quoted_lines == 2
    assert got[2, 2].own_text == "" and got[2, 1].own_text == ""


def test_oracle_agrees_on_quotes(spark):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", TALK)
    df = ql.link(spark.createDataFrame(TALK, KIND))
    names = sorted(df.columns)
    want = con.execute(f"select {', '.join(names)} from ({ql.ORACLE})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (1, None, "user", "> a"), (1, 0, None, "a"), (1, 0, None, "a"), (1, 1, "user", "> a\n" * 5000), (3, 5000, "u", "x"), (3, 5001, "u", "> x")]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 as depth", "2 as part", "3 as up")
    got = ql.link(df).collect()
    assert len(got) == len(rows)
    assert sorted(r.position for r in got if r.conv_id == 1 and r.turn is not None) == [0, 1, 2]
    assert [(r.position, r.thread_turn, r.depth) for r in got if r.conv_id is None or r.turn is None] == [(None, None, 0)] * 2
    assert [r.parent_turn for r in got if (r.conv_id, r.turn) == (1, 1)] == [0]
    assert [r.parent_turn for r in got if r.conv_id is None] == [None]
    assert ql.link(df.limit(0)).count() == 0


MAIL = [
    (1, 0, "a", "The first point is about cost. The second\npoint is about time."),
    (1, 1, "b", "> The second point is\n> about time.\n\nTime is short, I fear."),
    (1, 2, "c", "> The first point is about cost.\nCost is low."),
    (1, 3, "d", ">> The second point is about time.\n> Time is\n> short, I fear.\nWait a week."),
    (1, 4, "e", ">> The first point\n>> is about cost.\nonly deeper quotes"),
    (1, 5, "f", "> > cost is LOW.\n> unknown words\n"),
    (1, 6, "g", "> Wait a week.\n>> cost is low.\nYes"),
    (1, 1000000, "h", "> Cost is low.\nlate"),
    (1, 1000001, "i", "next"),
]


def test_passages_of_every_level_link_in_tree_order(spark):
    got = {r.turn: r for r in ql.link(spark.createDataFrame(MAIL, KIND)).collect()}
    assert {t: r.parent_turn for t, r in got.items()} == {0: None, 1: 0, 2: 0, 3: 1, 4: 0, 5: 2, 6: 3, 1000000: 2, 1000001: 1000000}
    assert [t for t, _ in sorted(got.items(), key=lambda x: x[1].position)] == [0, 1, 3, 6, 2, 5, 1000000, 1000001, 4]
    assert got[5].own_text == "" and got[3].own_text == "Wait a week."


@pytest.mark.parametrize("rows", [MAIL, TALK])
def test_oracle_agrees(spark, rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    df = ql.link(spark.createDataFrame(rows, KIND))
    names = sorted(df.columns)
    want = con.execute(f"select {', '.join(names)} from ({ql.ORACLE})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_many_replies_to_one_and_gaps(spark):
    hub = [(1, 0, "u", "root words")] + [(1, 7 * i, "u", f"> root words\nreply {i}") for i in range(1, 3000)]
    got = {r.turn: r for r in ql.link(spark.createDataFrame(hub + [(2, 5 * i, "u", "x") for i in range(2500)], KIND)).where("conv_id = 1").collect()}
    assert all(r.position == t // 7 and (t == 0 or (r.parent_turn == 0 and r.depth == 1)) for t, r in got.items())


def test_long_chain(spark):
    df = spark.createDataFrame([(1, i, "u", f"line {i}\n" + (f"> line {i - 1}" if i else "")) for i in range(300)], KIND)
    got = ql.link(df).collect()
    assert all(r.depth == r.turn == r.position and r.thread_turn == 0 for r in got)
