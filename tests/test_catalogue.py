import importlib
import os
import sys

import duckdb
import pytest

from tracequarry.plans import catalogue, inventory

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = catalogue.queries() | inventory.queries()
SQL = catalogue.oracle_sql() | inventory.SQL
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def clean(v):
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in found.description}
    names = sorted(df.columns)
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    at = [[d[0] for d in found.description].index(n) for n in names]
    want = sorted(tuple(clean(r[i]) for i in at) for r in found.fetchall())
    assert sorted(tuple(clean(r[n]) for n in names) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    picks = entry.queries()["select_coverage"](spark, SF).collect()
    assert 0 < len(picks) <= 12 and sorted(r.pick for r in picks) == list(range(len(picks)))


def test_import_without_the_optional_part(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("tracequarry.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert "rrf_recall_multi" in entry.queries() and "pipeline" not in entry.queries()
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_token_items_leave_texts_where_they_are(spark):
    from tracequarry.plans import catalogue

    plan = catalogue._token_items(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "documents.parquet" in plan and "Join" not in plan
