import os
import re

import pytest

pytest.importorskip("public_tokenizers")

import test_packing  # noqa: E402
import test_quality  # noqa: E402
import test_simhash  # noqa: E402

import corpus_pipeline  # noqa: E402


def stages(spark, docs, sf_dir, folder):
    """Each stage's rows, written and read again as the check tool does."""
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def brute(rows):
    """Ids and texts that each filtering stage keeps."""
    kept = [{r[0] for r in test_quality.brute([(d, t, lang) for d, t, lang in rows]) if r[7]}]
    texts = {d: t for d, t, _ in rows}
    kept.append({d for d in kept[-1] if re.search(r"[^\W\d_]", texts[d])})
    groups = test_simhash.brute({d: test_simhash.plain(texts[d]) for d in kept[-1]})
    kept.append({d for d, c in groups.items() if d == c})
    return kept, texts


def compare(spark, docs, sf_dir, folder):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    want, texts = brute(rows)
    got = stages(spark, docs, sf_dir, folder)
    for df, ids in zip(got, want):
        assert df.columns == docs.columns
        found = df.collect()
        assert sorted(r.doc_id for r in found) == sorted(ids)
        assert all(r.text == texts[r.doc_id] for r in found)
    bins, least = test_packing.verify(got[-1].collect(), [(d, texts[d]) for d in want[-1]])
    assert bins <= least + 2
    return want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_stages_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    want = compare(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf, tmp_path)
    assert 100 < len(want[2]) < len(want[0]) < 200
    whole = corpus_pipeline.run(spark, sf)
    assert whole.select("doc_id").distinct().count() == len(want[2])


def test_small_tables(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "en", "s", 9), (1, long, "en", "s", 9), (2, long, None, None, None), (3, None, "en", "s", 0), (4, "12 " + " ".join(str(i) for i in range(60)), "en", "s", 5), (None, long + " x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = stages(spark, docs, "", tmp_path / "a")
    assert [sorted((r.doc_id or -1) for r in df.select("doc_id").collect()) for df in got[:3]] == [[-1, 1, 1, 2, 4], [-1, 1, 1, 2], [-1, 1]]
    assert [df.count() for df in stages(spark, docs.limit(0), "", tmp_path / "b")] == [0, 0, 0, 0]


def test_columns_with_clashing_names_stay(spark, tmp_path):
    text = " ".join(f"w{i} the cat" for i in range(60))
    names = "known, lang_pred, score, q, refs, fp, kept, __row, __text, __id, __key, bucket, length, deal".split(", ")
    docs = spark.createDataFrame([(1, text, "en", "s", 9), (2, text, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *[f"{k} as `{c}`" for k, c in enumerate(names)])
    got = stages(spark, docs, "", tmp_path / "c")
    assert all(df.columns == docs.columns for df in got[:3])
    assert [tuple(r)[5:] for r in got[2].collect()] == [tuple(range(len(names)))]
    assert got[3].count() == 1
