import os
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tracequarry.llm import sharding


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_against_the_loop():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for n in (1, 2, 40, 41, 1000):
        assert sharding.jump(keys, n).tolist() == [jump_one(int(k), n) for k in keys]
    assert sharding.jump(keys[:0], 5).tolist() == []
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def test_appending_moves_only_into_the_new_shard():
    keys = np.random.default_rng(2).integers(0, 2**64, 50000, dtype=np.uint64)
    old, new = sharding.jump(keys, 40), sharding.jump(keys, 41)
    moved = old != new
    assert (new[moved] == 40).all() and 0.02 < moved.mean() < 0.03
    assert np.bincount(old, minlength=40).min() > 0.85 * len(keys) / 40


def verify(rows, texts):
    got, slots = defaultdict(int), defaultdict(list)
    by_id = {}
    for r in rows:
        got[r.doc_id, r.size, r.text_crc32] += 1
        slots[r.shard].append(r.slot)
        assert by_id.setdefault(r.doc_id, r.shard) == r.shard and 0 <= r.shard < 40 and r.law == "key"
        assert r.grown_shard in (r.shard, 40)
    want = defaultdict(int)
    for doc, text in texts:
        raw = (text or "").encode()
        want[doc, len(raw) + 16, zlib.crc32(raw)] += 1
    assert got == want
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_small_rows(spark):
    texts = [(i, f"text {i}") for i in range(300)] + [(1, "text 1"), (1, "text 1"), (None, None), (None, ""), (7, "ü" * 100000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "3 as shard", "'x' as bucket")
    verify(sharding.shard(docs).collect(), texts)
    assert sharding.shard(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op8_jump_sharding

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    verify(op8_jump_sharding(spark, "/root/testdata/sf0.01").collect(), [tuple(d) for d in docs])


def test_widened_keys_and_equal_rows(spark):
    ids = spark.createDataFrame([(i % 50,) for i in range(3000)], "doc_id int").selectExpr("doc_id", "'same' as text")
    small = {(r.doc_id, r.shard, r.grown_shard) for r in sharding.shard(ids).collect()}
    wide = sharding.shard(ids.selectExpr("cast(doc_id as long) doc_id", "text")).collect()
    assert small == {(r.doc_id, r.shard, r.grown_shard) for r in wide} and len(small) == 50
    slots = {}
    for r in wide:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_follow_from_the_hash_of_the_id(spark):
    import numpy as np

    rows = spark.range(2000).selectExpr("id as doc_id", "string(id) as text")
    hashes = {r.doc_id: r.h for r in rows.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}

    def plain(key, shards):
        at, goal = -1, 0
        while goal < shards:
            at = goal
            key = (key * 2862933555777941757 + 1) % 2**64
            goal = int((at + 1) * (2**31 / ((key >> 33) + 1)))
        return at

    for r in sharding.shard(rows).collect():
        key = int(np.int64(hashes[r.doc_id]).view(np.uint64))
        assert r.shard == plain(key, 40) and r.grown_shard == plain(key, 41)
