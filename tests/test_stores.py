import random
import shutil

import pytest
from pyspark.sql import functions as F

from tracequarry.operators import dedup
from tracequarry.sources import stores
from tracequarry.streaming import ingest


def table(spark, tmp_path):
    return stores.KeyedTable(spark, str(tmp_path / "t"), ["k"], "k int, v string")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.append(rows(spark, (1, "a"), (2, "b")))
    t.append(rows(spark, (2, "c"), (3, "d")), batch="s-0")
    t.append(rows(spark, (3, "e")))
    before = sorted(map(tuple, t.read().collect()))
    t.append(rows(spark, (2, "c"), (3, "d")), batch="s-0")
    assert sorted(map(tuple, t.read().collect())) == before
    t.append(rows(spark, (4, "f")), batch="s-1")
    t.compact()
    assert {(r.k, r.v) for r in t.read().collect()} == {(1, "a"), (2, "c"), (3, "e"), (4, "f")}
    t.append(rows(spark, (2, "c"), (3, "d")), batch="s-0")  # a late repetition after a compaction
    assert {(r.k, r.v) for r in t.read().collect()} == {(1, "a"), (2, "c"), (3, "e"), (4, "f")}


def test_compaction_that_dies_before_its_last_step(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.append(rows(spark, (1, "a"), (2, "b")))
    t.append(rows(spark, (2, "c")))
    want = sorted(map(tuple, t.read().collect()))

    class Dies:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, *_):
            raise RuntimeError("killed")

    whole = t._folder
    monkeypatch.setattr(t, "_folder", lambda: (Dies(whole()[0]), whole()[1]))
    with pytest.raises(RuntimeError):
        t.compact()
    again = table(spark, tmp_path)
    assert sorted(map(tuple, again.read().collect())) == want and again.count() == 2
    again.append(rows(spark, (3, "d")))
    assert again.count() == 3
    # and one that dies before the old table goes leaves it as it is
    shutil.copytree(tmp_path / "t", tmp_path / "t.compact")
    assert again.count() == 3


def test_stream_batches_write_both_tables_once(spark, tmp_path):
    line = lambda i, said: '{"trajectory_id": "x%d", "messages": [{"role": "user", "content": "%s"}]}' % (i, said)
    batch = spark.createDataFrame([(line(1, "one"), "f"), (line(2, "two"), "f"), ("junk", "f")], "value string, file string")
    write = ingest.batch_writer(spark, str(tmp_path / "w"), "offsets")
    write(batch, 0)
    tables = stores.open_stores(spark, str(tmp_path / "w"))
    before = [sorted(map(str, tables[n].read().collect())) for n in ("trajectories", "slices")]
    assert [len(x) for x in before] == [2, 2]
    ingest.batch_writer(spark, str(tmp_path / "w"), "offsets")(batch, 0)  # the batch runs again in another driver
    assert [sorted(map(str, tables[n].read().collect())) for n in ("trajectories", "slices")] == before
    assert [tables[n].history().count() for n in ("trajectories", "slices")] == [2, 2]
    assert tables["trajectories"].read().where(F.length("trajectory_path") > 0).count() == 2


def test_minhash_against_its_rule_and_the_exact_pairs(spark, monkeypatch):
    import random

    import xxhash

    pick = random.Random(9)
    base = [sorted({f"t{pick.randint(0, 400)}" for _ in range(60)}) for _ in range(12)]
    items = [(i, [t for t in base[i % 12] if pick.random() > 0.02] + ([f"n{i}"] if i % 3 == 0 else [])) for i in range(150)]
    items += [(900, None), (901, []), (902, items[0][1]), (903, items[0][1] + items[0][1])]
    df = spark.createDataFrame(items, "seq long, bm25_tokens array<string>")
    signed = lambda t, i: xxhash.xxh64_intdigest(i.to_bytes(4, "little"), xxhash.xxh64_intdigest(t.encode(), 42))
    place = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    sets = {}
    for i, ts in items:
        if ts:
            sets.setdefault(tuple(sorted(set(ts))), i)
    sig = {i: [min(place(signed(t, k)) for t in ts) for k in range(dedup.PERMUTATIONS)] for ts, i in sets.items()}
    ids = sorted(sig)
    equal = {(a, b): sum(x == y for x, y in zip(sig[a], sig[b])) for k, a in enumerate(ids) for b in ids[k + 1 :]}
    bands = lambda a, b: any(sig[a][k : k + dedup.BAND] == sig[b][k : k + dedup.BAND] for k in range(0, dedup.PERMUTATIONS, dedup.BAND))
    want = {(a, b, n) for (a, b), n in equal.items() if n >= dedup.LEAST_EQUAL and bands(a, b)}
    for hot in (512, 3):  # bands of more sets than that are split
        monkeypatch.setattr(dedup, "HOT", hot)
        pairs, firsts = dedup.minhash_pairs(df)
        assert set(map(tuple, pairs.collect())) == want
    assert {(r.seq, r["first"]) for r in firsts.where("seq in (902, 903)").collect()} == {(902, 0), (903, 0)}
    exact, _ = dedup.token_pairs(df)
    truth = {(r.a, r.b) for r in exact.collect()}
    verified, _ = dedup.minhash_pairs(df, verify=dedup.JACCARD)
    assert {(r.a, r.b) for r in verified.collect()} == truth
    clear = {p for p in truth if len(set(items[p[0]][1]) & set(items[p[1]][1])) / len(set(items[p[0]][1]) | set(items[p[1]][1])) >= 0.95}
    found = {(a, b) for a, b, _ in want}
    assert len(clear) > 20 and len(clear & found) >= 0.9 * len(clear)


def test_minhash_bands_miss_no_pair():
    edges = dedup.band_edges(dedup.LEAST_EQUAL)
    bands = list(zip(edges, edges[1:]))
    assert min(b - a for a, b in bands) >= 9 and edges[0] == 0 and edges[-1] == dedup.PERMUTATIONS
    pick = random.Random(1)
    for _ in range(500):
        differ = pick.sample(range(dedup.PERMUTATIONS), dedup.PERMUTATIONS - dedup.LEAST_EQUAL)
        assert any(not any(a <= d < b for d in differ) for a, b in bands)
