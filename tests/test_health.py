import random

import pytest
from pyspark.sql import functions as F

from tracequarry.operators import health


def test_classes(spark):
    rows = [(200, "", False, "success"), (204, "", True, "abnormal_response"), (401, "", False, "auth_error"), (402, "", False, "auth_error"), (429, "", False, "overload"), (503, "", False, "server_error"), (400, "Content Policy", False, "content_filtered"), (400, "maximum context length", False, "input_error"), (400, None, None, "transient_error"), (403, "", False, "transient_error"), (404, "", False, "input_error"), (599, "", False, "transient_error"), (301, "", False, "transient_error")]
    df = spark.createDataFrame(rows, "status int, error string, bad boolean, want string")
    for r in df.withColumn("got", health.outcome_class(F.col("status"), F.col("error"), F.col("bad"))).collect():
        assert r.got == r.want, r


def test_window_and_streaks(spark):
    rows = [("k", i, i * (1 if i < 60 else 30), "timeout" if i % 4 == 0 else "success") for i in range(65)]
    df = spark.createDataFrame(rows, "key string, n int, s int, outcome string").withColumn("ts", F.timestamp_seconds("s"))
    for r in health.window_rates(df, "key", "ts", "n").collect():
        inside = [x for x in rows if x[1] <= r.n and x[2] >= r.s - 20][-50:]
        assert r.total == len(inside) and r.timeout_rate == pytest.approx(sum(x[3] == "timeout" for x in inside) / len(inside))
    fatal = [("k", i, o) for i, o in enumerate("a a s a a a s t a".split())]
    df = spark.createDataFrame(fatal, "key string, n int, o string").withColumn("outcome", F.when(F.col("o") == "a", "auth_error").otherwise("x"))
    assert tuple(health.streaks(df, "key", "n", "n").first()) == ("k", 3, 3)


def test_truncation(spark):
    text = "a" * 100 + "b" * 100
    cut = spark.createDataFrame([(text,)], "t string").select(health.truncate_text(F.col("t"), F.lit(81)), health.truncate_text(F.col("t"), F.lit(200)), health.truncate_text(F.col("t"), F.lit(5))).first()
    assert cut[0] == "a" * 15 + health.TRUNCATION_MARKER + "b" * 35 and cut[1] == text and cut[2] == "a" + health.TRUNCATION_MARKER + "b"


def test_conversation_shares_are_exact(spark):
    """Shares of 680 and 700 characters: as doubles their 35 % lie just below 238 and 245."""
    for free in (680, 700):
        rows = [(0, "system", "s" * (800 - free))] + [(i, "user", "u" * 500) for i in (1, 2, 3)]
        cut = health.truncate_conversations(spark.createDataFrame([(1, *r) for r in rows], "c int, turn int, role string, text string"), "c", "turn", "role", "text", 200)
        size = [len(r.text) for r in cut.orderBy("turn").collect()]
        assert size == [800 - free, free * 35 // 100, free * 35 // 100, free * 30 // 100]


def test_abort_and_bucket():
    m = health.AbortMonitor()
    assert [m.record(o) for o in ["auth_error"] * 4 + ["timeout"] + ["auth_error"] * 5] == [False] * 9 + [True]
    m = health.AbortMonitor()
    assert not any(m.record("timeout", infra_only=True) for _ in range(50)) and m.total == 0
    assert [m.record("timeout") for _ in range(20)][-2:] == [False, True]
    t = health.TokenBucket(rps=2.0, warmup=0.0)
    assert [round(t.wait(0.0), 3) for _ in range(3)] == [0.0, 0.5, 1.0] and t.wait(10.0) == 0.0


def test_rates_of_a_stream(spark, tmp_path):
    """Out of order inside the watermark's room, one outcome too late, a key that falls silent."""
    from tracequarry.streaming.health import rates

    pick = random.Random(4)
    rows = [(f"k{i % 3}", 1000.0 + i * (0.5 if i < 150 else 8), i, pick.choice(["success", "timeout", "overload", "abnormal_response"])) for i in range(200)]
    parts = [rows[:90], rows[90:150], [*rows[150:], ("k0", 1000.0, 999, "timeout")], [("end", 1e9, -1, "success")]]
    kind = "key string, s double, event_id long, outcome string"
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k, part in enumerate(parts):
            shuffled = pick.sample(part, len(part))
            spark.createDataFrame(shuffled, kind).select("key", F.timestamp_seconds("s").alias("ts"), "event_id", "outcome").write.parquet(str(tmp_path / "in" / str(k)))
            source = spark.readStream.schema("key string, ts timestamp, event_id long, outcome string").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
            sink = rates(source, "key", "ts").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "offsets"))
            sink.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
    columns = ["event_id", "total", "timeout_rate", "overload_rate", "abnormal_rate", "infra_rate"]
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*columns).collect()))
    whole = spark.createDataFrame(rows, kind).withColumn("ts", F.timestamp_seconds("s"))
    assert got == sorted(map(tuple, health.window_rates(whole, "key", "ts", "event_id").select(*columns).collect()))


def test_windows_of_many_keys_at_once():
    """A bucket's keys are counted together; each window stays inside its key, 20 seconds and 50 outcomes."""
    import pandas as pd

    from tracequarry.streaming import health as stream

    pick = random.Random(6)
    rows = sorted((pick.choice("abc"), pick.randrange(400) * 500_000, i) for i in range(900))
    begin, low = stream._places(pd.DataFrame([(k if k != "a" else None, t, i) for k, t, i in rows], columns=["key", "at", "event_id"]))
    for n, (k, t, _) in enumerate(rows):
        inside = [m for m in range(n + 1) if rows[m][0] == k and rows[m][1] >= t - 20_000_000][-50:]
        assert low[n] == inside[0] and begin[n] == next(m for m, r in enumerate(rows) if r[0] == k)
    frame = pd.DataFrame({"key": ["x", None], "at": [1, 2], "event_id": [3, 4], "outcome": ["timeout", "success"]})
    assert len(stream._packed(frame)) == 1 and stream._packed(frame[:0]) == []
