import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmurlake.functions.time import usable_millis
from murmurlake.streaming.session_timers import stream_sessions, timer_sessions

GAP = 1_200_000


def brute(rows, gap=GAP):
    out = []
    by = {}
    for k, t in rows:
        if k is not None and t is not None:
            by.setdefault(k, []).append(t)
    for k, ts in by.items():
        ts.sort()
        start = last = ts[0]
        n = 0
        for t in ts:
            if t - last > gap:
                out.append((k, start, last, n))
                start, n = t, 0
            last = t
            n += 1
        out.append((k, start, last, n))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "uid string, t long, events string")
    return sorted((r["uid"], r["start_ms"], r["end_ms"], r["events"]) for r in timer_sessions(df, "uid", "t", **kw).collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3 * 86_400_000))), max_size=60), st.integers(1, 10_000_000))
def test_against_a_fold(spark, rows, gap):
    assert run(spark, rows, gap_ms=gap, bucket_ms=30_000_000) == brute(rows, gap)


def test_gap_is_exclusive_and_edges_of_buckets_join(spark):
    day = 86_400_000
    rows = [("a", 0), ("a", GAP), ("a", 2 * GAP + 1), ("b", day - 1), ("b", day - 1), ("b", day), ("b", day + GAP), ("c", day - GAP), ("c", day)]
    assert run(spark, rows) == brute(rows)


def test_a_session_over_many_buckets(spark):
    rows = [("hot", i * 1_000_000) for i in range(400)] + [("cold", 5)]
    assert run(spark, rows) == [("cold", 5, 5, 1), ("hot", 0, 399_000_000, 400)]


def test_empty_and_bad_buckets(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [], gap_ms=10, bucket_ms=15)


def test_usable_time(spark):
    rows = [
        (1, 1325469197825, None, 1325469197825),
        (2, 1325469197, "2015-01-01 00:00:00", 1325469197000),
        (3, 0, "2012-01-02T01:53:17.825Z", 1325469197825),
        (4, -1, "2012/01/02 01:53:17", 1325469197000),
        (5, None, "2012-01-02T01:53:17", 1325469197000),
        (6, 86400000, "刚刚", None),
        (7, 4102501986000, "1999-01-01 00:00:00", None),
        (8, None, "0000-00-00 00:00:00", None),
        (9, None, None, None),
        (10, None, "2012-01-02 01:53:17Z", None),
    ]
    df = spark.createDataFrame(rows, "i int, n long, s string, want long").withColumn("got", usable_millis("n", "s"))
    assert {r["i"]: r["got"] for r in df.collect()} == {r[0]: r[3] for r in rows}


def test_stream_emits_each_session_once(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    minutes = [("a", 0), ("a", 15), ("b", 3), ("a", 60), ("a", 90), ("b", 600), ("z", 2000), ("z", 3000)]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for i in range(0, len(minutes), 3):
        part = [(k, base + dt.timedelta(minutes=m)) for k, m in minutes[i : i + 3]]
        spark.createDataFrame(part, "uid string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("uid string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = (
        stream_sessions(source, "uid", "ts", watermark="1 minute")
        .writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    q.awaitTermination(120)
    ms = int(base.timestamp() * 1000)
    got = sorted((r["key"], (r["start_ms"] - ms) // 60000, (r["end_ms"] - ms) // 60000, r["events"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 0, 15, 2), ("a", 60, 60, 1), ("a", 90, 90, 1), ("b", 3, 3, 1), ("b", 600, 600, 1), ("z", 2000, 2000, 1)]
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("events") < 1).count() == 0
