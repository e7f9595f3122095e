import time

import pytest
from pyspark.sql import functions as F

from quern.streaming import guards, runs


def lines(spark, folder, *rows):
    spark.createDataFrame(rows, "name string, ts timestamp, n int").coalesce(1).write.mode("append").json(f"file://{folder}")


def stream(spark, folder):
    return spark.readStream.schema("name string, ts timestamp, n int").json(f"file://{folder}")


def at(minute):
    from datetime import datetime

    return datetime(2024, 1, 1, 0, minute)


def test_resumes_with_new_files_only(spark, tmp_path):
    lines(spark, tmp_path / "in", ("a", at(1), 1), ("b", at(2), 2))
    for _ in range(2):
        runs.run_to_end(stream(spark, tmp_path / "in"), f"file://{tmp_path}/out", f"file://{tmp_path}/c")
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 2
    lines(spark, tmp_path / "in", ("c", at(3), 3))
    runs.run_to_end(stream(spark, tmp_path / "in"), f"file://{tmp_path}/out", f"file://{tmp_path}/c")
    assert sorted(r.n for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [1, 2, 3]


def test_late_rows_are_dropped_behind_the_watermark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    counted = runs.tumbling(stream(spark, tmp_path / "in"), size="5 minutes", late="1 minute", by=("name",))
    for rows in ([("a", at(1), 1)], [("a", at(30), 1)], [("a", at(2), 1), ("a", at(55), 1)]):
        lines(spark, tmp_path / "in", *rows)
        runs.run_to_end(counted, f"file://{tmp_path}/out", f"file://{tmp_path}/c")
    got = {(r.window.start.minute, r.n) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert got == {(0, 1), (30, 1)}


def test_tee_and_time_limit(spark, tmp_path):
    lines(spark, tmp_path / "in", ("a", at(1), 1))
    seen = {"x": 0, "y": 0}

    def sink(name):
        def write(df, _):
            seen[name] += df.count()

        return write

    q = runs.collect_to(stream(spark, tmp_path / "in"), runs.tee(sink("x"), sink("y")), f"file://{tmp_path}/c", "append")
    assert runs.with_limit(q, 120) and seen == {"x": 1, "y": 1}
    q = runs.collect_to(stream(spark, tmp_path / "in"), sink("x"), f"file://{tmp_path}/c2", "append", "1 second")
    assert not runs.with_limit(q, 3) and not q.isActive


def test_heartbeat_on_silence(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.ROCKS)
    lines(spark, tmp_path / "in", ("a", at(1), 1))
    beats = guards.heartbeats(stream(spark, tmp_path / "in").select("name"), 500)
    q = beats.writeStream.format("memory").queryName("beats").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table("beats").count() >= 2:
                break
        rows = [r.silent_ms for r in spark.table("beats").collect()]
    finally:
        q.stop()
    assert len(rows) >= 2 and min(rows) >= 500


def test_intervals_and_distinct(spark, tmp_path):
    lines(spark, tmp_path / "a", ("k", at(1), 1), ("k", at(1), 1), ("j", at(1), 2))
    lines(spark, tmp_path / "b", ("k", at(4), 10), ("k", at(20), 11), ("j", at(0), 12))
    a = runs.distinct_events(stream(spark, tmp_path / "a"), ["name", "n"], late="10 minutes")
    runs.run_to_end(a, f"file://{tmp_path}/da", f"file://{tmp_path}/ca")
    assert spark.read.parquet(f"file://{tmp_path}/da").count() == 2
    left = stream(spark, tmp_path / "a").select("name", F.col("n").alias("a"), F.col("ts").alias("ta"))
    right = stream(spark, tmp_path / "b").select("name", F.col("n").alias("b"), F.col("ts").alias("tb"))
    joined = runs.interval_join(left, right, "name", "ta", "tb", "10 minutes", "10 minutes").select("a.a", "b.b")
    runs.run_to_end(joined, f"file://{tmp_path}/j", f"file://{tmp_path}/cj")
    assert sorted((r.a, r.b) for r in spark.read.parquet(f"file://{tmp_path}/j").collect()) == [(1, 10), (1, 10)]


def test_stuck_stream_is_an_error(spark, tmp_path):
    lines(spark, tmp_path / "in", ("a", at(1), 1))
    slow = stream(spark, tmp_path / "in").select(F.udf(lambda n: time.sleep(20) or n, "int")("n").alias("n"))
    with pytest.raises(TimeoutError):
        runs.run_to_end(slow, f"file://{tmp_path}/out", f"file://{tmp_path}/c", seconds=2)
