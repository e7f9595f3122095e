"""Streaming sources, windows and drivers: finite runs, resumption, tees, time limits and retries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, sf_dir: str, name: str, files: int = 1) -> DataFrame:
    """A table's Parquet files as a stream; zone-less times become timestamps, as watermarks need them."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"})


def tumbling(events: DataFrame, ts: str = "ts", size: str = "1 day", late: str = "1 hour", by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, size), *by).agg(F.count(F.lit(1)).alias("n"))


def sliding(events: DataFrame, ts: str = "ts", size: str = "1 day", step: str = "12 hours", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, size, step)).agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, ts: str = "ts", gap: str = "6 hours", late: str = "1 hour", by: str = "user_id") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(by, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("n"))


def distinct_events(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """First of the rows that repeat the keys within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def interval_join(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, within: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Right events up to `within` after a left event of the same key; both watermarks and the range bound the state."""
    a, b = left.withWatermark(left_ts, late).alias("a"), right.withWatermark(right_ts, late).alias("b")
    cond = (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col(f"b.{right_ts}") >= F.col(f"a.{left_ts}")) & (F.col(f"b.{right_ts}") <= F.col(f"a.{left_ts}") + F.expr(f"interval {within}"))
    return a.join(b, cond)


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", seconds: int = 600) -> None:
    """Process what is there now and stop; a rerun with the same checkpoint goes on with what is new."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    if not q.awaitTermination(seconds):
        q.stop()
        raise TimeoutError(f"stream still running after {seconds} s")


def collect_to(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update", every: str | None = None):
    """foreachBatch driver: batches never overlap, a slow one delays the next instead of queueing."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def tee(first: Callable[[DataFrame, int], None], second: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to both; the batch is computed once."""

    def both(df: DataFrame, batch: int) -> None:
        df.persist()
        first(df, batch)
        second(df, batch)
        df.unpersist()

    return both


def with_limit(query, seconds: float) -> bool:
    """Watchdog: True if the query ended by itself, else it is stopped."""
    if query.awaitTermination(seconds):
        return True
    query.stop()
    return False


def retried(work: Callable[[int], object], attempts: int = 3, pause: float = 0.0):
    """The first result of work(attempt) that does not raise; the last error if none. Work must be resumable."""
    for attempt in range(attempts):
        try:
            return work(attempt)
        except Exception:
            if attempt + 1 == attempts:
                raise
            time.sleep(pause * 2**attempt)
    raise ValueError("attempts must be at least 1")
