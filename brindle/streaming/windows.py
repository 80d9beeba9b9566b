"""Streaming queries on event time. Each builds a streaming DataFrame from one; `run` drives one to its end."""

from __future__ import annotations

import threading
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from brindle.functions.times import event_time


def tumbling(events: DataFrame, length: str, late: str) -> DataFrame:
    """Counts by window and event type."""
    e = events.withColumn("at", event_time(F.col("ts"))).withWatermark("at", late)
    return e.groupBy(F.window("at", length), "event_type").agg(F.count("*").alias("n")).select(*_bounds(), "event_type", "n")


def sliding(events: DataFrame, length: str, step: str, late: str) -> DataFrame:
    e = events.withColumn("at", event_time(F.col("ts"))).withWatermark("at", late)
    return e.groupBy(F.window("at", length, step)).agg(F.count("*").alias("n")).select(*_bounds(), "n")


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    """Sessions of each user: events no further apart than the gap."""
    e = events.withColumn("at", event_time(F.col("ts"))).withWatermark("at", late)
    return e.groupBy(F.session_window("at", gap).alias("window"), "user_id").agg(F.count("*").alias("n")).select(*_bounds(), "user_id", "n")


def _bounds():
    return [F.col(f"window.{x}").cast("timestamp_ntz").alias(x) for x in ("start", "end")]


def deduplicated(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    return events.withColumn("at", event_time(F.col("ts"))).withWatermark("at", late).dropDuplicatesWithinWatermark(keys).drop("at")


def followed(first: DataFrame, second: DataFrame, within: str, late: str) -> DataFrame:
    """Pairs of a user's events of two streams, the second at most `within` after the first; state is bounded by both watermarks."""
    a = first.select(F.col("event_id").alias("a"), F.col("user_id").alias("ua"), event_time(F.col("ts")).alias("ta")).withWatermark("ta", late)
    b = second.select(F.col("event_id").alias("b"), F.col("user_id").alias("ub"), event_time(F.col("ts")).alias("tb")).withWatermark("tb", late)
    return a.join(b, F.expr(f"ua = ub AND tb > ta AND tb <= ta + INTERVAL {within}")).select("a", "b")


class RunningTotal(StatefulProcessor):
    """Each event with the number of the user's events up to it, in the order of arrival."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues):
        n = self.seen.get()[0] if self.seen.exists() else 0
        for pdf in rows:
            pdf = pdf.sort_values("event_id")
            yield pd.DataFrame({"user_id": key[0], "event_id": pdf["event_id"], "nth": range(n + 1, n + len(pdf) + 1)})
            n += len(pdf)
        self.seen.update((n,))

    def close(self) -> None:
        pass


def running_total(events: DataFrame) -> DataFrame:
    """Wants spark.sql.streaming.stateStore.providerClass to be RocksDB's."""
    return events.select("user_id", "event_id").groupBy("user_id").transformWithStateInPandas(RunningTotal(), "user_id long, event_id long, nth long", "append", "none")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_complete(spark: SparkSession, df: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run to the end of what is there in complete mode; each batch writes the whole result to a folder of its own, the last of which is returned."""
    last = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{number}")
        last[:] = [number]

    df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/{last[0]}") if last else spark.createDataFrame([], df.schema)


def run_to_files(df: DataFrame, out: str, checkpoint: str, idle_batches: bool = True) -> int:
    """Append to parquet files exactly once; a restart from the checkpoint goes on where it stopped. Returns how many rows came too late.

    idle_batches: whether batches without rows may run, which move timers and windows on. State by the clock asks for them without end, so it wants none.
    """
    late, conf = _Late(), "spark.sql.streaming.noDataMicroBatches.enabled"
    before = df.sparkSession.conf.get(conf)
    df.sparkSession.conf.set(conf, str(idle_batches).lower())
    df.sparkSession.streams.addListener(late)
    try:
        query = df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        late.wait(str(query.runId))
    finally:
        df.sparkSession.streams.removeListener(late)
        df.sparkSession.conf.set(conf, before)
    return late.rows


class _Late(StreamingQueryListener):
    """Counts late rows batch by batch: a query itself keeps only the last batches' progress."""

    def __init__(self):
        self.by_query: dict[str, int] = {}
        self.over: dict[str, threading.Event] = {}
        self.rows = 0

    def wait(self, run: str) -> None:
        """Until the listener has heard of the query's end, and so of all its batches."""
        self.over.setdefault(run, threading.Event()).wait(60)
        self.rows = self.by_query.get(run, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.by_query[run] = self.by_query.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.over.setdefault(str(event.runId), threading.Event()).set()


def run_each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
