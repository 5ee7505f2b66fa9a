"""Done-markers as the state of a stream: a finished set becomes due again after some days, one that failed stays open.

The log has one row an outcome: ``key, at, status``. ``found`` and ``none`` finish a set at that time, whatever came
before; ``error`` leaves it as it is. The state holds one time for each finished set; a timer of event time clears it
when the log has moved on by ``days`` from there, and says so. ``now_due`` is the same by one pass over the whole log.
Sets share their state and timer in ``BLOCKS`` blocks by hash, since a call of the worker for each set costs far more than
the set's rows: a block's timer stands at its earliest marker. A checkpoint of single sets is not read.

Cases. Rows without key, time or a known status change nothing. Of several rows the latest finish counts, so repeats
and late rows change nothing either. A restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

LOG = T.StructType([T.StructField("key", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("status", T.StringType())])
OUT = "key string, event string, ms bigint"
DAY_MS = 86_400_000
FINISHED = ("found", "none")
#: A checkpoint's blocks stay as many as it began with.
BLOCKS = 1024


def valid(log: DataFrame) -> DataFrame:
    return log.filter(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("status").isin(*FINISHED, "error"))


class DoneMarkers(StatefulProcessor):
    """``finished`` when a set's marker is set or moved on, ``due`` when it runs out."""

    def __init__(self, days: int):
        self.wait = days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.block = handle.getValueState("block", "keys array<string>, at array<bigint>, timer bigint")

    def _load(self) -> tuple[dict[str, int], int | None]:
        found = self.block.get()
        return (dict(zip(found[0], found[1])), found[2]) if found else ({}, None)

    def _store(self, done: dict[str, int], timer: int | None) -> None:
        """Keep the markers, with the timer at the earliest that runs out."""
        due = min(done.values()) + self.wait if done else None
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if done:
            self.block.update((list(done), list(done.values()), due))
        else:
            self.block.clear()

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last: dict[str, int] = {}
        for batch in rows:
            finished = batch.loc[batch["status"].isin(FINISHED)]
            for k, ms in finished.groupby("key")["ms"].max().items():
                last[k] = max(int(ms), last.get(k, int(ms)))
        if not last:
            return
        done, timer = self._load()
        moved = {k: ms for k, ms in last.items() if k not in done or ms > done[k]}
        if moved:
            self._store(done | moved, timer)
            yield pd.DataFrame({"key": list(moved), "event": "finished", "ms": list(moved.values())})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        done, timer = self._load()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        now = max(fired, timerValues.getCurrentWatermarkInMs())
        due = {k: ms + self.wait for k, ms in done.items() if ms + self.wait <= now}
        self._store({k: ms for k, ms in done.items() if k not in due}, None if timer == fired else timer)
        if due:
            yield pd.DataFrame({"key": list(due), "event": "due", "ms": list(due.values())})

    def close(self) -> None:
        pass


def run_markers(spark: SparkSession, folder: str, output: str, checkpoint: str, days: int) -> StreamingQuery:
    """Follow the log files of ``folder`` that no earlier run has seen, then stop."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    log = valid(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1000).parquet(folder)).withWatermark("at", "0 seconds")
    rows = log.select(F.pmod(F.xxhash64("key"), F.lit(BLOCKS)).alias("block"), "key", "status", F.unix_millis("at").alias("ms"), "at")
    found = rows.groupBy("block").transformWithStateInPandas(DoneMarkers(days), OUT, "append", "eventtime")
    events = found.select("key", "event", F.timestamp_millis("ms").alias("at"))
    return events.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def now_due(log: DataFrame, days: int) -> DataFrame:
    """``key, done_at, due``: each set's last finish, and whether the log has moved on from it by ``days``."""
    rows = valid(log)
    moved = rows.agg(F.max("at").alias("now"))
    last = rows.groupBy("key").agg(F.max(F.when(F.col("status").isin(*FINISHED), F.col("at"))).alias("done_at"))
    return last.join(F.broadcast(moved)).select("key", "done_at", F.coalesce(F.col("done_at") + F.expr(f"make_dt_interval({days})") <= F.col("now"), F.lit(True)).alias("due"))
