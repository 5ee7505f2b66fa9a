"""Incremental runs as a file stream: each landed file is worked on once, across restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def run_new_files(spark: SparkSession, folder: str, schema: T.StructType, work: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, files_a_batch: int = 1000) -> StreamingQuery:
    """Work on files that no earlier run has seen, then stop.

    The checkpoint is the record of what is finished. A batch is written under its own number and
    overwrites itself if it is run again, so a failure between write and commit leaves no repeats.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
