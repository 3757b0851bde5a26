"""The append-only progress log as a stream: resume, and full recomputation at any time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkshoal.sources.tables import PROGRESS


def stream(spark: SparkSession, folder: str, schema: str = PROGRESS, files_per_trigger: int = 1000) -> DataFrame:
    """Lines of the log's files as they come; broken lines are skipped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(folder)


def first_of_each(lines: DataFrame, key: str = "uuid", time: str | None = None, delay: str = "30 days") -> DataFrame:
    """Each key's first line. Without a time column all keys stay in state; with one, keys older than the delay leave it."""
    lines = lines.where(F.col(key).isNotNull())
    if time is None:
        return lines.dropDuplicates([key])
    return lines.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def append(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """New items appended to a table; what earlier runs have is not written again (the checkpoint knows it)."""
    return lines.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def run_until(query: StreamingQuery, stop: Callable[[], bool], poll: float = 1.0) -> bool:
    """Waits for a query to end; once ``stop()`` says so it is stopped. True if it was.

    A batch cut short is done again whole at the next start with the same
    checkpoint, which goes on after the last one that ended.
    """
    while not query.awaitTermination(poll):
        if stop():
            query.stop()
            return True
    return False


def recompute(lines: DataFrame, log: str, compile_: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch to the log table, then writes ``compile_`` of the whole log anew."""

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")  # a repeated batch replaces itself
        compile_(spark.read.parquet(log)).write.mode("overwrite").parquet(out)

    return lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
