"""The incremental skip as a stream: new manifest rows are taken once, then the stream ends.

A file stream with ``availableNow`` remembers in its checkpoint which manifest files it has read;
within a file, rows that the store has already are dropped by the keyed anti join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import changed_snapshots


def manifest_stream(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def run_available(stream: DataFrame, checkpoint: str, stored: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], parser_version: str) -> StreamingQuery:
    """Hands every micro-batch of changed snapshots to ``handle`` and returns the ended query when all files
    are read."""

    def each(batch: DataFrame, epoch: int) -> None:
        new = changed_snapshots(batch.dropDuplicates(["date", "file_hash"]), stored(), parser_version)
        handle(new, epoch)

    q = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    q.awaitTermination()
    return q


def deduplicated(stream: DataFrame, at: str, delay: str = "7 days", key: tuple[str, ...] = ("date", "file_hash")) -> DataFrame:
    """First row of each key among those whose times ``at`` are less than ``delay`` apart.

    Keys older than that are dropped from the state, which therefore is as large as the keys of about
    two delays, however long the stream runs. A repeat that comes later passes here and is refused by the
    store (``run_available``). Rows older than the watermark are late and dropped; one without a time counts
    as seen when it is read."""
    timed = stream.withColumn(at, F.coalesce(at, F.current_timestamp()))
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))
