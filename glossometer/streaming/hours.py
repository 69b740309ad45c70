"""The first workload fed as hours arrive: a file stream into partial counts, and the archive from the partial counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.events import extract_events

_KEY = ["month", "actor", "repo", "event_type", "action"]


def stream_hours(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the events of the hourly files (YYYY-MM-DD-H.json.gz) that come into a folder, with their month."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return extract_events(lines.select("value", F.substring("_metadata.file_name", 1, 7).alias("month")))


def ingest_hours(events: DataFrame, partial: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append each batch's counts to `partial`, in a folder per batch: a batch that runs again replaces its own. No state is kept between batches."""

    def append(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(*_KEY).agg(F.min(F.struct("created_at", "id", "language")).alias("first"), F.count("*").alias("count"))
        counted.write.mode("overwrite").parquet(f"{partial}/batch={number}")

    return events.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def archive_from_partial(partial: DataFrame) -> DataFrame:
    """Archive rows by month from partial counts: the same as counting all events at once."""
    return partial.groupBy(*_KEY).agg(F.min("first")["language"].alias("language"), F.sum("count").alias("count"))
