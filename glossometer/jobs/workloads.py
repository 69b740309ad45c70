"""The three workloads: hours to archive, archive to ratings, ratings to series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import year_month_from_name
from ..functions.values import ACTOR_EVENT_LIMIT, REPO_ISSUE_LIMIT
from ..operators.events import aggregate_events, extract_events
from ..operators.filters import filter_archive
from ..operators.languages import languages_from_archive
from ..operators.pack import pack_all
from ..operators.ratings import language_shares, rated, repo_activity
from ..sources.readers import file_ledger, hour_index, hour_states, read_events
from ..sources.writers import write_ratings


def archive_month(spark: SparkSession, folder: str, year: int, month: int, archive: str) -> DataFrame:
    """Count a month's hourly event files into an archive (Parquet); returns the hours that are absent, empty or damaged.

    One gzipped file is one task, so a month has about 744; the JSON is parsed once.
    """
    name = f"{year:04d}-{month:02d}"
    index = hour_index(spark, year, month)
    lines = read_events(spark, f"{folder}/{name}-*.json.gz")
    aggregate_events(extract_events(lines)).withColumn("month", F.lit(name)).write.mode("overwrite").partitionBy("month").option("partitionOverwriteMode", "dynamic").parquet(archive)
    return hour_states(index, file_ledger(spark, f"{folder}/{name}-*.json.gz"))


def named_month(df: DataFrame) -> DataFrame:
    """df, read from files, with the month of its file's name."""
    return df.withColumn("month", year_month_from_name(F.col("_metadata.file_name")))


def clean_archive(spark: SparkSession, archive: str, cleaned: str, actor_event_limit: int = ACTOR_EVENT_LIMIT, repo_issue_limit: int = REPO_ISSUE_LIMIT) -> None:
    """Filter all months of an archive in one job."""
    filter_archive(spark.read.parquet(archive), actor_event_limit, repo_issue_limit, ["month"]).write.mode("overwrite").partitionBy("month").parquet(cleaned)


def rate_months(archive: DataFrame, languages: DataFrame | None = None, unfiltered: DataFrame | None = None, keys: Sequence[str] = ("month",)) -> DataFrame:
    """(month, metric, rank, language, rating, percentage). Languages come from a table, or from the unfiltered archive's own column."""
    if languages is None:
        languages = languages_from_archive(unfiltered if unfiltered is not None else archive)
    return rated(repo_activity(archive, keys), language_shares(languages), keys)


def rate_and_pack(spark: SparkSession, cleaned: str, languages: DataFrame, out: str) -> DataFrame:
    """Write the ratings of all months and return them packed."""
    write_ratings(rate_months(spark.read.parquet(cleaned), languages), out, "overwrite")
    return pack_all(spark, out)
