"""Writers. At scale Parquet is the better archive; CSV and JSON lines are for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import ARCHIVE_COLUMNS


def write_archive(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Archive rows as CSV with a header; an empty field is written as nothing."""
    df.select(*ARCHIVE_COLUMNS).write.mode(mode).csv(path, header=True, escape='"', emptyValue="", lineSep="\n")


def store_archive(df: DataFrame, table: str, buckets: int, mode: str = "errorifexists") -> DataFrame:
    """Archive rows as a table of the session's warehouse, in buckets of their repositories, one sorted file each; returned as read from there.

    What groups or joins its rows by repository doesn't shuffle them again (filter_archive with placed, repo_activity's joins). The rows of a
    repository lie in one bucket: don't store an archive so of which one repository has a large share.
    """
    df.repartition(buckets, "repo").sortWithinPartitions("repo").write.mode(mode).bucketBy(buckets, "repo").sortBy("repo").saveAsTable(table, format="parquet")
    return df.sparkSession.table(table)


def write_languages(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Languages as JSON lines, without repositories whose list is empty."""
    df.where(F.size("languages") > 0).select("repo", "total_size", "languages").write.mode(mode).json(path)


def write_ratings(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Ratings as JSON lines (rank, language, rating, percentage) in a folder per month and metric, each one sorted file of some hundred lines."""
    df.select("month", "metric", "rank", "language", "rating", "percentage").repartition("month", "metric").sortWithinPartitions("month", "metric", "rank").write.mode(mode).partitionBy("month", "metric").json(path)
