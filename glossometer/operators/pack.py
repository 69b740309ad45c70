"""Monthly rating files packed into series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import rating_files, rating_lines, read_rating_files


def packed(lines: DataFrame) -> DataFrame:
    """(metric, month, language, rating, percentage, line): by metric, months ascending, lines in their file's order. `line` keeps all fields as they were."""
    field = lambda name, kind: F.try_variant_get("record", f"$.{name}", kind)
    return lines.select("metric", "month", field("language", "string").alias("language"), field("rating", "double").alias("rating"), field("percentage", "double").alias("percentage"), "line", "file", "pos").orderBy("metric", "month", "file", "pos").drop("file", "pos")


def pack_ratings(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    """All months of one metric, without the metric's column. Months need not follow one another. No file of the metric is an error."""
    return packed(read_rating_files(spark, folder, metric)).drop("metric")


def pack_all(spark: SparkSession, folder: str) -> DataFrame:
    """All months of all six metrics, in one pass over the files. A metric without files has no rows; use pack_ratings where that is an error."""
    return pack_files(rating_files(spark, folder))


def pack_files(files: DataFrame) -> DataFrame:
    """pack_all over rating files given as (path, value)."""
    return packed(rating_lines(files))
