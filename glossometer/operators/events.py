"""From JSON lines to counted archive rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import text_of

#: Only the paths that are used. VARIANT leaves tell strings from other values.
EVENT = (
    "id variant, created_at variant, type variant, actor struct<login: variant>, repo struct<name: variant>, "
    "payload struct<action: variant, pull_request: struct<head: struct<repo: struct<language: variant>>>, issue: struct<repository: struct<language: variant>>, repository: struct<language: variant>>"
)


def extract_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """actor, repo, event_type, action, language, created_at and id of every line that is an event.

    An event has a string `type` and a string `repo.name` with a slash. A value that isn't a string counts as absent;
    absent texts are "". The language is the first string among the pull request's head repository, the issue's
    repository and the payload's repository; an empty one stops the search. Other columns of lines (a month, say) stay.
    """
    e = lines.withColumn("e_", F.from_json(column, EVENT))
    field = lambda path: text_of(F.col(f"e_.{path}"))
    languages = [field(f"payload.{path}.language") for path in ("pull_request.head.repo", "issue.repository", "repository")]
    others = [c for c in lines.columns if c != column]
    return e.select(
        *others,
        F.coalesce(field("actor.login"), F.lit("")).alias("actor"),
        field("repo.name").alias("repo"),
        field("type").alias("event_type"),
        F.coalesce(field("payload.action"), F.lit("")).alias("action"),
        F.coalesce(*languages, F.lit("")).alias("language"),
        field("created_at").alias("created_at"),
        field("id").alias("id"),
    ).where("event_type IS NOT NULL AND contains(repo, '/')")


def aggregate_events(events: DataFrame, order: tuple[str, ...] = ("created_at", "id"), keys: tuple[str, ...] = ()) -> DataFrame:
    """Archive rows: the events of each (actor, repo, event_type, action) counted, with the language of the earliest by `order` (then by language)."""
    by = [*keys, "actor", "repo", "event_type", "action"]
    return events.groupBy(*by).agg(F.min_by("language", F.struct(*order, "language")).alias("language"), F.count("*").alias("count"))
