from __future__ import annotations

import gzip
import json

from helpers import rows
from pyspark.sql import functions as F

from glossometer.operators.events import aggregate_events, extract_events
from glossometer.streaming.hours import archive_from_partial, ingest_hours, stream_hours


def test_hours_as_they_arrive(spark, tmp_path):
    folder = tmp_path / "hours"
    folder.mkdir()

    def put(day, hour, *events):
        lines = [json.dumps({"id": str(i), "type": "PullRequestEvent", "actor": {"login": a}, "repo": {"name": "a/b"}, "payload": {"repository": {"language": x}}, "created_at": f"2024-01-{day:02d}T{hour:02d}"}) for i, (a, x) in enumerate(events)]
        with gzip.open(folder / f"2024-01-{day:02d}-{hour}.json.gz", "wt") as f:
            f.write("\n".join([*lines, "broken"]))

    def drain():
        ingest_hours(stream_hours(spark, str(folder), 1), str(tmp_path / "partial"), str(tmp_path / "checkpoint")).awaitTermination()

    put(1, 5, ("ann", "Go"), ("ann", "C"), ("ben", "C"))
    put(1, 6, ("ann", "Rust"))
    drain()
    put(1, 3, ("ann", ""), ("cy", "C"))
    drain()
    drain()
    got = archive_from_partial(spark.read.parquet(str(tmp_path / "partial")))
    whole = aggregate_events(extract_events(spark.read.text(str(folder)).withColumn("month", F.lit("2024-01"))), keys=("month",))
    columns = ["month", "actor", "repo", "event_type", "action", "language", "count"]
    assert rows(got, *columns) == rows(whole, *columns)
    assert ("2024-01", "ann", "a/b", "PullRequestEvent", "", "", 4) in rows(got, *columns)
