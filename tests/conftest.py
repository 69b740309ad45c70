from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.checkpoint.dir", f"file://{shared}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def archive(spark):
    """Archive rows from (actor, repo, event_type, count[, action, language])."""

    def make(*rows):
        full = [(a, r, t, *(x[0:2] or ("", "")), c) for a, r, t, c, *x in rows]
        return spark.createDataFrame(full, "actor string, repo string, event_type string, action string, language string, count long")

    return make
