"""Folders for tables between jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side may be broadcast up to so many bytes, and only after they were measured.
BROADCAST_BYTES = 48 << 20

#: With this setting an execution's shuffle files go when it ends. Else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession) -> str:
    """A new folder where driver and executors both read and write: under spark.checkpoint.dir. Only a session that runs on this machine alone may leave that unset; it is then set to a folder of this machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """df written to a folder of scratch(), a new one or path, and read again: what follows doesn't compute it twice, and of its shuffles nothing stays on disk."""
    spark, path = df.sparkSession, path or scratch(df.sparkSession)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch() that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def measured(df: DataFrame) -> int:
    """About the bytes of df's rows: their texts as JSON, and what a row costs by itself."""
    return df.agg(F.sum(F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)) + 32)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """df with the hint to broadcast it, if its measured bytes are within the limit (BROADCAST_BYTES)."""
    return F.broadcast(df) if measured(df) <= (BROADCAST_BYTES if limit is None else limit) else df
