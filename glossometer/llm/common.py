"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word is a run of ASCII digits, ASCII lower-case letters and non-ASCII characters. (As a negated class it takes Java five times as long.)
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
#: Bytes that go to Python at once where rows hold whole texts.
BYTES_PER_BATCH = 512 << 10
#: Rows of a narrow table that make a file.
ROWS_A_FILE = 500_000
#: A side may be broadcast up to so many bytes, and only after they were measured.
BROADCAST_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The text's words in order, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def grams(words: Column, k: int) -> Column:
    """All k consecutive words, joined by spaces; position i holds words i to i + k - 1."""
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.concat_ws(" ", *(F.get(words, i + j) for j in range(k))))).otherwise(F.array().cast("array<string>"))


def written(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df written to shared storage and read again: it cuts the lineage, and lost executors take nothing with them.

    rows: about how many rows there are, if that is known; narrow tables of few rows then make few files.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession)
    (df if rows is None else df.coalesce(max(1, -(-rows // ROWS_A_FILE)))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Lower the session's limit of bytes in an Arrow batch to BYTES_PER_BATCH, so that batches of whole texts stay small whatever a text's length. Batches of narrow rows are smaller anyway."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BYTES_PER_BATCH:
        spark.conf.set(key, str(BYTES_PER_BATCH))


def unused(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has, whatever the case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name in taken:
        name += "_"
    return name


def aside(docs: DataFrame, *own: str) -> tuple[DataFrame, list[Column]]:
    """(docs with plain names for all columns but its own ones, the columns that give the result their names back): so no name of an operator's clashes, and none has to be escaped."""
    names = [c if c in own else f"column{i}_" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def measured(df: DataFrame) -> int:
    """About the bytes of df's rows: their texts as JSON, which no value's binary form exceeds by much, and what a row costs by itself."""
    return df.agg(F.sum(F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)) + 32)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """df with the hint to broadcast it, if its measured bytes are within the limit (BROADCAST_BYTES)."""
    return F.broadcast(df) if measured(df) <= (BROADCAST_BYTES if limit is None else limit) else df
