"""Sharding by sampled splitters.

A bounded sample of keys, drawn with chances in proportion to the rows' sizes, gives quantile boundaries that cut the
key space into many more ranges than shards. Rows are placed into ranges; a range that turns out overfull is cut again
by a sample of its own. Ranges in key order, with the bytes before each, then give every row its place on the byte
line, and equal pieces of that line are the shards: their sizes differ by less than one row's.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SHARDS, OVERHEAD = 40, 16
#: Ranges to a shard and rows to a range on average (whichever makes more ranges), drawn keys to a range (the sample's
#: expected size is ranges * DRAWS), and how many times the mean makes a range overfull.
RANGES, ROWS_A_RANGE, DRAWS, OVERFULL = 8, 2_000_000, 16, 4.0


def sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, k1, k2, k3): k1 to k3 are the key: the text's CRC-32, so that equal texts lie together, then the id, then a number for rows alike in both."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("k1"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k2"),
        F.monotonically_increasing_id().alias("k3"),
    )


def drawn(rows: DataFrame, rate: Column, turn: int = 0) -> DataFrame:
    """rows drawn with chance size * rate, at most 1, with weight: a row with a larger product counts as many times as it says. The draw is by hash, another one in each turn, so it is the same on each run."""
    chance = F.pmod(F.xxhash64(F.lit(turn), "k1", "k2", "k3"), F.lit(1 << 53)) / float(1 << 53)
    return rows.withColumn("weight", F.col("size") * rate).where(chance < F.col("weight")).withColumn("weight", F.greatest(F.lit(1.0), "weight"))


def quantiles(keys: list[tuple], ranges: int) -> set[tuple[int, int, int]]:
    """The keys (k1, k2, k3, weight) at the weighted quantiles."""
    keys = sorted(keys)
    if not keys:
        return set()
    before = np.cumsum([k[3] for k in keys])
    return {tuple(keys[i][:3]) for i in np.searchsorted(before, before[-1] * np.arange(1, ranges) / ranges)}


def range_of(bounds: list[tuple[int, int, int]]):
    """How many of the boundaries are at or below a key (a pandas UDF over k1, k2, k3)."""
    b1 = np.array([b[0] for b in bounds], np.int64)

    @F.pandas_udf("int")
    def find(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        v1 = k1.to_numpy(np.int64)
        low, high = np.searchsorted(b1, v1, "left"), np.searchsorted(b1, v1, "right")
        out = low.copy()
        tied = np.nonzero(low < high)[0]  # the first part is a boundary's: the others decide
        for v in np.unique(v1[tied]):
            rows = tied[v1[tied] == v]
            lo, hi = low[rows[0]], high[rows[0]]
            rest = np.array([bounds[i][1:] for i in range(lo, hi)], np.int64)
            x2, x3 = k2.to_numpy(np.int64)[rows], k3.to_numpy(np.int64)[rows]
            lo2, hi2 = np.searchsorted(rest[:, 0], x2, "left"), np.searchsorted(rest[:, 0], x2, "right")
            n = lo2 + [np.searchsorted(rest[a:b, 1], z, "right") for a, b, z in zip(lo2, hi2, x3)]
            out[rows] = lo + n
        return pd.Series(out.astype(np.int32))

    return find


def ranged(rows: DataFrame, ranges: int, draws: int = DRAWS, overfull: float = OVERFULL) -> DataFrame:
    """rows with range: an int, ascending with the key; a range holds over `overfull` times the mean only where a single row does, or where keys that lie side by side do.

    Boundaries come from a size-weighted sample of ranges * draws keys at most. Ranges that turn out overfull are sampled
    again, all in one pass and twice as densely each time, until none can be cut.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    key = ["k1", "k2", "k3", "weight"]
    bounds = sorted(quantiles([tuple(r) for r in drawn(rows, F.lit(ranges * draws / max(1, total))).select(key).collect()], ranges))
    for turn in count(1):
        placed = rows.withColumn("range", range_of(bounds)("k1", "k2", "k3"))
        # few at most: the sample cuts most ranges near the mean
        full = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where((F.col("bytes") > overfull * total / ranges) & (F.col("n") > 1))
        sizes = {r["range"]: r["bytes"] for r in full.collect()}
        parts = {r: int(np.ceil(n * ranges / total)) for r, n in sizes.items()}
        if not parts:
            break
        rates = rows.sparkSession.createDataFrame([(r, n * draws * 2.0**turn / sizes[r]) for r, n in parts.items()], "range int, rate double")
        found: dict[int, list[tuple]] = {r: [] for r in parts}
        for r in drawn(placed.join(F.broadcast(rates), "range"), F.col("rate"), turn).select("range", *key).collect():
            found[r["range"]].append(tuple(r)[1:])
        more = sorted({*bounds}.union(*(quantiles(keys, parts[r]) for r, keys in found.items())))
        if len(more) == len(bounds):
            break
        bounds = more
    return rows.withColumn("range", range_of(bounds)("k1", "k2", "k3"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """One row per row of docs: id, size, text_crc32, shard and slot; shards are of nearly equal bytes and in key order.

    A row lies in the shard in which its middle byte does. Slots count a shard's rows from 0 without gaps, in key
    order. Null and empty texts have size OVERHEAD; null ids come first within their text. Rows that are alike in text
    and id are placed by their number, so even a third of all rows alike is spread. Fewer rows than shards leave some
    shards empty; an empty table gives no rows. Other columns are ignored.
    """
    rows = written(sized(docs, id_col, text_col))
    placed = written(ranged(rows, max(shards * ranges, -(-rows.count() // rows_a_range))).select("id", "size", "k1", "k2", "k3", "range"))
    # one row per range, with the bytes before it: a range has some million rows
    per = placed.groupBy("range").agg(F.sum("size").alias("bytes"))
    per = per.withColumn("before", F.sum("bytes").over(Window.orderBy("range")) - F.col("bytes")).withColumn("total", F.sum("bytes").over(Window.partitionBy()))
    key = Window.partitionBy("range").orderBy("k1", "k2", "k3")
    middle = F.col("before") + F.sum("size").over(key.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    cut = placed.join(F.broadcast(per), "range").select("range", "id", "size", "k1", "k2", "k3", F.least(F.lit(shards - 1), F.floor(middle * shards / F.col("total"))).cast("int").alias("shard"))
    cut = cut.withColumn("at", F.row_number().over(Window.partitionBy("range", "shard").orderBy("k1", "k2", "k3")))
    cut = written(cut)
    # a shard's part of a range, with the shard's rows before it
    parts = cut.groupBy("range", "shard").agg(F.count("*").alias("n"))
    parts = parts.select("range", "shard", (F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).alias("earlier"))
    return cut.join(F.broadcast(parts), ["range", "shard"]).select(F.col("id").alias(id_col), "size", F.col("k1").alias("text_crc32"), "shard", (F.col("earlier") + F.col("at") - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id") -> None:
    """Write docs as Parquet with a folder per shard, rows in slot order; ids must be unique and not null."""
    placed = shard_rows(docs, shards, id_col).select(id_col, "shard", "slot")
    docs.join(placed, id_col).repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
