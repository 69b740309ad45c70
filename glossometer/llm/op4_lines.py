"""Line deduplication over levelled sorted runs of line hashes.

A store of runs remembers every line key (a 128-bit hash) that has come by: each run is a table with one file a bucket,
sorted by the key, and each key is in one run only. A batch of documents is merged against the runs: its keys that no run
holds (a merge-anti-join of co-located buckets, so the runs are neither moved nor sorted again) become a run of level 0; its keys that are known
become a small run of increments. When a level is full, its runs merge into one of the next level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import aside, broadcast_if_small, lower_ascii, table, unused, written

MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 3
#: Keys of a store that make a bucket, and the fewest and the most buckets: beyond these, buckets hold more keys.
KEYS_A_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 8, 50_000
#: Makes Spark trust the order of a bucket that is one file.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: ASCII white space: tab, line feed, vertical tab, form feed, carriage return and space.
STRIPPED = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(STRIPPED)))


def hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def document_keys(docs: DataFrame, batch: Column, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(batch, h1, h2, n_docs, keeper): each batch's line keys, in how many of its documents, and the largest id."""
    keys = F.array_distinct(F.filter(F.transform(lines(F.col(text_col)), line_key), lambda k: F.char_length(k) >= min_chars))
    each = docs.select(batch.alias("batch"), F.col(id_col).cast("long").alias("id"), F.explode(F.transform(keys, hashed)).alias("k")).select("batch", "id", "k.h1", "k.h2")
    return each.groupBy("batch", *KEY).agg(F.count("*").alias("n_docs"), F.max("id").alias("keeper"))


class LineRuns:
    """Runs of (h1, h2, n_docs, keeper) as bucketed tables of the session's warehouse."""

    def __init__(self, spark: SparkSession, buckets: int = LEAST_BUCKETS, fanout: int = FANOUT):
        if not spark.sparkContext.master.startswith("local") and not spark.sparkContext.getConf().get("spark.sql.warehouse.dir"):
            raise ValueError("spark.sql.warehouse.dir has to name a folder that driver and executors share")
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.name, self.made = f"line_runs_{uuid.uuid4().hex}", 0
        self.tables: set[str] = set()
        #: Tables by level; keys of the runs are disjoint.
        self.runs: dict[int, list[str]] = {}
        #: Small and not disjoint: plain files, since Spark 4.1.2 loses rows' partitioning in an aggregate over a union of bucketed tables.
        self.increments: list[DataFrame] = []

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"{self.name}_{self.made}"
        self.tables.add(name)
        # a task is a bucket, and a bucket one file: hashing by the key is how Spark places rows in buckets too
        rows.select(*KEY, "n_docs", "keeper").repartition(self.buckets, *KEY).sortWithinPartitions(*KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name, format="parquet")
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.tables.discard(name)

    def __enter__(self) -> LineRuns:
        self.before = self.spark.conf.get(ORDERED, None)
        self.spark.conf.set(ORDERED, "true")
        return self

    def __exit__(self, *failure) -> None:
        """A job that fails leaves no tables either."""
        if self.before is None:
            self.spark.conf.unset(ORDERED)
        else:
            self.spark.conf.set(ORDERED, self.before)
        self._drop(list(self.tables))

    def all_runs(self) -> list[str]:
        return [name for level in self.runs.values() for name in level]

    def unknown(self, batch: DataFrame) -> DataFrame:
        """The batch's rows with keys that no run holds."""
        for run in self.all_runs():
            batch = batch.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Merge one batch's distinct keys (h1, h2, n_docs, keeper): unknown ones become a run, known ones an increment."""
        new = self.unknown(batch)
        first, fresh = not self.all_runs(), self._write(new)
        if not first:
            self.increments.append(written(batch.join(self.spark.table(fresh).select(*KEY), KEY, "left_anti").select(*KEY, "n_docs", "keeper")))
        self.runs.setdefault(0, []).append(fresh)
        level = 0
        while len(self.runs.get(level, [])) >= self.fanout:
            self.runs.setdefault(level + 1, []).append(self._merge(self.runs.pop(level)))
            level += 1

    def _merge(self, names: list[str]) -> str:
        """One run from several: their keys are disjoint, so nothing has to be summed."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = rows.unionByName(self.spark.table(name))
        merged = self._write(rows)
        self._drop(names)
        return merged

    def common(self, min_docs: int) -> DataFrame:
        """(h1, h2, keeper) of the keys found in at least min_docs documents, written to shared storage."""
        more = None
        for rows in self.increments:
            more = rows if more is None else more.unionByName(rows)
        if more is not None:
            summed = self._write(more.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper")))
            more = self.spark.table(summed).select(*KEY, F.col("n_docs").alias("more_docs"), F.col("keeper").alias("more_keeper"))
        found = None
        for run in self.all_runs():
            rows = self.spark.table(run)
            if more is not None:
                rows = rows.join(more, KEY, "left").select(*KEY, (F.col("n_docs") + F.coalesce("more_docs", F.lit(0))).alias("n_docs"), F.greatest("keeper", "more_keeper").alias("keeper"))
            rows = rows.where(F.col("n_docs") >= min_docs).select(*KEY, "keeper")
            found = rows if found is None else found.unionByName(rows)
        out = written(found)
        self._drop(list(self.tables))
        self.runs, self.increments = {}, []
        return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, batch: Column | None = None) -> DataFrame:
    """docs with three more columns: kept_text, n_lines and n_dropped.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of min_chars code points or
    more that at least min_docs rows hold lose all their lines but those in the row of the largest id that holds it.
    batch: the batch of a row, from 0; by default a hash of the id deals rows into batches.

    Null and empty texts are one empty line. Rows that repeat an id are documents of their own and keep or lose a line
    alike. A null id is smaller than any other; a key held by null ids only keeps its lines. An empty table gives no
    rows. Other columns stay; any called kept_text, n_lines or n_dropped are replaced.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)).cast("int") if batch is None else batch
    # sorted by batch, so that a batch's read skips the pages of others
    staged = written(document_keys(docs, batch, id_col, text_col, min_chars).sortWithinPartitions("batch"))
    with LineRuns(spark, min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-staged.count() // KEYS_A_BUCKET)))) as store:
        for n in range(batches):
            store.add(staged.where(F.col("batch") == n).select(*KEY, "n_docs", "keeper"))
        common = store.common(min_docs)

    # the places to drop, by id and text: rows that are alike in both lose the same lines
    places = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.posexplode(F.transform(lines(F.col(text_col)), line_key)).alias("at", "key")).where(F.char_length("key") >= min_chars).select("id", "text_hash", "at", hashed(F.col("key")).alias("k")).select("id", "text_hash", "at", "k.h1", "k.h2")
    drops = places.join(broadcast_if_small(common), KEY).where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "text_hash").agg(F.collect_set("at").alias("dropped"))
    drops = broadcast_if_small(written(drops))

    rows = docs.drop("kept_text", "n_lines", "n_dropped")
    text, dropped, own = unused("text_", rows), unused("dropped_", rows), unused("lines_", rows)
    joined = rows.alias("d").join(drops.alias("x"), F.col(f"d.`{id_col}`").cast("long").eqNullSafe(F.col("x.id")) & (F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("x.text_hash")), "left")
    # the lines are a column of their own, used twice, so that the optimizer doesn't split the text for each line
    joined = joined.select("d.*", F.col(f"d.`{text_col}`").alias(text), F.col("x.dropped").alias(dropped), lines(F.col(f"d.`{text_col}`")).alias(own))
    kept = F.when(F.col(dropped).isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col(dropped)), lambda i: F.get(own, i)), "\n"))
    return joined.withColumn("kept_text", kept).withColumns({"n_lines": F.size(own).cast("long"), "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long")}).drop(text, dropped, own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its kept lines as the text; n_chars follows the text. A document that loses all its lines stays, with an empty text."""
    named, columns = aside(docs, "doc_id", "text")
    instead = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return dedup_lines(named).select(*(instead[c].alias(c) if c in instead else column for c, column in zip(docs.columns, columns)))


ORACLE = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), k AS (
    SELECT doc_id, pos, line, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
), c AS (
    SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> k.doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY k.doc_id
"""
