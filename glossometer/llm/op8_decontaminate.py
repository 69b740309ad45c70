"""Benchmark decontamination by a prefix-filtered set join.

A benchmark window is a set of placed five-word shingles. A document that holds the window holds all of them, so one
shingle of each window, its prefix, is enough to find the document, and the rarest makes the fewest candidates. The
order by rarity counts the shingles in all documents; a window with a shingle that no document holds is out at once.
Candidates whose place doesn't fit into the document are out (positional and length bounds); for the rest the words
themselves are compared over the whole window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, aside, broadcast_if_small, grams, lower_ascii, table, words, written

WINDOW, SHINGLE = 10, 5


def benchmark_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(window_text, n, items): every distinct window, its length in words and the items that have it."""
    w = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    cut = F.when(F.size("w") < window, F.array(F.array_join("w", " "))).otherwise(grams(F.col("w"), window))
    return w.select("item", F.least(F.size("w"), F.lit(window)).alias("n"), F.explode(F.array_distinct(cut)).alias("window_text")).groupBy("window_text", "n").agg(F.collect_set("item").alias("items"))


def hashed_grams(w: Column, k: int) -> Column:
    """The hashes of all k consecutive words. Candidates are compared word by word later, so two shingles of one hash only make a candidate more."""
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k))))).otherwise(F.array().cast("array<bigint>"))


def shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(window_text, n, k, offset, token): each window's placed shingles of k words, hashed; k is less than shingle only where the window is shorter."""
    w = windows.select("window_text", "n", F.split("window_text", " ").alias("w")).withColumn("k", F.least("n", F.lit(shingle)))
    tokens = F.lit(None).cast("array<bigint>")
    for k in range(1, shingle + 1):
        tokens = F.when(F.col("k") == k, hashed_grams(F.col("w"), k)).otherwise(tokens)
    return w.select("window_text", "n", "k", F.posexplode(tokens).alias("offset", "token"))


def document_tokens(docs: DataFrame, id_col: str, text_col: str, lengths: list[int]) -> DataFrame:
    """(id, text_hash, n_words, k, at, token): all hashed shingles of the given lengths of every document. Documents are told by id and text: ids may be null or repeated."""
    w = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words(F.col(text_col)).alias("w"))
    parts = [w.select("id", "text_hash", F.size("w").alias("n_words"), F.lit(k).alias("k"), F.posexplode(hashed_grams(F.col("w"), k)).alias("at", "token")) for k in lengths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _covered(places: Column) -> Column:
    """Words inside the union of (at, n) intervals that are sorted by at."""
    step = lambda s, p: F.struct((s["n"] + F.greatest(F.lit(0), p["at"] + p["n"] - F.greatest(p["at"], s["end"]))).alias("n"), F.greatest(s["end"], p["at"] + p["n"]).alias("end"))
    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda s: s["n"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """docs with n_words, n_hit, n_items, hit_items (sorted strings) and contaminated.

    A word is hit where it lies in an occurrence of a window: WINDOW consecutive words of an item, or a shorter
    item's whole words. Null and empty texts have no words, and items without words have no windows. Rows that repeat
    an id are judged each by its own text; null ids are kept and judged too. Items that share an id count once. An
    empty benchmark hits nothing; an empty table gives no rows. Other columns stay; those of the names above are replaced.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "hit_items", "contaminated")
    windows = written(benchmark_windows(items, item_col))
    tokens = written(shingles(windows))
    lengths = sorted(r[0] for r in tokens.select("k").distinct().collect()) or [SHINGLE]
    known = broadcast_if_small(tokens.select("token").distinct())
    hits = written(document_tokens(docs, id_col, text_col, lengths).join(known, "token"))

    # rarity over all documents; the inner join drops windows with a shingle that no document holds
    counts = hits.groupBy("k", "token").agg(F.count("*").alias("frequency"))
    rated = tokens.join(counts, ["k", "token"]).groupBy("window_text", "n", "k").agg(F.count("*").alias("found"), F.min(F.struct("frequency", "token", "offset")).alias("rarest"))
    prefixes = written(rated.where("found = n - k + 1").select("window_text", "n", "k", "rarest.token", "rarest.offset"))
    placed = hits.join(broadcast_if_small(prefixes), ["k", "token"]).select("id", "text_hash", "n_words", (F.col("at") - F.col("offset")).alias("at"), "n", "window_text").where("at >= 0 AND at + n <= n_words")
    candidates = broadcast_if_small(written(placed.groupBy("id", "text_hash").agg(F.collect_set(F.struct("at", "n", "window_text")).alias("candidates"))))

    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    w = texts.join(candidates, F.col("doc").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("text_hash"))).select("id", "text_hash", words(F.col("text")).alias("w"), "candidates")
    # with two uses of w the optimizer doesn't move its expression into the lambda
    true = F.filter("candidates", lambda c: (c["at"] + c["n"] <= F.size("w")) & (F.array_join(F.slice("w", c["at"] + 1, c["n"]), " ") == c["window_text"]))
    # (and with the filter behind the written table, it can't move it there on the filter's behalf)
    occurring = written(w.select("id", "text_hash", F.array_sort(true).alias("places")).distinct()).where("size(places) > 0")

    covered = occurring.select("id", "text_hash", _covered(F.col("places")).cast("long").alias("n_hit"))
    there = occurring.select("id", "text_hash", F.explode(F.array_distinct(F.transform("places", lambda c: c["window_text"]))).alias("window_text"))
    named = there.join(windows.select("window_text", F.explode("items").alias("item")), "window_text").groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("hit_items"))
    by_null_safe = lambda x, y: F.col(f"{x}.id").eqNullSafe(F.col(f"{y}.id")) & (F.col(f"{x}.text_hash") == F.col(f"{y}.text_hash"))
    summary = written(covered.alias("a").join(named.alias("b"), by_null_safe("a", "b")).select("a.*", "b.hit_items"))

    summary = broadcast_if_small(summary)
    text = F.col(f"d.`{text_col}`")
    rows = docs.alias("d").join(summary.alias("s"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("s.id")) & (F.xxhash64(text) == F.col("s.text_hash")), "left")
    return rows.select(
        "d.*",
        F.regexp_count(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD)).cast("long").alias("n_words"),
        F.coalesce("s.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("s.hit_items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("s.hit_items", F.array().cast("array<string>")).alias("hit_items"),
        F.col("s.n_hit").isNotNull().alias("contaminated"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    docs, columns = aside(docs, "doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*columns)


ORACLE = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS t
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM bw
), dw AS (
    SELECT doc_id, n, i AS pos, array_to_string(w[i + 1 : i + n], ' ') AS t
    FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n)
), m AS (
    SELECT dw.doc_id, dw.pos, dw.n, bw.item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n
), h AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS p FROM m) GROUP BY doc_id
), i AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
