"""Hard negatives by full score sorts.

Anchors and rows are dealt to cells of a block of anchors and a block of rows, so a task holds two blocks whatever
the table's size. In a cell all integer scores of an anchor are sorted, by score from the highest and then by id. A
first pass reads each anchor's first same-label entries from every cell's sorted scores; the first ones of all cells are
its positives. A second pass brings these along: in each cell's sorted scores a binary search finds the place of a
positive's upper limit, from where the first different-label entries above the lower limit are read. The first ones of
all cells are the negatives. Scores are computed twice, so that no list of an anchor's scores leaves its cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, table, written

POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 80, 100
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Anchors and rows of a cell, scores held at once, and cells whose first entries are merged at a time.
ANCHORS, ROWS, SCORES, MERGED = 1024, 8192, 1 << 21, 64


def integer_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in double precision where all sums stay below 2^53, else in 64 bits; beyond these an error."""
    most = anchors.shape[1] * float(np.abs(anchors.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0))
    if most < 2.0**53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most * 100 >= 2.0**63:
        raise OverflowError("a score times 100 may exceed 64 bits")
    return anchors @ rows.T


def sorted_scores(cell: pd.DataFrame):
    """For some anchors at a time: (their places in the cell, ids, labels and vectors' order of the rows by score, the sorted scores)."""
    a, r = cell[cell["anchor"]], cell[~cell["anchor"]].sort_values("id", kind="stable")
    if not len(a) or not len(r):
        return
    rows, anchors = np.stack(r["v"].to_numpy()), np.stack(a["v"].to_numpy())
    ids, labels = r["id"].to_numpy(np.int64), r["label"].to_numpy(np.int64)
    step = max(1, SCORES // len(r))
    for at in range(0, len(a), step):
        some = a.iloc[at : at + step]
        scores = integer_scores(anchors[at : at + step], rows)
        order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)
        yield some, ids[order], labels[order], np.take_along_axis(scores, order, 1)


def first_positives(n: int):
    def run(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        """Each anchor's first n other rows of its label in this cell."""
        out = []
        for some, ids, labels, scores in sorted_scores(cell):
            for k, (anchor, label) in enumerate(zip(some["id"], some["label"])):
                at = np.flatnonzero((labels[k] == label) & (ids[k] != anchor))[:n]
                out.append(pd.DataFrame({"anchor_id": anchor, "part": key[-1], "id": ids[k, at], "score": scores[k, at]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("anchor_id", "part", "id", "score")}, dtype=np.int64)

    return run


def first_negatives(n: int, low: int, high: int):
    def run(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        """For each anchor and positive the first n rows of another label within the limits in this cell."""
        out = []
        for some, ids, labels, scores in sorted_scores(cell):
            for k, (anchor, label, positives) in enumerate(zip(some["id"], some["label"], some["positives"])):
                others = np.flatnonzero(labels[k] != label)
                falling = -100 * scores[k, others]  # ascending
                for p in positives:
                    start = int(np.searchsorted(falling, -high * p["score"], "left"))
                    end = min(start + n, int(np.searchsorted(falling, -low * p["score"], "right")))
                    if start < end:
                        at = others[start:end]
                        out.append(pd.DataFrame({"anchor_id": anchor, "positive_id": p["id"], "positive_score": p["score"], "part": key[-1], "id": ids[k, at], "score": scores[k, at]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("anchor_id", "positive_id", "positive_score", "part", "id", "score")}, dtype=np.int64)

    return run


def block(size: int, rows: int) -> Column:
    """The block of an id: so many that blocks hold about `rows`."""
    return F.pmod(F.xxhash64("id"), F.lit(max(1, -(-size // rows)))).cast("int")


def first(df: DataFrame, by: list[str], n: int, parts: int) -> DataFrame:
    """(by, first): the first n of (less, id) of each group, by score from the highest (less is its negative), then by id.

    Each of the parts sends n at most. They are merged MERGED parts at a time, so no group of a merge holds more than
    n * MERGED entries.
    """
    listed = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "id"))), 1, n).alias("first")
    while parts > MERGED:
        parts = -(-parts // MERGED)
        df = df.groupBy(*by, F.expr(f"part DIV {MERGED}").alias("part")).agg(listed).select(*by, "part", F.explode("first").alias("f")).select(*by, "part", "f.id", (-F.col("f.less")).alias("score"))
    return df.groupBy(*by).agg(listed)


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, anchor_rows: int = ANCHORS, cell_rows: int = ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); anchors: a condition on the column id.

    A component x becomes floor(scale * x), and a score is the integer inner product with the anchor. An anchor's
    positives are its first n_positives other rows of the same label; for each, the first n_negatives rows of another
    label with low * positive_score <= 100 * negative_score <= high * positive_score are returned. Higher
    scores come first, ties by the smaller id.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part. An id stands for
    one row: of rows that repeat one the least by label, then vector. Vectors of different widths never meet. An anchor
    without positives, and a positive without negatives, give no rows, as does an empty table. Other columns are ignored. Scores that times
    100 may exceed 64 bits are an error.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    sound = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & sound).select("id", F.struct("label", whole.alias("v")).alias("r"))
    one = written(good.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v", F.size("r.v").alias("width")))
    chosen = written(one.where(anchors))
    size, n_anchors = one.count(), chosen.count()

    # cells: every block of rows meets every block of anchors of its width
    columns = ["width", "a_block", "r_block", "anchor", "id", "label", "v"]
    a_blocks, r_blocks = max(1, -(-n_anchors // anchor_rows)), max(1, -(-size // cell_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt_rows = one.withColumn("r_block", block(size, cell_rows)).select("*", every(a_blocks).alias("a_block"), F.lit(False).alias("anchor"))
    dealt = lambda a: a.withColumn("a_block", block(n_anchors, anchor_rows)).select("*", every(r_blocks).alias("r_block"), F.lit(True).alias("anchor"))
    by = ["width", "a_block", "r_block"]

    cells = dealt_rows.select(columns).unionByName(dealt(chosen).select(columns)).groupBy(*by)
    found = cells.applyInPandas(first_positives(n_positives), "anchor_id long, part long, id long, score long")
    positives = first(found, ["anchor_id"], n_positives, r_blocks)
    kept = F.transform("first", lambda x: F.struct(x["id"].alias("id"), (-x["less"]).alias("score"))).alias("positives")
    known = written(chosen.join(broadcast_if_small(written(positives.select(F.col("anchor_id").alias("id"), kept))), "id"))

    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>").alias("positives")
    cells = dealt_rows.select(*columns, none).unionByName(dealt(known).select(*columns, "positives")).groupBy(*by)
    found = cells.applyInPandas(first_negatives(n_negatives, low, high), "anchor_id long, positive_id long, positive_score long, part long, id long, score long")
    last = first(found, ["anchor_id", "positive_id", "positive_score"], n_negatives, r_blocks)
    return last.select("anchor_id", "positive_id", "positive_score", F.posexplode("first").alias("at", "n")).select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", (-F.col("n.less")).alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("id") % 100 == 0)


#: All anchors against all rows.
ORACLE = """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.id AS anchor_id, a.label AS anchor_label, r.id, r.label, list_inner_product(a.e, r.e)::BIGINT AS score FROM v a JOIN v r ON a.id % 100 = 0 AND len(a.e) = len(r.e)
), p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label AND id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> anchor_label AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
