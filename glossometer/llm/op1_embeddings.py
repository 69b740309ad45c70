"""Embedding near-duplicates by cross-polytope hashing.

Vectors are rotated by fast Hadamard transforms with random signs; a rotation's hash is the axis, with its sign, that
is closest to the rotated vector. A table joins the hashes of K rotations to a bucket; each vector lies in its own
bucket of every table and visits the next likely ones (multiprobe). Only buckets' keys and vectors' ids are shuffled at
first; a vector is fetched for the buckets in which it meets another one, and K follows from the number of vectors so
that few meet by chance. Pairs that meet are compared in double precision.

Equal vectors are one class, compared once. A bucket's members are cut into blocks of bounded size; pairs of blocks
return a spanning set of links and each class's number of links, so pairs are never listed. A pair that meets in several
buckets counts in one of them only, which the keys of both tell: numbers of links cost what the candidates cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, table, written
from .components import components

THRESHOLD = 0.95
PROBES, SEED = 3, 20240229
#: Tables by K (from 1): a table finds a pair of cosine 0.95 with a chance of about 0.54, 0.39, 0.26 and 0.17 for K = 3 to 6 (width 64, three probes), so that all together miss 5 in a thousand at most.
TABLES = (8, 8, 8, 12, 18, 28)
#: Members of a block, rows of a cell (a task's unit: some pairs of blocks), members of a block whose pairs are listed inside a task, and pairs compared at once.
BLOCK, CELL, FEW, PAIRS = 512, 8192, 32, 50_000
#: Linked pairs whose first common table is looked for at once.
OWNERS = 10_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def rotations(width: int, n: int) -> np.ndarray:
    """Random signs of n rotations of three transforms each."""
    return np.random.default_rng(SEED).choice([-1.0, 1.0], size=(n, 3, width))


def buckets(x: np.ndarray, k: int, tables: int, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, 1 + probes): each vector's own bucket, then the likeliest others."""
    width = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    signs = rotations(width, tables * k)
    out = np.zeros((len(x), tables, 1 + probes), np.int64)
    for t in range(tables):
        best, loss = [], []
        for r in range(k):
            y = x
            for s in signs[t * k + r]:
                y = hadamard(y * s)
            axes = np.argsort(-np.abs(y), axis=1, kind="stable")[:, : 1 + probes]
            value = np.take_along_axis(y, axes, 1)
            best.append(axes + width * (value < 0))
            loss.append(np.abs(value[:, :1]) - np.abs(value))  # what it costs to take the next axis
        own = [b[:, 0] for b in best]
        changes = sorted((r, j) for r in range(k) for j in range(1, best[0].shape[1]))
        order = np.argsort(np.stack([loss[r][:, j] for r, j in changes], axis=1), axis=1, kind="stable")
        for p in range(1 + probes):
            code = np.zeros(len(x), np.int64)
            for r in range(k):
                part = own[r].copy()
                if p and p <= len(changes):
                    for c, (cr, cj) in enumerate(changes):
                        if cr == r:
                            taken = order[:, p - 1] == c
                            part[taken] = best[r][taken, cj]
                code = code * (2 * width) + part
            out[:, t, p] = code
    return out


def unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rotations_for(size: int, width: int, probes: int = PROBES) -> int:
    """K for so many vectors: as many buckets as vectors have places in a table."""
    directions = 2 << max(1, int(width - 1).bit_length())
    return min(len(TABLES), max(1, int(np.ceil(np.log(max(2, (1 + probes) * size)) / np.log(directions)))))


def coded(classes: DataFrame, k: int, tables: int, probes: int) -> DataFrame:
    """(rep, keys): for each table the hash of a class's own bucket and those of the ones that it visits, one after the other.

    Tables, widths and buckets are mixed to one key: two buckets that share one make candidates only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, g in batch.groupby(batch["v"].map(len)):  # vectors of another width never meet
                key = buckets(unit(g["v"]), k, tables, probes).astype(np.uint64)
                key = (key + np.arange(tables, dtype=np.uint64)[None, :, None] * np.uint64(0x9E3779B97F4A7C15) + np.array(width, np.uint64) * np.uint64(0x94D049BB133111EB)) * np.uint64(0xBF58476D1CE4E5B9)
                key = (key ^ (key >> np.uint64(31))).view(np.int64).reshape(len(g), -1)
                yield pd.DataFrame({"rep": g["rep"].to_numpy(), "keys": list(key)})

    return classes.select("rep", "v").mapInPandas(run, "rep long, keys array<long>")


def near(group: np.ndarray, low: np.ndarray, same: np.ndarray, home: np.ndarray, x: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of rows of one group that are near: of a block with itself (same), or of the lower block (low) with the other. One of the two is at home. group is ascending."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(starts, append=len(group))
    few = np.repeat(sizes <= FEW, sizes)
    later = np.where(few, np.searchsorted(group, group, "right") - np.arange(len(group)) - 1, 0)  # rows of the group behind each row
    done, start = np.cumsum(later), 0
    while start < len(group):
        end = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + PAIRS)))
        i = np.repeat(np.arange(start, end), later[start:end])
        j = i + 1 + np.arange(len(i)) - np.repeat(done[start:end] - later[start:end] - (done[start - 1] if start else 0), later[start:end])
        start = end
        met = (same[i] | (low[i] != low[j])) & (home[i] | home[j])
        i, j = i[met], j[met]
        close = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        if close.any():
            yield i[close], j[close]
    for start, size in zip(starts[sizes > FEW], sizes[sizes > FEW]):
        rows = np.arange(start, start + size)
        a, b = (rows, rows) if same[start] else (rows[low[rows]], rows[~low[rows]])
        close = (x[a] @ x[b].T >= threshold) & (home[a][:, None] | home[b])
        i, j = np.nonzero(np.triu(close, 1) if same[start] else close)
        if len(i):
            yield a[i], b[j]


def owned(low: np.ndarray, high: np.ndarray, turn: np.ndarray, low_home: np.ndarray) -> np.ndarray:
    """Whether a bucket is the one in which a pair counts: keys of both (pairs, tables, 1 + probes), the bucket's table, and whether the smaller id is at home there.

    That is in the first table in which one's own bucket is the other's or one that it visits; and of two such buckets in that table the smaller id's own.
    """
    visited = (low[:, :, :1] == high).any(axis=2)
    first = (visited | (high[:, :, :1] == low).any(axis=2)).argmax(axis=1)
    return (first == turn) & (low_home | ~visited[np.arange(len(turn)), turn])


def compare(threshold: float, tables: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        """Some pairs of blocks: each class with the least one that it reaches here, and its number of links that count here."""
        cell = cell.assign(width=cell["v"].map(len)).sort_values([*(key := ["key", "width", "b_low", "b_high"]), "rep", "visits"], kind="stable")
        group = (cell[key].diff() != 0).any(axis=1).cumsum().to_numpy()
        keep = ~pd.DataFrame({"g": group, "r": cell["rep"].to_numpy()}).duplicated().to_numpy()  # at home or, if it is only visiting, once
        cell, group = cell[keep], group[keep]
        rep, home, n, turn = cell["rep"].to_numpy(), ~cell["visits"].to_numpy(), cell["n"].to_numpy(), cell["turn"].to_numpy()
        widths = cell["width"].to_numpy()
        x = np.zeros((len(cell), int(widths.max())))
        for width in np.unique(widths):
            x[widths == width, :width] = unit(cell["v"][widths == width])
        ids, at = np.unique(rep, return_inverse=True)
        first = np.unique(at, return_index=True)[1]
        keys = np.stack(cell["keys"].iloc[first].to_numpy()).reshape(len(ids), tables, -1)
        root, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for i, j in near(group, cell["own_low"].to_numpy(), (cell["b_low"] == cell["b_high"]).to_numpy(), home, x, threshold):
            a, b = at[i], at[j]
            for start in range(0, len(a), OWNERS):
                p, q = i[start : start + OWNERS], j[start : start + OWNERS]
                p, q = np.where(at[p] < at[q], p, q), np.where(at[p] < at[q], q, p)
                counts = owned(keys[at[p]], keys[at[q]], turn[p], home[p])
                np.add.at(links, at[p[counts]], n[q[counts]])
                np.add.at(links, at[q[counts]], n[p[counts]])
            while True:
                before = root.copy()
                np.minimum.at(root, a, root[b])
                np.minimum.at(root, b, root[a])
                root = root[root]
                if (root == before).all():
                    break
        while (root[root] != root).any():
            root = root[root]
        told = (ids[root] != ids) | (links > 0)
        return pd.DataFrame({"rep": ids, "root": ids[root], "links": links})[told]

    return run


def compared(members: DataFrame, classes: DataFrame, keys: DataFrame, tables: int, block: int, threshold: float) -> DataFrame:
    """(rep, root, links) from members (key, turn: its table, rep, visits, members of the key): pairs of their blocks, compared cell by cell."""
    dealt = members.withColumn("blocks", F.ceil(F.col("members") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    cells = max(1, (dealt.agg(F.sum("blocks")).first()[0] or 0) // CELL)
    dealt = dealt.join(classes.select("rep", "n", "v"), "rep").join(keys, "rep")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("low"), F.greatest(o, F.col("own")).alias("high"))))
    groups = dealt.select("*", pair.alias("p")).select("key", "turn", F.col("p.low").alias("b_low"), F.col("p.high").alias("b_high"), "rep", "n", "v", "keys", "visits", (F.col("own") == F.col("p.low")).alias("own_low"))
    cell = F.pmod(F.xxhash64("key", "b_low", "b_high"), F.lit(cells)).alias("cell")
    return groups.groupBy(cell).applyInPandas(compare(threshold, tables), "rep long, root long, links long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tables: int | None = None, probes: int = PROBES, block: int = BLOCK, k: int | None = None) -> DataFrame:
    """One row per row of vectors: id, n_links, component_id and kept.

    A vector that is null, empty or zero, or holds a null or non-finite component, links with nothing; vectors of
    different widths don't link. Equal vectors are found for certain and others with a high chance: recall is measured
    in the tests. Rows that repeat an id and vector link like any two equal vectors. Rows with a null id are returned
    without links and count for nobody. An empty table gives no rows; other columns are ignored. k, the rotations of a
    table, follows from the number of distinct vectors if it isn't given, and tables from k. Equal vectors are told by
    128 bits of hash where rows are given their results.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("v", lambda x: x != 0)
    fit = F.coalesce(F.col("id").isNotNull() & F.col("v").isNotNull() & finite, F.lit(False))
    good = rows.where(fit)
    classes = written(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).select("rep", "n", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")))
    size, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    k = k or rotations_for(size, width or 1, probes)
    tables = tables or TABLES[min(k, len(TABLES)) - 1]

    keys = written(coded(classes, k, tables, probes))
    each = keys.select("rep", F.posexplode("keys").alias("at", "key")).select("key", F.expr(f"CAST(at DIV {1 + probes} AS INT)").alias("turn"), "rep", (F.col("at") % (1 + probes) > 0).alias("visits"))
    # a bucket counts if somebody is at home in it and somebody else is there
    met = written(each.groupBy("key").agg(F.count("*").alias("members"), F.count(F.when(~F.col("visits"), 1)).alias("home"), F.min("rep").alias("a"), F.max("rep").alias("b")).where("home > 0 AND a < b").select("key", "members"))
    found = written(compared(written(each.join(broadcast_if_small(met), "key")), classes, keys, tables, block, threshold))
    linked = written(components(found, "rep", "root"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    by_class = written(classes.select("rep", "n", "h1", "h2").join(links, "rep", "left").join(linked.withColumnRenamed("node", "rep"), "rep", "left").select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    hashed = rows.select("id", F.when(fit, F.xxhash64("v")).alias("h1"), F.when(fit, F.xxhash64(F.lit(1), "v")).alias("h2"))
    joined = hashed.join(by_class, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs by brute force.
ORACLE = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), u AS (
    SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), p AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
    WITH RECURSIVE c(a, b) AS (SELECT vec_id, vec_id FROM u UNION SELECT c.a, p.b FROM c JOIN p ON c.b = p.a) SELECT a, min(b) AS component_id FROM c GROUP BY a
), n AS (
    SELECT a, count(*) AS n_links FROM p GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN r ON r.a = vec_id
"""
