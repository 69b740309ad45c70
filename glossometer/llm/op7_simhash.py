"""SimHash near-duplicates by a self-join of the fingerprints' binary trie.

The trie's upper part is traversed by Spark: pairs of nodes descend together, eight bits a level, and a pair goes
as soon as its prefixes differ in more bits than the budget. A pair whose two nodes are small enough leaves the
traversal; what one small node has to meet becomes one group, in which numpy goes on in the same way down to the last bit. So a node never has
to fit in memory because of its popularity: it is divided as deep as it takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles
from .common import table, text_batches, written
from .components import components
from .shingles import bit_counts, majority

SHINGLE, BUDGET = 3, 2
#: Bits by which the distributed traversal descends, and fingerprints that a node may bring to one group.
STEP, LEAF = 8, 20_000
#: Node pairs that the traversal inside a group expands at once.
CHUNK = 200_000


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The text's fingerprint, signed; 0 for no words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and ASCII white space count
    if not tokens:
        return 0
    n = max(1, len(tokens) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = tokens[at : min(n, at + (1 << 15)) + shingle - 1]
        if len(part) < shingle:
            hashed = [xxhash.xxh64_intdigest(b" ".join(part), 42)]
        else:
            hashed = [xxhash.xxh64_intdigest(b" ".join(part[i : i + shingle]), 42) for i in range(len(part) - shingle + 1)]
        ones += bit_counts(np.array(hashed, np.uint64))
    return majority(ones, n)


def fingerprinted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint_of(x) for x in batch], dtype="int64")


def prefix(fp: Column, depth: int) -> Column:
    """The fingerprint's node at this depth."""
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def close_pairs(a: np.ndarray, b: np.ndarray, depth: int, budget: int = BUDGET, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Pairs x < y, one from each sorted distinct array of uint64, at most budget bits apart. Both arrays hang below one node each at depth."""

    def down(values: np.ndarray, at: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes at depth to, and for each node at depth at where its children begin and how many they are."""
        nodes = np.unique(values >> np.uint64(64 - to))
        above, first, n = np.unique(nodes >> np.uint64(to - at) if at else np.zeros(len(nodes), np.uint64), return_index=True, return_counts=True)
        return nodes, first, n

    left, right, at, single = np.zeros(1, np.int64), np.zeros(1, np.int64), depth, False
    while at < 64:
        to = 64 if single else min(64, at + step)
        nodes_a, first_a, n_a = down(a, at, to)
        nodes_b, first_b, n_b = down(b, at, to)
        kept_a, kept_b, combos = [], [], np.cumsum(n_a[left] * n_b[right])
        start = 0
        while start < len(left):
            end = max(start + 1, int(np.searchsorted(combos, (combos[start - 1] if start else 0) + 8 * CHUNK)))
            p, q = left[start:end], right[start:end]
            each = n_a[p] * n_b[q]
            k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            wide = np.repeat(n_b[q], each)
            i, j = np.repeat(first_a[p], each) + k // wide, np.repeat(first_b[q], each) + k % wide
            keep = np.bitwise_count(nodes_a[i] ^ nodes_b[j]) <= budget
            if a is b:
                keep &= i <= j
            kept_a.append(i[keep])
            kept_b.append(j[keep])
            start = end
        left, right, at = np.concatenate(kept_a), np.concatenate(kept_b), to
        single = len(nodes_a) == len(a) and len(nodes_b) == len(b)  # every node holds one value: what is left is compared at once
        if not len(left):
            break
    x, y = a[left], b[right]
    return (np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]) if len(left) else (a[:0], a[:0])


def spanning(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value of the links x, y with the least value that it reaches: as many links as values, with the same components."""
    values, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    i, j = at[: len(x)], at[len(x) :]
    root = np.arange(len(values))
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            keep = root != np.arange(len(values))
            return values[root][keep], values[keep]


def leaf_links(budget: int, few: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Links between one node's own fingerprints and those of all nodes that it is paired with."""
        own = np.unique(group.loc[~group["other"], "fp"].to_numpy(np.int64).view(np.uint64))
        x, y = close_pairs(own, np.unique(group["fp"].to_numpy(np.int64).view(np.uint64)), 0, budget)
        x, y = spanning(x, y) if few and len(x) else (x, y)
        return pd.DataFrame({"x": x.view(np.int64), "y": y.view(np.int64)}).drop_duplicates()

    return run


def close_fingerprints(distinct: DataFrame, budget: int = BUDGET, leaf: int = LEAF, few: bool = False) -> DataFrame:
    """(x, y): every pair of the distinct fingerprints (column fp) that differs in 1 to budget bits, once or twice.

    few: not every pair, but as many as keep the components, so that a dense group's pairs are never listed.
    """
    pairs, leaves, depth = None, None, 0
    while True:
        depth = min(64, depth + STEP)
        nodes = distinct.groupBy(prefix(F.col("fp"), depth - STEP).alias("up"), prefix(F.col("fp"), depth).alias("node")).agg(F.count("*").alias("n"))
        a = nodes.select(F.col("up").alias("a_up"), F.col("node").alias("a"), F.col("n").alias("a_n"))
        b = nodes.select(F.col("up").alias("b_up"), F.col("node").alias("b"), F.col("n").alias("b_n"))
        near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= budget) & ((F.col("a_up") < F.col("b_up")) | (F.col("a") <= F.col("b")))
        if pairs is None:  # all nodes hang below the root: each meets those that it becomes by changing up to budget bits
            masks = [m for m in range(1 << STEP) if m.bit_count() <= budget]
            found = a.withColumn("b", F.explode(F.array(*(F.col("a").bitwiseXOR(F.lit(m).cast("long")) for m in masks)))).where("a <= b").join(b, "b")
        else:
            found = pairs.join(a, "a_up").join(b.withColumnRenamed("b_up", "b_above"), (F.col("b_up") == F.col("b_above")) & near)
        found = written(found.select("a", "b", (F.greatest("a_n", "b_n") > leaf).alias("large") if depth < 64 else F.lit(False).alias("large")))
        done = found.where("NOT large").select("a", "b", F.lit(depth).alias("depth"))
        leaves = done if leaves is None else leaves.unionByName(done)
        pairs = found.where("large").select(F.col("a").alias("a_up"), F.col("b").alias("b_up"))
        if pairs.isEmpty():
            break
    at = [d for d in range(STEP, depth + 1, STEP)]
    placed = distinct.select("fp", F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), prefix(F.col("fp"), d).alias("node")) for d in at))).alias("p")).select("fp", "p.*")
    left = leaves.select("depth", "a").distinct().join(placed.withColumnRenamed("node", "a"), ["depth", "a"]).select("depth", "a", "fp", F.lit(False).alias("other"))
    right = leaves.where("a <> b").join(placed.withColumnRenamed("node", "b"), ["depth", "b"]).select("depth", "a", "fp", F.lit(True).alias("other"))
    return left.unionByName(right).groupBy("depth", "a").applyInPandas(leaf_links(budget, few), "x long, y long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row per row of docs: id, fingerprint long, component_id (the smallest id reachable over links).

    Fingerprints link at `budget` or fewer differing bits; equal ones always. Null and empty texts and texts of white
    space only have fingerprint 0, which links like any other. Repeated ids and rows give a row each. A null id keeps its
    row and never names a component that has another id. An empty table gives no rows; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).cast("long").alias(id_col), F.pandas_udf(fingerprinted, "long")(F.col(text_col)).alias("fp")))
    distinct = written(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    # components are named by fingerprints; each takes the least id among its fingerprints
    named = distinct.join(trie_components(distinct, budget), "fp")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # written, so that both sides of the last join are plain exchanges, of which Spark splits a fingerprint with many rows
    by_fp = written(named.join(least, "component").select("fp", "component_id"))
    return rows.join(by_fp, "fp").select(id_col, F.col("fp").alias("fingerprint"), "component_id")


def trie_components(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(fp, component): for each of the distinct fingerprints the smallest one that it reaches over links."""
    linked = components(written(close_fingerprints(distinct.select("fp"), budget, few=True)), "x", "y").withColumnRenamed("node", "fp")
    return distinct.select("fp").join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: that of the smallest id (rows that repeat this id stay; a group without any id stays whole).

    Documents that the trie links, by fingerprints of five-word shingles, are candidates. At a similarity of 0.8
    fingerprints are some ten bits apart, where a trie no longer tells copies from others: further candidates share a
    MinHash bucket. The shingles themselves decide on each candidate.
    """
    found = shingles.near_duplicates(docs, trie_components).select(F.col("doc_id").alias("id"), "component_id").where("id = component_id OR component_id IS NULL").select("id").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["id"]), "left_semi")
