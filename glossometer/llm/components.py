"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of the undirected edges the smallest node that it reaches.

    Labels start as the node itself. Each round takes the least label among a node and its neighbours, then
    follows the label's own label (pointer jumping), until no label changes. Links stay in tables: each round
    reads the last one's written labels, and aggregates before it shuffles; both sides of the join by neighbour are plain
    exchanges of written tables, of which adaptive execution splits a hub's partition. No edges give no rows; nulls and
    self links are ignored; repeated edges change nothing.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    n = e.count()
    label = written(e.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), n)
    while True:
        near = e.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        joined = label.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("next"))
        jump = label.select(F.col("node").alias("next"), F.col("label").alias("jumped"))
        new = written(joined.join(jump, "next").select("node", "old", F.least("next", "jumped").alias("label")), n)
        if new.where("old <> label").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        label = new.select("node", "label")
