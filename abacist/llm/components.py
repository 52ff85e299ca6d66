"""Connected components of an edge table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the smallest node of each component; ``edges`` has columns a and b.

    Each round every node takes the smallest root among its own and its neighbours' and then that root's
    root. Labels only fall, and rounds go on until none does. After each round the ends of the edges are replaced
    by their roots, and loops and repeats go, as the labels themselves hold what is joined already. Joins on a hub's key
    are one-sided: the labels have one row per node, so adaptive execution can split the hub's edges.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialise(nodes.withColumn("root", F.col("node")))
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("seen"))
        lowered = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", "root", F.least("root", F.coalesce("seen", "root")).alias("lower"))
        lowered = materialise(lowered)
        jumps = lowered.select(F.col("node").alias("at"), F.col("lower").alias("further"))
        moved = materialise(lowered.join(jumps, F.col("lower") == F.col("at")).select(
            "node", F.col("root").alias("before"), F.least("lower", "further").alias("root")))
        labels = moved.select("node", "root")
        if moved.where(F.col("root") < F.col("before")).isEmpty():
            return labels
        ends = [labels.select(F.col("node").alias(f"{x}_node"), F.col("root").alias(f"{x}_root")) for x in "ab"]
        edges = edges.join(ends[0], F.col("a") == F.col("a_node")).join(ends[1], F.col("b") == F.col("b_node"))
        edges = materialise(edges.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).where("a <> b").distinct())
