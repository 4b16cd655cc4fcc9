"""Connected components of an edge table by contraction: each round joins every node to its least neighbour and keeps the edges between groups."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that the cluster names; a temporary one only on a local master, as in tests."""
    if not spark.sparkContext.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        master = spark.sparkContext.master
        if not named and (not master.startswith("local") or master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-checkpoint-"))
    return df.checkpoint()


def connected_components(edges: DataFrame, left: str, right: str, rounds: int = 50) -> DataFrame:
    """(node, component): component is the least node that can be reached.

    In a round each node points at the least of itself and its neighbours, which makes trees; a node's label is then
    where its own label points.  Edges are renamed by these labels, and those within a group are dropped with
    their nodes, so that later rounds see only what still grows together; at least half of the nodes that are left
    go in each round.  The labels of the rounds, which shrink alike, are followed back in the end.
    Self edges name single nodes; null ends are ignored.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = cut_lineage(spark, pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    live = cut_lineage(spark, pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    for _ in range(rounds):
        if live.isEmpty():
            break
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = cut_lineage(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")))
        # a chain of pointers is followed to its end by doubling; pointers fall, so it has one
        while True:
            onward = point.join(point.select(F.col("a").alias("to"), F.col("to").alias("far")), "to").select("a", "to", "far")
            further = cut_lineage(spark, onward.select("a", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")))
            point = further.select("a", "to")
            if further.filter("moved").isEmpty():
                break
        steps.append(point)
        renamed = live.join(point.withColumnRenamed("to", "x"), "a").join(point.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        live = cut_lineage(spark, renamed.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    else:
        raise RuntimeError(f"components still grew together after {rounds} rounds")
    labels = None
    for point in reversed(steps):  # from the last and smallest round back
        if labels is not None:
            point = point.join(labels.select(F.col("a").alias("to"), F.col("to").alias("end")), "to", "left").select("a", F.coalesce("end", "to").alias("to"))
        labels = point
    if labels is None:
        return nodes.select("node", F.col("node").alias("component"))
    labels = cut_lineage(spark, labels)
    return nodes.join(labels.select(F.col("a").alias("node"), "to"), "node", "left").select("node", F.coalesce("to", "node").alias("component"))
