"""Connected components of an edge table, by minimum labels with hooked labels and pointer jumping.

Labels move over edges and jump to the label of their label, and a label's own node goes under the smallest label
that its holders have met.  So whole trees join others each round, and the rounds grow with the logarithm of a chain's
length in any order of its labels (a shuffled path of 1,000 nodes: 11, of 1,000,000: 21, in a plain sketch).  Each
round is cut into the shared folder; edges and labels never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (cls, comp), edges (a, b) between nodes of different comp: nodes with comp lowered to the
    smallest comp that is reachable.  Nulls do not occur in keys; no edges: nodes come back as they are."""
    pairs = (edges.join(nodes.select(F.col("cls").alias("a"), F.col("comp").alias("x")), "a")
             .join(nodes.select(F.col("cls").alias("b"), F.col("comp").alias("y")), "b")
             .select("x", "y").filter("x <> y").distinct())
    links = cut(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    if links.isEmpty():
        return nodes
    label = links.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("v"), F.least("x", "m").alias("l"))
    label = cut(label, "labels")
    while True:
        # label of the label, then the smallest label among neighbours
        jumped = (label.join(label.select(F.col("v").alias("l"), F.col("l").alias("l2")), "l", "left")
                  .select("v", F.col("l").alias("old"), F.coalesce("l2", "l").alias("l")))
        near = (links.join(jumped.select(F.col("v").alias("y"), F.col("l").alias("m")), "y")
                .groupBy("x").agg(F.min("m").alias("m")))
        met = cut(jumped.join(near.withColumnRenamed("x", "v"), "v").select("v", "old", F.least("l", "m").alias("l")), "met")
        # the old label itself goes under the smallest label that any of its holders has met
        hooks = met.groupBy("old").agg(F.min("l").alias("hook")).withColumnRenamed("old", "v")
        new = cut(met.join(hooks, "v", "left").select("v", "old", F.least("l", "hook").alias("l")), "labels")
        label = new.select("v", "l")
        if new.filter("l < old").isEmpty():     # labels only fall, so this ends
            break
    return (nodes.join(label.withColumnRenamed("v", "comp"), "comp", "left")
            .select("cls", F.coalesce("l", "comp").alias("comp")))
