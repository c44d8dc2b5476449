"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearyard.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): every node of the links with the smallest node it is connected to.

    Each round a node moves to the smallest node around it, and on to where
    that one moves; links between what has moved together are dropped, so
    stars are done with after a round and chains halve. Every round is stored:
    no plan grows, and a lost executor costs its own tasks only. A node with
    very many links takes part in plain equi-joins, which adaptive execution splits.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))
    )
    edges, labels = stored(both.distinct(), "links"), None
    while True:
        near = stored(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to")), "moves")
        on = near.select(F.col("node").alias("to"), F.col("to").alias("onto"))
        moves = stored(near.join(on, "to").select("node", F.col("onto").alias("to")), "moves")
        if labels is None:
            labels = moves.select("node", F.col("to").alias("comp"))
        else:
            step = moves.withColumnRenamed("node", "comp")
            labels = stored(labels.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        ends = edges.join(moves, "node").select("other", F.col("to").alias("left")).join(
            moves.withColumnRenamed("node", "other"), "other"
        )
        edges = stored(ends.filter("left <> to").select(F.col("left").alias("node"), F.col("to").alias("other")).distinct(), "links")
        if edges.isEmpty():
            return labels
