"""Connected components of a link table, by contraction in Spark joins.

Every node hooks to its smallest neighbour, chains are shortened by pointer
jumping, links are relabelled with the roots and repeated until none joins two
roots: about log(n) rounds, whatever the shape.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node with a link; ``links``: columns a, b.  The
    root is the smallest node of the component."""
    links = scratch.save(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .distinct(), f"{name}-links0")
    labels = None
    k = 0
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = scratch.save(both.groupBy(F.col("a").alias("node"))
                               .agg(F.least(F.col("node"), F.min("b")).alias("root")), f"{name}-hook{k}")
        j = 0
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = scratch.save(parents.join(up, "root").select("node", F.col("above").alias("root"),
                                                                  (F.col("above") != F.col("root")).alias("moved")),
                                  f"{name}-jump{k}-{j}")
            parents, j = jumped.select("node", "root"), j + 1
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        labels = scratch.save(labels, f"{name}-labels{k}")
        to_a = parents.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = scratch.save(links.join(to_a, "a").join(to_b, "b").filter("ra <> rb")
                             .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                             f"{name}-links{k + 1}")
        k += 1
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
