"""Connected components of a graph, by joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected edges (u, v); label is the least node.

    Each round takes the least label of the neighbours and then jumps to the
    label's label, so chains halve. Both sides of every join are written
    tables, which lets the engine split a hub's partition. Nothing reaches
    the driver but the number of changed labels.
    """
    both = materialise(edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"),
                                                                    F.col("u").alias("v"))),
                       "edges")
    labels = materialise(both.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct(),
                         "labels")
    while True:
        heard = (both.join(labels.select(F.col("node").alias("v"), "label"), "v")
                 .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("heard")))
        near = materialise(labels.join(heard, "node", "left").select(
            "node", F.col("label").alias("old"),
            F.least("label", F.coalesce("heard", "label")).alias("label")), "labels")
        far = near.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        labels = materialise(near.join(far, "label", "left").select(
            "node", "old", F.coalesce("beyond", "label").alias("label")), "labels")
        if not labels.where("label <> old").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
