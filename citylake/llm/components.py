"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes that have an edge.

    ``edges`` has two long columns ``a`` and ``b``. Every round takes the smallest label among
    the neighbours (a combined minimum, so a node with very many edges costs one row per task)
    and then the label of that label, until nothing changes. Rounds are written to the
    shared folder; none keeps its lineage.
    """
    both = common.written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "edges",
    )
    labels = common.written(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("jumped"))
        step = common.written(
            lower.join(jump, "next", "left").select(
                "node", F.least("next", F.coalesce("jumped", "next")).alias("label"), (F.col("label") != F.least("next", F.coalesce("jumped", "next"))).alias("moved")
            ),
            "labels",
        )
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels
