"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node that it reaches.

    Each round gives a node the smallest label among its neighbours and then that label's own label,
    so that a chain shortens by half; the rounds end when no label changes. Every round is a stored
    table. A hot node's neighbours are combined before they are shuffled.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialize(both, "links")
    labels = materialize(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("low"))
        owners = labels.select(F.col("node").alias("owner"), F.col("label").alias("above"))
        jumped = low.join(owners, F.col("low") == F.col("owner"), "left").select(
            "node", F.least("low", F.coalesce("above", "low")).alias("next"), "label"
        )
        stored = materialize(jumped, "labels")
        labels = stored.select("node", F.col("next").alias("label"))
        if stored.where(F.col("next") < F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")
