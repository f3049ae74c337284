"""Connected components of a large set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopspan.sources.staging import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node.

    Every round gives a node the smallest label among its neighbours and then the label of that
    label, so chains halve; a round's labels are staged, which also cuts the lineage. Labels of
    nodes are combined before the shuffle, so a hub costs one row per task. No links: no rows.
    """
    both = staged(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(),
        "links",
    )
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        seen = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        new = staged(
            seen.join(jump, "to").select("node", F.col("label").alias("was"), F.least("to", "beyond").alias("label")),
            "labels",
        )
        if new.where("was <> label").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")
