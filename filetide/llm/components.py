"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.llm.work import keep


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node in ``edges`` (a, b; null in neither).

    Each round takes the least label among neighbours and then the label of one's label, so that long
    chains halve; it ends when a round changes nothing. Every round is written, since the next one
    reads it several times. A node with very many edges is summed up in each task before it moves.
    """
    links = keep(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = keep(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")),
                  "labels")
    while True:
        told = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("told"))
        near = labels.join(told, "node").select("node", "component", F.least("component", "told").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("component").alias("up"))
        moved = keep(near.join(up, "next").select("node", "component", F.least("next", "up").alias("next")), "labels")
        changed = moved.filter(F.col("component") != F.col("next")).limit(1).count()
        labels = moved.select("node", F.col("next").alias("component"))
        if not changed:
            return labels
