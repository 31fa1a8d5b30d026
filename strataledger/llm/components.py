"""Connected components of an edge table by smallest label, without bringing edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Columns node and component (the smallest node that edges reach) for all nodes of ``edges`` (a, b).

    Every round takes the smallest label of all neighbours and then the label's own label, so paths
    shrink by more than half. Labels only fall; an unchanged sum ends the rounds.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = stored(labels.select("node", F.least("node", "least").alias("component")), "labels")
    total = None
    while True:
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
        offered = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "component")
        least = labels.union(offered).groupBy("node").agg(F.min("component").alias("component"))
        of_label = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = stored(
            least.join(of_label, "component").select("node", F.least("component", "further").alias("component")), "labels"
        )
