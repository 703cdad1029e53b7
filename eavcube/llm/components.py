"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavcube.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of the links (x, y); null ends are dropped.

    Every round takes the smallest label among the neighbours and then the label of that label, until nothing changes.
    Both sides of each join are stored tables, so adaptive execution can split a node with very many links.
    """
    links = links.where("x is not null and y is not null and x <> y").select(F.col("x").cast("long"), F.col("y").cast("long"))
    both = staged(links.union(links.select("y", "x")).distinct())
    labels = staged(both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("x"), F.min("y")).alias("component")))
    while True:
        near = both.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("component").alias("near"))
        hooked = staged(labels.join(near, F.col("node") == F.col("x")).select(
            "node", "component", F.least("component", "near").alias("hook")))
        other = labels.select(F.col("node").alias("at"), F.col("component").alias("jump"))
        new = staged(hooked.join(other, F.col("hook") == F.col("at")).select(
            "node", F.least("hook", "jump").alias("component"), (F.least("hook", "jump") < F.col("component")).alias("moved")))
        labels = new.select("node", "component")
        if new.where("moved").isEmpty():
            return labels
