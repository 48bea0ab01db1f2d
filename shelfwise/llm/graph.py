"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (x, y); a component is its least node.

    Each round takes the least component of a node and its neighbours, then lets the node follow
    its component's own component, so that long chains shrink by more than half in a round.
    Minima are added up before they are shuffled; a node with very many links is no burden.
    """
    both = written(
        links.select("x", "y").union(links.select("y", "x")).distinct(), "links"
    )
    now = written(
        both.groupBy("x").agg(F.min("y").alias("y")).select(
            F.col("x").alias("node"), F.least("x", "y").alias("component")
        ), "components",
    )
    while True:
        near = (
            both.join(now.withColumnRenamed("node", "y"), "y")
            .groupBy("x").agg(F.min("component").alias("near"))
        )
        stepped = now.join(near.withColumnRenamed("x", "node"), "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("via")
        )
        onward = now.select(F.col("node").alias("via"), F.col("component").alias("next"))
        after = written(
            stepped.join(onward, "via").select(
                "node", "before", F.least("via", "next").alias("component")
            ), "components",
        )
        now = after.select("node", "component")
        if after.filter("component <> before").isEmpty():
            return now
