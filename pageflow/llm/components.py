"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import fits_broadcast, lookup_join
from ..session import pin


def connected_components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for the ends of ``links`` (``a``, ``b``); a component is named by its least node.

    Each round a node takes the least name among its neighbours, and then the
    name of the node it is named after, so chains halve. A node with very many
    links is no group: minima are combined before they move.
    """
    both = pin(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = pin(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    # the names of all nodes keep their number, so whether they may be sent to all tasks is measured once
    fits = fits_broadcast(labels)
    while True:
        named = labels.withColumnRenamed("node", "b")
        near = (
            lookup_join(both, named, "b", fits=fits, spread=["a"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        names = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        names = F.broadcast(names) if fits else names
        moved = pin(
            lower.join(names, "component", "left").select("node", "old", F.coalesce("further", "component").alias("component")),
            "labels",
        )
        labels = moved.select("node", "component")
        if not moved.where(F.col("old") != F.col("component")).limit(1).count():
            return labels
