"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.tables import removed, written


def _jumped(parents: DataFrame) -> DataFrame:
    """Every node under its root: parents of parents, until nothing moves. Takes the table's place."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        before, parents = parents, written(
            parents.join(up, "parent", "left")
            .select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")),
            "jump",
        )
        removed(before)
        if parents.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; a component is named after its smallest node.

    Each round hangs every node below its smallest neighbour, pulls all nodes
    up to their roots and contracts the links to links between roots. Roots
    that are left are the smallest nodes of their components. Nodes may be of
    any type with an order. Links with a NULL end are left out; a link of a
    node with itself only names the node. Nothing is collected; per round
    a node's neighbours are reduced to their minimum before the shuffle, and
    joins are between written tables, which Spark splits at frequent keys.
    """
    every = written(
        links.where("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links",
    )
    labels = written(
        every.select(F.col("a").alias("node")).union(every.select("b")).distinct()
        .select("node", F.col("node").alias("component")), "labels",
    )
    links = every.where("a <> b")
    while not links.isEmpty():
        parents = _jumped(written(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "parents"))
        high = parents.select(F.col("node").alias("a"), F.col("parent").alias("top_a"))
        low = parents.select(F.col("node").alias("b"), F.col("parent").alias("top_b"))
        moved = (
            links.join(high, "a").join(low, "b", "left")
            .select(F.col("top_a").alias("x"), F.coalesce("top_b", "b").alias("y")).where("x <> y")
        )
        before, every = every, written(moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
        links = every
        up = parents.select(F.col("node").alias("component"), F.col("parent").alias("top"))
        named, labels = labels, written(
            labels.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component")),
            "labels",
        )
        removed(before, named, parents)
    removed(every)
    return labels
