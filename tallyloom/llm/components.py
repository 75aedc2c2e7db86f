"""Connected components of links, as joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


def _rooted(tree: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, parent) in which roots are their own parents; paths halve in every round."""
    while True:
        up = tree.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
        told = stored(tree.join(up, "parent").select("node", "parent", "over"), "told")
        tree = told.select("node", F.col("over").alias("parent"))
        if told.where("parent <> over").isEmpty():
            return tree.select("node", F.col("parent").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node it is linked to, over any number of links.

    Each round hangs every node on its least neighbour, finds the roots of these
    trees and contracts the links to links between roots, so that nodes at least
    halve and links inside a tree are gone: a dense group costs its links once.
    Every round is stored, which cuts the lineage and gives each join inputs
    that adaptive execution can split at a frequent root.
    """
    links = stored(links.select("a", "b").where("a <> b"), "links")
    labels = None
    while True:
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        tree = stored(ends.groupBy("node").agg(F.least("node", F.min("other")).alias("parent")), "tree")
        roots = stored(_rooted(tree), "roots")
        if labels is None:
            labels = roots
        else:
            later = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = stored(labels.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
        one = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
        two = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
        between = links.join(one, "a").join(two, "b").where("x <> y")
        links = stored(between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels
