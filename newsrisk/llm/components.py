"""Connected components by contraction, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsrisk.llm.common import stored
from newsrisk.operators.skew import join_one_per_key


def renamed(edges: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """``edges`` with ``column`` replaced by its parent, where it has one."""
    parent = parents.select(F.col("node").alias(column), F.col("parent").alias("_to"))
    joined = join_one_per_key(edges, parent, [column], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_to")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is its component's least node.

    Every round hooks each node to its least neighbour, shortens the chains and replaces the
    nodes of the links by their parents; links inside a parent vanish.  The rounds are
    logarithmic in the longest chain; each is written, so a lost executor costs one round.
    Links and nodes only get fewer, so their first numbers bound the files of every round.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links", links.count())
    left = links.count()
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    labels = stored(labels, "labels", 2 * left)
    nodes = labels.count()
    while left:
        ways = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("w")).select("w.*")
        most = min(nodes, 2 * left)
        parents = stored(
            ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("parent")), "parents", most
        )
        for _ in range(2):
            parents = stored(renamed(parents, parents, "parent"), "parents", most)
        labels = stored(renamed(labels, parents, "root"), "labels", nodes)
        links = renamed(renamed(links, parents, "a"), parents, "b")
        links = stored(links.where("a <> b").distinct(), "links", left)
        left = links.count()
    return labels
