"""Connected components by contraction, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.llm.common import stored
from sheetflow.operators.keyed import lookup


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link; ``links``: a, b.

    Each round every node takes the smallest of itself and its neighbours as its
    parent, and the links are drawn between parents. The number of nodes at
    least halves in a round, so a few rounds do. The tables of a round are
    written to the shared folder.
    """
    links = stored(_plain(links), "links")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    member = stored(ends.withColumn("component", F.col("node")), "members")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent")), "parents")
        member = lookup(member.withColumnRenamed("component", "a"), parent, "a").select("node", F.coalesce("parent", "a").alias("component"))
        member = stored(member, "members")
        of_a = lookup(links, parent, "a", "inner").select(F.col("parent").alias("p"), F.col("b").alias("a"))
        of_b = lookup(of_a, parent, "a", "inner").select(F.col("p").alias("a"), F.col("parent").alias("b"))
        links = stored(_plain(of_b), "links")
    return member


def _plain(links: DataFrame) -> DataFrame:
    """Each link between two nodes once, the smaller node first."""
    return links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
