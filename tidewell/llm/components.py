"""Connected components of a graph given as a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of links(a, b); root is the least node reachable.

    In a round each node points to its least neighbour (itself included), then to where that one points; links
    move to these and loops vanish. The rounds' small tables are composed at the end. Nodes with very many links
    are summed up before the shuffle, and joins on their key are of a kind that Spark splits.
    """
    links, steps = scratch.keep(_ordered(links)), []
    while links.head(1):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.keep(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")))
        beyond = least.select(F.col("node").alias("to"), F.col("to").alias("root"))
        step = scratch.keep(least.join(beyond, "to").select("node", "root"))
        steps.append(step)
        for end in ("a", "b"):
            links = links.join(step.withColumnsRenamed({"node": end, "root": "to"}), end).drop(end).withColumnRenamed("to", end)
        links = scratch.keep(_ordered(links))
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0]
    for step in steps[1:]:
        beyond = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = out.join(beyond, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return scratch.keep(out)
