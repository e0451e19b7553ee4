"""The pages that a crawl reads, level by level: links not visited before, within each source's budget.

A level's pages come from the links of the level before. Of the links that no earlier level has, each once, a source
takes as many as its budget still allows, in the order of the pages that they stand on and of their places there; each is
a page to visit whether or not there is a row for it, and only pages with a row have links. Levels are cut by checkpoints,
and budgets are running numbers within a source: numbered in range partitions whose sizes are summed up before, so that a
source of a third of all links is no one task.

Defined results: null URLs are no pages; URLs are compared as normalize_url gives them; a page given twice counts once,
with the links of the row whose address and links sort first; seeds take from the budget in the order of their URLs; a budget of 0 or below takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import url as U
from tidewell.operators.containment import with_checkpoints
from tidewell.operators.extract import links, resolve


def numbered(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """df with `running`: from 1 on within each key in the given order, in range partitions and not in one task per key."""
    parts = df.repartitionByRange(F.col(key), *order).withColumn("_p", F.spark_partition_id()).checkpoint()
    sums = parts.groupBy("_p", key).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_p", key).orderBy(*order)))
    base = sums.select("_p", F.col(key).alias("_key"), before.alias("_before"))
    met = inside.join(base, (inside["_p"] == base["_p"]) & inside[key].eqNullSafe(base["_key"]))
    return met.withColumn("running", F.col("_i") + F.col("_before")).drop("_p", "_i", "_key", "_before")


def crawl(pages: DataFrame, seeds: DataFrame, depth: int, budget: Column, source: Column, url: str = "url", html: str = "html", follow: Column | None = None) -> DataFrame:
    """(url, source, depth, running) of the pages that a crawl from seeds(url) visits over the links of pages(url, html).

    source: the source of a link, and budget: how many pages it may have, both over the column `url` (budget over
    `source` too). running: the page's number within its source's budget. follow: a rule over `url`, `source` and
    `depth` that links of the levels after the first must keep.
    """
    with_checkpoints(pages.sparkSession)
    # links leave the pages before anything is shuffled, so that no markup is
    own = pages.select(U.normalize_url(F.col(url)).alias("page"), F.struct(F.col(url).alias("base"), F.coalesce(links(F.col(html)), F.array()).alias("hrefs")).alias("p")).where("page != ''")
    found = own.groupBy("page").agg(F.min("p").alias("p"))
    edges = found.select("page", F.posexplode("p.hrefs").alias("place", "href"), F.col("p.base").alias("base"))
    edges = edges.select("page", "place", U.normalize_url(resolve(F.col("href"), F.col("base"))).alias("url")).where("url != ''").checkpoint()
    level = seeds.select(U.normalize_url(F.col("url")).alias("url")).where("url != ''").distinct().select("url", F.col("url").alias("from"), F.lit(0).alias("place"))
    visited, spent = None, None
    for d in range(depth + 1):
        due = level.withColumn("source", source).withColumn("depth", F.lit(d))
        if d and follow is not None:
            due = due.where(F.coalesce(follow, F.lit(False)))
        ranked = numbered(due, "source", [F.col("from"), F.col("place"), F.col("url")])
        if spent is not None:
            ranked = ranked.join(spent.select(F.col("source").alias("_s"), "spent"), F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("running", F.col("running") + F.coalesce("spent", F.lit(0))).drop("_s", "spent")
        taken = ranked.where(F.col("running") <= budget).select("url", "source", "depth", F.col("running").cast("long").alias("running"), F.col("from")).checkpoint()
        visited = taken if visited is None else visited.unionByName(taken)
        if d == depth or not taken.head(1):
            break
        spent = visited.groupBy("source").agg(F.count("*").alias("spent"))
        out = edges.join(taken.select(F.col("url").alias("page")), "page")
        first = out.groupBy("url").agg(F.min(F.struct("page", "place")).alias("m")).select("url", F.col("m.page").alias("from"), F.col("m.place").alias("place"))
        level = first.join(visited.select("url"), "url", "left_anti")
    return visited.select("url", "source", "depth", "running")
