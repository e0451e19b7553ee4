"""A crawl by levels against a queue."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import frontier as FR


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def some_site(seed, n=60):
    r = random.Random(seed)
    name = lambda i: f"https://{'abc'[i % 3]}.example/p{i}"
    return [(name(i), [name(r.randrange(n + 20)) for _ in range(r.randrange(6))]) for i in range(n)]


def brute(site, seeds, depth, budget):
    source = lambda u: u.split("/")[2]
    spent, seen, out = {}, set(), []
    due = [(u, u, 0) for u in sorted(seeds)]
    for d in range(depth + 1):
        level = []
        for u, _, _ in sorted(due, key=lambda x: (x[1], x[2], x[0])):
            s = source(u)
            if spent.get(s, 0) < budget.get(s, 3):
                spent[s] = spent.get(s, 0) + 1
                seen.add(u)
                level.append(u)
                out.append((u, s, d, spent[s]))
        first = {}
        for u in sorted(level):
            for place, v in enumerate(site.get(u, [])):
                if v not in seen:
                    first[v] = min(first.get(v, (u, place)), (u, place))
        due = [(v, *at) for v, at in first.items()]
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_crawl_equals_a_queue(spark, seed):
    site = some_site(seed)
    pages = [(u, "".join(f'<a href="{v}">x</a>' for v in vs)) for u, vs in site] + [(None, "<a href='https://a.example/p1'>"), (site[0][0], "<p>"), ("https://a.example/empty", None)]
    seeds = [site[0][0], site[1][0], site[1][0], site[5][0], None]
    df = spark.createDataFrame(pages, "url string, html string").withColumn("depth", F.lit("x"))
    budget = F.when(F.col("source") == "a.example", 6).when(F.col("source") == "b.example", 0).otherwise(9)
    got = FR.crawl(df, spark.createDataFrame([(s,) for s in seeds], "url string"), 3, budget, F.split("url", "/")[2])
    links = dict(site) | {site[0][0]: []}  # of a page given twice the row whose links sort first
    want = brute(links, {s for s in seeds if s}, 3, {"a.example": 6, "b.example": 0, "c.example": 9})
    assert sorted(map(tuple, got.collect())) == want and len(want) >= 8


def test_rules_and_empty_crawls(spark):
    pages = spark.createDataFrame([("https://a.example/", '<a href="/x">1</a><a href="/y">2</a>')], "url string, html string")
    seeds = pages.select("url")
    run = lambda s, **more: sorted((r.url, r.depth) for r in FR.crawl(pages, s, 2, F.lit(9), F.lit(None).cast("string"), **more).collect())
    assert run(seeds) == [("https://a.example/", 0), ("https://a.example/x", 1), ("https://a.example/y", 1)]
    assert run(seeds, follow=F.col("url").endswith("x")) == [("https://a.example/", 0), ("https://a.example/x", 1)]
    assert run(seeds.where("false")) == []


def test_numbers_run_over_partitions(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.lit(None)).alias("k"), F.col("id").alias("v"))
    got = FR.numbered(df, "k", [F.col("v")]).collect()
    for key in ("hot", None):
        own = sorted((r.v, r.running) for r in got if r.k == key)
        assert [n for _, n in own] == list(range(1, len(own) + 1))
