"""Containment joins and classes of duplicates against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.containment import closure, containments, groups


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def some_rows(seed, n=150):
    r = random.Random(seed)
    words = ["a", "ab", "dine", "dinner", "spa", "spa-day", "off", "x"]
    rows = [(i, r.choice(["h1", "h2", None]), "-".join(r.choice(words) for _ in range(r.randrange(0, 4))) or r.choice([None, ""])) for i in range(n)]
    return rows + [(n, "h1", "dine"), (n, "h1", "dine"), (n + 1, "h3", "é日本-dine"), (n + 2, "h3", "日本"), (n + 3, "h3", "本")]


@pytest.mark.parametrize("seed", range(3))
def test_containments_equal_brute_force(spark, seed):
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, "i long, b string, t string")
    left, right = df.where("i % 2 = 0"), df.where("i % 3 != 0")
    got = sorted(map(tuple, containments(left, right, ["b"], "t").collect()))
    xs = {(b, t) for i, b, t in rows if i % 2 == 0 and b and t}
    ys = {(b, t) for i, b, t in rows if i % 3 and b and t}
    assert got == sorted((b, x, y) for b, x in xs for c, y in ys if b == c and y in x)


def brute_groups(rows):
    root = {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, b, t in rows:
        for j, c, u in rows:
            if b and b == c and t and u and (t in u or u in t) or i % 10 == j % 10 == 3:
                x, y = sorted((find(i), find(j)), key=str)
                root[y] = x
    return {i: find(i) for i, *_ in rows}


def test_groups_equal_brute_force(spark):
    rows = some_rows(5, 60)
    df = spark.createDataFrame(rows, "i long, b string, t string")
    keys = F.array(F.when(F.col("i") % 10 == 3, "three"), F.lit(None).cast("string"))
    got = {r["i"]: r["root"] for r in groups(df, "i", keys, ["b"], "t").collect()}
    want = brute_groups(rows)
    assert set(got) == set(want)
    for i in got:
        for j in got:
            assert (got[i] == got[j]) == (want[i] == want[j])
        assert got[i] == min((str(j) for j in got if want[j] == want[i]), key=lambda s: s)


def test_closure_of_long_chains_and_stars(spark):
    n = 300
    links = spark.createDataFrame([(f"n{i:04}", f"n{i + 1:04}") for i in range(n)] + [("s0", f"s{i}") for i in range(1, 500)], "a string, b string")
    got = {r["node"]: r["root"] for r in closure(links).collect()}
    assert len(got) == n + 1 + 500 and set(got.values()) == {"n0000", "s0"}
    assert closure(links.where("false")).count() == 0


def test_one_block_of_many_titles_takes_bounded_time(spark):
    """50,000 titles of one block: pairwise it would be 2.5 billion comparisons."""
    i = F.col("id")
    df = spark.range(50_000).select(F.lit("shop").alias("b"), F.concat_ws("-", F.lit("offer"), F.md5(i.cast("string")), F.when(i % 100 == 0, F.md5((i + 1).cast("string")))).alias("t"))
    inner = spark.range(1, 50_000, 100).select(F.lit("shop").alias("b"), F.md5((F.col("id")).cast("string")).alias("t"))
    assert containments(df, inner, ["b"], "t").count() == 1000  # each in its own title and in the one before


def test_empty_tables_and_rows_without_keys(spark):
    df = spark.createDataFrame([(1, None, None), (2, "b", None)], "i long, b string, t string")
    none = F.array(F.lit(None).cast("string"))
    assert sorted(map(tuple, groups(df, "i", none, ["b"], "t").collect())) == [(1, "1"), (2, "2")]
    assert groups(df.where("false"), "i", none, ["b"], "t").count() == 0


def test_rows_are_no_nodes_of_the_closure(spark, monkeypatch):
    from tidewell.operators import containment

    seen = []
    monkeypatch.setattr(containment, "closure", lambda links: seen.append(links.count()) or closure(links))
    texts = ["spa", "spa-day", "dinner", "off"]
    df = spark.createDataFrame([(i, "h", texts[i % 4]) for i in range(400)], "i long, b string, t string")
    none = F.array().cast("array<string>")
    got = {r.i: r.root for r in containment.groups(df, "i", none, ["b"], "t").collect()}
    assert got == {i: {0: "0", 1: "0", 2: "10", 3: "103"}[i % 4] for i in range(400)}
    assert seen == [1]  # spa within spa-day; 400 rows or more before


def test_rows_of_one_name_are_one_class(spark):
    rows = [(1, "a"), (1, "b"), (1, None), (2, "b"), (3, "a"), (4, None), (5, "c"), (None, "c"), (6, "c")]
    df = spark.createDataFrame(rows, "i long, k string")
    got = sorted(map(tuple, groups(df, "i", F.array("k")).collect()), key=str)
    assert got == [(1, "1"), (2, "1"), (3, "1"), (4, "4"), (5, "5"), (6, "5"), (None, None)]
