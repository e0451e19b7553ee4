"""Which texts contain which, without comparing all of a block: rare grams lead to candidates, contains() decides.

Each text to be found is looked up under the rarest of its grams, each text to be searched is filed under all of its
grams; both meet in one equi-join on block and gram. Texts shorter than a gram are looked up as a whole among the
equally short pieces of the others.

Also the closure over matches: groups() joins rows that share a key, or whose texts contain each other, to classes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.text import step

GRAM = 4


def with_checkpoints(spark: SparkSession) -> None:
    """Make sure that there is a folder for checkpoints: the session's setting, else one of this machine if it runs alone."""
    if spark.sparkContext.getCheckpointDir():
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(path or f"/tmp/checkpoints/{uuid.uuid4().hex}")


def pieces(text: Column, n: Column | int) -> Column:
    """The distinct pieces of n characters of a text; none of a shorter one."""
    n = F.lit(n) if isinstance(n, int) else n
    last = F.length(text) - n + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, n)))).otherwise(F.array().cast("array<string>"))


def containments(whole: DataFrame, part: DataFrame, block: Sequence[str], text: str) -> DataFrame:
    """Distinct (block..., x, y): a text x of `whole` contains a text y of `part` in the same block; equal texts do.

    Null or empty texts and null blocks take no part. Every text comes once per block, whatever the number of its rows.
    """
    own = lambda df, name: df.select(*block, F.col(text).alias(name)).where(F.col(name) != "").dropna(subset=[*block]).distinct()
    xs, ys = own(whole, "x"), own(part, "y")
    filed = xs.select(*block, "x", F.explode(pieces(F.col("x"), GRAM)).alias("_gram"))
    often = filed.groupBy(*block, "_gram").agg(F.count("*").alias("_n"))
    long = ys.where(F.length("y") >= GRAM).select(*block, "y", F.explode(pieces(F.col("y"), GRAM)).alias("_gram"))
    # a text whose grams aren't all filed is in no other
    rare = long.join(often, [*block, "_gram"], "left").groupBy(*block, "y").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"), F.bool_and(F.col("_n").isNotNull()).alias("_all")).where("_all").drop("_all")
    found = filed.join(rare, [*block, "_gram"]).where(F.contains("x", F.col("y"))).select(*block, "x", "y")
    short = ys.where(F.length("y") < GRAM)
    sizes = F.explode(F.sequence(F.lit(1), F.lit(GRAM - 1)))
    filed_short = xs.join(short.select(*block).distinct(), list(block), "left_semi").select(*block, "x", sizes.alias("_s")).select(*block, "x", F.explode(pieces(F.col("x"), F.col("_s"))).alias("y"))
    return found.unionByName(filed_short.join(short, [*block, "y"]).select(*block, "x", "y"))


def closure(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links(a, b): root is the least node reachable. Rounds are cut by checkpoints.

    A round points each node to the one of least hash among its neighbours and itself, and on to where that one points;
    links move along. Hashes change with the round, so that chains in any order shrink by a factor a round, not by a
    step. A node with very many links is a key that is summed up in each task before the shuffle, and whose joins Spark
    may split.
    """
    ordered = lambda df: df.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    with_checkpoints(links.sparkSession)
    first = ordered(links).checkpoint()
    links, steps = first, []
    while links.head(1):
        drawn = lambda c: F.struct(F.xxhash64(F.lit(len(steps)), c).alias("h"), F.col(c).alias("node"))  # noqa: E731, B023
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(drawn("b")).alias("m")).select(F.col("a").alias("node"), F.least(drawn("a"), "m")["node"].alias("to"))
        step = least.join(least.select(F.col("node").alias("to"), F.col("to").alias("root")), "to").select("node", "root").checkpoint()
        steps.append(step)
        for end in ("a", "b"):
            links = links.join(step.select(F.col("node").alias(end), F.col("root").alias("to")), end).drop(end).withColumnRenamed("to", end)
        links = ordered(links).checkpoint()
    if not steps:
        return first.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0]
    for step in steps[1:]:
        out = out.join(step.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    out = out.checkpoint()
    return out.join(out.groupBy("root").agg(F.min("node").alias("least")), "root").select("node", F.col("least").alias("root"))


def groups(rows: DataFrame, row: str, keys: Column, block: Sequence[str] = (), text: str | None = None) -> DataFrame:
    """(row, root): the class of each row under sharing any of its keys, or having texts of which one contains the other.

    keys: an array of strings; null ones are no keys. block and text: columns; rows of one block with equal texts or
    texts that contain each other belong together. root is the least row of the class, as text; a row without any key is
    its own class.

    Rows are no nodes of the closure: those alike in text and keys are one set, a set's first key or text stands for it,
    and only keys and texts that are linked to others are closed. So the rounds follow the different keys and texts that
    meet, not the rows.
    """
    name = lambda kind, *parts: F.concat(F.lit(f"{kind}:"), F.to_json(F.struct(*(p.alias(f"c{i}") for i, p in enumerate(parts)))))
    node = lambda c: name("2", *map(F.col, block), F.col(c))
    named = F.transform(F.filter(keys, lambda k: k.isNotNull()), lambda k: name("1", k))
    has = F.lit(False) if text is None else F.coalesce(F.col(text), F.lit("")) != ""
    for b in block:
        has = has & F.col(b).isNotNull()
    own = F.array_compact(F.array(F.when(has, node(text)) if text is not None else F.lit(None).cast("string")))
    none = F.array().cast("array<string>")
    texts = [] if text is None else [F.col(text)]
    held = rows.select(F.col(row).alias("_row"), *block, *texts, F.coalesce(named, none).alias("_keys"))
    held = step(held, _at=F.concat(own, "_keys")).drop("_keys")
    with_checkpoints(rows.sparkSession)
    sets = held.groupBy(*held.columns[1:]).agg(F.min(F.col("_row").cast("string")).alias("_least")).where("size(_at) > 0").checkpoint()
    links = sets.where("_least is not null and size(_at) > 1").select(F.col("_at")[0].alias("a"), F.explode(F.slice("_at", 2, F.size("_at") - 1)).alias("b"))
    if text is not None:
        links = links.unionByName(containments(sets, sets, block, text).where("x != y").select(node("x").alias("a"), node("y").alias("b")))
    twice = rows.groupBy(F.col(row).alias("_row")).agg(F.count("*").alias("_n")).where("_n > 1 and _row is not null").select("_row")
    if twice.head(1):  # rows of one name belong together
        again = held.where("size(_at) > 0").join(twice, "_row", "left_semi")
        links = links.unionByName(again.select(F.min(F.col("_at")[0]).over(Window.partitionBy("_row")).alias("a"), F.col("_at")[0].alias("b")))
    firsts = sets.groupBy(F.col("_at")[0].alias("node")).agg(F.min("_least").alias("_least")).join(closure(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = firsts.join(firsts.groupBy("root").agg(F.min("_least").alias("_class")), "root").select("node", "_class")
    placed = held.select("_row", F.get("_at", F.lit(0)).alias("node")).join(least, "node", "left")
    return placed.select(F.col("_row").alias(row), F.when(F.col("_row").isNotNull(), F.coalesce("_class", F.col("_row").cast("string"))).alias("root")).groupBy(row).agg(F.min("root").alias("root"))
