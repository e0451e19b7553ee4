"""Operator 12: a mixture of sources by target weights, cut at each source's exact budget. DataFrame operations only.

All sizes together are shared among the sources by weight; no source gives more than `most` times its size, and what it
can't give is shared among the others by weight, until none is above. A source's budget is its target rounded to whole
words. It is met by whole repeats (epochs) and, for the rest, a cut through one more epoch: rows get hash-random keys,
the keys' space is cut in equal ranges, which sort the rows of each source by range, prefix sums of the ranges' sizes tell
in which of them the budget ends, and that range alone is sorted on, by finer ranges and at last by key. Rows before the
cut are taken whole, the row at the cut as far as the budget reaches, later ones not.

So rows never move: what is shuffled are sums of a range and source, combined in each task before, 2^BITS rows of a
source and level at most and about FAN at the last. Keys depend on the seed and the row's key alone, so reruns agree, whatever the partitions.

Defined results: a null source is a source of its own, sorted last; rows of one key (repeated or null ones) share the
cut in proportion to their sizes, rounded down; rows of size null count as 0; sources without weight, or of weight null or
below 1, have weight 1; sources of size 0 have target 0; an empty table gives an empty one. Other columns stay; a
result's column is named with underscores before it where the table has one of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch, fresh, read, sized_join

SEED = 12
BITS = 8  # a level of ranges splits the one before in 2^BITS; keys have 60 bits
FAN = 512  # there are as many levels as leave about so many rows of a source, or fewer, to be sorted by key
MOST = 3
WORDS = r"[^\x20\x09-\x0D]+"
_NAME = ["_none", "_name"]


def mix_key(key: Column, seed: int = SEED) -> Column:
    """60 random bits of a row's key."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _before(df: DataFrame, scratch: Scratch, order: list[Column], **values: Column) -> DataFrame:
    """df with the sums of the values over all rows before each in the order: within range partitions, then over these."""
    parts = scratch.keep(df.withColumns(values).repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    totals = parts.groupBy("_p").agg(*(F.sum(v).alias(f"{v}_all") for v in values))
    rows = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_p", *(F.coalesce(F.sum(f"{v}_all").over(rows(Window.orderBy("_p"))), F.lit(0)).alias(f"{v}_base") for v in values))
    inside = parts.withColumns({f"{v}_in": F.coalesce(F.sum(v).over(rows(Window.partitionBy("_p").orderBy(*order))), F.lit(0)) for v in values})
    return inside.join(F.broadcast(base), "_p").select(*df.columns, *((F.col(f"{v}_in") + F.col(f"{v}_base")).alias(v) for v in values))


def cyclic_weights(sources: DataFrame, scratch: Scratch, cycle: int = 3) -> DataFrame:
    """(_none, _name, source_size) with weights 1 to cycle, repeating by code point, null last."""
    out = _before(sources, scratch, [F.col(c) for c in _NAME], weight=F.lit(1))
    return out.withColumn("weight", F.pmod("weight", F.lit(cycle)) + 1)


def targets(sources: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """sources (source_size, weight) with target: shares of the sum of sizes by weight, at most `most` times a source's size.

    By ascending size for its weight, a source is at its limit if its part of what is left for it and all later ones
    reaches it; the first that is not sets the share of a weight for all later ones.
    """
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    ratio = F.col("source_size") / F.col("weight")
    rows = _before(sources, scratch, [ratio, *(F.col(c) for c in _NAME)], limits=F.col("source_size") * most, weights=F.col("weight"))
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).head()
    rows = rows.withColumns({"_left": F.lit(total or 0) - F.col("limits"), "_among": F.lit(weights or 0) - F.col("weights")})
    free = wide("source_size") * most * wide("_among") > wide("weight") * wide("_left")
    share = rows.where(free).agg(F.min_by(F.struct("_left", "_among"), F.struct("limits", "weights"))).head()[0]
    limit = (F.col("source_size") * most).cast("double")
    part = F.least(limit, F.col("weight") * F.lit(share[0]) / F.lit(share[1])) if share else limit
    return rows.select(*_NAME, "source_size", F.when(free, part).otherwise(limit).alias("target"))


def mixture(docs: DataFrame, key: str, source: str, size: Column, weights=cyclic_weights, most: int = MOST, seed: int = SEED, columns: list[str] | None = None) -> DataFrame:
    """docs (or the given columns) with size, source_size, target, repeats and taken.

    size: an expression over docs, whole and not negative. weights: a function from (_none, _name, source_size) rows
    to the same rows with a whole number `weight`. repeats: whole epochs of the row; taken: size * repeats and what
    the last, cut epoch takes of it.
    """
    kept = docs.columns if columns is None else columns
    named = dict(zip(("size", "source_size", "target", "repeats", "taken"), fresh(docs.select(*kept), "size", "source_size", "target", "repeats", "taken"), strict=True))
    hidden = {c: f"c{i}" for i, c in enumerate(kept)}
    scratch = Scratch(docs.sparkSession)
    name = {"_none": F.col(source).isNull(), "_name": F.coalesce(F.col(source).cast("string"), F.lit(""))}
    rows = docs.select(*(F.col(c).alias(h) for c, h in hidden.items()), *(e.alias(n) for n, e in name.items()), F.coalesce(size, F.lit(0)).cast("long").alias("size"), mix_key(F.col(key), seed).alias("key"))
    rows = scratch.keep(rows)
    counted = scratch.keep(rows.groupBy(*_NAME).agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")))
    levels = 1
    most_rows = counted.agg(F.max("rows")).head()[0] or 0
    while most_rows >> BITS * levels > FAN:
        levels += 1
    weighed = weights(counted.drop("rows"), scratch).withColumn("weight", F.greatest(F.coalesce(F.col("weight").cast("long"), F.lit(1)), F.lit(1)))
    plan = targets(weighed, scratch, most)
    budget = F.round("target").cast("long")
    plan = scratch.keep(plan.withColumns({"repeats": F.when(F.col("source_size") > 0, F.expr("cast(round(target) as long) div source_size")).otherwise(F.lit(0))}).withColumn("left", budget - F.col("repeats") * F.col("source_size")))
    # where the rest of a source's budget ends: from range to finer range
    cut = plan.where("left > 0").select(*_NAME, F.lit(0).cast("long").alias("range"), "left")
    for level in range(levels + 1):
        above, shift = 60 - BITS * level, 60 - BITS * (level + 1) if level < levels else 0
        own = rows.where("size > 0").withColumn("range", F.shiftright("key", above))
        within = sized_join(own, cut, [*_NAME, "range"], "inner")
        sums = within.groupBy(*_NAME, "left", F.shiftright("key", shift).alias("range")).agg(F.sum("size").alias("sum"))
        until = F.sum("sum").over(Window.partitionBy(*_NAME).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        placed = sums.withColumn("until", until).where("until - sum < left and left <= until")
        cut = scratch.keep(placed.select(*_NAME, "range", (F.col("left") - F.col("until") + F.col("sum")).alias("left"), "sum"))
    plan = scratch.keep(plan.drop("left").join(cut.withColumnsRenamed({"range": "cut", "left": "part"}), _NAME, "left"))
    share = F.expr("cast(size as decimal(19,0)) * cast(part as decimal(19,0)) div cast(sum as decimal(19,0))")
    last = F.when(F.col("key") < F.col("cut"), F.col("size")).when(F.col("key") == F.col("cut"), share).otherwise(F.lit(0))
    out = sized_join(rows, plan, _NAME, "left").withColumn("taken", F.col("size") * F.col("repeats") + last)
    return scratch.final(out.select(*(F.col(h).alias(c) for c, h in hidden.items()), *(F.col(c).alias(n) for c, n in named.items())))


def epochs(mixed: DataFrame, key: str, seed: int = SEED, size: str = "size", repeats: str = "repeats", taken: str = "taken") -> DataFrame:
    """A row per row and epoch it is taken in, with `epoch` from 0 and `words` of it, in random order within epochs."""
    last = F.col(taken) - F.col(repeats) * F.col(size)
    number = F.col(repeats) + F.when(last > 0, 1).otherwise(0)
    each = mixed.where(number > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))
    each = each.withColumn("words", F.when(F.col("epoch") < F.col(repeats), F.col(size)).otherwise(last))
    return each.withColumn("_key", mix_key(F.concat_ws(":", "epoch", F.col(key).cast("string")), seed)).repartitionByRange("epoch", "_key").sortWithinPartitions("epoch", "_key").drop("_key")


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixture(docs, "doc_id", "source", F.regexp_count("text", F.lit(WORDS)), columns=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "repeats")


OP12_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
o AS MATERIALIZED (
  SELECT *, coalesce(sum(source_size) OVER (), 0) - coalesce(sum(3 * source_size) OVER b, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS among, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS n
  FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (SELECT * FROM o WHERE 3 * source_size * among > weight * rest ORDER BY n LIMIT 1),
t AS MATERIALIZED (
  SELECT o.source, o.source_size, CASE WHEN f.n IS NULL OR o.n < f.n THEN 3.0::DOUBLE * o.source_size ELSE least(3.0::DOUBLE * o.source_size, CAST(o.weight * f.rest AS DOUBLE) / f.among) END AS target
  FROM o LEFT JOIN f ON true
), b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS repeats, CAST(round(target) AS BIGINT) AS budget FROM t),
k AS (
  SELECT source, key, sum(size) AS own, sum(sum(size)) OVER (PARTITION BY source ORDER BY key) - sum(size) AS before FROM d GROUP BY 1, 2
)
SELECT d.doc_id, d.size, b.source_size, b.target, CAST(b.repeats AS BIGINT) AS repeats,
  CAST(b.repeats * d.size + CASE WHEN k.own = 0 THEN 0 ELSE d.size * greatest(0, least(k.own, b.budget - b.repeats * b.source_size - k.before)) // k.own END AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.key = k.key
"""
