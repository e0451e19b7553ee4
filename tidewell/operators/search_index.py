"""Substring search over texts with an index: postings of three-letter pieces tell which parts of a table can match.

build() writes a table in parts, and for every piece of its texts the parts that hold it. search() reads the postings of
the term's pieces alone, keeps the parts that have all of them, and looks for the term in these: the rows are those that a
search of the whole table gives, the files read are few for a term that is rare.

A posting is a piece and a part, however often and in however many rows, so the index holds at most as many rows as
there are different pieces times parts. Rows are dealt to parts by a key whose like rows lie together (a host, a
shop), so that a term is in few of them.

Defined results: search is without regard to case; null texts match nothing; a term of fewer letters than a piece reads
every part, an empty one gives every row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.containment import pieces
from tidewell.operators.relational import contains_any

PIECE, PARTS, SLOTS = 3, 64, 32


def build(df: DataFrame, columns: Sequence[str], together: Column, path: str, parts: int = PARTS) -> None:
    """Write the rows of df and the postings of the columns' texts under path; rows with one `together` share a part."""
    placed = df.withColumn("_part", F.pmod(F.xxhash64(together), F.lit(parts)).cast("int"))
    placed.hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part").parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    text = F.explode(F.array(*(F.lower(F.col(c).cast("string")) for c in columns)))
    found = rows.select("_part", text.alias("_t")).where("_t is not null").select("_part", F.explode(pieces(F.col("_t"), PIECE)).alias("piece")).distinct()
    slot = F.pmod(F.xxhash64("piece"), F.lit(SLOTS)).cast("int")
    found.withColumn("_slot", slot).repartition("_slot").sortWithinPartitions("_slot", "piece").write.mode("overwrite").partitionBy("_slot").parquet(f"{path}/pieces")


def parts_with(spark: SparkSession, path: str, term: str) -> list[int] | None:
    """The parts that hold every piece of the term; None if it has none. At most as many as there are parts."""
    wanted = sorted({term.lower()[i : i + PIECE] for i in range(len(term) - PIECE + 1)})
    if not wanted:
        return None
    asked = spark.createDataFrame([(w,) for w in wanted], "piece string").select("piece", F.pmod(F.xxhash64("piece"), F.lit(SLOTS)).cast("int").alias("_slot"))
    slots = [r[0] for r in asked.select("_slot").distinct().collect()]
    postings = spark.read.schema("piece string, _part int, _slot int").parquet(f"{path}/pieces").where(F.col("_slot").isin(slots) & F.col("piece").isin(wanted))
    return sorted(r[0] for r in postings.groupBy("_part").agg(F.count_distinct("piece").alias("n")).where(F.col("n") == len(wanted)).collect())


def search(spark: SparkSession, path: str, schema: str, columns: Sequence[str], term: str) -> DataFrame:
    """The rows of a built table whose columns contain the term."""
    rows = spark.read.schema(f"{schema}, _part int").parquet(f"{path}/rows")
    parts = parts_with(spark, path, term)
    if parts is not None:
        rows = rows.where(F.col("_part").isin(parts) if parts else F.lit(False))
    return rows.where(contains_any(columns, term)).drop("_part")
