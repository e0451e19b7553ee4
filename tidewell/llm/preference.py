"""Operator 5: preference pairs from two tables of turns. DataFrame operations only.

Chosen and rejected conversations meet by a pair id. Their longest common turn prefix (equal turn number, role and
text) becomes the prompt, rendered once; what follows in each becomes its completion. In completions the assistant's
turns are trained, all else is masked; a prompt is masked as a whole.

preference_turns() has a row per rendered turn: turns are compared by sums of hashes per pair and turn, which combine
before the shuffle, and the first difference comes back by a join that Spark can split. preference_pairs() joins
them up to a row per pair with the completions' masks.

Defined results: a missing partner leaves the other side whole as a completion; null roles are "unknown", null texts
empty; several rows of one turn are compared as a whole and all kept; a null turn number comes before all others;
rows without a pair id are kept as part "unpaired", masked; an empty table on either side is a missing partner;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import read

TRAINED = "assistant"
_FIRST = -(1 << 62)


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def preference_turns(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, conv_id, turn, role, rendered, trained) from two tables (pair_id, conv_id, turn, role, text).

    part: prompt, chosen, rejected or unpaired.
    """
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("pair_id", F.lit(name).alias("side"), "conv_id", "turn", role.alias("role"), text.alias("text"), F.coalesce("turn", F.lit(_FIRST)).cast("long").alias("at"))

    turns = side(chosen, "chosen").unionByName(side(rejected, "rejected"))
    is_chosen = F.col("side") == "chosen"
    sign = F.when(is_chosen, 1).otherwise(-1)
    hashes = (F.xxhash64("role", "text"), F.xxhash64("text", "role"))
    sums = [F.sum((sign * F.shiftrightunsigned(h, 16)).cast("decimal(20,0)")).alias(f"h{i}") for i, h in enumerate(hashes)]
    compared = turns.where("pair_id is not null").groupBy("pair_id", "at").agg(F.sum(sign).alias("n"), *sums)
    first = compared.where("n != 0 or h0 != 0 or h1 != 0").groupBy("pair_id").agg(F.min("at").alias("differs"))
    joined = turns.join(first, "pair_id", "left")
    same = F.col("differs").isNull() | (F.col("at") < F.col("differs"))
    part = F.when(F.col("pair_id").isNull(), "unpaired").when(same, F.when(is_chosen, "prompt")).otherwise(F.col("side"))
    out = joined.withColumn("part", part).where("part is not null")
    trained = F.col("part").isin("chosen", "rejected") & (F.col("role") == TRAINED)
    return out.select("pair_id", "part", "conv_id", "turn", "role", rendered(F.col("role"), F.col("text")).alias("rendered"), trained.alias("trained"))


def preference_pairs(turns: DataFrame, turns_per_piece: int | None = None) -> DataFrame:
    """(pair_id, piece, prompt, chosen, rejected, chosen_trained, rejected_trained) from the rows of preference_turns.

    A row per pair, however long: the common prefix rendered once, both completions, and what is trained of each (start
    and end in code points, ends exclusive; all else is masked). piece is 0. With turns_per_piece, a row holds at most
    so many turn numbers, longer pairs go on in further pieces, whose spans count from the piece's start, and rows
    without a turn number are a piece before the others. Each row without a pair id is a row here (as a prompt).
    """
    at = F.coalesce("turn", F.lit(_FIRST)).cast("long")
    piece = F.floor(at / turns_per_piece) if turns_per_piece else F.lit(0)
    paired = turns.where("pair_id is not null").withColumns({"_at": at, "piece": piece.cast("long")})
    single = turns.where("pair_id is null").withColumns({"_at": at, "piece": F.lit(None).cast("long")})
    entry = F.struct("_at", "role", "rendered", "trained", F.when(F.col("part") == "unpaired", "prompt").otherwise(F.col("part")).alias("part"))
    rows = paired.groupBy("pair_id", "piece").agg(F.sort_array(F.collect_list(entry)).alias("t")).unionByName(single.select("pair_id", "piece", F.array(entry).alias("t")))
    parts = {p: F.filter("t", lambda x: x["part"] == p) for p in ("prompt", "chosen", "rejected")}  # noqa: B023

    def spans(xs: Column) -> Column:
        def step(a, x):
            end = a["pos"] + F.length(x["rendered"])
            span = F.struct((a["pos"] + F.length(x["role"]) + 5).alias("start"), end.alias("end"))
            return F.struct(end.alias("pos"), F.when(x["trained"], F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

        return F.aggregate(xs, F.struct(F.lit(0).alias("pos"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out")), step)["out"]

    strings = [F.array_join(F.transform(x, lambda y: y["rendered"]), "").alias(p) for p, x in parts.items()]
    return rows.select("pair_id", "piece", *strings, spans(parts["chosen"]).alias("chosen_trained"), spans(parts["rejected"]).alias("rejected_trained"))


def given_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2n (chosen) and 2n + 1 (rejected) are a pair."""
    turns = read(spark, sf_dir, "conversations").withColumn("pair_id", F.floor(F.col("conv_id") / 2).cast("long"))
    odd = F.pmod(F.col("conv_id"), F.lit(2)) == 1
    return preference_turns(turns.where(~odd | F.col("conv_id").isNull()), turns.where(odd))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of the given conversations; spans as "start-end" joined by commas."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(spans)
    return preference_pairs(given_turns(spark, sf_dir)).select("pair_id", "piece", "prompt", "chosen", "rejected", text("chosen_trained"), text("rejected_trained"))


_PARTS = """
WITH t AS (
  SELECT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 AS odd, conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations
), sides AS (
  SELECT pair_id, turn,
    list([role, text] ORDER BY role, text) FILTER (odd = 0) AS a, list([role, text] ORDER BY role, text) FILTER (odd = 1) AS b
  FROM t GROUP BY pair_id, turn
), firsts AS (
  SELECT pair_id, min(turn) AS differs FROM sides WHERE a IS DISTINCT FROM b GROUP BY pair_id
), parts AS (
  SELECT t.*, CASE WHEN differs IS NULL OR turn < differs THEN CASE WHEN odd = 0 THEN 'prompt' END WHEN odd = 0 THEN 'chosen' ELSE 'rejected' END AS part
  FROM t LEFT JOIN firsts USING (pair_id)
)
"""
TURNS_SQL = _PARTS + """SELECT pair_id, part, conv_id, turn, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
  part IN ('chosen', 'rejected') AND role = 'assistant' AS trained
FROM parts WHERE part IS NOT NULL
"""
OP5_SQL = _PARTS + """, r AS (
  SELECT pair_id, CAST(CASE WHEN pair_id IS NOT NULL THEN 0 END AS BIGINT) AS piece, part, turn, role, conv_id, row_number() OVER () AS n,
    '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered, part IN ('chosen', 'rejected') AND role = 'assistant' AS trained
  FROM parts WHERE part IS NOT NULL
), g AS (SELECT *, CASE WHEN pair_id IS NULL THEN n END AS own FROM r),
p AS (SELECT *, sum(length(rendered)) OVER (PARTITION BY pair_id, piece, own, part ORDER BY turn NULLS FIRST, role, rendered, n ROWS UNBOUNDED PRECEDING) AS stop FROM g),
s AS (SELECT *, CASE WHEN trained THEN (stop - length(rendered) + length(role) + 5) || '-' || stop END AS span FROM p)
SELECT pair_id, piece,
  coalesce(string_agg(rendered, '' ORDER BY turn NULLS FIRST, role, rendered) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(rendered, '' ORDER BY turn NULLS FIRST, role, rendered) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(rendered, '' ORDER BY turn NULLS FIRST, role, rendered) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY stop) FILTER (part = 'chosen'), '') AS chosen_trained,
  coalesce(string_agg(span, ',' ORDER BY stop) FILTER (part = 'rejected'), '') AS rejected_trained
FROM s GROUP BY pair_id, piece, own
"""
