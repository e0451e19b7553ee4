"""Health of sources: metrics, score and status for all sources in one grouped plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.keys import round3

TIER_A = ["emiratesNbd", "adcb", "mashreq", "fab", "visaUAE"]
TIER_B = ["dib", "adib", "rakBank", "hsbc", "cbd", "citibank", "mastercard", "scb"]


def metrics(offers: DataFrame, quarantined: DataFrame, key: str, confidence: str, filled: Column, of: int, merchant: Column, fresh: Column) -> DataFrame:
    """Per key: averages of its offers and rates over offers and quarantined rows; zeros where there are none."""
    rows = offers.groupBy(key).agg(
        F.count("*").alias("n"), F.avg(confidence).alias("_c"), F.avg(filled / of).alias("_f"), F.avg(merchant.cast("double")).alias("_m"), F.avg(fresh.cast("double")).alias("_r")
    )
    bad = quarantined.groupBy(key).agg(F.count("*").alias("q"))
    both = rows.join(bad, key, "full_outer").withColumns({"n": F.coalesce("n", F.lit(0)), "q": F.coalesce("q", F.lit(0))})
    total = F.col("n") + F.col("q")
    share = lambda x: round3(F.when(total > 0, x / total).otherwise(0.0))
    avg = lambda x: round3(F.coalesce(F.col(x), F.lit(0.0)))
    return both.select(
        key,
        F.col("n").alias("sample_size"),
        avg("_c").alias("avg_confidence"),
        avg("_f").alias("completeness"),
        avg("_m").alias("merchant_yield"),
        avg("_r").alias("freshness"),
        share(F.col("n")).alias("parse_success"),
        share(F.col("q")).alias("quarantine_rate"),
        F.when(total > 0, F.col("q") / total).otherwise(0.0).alias("failure_rate"),
    )


def score() -> Column:
    c = F.col
    small = F.least(F.lit(0.55), F.when(c("avg_confidence") > 0, c("avg_confidence")).otherwise(0.3))
    full = c("avg_confidence") * 0.25 + c("completeness") * 0.2 + c("parse_success") * 0.15 + c("merchant_yield") * 0.2 + c("freshness") * 0.1 - c("quarantine_rate") * 0.15 - c("failure_rate") * 0.1
    return F.when(c("sample_size") < 3, small).otherwise(round3(F.greatest(F.lit(0.0), F.least(F.lit(1.0), full))))


def status(kind: str = "source_type") -> Column:
    c, few = F.col, F.col("sample_size") < 5
    good = (c("score") >= 0.75) & (c("quarantine_rate") <= 0.15) & (c("merchant_yield") >= 0.6) & (c("completeness") >= 0.5)
    first = c(kind).isin(TIER_A)
    return (
        F.when(few & first, "approved")
        .when(few & c(kind).isin(TIER_B), "probation")
        .when(few & (c(kind) == "discovery"), "rejected")
        .when(good, "approved")
        .when(c("score") >= 0.45, "probation")
        .when(first, "probation")
        .otherwise("rejected")
    )


def classify(measured: DataFrame, kind: str = "source_type", locked: Column | None = None, current: str | None = None) -> DataFrame:
    """measured with score and status; locked sources keep their status."""
    out = measured.withColumn("score", score()).withColumn("status", status(kind))
    return out.withColumn("status", F.when(locked, F.col(current)).otherwise(F.col("status"))) if locked is not None else out
