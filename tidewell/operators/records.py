"""Records that runs leave behind, and look-ups of single rows: tables to append, and states after a run.

Ids are hashes of content, so that a step that runs twice makes the same rows. Appending is left to the sink; what is
appended twice is one row after latest().
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.relational import contains, first_per

EVENT = ["source_url", "discovery_query", "discovery_source", "serp_rank", "source_type", "parser_name", "parser_reason", "raw_html", "raw_text", "scraped_at", "page_length"]


def content_id(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def started_runs(inputs: DataFrame, at: Column, kind: str = "crawl_ingest") -> DataFrame:
    """A run per row of inputs: (run_id, run_type, input, status, started_at)."""
    columns = inputs.columns
    return inputs.select(content_id(inputs, columns).alias("run_id"), F.lit(kind).alias("run_type"), F.to_json(F.struct(*columns)).alias("input"), F.lit("running").alias("status"), at.cast("timestamp").alias("started_at"))


def finished_runs(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """runs with the outcome of those that ended: outcomes(run_id, status, stats, finished_at, error). Others keep running."""
    done = outcomes.select("run_id", F.col("status").alias("_status"), "stats", "finished_at", "error")
    out = runs.drop("stats", "finished_at", "error").join(done, "run_id", "left")
    return out.withColumn("status", F.coalesce("_status", "status")).drop("_status")


def processed_files(ledger: DataFrame, files: DataFrame, run_id: Column) -> DataFrame:
    """The ledger (run_id, file, content_hash) after a run read files(file, content_hash); the newest hash of a file counts."""
    new = files.select(run_id.alias("run_id"), "file", "content_hash")
    kept = ledger.join(new.select("run_id", "file"), ["run_id", "file"], "left_anti")
    return kept.select("run_id", "file", "content_hash").unionByName(new)


def raw_events(rows: DataFrame, run_id: Column) -> DataFrame:
    """An audit row per raw row, with all of it as JSON."""
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    fields = {c: have(c) for c in EVENT} | {"source_type": F.coalesce(have("source_type"), F.lit("generic")), "page_length": F.coalesce(have("page_length").cast("int"), F.lit(0))}
    return rows.select(run_id.alias("run_id"), *(x.alias(c) for c, x in fields.items()), F.to_json(F.struct(*rows.columns)).alias("payload"))


def observations(measured: DataFrame, source: str, metrics: Sequence[str], kind: str = "validation") -> DataFrame:
    """A row per source and metric: (source, observation_type, metric_name, metric_value)."""
    values = F.array(*(F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("metric_value")) for m in metrics))
    return measured.select(F.col(source).alias("source"), F.lit(kind).alias("observation_type"), F.explode(values).alias("m")).select("source", "observation_type", "m.*")


def failures(rows: DataFrame, source: str, reasons: str, sample: str) -> DataFrame:
    """Per source and reason of rows(.., reasons array): how many, and the least sample."""
    return rows.select(F.col(source).alias("source"), F.explode(reasons).alias("reason"), F.col(sample).alias("sample")).groupBy("source", "reason").agg(F.count("*").alias("n"), F.min("sample").alias("sample"))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    return first_per(rows, keys, order)


def newest_per_host(offers: DataFrame, host: Column, order: Sequence[Column], n: int = 20) -> DataFrame:
    """The first n offers of each host; rows without a host have none."""
    return first_per(offers.withColumn("_host", host).where("_host is not null"), ["_host"], order, n).drop("_host")


def find(df: DataFrame, **values) -> DataFrame:
    """The rows whose columns equal the given values, by predicates that reach the scan; a missing value finds nothing."""
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def find_text(df: DataFrame, **values: str) -> DataFrame:
    """As find, whatever the case of letters."""
    for name, value in values.items():
        df = df.where(F.lower(name) == F.lit(value.lower()))
    return df


def card_products(products: DataFrame, bank: str | None = None, network: str | None = None, name: str | None = None, most: int = 100) -> DataFrame:
    """Products by parts of bank, network and name, the first hundred by bank and name."""
    for column, term in (("bank_name", bank), ("card_network", network), ("product_name", name)):
        if term:
            products = products.where(contains(column, term))
    return products.orderBy("bank_name", "product_name").limit(most)


def may_ingest(status: Column) -> Column:
    return F.coalesce(status != "rejected", F.lit(True))


def may_change(before: Column, after: Column) -> Column:
    """Any known status may follow any other."""
    known = ("approved", "probation", "rejected")
    return F.coalesce(before.isin(*known) & after.isin(*known), F.lit(False))


def advice(status: Column, source: Column) -> Column:
    """What to do about a source of a status."""
    tighter = F.concat(F.lit("Tighter quality gates active. Improve parser for "), F.coalesce(source, F.lit("source")), F.lit(" before promoting."))
    return F.when(status == "approved", "Continue automated crawl at normal quality gates.").when(status == "probation", tighter).otherwise("Excluded from crawl planning. Manual review required to re-enable.")


def approved_domains(sources: DataFrame) -> DataFrame:
    """The distinct domains of sources(domain, status, auto_crawl) that may be crawled: approved ones, and those on probation that crawl by themselves."""
    on_probation = (F.col("status") == "probation") & F.coalesce("auto_crawl", F.lit(False))
    return sources.where((F.col("status") == "approved") | on_probation).select("domain").distinct()
