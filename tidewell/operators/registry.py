"""Changes of the source registry and of what hangs on it, as whole-table plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import constants as C
from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators.relational import first_per, merge

KEYS = ["domain", "source_type"]


def category(source: Column) -> Column:
    return F.coalesce(T.lookup(source, C.SOURCE_CATEGORY), F.lit("generic"))


def valid_source() -> Column:
    """A registry row's own checks: lengths, URL and known words."""
    c = F.col
    return F.coalesce((F.length("source_name") >= 2) & (F.length("domain") >= 3) & U.hostname(c("base_url")).isNotNull() & c("source_type").isNotNull() & F.coalesce(c("category").isin("bank", "network", "merchant", "coupon", "discovery", "generic"), F.lit(True)) & F.coalesce(c("status").isin("approved", "probation", "rejected"), F.lit(True)), F.lit(False))


def upsert_sources(sources: DataFrame, new: DataFrame) -> DataFrame:
    """New descriptions by (domain, type); status and priority of known sources stay."""
    columns = [c for c in sources.columns if c not in KEYS]
    return merge(sources, new.withColumn("domain", U.normalize_domain(F.col("domain"))), KEYS, columns, F.lit(True), sticky=["status", "priority", "confidence"]).drop("action")


def sync_registry(sources: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry's rows by (domain, type) replace the stored ones, status and priority included."""
    columns = [c for c in sources.columns if c not in KEYS]
    return merge(sources, registry, KEYS, columns, F.lit(True)).drop("action")


def update_health(sources: DataFrame, health: DataFrame) -> DataFrame:
    """sources(…, locked) with confidence and status from health(source_type, score, status); locked ones keep status."""
    h = health.select("source_type", F.col("score").alias("_score"), F.col("status").alias("_status"))
    out = sources.join(h, "source_type", "left")
    new = F.when(F.coalesce("locked", F.lit(False)), F.col("status")).otherwise(F.coalesce("_status", "status"))
    return out.withColumns({"confidence": F.coalesce("_score", "confidence"), "status": new}).select(sources.columns)


def set_status(sources: DataFrame, decisions: DataFrame) -> DataFrame:
    """Manual decisions(domain, source_type, new_status), whatever the lock."""
    return sources.join(decisions, KEYS, "left").withColumn("status", F.coalesce("new_status", "status")).select(sources.columns)


def link_offers(offers: DataFrame, sources: DataFrame) -> DataFrame:
    """offers with source_name: their own, else the best source of their type, else of their host."""
    order = [F.col("priority").desc_nulls_last(), F.col("source_name")]
    kinds = first_per(sources, ["source_type"], order).select("source_type", F.col("source_name").alias("_k"))
    hosts = first_per(sources, ["domain"], order).select(F.col("domain").alias("_d"), F.col("source_name").alias("_h"))
    out = offers.withColumn("_d", U.domain(F.col("normalized_url"))).join(kinds, "source_type", "left").join(hosts, "_d", "left")
    own = F.col("source_name") if "source_name" in offers.columns else F.lit(None).cast("string")
    return out.withColumn("source_name", F.coalesce(own, "_k", "_h")).drop("_d", "_k", "_h")


def missing_sources(urls: DataFrame, sources: DataFrame) -> DataFrame:
    """A source on probation, not crawled by itself, for each host that no source covers."""
    hosts = urls.select(U.domain(F.col("url")).alias("domain")).where(F.coalesce("domain", F.lit("")) != "").distinct()
    labels = F.split("domain", r"\.")
    above = hosts.withColumn("_d", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    covered = above.join(sources.select(F.col("domain").alias("_d")), "_d", "left_semi").select("domain").distinct()
    new = hosts.join(covered, "domain", "left_anti")
    kind = U.source_type(F.concat(F.lit("https://"), F.col("domain")))
    return new.select(F.col("domain").alias("source_name"), "domain", F.concat(F.lit("https://"), F.col("domain")).alias("base_url"), kind.alias("source_type"), category(kind).alias("category"), F.lit("probation").alias("status"), F.lit(False).alias("auto_crawl"))


def release(quarantine: DataFrame, source_types: list[str], kind: str = "rejected_source") -> DataFrame:
    """quarantine without the rows of a type that now approved sources no longer have."""
    return quarantine.where(~F.coalesce((F.col("quarantine_type") == kind) & F.col("source_type").isin(source_types), F.lit(False)))


def purge(offers: DataFrame, noise: list[str]) -> DataFrame:
    """offers without rows whose title or description has noise, or that earn at most one point without a merchant."""
    text = F.concat_ws(" ", "offer_title", "offer_description")
    empty = F.coalesce("merchant_name", F.lit("")) == ""
    low = F.coalesce(T.to_number(F.col("discount_value")), F.lit(0.0)) <= 1
    return offers.where(~(T.any_of(text, noise) | (empty & low & F.coalesce(F.col("discount_type") == "points", F.lit(False)))))


def dashboard(sources: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per status: sources, mean confidence and quarantined rows."""
    q = quarantine.groupBy("source_type").agg(F.count("*").alias("q"))
    return sources.join(q, "source_type", "left").groupBy("status").agg(F.count("*").alias("sources"), F.avg("confidence").alias("confidence"), F.coalesce(F.sum("q"), F.lit(0)).alias("quarantined"))


def recent_failures(failures: DataFrame, n: int = 5) -> DataFrame:
    """The newest failures of each source."""
    return first_per(failures, ["source_name"], [F.col("occurred_at").desc(), F.col("reason")], n)


def coverage(offers: DataFrame, thresholds: DataFrame, strong: Column) -> DataFrame:
    """Per source type of thresholds(source_type, least, least_strong): counts and whether they suffice."""
    n = offers.groupBy("source_type").agg(F.count("*").alias("n"), F.count_if(strong).alias("strong"))
    out = thresholds.join(n, "source_type", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "strong": F.coalesce("strong", F.lit(0))})
    return out.withColumn("covered", (F.col("n") >= F.col("least")) & (F.col("strong") >= F.col("least_strong")))


def merged_profiles(sources: DataFrame, source_types: list[str], entries: dict[str, str], column: str = "parser_profile") -> DataFrame:
    """sources whose map column takes the entries, over its own, for some types."""
    new = F.create_map(*(F.lit(x) for k, v in entries.items() for x in (k, v)))
    old = F.map_filter(F.coalesce(column, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*entries))
    return sources.withColumn(column, F.when(F.col("source_type").isin(source_types), F.map_concat(old, new)).otherwise(F.col(column)))
