"""Inputs of ingestion: crawl records, discovery results, run summaries, source registries; and file ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_OFFER = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("sourceUrl", "sourceType", "bankName", "cardName", "merchantName", "offerTitle", "offerDescription", "discountType", "discountValue", "currency", "couponCode", "minSpend", "capValue", "termsUrl", "validFrom", "validTo")]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("paymentMethods", "eligibleMccList", "categories")]
    + [T.StructField("stackable", T.BooleanType()), T.StructField("confidence", T.DoubleType())]
    + [T.StructField(n, T.StringType()) for n in ("parserName", "parserReason", "parserVersion", "pageType", "schemaVersion")]
    + [T.StructField("crawlDepth", T.IntegerType()), T.StructField("pageLength", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("scrapedAt", "rawText", "rawHtml", "discoveryQuery", "discoverySource")]
    + [T.StructField("serpRank", T.IntegerType()), T.StructField("fromDiscovery", T.BooleanType()), T.StructField("_corrupt", T.StringType())]
)
DISCOVERED = "array<struct<url:string,title:string,snippet:string,discoveryQuery:string,query:string,discoverySource:string,source:string,serpRank:int,rank:int>>"
SUMMARY = "timestamp string, qualityBySource map<string,struct<pages:bigint,offersEmitted:bigint,skippedShell:bigint,skippedCategory:bigint,skippedValidation:bigint,enqueued:bigint>>"
REGISTRY = "source_name string, domain string, base_url string, source_type string, category string, status string, priority int, confidence double, confidence_floor double, strict boolean"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def crawl_records(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON object per file or line, with its file; broken ones have their text in _corrupt."""
    if not exists(spark, folder):
        raise FileNotFoundError(folder)
    rows = spark.read.schema(RAW_OFFER).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    return as_offers(rows.withColumn("file", F.col("_metadata.file_path")))


def as_offers(rows: DataFrame) -> DataFrame:
    """Raw field names to the engine's; the parser's confidence is kept apart from the engine's."""
    names = {n: "".join(f"_{c.lower()}" if c.isupper() else c for c in n) for n in rows.columns}
    return rows.select(*(F.col(n).alias("parser_confidence" if n == "confidence" else new) for n, new in names.items()))


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """(file, content_hash) of each file."""
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), F.sha2("content", 256).alias("content_hash"))


def unseen(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content no completed run has read, each content once."""
    return files.join(ledger.select("content_hash"), "content_hash", "left_anti").groupBy("content_hash").agg(F.min("file").alias("file"))


def discovery_results(spark: SparkSession, path: str) -> DataFrame:
    """(url, title, snippet, query, source, rank) of a discovery file in any of its shapes; empty if it is missing."""
    empty = spark.createDataFrame([], "url string, title string, snippet string, query string, source string, rank int")
    if not exists(spark, path):
        return empty
    text = spark.read.text(path, wholetext=True)
    wrapped = F.from_json("value", f"results {DISCOVERED}, seeds {DISCOVERED}")
    items = F.coalesce(F.when(F.ltrim("value").startswith("["), F.from_json("value", DISCOVERED)), wrapped["results"], wrapped["seeds"])
    x = text.select(F.explode(items).alias("x")).select("x.*")
    return x.select("url", "title", "snippet", F.coalesce("discoveryQuery", "query").alias("query"), F.coalesce("discoverySource", "source").alias("source"), F.coalesce("serpRank", "rank").alias("rank")).where("url is not null")


def run_summary(spark: SparkSession, path: str) -> DataFrame:
    """Counters per source type of a crawl run; empty if the file is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], "source_type string, pages bigint, offers_emitted bigint, skipped bigint, enqueued bigint")
    rows = spark.read.schema(SUMMARY).option("multiLine", True).json(path).select(F.explode("qualityBySource").alias("source_type", "q"))
    zero = lambda n: F.coalesce(F.col(f"q.{n}"), F.lit(0))
    return rows.select("source_type", zero("pages").alias("pages"), zero("offersEmitted").alias("offers_emitted"), (zero("skippedShell") + zero("skippedCategory") + zero("skippedValidation")).alias("skipped"), zero("enqueued").alias("enqueued"))


def crawl_rates(summary: DataFrame) -> DataFrame:
    per = lambda n: F.when(F.col("pages") > 0, F.col(n) / F.col("pages")).otherwise(0.0)
    return summary.select("source_type", "pages", per("offers_emitted").alias("yield_rate"), per("skipped").alias("skip_rate"))


def registry(spark: SparkSession, path: str | None = None, rows: list[tuple] = ()) -> DataFrame:
    """The source registry from a JSON file, else from given rows."""
    if path and exists(spark, path):
        return spark.read.schema(REGISTRY).option("multiLine", True).json(path)
    return spark.createDataFrame(list(rows), REGISTRY)


def source_index(sources: DataFrame) -> DataFrame:
    """One source per type: approved before probation before rejected, then by priority."""
    rank = F.when(F.col("status") == "approved", 3).when(F.col("status") == "probation", 2).when(F.col("status") == "rejected", 1).otherwise(0)
    values = [c for c in sources.columns if c != "source_type"]
    return sources.groupBy("source_type").agg(F.max_by(F.struct(*values), F.struct(rank, F.coalesce("priority", F.lit(-(1 << 30))), F.col("source_name"))).alias("s")).select("source_type", "s.*")


def discovery_index(found: DataFrame) -> DataFrame:
    """(key, url, query, source, rank): each lookup key of each result, the first result of a key."""
    from tidewell.functions.url import discovery_keys

    rows = found.select("url", "query", "source", "rank", F.posexplode(discovery_keys(F.col("url"))).alias("at", "key"))
    return rows.groupBy("key").agg(F.min_by(F.struct("url", "query", "source", "rank"), F.struct(F.coalesce("rank", F.lit(1 << 30)), "at", "url")).alias("r")).select("key", "r.*")


def crawlable(status: Column, auto: Column) -> Column:
    return F.coalesce(auto, F.lit(True)) & F.coalesce(status.isin("approved", "probation"), F.lit(False))


def crawl_plan(sources: DataFrame) -> DataFrame:
    """Sources that may be crawled, best first."""
    return sources.where(crawlable(F.col("status"), F.lit(True))).orderBy(F.col("priority").desc_nulls_last(), "domain", "source_type")


def start_urls(sources: DataFrame, seeds: Column | None = None) -> DataFrame:
    """Base and seed URLs of the plan, each once, with the best priority."""
    from tidewell.functions.url import strip_query

    urls = F.concat(F.array("base_url"), F.coalesce(seeds, F.array())) if seeds is not None else F.array("base_url")
    rows = sources.where(crawlable(F.col("status"), F.lit(True))).select("source_type", "priority", F.posexplode(urls).alias("at", "url")).where("url is not null")
    return rows.groupBy(strip_query(F.col("url")).alias("key")).agg(F.max_by(F.struct("url", "source_type", "priority"), F.struct(F.coalesce("priority", F.lit(0)), -F.col("at"), "source_type")).alias("r")).select("r.*")
