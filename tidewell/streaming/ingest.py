"""Ingestion as a file stream: micro-batches of crawl files through the same plan, each batch applied once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.url import hostname
from tidewell.operators import quality as Q
from tidewell.operators.containment import with_checkpoints
from tidewell.plans import ingestion as I
from tidewell.sources.buckets import BucketTable
from tidewell.streaming.ledger import new_files, records

FILES_PER_BATCH = 50
STORED = [*I.STORED, "filled", "first_seen_at", "last_seen_at", "freshness"]
KINDS = {c: Q.OFFER.get(c, "string") for c in STORED} | {"confidence": "double", "filled": "int", "first_seen_at": "timestamp", "last_seen_at": "timestamp"}


def offers_table(spark: SparkSession, folder: str) -> BucketTable:
    """The stream's offers: buckets by host, since only offers of one host are merged, and by key within a host."""
    kinds = "canonical_key string, " + ", ".join(f"{c} {KINDS[c]}" for c in STORED)
    return BucketTable(spark, f"{folder}/offers", kinds, F.coalesce(hostname(F.col("normalized_url")), F.col("normalized_url")), F.col("canonical_key"))


def apply_batch(raw: DataFrame, sources: DataFrame, folder: str, batch: int) -> None:
    """Merge one batch into the offers and write its quarantine and snapshots under its number.

    Only the buckets of hosts in the batch are read, and only those with a changed row written. A batch that runs again
    before it is done overwrites its own files; after it, nothing happens, so its snapshots stay.
    """
    spark = raw.sparkSession
    table = offers_table(spark, folder)
    if batch in table.done():
        return
    with_checkpoints(spark)
    rows = I.evaluated(raw, sources).checkpoint()
    seen = F.lit(rows.agg(F.max("scraped_at")).head()[0]).cast("timestamp")
    accepted = rows.where("route = 'offers'")
    groups = [r[0] for r in accepted.select(table.group_number()).distinct().collect()]  # at most table.groups
    after = I.upsert(table.read(groups), accepted, seen).withColumn("_bucket", table.bucket()).checkpoint()
    changed = [r[0] for r in after.where("action != 'kept'").select("_bucket").distinct().collect()]  # at most all buckets
    I.snapshots(after, seen).write.mode("overwrite").parquet(f"{folder}/snapshots/batch={batch}")
    I.quarantined(rows).write.mode("overwrite").parquet(f"{folder}/quarantine/batch={batch}")
    table.write(after.where(F.col("_bucket").isin(changed)).select("canonical_key", *(F.col(c).cast(KINDS[c]).alias(c) for c in STORED)), batch)
    table.vacuum()


def stream(spark: SparkSession, crawl: str, sources: DataFrame, folder: str, remember: str = "30 days"):
    """Start the stream over all files that are there; it ends when these are read. Equal files count once."""
    raw = records(new_files(spark, crawl, remember, FILES_PER_BATCH))
    return raw.writeStream.foreachBatch(lambda df, n: apply_batch(df, sources, folder, n)).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """Events per type and window, for a stream or a table; rows later than the watermark are left out of a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
