"""Files of a stream by content: each content once, however often and under whatever name it is delivered.

The ledger is the stream's own state: content hashes are dropped within a watermark on the files' times, so the state
holds the hashes of `remember`, not of all time. A content that comes again after that counts as new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.crawl import RAW_OFFER, as_offers

FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str, remember: str = "30 days", per_batch: int = 50) -> DataFrame:
    """A stream of (file, modified, content_hash, content), a row per content."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", per_batch).option("recursiveFileLookup", True).load(folder)
    return once_by_content(files.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("content_hash"), "content"), remember)


def once_by_content(files: DataFrame, remember: str = "30 days") -> DataFrame:
    """files (modified, content_hash, ...) without those whose content came before; a table keeps each content's first file."""
    if files.isStreaming:
        return files.withWatermark("modified", remember).dropDuplicatesWithinWatermark(["content_hash"])
    rest = [c for c in files.columns if c != "content_hash"]
    first = F.min_by(F.struct(*rest), F.struct("modified", *(c for c in rest if c == "file")))
    return files.groupBy("content_hash").agg(first.alias("_f")).select(*(F.col("content_hash") if c == "content_hash" else F.col(f"_f.{c}").alias(c) for c in files.columns))


def records(files: DataFrame) -> DataFrame:
    """The raw offer rows of files: an object or an array of objects each; broken ones have their text in _corrupt."""
    text = F.decode("content", "UTF-8")
    listed = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))
    rows = files.select("file", F.explode(F.coalesce(listed, F.array(text))).alias("_t"))
    parsed = F.from_json("_t", RAW_OFFER, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return as_offers(rows.select(parsed.alias("_o"), "file").select("_o.*", "file"))
