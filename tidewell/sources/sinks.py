"""Outputs: CSV and JSON files, exports with a manifest, and tables replaced as a whole."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame) -> DataFrame:
    """Complex columns as JSON, times as ISO text, nulls as empty text."""
    def cell(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    return df.select(*map(cell, df.schema.fields))


def write_csv(df: DataFrame, path: str) -> None:
    """Quotes doubled, header in each part; parts stay as they are, so no task gets all rows."""
    flat(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def export_tables(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Each table as CSV, and a manifest (name, rows, error), counted while written; one table's failure doesn't stop the others."""
    done = []
    for name, df in tables.items():
        try:
            counted = Observation()
            write_csv(df.observe(counted, F.count(F.lit(1)).alias("rows")), f"{folder}/{name}")
            done.append((name, counted.get["rows"], None))
        except Exception as e:  # noqa: BLE001  recorded in the manifest
            done.append((name, None, str(e)[:500]))
    manifest = spark.createDataFrame(done, "name string, rows long, error string")
    write_csv(manifest, f"{folder}/manifest")
    return manifest


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)


def replace_table(df: DataFrame, path: str, batch: int | None = None) -> None:
    """Write beside, then swap by two renames; df may read the old table.

    Between the renames there is no table at path: a reader then fails, and what stops there is mended by recover().
    batch: a number that the new table carries (see last_batch).
    """
    spark = df.sparkSession
    new, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.old"
    df.write.parquet(new)
    fs, at = _files(spark, path)
    if batch is not None:
        fs.create(at(f"{new}/_batch-{batch}")).close()
    recover(spark, path)
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(new), at(path))
    fs.delete(at(old), True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring the old table back where a swap stopped halfway, or remove it where the swap was done."""
    fs, at = _files(spark, path)
    if fs.exists(at(f"{path}.old")):
        if fs.exists(at(path)):
            fs.delete(at(f"{path}.old"), True)
        else:
            fs.rename(at(f"{path}.old"), at(path))


def last_batch(spark: SparkSession, path: str) -> int:
    """The number that a table carries; -1 without one."""
    fs, at = _files(spark, path)
    found = fs.globStatus(at(f"{path}/_batch-*")) if fs.exists(at(path)) else None
    return max((int(f.getPath().getName().rsplit("-", 1)[1]) for f in found or []), default=-1)


MANIFEST = "database string, table string, rows long, source string, error string, file string"


def file_name(table: str) -> str:
    """A table's name as a file's: without quotes, points and slashes as underscores."""
    return re.sub(r"[./]", "_", table.replace('"', ""))


def live_tables(spark: SparkSession, databases: Sequence[str]) -> dict[str, list[str]]:
    """The tables and permanent views of those of the databases that the session's catalog has, by name."""
    there = {d for d in databases if spark.catalog.databaseExists(d)}
    return {d: sorted(t.name for t in spark.catalog.listTables(d) if not t.isTemporary) for d in databases if d in there}


def file_tables(spark: SparkSession, path: str, databases: Sequence[str], scratch: str) -> dict[str, dict[str, DataFrame]]:
    """Tables of a JSON file {database: {table: [rows]}}, of the given databases only; none if there is no file.

    Rows are dealt out as lines to the scratch folder and read again, so that Spark infers each table's columns.
    """
    fs, at = _files(spark, path)
    if not fs.exists(at(path)):
        return {}
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,map<string,array<string>>>")).alias("database", "tables"))
    lines = whole.where(F.col("database").isin(*databases)).select("database", F.explode("tables").alias("table", "rows")).select("database", "table", F.explode_outer("rows").alias("value"))
    lines.write.mode("overwrite").partitionBy("database", "table").text(scratch)
    names = spark.read.schema("value string, database string, table string").text(scratch).select("database", "table").distinct().collect()  # one row per table
    return {d: {t: spark.read.json(f"{scratch}/database={_escaped(d)}/table={_escaped(t)}") for e, t in sorted(map(tuple, names)) if e == d} for d in sorted({n[0] for n in names})}


def _escaped(name: str) -> str:
    """A partition's value as Spark writes it in folder names."""
    return re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", name)


def export_databases(spark: SparkSession, databases: Sequence[str], folder: str, fallback: str | None = None) -> DataFrame:
    """Every live table of the databases as CSV under folder/<database>/<table>.csv; those of databases that the catalog
    lacks from the fallback file. Returns and writes the manifest (MANIFEST), ordered by database and table.

    A table that fails has its error in the manifest and stops no other; a database in neither place has no rows in it.
    """
    live = live_tables(spark, databases)
    missing = [d for d in databases if d not in live]
    found = [(d, t, "live", lambda d=d, t=t: spark.table(f"`{d}`.`{t}`")) for d, ts in live.items() for t in ts]
    scratch = f"{folder}/_rows-{uuid.uuid4().hex}"
    if fallback and missing:
        found += [(d, t, "json", lambda df=df: df) for d, ts in file_tables(spark, fallback, missing, scratch).items() for t, df in ts.items()]
    done = []
    for database, name, source, table in found:
        at = f"{database}/{file_name(name)}.csv"
        try:
            counted = Observation()
            write_csv(table().observe(counted, F.count(F.lit(1)).alias("rows")), f"{folder}/{at}")
            done.append((database, name, counted.get["rows"], source, "", at))
        except Exception as e:  # noqa: BLE001  recorded in the manifest
            done.append((database, name, 0, source, str(e).partition("\n")[0][:500], at))
    fs, path = _files(spark, folder)
    fs.delete(path(scratch), True)
    manifest = spark.createDataFrame(sorted(done), MANIFEST)
    write_csv(manifest.coalesce(1), f"{folder}/_manifest.csv")
    return manifest
