"""What the corpus operators share: reading tables, shared scratch tables, shipping code to workers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.relational import spread

_SHIPPED: set[str] = set()


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """A table or some of its columns. Named columns are dealt out over all cores where a small file gives few tasks."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spread(df.select(*columns)) if columns else df


def ship(spark: SparkSession) -> None:
    """Make this package importable on the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "tidewell.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith((".py", ".json")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has, in any case: the given ones, with underscores before them where needed."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where a session with a local master names none (tests), a local one is set.

    On a cluster a machine's own folder would hide files from other machines, so there a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"/tmp/checkpoints/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(path)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


class Scratch:
    """Tables written to the shared folder, so that lineage is cut and lost executors cost no recomputation.

    drop() deletes them; what an operator returns must not read them any more (see final()).
    """

    def __init__(self, spark: SparkSession, kind: str = "scratch"):
        self.spark, self.base = spark, f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, df: DataFrame) -> None:
        """Delete the one table that df reads."""
        for f in df.inputFiles()[:1]:
            _delete(self.spark, f.rsplit("/", 1)[0])

    def final(self, df: DataFrame) -> DataFrame:
        """df cut from this scratch by a reliable checkpoint, which Spark's cleaner removes when it is out of use."""
        out = df.checkpoint(eager=True)
        self.drop()
        return out

    def drop(self) -> None:
        _delete(self.spark, self.base)

    def quietly_drop(self) -> None:
        """For the end of the driver, when the session may be gone already."""
        try:
            self.drop()
        except Exception:  # noqa: BLE001
            return


def shared_files(spark: SparkSession, kind: str) -> str:
    """A new folder of shared files that plans still read; it goes when the driver ends."""
    own = Scratch(spark, kind)
    atexit.register(own.quietly_drop)
    return own.base


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def row_bytes(df: DataFrame, text: str) -> int:
    """About the bytes of a table: twice its files' size, as the planner knows it, else the size of its texts."""
    known = 2 * int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < 1 << 60 else df.agg(F.sum(F.octet_length(text))).head()[0] or 0


def widened(df: DataFrame, **columns: str) -> T.StructType:
    """The schema of df with more columns."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in columns.items())])


def sized_join(left: DataFrame, right: DataFrame, on, how: str, rows: int = 500_000) -> DataFrame:
    """Broadcast right, a written table of narrow rows, only if it has at most so many; else both sides shuffle."""
    return left.join(F.broadcast(right) if right.count() <= rows else right, on, how)


HOT = 1000  # rows of one key beyond which a join deals them out


def salted_join(many: DataFrame, one: DataFrame, key: str, scratch: Scratch, before=lambda df: df) -> DataFrame:
    """many (a written table) joined with one (a row per key) on key. A key of more than HOT rows is dealt out.

    The hot keys' rows in `many` get a part by a hash of the whole row, and their row in `one` is repeated for each part,
    so no task gets all rows of a key. before: what else is joined to the rows of `many` first.
    """
    hot = many.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    hot = scratch.keep(hot.select(key, F.ceil(F.col("n") / HOT).cast("int").alias("_parts")))
    if not hot.head(1):
        return before(many).join(one, key)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = sized_join(many, hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*many.columns), parts).cast("int")).drop("_parts")
    repeated = sized_join(one, hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return before(dealt).join(repeated, [key, "_part"]).drop("_part")


def groups_of(batches, keys: list[str]):
    """The groups of a sorted stream of record batches, each as a table. Key columns are numbers."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if not rows.num_rows:
            continue
        key = np.stack([rows.column(c).to_numpy() for c in keys], 1)
        bounds = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist()]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield rows.slice(a, b - a)
        rest = rows.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest


def trim() -> None:
    """Give memory that a task no longer uses back to the system; its worker may live on."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return
