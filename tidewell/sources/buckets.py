"""A table in hashed buckets whose batches rewrite only the buckets they touch, and whose readers always find it.

Rows lie under bucket=<n>/batch=<m>; a bucket's rows are those of its newest batch that is done. A batch writes new
folders for the buckets it changes (by dynamic partition overwrite, so one that runs again replaces only its own) and is
done once its marker file exists, which one call creates. Until then readers see the state before, after that the new
one; nothing is renamed. vacuum() deletes what no reader of the last states needs.

A bucket is one of `groups` by a hash of the group column (rows that may be merged with each other share it) times one of
`parts` by a hash of the key: matching reads a group, writing stays within parts, and a group that holds a third of all
rows is dealt over its parts.

Defined results: a table without a batch is empty; a null group or key is a value of its own; a batch without rows only
sets its marker; a batch number that is done already is not written again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.sinks import _files


@dataclass
class BucketTable:
    spark: SparkSession
    path: str
    schema: str
    group: Column
    key: Column
    groups: int = 64
    parts: int = 16

    def group_number(self) -> Column:
        return F.pmod(F.xxhash64(self.group), F.lit(self.groups)).cast("int")

    def bucket(self) -> Column:
        return self.group_number() * self.parts + F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.parts)).cast("int")

    def _listed(self, pattern: str) -> list[str]:
        fs, at = _files(self.spark, self.path)
        found = fs.globStatus(at(f"{self.path}/{pattern}")) if fs.exists(at(self.path)) else None
        return [f.getPath().toString() for f in found or []]

    def done(self) -> list[int]:
        """The numbers of the batches that are done, ascending."""
        return sorted(int(p.rsplit("-", 1)[1]) for p in self._listed("_done-*"))

    def folders(self) -> list[tuple[int, int, str]]:
        """(bucket, batch, path) of every folder, done or not: as many as there are buckets and kept states."""
        out = []
        for p in self._listed("bucket=*/batch=*"):
            bucket, batch = p.rsplit("/", 2)[1:]
            out.append((int(bucket.partition("=")[2]), int(batch.partition("=")[2]), p))
        return out

    def current(self, upto: int | None = None) -> dict[int, str]:
        """The folder of each bucket, as of a batch or the last one that is done."""
        finished = [n for n in self.done() if upto is None or n <= upto]
        done, out = set(finished), {}
        for bucket, batch, path in self.folders():
            if batch in done and (bucket not in out or batch > out[bucket][0]):
                out[bucket] = (batch, path)
        return {b: p for b, (_, p) in out.items()}

    def read(self, groups: Iterable[int] | None = None, upto: int | None = None) -> DataFrame:
        """All rows, or those of some groups, whose buckets alone are read."""
        wanted = None if groups is None else set(groups)
        paths = [p for b, p in self.current(upto).items() if wanted is None or b // self.parts in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, batch: int) -> bool:
        """Make the given rows the whole content of the buckets that they lie in; False if the batch was done before."""
        if batch in self.done():
            return False
        placed = rows.withColumns({"bucket": self.bucket(), "batch": F.lit(batch)})
        placed.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.path)
        fs, at = _files(self.spark, self.path)
        fs.mkdirs(at(self.path))
        fs.create(at(f"{self.path}/_done-{batch}"), True).close()
        return True

    def vacuum(self, states: int = 2) -> int:
        """Delete folders that none of the last `states` states reads; returns how many."""
        done = self.done()
        if not done:
            return 0
        kept = {p for n in done[-states:] for p in self.current(n).values()}
        gone = [p for _, batch, p in self.folders() if p not in kept and batch <= done[-1]]
        fs, at = _files(self.spark, self.path)
        for p in gone:
            fs.delete(at(p), True)
        return len(gone)
