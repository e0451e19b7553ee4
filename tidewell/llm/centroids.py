"""Operator 11: centroid clustering of whole-number vectors with partial-distance search.

Vectors are scaled, floored and kept as whole numbers, so that every step is exact and reruns agree. A round assigns
each vector to its nearest centroid and replaces each centroid by the floored mean of its vectors. The search for the
nearest goes over the dimensions by descending variance in blocks: after the first block the centroid that is
nearest so far gets its whole distance, and centroids whose partial distance is strictly above the best are abandoned
block by block; what survives finishes all dimensions. Ties go to the smaller number.

Vectors stay in their tasks: a round sends the centroids (k rows of `dims` numbers) to the tasks and gets one sum per task
and centroid back, added up by an aggregate. The kept vectors are written once to the shared folder.

Defined results: only vectors with exactly `dims` components, none null or not finite, are kept; others have no row.
Components are held within +-2^27 after scaling, so that distances fit a long. Repeated rows count each; a null key
sorts last among the first centroids; with fewer than k vectors there are as many centroids as vectors, with none the
result is empty; centroids without vectors stay as they are. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch, read, ship

K, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
HELD = 1 << 27
BLOCKS = (8, 8, 16)  # dimensions of the first blocks; the last has the rest
ROWS = 4096


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest of the centers; both with dimensions in the order of the search."""
    n, dims = x.shape
    edges = [0, *np.minimum(np.cumsum(BLOCKS), dims).tolist(), dims]
    partial = np.zeros((n, len(centers)), np.int64)
    for d in range(edges[1]):
        step = x[:, d, None] - centers[None, :, d]
        partial += step * step
    first = partial.argmin(1)
    best = ((x - centers[first]) ** 2).sum(1)
    row, center = np.nonzero(partial <= best[:, None])
    sums = partial[row, center]
    for a, b in zip(edges[1:-1], edges[2:], strict=True):
        if a < b:
            sums = sums + ((x[row, a:b] - centers[center, a:b]) ** 2).sum(1)
            alive = sums <= best[row]
            row, center, sums = row[alive], center[alive], sums[alive]
    order = np.lexsort((center, sums, row))
    row, center, sums = row[order], center[order], sums[order]
    head = np.flatnonzero(np.diff(row, prepend=-1))
    return center[head], sums[head]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.int64)


def _pieces(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _summing(centers: np.ndarray, order: np.ndarray):
    """A task's vectors as one row per centroid and dimension: (cluster, i, n, x)."""

    def run(batches):
        sums, count = np.zeros((len(centers), len(order)), np.int64), np.zeros(len(centers), np.int64)
        mine = centers[:, order]
        for piece in _pieces(batches):
            x = _matrix(piece.column(1))
            at = nearest(x[:, order], mine)[0]
            np.add.at(sums, at, x)
            count += np.bincount(at, minlength=len(centers))
        own = np.flatnonzero(count)
        dims = np.arange(len(order), dtype=np.int32)
        columns = [np.repeat(own, len(dims)).astype(np.int32), np.tile(dims, len(own)), np.repeat(count[own], len(dims)), sums[own].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "i", "n", "x"])

    return run


def _assigning(centers: np.ndarray, order: np.ndarray):
    def run(batches):
        mine = centers[:, order]
        for piece in _pieces(batches):
            at, far = nearest(_matrix(piece.column(1))[:, order], mine)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(at, pa.int32()), pa.array(far, pa.int64())], ["key", "cluster", "distance"])

    return run


@dataclass
class Clusters:
    assigned: DataFrame  # key, cluster, distance; read from the scratch
    centers: np.ndarray


def whole_vectors(vectors: DataFrame, key: str, vector: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(key, v) of the vectors that can be used, as whole numbers."""
    e = F.transform(vector, lambda x: x.cast("double"))
    ok = (F.size(vector) == dims) & F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    whole = F.transform(e, lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x * scale, F.lit(1e15)), F.lit(-1e15))), F.lit(HELD)), F.lit(-HELD)).cast("int"))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(key).alias("key"), whole.alias("v"))


def cluster(vectors: DataFrame, scratch: Scratch, key: str, vector: str, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> Clusters:
    """Centroids start as the k kept vectors of least sha256 of "seed:key"."""
    spark = vectors.sparkSession
    ship(spark)
    kept = scratch.keep(whole_vectors(vectors, key, vector, dims, scale))
    kind = kept.schema["key"].dataType.simpleString()
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")).cast("binary"), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "v").limit(k).select("v").collect()
    centers = np.array([r.v for r in first], np.int64).reshape(len(first), dims)
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    each = kept.select(F.posexplode("v").alias("i", "x")).withColumn("xx", F.col("x").cast("long") * F.col("x"))
    moments = each.groupBy("i").agg(F.count("*").alias("n"), wide("x").alias("s"), wide("xx").alias("q")).collect()
    variance = {r["i"]: int(r["q"]) * r["n"] - int(r["s"]) ** 2 for r in moments}
    order = np.array(sorted(range(dims), key=lambda i: (-variance.get(i, 0), i)))
    for _ in range(rounds if len(centers) else 0):
        sums = kept.mapInArrow(_summing(centers, order), "cluster int, i int, n bigint, x bigint").groupBy("cluster", "i")
        centers = centers.copy()
        for r in sums.agg(F.sum("n").alias("n"), wide("x").alias("x")).collect():  # k x dims rows
            centers[r["cluster"], r["i"]] = int(r["x"]) // r["n"]
    found = kept.mapInArrow(_assigning(centers, order), f"key {kind}, cluster int, distance bigint") if len(centers) else kept.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false")
    return Clusters(scratch.keep(found), centers)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    out = cluster(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), scratch, "vec_id", "embedding")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    inertia = lambda c: F.least(F.sum(F.col(c).cast("decimal(38,0)")), most)
    by = out.assigned.groupBy("cluster").agg(inertia("distance").alias("inside"))
    # at most K rows: what each centroid is and the sums of its vectors
    hashes = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(out.centers.tolist())], "cluster int, centroid_sha256 string")
    by = scratch.keep(by)
    whole = by.agg(inertia("inside")).head()[0] or 0
    rows = out.assigned.join(F.broadcast(by.join(F.broadcast(hashes), "cluster")), "cluster").withColumn("whole", F.lit(whole))
    return scratch.final(rows.select(F.col("key").alias("vec_id"), "cluster", "distance", F.col("inside").cast("long").alias("cluster_inertia"), F.col("whole").cast("long").alias("inertia"), "centroid_sha256"))


def _sql() -> str:
    sets = [f"""WITH q AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM q ORDER BY h NULLS LAST, v LIMIT {K})
)"""]  # fmt: skip
    for i in range(ROUNDS + 1):
        sets.append(f"""a{i} AS MATERIALIZED (
  SELECT r, first(c ORDER BY d, c) AS c, min(d) AS d
  FROM (SELECT q.r, c{i}.c, list_sum(list_transform(list_zip(q.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM q, c{i}) GROUP BY r
)""")
        if i < ROUNDS:
            sets.append(f"""m{i} AS (
  SELECT c, list(f ORDER BY i) AS v FROM (SELECT c, i, CAST(floor(CAST(sum(v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS f FROM a{i} JOIN q USING (r), unnest(range(1, {DIMS + 1})) t(i) GROUP BY c, i) GROUP BY c
), c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    last = f"a{ROUNDS}"
    return ",\n".join(sets) + f"""
SELECT vec_id, CAST({last}.c AS INTEGER) AS cluster, CAST({last}.d AS BIGINT) AS distance, CAST(sum({last}.d) OVER (PARTITION BY {last}.c) AS BIGINT) AS cluster_inertia,
  CAST(sum({last}.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM {last} JOIN q USING (r) JOIN c{ROUNDS} USING (c)
"""


OP11_SQL = _sql()
