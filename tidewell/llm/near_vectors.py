"""Operator 4: near-duplicate vectors by random-hyperplane signs in several tables, with exact cosines.

Vectors of equal components form a class. A class goes to one bucket in each table: the signs of its products with
the table's random hyperplanes. Within a bucket all cosines are computed in double precision, block by block of at
most BLOCK classes; a pair that shares buckets of several tables counts in the first only. What leaves a block is one
row per class: its links, and the least class it is linked to within the block; pairs are not emitted. These rows
give the links per class and, by contraction, the components.

A bucket of more classes than BLOCK is dealt out to pairs of blocks, each a group of its own, so no task gets a
whole large bucket and no pair in it is skipped. Bits per table follow the number of classes (about PER_BUCKET to a
bucket if they were even); tables are as many as it takes to miss a pair at the threshold with probability MISS.

Defined results: null vectors, zero vectors and those with null or non-finite components link with nothing, each
being its own component; vectors of different lengths don't link; equal vectors link with each other; repeated rows
are vectors of their own; rows without vec_id take part, but never name a component; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import Scratch, read, ship
from tidewell.llm.components import components

COSINE, BLOCK, PER_BUCKET, MISS = 0.9, 512, 48, 0.001


def tables_for(classes: int, cosine: float) -> tuple[int, int]:
    """Bits per table and number of tables."""
    bits = min(24, max(4, round(math.log2(max(classes, 1) / PER_BUCKET)))) if classes > PER_BUCKET else 4
    each = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-each)))


def planes(dimension: int, bits: int, tables: int) -> np.ndarray:
    return np.random.RandomState(20_011).standard_normal((dimension, bits * tables))


def signatures(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One integer for each row and table."""
    signs = (x @ planes(x.shape[1], bits, tables) > 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(2).astype(_number(bits))


def _number(bits: int) -> str:
    return "<u2" if bits <= 16 else "<i4"


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows in double precision with 1 as the greatest size of a component, so that no square overflows."""
    x = x.astype(np.float64)
    return x / np.abs(x).max(1)[:, None]


def linked_block(x: np.ndarray, sig: np.ndarray, weight: np.ndarray, table: int, own: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (of weight) per row, and the least row of its component here. own: True for pairs to look at."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = (unit @ unit.T >= cosine) & own
    np.fill_diagonal(near, False)
    links = near.copy()
    rows, cols = np.nonzero(near)
    if table and len(rows):  # counted in an earlier table
        for at in range(0, len(rows), 1 << 16):
            r, c = rows[at : at + (1 << 16)], cols[at : at + (1 << 16)]
            links[r, c] = ~(sig[r, :table] == sig[c, :table]).any(1)
    least = np.arange(len(x))
    while True:
        best = np.minimum(least, np.where(near, least[None, :], len(x)).min(1, initial=len(x)))
        if (best == least).all():
            return links @ weight, least
        least = best


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vectors(vec_id, embedding)."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    sound = F.size("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("v", lambda c: c != 0)
    # adding zero makes both zeros one; two hashes of the components name a class
    zeroed = F.transform("v", lambda c: c + F.lit(0.0))
    keyed = rows.select("vec_id", F.when(sound, zeroed).alias("v")).select("vec_id", "v", F.when(F.col("v").isNotNull(), F.concat(F.hex(F.xxhash64("v")), F.lit("-"), F.hex(F.xxhash64(F.lit(7), F.reverse("v"))))).alias("k"))
    classes = scratch.keep(keyed.where("k is not null").groupBy("k").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("v").alias("v")))
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    found = _class_links(classes, cosine, "<f4" if single else "<f8", scratch)
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    roots = components(found.where("k != root").select(F.col("k").alias("a"), F.col("root").alias("b")), scratch)
    named = classes.drop("v").join(links, "k", "left").join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    named = named.select("k", "low", "root", (F.col("n") - 1 + F.coalesce(F.col("links"), F.lit(0))).alias("n_links"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(least, "root").select("k", "n_links", "component_id")
    out = keyed.select("vec_id", "k").join(named, "k", "left")
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
    return scratch.final(out)


def _class_links(classes: DataFrame, cosine: float, number: str, scratch: Scratch) -> DataFrame:
    """(k, links, root) rows: links of a class in a block, and the least class it is linked to there.

    number: how components travel; single precision holds those that came so exactly.
    """
    bits, tables = tables_for(classes.count(), cosine)

    def sign(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy().astype(float)
            starts = np.cumsum(sizes) - sizes
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x = flat[starts[at][:, None] + np.arange(d)]
                sig = signatures(scaled(x), bits, tables)
                for t in range(0, len(at), 4096):
                    part = at[t : t + 4096]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(part)), batch.column(1).take(pa.array(part)), pa.array([r.tobytes() for r in x[t : t + 4096].astype(number)], pa.binary()), pa.array([r.tobytes() for r in sig[t : t + 4096]], pa.binary()), pa.array(np.full(len(part), d, np.int32)), pa.array(list(sig[t : t + 4096].astype(np.int32)), pa.list_(pa.int32()))], names=["k", "n", "x", "sig", "d", "buckets"])

    signed = scratch.keep(classes.select("k", "n", "v").mapInArrow(sign, "k string, n long, x binary, sig binary, d int, buckets array<int>"))
    placed = signed.select("k", "d", F.posexplode("buckets").alias("table", "bucket"))
    sizes = placed.groupBy("d", "table", "bucket").agg(F.count("*").alias("members")).where("members > 1")
    placed = placed.join(sizes, ["d", "table", "bucket"])
    # large buckets: each member meets every block; blocks i <= j
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("k"), blocks).cast("int")
    meets = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, "own").alias("i"), F.greatest(b, "own").alias("j"))))
    dealt = placed.select("k", "d", "table", "bucket", blocks.alias("blocks"), own.alias("own")).select("k", "d", "table", "bucket", "own", F.explode(meets).alias("meet"))
    dealt = dealt.select("k", "d", "table", "bucket", "own", "meet.i", "meet.j").join(signed.select("k", "n", "x", "sig"), "k")
    group = ["d", "table", "bucket", "i", "j"]

    def work(rows: pa.Table):
        k = rows.column("k").to_pylist()
        if len(k) < 2:
            return None
        x = scaled(np.frombuffer(b"".join(rows.column("x").to_pylist()), number).reshape(len(k), -1))
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), _number(bits)).reshape(len(k), -1)
        own, i, j = rows.column("own").to_numpy(), rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        pairs = np.ones((len(k), len(k)), bool) if i == j else own[:, None] != own[None, :]
        links, least = linked_block(x, sig, rows.column("n").to_numpy(), rows.column("table")[0].as_py(), pairs, cosine)
        some = np.flatnonzero((links > 0) | (least != np.arange(len(k))))
        return {"k": [k[a] for a in some], "links": links[some], "root": [k[least[a]] for a in some]} if len(some) else None

    def solve(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            key = np.stack([rows.column(c).to_numpy() for c in group], 1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            bounds = [0, *cuts.tolist()]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                out = work(rows.slice(a, b - a))
                if out:
                    yield pa.RecordBatch.from_pydict(out, schema=shape)
            rest = rows.slice(bounds[-1])
        if rest is not None and rest.num_rows:
            out = work(rest)
            if out:
                yield pa.RecordBatch.from_pydict(out, schema=shape)

    shape = pa.schema([("k", pa.string()), ("links", pa.int64()), ("root", pa.string())])
    columns = ["k", *group, "own", "n", "x", "sig"]
    parts = dealt.repartition(*group).sortWithinPartitions(*group).select(*columns)
    return scratch.keep(parts.mapInArrow(solve, "k string, links long, root string"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))
