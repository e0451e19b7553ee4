"""Operator 7: near-duplicate documents by SetSketch registers.

A text's set holds the hashes of its five-word shingles. Each element sends exponentially spaced points to random
registers; a register keeps the least point, truncated to a power of BASE. Registers of a union are the least of
both (sketches merge), and equal registers tell similarity. Work is done on classes of equal sets:

1. one pass makes each document's set key and registers; documents of one key form a class;
2. bands of ROWS registers put classes in buckets. In a bucket all members are compared with its least one (the
   pivot), and linked classes become one component. So a group of n copies costs about n comparisons. Of what is
   left, members of one component need no comparison; others are compared pair by pair in buckets of up to SMALL
   members, and in blocks of bounded size in larger ones. No bucket is cut or dropped;
3. a pair is dropped if, given its registers and set sizes, a similarity over the threshold is less likely than
   the best one by a factor of exp(-LIKELIHOOD); others are confirmed on their full sets, made from the texts.

A pair at the threshold misses all bands with probability 4e-7. Buckets and pivots of many members are dealt out in
joins (salted_join), so none comes to one task.

Defined results: null or wordless texts have empty sets and link with nothing; texts of one to four words have
their whole sequence as one shingle; repeated rows are copies of each other; rows without doc_id take part, but
never name a component (a group without ids has a null component_id, and its rows count as kept); an empty table
gives an empty result; other columns are ignored. stays marks the rows of the one document of each group that the
pipeline keeps: that of least id (none last), then of least text hash; rows without words all stay.
"""

from __future__ import annotations

import atexit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch, fresh, groups_of, read, salted_join, ship, sized_join, trim
from tidewell.llm.components import components
from tidewell.llm.words import WordHasher, grams, splitmix

SHINGLE, REGISTERS, ROWS, BASE = 5, 125, 5, 1.001
BANDS = REGISTERS // ROWS
LIKELIHOOD = 14.0
SMALL, BLOCK = 16, 512  # members of a bucket whose pairs are compared singly; classes of a block
_U = np.uint64


def spaced_words() -> WordHasher:
    b = np.arange(256)
    return WordHasher((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingle hashes."""
    if len(words) >= SHINGLE:
        return np.unique(grams(words, SHINGLE))
    return grams(words, len(words)) ^ _U(len(words)) if len(words) else np.zeros(0, np.uint64)


def set_key(elements: np.ndarray) -> bytes:
    """128 bits of a set, whatever its order."""
    with np.errstate(over="ignore"):
        a, b = splitmix(elements ^ _U(0xA5A5A5A5A5A5A5A5)), splitmix(elements + _U(0x1234567))
        return np.array([a.sum(dtype=np.uint64) + _U(len(elements)), b.sum(dtype=np.uint64)], np.uint64).tobytes()


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sets' sketches, a row each, 16 bits a register.

    An element's points are a Poisson process of rate REGISTERS, each at a random register; those beyond the
    largest register's least point cannot count, so long sets need few points each.
    """
    least = np.full((len(sets), REGISTERS), np.inf)
    at = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    points, turn, bound = np.zeros(len(at)), 0, np.full(len(sets), np.inf)
    while len(at):
        turn += 1
        with np.errstate(over="ignore"):
            bits = splitmix(at + _U((turn * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF))
        points = points - np.log(((bits >> _U(11)).astype(float) + 0.5) * 2.0**-53) / REGISTERS
        np.minimum.at(least.reshape(-1), owner * REGISTERS + ((bits & _U(0x3FF)) * _U(REGISTERS) >> _U(10)).astype(np.int64), points)
        live = np.flatnonzero(np.bincount(owner, minlength=len(sets)))
        bound[live] = least[live].max(1)
        going = points < bound[owner]
        at, owner, points = at[going], owner[going], points[going]
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)) + 32768, 0, 65535).astype("<u2")


def portions(sets, elements: int = 300_000):
    """The sets in lists of bounded size."""
    part, size = [], 0
    for s in sets:
        part.append(s)
        size += len(s)
        if size >= elements or len(part) == 1024:
            yield part
            part, size = [], 0
    if part:
        yield part


_GRID = np.linspace(0, 1, 401)


def plausible(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a similarity of at least the threshold is plausible for pairs of sketches (rows of a and b) of sets of n and m elements."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = n / (n + m), m / (n + m)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    best = np.full((2, len(n)), -np.inf)
    for j in _GRID:
        possible = j <= np.minimum(u / v, v / u) + 1e-9
        up, down = p(u - v * j), p(v - u * j)
        value = np.where(possible, more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12)), -np.inf)
        best[0] = np.maximum(best[0], value)
        if j >= threshold - 0.5 / (len(_GRID) - 1):
            best[1] = np.maximum(best[1], value)
    return best[1] > best[0] - LIKELIHOOD


def sketch_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, k, sig) per row of docs(doc_id, text); k and sig are null for empty sets."""
    ship(docs.sparkSession)

    def sketch(batches):
        hasher = spaced_words()
        for batch in batches:
            n, keys, sigs = [], [], []
            for part in portions(shingle_set(words) for words in hasher.column(batch.column(2))):
                n += [len(s) for s in part]
                keys += [set_key(s) if len(s) else None for s in part]
                sigs += [row.tobytes() if len(s) else None for s, row in zip(part, registers(part), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "text_key", "n_shingles", "k", "sig"])
        trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(sketch, "doc_id long, text_key long, n_shingles long, k binary, sig binary")


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Those of pairs(a, b), a written table, whose sketches don't rule a link out."""
    a, b = (classes.select(F.col("k").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}")) for end in ("a", "b"))
    pairs = salted_join(pairs, a, "a", scratch, lambda df: df.join(b, "b"))

    def judge(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                x = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(n, -1) for c in ("sig_a", "sig_b")]
                sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                keep = pa.array(plausible(*x, *sizes, threshold))
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(judge, "a binary, b binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Those of pairs(a, b), a written table, whose full sets are similar enough: 100 * both >= percent * any."""
    a, b = (texts.withColumnsRenamed({"k": end, "text": f"text_{end}"}) for end in ("a", "b"))
    pairs = salted_join(pairs, a, "a", scratch, lambda df: df.join(b, "b"))

    def check(batches):
        hasher, last = spaced_words(), (None, None)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for i, (wa, wb) in enumerate(zip(hasher.column(batch.column("text_a")), hasher.column(batch.column("text_b")), strict=True)):
                if last[0] != a[i]:
                    last = (a[i], shingle_set(wa))
                x, y = last[1], shingle_set(wb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(set_key(x) == a[i] and set_key(y) == b[i] and 100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])
        trim()

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")


def _class_links(docs: DataFrame, classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(node, root) over the classes that have links."""
    places = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("sig", i * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    members = classes.select("k", places.alias("bucket"))
    # each bucket's least member (a) meets all others
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("k").alias("a")).where("n > 1")
    members = scratch.keep(salted_join(members, scratch.keep(shared.select("bucket", "a")), "bucket", scratch))
    wanted = scratch.keep(members.select("k").distinct().join(classes.select("k", "one.doc_id", "one.text_key"), "k"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"), "text")
    texts = sized_join(rows, wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "inner")
    texts = scratch.keep(_own_texts(texts.select("k", "text")).dropDuplicates(["k"]))
    pairs = scratch.keep(members.withColumnRenamed("k", "b").where("a != b").select("a", "b").distinct())
    links = scratch.keep(_confirmed(scratch.keep(_likely(pairs, classes, percent / 100, scratch)), texts, percent, scratch))
    found = components(links, scratch)
    # what is left: buckets with members of several components
    named = members.where("k != a").join(found.withColumnRenamed("node", "k"), "k", "left").select("bucket", "k", F.coalesce("root", "k").alias("root"))
    named = scratch.keep(named)
    live = named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("bucket", "n")
    named = scratch.keep(salted_join(named, scratch.keep(live), "bucket", scratch))
    small, large = named.where(F.col("n") <= SMALL), named.where(F.col("n") > SMALL)
    other = small.select("bucket", F.col("k").alias("b"), F.col("root").alias("root_b"))
    pairs = scratch.keep(small.withColumnRenamed("k", "a").join(other, "bucket").where("a < b and root != root_b").select("a", "b").distinct())
    more = scratch.keep(_confirmed(scratch.keep(_likely(pairs, classes, percent / 100, scratch)), texts, percent, scratch))
    links = links.unionByName(more)
    if large.head(1):
        links = links.unionByName(_family_links(large, texts, percent, scratch))
    return components(links, scratch)


def similar_in_block(sets: list[np.ndarray], roots: list[bytes], percent: int) -> np.ndarray:
    """For each set the least row that is reachable by links between sets of different roots."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    elements, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), sizes)
    shared = np.bincount(column)[column] > 1
    names, column = np.unique(column[shared], return_inverse=True)
    bits = np.zeros((n, -(-max(len(names), 1) // 64) * 8), np.uint8)
    np.bitwise_or.at(bits, (row[shared], column >> 3), (1 << (column & 7)).astype(np.uint8))
    words = bits.view(np.uint64)
    number = np.unique(np.array(roots, dtype=object), return_inverse=True)[1]
    least = np.arange(n)
    near = np.zeros((n, n), bool)
    for i in range(n):
        both = np.bitwise_count(words & words[i]).sum(1, dtype=np.int64)
        near[i] = (100 * both >= percent * (sizes + sizes[i] - both)) & (number != number[i])
    while True:
        best = np.minimum(least, np.where(near, least[None, :], n).min(1, initial=n))
        if (best == least).all():
            return least
        least = best


def _family_links(members: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between classes of different components in large buckets(bucket, k, root).

    Buckets that share members make up a family. Its largest component needs no comparison within itself; the other
    members (outsiders) are compared with all, block by block: a group is a pair of blocks of at most BLOCK classes,
    whose full sets are intersected as bit rows. A block gives a row per class at most, no pairs.
    """
    hubs = members.groupBy("bucket").agg(F.min("k").alias("b"))
    family = components(salted_join(members, scratch.keep(hubs), "bucket", scratch).select(F.col("k").alias("a"), "b"), scratch)
    info = members.select("k", "root").distinct().join(family.select(F.col("node").alias("k"), F.xxhash64("root").alias("family")), "k")
    info = scratch.keep(info)
    sizes = info.groupBy("family", "root").agg(F.count("*").alias("c")).groupBy("family").agg(F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("m"))
    blocks = lambda c: F.ceil(c / BLOCK).cast("int")
    sizes = scratch.keep(sizes.select("family", F.col("m.root").alias("main"), blocks(F.col("m.c")).alias("mains"), blocks(F.col("all") - F.col("m.c")).alias("outs")).where("outs > 0"))
    rows = sized_join(info, sizes, "family", "inner").withColumn("inside", F.col("root") == F.col("main"))
    own = F.pmod(F.xxhash64("k"), F.when(F.col("inside"), F.col("mains")).otherwise(F.col("outs"))).cast("int")
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    meets = F.when(F.col("inside"), F.transform(upto("outs"), lambda i: cell(1, i, F.col("own")))).otherwise(
        F.concat(F.transform(upto("outs"), lambda j: cell(0, F.least("own", j), F.greatest("own", j))), F.transform(upto("mains"), lambda j: cell(1, F.col("own"), j)))
    )
    dealt = rows.withColumn("own", own).select("k", "root", "family", F.explode(meets).alias("m")).select("k", "root", "family", "m.kind", "m.i", "m.j").join(texts, "k")
    group = ["family", "kind", "i", "j"]

    def compare(batches):
        hasher = spaced_words()
        for rows in groups_of(batches, group):
            k, roots = rows.column("k").to_pylist(), rows.column("root").to_pylist()
            if len(set(roots)) > 1:
                sets = [shingle_set(w) for w in hasher.column(rows.column("text").combine_chunks())]
                least = similar_in_block(sets, roots, percent)
                at = np.flatnonzero(least != np.arange(len(k)))
                yield pa.RecordBatch.from_pydict({"a": pa.array([k[i] for i in at], pa.binary()), "b": pa.array([k[least[i]] for i in at], pa.binary())})

    parts = dealt.repartition(*group).sortWithinPartitions(*group).select(*group, "k", "root", "text")
    return scratch.keep(parts.mapInArrow(compare, "a binary, b binary"))


def _own_texts(rows: DataFrame) -> DataFrame:
    """Of rows(k, text), those whose text has the key k."""

    def own(batches):
        hasher = spaced_words()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            mask = pa.array([set_key(shingle_set(w)) == k for w, k in zip(hasher.column(batch.column(1)), keys, strict=True)], pa.bool_())
            yield batch.filter(mask)

    return rows.mapInArrow(own, "k binary, text string")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept, stays) per row of docs(doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(sketch_documents(docs))
    classes = scratch.keep(rows.where("k is not null").groupBy("k").agg(F.min("doc_id").alias("low"), F.max("n_shingles").alias("n"), F.max("sig").alias("sig"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one")))
    found = _class_links(docs, classes, percent, scratch)
    named = classes.select("k", "low", "one").join(found.withColumnRenamed("node", "k"), "k", "left").select("k", "low", "one", F.coalesce("root", "k").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"), F.min("one").alias("one"))
    named = named.select("k", "root").join(least, "root").select("k", "component_id", "one")
    out = rows.drop("sig").join(named, "k", "left")
    component = F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    stays = F.col("k").isNull() | (F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("text_key") == F.col("one.text_key")))
    out = out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), stays.alias("stays"))
    return scratch.final(out)


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text")).drop("text_key", "stays")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near-duplicates stays (see stays above), of repeated rows one."""
    scratch = Scratch(spark)
    atexit.register(scratch.quietly_drop)  # the result still reads its tables
    found = near_duplicates(docs)
    gone = scratch.keep(found.where("not stays").select("doc_id", "text_key").distinct())
    twice = scratch.keep(found.where("stays").groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"))
    own, other, key = fresh(docs, "own_key", "other_id", "other_key")
    keyed = docs.withColumn(own, F.xxhash64("text"))

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.toDF(other, key)
        return sized_join(rows, keys, rows["doc_id"].cast("long").eqNullSafe(keys[other]) & (rows[own] == keys[key]), how)

    left = among(keyed, gone, "left_anti")
    if twice.head(1):
        left = among(left, twice, "left_anti").unionByName(among(left, twice, "left_semi").dropDuplicates(["doc_id", own]))
    return left.select(docs.columns)
