"""Operator 13: periodic runs of words, by comparing a text's word ids with themselves at every lag.

A run is a stretch of consecutive words with smallest period q that is at least max(MIN_LENGTH, MIN_EXP * q) long and
that no neighbouring word extends. For each lag q up to n / MIN_EXP the array of word ids is compared with itself
shifted by q; a stretch of equal words of the needed length is a run of period q, and of runs with one start and end
the smallest period stays.

A lag q needs q equal words in a row (12 - q for the smallest), so most lags are ruled out by looking at every
so many places only: lags are taken in ranges [Q, 2Q), whose stretches hold Q words at least and so a whole gram of Q / 2
words that starts at a multiple of Q / 2 + 1. These few grams are compared with the grams at all lags of the range in
one array operation of about 2n comparisons (none, if no gram recurs at all: then the scan is over), and only lags with an equal gram are compared in full and run-length
encoded. Grams are compared by 64-bit hashes; a collision costs one more full comparison, never a wrong or lost run.
Where a gram recurs in a row of equal steps, the multiples of a step within that step's own stretch give the same
stretch again and are left out; so a text of one repeated word takes no quadratic time either.

The unit of work is a range of lags of a document. Texts of up to `split` bytes are one unit with all their ranges and
stay in their task; longer ones are dealt out with a row per range, and the ranges' runs meet again per document.

Defined results: a null text is empty; words are what lies between ASCII white space, any other character is part of
a word, and words are equal if their bytes are; a text without runs collapses to its words joined by single spaces;
equal rows are rows of their own with equal results, and null or repeated keys are just carried along; an empty table
gives an empty one; columns other than key and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import read, ship
from tidewell.llm.words import splitmix

MIN_LENGTH, MIN_EXP = 12, 2
FIRST = 16  # lags below are one range, screened by grams of four words
SPLIT = 4 << 20  # bytes of a text beyond which its lag ranges are rows of their own
WORDS = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_MIX, _SHIFT = np.uint64(0xD1342543DE82EF95), np.uint64(29)


def lag_ranges(n: int) -> list[tuple[int, int]]:
    """[from, to) of the lags 1 to n / MIN_EXP."""
    most, out, at = n // MIN_EXP, [], 1
    while at <= most:
        end = FIRST if at == 1 else 2 * at
        out.append((at, min(end, most + 1)))
        at = end
    return out


def stretches(ids: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all maximal stretches of period lag with `least` equal pairs or more."""
    same = np.zeros(len(ids) - lag + 2, np.int8)
    same[1:-1] = ids[lag:] == ids[:-lag]
    steps = np.diff(same)
    begins, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    long = ends - begins >= least
    return begins[long], ends[long] + lag


def _needed(lag: int) -> int:
    return max(MIN_LENGTH - lag, (MIN_EXP - 1) * lag)


def _explained(ids: np.ndarray, at: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
    """Which hits (sorted by place, then lag) lie in a stretch of a smaller period that divides their lag."""
    out = np.zeros(len(at), bool)
    step = np.diff(lag)
    row = at[1:] == at[:-1]
    thrice = row[1:] & row[:-1]  # a place with three hits or more
    if not thrice.any():
        return out
    equal = np.flatnonzero(thrice & (step[1:] == step[:-1]))
    for d in np.unique(step[equal]):
        starts, ends = stretches(ids, int(d), int(d))
        if not len(starts):
            continue
        k = np.searchsorted(starts, at, "right") - 1
        out |= (k >= 0) & (at + lag + size <= ends[np.maximum(k, 0)]) & (lag % d == 0) & (lag > d)
    return out


def lags_to_scan(ids: np.ndarray, ranges: list[tuple[int, int]]):
    """The lags of the ranges at which some gram recurs: all that can have a stretch of the needed length."""
    n, size, grams = len(ids), 1, splitmix(ids.astype(np.uint64))
    for first, end in ranges:
        want = 4 if first == 1 else first // 2
        step = 3 if first == 1 else first // 2 + 1
        while size < want:
            grams = (grams[:-size] * _MIX) ^ (grams[size:] >> _SHIFT) ^ grams[size:] if len(grams) > size else grams[:0]
            size *= 2
        in_order = np.sort(grams)
        if not (in_order[1:] == in_order[:-1]).any():  # nor do longer grams recur
            return
        places = np.arange(0, n - first - size + 1, step)
        if not len(places):
            continue
        padded = np.concatenate([grams, np.zeros(end - first + step, np.uint64)])
        shifted = np.lib.stride_tricks.as_strided(padded[first:], (len(places), end - first), (step * 8, 8), writeable=False)
        place, lag = np.nonzero(shifted == grams[places][:, None])
        if not len(place):
            continue
        place, lag = places[place], lag + first
        if len(place) > 8:
            keep = ~_explained(ids, place, lag, size)
            lag = lag[keep]
        yield from np.unique(lag).tolist()


def runs_of(ids: np.ndarray, ranges: list[tuple[int, int]] | None = None) -> np.ndarray:
    """Rows (start, length, period) by start, then period: runs of the lags in the given ranges, all by default.

    Of one stretch only the smallest period found is given.
    """
    found = []
    for lag in lags_to_scan(ids, lag_ranges(len(ids)) if ranges is None else ranges):
        starts, ends = stretches(ids, lag, _needed(lag))
        found.append(np.stack([starts, ends - starts, np.full(len(starts), lag)], 1))
    return smallest(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)


def smallest(runs: np.ndarray) -> np.ndarray:
    """Of rows with one start and length the one of smallest period; by start, then period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))].astype(np.int64)


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words: the place of each word's first use."""
    first: dict[bytes, int] = {}
    return np.fromiter(map(first.setdefault, words, range(len(words))), np.int64, len(words))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without what repeats: of each run only the first period stays."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def _run_lists(each: list[np.ndarray]) -> pa.Array:
    rows = np.concatenate([np.zeros((0, 3), np.int64), *each])
    offsets = np.cumsum([0, *(len(r) for r in each)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])).cast(_RUN)


def _texts(column: pa.Array):
    return (v.as_py() or b"" for v in column)


def _whole(batches):
    """(key, text) to (key, n_words, runs, collapsed)."""
    for batch in batches:
        sizes, runs, kept = [], [], []
        for text in _texts(batch.column(1)):
            words = text.split()
            found = runs_of(word_ids(words))
            sizes.append(len(words))
            runs.append(found)
            kept.append(collapsed(words, found))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), _run_lists(runs), pa.array(kept, pa.binary())], ["key", "n_words", "runs", "collapsed"])


def _ranged(batches):
    """(key, id, text, part) to (key, id, text, runs); the text goes on with the first range only."""
    for batch in batches:
        runs, on = [], []
        for text, part in zip(_texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
            words = text.split()
            ranges = lag_ranges(len(words))
            runs.append(runs_of(word_ids(words), ranges[part : part + 1]) if part < len(ranges) else np.zeros((0, 3), np.int64))
            on.append(text if part == 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(on, pa.binary()), _run_lists(runs)], ["key", "id", "text", "runs"])


def _joined(batches):
    """(key, text, runs of all ranges) to (key, n_words, runs, collapsed)."""
    for batch in batches:
        sizes, runs, kept = [], [], []
        for text, found in zip(_texts(batch.column(1)), batch.column(2), strict=True):
            words = text.split()
            rows = found.values.flatten()
            got = smallest(np.stack([c.to_numpy(zero_copy_only=False) for c in rows], 1)) if len(found.values) else np.zeros((0, 3), np.int64)
            sizes.append(len(words))
            runs.append(got)
            kept.append(collapsed(words, got))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), _run_lists(runs), pa.array(kept, pa.binary())], ["key", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", split: int = SPLIT) -> DataFrame:
    """(key, n_words, runs, collapsed) of each row of docs; runs are (start, length, period) by start, then period."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = f"key {kind}, n_words bigint, runs {RUNS}, collapsed binary"
    long = F.octet_length("text") > split
    short = rows.where(~long).mapInArrow(_whole, out)
    # equal long rows are one piece of work; a range is a row, and as many ranges as the bytes allow words
    once = rows.where(long).groupBy("key", "text").agg(F.count("*").alias("copies"))
    parts = F.ceil(F.log2(F.octet_length("text"))).cast("int")
    units = once.select("key", F.struct(F.sha2("text", 256).alias("hash"), "copies").alias("id"), "text", F.explode(F.sequence(F.lit(0), parts)).alias("part"))
    units = units.repartition(F.xxhash64("key", "id"), "part")
    found = units.mapInArrow(_ranged, f"key {kind}, id struct<hash:string,copies:bigint>, text binary, runs {RUNS}")
    whole = found.groupBy("key", "id").agg(F.max("text").alias("text"), F.flatten(F.collect_list("runs")).alias("runs"))
    copies = whole.select("key", "text", "runs", F.explode(F.sequence(F.lit(1), F.col("id.copies"))))
    return short.unionByName(copies.select("key", "text", "runs").mapInArrow(_joined, out)).withColumns({"collapsed": F.col("collapsed").cast("string")}).withColumnRenamed("key", key)


def with_repeats(key: Column, text: Column) -> Column:
    """Texts of every tenth document, by the crc32 of its key, go on periodically from some word on."""
    h = F.crc32(key.cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))

    def tiled(ws: Column) -> Column:
        n = F.size(ws)
        a = F.pmod(g, n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("int")
        tiles = F.flatten(F.array_repeat(F.slice(ws, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(ws, F.lit(1), a), F.slice(tiles, F.lit(1), n - a)), " ")).otherwise(text)

    # a variable of a lambda is computed once, where a repeated expression might be computed for each use
    return F.when(h % 10 == 0, F.element_at(F.transform(F.array(words), tiled), 1)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    best = F.when(F.size("runs") > 0, best)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = periodic_runs(docs).withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
