"""Operator 8: benchmark passages in documents, found by winnowing.

Of each SPAN consecutive words, the fingerprint is the least hash among its K-word grams (the rightmost of equals).
A benchmark item and a document that share SPAN words in a row therefore share a fingerprint within them. Document
fingerprints are joined with those of the items; each hit is extended to the SPAN-word windows around it, and a
window counts if an item has a window of the same 64-bit hash of its words (two windows of different words have one
hash with probability 2**-64). Items of fewer words are one window each, looked up by its length.

The benchmark's index is written once to the shared folder in blocks of bounded size, built by tasks; no side is
collected or broadcast. Documents stay where they are: a task loads block after block for each portion of its
documents, so memory is bounded by one block and one portion, and there is no shuffle of documents.

Defined results: null or wordless texts have no words and no hits; an item without words never occurs; a null item
id is named "null", an empty one is a name like others; rows that repeat, in either table, count for themselves among
documents and once among items; an empty table on either side gives no hits; other columns of the documents stay, but
those named like an output column are replaced (out gives the output columns other names).
"""

from __future__ import annotations

import io
import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import fresh, read, shared_files, ship, trim, widened
from tidewell.llm.token_store import _fs, _put
from tidewell.llm.words import WordHasher, grams

SPAN, K = 10, 5
OUT = ("n_words", "n_hit", "items")
BLOCK_BYTES = 16 << 20  # of item text in a block of the index
PORTION_WORDS = 1 << 20  # of documents that meet the blocks together


def leak_words() -> WordHasher:
    b = np.arange(256)
    return WordHasher((b < 0x30) | ((b >= 0x3A) & (b <= 0x40)) | ((b >= 0x5B) & (b <= 0x60)) | ((b >= 0x7B) & (b <= 0x7F)))


def winnowed(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a text and their places."""
    g, window = grams(words, K), SPAN - K + 1
    if len(g) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    back = np.lib.stride_tricks.sliding_window_view(g, window)[:, ::-1].argmin(1)
    at = np.arange(window - 1, len(g)) - back
    at = at[np.diff(at, prepend=-1) > 0]
    return g[at], at


class Block:
    """An index of some items: fingerprints, and (length, window hash) -> items."""

    def __init__(self, names: list[str], texts: list[np.ndarray]):
        prints, windows = [], {}
        for i, words in enumerate(texts):
            prints.append(winnowed(words)[0])
            if len(words):
                n = min(SPAN, len(words))
                windows.setdefault(n, []).append((grams(words, n), i))
        self.names, self.prints = np.array(names, dtype=object), np.unique(np.concatenate([np.zeros(0, np.uint64), *prints]))
        self.windows = {}
        for n, found in windows.items():
            hashes, items = np.concatenate([h for h, _ in found]), np.concatenate([np.full(len(h), i) for h, i in found])
            order = np.lexsort((items, hashes))
            self.windows[n] = hashes[order], items[order]

    def dump(self) -> bytes:
        names = np.frombuffer(json.dumps(list(self.names)).encode(), np.uint8)
        out = {"names": names, "prints": self.prints, "lengths": np.array(sorted(self.windows))}
        for n, (h, i) in self.windows.items():
            out |= {f"h{n}": h, f"i{n}": i.astype(np.int32)}
        file = io.BytesIO()
        np.savez(file, **out)
        return file.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Block:
        x, own = np.load(io.BytesIO(data)), cls([], [])
        own.names, own.prints = np.array(json.loads(x["names"].tobytes()), dtype=object), x["prints"]
        own.windows = {int(n): (x[f"h{n}"], x[f"i{n}"]) for n in x["lengths"]}
        return own

    def _items(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are windows of n words of an item, and all such items."""
        table, items = self.windows[n]
        low, high = np.searchsorted(table, hashes, "left"), np.searchsorted(table, hashes, "right")
        hit = high > low
        pairs = np.unique(np.stack([low[hit], high[hit]]), axis=1)
        found = [items[a:b] for a, b in pairs.T]
        return hit, np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def search(self, words: np.ndarray, prints: np.ndarray, at: np.ndarray, hit: np.ndarray) -> set[str]:
        """Mark the hit words of a document; return the names of the items with occurring windows."""
        names: set[str] = set()
        if SPAN in self.windows and len(prints):
            place = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1) if len(self.prints) else None
            shared = at[self.prints[place] == prints] if place is not None else at[:0]
            if len(shared):
                starts = np.unique((shared[:, None] - np.arange(SPAN - K + 1)).ravel())
                starts = starts[(starts >= 0) & (starts <= len(words) - SPAN)]
                names |= self._mark(words, SPAN, starts, hit)
        for n in self.windows:
            if n < SPAN and len(words) >= n:
                names |= self._mark(words, n, np.arange(len(words) - n + 1), hit)
        return names

    def _mark(self, words: np.ndarray, n: int, starts: np.ndarray, hit: np.ndarray) -> set[str]:
        low, high = int(starts[0]), int(starts[-1]) + n
        ok, items = self._items(n, grams(words[low:high], n)[starts - low])
        hit[(starts[ok][:, None] + np.arange(n)).ravel()] = True
        return set(self.names[items])


def write_blocks(benchmark: DataFrame, uri: str) -> list[int]:
    """The index of benchmark(item_id, text) in files at uri; returns the numbers of those that hold items."""
    spark = benchmark.sparkSession
    ship(spark)
    benchmark = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    blocks = 1 + (benchmark.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // BLOCK_BYTES
    fs, path = _fs(uri)
    fs.create_dir(path, recursive=True)

    def build(batches):
        hasher, names, texts = leak_words(), [], []
        out, where = _fs(uri)
        for batch in batches:
            names += batch.column(0).to_pylist()
            texts += list(hasher.column(batch.column(1)))
        number = TaskContext.get().partitionId()
        if names:
            _put(out, f"{where}/block-{number:05d}.npz", [Block(names, texts).dump()])
            yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64())})

    return sorted(r.block for r in benchmark.repartition(blocks).mapInArrow(build, "block long").collect())


_BLOCKS: dict[tuple[str, int], Block] = {}


def _block(uri: str, number: int) -> Block:
    """The worker keeps the last block."""
    if (uri, number) not in _BLOCKS:
        fs, path = _fs(uri)
        with fs.open_input_file(f"{path}/block-{number:05d}.npz") as f:
            data = f.read()
        _BLOCKS.clear()
        _BLOCKS[uri, number] = Block.load(data)
    return _BLOCKS[uri, number]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: Sequence[str] = OUT) -> DataFrame:
    """docs with n_words, n_hit (words inside occurring windows) and items (their item ids, sorted as strings)."""
    uri = shared_files(docs.sparkSession, "leaks")
    blocks = write_blocks(benchmark, uri)
    docs = docs.drop(*out)
    at = docs.columns.index(text)
    schema = widened(docs, **dict(zip(out, ("long", "long", "array<string>"), strict=True)))

    def scan(batches):
        hasher = leak_words()
        for batch in batches:
            texts = batch.column(at)
            words = hasher.column(texts)
            row = 0
            while row < batch.num_rows:
                portion, size = [], 0
                for w in words:
                    portion.append((w, *winnowed(w), np.zeros(len(w), bool), set()))
                    size += len(w)
                    if size >= PORTION_WORDS:
                        break
                for number in blocks:
                    block = _block(uri, number)
                    for w, prints, places, hit, names in portion:
                        names |= block.search(w, prints, places, hit)
                part = batch.slice(row, len(portion))
                more = [pa.array([len(x[0]) for x in portion], pa.int64()), pa.array([int(x[3].sum()) for x in portion], pa.int64()), pa.array([sorted(x[4]) for x in portion], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, *out])
                row += len(portion)
        trim()

    return docs.mapInArrow(scan, schema)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark window are removed."""
    out = fresh(docs, *OUT)
    return find_leaks(docs, read(spark, sf_dir, "benchmark"), out=out).where(F.col(out[1]) == 0).select(docs.columns)
