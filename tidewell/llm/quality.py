"""Operator 9: document quality by compression against two dictionaries.

A zstandard dictionary is built from texts labelled good and one from texts labelled bad. A text is cut in blocks
of BLOCK bytes (the whole text; blocks make long and short texts comparable) and each block is compressed with
both. The normalised difference (bad - good) / (bad + good) of the summed sizes, with the sizes per byte and the
length, goes through a logistic calibration fitted on labelled texts that the dictionaries have not seen.

Fitting uses a bounded sample: at most SAMPLE_ROWS labelled texts of each class, those of least key hash among
texts of at most SAMPLE_TEXT bytes. Of two thirds of them, cut in blocks, at most DICTIONARY_BLOCKS blocks in random
order train a class's dictionary; where these are too few or too alike for zstandard's training, the blocks
themselves, up to DICTIONARY_BYTES, are the dictionary's content. The other third fits the calibration. Scoring covers
every row and whole texts, in place, without a shuffle.

Defined results: a null text scores as an empty one, an empty text gets the calibration's value for an empty
block; repeated rows score alike; if one class has no labelled text, every score is the smoothed share of good
labels, (good + 1) / (good + bad + 2); labels of 0/1 other than those or null are ignored, as are labels without a
document; other columns stay, but one named like the output column is replaced (out gives the score another name).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import fresh, read, ship, trim, widened

BLOCK = 2048
LEVEL = 3
DICTIONARY_BYTES = 112_640
SAMPLE_ROWS = 3000
SAMPLE_TEXT = 64 << 10
DICTIONARY_BLOCKS = 6000
THRESHOLD = 0.7


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)] or [b""]


def dictionary(texts: list[bytes], order: np.random.RandomState) -> bytes:
    import zstandard

    parts = [b for t in texts for b in blocks(t) if b]
    order.shuffle(parts)
    parts = parts[:DICTIONARY_BLOCKS]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:  # too few or too alike: raw content serves
        return b"".join(parts)[:DICTIONARY_BYTES]


@dataclass
class QualityModel:
    good: bytes = b""
    bad: bytes = b""
    weights: np.ndarray | None = None
    prior: float = 0.5

    def __post_init__(self):
        self._pair = None

    def __getstate__(self):
        return self.__dict__ | {"_pair": None}

    def _sizes(self, text: bytes) -> tuple[int, int]:
        if self._pair is None:
            import zstandard

            pair = []
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                pair.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
            self._pair = pair
        good, bad = self._pair
        parts = blocks(text)
        return sum(len(good.compress(p)) for p in parts), sum(len(bad.compress(p)) for p in parts)

    def features(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.array([self._sizes(t) for t in texts], float).reshape(-1, 2)
        good, bad = sizes.T
        n = np.maximum([len(t) for t in texts], 1).astype(float)
        d, g, b, length = 10 * (bad - good) / np.maximum(bad + good, 1), np.minimum(good / n, 3), np.minimum(bad / n, 3), np.log1p(n) / 10
        return np.stack([np.ones_like(n), d, g, b, length, d * length, g * g, d * d, np.minimum(g, 0.3)], 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -40, 40)))


def fit(rows: list[tuple[bytes, int]]) -> QualityModel:
    """From (text, label) in a fixed order. Two of three texts make the dictionaries, the third the calibration."""
    labels = [y for _, y in rows]
    model = QualityModel(prior=(sum(labels) + 1) / (len(labels) + 2))
    sets = {(y, k): [t for i, (t, label) in enumerate([r for r in rows if r[1] == y]) if (i % 3 == 2) == k] for y in (0, 1) for k in (False, True)}
    if not all(sets.values()) or not any(map(len, sets[1, False])) or not any(map(len, sets[0, False])):
        return model
    order = np.random.RandomState(7)
    model.good, model.bad = dictionary(sets[1, False], order), dictionary(sets[0, False], order)
    x = model.features([*sets[1, True], *sets[0, True]])
    y = np.repeat([1.0, 0.0], [len(sets[1, True]), len(sets[0, True])])
    w = np.zeros(x.shape[1])
    for _ in range(60):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    model.weights = w
    return model


def held_out(key: str = "doc_id"):
    """Rows kept from fitting."""
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on labelled rows of docs(doc_id, text) that are not held out."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    rows = []
    for label in (0, 1):
        # twice the rows, as some have no document or a longer text; the bound makes the broadcast safe
        keys = known.where(F.col("label") == label).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE_ROWS)
        texts = docs.select("doc_id", "text").where(F.octet_length("text") <= SAMPLE_TEXT).join(F.broadcast(keys), "doc_id", "left_semi")
        found = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(SAMPLE_ROWS).collect()
        rows += [(r.text.encode("utf-8", "surrogatepass"), label) for r in found]
    return fit(rows)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score (0 to 1) for each row's whole text."""
    ship(docs.sparkSession)
    docs = docs.drop(out)
    at = docs.columns.index(text)

    def score(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [b or b"" for b in part.column(at).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(texts), pa.float64())], names=[*part.schema.names, out])
        trim()

    return docs.mapInArrow(score, widened(docs, **{out: "double"}))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    scored = score_quality(docs, fit_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored below the threshold are removed."""
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "score")
    return score_quality(docs, model, out=score).where(F.col(score) >= THRESHOLD).select(docs.columns)
