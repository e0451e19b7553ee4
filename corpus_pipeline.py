"""A corpus pipeline of five stages; each works on all that the one before it kept.

Part of the corpus operators (tidewell.llm): quality classifier, near-duplicates, decontamination, personal data,
SentencePiece ids. run() writes each stage's result to the shared folder and reads it again as the next one's
documents; the last stage's folder goes when the driver ends. SQL cannot express the classifier or the encoder, so
there is none; tests compare with brute force.

Defined results: a null or empty text is judged like any other by the classifier, has no near-duplicates and no
personal data, and is encoded as the end id alone; rows of one id and text are one document; rows without an id take
part; an empty table passes through all stages; columns of any name, those of the stages' own results included, leave
the first four stages as they went in, but that personal data is replaced in text and n_chars follows it. The last
stage returns doc_id, the ids and their digests, and no other column.
"""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import Scratch, spread
from tidewell.llm.decontaminate import leak_stage
from tidewell.llm.near_dups import near_dup_stage
from tidewell.llm.pii import pii_stage
from tidewell.llm.piece_codec import encoded_stage
from tidewell.llm.quality import quality_stage

STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", leak_stage),
    ("personal_data", pii_stage),
    ("piece_ids", encoded_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), None
    for _, stage in STAGES:
        own = Scratch(spark)
        docs = own.keep(stage(spark, docs, sf_dir))
        if before is not None:
            before.drop()
        before = own
    atexit.register(before.quietly_drop)
    return docs
