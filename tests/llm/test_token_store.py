import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tokenizers import Tokenizer

from tidewell.llm import token_store as ts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = ts.ChunkEncoder(PATH)


def encoded(texts):
    ids, n = ENCODER.encode(pa.array(texts, pa.string()))
    return [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r ab'sé!1日-.\xa0\x1c", max_size=20), min_size=1, max_size=20))
def test_chunks_encode_like_the_library(texts):
    assert encoded(texts) == ENCODER.library(texts)


def test_special_strings_like_the_bare_library():
    texts = ["a <|endoftext|> b", "<|endoftext|> a <|endoftext|>", "x<|endoftext|>", "it's I'll ' s", ""]
    bare = Tokenizer.from_file(PATH)
    assert encoded(texts) == [np.array(bare.encode(t, add_special_tokens=False).ids, ENCODER.type).tobytes() for t in texts]
    assert bare.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_hash_is_perfect_and_minimal(n):
    keys = np.random.RandomState(n).permutation(10 * n + 1)[:n].astype(np.int64) - 7
    mph = ts.PerfectHash.build(keys)
    assert sorted(mph.slots(keys)) == list(range(n))


def test_store_round_trip(spark, docs, odd_rows, tmp_path):
    df = docs(odd_rows)
    store = ts.write_store(df, f"file://{tmp_path}/store", PATH, shards=3)
    got = sorted(ts.read_store(spark, store).collect(), key=lambda r: r.start)
    key = lambda r: (r[0] is not None, r[0] or 0)
    expected = [(i, np.array(ENCODER.lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")) for i, t in sorted(odd_rows, key=key)]
    assert [r.doc_id for r in got] == [i for i, _ in expected]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(x.tobytes())) for _, x in expected]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([len(x) for _, x in expected])[:-1]]).tolist()
    reopened = ts.TokenStore(f"file://{tmp_path}/store")
    assert len(reopened.get(9)) == 2 and reopened.get(12345) == []
    assert [x.tolist() for x in reopened.get(4)] == [expected[[i for i, _ in expected].index(4)][1].tolist()]


def test_empty_table(spark, docs, tmp_path):
    store = ts.write_store(docs([]), f"file://{tmp_path}/empty", PATH)
    assert ts.read_store(spark, store).count() == 0


@pytest.mark.parametrize("rows", [200, 20_000])
def test_lookups_read_a_few_entries(spark, tmp_path, rows):
    store = ts.write_store(spark.range(rows).selectExpr("id * 3 AS doc_id", "concat('text ', id) AS text"), f"file://{tmp_path}/store", PATH, shards=2)
    for key in (0, 3, 3 * (rows // 2), 3 * rows - 3):
        (ids,) = store.get(key)
        assert ids.tolist() == ENCODER.lib.encode(f"text {key // 3}", add_special_tokens=False).ids + [0]
    assert store.get(4) == [] and store.get(-1) == [] and store.get(3 * rows) == []
    assert store.bytes_read < 7 * 1000  # a shard's index has 40 bytes and more a row


def test_a_key_of_many_equal_rows_is_spread(spark, tmp_path):
    df = spark.range(3000).selectExpr("if(id < 2000, 7, id) AS doc_id", "if(id < 2000, 'same text', concat('t', id)) AS text").repartition(4)
    store = ts.write_store(df, f"file://{tmp_path}/store", PATH, shards=6)
    assert max(s["rows"] for s in store.shards) < 1500
    assert len(store.get(7)) == 2000 and len(store.get(2500)) == 1
    got = ts.read_store(spark, store)
    assert got.count() == 3000 and got.where("doc_id = 7").count() == 2000


def test_query_like_the_library(spark):
    sf = "/root/testdata/sf0.001"
    lib, start, expected = Tokenizer.from_file(PATH), 0, []
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r)[:4] for r in ts.op1_token_store(spark, sf).orderBy("doc_id").collect()] == expected
