"""Keyed freshness: stream and table give the same stretches; the ledger and the bucket table on their own."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.sources.buckets import BucketTable
from tidewell.streaming import freshness as S
from tidewell.streaming import ledger

DAYS = "CASE WHEN event_type = 'click' THEN 1 ELSE 2 END"


def sightings(seed, n):
    r = random.Random(seed)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * r.randrange(0, 4 * 24 * 20))
    return sorted(((r.choice([1, 2, 3, None]), r.choice(["click", "view"]), at()) for _ in range(n)), key=lambda x: x[2])


def brute(rows):
    out, by = [], {}
    for u, e, t in rows:
        if t is not None:
            by.setdefault((u, e), []).append(t)
    for (u, e), ts in by.items():
        days, own = dt.timedelta(days=1 if e == "click" else 2), None
        for t in sorted(ts):
            if own and t <= own[1] + days:
                own = [own[0], t, own[2] + 1]
                continue
            if own:
                out.append((u, e, *own, own[1] + days))
            own = [t, t, 1]
        out.append((u, e, *own, own[1] + days))
    return sorted(out, key=str)


def test_stretches_of_a_table(spark):
    rows = [*sightings(1, 90), (1, "click", None), (9, "view", dt.datetime(2024, 1, 1)), (9, "view", dt.datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, "user_id long, event_type string, ts timestamp")
    got = sorted((tuple(x) for x in S.episodes(df, ["user_id", "event_type"], "ts", F.expr(DAYS)).collect()), key=str)
    assert got == brute(rows) and S.episodes(df.where("false"), ["user_id"], "ts", F.expr(DAYS)).count() == 0


def test_stream_gives_what_a_table_gives(spark, tmp_path):
    rows = sightings(2, 160)
    for i in range(4):
        spark.createDataFrame(rows[40 * i : 40 * i + 40], "user_id long, event_type string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user_id long, event_type string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    try:
        out = S.stream_episodes(stream, ["user_id", "event_type"], "ts", F.expr(DAYS))
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted((tuple(x) for x in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    mark = rows[-1][2] - dt.timedelta(hours=1)
    want = [r for r in brute(rows) if r[5] < mark]
    assert got == want and len(got) > 10, (len(got), len(want), [x for x in got if x not in want][:3], [x for x in want if x not in got][:3], mark)


def test_joined_stretches_in_any_order():
    r = np.random.default_rng(0)
    at = r.integers(0, 5000, 200)
    rows = np.stack([at, at, np.ones(200, int), at + 20], 1)
    whole = S.joined(rows)
    parts = np.zeros((0, 4), np.int64)
    for chunk in np.array_split(r.permutation(rows), 9):
        parts = S.joined(np.concatenate([parts, chunk]))
    assert parts.tolist() == whole.tolist() and whole[:, 2].sum() == 200 and (whole[1:, 0] > whole[:-1, 3]).all()


def test_contents_of_a_table_come_once(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("b", t, "h1", bytearray(b"x")), ("a", t, "h1", bytearray(b"x")), ("c", t, "h2", bytearray(b"[1"))]
    got = ledger.once_by_content(spark.createDataFrame(rows, "file string, modified timestamp, content_hash string, content binary"))
    assert sorted((r.file, r.content_hash) for r in got.collect()) == [("a", "h1"), ("c", "h2")]


@pytest.fixture
def table(spark, tmp_path):
    return BucketTable(spark, str(tmp_path / "t"), "k string, g string, v int", F.col("g"), F.col("k"), groups=4, parts=2)


def test_buckets(spark, table):
    make = lambda rows: spark.createDataFrame(rows, "k string, g string, v int")
    assert table.read().count() == 0 and table.done() == [] and table.vacuum() == 0
    rows = [(f"k{i}", f"g{i % 7}", 0) for i in range(50)] + [(None, None, 0)]
    assert table.write(make(rows), 0) and table.read().count() == 51
    touched = table.read([0, 1]).withColumn("v", F.lit(1))
    n = touched.count()
    assert 0 < n < 51 and table.write(touched, 1) and not table.write(make(rows), 1)
    assert table.read().count() == 51 and table.read().where("v = 1").count() == n and table.read(upto=0).where("v = 1").count() == 0
    assert table.write(make([]), 2) and table.read().count() == 51
    assert table.write(table.read().withColumn("v", F.lit(3)), 3) and table.vacuum(1) > 0 and table.read().where("v = 3").count() == 51
