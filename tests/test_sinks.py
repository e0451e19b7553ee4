import csv
import glob
import json

from pyspark.sql import functions as F

from tidewell.sources import crawl, sinks
from tidewell.streaming.ingest import windowed_counts


def rows_of(path):
    out = []
    for f in sorted(glob.glob(f"{path}/*.csv")):
        with open(f, newline="") as file:
            out += list(csv.DictReader(file))
    return out


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', ["x"], None), (2, "line\nend", None, 1.5)], "i int, t string, xs array<string>, v double")
    sinks.write_csv(df, str(tmp_path / "t"))
    got = {r["i"]: r for r in rows_of(tmp_path / "t")}
    assert got["1"] == {"i": "1", "t": 'a "b", c', "xs": '["x"]', "v": ""} and got["2"]["t"] == "line\nend"


def test_export_goes_on_after_a_failure(spark, tmp_path):
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
    manifest = {r.name: r for r in sinks.export_tables(spark, {"good": spark.range(3), "bad": bad}, str(tmp_path)).collect()}
    assert manifest["good"].rows == 3 and manifest["good"].error is None and "broken" in manifest["bad"].error


def test_replaced_table_may_feed_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    sinks.replace_table(spark.read.parquet(path).where("id > 0"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]
    assert len(list(tmp_path.glob("t*"))) == 1
    assert sinks.last_batch(spark, path) == -1
    sinks.replace_table(spark.range(2), path, 7)
    assert sinks.last_batch(spark, path) == 7 and spark.read.parquet(path).count() == 2
    (tmp_path / "t").rename(tmp_path / "t.old")  # a swap that stopped halfway
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t.old").exists()


def test_file_ledger(spark):
    from tidewell.operators import records as N

    ledger = spark.createDataFrame([("r", "a", "1"), ("q", "a", "1")], "run_id string, file string, content_hash string")
    after = N.processed_files(ledger, spark.createDataFrame([("a", "2"), ("b", "3")], "file string, content_hash string"), F.lit("r"))
    assert sorted(tuple(r) for r in after.collect()) == [("q", "a", "1"), ("r", "a", "2"), ("r", "b", "3")]
    assert N.find(after, file=None).count() == 0 and N.find_text(after, file="A").count() == 2
    assert N.latest(after, ["file"], [F.col("content_hash").desc()]).count() == 2


def test_run_summary(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"timestamp": "t", "qualityBySource": {"adcb": {"pages": 4, "offersEmitted": 2, "skippedShell": 1}, "fab": {"pages": 0}}}))
    got = {r.source_type: (r.pages, r.yield_rate, r.skip_rate) for r in crawl.crawl_rates(crawl.run_summary(spark, str(path))).collect()}
    assert got == {"adcb": (4, 0.5, 0.25), "fab": (0, 0.0, 0.0)}
    assert crawl.run_summary(spark, str(tmp_path / "none")).count() == 0


def test_windows_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).select("ts", "event_type", "value")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    query = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    key = lambda df: sorted((str(r.start), r.event_type or "", r.n) for r in df.collect())
    assert key(spark.table("windows")) == key(windowed_counts(events))


def test_databases_live_and_from_a_file(spark, tmp_path):
    """Live tables first, the file for databases that the catalog lacks; an error is a row; nothing is exported twice."""
    import json

    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    try:
        spark.range(3).write.mode("overwrite").parquet(str(tmp_path / "data"))
        spark.sql(f"CREATE TABLE IF NOT EXISTS shop.items USING parquet LOCATION '{tmp_path / 'data'}'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS shop.`gone` (x int) USING parquet LOCATION '{tmp_path / 'bad'}'")
        (tmp_path / "bad").mkdir(exist_ok=True)
        (tmp_path / "bad/x.parquet").write_text("no parquet")
        (tmp_path / "all.json").write_text(json.dumps({"shop": {"items": [{"id": 9}]}, "wallet": {"cards": [{"id": "c1", "tags": ["a", "b"]}, {"id": "c2"}], "a.b c": [{"n": 1}]}, "other": {"t": [{}]}}))
        got = sinks.export_databases(spark, ["shop", "wallet", "none"], str(tmp_path / "out"), str(tmp_path / "all.json")).collect()
        assert [(r.database, r.table, r.rows, r.source, bool(r.error), r.file) for r in got] == [
            ("shop", "gone", 0, "live", True, "shop/gone.csv"),
            ("shop", "items", 3, "live", False, "shop/items.csv"),
            ("wallet", "a.b c", 1, "json", False, "wallet/a_b c.csv"),
            ("wallet", "cards", 2, "json", False, "wallet/cards.csv"),
        ]
        cards = spark.read.csv(str(tmp_path / "out/wallet/cards.csv"), header=True, quote='"', escape='"').orderBy("id").collect()
        assert [(r.id, r.tags) for r in cards] == [("c1", '["a","b"]'), ("c2", None)]
        assert spark.read.csv(str(tmp_path / "out/_manifest.csv"), header=True).count() == 4
        assert sinks.export_databases(spark, ["none"], str(tmp_path / "more"), str(tmp_path / "missing.json")).count() == 0
    finally:
        spark.sql("DROP DATABASE shop CASCADE")
