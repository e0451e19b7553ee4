"""Every query that has SQL against DuckDB on the small tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewell.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float) or hasattr(v, "quantize"):
        return None if math.isnan(v) else round(float(v), 9)
    return v


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in SQL:
        assert got
        return
    found = con.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert list(map(repr, got)) == list(map(repr, expected))


def test_layers_of_every_order(spark):
    left = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey").join(QUERIES["pay_layers_all"](spark, SF), F.col("o_orderkey") == F.col("request_id"), "left_anti")
    assert left.count() == 0


def test_filters_reach_the_scan(spark):
    plan = QUERIES["list_filter_page"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" in plan and "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice" in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
