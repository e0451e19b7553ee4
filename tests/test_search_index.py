"""Search by an index gives what a search of the whole table gives, from fewer files."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import search_index as X
from tidewell.operators.relational import contains_any

SCHEMA = "id long, shop string, title string"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    r = random.Random(3)
    words = ["Dinner", "spa", "Ünïcode", "off", "hotel", "x", "20%"]
    rows = [(i, f"shop{i % 40}", " ".join(r.choice(words) for _ in range(r.randrange(4))) or None) for i in range(400)] + [(900, "shop7", "a RARE-word here"), (901, None, "rare"), (901, None, "rare")]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("index"))
    X.build(df, ["title", "shop"], F.col("shop"), path, parts=16)
    return df, path


@pytest.mark.parametrize("term", ["rare-word", "RARE", "dinner", "ÜNÏ", "x", "", "20% off", "nowhere", "shop1", "r s", "_", "%"])
def test_same_rows(spark, built, term):
    df, path = built
    got = X.search(spark, path, SCHEMA, ["title", "shop"], term)
    want = df.where(contains_any(["title", "shop"], term))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_most_files_are_not_read(spark, built):
    _, path = built
    assert len(X.parts_with(spark, path, "rare-word")) == 1 and X.parts_with(spark, path, "nowhere") == [] and X.parts_with(spark, path, "x") is None
    plan = X.search(spark, path, SCHEMA, ["title"], "rare-word")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.partition("PartitionFilters: [")[2].partition("]")[0]


def test_empty_table(spark, tmp_path):
    X.build(spark.createDataFrame([], SCHEMA), ["title"], F.col("shop"), str(tmp_path))
    assert X.search(spark, str(tmp_path), SCHEMA, ["title"], "any").count() == 0
