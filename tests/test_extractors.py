"""The registry: order, hints, the user's own extractors, errors as rows."""

import pytest
from pyspark.sql import functions as F

from tidewell.operators.extractors import Extractor, Registry, unwrapped


@pytest.fixture
def registry(spark):
    return Registry(
        [Extractor("shops", F.col("url").contains("shop"), lambda p: [{"title": p["html"], "price": 1.5}]), Extractor("offers", F.col("url").contains("offer"), lambda p: {"rows": [{"title": "o"}], "warnings": ["thin"], "outcome": "ok"})],
        Extractor("rest", None, lambda p: None, "restOfAll"),
        "title string, price double",
    )


def rows(registry, spark, pages, hint=None):
    df = spark.createDataFrame(pages, "page_id long, url string, html string, hint string")
    return sorted(map(tuple, registry.extract(df, ["page_id"], ["url", "html"], hint).collect()), key=str)


def test_the_first_rule_that_holds_wins(spark, registry):
    pages = [(1, "/shop/offer", "a", None), (2, "/offer", "b", None), (3, "/x", "c", None), (4, None, None, None), (2, "/offer", "b", None)]
    offer = (2, "offers", "auto-match:offers", "offersParser", "ok", ["thin"], 0, "o", None)
    assert rows(registry, spark, pages) == [(1, "shops", "auto-match:shops", "shopsParser", None, [], 0, "a", 1.5), offer, offer]


def test_hints_come_before_rules(spark, registry):
    got = rows(registry, spark, [(1, "/shop", "a", "offers"), (2, "/shop", "a", "unknown"), (3, "/shop", "a", "rest")], "hint")
    assert [r[:4] for r in got] == [(1, "offers", "userData.sourceType=offers", "offersParser"), (2, "shops", "auto-match:shops", "shopsParser")]


def test_a_users_extractor_and_its_error(spark, registry):
    def own(page):
        if not page["html"]:
            raise ValueError("empty page")
        yield {"title": page["html"], "price": 2.0, "unknown": 1}
        yield {"price": "x"}
        yield "no dict"
        if page["html"] == "late":
            raise KeyError("late")

    more = registry.adding(Extractor("own", F.col("url").contains("shop"), own), before="shops")
    got = rows(more, spark, [(1, "/shop", "a", None), (2, "/shop", None, None), (3, "/shop", "late", None), (4, "/offer", "x", None)])
    by = {i: sorted((r for r in got if r[0] == i), key=lambda r: r[6] or 0) for i in (1, 2, 3, 4)}
    assert [(r[6], r[7], r[8]) for r in by[1]] == [(0, "a", 2.0), (1, None, None), (2, None, None)] and "price" in by[1][1][5][0] and "str" in by[1][2][5][0]
    assert [r[4:] for r in by[2]] == [("failed", ["ValueError: empty page"], None, None, None)]
    assert [r[4:6] for r in by[3]] == [("failed", ["KeyError: 'late'"])] and by[4][0][1] == "offers"  # a function fails as a whole


def test_what_functions_return():
    assert unwrapped(None) == ([], [], None) and unwrapped([]) == ([], [], None)
    assert unwrapped({"warnings": ["w"], "outcome": "empty"}) == ([], ["w"], "empty")
    assert unwrapped({"rows": {"rows": [{"a": 1}], "warnings": ["in"]}, "warnings": ["out"]}) == ([{"a": 1}], ["in", "out"], None)


def test_pages_with_warnings_only_and_empty_tables(spark):
    quiet = Registry([], Extractor("rest", None, lambda p: {"warnings": ["nothing here"]}), "title string")
    assert [r[5:] for r in rows(quiet, spark, [(1, "u", "h", None)])] == [(["nothing here"], None, None)]
    assert rows(quiet, spark, []) == []


def test_ids_are_unique(registry):
    with pytest.raises(ValueError):
        registry.adding(Extractor("shops", None, lambda p: None))
    assert [e.id for e in registry.adding(Extractor("new", None, lambda p: None), before="offers").extractors] == ["shops", "new", "offers"]
