import pytest
from pyspark.sql import functions as F

from tidewell.operators import registry as G
from tidewell.plans import listing as L

OFFERS = "canonical_key string, source_type string, merchant_name string, bank_name string, card_name string, offer_title string, offer_description string, coupon_code string, categories array<string>, discount_type string, discount_value string, min_spend double, cap_value double, confidence double, valid_to string, freshness string, last_seen_at string, normalized_url string"


@pytest.fixture(scope="module")
def offers(spark):
    row = lambda k, **x: tuple(({"canonical_key": k, "source_type": "adcb", "merchant_name": "Lulu", "bank_name": "ADCB", "card_name": None, "offer_title": f"Offer {k}", "offer_description": None, "coupon_code": None, "categories": ["dining"], "discount_type": "percent", "discount_value": "10", "min_spend": None, "cap_value": None, "confidence": 0.5, "valid_to": None, "freshness": "fresh", "last_seen_at": k, "normalized_url": "https://www.adcb.com/x"} | x).values())
    return spark.createDataFrame([row("a"), row("b", confidence=0.9, valid_to="2020-01-01"), row("c", merchant_name="Ikea", coupon_code="SAVE20", discount_value="0.2", last_seen_at=None, source_type="groupon", normalized_url="https://shop.new.com/x"), row("d", freshness="stale", categories=["travel"])], OFFERS)


@pytest.mark.parametrize(
    "query, keys",
    [
        ({}, ["c", "d", "b", "a"]),
        ({"order": "asc"}, ["a", "b", "d", "c"]),
        ({"merchant": "LUL", "limit": 2, "page": 2}, ["a"]),
        ({"valid_now": "true", "as_of": "2026-01-01", "freshness": "fresh"}, ["c", "a"]),
        ({"valid_now": "false"}, ["c", "d", "b", "a"]),
        ({"coupon": "save20"}, ["c"]),
        ({"category": "TRAV"}, ["d"]),
        ({"confidence_min": 0.6}, ["b"]),
        ({"q": "ikea"}, ["c"]),
        ({"sort": "confidence", "confidence_max": "0.5"}, ["a", "c", "d"]),
    ],
)
def test_offer_lists(offers, query, keys):
    rows, total = L.OfferQuery(**query).run(offers, "canonical_key")
    assert [r.canonical_key for r in rows.collect()] == keys
    assert total.first().total >= len(keys)


@pytest.mark.parametrize("bad", [{"limit": 101}, {"page": 0}, {"sort": "x"}, {"order": "up"}, {"confidence_min": 2}, {"valid_now": "maybe"}, {"valid_now": True}])
def test_bad_queries(bad):
    with pytest.raises(ValueError):
        L.OfferQuery(**bad)


def test_other_lists(spark):
    q = spark.createDataFrame([(1, "u", "low_confidence", "pending", 0.1, "{}"), (2, "v", "quality_gate", "pending", None, '{"x": "Lulu"}')], "row_id long, source_url string, quarantine_type string, review_status string, confidence double, payload string")
    assert [r.row_id for r in L.QuarantineQuery(q="lulu").run(q, "row_id")[0].collect()] == [2]
    s = spark.createDataFrame([("A", "adcb.com", 1, "approved", 0.5), ("B", "b.com", None, "approved", 0.5)], "source_name string, domain string, priority int, status string, confidence double")
    assert [r.source_name for r in L.SourceQuery().run(s, "source_name")[0].collect()] == ["A", "B"]
    assert [r.source_name for r in L.SourceQuery(domain="WWW.b.com").run(s, "source_name")[0].collect()] == ["B"]
    with pytest.raises(ValueError):
        L.SourceQuery(status="x")


def test_payment_offers(offers):
    cards, coupons = L.offers_for_payment(offers, "lulu", "dining", "2026-01-01")
    assert [r.canonical_key for r in cards.collect()] == ["a"] and [r.canonical_key for r in coupons.collect()] == ["c"]
    c = L.coupons_of(coupons).first()
    assert (c.code, c.kind, c.value, c.verify) == ("SAVE20", "percent", 20.0, True)


def test_registry_changes(spark, offers):
    schema = "source_name string, domain string, source_type string, base_url string, category string, status string, priority int, confidence double, locked boolean"
    sources = spark.createDataFrame([("ADCB", "adcb.com", "adcb", "https://adcb.com", "bank", "approved", 5, 0.8, True), ("Groupon", "groupon.ae", "groupon", "https://groupon.ae", "coupon", "rejected", 1, 0.2, False)], schema)
    new = spark.createDataFrame([("ADCB bank", "www.adcb.com", "adcb", "https://adcb.com/x", "bank", "rejected", 9, 0.1, False)], schema)
    up = {r.source_type: r for r in G.upsert_sources(sources, new).collect()}
    assert (up["adcb"].source_name, up["adcb"].status, up["adcb"].priority) == ("ADCB bank", "approved", 5)
    assert {r.source_type: r.status for r in G.sync_registry(sources, new.withColumn("domain", F.lit("adcb.com"))).collect()} == {"adcb": "rejected", "groupon": "rejected"}
    health = spark.createDataFrame([("adcb", 0.1, "rejected"), ("groupon", 0.9, "approved")], "source_type string, score double, status string")
    assert {r.source_type: (r.status, r.confidence) for r in G.update_health(sources, health).collect()} == {"adcb": ("approved", 0.1), "groupon": ("approved", 0.9)}
    manual = spark.createDataFrame([("adcb.com", "adcb", "probation")], "domain string, source_type string, new_status string")
    assert {r.source_type: r.status for r in G.set_status(sources, manual).collect()} == {"adcb": "probation", "groupon": "rejected"}
    assert {r.canonical_key: r.source_name for r in G.link_offers(offers, sources).collect()} == {"a": "ADCB", "b": "ADCB", "c": "Groupon", "d": "ADCB"}
    urls = spark.createDataFrame([("https://shop.adcb.com/x",), ("https://new.example.com/y",), ("bad",)], "url string")
    assert sorted(r.domain for r in G.missing_sources(urls, sources).collect()) == ["bad", "new.example.com"]
    assert G.purge(offers, ["offer a"]).count() == 3
    assert sources.where(G.valid_source()).count() == 2
    q = spark.createDataFrame([("groupon", "rejected_source"), ("groupon", "x"), (None, None)], "source_type string, quarantine_type string")
    assert G.release(q, ["groupon"]).count() == 2
    assert {r.status: r.quarantined for r in G.dashboard(sources, q).collect()} == {"approved": 0, "rejected": 2}
    need = spark.createDataFrame([("adcb", 2, 1), ("hsbc", 1, 0)], "source_type string, least int, least_strong int")
    assert {r.source_type: r.covered for r in G.coverage(offers, need, F.col("confidence") > 0.8).collect()} == {"adcb": True, "hsbc": False}
    fails = spark.createDataFrame([("A", i, "r") for i in range(9)], "source_name string, occurred_at int, reason string")
    assert G.recent_failures(fails).count() == 5
