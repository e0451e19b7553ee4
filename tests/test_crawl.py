import pytest
from pyspark.sql import functions as F

from tidewell.operators import crawl_quality as CQ
from tidewell.operators import discovery as D
from tidewell.operators import payment as P
from tidewell.operators import quality as Q
from tidewell.operators import wallet as W


@pytest.mark.parametrize(
    "url, source, expected",
    [
        ("https://www.adcb.com/careers/x", "adcb", (False, "blocked:generic-noise")),
        ("https://a.com/offers/x.png", "adcb", (False, "blocked:asset")),
        ("https://www.emiratesnbd.com/en/deals/x", "emiratesNbd", (True, "enbd:offer-path")),
        ("https://www.emiratesnbd.com/en/rates", "emiratesNbd", (False, "enbd:non-offer-path")),
        ("https://www.bankfab.com/rewards/1", None, (True, "fab:offer-path")),
        ("https://www.groupon.ae/stores/1", "groupon", (True, "coupon:offer-path")),
        ("https://www.dib.ae/about", "dib", (False, "bank:non-offer-path")),
        ("https://shop.com/cashback", "generic", (True, "generic:offer-keyword")),
        ("https://shop.com/about", "generic", (False, "generic:no-keyword")),
    ],
)
def test_follow(spark, url, source, expected):
    df = spark.createDataFrame([(url, source)], "u string, s string")
    assert tuple(df.select(D.follow(F.col("u"), F.col("s")).alias("f")).first().f) == expected


@pytest.mark.parametrize("url, source, depth, expected", [("https://a.com/campaigns/offer", "generic", 0, (False, "campaign_or_tracking")), ("https://a.com/", "generic", 0, (False, "empty_path")), ("https://www.dib.ae/offers/offer-detail/1", "dib", 1, (True, "dib_offer_detail")), ("https://visa.co.ae/offers/1", "visaUAE", 1, (False, "visa_off_topic")), ("https://a.com/offer/1", "generic", 0, (True, "allowed"))])
def test_enqueue(spark, url, source, depth, expected):
    df = spark.createDataFrame([(url, source, depth)], "u string, s string, d int")
    assert tuple(df.select(D.enqueue(F.col("u"), F.col("s"), F.col("d")).alias("e")).first().e) == expected


def test_seeds(spark):
    results = spark.createDataFrame([("https://www.adcb.com/offers?utm_source=x", "t", None, "q", 2), ("https://www.adcb.com/offers", "t", None, "q", 1), ("https://youtube.com/offers", "t", None, "q", 3), ("https://a.com/login/offers", "t", None, "q", 4), ("https://b.com/x", "cashback", None, "q", 5), ("https://old.com/offers", None, None, "q", 6)], "url string, title string, snippet string, query string, rank int")
    known = spark.createDataFrame([("https://old.com/offers#x",)], "url string")
    assert [(r.url, r.rank) for r in D.seeds(results, known).collect()] == [("https://www.adcb.com/offers", 1), ("https://b.com/x", 5)]
    assert [r.hits for r in D.candidates(results).orderBy("host").collect()] == [1, 2, 1, 1, 1]
    left = D.rejected_filter(results.select("url"), "url", spark.createDataFrame([("ADCB.com",)], "domain string"), "domain")
    assert left.count() == 4
    got = spark.createDataFrame([("/url?q=https%3A%2F%2Fa.com%2F&x=1",), ("https://b.com",), ("#x",)], "h string").select(D.result_url(F.col("h")).alias("u")).collect()
    assert [r.u for r in got] == ["https://a.com/", "https://b.com", None]
    assert D.searches(spark.createDataFrame([("a b",)], "query string"), 2).orderBy("page").collect()[1].url.startswith("https://www.google.com/search?q=a+b&gl=ae&hl=en&num=10&start=10")


def test_pages_and_scores(spark):
    html = "<p>x</p>"
    rows = [("https://x.com/a", "Page not found", html, "adcb"), ("https://www.hsbc.ae/special-offers/a", "text " * 50, html, "hsbc"), ("https://x.com/a", "short", html, "adcb"), ("https://x.com/a", "text " * 50, '<div class="offer-x card">', "adcb"), ("https://x.com/a", "Card offers\n" + "text " * 50, html, "adcb"), ("https://x.com/a", "text " * 50, html, "adcb")]
    df = spark.createDataFrame(rows, "u string, t string, h string, s string")
    assert [r.p for r in df.select(CQ.page_type(F.col("u"), F.col("t"), F.col("h"), F.col("s")).alias("p")).collect()] == ["error", "detail", "shell", "listing", "category", "unknown"]
    offers = Q.offers(spark.createDataFrame([("20% off at Carrefour", "percent", "20", "Carrefour"), ("Seasonal offers", None, None, None), ("", None, None, None)], "offer_title string, discount_type string, discount_value string, merchant_name string"))
    got = offers.select(CQ.confidence().alias("c"), CQ.emit_reasons().alias("r")).collect()
    assert [(r.c, r.r) for r in got] == [(0.7, []), (0.35, ["category_header", "no_meaningful_fields"]), (0.15, ["no_meaningful_fields"])]


def test_wallets(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    wallets = W.instruments(
        make([(1,), (2,)], "user_id int"),
        make([(1, "smiles", "4000", None, "100", True)], "user_id int, program string, balance_coins string, max_coins string, rate string, enabled boolean"),
        make([(1, "c", "FAB", "mc", 2.0, 0.01, None)], "user_id int, id string, bank string, network string, points_rate double, gold_rate double, enabled boolean"),
        make([(1, None, "x", True)], "user_id int, id string, bank string, enabled boolean"),
        make([(1, "a", "Percentage", 10.0, None, None, True), (1, "b", "flat", 5.0, None, None, True), (1, "", "x", 1.0, None, None, True)], "user_id int, code string, kind string, value double, min_spend double, cap double, enabled boolean"),
        make([(1, 10.0, True)], "user_id int, percent double, enabled boolean"),
    )
    row = wallets.where("user_id = 1").first()
    assert row.cards[0].network == "Mastercard" and [c.kind for c in row.coupons] == ["percent", "fixed"] and row.banks is None and row.membership == 10
    sessions = make([(7, 1, 200.0, "open", None, None, None, None, None), (8, 1, 200.0, "closed", None, None, None, None, None), (9, 1, 200.0, "open", 50, "B", "c", False, None)], "session_id int, user_id int, amount double, status string, loyalty_percent int, coupon_code string, card_id string, use_membership boolean, use_coupons boolean")
    got = {r.session_id: (r.net_amount, r.loyalty_aed, r.coupon_aed, r.membership_aed) for r in W.confirmed(sessions, wallets).collect()}
    assert got == {7: (129.6, 40.0, 16.0, 14.4), 9: (175.0, 20.0, 5.0, 0.0)}
    assert "save 70.40" in W.explanation(P.best_combination(W.session_requests(sessions.where("session_id = 7"), wallets))).first().explanation
    assert make([('so: {"bestIndex": 2, "reason": "r"} ok',), ("none",)], "x string").select(W.parse_answer(F.col("x"))["bestIndex"].alias("b")).collect()[0].b == 2


def test_merchants(spark):
    merchants = spark.createDataFrame([("m1", "Lulu", "grocery", "5411", "q1")], "merchant_id string, name string, category string, mcc string, qr_code string")
    aliases = spark.createDataFrame([("lulu", "m1")], "alias string, merchant_id string")
    new = spark.createDataFrame([("Ikea", "home", None, ["IKEA UAE", "lulu"])], "name string, category string, mcc string, aliases array<string>")
    known, names = W.register_merchants(merchants, aliases, new)
    assert known.count() == 2 and sorted(r.alias for r in names.collect()) == ["ikea", "ikea uae", "lulu"]
    assert sorted(r.name for r in W.merchant_names(known, names, "ikea").collect()) == ["Ikea", "ikea", "ikea uae"]
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "user_id int, id string")
    assert W.replace_for_users(rows, spark.createDataFrame([(1, "z")], rows.schema)).count() == 2
    assert W.delete_owned(rows, spark.createDataFrame([(2, "a"), (2, "c")], rows.schema)).count() == 2
