from pyspark.sql import functions as F

from tidewell.operators import site_offers as S

FILL = "<p>" + "Some words about this bank and its cards in the country. " * 10 + "</p>"


def offers(spark, *pages):
    return S.page_offers(spark.createDataFrame(list(pages), "url string, html string"))


def test_cards_of_a_listing(spark):
    html = f"""<html><title>Offers</title><body>{FILL}
    <div class="offer-card offer"><h3>20% off at Carrefour</h3><p>Valid until 31 December 2027. Minimum spend AED 100</p><a href="/offers/carrefour">more</a></div>
    <div class="offer"><h3>Know more about us</h3></div>
    <div class="card"><h3>Save with code</h3><span data-code="SAVE20NOW"></span></div></body></html>"""
    rows = {r.offer_title: r for r in offers(spark, ("https://www.adcb.com/offers/", html)).collect()}
    assert set(rows) == {"20% off at Carrefour", "Know more about us", "Save with code"}
    r = rows["20% off at Carrefour"]
    assert (r.source_url, r.bank_name, r.merchant_name, r.discount_type, r.discount_value, r.valid_to, r.min_spend) == ("https://www.adcb.com/offers/carrefour", "ADCB", "Carrefour", "percent", "20", "2027-12-31", "100")
    assert rows["Save with code"].coupon_code == "SAVE20NOW" and rows["Save with code"].discount_type == "coupon"


def test_structured_data_comes_first(spark):
    html = f"""<script type="application/ld+json">{{"@type": "Product", "name": "Spa day 15% off", "offers": [{{"@type": "Offer", "description": "15% off", "validThrough": "2027-05-06T00:00"}}]}}</script>{FILL}<div class="card"><h3>10% off</h3></div>"""
    (r,) = offers(spark, ("https://shop.example.com/x", html)).collect()
    assert (r.offer_title, r.valid_to, r.discount_value, r.source_type) == ("Spa day 15% off", "2027-05-06", "15", "generic")


def test_dated_links_and_whole_pages(spark):
    links = f'{FILL}<a href="/special-offers/marina-hotel-half-price-05-06-2027/">x</a><a href="/special-offers/">all</a>'
    page = f"<h1>30% cashback with Lulu</h1>{FILL}"
    rows = {r.source_url: r for r in offers(spark, ("https://www.hsbc.ae/special-offers/", links), ("https://www.cbd.ae/lulu", page), ("https://www.cbd.ae/empty", "<p>404 page not found</p>"), (None, page), ("https://x.com", None)).collect()}
    assert set(rows) == {"https://www.hsbc.ae/special-offers/marina-hotel-half-price-05-06-2027/", "https://www.cbd.ae/lulu"}
    a, b = rows["https://www.hsbc.ae/special-offers/marina-hotel-half-price-05-06-2027/"], rows["https://www.cbd.ae/lulu"]
    assert (a.merchant_name, a.valid_to, a.offer_title) == ("Marina", "2027-06-05", "marina hotel half price")
    assert (b.discount_type, b.discount_value, b.bank_name) == ("cashback", "30", "CBD")


def test_api_and_pdf(spark):
    json = '{"data": {"offers": {"items": [{"id": "1", "title": "20% off", "category": "a", "validTo": "20270506T000000Z"}, {"id": "2", "title": "20% off", "category": "a"}, {"id": "3", "title": "Easy payment plan", "category": "b"}, {"id": "4", "title": "Pay with Vantage points", "category": "c", "validTo": "20270506"}]}}}'
    (r,) = S.api_offers(spark.createDataFrame([(json,), ("bad",)], "j string"), "j", "https://www.mashreq.com/offers").collect()
    assert (r.source_url, r.valid_to, r.discount_value) == ("https://www.mashreq.com/offers?offerId=1", "2027-05-06", "20")
    df = spark.createDataFrame([(bytearray(b"stream (Hello \\(you\\)) Tj (there)Tj endstream"),)], "c binary")
    assert df.select(S.pdf_text(F.col("c")).alias("t")).first().t == "Hello (you) there"


def test_hints_of_addresses(spark):
    from tidewell.operators import site_rules as SR

    rows = [
        ("hsbc", "https://www.hsbc.ae/special-offers/marina-hotel-25-off-on-rooms-05-06-2027/", ("percent", "25", "Marina", "2027-06-05", False)),
        ("hsbc", "https://www.hsbc.ae/special-offers/airalo-3gb-free/", ("fixed", "3", "Airalo", None, False)),
        ("hsbc", "https://www.hsbc.ae/special-offers/cafe-bogo-10-off-x/", ("percent", "50", "Cafe", None, False)),
        ("hsbc", "https://www.hsbc.ae/special-offers/shop-flexi-instalment-01-02-2027", (None, None, "Shop", "2027-02-01", True)),
        ("fab", "https://www.bankfab.com/offers/blue-lagoon-30-percent-off", ("percent", "30", "Blue Lagoon Percent", None, False)),
        ("fab", "https://www.bankfab.com/offers/red-rose-discount-15", ("percent", "15", "Red Rose", None, False)),
        ("cbd", "https://www.cbd.ae/offers/x-20-off-y", (None, None, None, None, False)),
        ("hsbc", "not a url", (None, None, None, None, False)),
        (None, None, (None, None, None, None, False)),
    ]
    df = spark.createDataFrame([(i, s, u) for i, (s, u, _) in enumerate(rows)], "i int, s string, u string").select("i", SR.slug_hints(F.col("u"), F.col("s")).alias("h"))
    got = [(r.h.type, r.h.value, r.h.merchant, str(r.h.until) if r.h.until else None, bool(r.h.instalment)) for r in df.orderBy("i").collect()]
    assert got == [e for *_, e in rows]
    assert str(spark.range(1).select(SR.year_end(F.lit("valid until 2027 only")).alias("d")).first().d) == "2027-12-31"


def test_rows_per_tier_and_shop(spark):
    tiers = f"<h1>Early bird</h1>{FILL}<p>Up to AED 1,500 cashback, then AED 500 cash-back and AED 500 cashback, AED 1 each</p>"
    card = f"<h1>Blue Card</h1>{FILL}<ul><li>Enjoy 10% cashback at Lulu, Noon and Amazon.</li><li>Get 25% off at Zara this month</li><li>Free lounge for all</li></ul>"
    rows = offers(spark, ("https://www.mashreq.com/en/neo/offers/early-bird-cashback", tiers), ("https://www.mashreq.com/en/cards/credit-cards/blue", card)).collect()
    assert sorted(r.offer_title for r in rows) == ["10% cashback at Lulu", "10% cashback at Noon", "Early bird — AED 1,500 cashback", "Early bird — AED 500 cashback", "Get 25% off at Zara this month"]
    assert {r.merchant_name for r in rows} == {"Lulu", "Noon", "Mashreq", "Zara this month"} and sorted(r.discount_type for r in rows) == ["cashback"] * 4 + ["percent"]
    assert sorted(r.discount_value for r in rows) == ["10", "10", "1500", "25", "500"]


def test_tags_and_instalments(spark):
    burn = f"<h1>10% off at Lulu</h1>{FILL}<p>Pay with TouchPoints</p>"
    pages = [("https://www.adcb.com/lulu", burn), ("https://www.hsbc.ae/special-offers/shop-flexi-instalment-01-02-2027", f"<h1>Shop easy payment 5% off</h1>{FILL}"), ("https://www.hsbc.ae/special-offers/shop-flexi-instalment", f"<h1>Shop easy payment 5% off</h1>{FILL}")]
    rows = {r.source_url: r for r in offers(spark, *pages).collect()}
    assert set(rows) == {pages[0][0], pages[1][0]}
    assert "touchpoints_burn" in rows[pages[0][0]].categories and "instalment_plan" in rows[pages[1][0]].categories and rows[pages[1][0]].valid_to == "2027-02-01"


def test_result_pages(spark):
    from tidewell.operators import site_rules as SR

    html = """<div class="g"><a href="/url?q=https://shop.com/deals%3Fa%3D1&amp;sa=U"><h3>Deals   of <b>today</b></h3></a><span>Best prices.... here</span></div>
    <div class="g"><a href="https://shop.com/deals?a=1"><h3>Again</h3></a></div><a href="https://www.facebook.com/x"><h3>Blocked</h3></a>
    <a href="https://other.com/login"><h3>Login page</h3></a><a href="https://third.com/offers"><h3>Third one</h3></a><div>about it</div><a href="https://no.com/">no heading</a>"""
    got = SR.result_rows(spark.createDataFrame([(html, "q", 10), ("", "q", 0), (None, None, None)], "html string, query string, offset int")).orderBy("rank").collect()
    assert [(r.url, r.title, r.query, r.source, r["rank"]) for r in got] == [("https://shop.com/deals?a=1", "Deals of today", "q", "google", 11), ("https://third.com/offers", "Third one", "q", "google", 12)]
    assert got[0].snippet.startswith("Best prices") and got[1].snippet == "about it"


def test_pages_are_read_once_and_the_first_way_of_a_url_counts(spark):
    pages = [("https://shop.example.com/a", f"<h1>30% off here</h1>{FILL}"), ("https://shop.example.com/a", f'{FILL}<div class="card"><h3>10% off spa</h3></div>'), ("https://shop.example.com/b", f"<h1>20% off there</h1>{FILL}")]
    df = offers(spark, *pages)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and plan.count("noscript") == 1  # one scan, one reading of the text
    assert sorted((r.source_url, r.offer_title, r.parser_reason) for r in df.collect()) == [("https://shop.example.com/a", "10% off spa", "card"), ("https://shop.example.com/b", "20% off there", "page")]
