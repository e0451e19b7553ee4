import pytest
from pyspark.sql import functions as F

from tidewell.functions import keys as K
from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators import extract as X


def value(spark, make, x, kind="string"):
    df = spark.createDataFrame([(x,)], f"x {kind}")
    return df.select(make(F.col("x")).alias("v")).first().v


@pytest.mark.parametrize(
    "make, x, expected",
    [
        (T.clean_text, " a  b\n c ", "a b c"),
        (T.clean_text, None, ""),
        (T.slugify, "Cards & Rewards!", "cards-rewards"),
        (T.to_number, "AED 1,250.50 off", 1250.5),
        (T.to_number, "6 months", 6.0),
        (T.to_number, "none", None),
        (T.to_number, "", None),
        (T.find_currency, "from 20 dirhams", "AED"),
        (T.find_currency, "$5", "USD"),
        (T.find_currency, "5", None),
        (T.normalize_bank, " ENBD ", "Emirates NBD"),
        (T.normalize_bank, "Some  Bank", "Some Bank"),
        (T.normalize_merchant, "Seasonal Offers", None),
        (T.normalize_merchant, "x", None),
        (T.normalize_merchant, "Carrefour", "Carrefour"),
        (T.normalize_discount_type, "Percent", "percent"),
        (T.normalize_discount_type, "odd", None),
        (T.valid_coupon, "SAVE20", True),
        (T.valid_coupon, "here", False),
        (T.valid_coupon, "abcde", False),
        (T.valid_coupon, "ABCDEF", True),
        (T.valid_coupon, "1ABCD", False),
        (T.earn_rate_noise, "earn 5 bonus touchpoints", True),
        (T.earn_rate_noise, "20% off", False),
        (T.stackable, "cannot be combined with others", False),
        (U.normalize_url, "HTTPS://X.com/A/?utm_source=z&b=1#f", "https://x.com/a/?b=1"),
        (U.normalize_url, "https://x.com/a/", "https://x.com/a"),
        (U.normalize_url, "https://x.com/", "https://x.com/"),
        (U.normalize_url, None, ""),
        (U.normalize_url, "not a url?x#y", "not a url"),
        (U.hostname, "https://WWW.Bank.ae:8080/x", "www.bank.ae"),
        (U.domain, "https://www.bank.ae/x", "bank.ae"),
        (U.source_type, "https://www.dib.ae/offers", "dib"),
        (U.source_type, "https://www.noon.com/deals", "noon"),
        (U.source_type, "https://shop.com/voucher/1", "couponFeed"),
        (U.source_type, "https://shop.com/", "generic"),
        (U.is_pdf, "https://x.com/a.PDF?x", True),
        (X.title, "<html><TITLE>a\n b</title>", "a b"),
        (X.visible_text, "<nav>x</nav><p>a<b>b</b></p><!-- c --><script>1</script>", "a b"),
        (lambda c: X.meta(c, "og:title"), '<meta content="T" property="og:title">', "T"),
        (lambda c: X.resolve(c, F.lit("https://x.com/a/b?c")), "d.html", "https://x.com/a/d.html"),
        (lambda c: X.resolve(c, F.lit("https://x.com/a/b?c")), "/d", "https://x.com/d"),
        (lambda c: X.resolve(c, F.lit("https://x.com/a/b")), "mailto:x", None),
    ],
)
def test_values(spark, make, x, expected):
    assert value(spark, make, x) == expected


@pytest.mark.parametrize("x, expected", [("31/12/2027", "2027-12-31"), ("1st March 2026", "2026-03-01"), ("2026-05-06", "2026-05-06"), ("Dec 5, 2026", "2026-12-05"), ("2026-05-06T10:00:00Z", "2026-05-06"), ("32/13/2026", None), ("soon", None), (None, None), ("2 June 1999", None)])
def test_dates(spark, x, expected):
    got = value(spark, T.parse_date, x)
    assert (str(got) if got else None) == expected


@pytest.mark.parametrize(
    "x, expected",
    [
        ("Up to 15% cashback", ("cashback", "15")),
        ("20% off on shoes", ("percent", "20")),
        ("Save AED 1,250 today", ("fixed", "1250")),
        ("EUR 30 cashback", ("cashback", "30")),
        ("complimentary lounge", ("complimentary", None)),
        ("1,000 bonus points", ("points", "1000")),
        ("use code SAVE20", ("coupon", None)),
        ("easy payment plan from AED 99", (None, None)),
        ("nothing", (None, None)),
        (None, (None, None)),
    ],
)
def test_discounts(spark, x, expected):
    assert tuple(value(spark, T.detect_discount, x)) == expected


def test_arrays(spark):
    assert value(spark, T.categories, "Hotel and cinema") == ["travel", "entertainment"]
    assert value(spark, lambda c: T.category_codes(T.categories(c)), "dining at the mall") == ["5812", "5814", "5311", "5331", "5399"]
    assert value(spark, T.payment_methods, "FAB credit card or Visa Infinite") == ["Credit Card", "Visa Infinite", "FAB Card"]
    assert value(spark, U.discovery_keys, "https://X.com/a/?ref=1") == ["https://X.com/a/?ref=1", "https://x.com/a", "x.com/a"]
    assert value(spark, X.links, '<a href="/a"><a class="x" href="b#c">') == ["/a", "b"]


def test_rounding_and_keys(spark):
    assert value(spark, K.round2, 1.005, "double") == 1.0
    assert value(spark, K.round3, 0.0125, "double") == 0.013
    assert value(spark, K.number_text, "20.0") == "20" and value(spark, K.number_text, "6 months") == "6 months"
    key = lambda v: value(spark, lambda c: K.canonical_key(F.lit("u"), F.lit("M"), F.lit(None), F.lit("T"), F.lit(None), F.lit("percent"), c), v)
    assert key("20") == key("20.0") != key("21")


def test_json_ld(spark):
    page = '<script type="application/ld+json">{"name": "P", "offers": [{"price": "5", "priceCurrency": "AED"}, {"name": "Q"}]}</script><script type="application/ld+json">{bad</script>'
    rows = X.json_ld_offers(spark.createDataFrame([(page,)], "html string")).select("offer_title", "price", "currency").collect()
    assert [tuple(r) for r in rows] == [("P", "5", "AED"), ("Q", None, None)]


def test_crawl_side_names(spark):
    from tidewell.functions import crawl_names as N

    rows = [("ENBD ", "my Visa  Infinite card", "at Lulu Deal", "Cash back"), ("mashreq bank", "world elite", "from  X promotion", "50%"), ("Other\u00a0Bank", "Plain", "Offer", "EMI"), ("", "", "", ""), (None, None, None, None), ("dib", "MasterCard World Elite", "for", "free gift"), ("x", "x", "x", "miles"), ("x", "x", "x", "what"), ("x", "x", "x", "promo code"), ("x", "x", "x", "AED 5")]
    df = spark.createDataFrame(rows, "b string, c string, m string, d string")
    got = [tuple(r) for r in df.select(N.bank_name(F.col("b")), N.card_name(F.col("c")), N.merchant_name(F.col("m")), N.discount_type(F.col("d"))).collect()]
    assert got[:6] == [("Emirates NBD", "Visa Infinite", "Lulu", "cashback"), ("Mashreq", "World Elite Mastercard", "X", "percent"), ("Other Bank", "Plain", "Offer", "emi"), (None,) * 4, (None,) * 4, ("Dubai Islamic Bank", "Mastercard", "for", "complimentary")]
    assert [g[3] for g in got[6:]] == ["points", "other", "coupon", "fixed"]
