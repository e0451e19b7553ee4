"""Offer rows from pages, by expressions: structured data, cards of listings, dated links, coupons, or the page itself.

Every page goes through one plan. The first way that finds offers supplies the page's rows; each row is then filled
from its text by the same builder, with what site_rules.py reads from the addresses of some sites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import constants as C
from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators import crawl_quality as CQ
from tidewell.operators import extract as X
from tidewell.operators import site_rules as SR
from tidewell.operators.relational import first_per

# fixed values
SIGNAL = r"cashback|%\s*off|AED\s*\d|\d+\s*%|promo\s*code|valid\s+until|minimum\s+spend|discount|coupon|save|reward|complimentary|instalment|installment|know more|flexi|welcome bonus|miles|lounge"
LISTING = r"/(?:special-)?offers?/?$|/promotions?/?$|/deals?/?$|/rewards?/?$|/perks?/?$|/neo/offers/?$|offers\.aspx"
VALIDITY = r"valid\s+(?:until|till|thru|from|through)\s*([0-9]{1,2}[\s/.-][A-Za-z0-9\s,.-]+)"
EXPIRY = r"(?:expires?|expiry|ends?)\s*(?:on|by)?\s*([0-9]{1,2}[\s/.-][A-Za-z0-9\s,.-]+)"
CARDS = [(r"visa\s+infinite", "Visa Infinite"), (r"visa\s+signature", "Visa Signature"), (r"visa\s+platinum", "Visa Platinum"), (r"\bvisa\b", "Visa"), (r"world\s+elite", "World Elite Mastercard"), ("mastercard", "Mastercard")]
DATE = r"(\d{1,2}[\s/.-](?:\d{1,2}|[A-Za-z]{3,9})[\s/.-]\d{4})"
VERSION = "1"


def card_name(x: Column) -> Column:
    out = F.when(T.matches(x, CARDS[0][0]), CARDS[0][1])
    for pattern, name in CARDS[1:]:
        out = out.when(T.matches(x, pattern), name)
    return out


def merchant_in_title(x: Column) -> Column:
    """After "By" at the start, or after at, with, from or for."""
    by = T.clean_text(F.regexp_extract(x, r"(?i)^By\s+(.+?)(?:\s*[-–|]|$)", 1))
    at = T.clean_text(F.regexp_extract(x, r"(?i)(?:at|with|from|for)\s+([A-Za-z0-9&'.\s-]{2,40})", 1))
    return F.coalesce(F.nullif(by, F.lit("")), F.nullif(at, F.lit("")))


def slug_title(path: Column) -> Column:
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.initcap(F.regexp_replace(F.try_element_at(parts, F.lit(-1)), "-", " "))


def day(x: Column, pattern: str) -> Column:
    """The date within what a validity pattern captures."""
    return T.parse_date(F.nullif(F.regexp_extract(T.found(x, pattern), DATE, 1), F.lit("")))


def is_listing(url: Column, html: Column) -> Column:
    return T.matches(url, LISTING) | (F.size(_cards(html)) >= 2)


def _cards(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"(?is)<(article|li|div|section)\b[^>]*class=\"[^\"]*\b(?:card|offer|promo|promotion|deal)\b[^\"]*\"[^>]*>(.*?)</\1>"), 2)


def tag_text(html: Column, tags: str) -> Column:
    return F.nullif(T.clean_text(F.regexp_replace(F.regexp_extract(html, rf"(?is)<({tags})\b[^>]*>(.*?)</\1>", 2), "<[^>]*>", " ")), F.lit(""))


def named_text(html: Column, names: str) -> Column:
    return F.nullif(T.clean_text(F.regexp_replace(F.regexp_extract(html, rf"(?is)<(\w+)\b[^>]*class=\"[^\"]*(?:{names})[^\"]*\"[^>]*>(.*?)</\1>", 2), "<[^>]*>", " ")), F.lit(""))


def built(rows: DataFrame) -> DataFrame:
    """rows(page_url, source_url, source_type, mode, title, merchant, description, code, text) as offer rows."""
    both = F.concat_ws(" ", "title", "description", "text")
    found = T.once(both, T.detect_discount)
    coupon = F.upper(F.coalesce("code", T.found(both, C.PATTERNS["coupon"])))
    hints = T.once(F.struct("source_url", "source_type"), lambda s: SR.slug_hints(s["source_url"], s["source_type"]))
    df = T.step(rows, _d=found, _c=coupon, _h=hints)
    # an address counts before the text on one site, and where the text tells no more than 1 on the other
    weak = (F.col("source_type") == "hsbc") | F.coalesce(F.col("_d.value").try_cast("double") <= 1, F.col("_d.value").isNull())
    df = df.withColumn("_d", F.when(F.col("_h.value").isNotNull() & weak, F.struct(F.col("_h.type").alias("type"), F.col("_h.value").alias("value"))).otherwise(F.col("_d")))
    df = df.where(~F.coalesce(F.col("_h.instalment"), F.lit(False)) | (F.col("_h.until").isNotNull() & F.col("_h.merchant").isNotNull()))
    b = both
    df = df.select(
        "source_url",
        "source_type",
        F.col("title").alias("offer_title"),
        F.col("description").alias("offer_description"),
        F.coalesce("merchant", F.when(F.col("source_type") == "hsbc", F.col("_h.merchant")), F.when(F.col("_h.value").isNotNull(), F.col("_h.merchant")), merchant_in_title(F.col("title"))).alias("merchant_name"),
        T.lookup(F.col("source_type"), C.BANK_BY_SOURCE).alias("bank_name"),
        T.once(b, card_name).alias("card_name"),
        F.coalesce(F.when(F.col("code").isNotNull() & F.col("_d.type").isNull(), "coupon"), F.col("_d.type")).alias("discount_type"),
        F.col("_d.value").alias("discount_value"),
        F.lit("AED").alias("currency"),
        F.when(T.valid_coupon(F.col("_c")), F.col("_c")).alias("coupon_code"),
        T.found(b, C.PATTERNS["min_spend"]).alias("min_spend"),
        T.found(b, C.PATTERNS["cap"]).alias("cap_value"),
        T.once(b, lambda x: day(x, VALIDITY)).cast("string").alias("valid_from"),
        F.coalesce("until", T.once(b, lambda x: F.coalesce(day(x, EXPIRY), day(x, VALIDITY))).cast("string"), F.col("_h.until").cast("string"), F.when(F.col("source_type") == "fab", SR.year_end(b)).cast("string")).alias("valid_to"),
        T.once(b, T.payment_methods).alias("payment_methods"),
        T.distinct_filled(F.concat(T.once(b, T.page_categories), SR.tags(b, F.col("source_type"), F.col("_h.instalment")))).alias("categories"),
        T.stackable(b).alias("stackable"),
        F.length("text").alias("page_length"),
        F.col("text").alias("raw_text"),
        F.lit("tidewell").alias("parser_name"),
        F.col("mode").alias("parser_reason"),
        F.lit(VERSION).alias("parser_version"),
    )
    return df.withColumn("parser_confidence", CQ.confidence() * F.when(F.col("source_type") == "generic", 0.7).otherwise(1.0))


def page_offers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Offer rows of pages(url, html); pages of errors, shells and categories have none.

    A page is read once: each way to find offers is an array in the page's row, and a later way is tried only where the
    ways before it give none. Rows are shuffled by page, as a URL may come more than once, and by what makes an offer one.
    """
    p = pages.select(F.col(url).alias("page_url"), F.col(html).alias("html")).where("page_url is not null and html is not null")
    here, source, whole, text = F.col("page_url"), F.col("source_type"), F.col("html"), F.col("text")
    p = T.step(p, source_type=U.source_type(here), text=X.visible_text(whole))
    p = T.step(p, page_type=CQ.page_type(here, text, whole, source)).where(~CQ.skipped(F.col("page_type")))
    none = F.lit(None).cast("string")
    offer = lambda mode, order, source, title, merchant, description, code, until, text: F.struct(F.lit(mode).alias("mode"), F.lit(order).alias("order"), source.alias("source_url"), title.alias("title"), merchant.alias("merchant"), description.alias("description"), code.alias("code"), until.cast("string").alias("until"), text.alias("text"))
    data = F.transform(X.structured_offers(whole), lambda s: offer("structured", 0, F.coalesce(s["offer_url"], here), s["offer_title"], none, s["offer_description"], none, F.substring(s["valid_to"], 1, 10), F.coalesce(s["offer_description"], s["offer_title"])))
    link = lambda x: F.coalesce(X.resolve(F.nullif(F.regexp_extract(x, r"(?is)<a\b[^>]*href=\"([^\"#]+)", 1), F.lit("")), here), here)
    text_of = lambda x: T.clean_text(F.regexp_replace(x, "<[^>]*>", " "))
    code = lambda x: F.nullif(F.regexp_extract(x, r"(?is)data-(?:code|coupon)=\"([^\"]+)", 1), F.lit(""))
    cards = F.transform(_cards(whole), lambda c: offer("card", 1, link(c), F.coalesce(tag_text(c, "h1|h2|h3|h4"), named_text(c, "title")), named_text(c, "merchant|brand|store|partner"), tag_text(c, "p"), code(c), none, text_of(c)))
    titled = F.coalesce(tag_text(whole, "h1"), X.title(whole))
    tiers = F.transform(SR.tiers(here, source, titled, text), lambda t: offer("tier", 1, here, t["tier_title"], F.lit("Mashreq"), t["tier_title"], none, none, t["tier_title"]))
    shops = F.transform(SR.benefits(here, source, whole), lambda b: offer("card benefit", 1, here, b["shop_title"], b["shop"], b["snippet"], none, none, b["shop_title"]))
    slug = lambda u: F.try_element_at(F.filter(F.split(u, "/"), lambda x: x != ""), F.lit(-1))
    dated = F.filter(F.transform(F.array_distinct(X.links(whole)), lambda h: X.resolve(h, here)), lambda u: slug(u).rlike(r"-\d{2}-\d{2}-\d{4}$") & T.matches(u, "/(?:special-)?offers/"))
    words = lambda u: F.regexp_replace(F.regexp_replace(slug(u), r"-\d{2}-\d{2}-\d{4}$", ""), "-", " ")
    until = lambda u: T.parse_date(F.regexp_extract(slug(u), r"(\d{2}-\d{2}-\d{4})$", 1))
    slugs = F.transform(dated, lambda u: offer("dated link", 2, u, words(u), F.initcap(F.regexp_extract(words(u), r"^(\S+)", 1)), words(u), none, until(u), words(u)))
    title = F.coalesce(X.meta(whole, "og:title"), tag_text(whole, "h1"), X.title(whole))
    about = F.coalesce(X.meta(whole, "og:description"), X.meta(whole, "description"))
    page = F.array(offer("page", 3, here, title, none, about, none, none, text))
    sound = lambda o: (F.length(F.coalesce(o["title"], F.lit(""))) >= 4) & (T.matches(F.concat_ws(" ", o["title"], o["text"]), SIGNAL) | o["code"].isNotNull() | o["until"].isNotNull())
    some = lambda offers: T.once(F.filter(offers, sound), lambda xs: F.when(F.size(xs) > 0, xs))
    listed = F.concat(cards, *(F.coalesce(x, F.slice(cards, 1, 0)) for x in (tiers, shops)))
    found = F.coalesce(some(data), some(listed), some(slugs), some(page))
    rows = p.select("page_url", "source_type", F.posexplode(found).alias("at", "o")).select("page_url", "source_type", "at", "o.*")
    kept = rows.withColumn("_n", F.rank().over(Window.partitionBy("page_url").orderBy("order"))).where("_n = 1").drop("_n")
    return built(first_per(kept, ["source_url", "title", "code"], [F.col("page_url"), F.col("text"), F.col("at")]))


def api_offers(rows: DataFrame, payload: str, base: str, path: str = "$.data.offers.items") -> DataFrame:
    """Offer rows of an offers API's JSON answers: items(id, title, description, category, validTo), each once."""
    item = "struct<id:string,title:string,description:string,category:string,validTo:string>"
    x = rows.select(F.explode(F.from_json(F.get_json_object(payload, path), f"array<{item}>")).alias("i")).select("i.*")
    until = F.when(F.col("validTo").rlike(r"^\d{8}"), F.try_to_timestamp(F.substring("validTo", 1, 8), F.lit("yyyyMMdd")).cast("date"))
    x = first_per(x.withColumn("until", until.cast("string")), ["title", "category"], [F.col("id")])
    plan = CQ.instalment_offer(F.concat_ws(" ", "title", "description"), F.col("category"))
    value = T.detect_discount(F.concat_ws(" ", "title", "description"))["value"]
    x = x.where(~CQ.points_noise(F.concat_ws(" ", "title", "description")) & F.when(plan, F.col("until").isNotNull()).otherwise(value.isNotNull() | F.col("until").isNotNull()))
    url = F.concat(F.lit(f"{base}?offerId="), F.url_encode("id"))
    return built(x.select(F.lit(base).alias("page_url"), url.alias("source_url"), U.source_type(F.lit(base)).alias("source_type"), F.lit("api").alias("mode"), "title", F.lit(None).cast("string").alias("merchant"), "description", F.lit(None).cast("string").alias("code"), "until", F.concat_ws(" ", "title", "description").alias("text")))


def pdf_text(content: Column) -> Column:
    """The text shown by a PDF's uncompressed text operators."""
    parts = F.regexp_extract_all(F.decode(content, "ISO-8859-1"), F.lit(r"\(((?:\\.|[^()\\])*)\)\s*Tj"), 1)
    return T.clean_text(F.regexp_replace(F.array_join(parts, " "), r"\\([()\\])", "$1"))
