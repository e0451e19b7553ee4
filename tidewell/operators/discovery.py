"""Discovery of pages: search results to seeds, and which links of a page to follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import url as U
from tidewell.functions.text import any_of, clean_text, matches
from tidewell.operators.relational import first_per

# fixed values
BLOCKED_HOSTS = ["google.com", "google.ae", "googleusercontent.com", "gstatic.com", "youtube.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "wikipedia.org", "linkedin.com", "tiktok.com", "pinterest.com", "reddit.com", "amazon.com", "play.google.com", "accounts.google.com"]
BLOCKED_PATH = r"/(?:login|signin|sign-in|signup|register|account|privacy|policy|terms|help|support|careers|cookie)\b"
RELEVANT = ["offer", "deal", "promo", "promotion", "coupon", "cashback", "discount", "bank", "card", "visa", "mastercard", "emirates nbd", "enbd", "fab", "credit card", "debit card", "reward", "perk", "voucher", "uae"]
NOT_OFFERS = [
    "/private-banking", "/priority-banking", "/business", "/corporate-banking", "/about-us", "/careers", "/investor-relations", "/sustainability", "/privacy-policy",
    "/contact-us", "/help-centre", "/help-center", "/help-and-support", "/atm-branches", "/branches-atms", "/emirati", "/loans/", "/accounts/", "/login", "/sign-in",
    "/signin", "/register", "/cookie", "/fatca", "/media-centre", "/media-center", "/investor", "/schedule-of-charges", "/key-facts", "/application-form",
    "/ways-of-banking", "/digital-banking", "/online-banking", "/mobile-banking", "/phone-banking", "/sitemap", "/search", "/knowledge-hub", "/fraud", "/complaint",
]
OFFER_WORDS = "deal|offer|promo|promotion|benefit|reward|perk|coupon|cashback|discount|campaign|mastercard|visa-offer"
COUPON_SOURCES = ["couponFeed", "groupon", "cuponation", "picodi", "couponsAe", "wethrift", "smiles", "noon"]
BANK_SOURCES = ["adcb", "mashreq", "rakBank", "dib", "hsbc", "citibank", "cbd", "mastercard", "adib", "fab"]
#: (source types, URL pattern or none, name, path pattern)
FOLLOWED = [
    (["emiratesNbd"], r"emiratesnbd\.com", "enbd", r"/deals/|/deals\?|/promotions/|/cards/deals/|/offers/|/mastercard-benefits|\.pdf$"),
    (["visaUAE"], r"visamiddleeast\.com|visa\.co\.ae|visa\.com", "visa", rf"/visa-offers-and-perks/|/offers?/|/perks?/|/promotions?/|{OFFER_WORDS}"),
    (["fab"], r"bankfab\.com", "fab", rf"/offers?/|/rewards?/|/promotions?/|{OFFER_WORDS}"),
    (["hsbc"], r"hsbc\.ae", "hsbc", rf"/special-offers/|/offers?/|/promotions?/|/deals?/|/rewards?/|/benefits?/|{OFFER_WORDS}"),
    (["adib"], r"adib\.ae", "adib", rf"/offers?/|/promotions?/|/cards?/|{OFFER_WORDS}"),
    (COUPON_SOURCES, None, "coupon", rf"{OFFER_WORDS}|/(?:coupons?|promo|deals?|vouchers?|offers?|stores?|brands?)/"),
    (BANK_SOURCES, None, "bank", rf"/offers?/|/promotions?/|/deals?/|/rewards?/|/benefits?/|{OFFER_WORDS}"),
]
BUDGETS = {"emiratesNbd": 40, "visaUAE": 30, "fab": 50, "adcb": 60, "mashreq": 50, "rakBank": 25, "dib": 30, "adib": 25, "hsbc": 20, "cbd": 15}
DEFAULT_BUDGET = 25


def literal(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


def blocked_host(host: Column) -> Column:
    h = F.regexp_replace(F.lower(host), r"^www\.", "")
    return h.isNull() | h.rlike(rf"(?:^|\.)(?:{literal(BLOCKED_HOSTS)})$")


def relevant(url: Column, title: Column, snippet: Column) -> Column:
    return ~matches(url, BLOCKED_PATH) & matches(F.concat_ws(" ", url, title, snippet), literal(RELEVANT))


def result_url(href: Column) -> Column:
    """The target of a search result's link."""
    inner = F.try_url_decode(F.coalesce(F.try_parse_url(F.concat(F.lit("https://www.google.com"), href), F.lit("QUERY"), F.lit("q")), F.try_parse_url(F.concat(F.lit("https://www.google.com"), href), F.lit("QUERY"), F.lit("url"))))
    return F.when(href.startswith("/url?"), inner).when(href.rlike("^https?://"), href)


def search_url(query: Column, page: Column, country: str = "ae", language: str = "en", size: int = 10) -> Column:
    return F.concat(F.lit("https://www.google.com/search?q="), F.url_encode(query), F.lit(f"&gl={country}&hl={language}&num={size}&start="), (page * size).cast("string"), F.lit("&pws=0"))


def searches(queries: DataFrame, pages: int) -> DataFrame:
    """(query, page, url): a search per query and page; the pages are a short list within the row."""
    out = queries.select("query", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))
    return out.withColumn("url", search_url(F.col("query"), F.col("page")))


def seeds(results: DataFrame, known: DataFrame, denied: list[str] = (), allowed: list[str] = (), most: int = 100) -> DataFrame:
    """Results(url, title, snippet, query, rank) worth crawling: relevant, not blocked, denied or known, each page once."""
    df = results.withColumn("key", U.normalize_url(F.col("url"))).where(F.col("key") != "")
    df = df.where(~blocked_host(U.hostname(F.col("url"))) & relevant(F.col("url"), F.col("title"), F.col("snippet")))
    if denied:
        df = df.where(~any_of(F.col("url"), list(denied)))
    if allowed:
        df = df.where(U.allowed(F.col("url"), F.array(*map(F.lit, allowed))))
    first = first_per(df, ["key"], [F.col("rank").asc_nulls_last(), F.col("query"), F.col("url")])
    new = first.join(known.select(U.normalize_url(F.col("url")).alias("key")).distinct(), "key", "left_anti")
    return new.withColumn("source_type", U.source_type(F.col("url"))).orderBy("query", F.col("rank").asc_nulls_last(), "url").limit(most)


def follow(url: Column, source: Column) -> Column:
    """struct(follow, reason) for a link of a page of a source."""
    low = F.lower(url)
    out = lambda yes, why: F.struct(F.lit(yes).alias("follow"), F.lit(why).alias("reason"))
    rule = F.when(matches(low, literal(NOT_OFFERS)), out(False, "blocked:generic-noise")).when(matches(low, r"\.(jpg|jpeg|png|gif|svg|css|js|woff|ico)(\?|$)"), out(False, "blocked:asset"))
    for kinds, host, name, path in FOLLOWED:
        here = source.isin(kinds) | (matches(low, host) if host else F.lit(False))
        rule = rule.when(here & matches(low, path), out(True, f"{name}:offer-path")).when(here, out(False, f"{name}:non-offer-path"))
    return rule.when(matches(low, OFFER_WORDS), out(True, "generic:offer-keyword")).otherwise(out(False, "generic:no-keyword"))


def enqueue(url: Column, source: Column, depth: Column) -> Column:
    """struct(enqueue, reason): follow() with campaign links, empty paths and source rules."""
    f = follow(url, source)
    out = lambda yes, why: F.struct(F.lit(yes).alias("enqueue"), F.lit(why).alias("reason"))
    of = lambda kind, p: (source == kind) & matches(url, p)
    return (
        F.when(matches(url, r"/campaigns?/|/utm_|/track(?:ing)?/"), out(False, "campaign_or_tracking"))
        .when(U.empty_path(url), out(False, "empty_path"))
        .when(~f["follow"], F.struct(F.lit(False).alias("enqueue"), f["reason"].alias("reason")))
        .when(of("emiratesNbd", "/deals/deal-search"), out(False, "enbd_search_page"))
        .when(of("emiratesNbd", r"/deals/[^/?]+"), out(True, "enbd_deal_detail"))
        .when(of("hsbc", r"/special-offers/[^/]+"), out(True, "hsbc_detail_slug"))
        .when(of("mashreq", r"/neo/offers/[^/]+"), out(True, "mashreq_offer_detail"))
        .when(of("dib", "/offers/offer-detail/"), out(True, "dib_offer_detail"))
        .when((source == "visaUAE") & ~matches(url, "/visa-offers-and-perks/") & (depth > 0), out(False, "visa_off_topic"))
        .otherwise(out(True, "allowed"))
    )


def needs_browser(url: Column, source: Column) -> Column:
    return source.isin("emiratesNbd", "visaUAE") | matches(url, r"emiratesnbd\.com.*(?:/deals|/promotions)|visamiddleeast\.com|visa\.co\.ae.*/offers|visa-offers-and-perks")


def globs(domain: Column) -> Column:
    bare = F.regexp_replace(domain, r"^\*\.", "")
    return F.array(*(F.concat(F.lit(f"{p}://{s}"), bare, F.lit("/**")) for s in ("*.", "") for p in ("https", "http")))


def budget(source: Column, own: Column | None = None) -> Column:
    from tidewell.functions.text import lookup

    known = F.coalesce(lookup(source, BUDGETS), F.lit(DEFAULT_BUDGET))
    return F.coalesce(own, known) if own is not None else known


def candidates(results: DataFrame) -> DataFrame:
    """Hosts of results(url, query): hits, first five URLs and queries. Lists are bounded before they are gathered."""
    rows = results.withColumn("host", U.domain(F.col("url"))).where(F.coalesce("host", F.lit("")) != "")
    hits = rows.groupBy("host").agg(F.count("*").alias("hits"))
    first = first_per(rows.select("host", "url").distinct(), ["host"], [F.col("url")], 5).groupBy("host").agg(F.sort_array(F.collect_list("url")).alias("urls"))
    asked = rows.select("host", "query").distinct().groupBy("host").agg(F.count("query").alias("queries"))
    return hits.join(first, "host").join(asked, "host")


def rejected_filter(urls: DataFrame, url: str, rejected: DataFrame, domain: str) -> DataFrame:
    """urls whose host is not in or below a rejected domain, by suffix keys."""
    host = U.hostname(F.col(url))
    labels = F.split(host, r"\.")
    keys = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hit = urls.select(url, F.explode(F.coalesce(keys, F.array())).alias(domain)).join(rejected.select(U.normalize_domain(F.col(domain)).alias(domain)), domain, "left_semi").select(url).distinct()
    return urls.join(hit, url, "left_anti")


def search_text(x: Column) -> Column:
    return F.regexp_replace(clean_text(x), r"\.{3,}", "…")
