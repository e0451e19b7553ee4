"""Selector lists of the sites, and what they are for: cards of a page, links to follow, how a page is to be rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators import crawl_quality as CQ
from tidewell.operators import discovery as D
from tidewell.operators import page_tree as PT
from tidewell.operators.extract import resolve

# fixed values: selectors by type of source, in the order in which they are tried
CARDS = {
    "emiratesNbd": ['a[href*="/deals/"][data-ctatext]', 'a.stretched-link[href*="/deals/"]', 'a[href*="/deals/"]'],
    "visaUAE": [".vs-card", 'a[href*="/visa-offers-and-perks/"]'],
    "fab": ['[class*="offer-card"]', ".promo-card", "article", "li"],
    "adcb": [".offer-card", ".promo-card", "article", '[class*="offer"]'],
    "mashreq": [".ui-card", 'a[href*="/neo/offers/"]', '[class*="offer-card"]', ".promotion-item", "article"],
    "rakBank": [".offer-card", ".card-offer", "article"],
    "dib": [".card-list-item", ".card-title-info"],
    "groupon": [".deal", '[class*="deal-card"]', '[data-testid*="deal"]'],
    "picodi": [".coupon", '[class*="coupon-item"]', '[class*="offer"]'],
    "cuponation": [".coupon", ".deal", '[class*="coupon"]'],
    "generic": ["article", ".card", ".offer"],
}
DETAILS = {
    "emiratesNbd": [".deal-info", ".deal-details", "h1"],
    "visaUAE": [".vs-card-content", "h1", "h2"],
    "fab": ["h1", ".offer-details", "main"],
    "adcb": ["h1", ".offer-details", "main"],
    "mashreq": ["h1", ".offer-body", "main", "article"],
    "rakBank": ["h1", "main"],
    "dib": ["h1", ".card-desc-info", "main"],
    "groupon": ["h1", "main"],
    "picodi": ["h1", ".coupon-code", "main"],
    "cuponation": ["h1", "main"],
    "generic": ["h1", "main"],
}
WAITS = {
    "emiratesNbd": ['a[href*="/deals/"]', ".deal-info", "h1"],
    "visaUAE": [".vs-card", ".vs-cards-container", "h1"],
    "fab": ["h1", "h2", ".offer", '[class*="offer"]', "main"],
    "adcb": [".offer-card", ".promo-card", "article", "main"],
    "mashreq": [".ui-card", 'a[href*="/neo/offers/"]', "main", "h1", "h2", '[class*="offer"]'],
    "rakBank": [".offer-card", ".card-offer", "article", "main"],
    "dib": [".card-list-item", ".card-title-info", ".offer-listing-sec"],
    "groupon": [".deal", '[class*="deal"]', "main", "h1"],
    "picodi": [".coupon", '[class*="coupon"]', "main", "h1"],
    "cuponation": [".coupon", ".deal", "main"],
    "generic": ["h1", "main", "article"],
}
FOLLOWED = {
    "emiratesNbd": 'a[href*="/deals/"]',
    "visaUAE": 'a[href*="/visa-offers-and-perks/"]',
    "fab": 'a[href*="offer"], a[href*="promo"]',
    "hsbc": 'a[href*="/special-offers/"]',
    "mashreq": 'a[href*="/neo/offers/"], a[href*="/offers/"]',
}
FOLLOWED_COUPONS = 'a[href*="coupon"], a[href*="deal"], a[href*="promo"], a[href*="offer"], a[href*="store"]'
FOLLOWED_BANKS = 'a[href*="offer"], a[href*="promo"], a[href*="deal"], a[href*="promotion"]'
NOT_FOLLOWED = ["/deal-search", "/login", "/sign-?in"]
NOT_FOLLOWED_OF = {"emiratesNbd": [r"/campaigns/", r"/deals/?(?:\?|#|$)"]}
COUPON_CARDS = {
    "groupon.ae": '.deal, [class*="deal-card"], [data-testid*="deal"], article',
    "cuponation.ae": '.coupon, .deal, [class*="coupon"], [class*="offer"]',
    "picodi.com": '.coupon, [class*="coupon-item"], [class*="offer-card"], .promo',
    "coupons.ae": '.coupon-item, .coupon, .deal, [class*="coupon"]',
    "wethrift.com": '.coupon, .deal, [class*="coupon"], article',
    "smiles.ae": '.offer, .deal, [class*="offer"], article',
    "noon.com": '[class*="offer"], [class*="deal"], .coupon, article',
}
ANY_COUPON_CARD = '.coupon, .deal, .offer-item, .coupon-item, [class*="coupon"], [data-coupon-code]'
SETTLE_MS, SETTLE_MS_OF = 2000, {"visaUAE": 2500}


def by_source(source_type: Column, values: dict, default) -> Column:
    """The value of a table for a source type, else the default."""
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(source_type == k, F.lit(v)).otherwise(out)
    return out


def coupon_cards(url: Column) -> Column:
    """The card selector of a coupon site's address."""
    host, out = F.regexp_replace(U.hostname(url), r"^www\.", ""), F.lit(ANY_COUPON_CARD)
    for domain, selector in reversed(COUPON_CARDS.items()):
        out = F.when((host == domain) | host.endswith(f".{domain}"), selector).otherwise(out)
    return out


def cards(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page, source_type, card, link, title, text): the cards of each page by its site's first selector that matches.

    Coupon sites have one selector by domain, other sites a list by source type. A card's link is its own or the first
    inside, its title the first heading inside, else its text. Cards inside other cards of the page are left out.
    """
    address = F.coalesce(F.col(url), F.lit(""))
    kind = F.when(U.source_type(address).isin(*D.COUPON_SOURCES), coupon_cards(address)).otherwise(U.source_type(address))
    lists = CARDS | {s: [s] for s in (*COUPON_CARDS.values(), ANY_COUPON_CARD)}
    typed = pages.select(F.struct(F.col(page).alias("id"), F.col(url).alias("url"), kind.alias("kind")).alias("_page"), F.col(html).alias("_html"))
    inside = ["a[href]", "h1, h2, h3, h4, h5, h6"]
    found = PT.hits(PT.elements(typed, "_html", "_page"), "_page", [*(s for v in lists.values() for s in v), *inside])
    found = found.withColumn("href", F.try_element_at("attrs", F.lit("href")))
    some = ["_page", "pre", "post", "href", "text"]
    spots = PT.first_of(found, "_page", lists, F.col("_page.kind"), "generic").select(*some, F.lit(0).alias("what"))
    inner = found.where(F.col("selector").isin(inside)).select(*some, F.when(F.col("tag") == "a", 1).otherwise(2).alias("what"))
    # in order of opening: what closes before an earlier card does lies inside it
    upto = Window.partitionBy("_page").orderBy("pre", "what").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    rows = spots.unionByName(inner).withColumn("_reach", F.coalesce(F.max(F.when(F.col("what") == 0, F.col("post"))).over(earlier), F.lit(-1)))
    outer = (F.col("what") == 0) & (F.col("post") > F.col("_reach"))
    rows = rows.withColumn("card", F.max(F.when(outer, F.col("pre"))).over(upto)).where(outer | (F.col("post") <= F.col("_reach")))
    first = lambda what, c: F.min_by(c, F.when((F.col("what") == what) & F.col(c).isNotNull(), F.col("pre")))
    own = rows.groupBy("_page", "card").agg(F.coalesce(first(0, "href"), first(1, "href")).alias("link"), first(2, "text").alias("heading"), F.min_by("text", F.struct("pre", "what")).alias("text"))
    link = resolve(F.col("link"), F.col("_page.url"))
    return own.select(F.col("_page.id").alias(page), U.source_type(F.col("_page.url")).alias("source_type"), "card", link.alias("link"), F.coalesce(F.nullif("heading", F.lit("")), "text").alias("title"), "text")


def followed(source_type: Column) -> Column:
    """The selector of links to follow on a source's pages."""
    other = F.when(source_type.isin(*D.COUPON_SOURCES), FOLLOWED_COUPONS).when(source_type.isin(*D.BANK_SOURCES), FOLLOWED_BANKS).otherwise("a")
    for k, v in FOLLOWED.items():
        other = F.when(source_type == k, v).otherwise(other)
    return other


def links_to_follow(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", source_type: Column | None = None) -> DataFrame:
    """(page, link): the absolute links that a page's source selector finds and no rule of exclusion names, each once."""
    kind = U.source_type(F.col(url)) if source_type is None else source_type
    selectors = [*FOLLOWED.values(), FOLLOWED_COUPONS, FOLLOWED_BANKS, "a"]
    typed = pages.select(F.struct(F.col(page).alias("id"), F.col(url).alias("url"), kind.alias("kind"), followed(kind).alias("follow")).alias("_page"), F.col(html).alias("_html"))
    found = PT.hits(PT.elements(typed, "_html", "_page"), "_page", selectors).where("selector = _page.follow")
    link = resolve(F.try_element_at("attrs", F.lit("href")), F.col("_page.url"))
    out = found.select(F.col("_page.id").alias(page), link.alias("link"), F.col("_page.kind").alias("kind")).where("link is not null")
    barred = F.lit(False)
    for pattern in NOT_FOLLOWED:
        barred = barred | T.matches(F.col("link"), pattern)
    for k, patterns in NOT_FOLLOWED_OF.items():
        for pattern in patterns:
            barred = barred | ((F.col("kind") == k) & T.matches(F.col("link"), pattern))
    return out.where(~barred).select(page, "link").distinct()


def crawler_type(mode: Column, use_browser: Column) -> Column:
    """static unless the mode, or with another mode than static the flag, asks for a browser."""
    return F.when(mode == "static", "static").when((mode == "browser") | F.coalesce(use_browser, F.lit(False)), "browser").otherwise("static")


def render_plan(url: Column, source_type: Column, page_type: Column, needs_render: Column, crawler: Column) -> Column:
    """struct(needs_browser, wait_selector, settle_ms, card_selectors, retry_with_browser) for a page."""
    browser = (crawler == "browser") | F.coalesce(needs_render, F.lit(False)) | F.coalesce(D.needs_browser(url, source_type), F.lit(False)) | F.coalesce(page_type == "shell", F.lit(False))
    waits = by_source(source_type, {k: ", ".join(v) for k, v in WAITS.items()}, ", ".join(WAITS["generic"]))
    lists = F.array(*map(F.lit, CARDS["generic"]))
    for k, v in CARDS.items():
        lists = F.when(source_type == k, F.array(*map(F.lit, v))).otherwise(lists)
    shell = CQ.script_shell(F.lit(""), F.lit(""))
    return F.struct(browser.alias("needs_browser"), waits.alias("wait_selector"), by_source(source_type, SETTLE_MS_OF, SETTLE_MS).alias("settle_ms"), lists.alias("card_selectors"), (~browser & (F.coalesce(needs_render, F.lit(False)) | F.coalesce(shell, F.lit(False)))).alias("retry_with_browser"))
