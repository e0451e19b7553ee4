"""What single sites add to the common page plan: hints in addresses, rows per cashback tier or shop, result pages.

The rules are rows of the tables below; one expression applies them, so a further site is a further row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators import crawl_quality as CQ
from tidewell.operators import discovery as D
from tidewell.operators import page_tree as PT

# fixed values
#: (source, pattern on the last part of the path, discount type, value or None for what the pattern captures); first match wins
SLUG_DISCOUNTS = [
    ("hsbc", r"buy-one-get-one|bogo", "percent", "50"),
    ("hsbc", r"complimentary-(\d{1,2})-month", "fixed", None),
    ("hsbc", r"(\d+)gb-free", "fixed", None),
    ("hsbc", r"-(\d{1,2})-off-", "percent", None),
    ("hsbc", r"-(\d{1,2})-discount", "percent", None),
    ("hsbc", r"-(\d{1,2})-percent-off", "percent", None),
    ("hsbc", r"save-with-a-(\d{1,2})-discount", "percent", None),
    ("fab", r"(\d{1,2})-percent-off", "percent", None),
    ("fab", r"-(\d{1,2})-off", "percent", None),
    ("fab", r"discount-(\d{1,2})", "percent", None),
]
INSTALMENT_SLUG = r"flexi-instalment|instalment-plans?-on-purchases"
SLUG_DATE = r"-(\d{2}-\d{2}-\d{4})/?$"
YEAR_END = r"(?:valid\s+until|year\s+of)\s*(\d{4})"
TIER = r"(?i)(?:up\s+to\s+)?AED\s*([\d,]+)\s*(?:cash[\s-]*back)?"
BENEFIT = r"(\d{1,2})\s*%|AED\s*[\d,]+|cash[\s-]*back"
SHOPS = r"(?i)(\d{1,2})\s*%\s*(?:cash[\s-]*back\s+)?at\s+([^.]+?)(?:\s+and\s+up\s+to|\s+and\s+|\.\s|$)"
PERCENT_OFF = r"(\d{1,2})\s*%\s*(?:off|discount)"
CARD_NAME = "Mashreq Card"
FAB_WORDS = r"^(?:off|fab|uae|offer)$"
TIER_URL, CARD_URL = r"/early-bird-cashback", r"/cards/(?:credit|debit)-cards/[^/]+"


def slug(url: Column) -> Column:
    """The last part of a URL's path."""
    return F.coalesce(F.try_element_at(F.filter(F.split(U.part(url, "PATH"), "/"), lambda p: p != ""), F.lit(-1)), F.lit(""))


def slug_hints(url: Column, source: Column) -> Column:
    """struct(type, value, merchant, until, instalment) that an address tells of its offer; nulls where it tells nothing."""
    s = slug(url)
    pair = lambda kind, value: F.struct(F.lit(kind).cast("string").alias("type"), value.cast("string").alias("value"))
    found = None
    for site, pattern, kind, value in SLUG_DISCOUNTS:
        cond = (source == site) & T.matches(s, pattern)
        out = pair(kind, F.lit(value) if value else F.regexp_replace(F.regexp_extract(s, f"(?i){pattern}", 1), "^0+(?=.)", ""))
        found = F.when(cond, out) if found is None else found.when(cond, out)
    first = F.regexp_extract(s, "^([^-]*)", 1)
    # of words in small letters or other, the first letter becomes a capital and the rest stays
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000))
    words = F.filter(F.split(F.regexp_replace(F.regexp_replace(s, r"(?i)-discount.*$", ""), r"-\d+$", ""), "-"), lambda p: (F.length(p) > 2) & ~T.matches(p, FAB_WORDS))
    merchant = F.when((source == "hsbc") & (F.length(first) >= 3), capital(first)).when((source == "fab") & (F.size(words) > 0), F.array_join(F.transform(words, capital), " "))
    until = F.when(source == "hsbc", F.try_to_timestamp(F.nullif(F.regexp_extract(s, SLUG_DATE, 1), F.lit("")), F.lit("dd-MM-yyyy")).cast("date"))
    return F.struct(found["type"].alias("type"), found["value"].alias("value"), merchant.alias("merchant"), until.alias("until"), ((source == "hsbc") & T.matches(s, INSTALMENT_SLUG)).alias("instalment"))


def year_end(x: Column) -> Column:
    """The last day of a year that a text names as the end."""
    year = F.nullif(F.regexp_extract(x, f"(?i){YEAR_END}", 1), F.lit(""))
    return F.concat(year, F.lit("-12-31")).try_cast("date")


def tags(x: Column, source: Column, instalment: Column) -> Column:
    """Categories that the source's rules add to an offer's own."""
    burn = F.when((source == "adcb") & T.points_burn(x), "touchpoints_burn").when(source == "adcb", "merchant_discount")
    return F.array_compact(F.array(burn, F.when(instalment, "instalment_plan")))


def tiers(url: Column, source: Column, title: Column, text: Column) -> Column:
    """A page's different amounts of cashback: array of struct(tier (AED), tier_title); null for pages of other kinds."""
    here = (source == "mashreq") & T.matches(url, TIER_URL)
    amounts = F.transform(F.regexp_extract_all(text, F.lit(TIER), 1), lambda a: F.regexp_replace(a, ",", "").try_cast("bigint"))
    named = lambda a: F.concat(title, F.lit(" — AED "), F.format_number(a, 0), F.lit(" cashback"))
    return F.when(here, F.transform(F.array_distinct(F.filter(amounts, lambda a: a > 1)), lambda a: F.struct(a.alias("tier"), named(a).alias("tier_title"))))


def tier_rows(pages: DataFrame) -> DataFrame:
    """pages(page_url, source_type, title, text, ..) with a row per different amount of cashback: tier (AED), tier_title."""
    return pages.select("*", F.inline(tiers(F.col("page_url"), F.col("source_type"), F.col("title"), F.col("text"))))


def benefits(url: Column, source: Column, html: Column) -> Column:
    """The benefits of a card's page, each title once: array of struct(snippet, shop, shop_title); null for pages of other kinds.

    A line with "n% at A, B" gives a row per shop, up to the first "and"; one with "n% off" a row of its own, titled by the
    line or, if that is long, by the card, for the shop that it or the card's name tells. Others give none.
    """
    from tidewell.operators.site_offers import merchant_in_title

    here = (source == "mashreq") & T.matches(url, CARD_URL)
    plain = lambda x: T.clean_text(F.regexp_replace(x, "<[^>]*>", " "))
    lines = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<(li|p|h3|h4)\b[^>]*>(.*?)</\1>"), 2), plain)
    card = F.coalesce(F.nullif(plain(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)), F.lit("")), F.lit(CARD_NAME))

    def of_line(x: Column, card: Column) -> Column:
        share, off = (F.nullif(F.regexp_extract(x, p, 1), F.lit("")) for p in (SHOPS, f"(?i){PERCENT_OFF}"))
        names = F.transform(F.split(F.regexp_extract(x, SHOPS, 2), r"(?i),\s*and\s+|,\s*|\s+and\s+"), T.clean_text)
        row = lambda shop, title: F.struct(x.alias("snippet"), shop.alias("shop"), title.alias("shop_title"))
        shops = F.transform(F.filter(names, lambda n: F.length(n).between(2, 40)), lambda n: row(n, F.concat(share, F.lit("% cashback at "), n)))
        title = F.when(F.length(x) <= 120, x).otherwise(F.concat(off, F.lit("% off — "), card))
        percent = F.array(row(F.coalesce(merchant_in_title(x), merchant_in_title(card), card), title))
        return F.coalesce(F.when(share.isNotNull(), shops).when(off.isNotNull(), percent), F.slice(percent, 1, 0))

    kept = F.filter(lines, lambda x: F.length(x).between(12, 300) & T.matches(x, BENEFIT) & ~CQ.points_noise(x))
    found = T.once(card, lambda c: F.flatten(F.transform(kept, lambda x: of_line(x, c))))
    first = lambda rows: F.filter(rows, lambda r, i: F.array_position(F.transform(rows, lambda o: o["shop_title"]), r["shop_title"]) == i + 1)
    return F.when(here, T.once(found, first))


def benefit_rows(pages: DataFrame) -> DataFrame:
    """pages(page_url, source_type, html, ..) of cards with their lines' benefits: shop, shop_title, snippet; see benefits()."""
    rows = pages.select("*", F.inline(benefits(F.col("page_url"), F.col("source_type"), F.col("html"))))
    return rows.dropDuplicates(["page_url", "shop_title"])


RESULT_BLOCKS = "#search .g, div[data-hveid] .g, .MjjYud"
RESULT_LINKS = 'a[href^="/url?"], a[href^="http"]'
SNIPPETS = ".VwiC3b, .st, [data-sncf]"


def _results(rows: DataFrame, most: int) -> DataFrame:
    """Rows (_page, query, offset, _at, href, title, snippet) as results: good ones, each URL of a page once, ranked."""
    plain = lambda x: D.search_text(F.regexp_replace(x, "<[^>]*>", " "))
    # a character reference is the only one that links hold as a rule
    rows = rows.select("_page", "query", "offset", "_at", U.normalize_url(D.result_url(F.regexp_replace("href", "&amp;", "&"))).alias("url"), plain(F.col("title")).alias("title"), F.substring(plain(F.coalesce("snippet", F.lit(""))), 1, 300).alias("snippet"))
    good = (F.col("url") != "") & ~D.blocked_host(U.hostname(F.col("url"))) & ~T.matches(F.col("url"), D.BLOCKED_PATH) & (F.length("title") >= 3)
    rows = rows.where(F.coalesce(good, F.lit(False)))
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_page", "url").orderBy("_at"))).where("_n = 1").drop("_n")
    ranked = first.withColumn("_n", F.row_number().over(Window.partitionBy("_page").orderBy("_at"))).where(F.col("_n") <= most)
    return ranked.select("_page", "url", "title", "snippet", "query", F.lit("google").alias("source"), (F.coalesce("offset", F.lit(0)) + F.col("_n")).cast("int").alias("rank"))


def _paged(results: DataFrame) -> DataFrame:
    return results.withColumn("_page", F.sha2(F.concat_ws("|", "query", "offset", "html"), 256))


def block_rows(results: DataFrame, most: int = 10) -> DataFrame:
    """Results of pages (html, query, offset) by their result blocks, and the page's key.

    A block's result is its first link; its title is the headings inside the link, else the link's text, its snippet the
    first snippet element, else the text of its spans outside headings. Blocks within blocks are blocks too.
    """
    pages = _paged(results).select(F.struct("_page", "query", "offset").alias("_key"), "html")
    kinds = {"block": RESULT_BLOCKS, "link": RESULT_LINKS, "heading": "a h3", "snippet": SNIPPETS, "span": "span", "headed": "h3 span"}
    found = PT.hits(PT.elements(pages, "html", "_key"), "_key", list(kinds.values()))
    of = lambda kind: F.col("selector") == kinds[kind]
    blocks = found.where(of("block")).select("_key", F.col("pre").alias("_at"), F.col("post").alias("_end"))
    inside = found.where(~of("block")).join(blocks, "_key").where((F.col("pre") > F.col("_at")) & (F.col("post") < F.col("_end")))
    spot = F.struct("pre", "post", "text", F.try_element_at("attrs", F.lit("href")).alias("href"))
    gathered = inside.groupBy("_key", "_at").agg(F.min(F.when(of("link"), spot)).alias("link"), F.min(F.when(of("snippet"), spot)).alias("snippet"), *(F.sort_array(F.collect_list(F.when(of(k), spot))).alias(k) for k in ("heading", "span", "headed")))
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: x["text"]), "")
    titles = F.filter("heading", lambda h: (h["pre"] > F.col("link.pre")) & (h["post"] < F.col("link.post")))
    spans = F.filter("span", lambda s: ~F.exists("headed", lambda h: h["pre"] == s["pre"]))
    snippet = F.coalesce(F.nullif(F.col("snippet.text"), F.lit("")), joined(spans))
    rows = gathered.where("link is not null").select("_key.*", "_at", F.col("link.href").alias("href"), F.coalesce(F.nullif(joined(titles), F.lit("")), F.col("link.text")).alias("title"), snippet.alias("snippet"))
    return _results(rows, most)


def search_results(results: DataFrame, most: int = 10) -> DataFrame:
    """Results by blocks; of pages that have none that way, links with headings."""
    blocks = block_rows(results, most)
    rest = _paged(results).join(blocks.select("_page").distinct(), "_page", "left_anti")
    return blocks.drop("_page").unionByName(result_rows(rest, most))


def result_rows(results: DataFrame, most: int = 10) -> DataFrame:
    """Rows of result pages (html, query, offset): url, title, snippet, query, source, rank; blocked and repeated links are left out.

    A result is a link with a heading; its snippet is the text after it up to the next one. Ranks count what is kept, from
    the page's offset on, up to `most`.
    """
    item = r'(?is)<a\b[^>]*href="([^"]+)"[^>]*>(?:(?!</a>).)*?<h3[^>]*>(.*?)</h3>.*?</a>((?:(?!<a\b).)*)'
    part = lambda g: F.regexp_extract_all("html", F.lit(item), F.lit(g))
    rows = _paged(results).select("_page", "query", "offset", F.posexplode(F.arrays_zip(part(1).alias("href"), part(2).alias("title"), part(3).alias("snippet"))).alias("_at", "r")).select("_page", "query", "offset", "_at", "r.*")
    return _results(rows, most).drop("_page")
