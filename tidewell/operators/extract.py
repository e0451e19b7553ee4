"""Fields of raw pages by expressions: title, meta tags, links, structured data and text without boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text as T
from tidewell.functions import url as U

HIDDEN = "script|style|nav|footer|header|noscript|svg|form|iframe"


def title(html: Column) -> Column:
    return F.nullif(T.clean_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def meta(html: Column, name: str) -> Column:
    """The content of a meta tag by name or property, whichever way round its attributes are."""
    a = F.regexp_extract(html, rf"(?is)<meta[^>]*(?:name|property)=\"{name}\"[^>]*content=\"([^\"]*)\"", 1)
    b = F.regexp_extract(html, rf"(?is)<meta[^>]*content=\"([^\"]*)\"[^>]*(?:name|property)=\"{name}\"", 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def links(html: Column) -> Column:
    """The targets of all anchors, in page order."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*href=\"([^\"#]*)"), 1)


def resolve(href: Column, base: Column) -> Column:
    """A link's absolute URL; null for other schemes."""
    origin = F.concat(U.part(base, "PROTOCOL"), F.lit("://"), U.part(base, "AUTHORITY"))
    folder = F.concat(origin, F.coalesce(F.regexp_extract(F.concat(U.part(base, "PATH"), F.lit("")), "^(.*/)", 1), F.lit("/")))
    return F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("//"), F.concat(U.part(base, "PROTOCOL"), F.lit(":"), href)).when(href.startswith("/"), F.concat(origin, href)).when(href.rlike("^[a-zA-Z]+:"), None).otherwise(F.concat(folder, href))


def visible_text(html: Column) -> Column:
    """Text without tags, comments and the parts that hold no content."""
    t = F.regexp_replace(html, rf"(?is)<({HIDDEN})\b[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " ")
    return T.clean_text(t)


def json_ld(html: Column) -> Column:
    """The page's structured data as an array of JSON texts; broken ones are left out."""
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    return F.filter(raw, lambda x: F.try_parse_json(x).isNotNull())


def _list(x: Column) -> Column:
    """The items of a JSON text as JSON texts; one that is no list is the only item of its own. Empty if it can't be read."""
    whole = F.when(F.ltrim(x).startswith("["), x).otherwise(F.concat(F.lit("["), x, F.lit("]")))
    return F.coalesce(F.from_json(whole, "array<string>"), F.array().cast("array<string>"))


def structured_offers(html: Column) -> Column:
    """A page's structured offers in order, nested ones included: array of struct(offer_title, offer_description, price, currency, valid_to, offer_url)."""
    get = lambda x, path: F.get_json_object(x, path)
    of = lambda i: F.when(get(i, "$['@type']") == "Offer", F.array(i)).otherwise(_list(get(i, "$.offers")))

    def fields(i: Column, o: Column) -> Column:
        pick = lambda *paths: F.coalesce(*(get(o, f"$.{p}") for p in paths))
        return F.struct(F.coalesce(pick("name"), get(i, "$.name")).alias("offer_title"), pick("description").alias("offer_description"), pick("price").alias("price"), pick("priceCurrency").alias("currency"), pick("validThrough", "priceValidUntil").alias("valid_to"), pick("url").alias("offer_url"))

    items = F.flatten(F.transform(json_ld(html), _list))
    return F.flatten(F.transform(items, lambda i: F.transform(of(i), lambda o: fields(i, o))))


def json_ld_offers(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per structured offer of a page, nested ones included, with its usual fields."""
    return pages.select("*", F.inline(structured_offers(F.col(html))))


def page_type(url: Column, text: Column, html: Column) -> Column:
    """error, listing, detail, shell, category or unknown, by the first rule that holds."""
    length = F.length(F.coalesce(text, F.lit("")))
    return (
        F.when(T.matches(text, r"404 not found|page not found|can't seem to find the page|access denied") & (length < 2000), "error")
        .when(T.matches(url, r"/(?:offers?|deals?|promotions?)/?(?:[?#]|$)"), "listing")
        .when(T.matches(url, r"/(?:offers?|deals?|promotions?)/[^/?#]+"), "detail")
        .when((length < 200) & (F.length(F.coalesce(html, F.lit(""))) > 5000), "shell")
        .when(T.matches(F.substring(text, 1, 80), r"^[^.]{0,60}offers?\b"), "category")
        .otherwise("unknown")
    )


def frontier(pages: DataFrame, url: str, html: str, depth: int, most: int, known: DataFrame | None = None, source: Column | None = None) -> DataFrame:
    """The next pages to read: (url, depth + 1), each once, none beyond the greatest depth and none read before.

    known(url): pages read before, besides the given ones. source: the type of source that each page belongs to; if
    given, only links that its rules allow are followed.
    """
    from tidewell.operators.discovery import enqueue

    if depth >= most:
        return pages.select(F.col(url).alias("url"), F.lit(depth).alias("depth")).limit(0)
    kind = F.lit("generic") if source is None else source
    found = pages.select(F.col(url).alias("_b"), kind.alias("_s"), F.explode(links(F.col(html))).alias("_h"))
    found = found.select(U.normalize_url(resolve(F.col("_h"), F.col("_b"))).alias("url"), "_s").where("url != ''")
    if source is not None:
        found = found.where(enqueue(F.col("url"), F.col("_s"), F.lit(depth + 1))["enqueue"])
    read = pages.select(U.normalize_url(F.col(url)).alias("url"))
    if known is not None:
        read = read.unionByName(known.select(U.normalize_url(F.col("url")).alias("url")))
    return found.select("url").distinct().join(read.distinct(), "url", "left_anti").withColumn("depth", F.lit(depth + 1))
