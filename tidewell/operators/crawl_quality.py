"""The crawler's own rules: noise and page predicates, its score, its gate, and reasons for not emitting a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions import constants as C
from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators import quality as Q

# fixed values
COOKIE_WORDS = ["preference cookies", "HTTP Cookie", "stores the user'?s preferred language", "cookie is used to determine the preferred language", "maximum storage duration", "NameProviderPurpose"]
CHROME_TITLES = [r"^(credit cards|offers|deals|promotions|rewards|shukran)$", r"^UAE \|", r"^credit and debit card special offers$"]
MORE_CATEGORY_TITLES = [*C.CATEGORY_TITLES, "^explore the world with", "^card offers$"]
FAB_TITLES = [r"^(?:seasonal|travel|food|fashion|online|entertainment|wellness)\s+(?:&\s+\w+\s+)?offers?$", r"^0%\s*epp\b"]
FAB_LISTING = r"/credit-cards/offers(?:/[^/]+)?/?$"
#: (source, path pattern, page type), first match wins
PAGES = [
    ("emiratesNbd", r"/deals/?$", "listing"),
    ("emiratesNbd", r"/deals/[^/]+/[^/]+", "detail"),
    ("visaUAE", r"/visa-offers-and-perks/?$", "listing"),
    ("visaUAE", r"/visa-offers-and-perks/.+/\d+/?$", "detail"),
    ("fab", FAB_LISTING, "listing"),
    ("hsbc", r"/special-offers/[^/]+", "detail"),
    ("hsbc", r"/special-offers/?$", "listing"),
    ("mashreq", r"/neo/offers/?$", "listing"),
    ("mashreq", r"/neo/offers/[^/]+", "detail"),
    ("dib", r"/offers/card-offers", "listing"),
    ("dib", r"/offers/offer-detail/", "detail"),
]


def cookie_noise(x: Column) -> Column:
    t = T.clean_text(x)
    hits = sum((T.matches(t, p).cast("int") for p in COOKIE_WORDS), F.lit(0))
    return (F.length(t) >= 40) & ((hits >= 2) | T.matches(t, "preference cookies enable a website"))


def chrome_title(x: Column) -> Column:
    t = T.clean_text(x)
    return T.any_of(t, CHROME_TITLES) | ((F.length(t) > 100) & T.matches(t, "cookie|privacy policy|terms of use"))


def category_title(x: Column, source: Column) -> Column:
    t = T.clean_text(x)
    short = T.matches(t, "offers?$") & (F.length(t) < 35) & ~t.rlike(r"\d")
    return (t != "") & (T.any_of(t, MORE_CATEGORY_TITLES) | (F.coalesce(source == "fab", F.lit(False)) & T.any_of(t, FAB_TITLES)) | short)


def shell_page(text: Column, html: Column, clean: Column | None = None) -> Column:
    """clean: the text's clean_text, where it is made already."""
    n = F.length(T.clean_text(text) if clean is None else clean)
    return T.matches(text, C.PATTERNS["network_shell"]) | (T.matches(text, "oops|page not found|can't seem to find") & (n < 500)) | ((n < 400) & (F.length(F.coalesce(html, F.lit(""))) > 5000)) | (n < 80)


def script_shell(text: Column, html: Column) -> Column:
    lazy = T.matches(html, "lazy-component|ajaxrender|react-root|__NEXT_DATA__|ng-app")
    return lazy | T.matches(text, "oops|page not found|can't seem to find") | ((F.length(T.clean_text(text)) < 800) & (F.length(F.coalesce(html, F.lit(""))) > 5000))


def error_page(text: Column, clean: Column | None = None) -> Column:
    t = T.clean_text(text) if clean is None else clean
    return (T.matches(t, r"^404\b|page not found|access denied") & (F.length(t) < 800)) | (T.matches(t, r"oops!?$") & ~t.rlike(r"\d+\s*%"))


def page_type(url: Column, text: Column, html: Column, source: Column) -> Column:
    """error, then by URL and source, then shell, listing by cards, category by heading, else unknown."""
    made = F.struct(F.coalesce(U.part(url, "PATH"), F.lit("")).alias("path"), T.clean_text(text).alias("clean"))
    return T.once(made, lambda m: _page_type(text, html, source, m["path"], m["clean"]))


def _page_type(text: Column, html: Column, source: Column, path: Column, t: Column) -> Column:
    first = F.trim(F.substring_index(F.coalesce(text, F.lit("")), "\n", 1))
    out = F.when(error_page(text, t), "error")
    out = out.when((source == "fab") & T.matches(path, FAB_LISTING) & T.matches(F.coalesce(text, F.lit("")), rf"(?m){FAB_TITLES[0]}") & ~t.rlike(r"\d+\s*%"), "category")
    for kind, pattern, name in PAGES:
        out = out.when((source == kind) & T.matches(path, pattern), name)
    cards = T.matches(html, r"<article\b|class=\"[^\"]*\b(?:card|offer)\b")
    return out.when(shell_page(text, html, t), "shell").when(cards, "listing").when(T.matches(first, "offers?$") & ~t.rlike(r"\d+\s*%"), "category").otherwise("unknown")


def skipped(kind: Column) -> Column:
    return kind.isin("error", "shell", "category")


def listing_noise(merchant: Column, title: Column) -> Column:
    return T.matches(F.concat_ws(" ", merchant, title), r"amazon\.ae|dubai\s+municipality|sharjah\s+free|government")


def abroad(text: Column, url: Column) -> Column:
    both = F.concat_ws(" ", text, url)
    return T.matches(both, r"london|shard|sea\s*life|uk\b|united\s+kingdom|manchester\s+city") & ~T.matches(both, r"uae|dubai|abu\s+dhabi|sharjah|emirates")


def points_noise(x: Column) -> Column:
    t = T.clean_text(x)
    any_points = T.any_of(t, [r"mashreq\s+vantage\s+(?:reward\s+)?points", r"enjoy\s+free\s+shopping\s+with\s+mashreq\s+vantage", r"pay\s+with\s+vantage\s+points"])
    return any_points | (T.matches(t, r"vantage\s+points") & ~T.matches(t, r"(?:%\s*off|cashback|AED\s*[\d,]+)"))


def instalment_offer(text: Column, category: Column) -> Column:
    return T.matches(F.concat_ws(" ", text, category), r"easy\s+payment\s+plan|0%\s*easy\s+payment")


def meaningful() -> Column:
    c = F.col
    return (
        (F.length(T.clean_text(c("merchant_name"))) >= 2)
        | ((F.length(T.clean_text(c("offer_title"))) >= 4) & ~category_title(c("offer_title"), c("source_type")))
        | (c("discount_type").isNotNull() & c("discount_value").isNotNull())
        | F.coalesce(T.valid_coupon(c("coupon_code")), F.lit(False))
        | (T.clean_text(c("bank_name")) != "")
    )


def confidence() -> Column:
    """The crawler's score of an offer row, two decimals."""
    c, plus = F.col, (lambda cond, x: F.when(cond, F.lit(x)).otherwise(0.0))
    title, raw = F.coalesce("offer_title", F.lit("")), F.coalesce("raw_text", F.lit(""))
    sound = (title != "") & ~Q.garbage_title(title)
    score = F.lit(0.15) + F.when(sound & (F.length(title) >= 10), 0.2).when(sound, 0.1).otherwise(0.0)
    score = score + plus(F.coalesce("discount_type", F.lit("")) != "", 0.15) + plus(F.coalesce(Q.number("discount_value") > 0, F.lit(False)), 0.1)
    score = score + plus(F.coalesce("merchant_name", F.lit("")) != "", 0.1) + plus((F.coalesce("bank_name", F.lit("")) != "") | (F.coalesce("card_name", F.lit("")) != ""), 0.05)
    score = score + plus(F.length(F.coalesce("coupon_code", F.lit(""))) >= 3, 0.1) + plus(c("min_spend").isNotNull(), 0.03) + plus(c("cap_value").isNotNull(), 0.03)
    score = score + plus(F.coalesce("valid_to", F.lit("")) != "", 0.05) + plus(F.length(F.coalesce("offer_description", F.lit(""))) > 30, 0.04)
    score = score - plus(T.matches(title, "help (?:centre|center)|customer support|schedule of charges|privacy policy"), 0.3)
    score = score + plus(T.matches(raw, r"(?:cashback|%\s*off|AED\s*\d|promo code|valid until|minimum spend|cardholder)"), 0.08) - plus((raw != "") & (F.length(raw) < 500), 0.15)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.floor(score * 100 + 0.5) / 100))


def emit_reasons() -> Column:
    """Why a row is not emitted; empty if it is."""
    c = F.col
    rules = {
        "cookie_noise": cookie_noise(F.concat_ws(" ", "offer_title", "offer_description")),
        "page_chrome_title": chrome_title(c("offer_title")),
        "category_header": category_title(c("offer_title"), c("source_type")),
        "no_meaningful_fields": ~meaningful(),
        "absurd_values": Q.absurd(),
        "earn_rate_noise": T.earn_rate_noise(Q.body()),
        "nav_noise": T.nav_noise(Q.body()),
        "outside_region": F.coalesce(c("source_type") == "fab", F.lit(False)) & abroad(Q.body(), c("source_url")),
    }
    return F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules.items())), lambda r: r.isNotNull())


def dedupe_key() -> Column:
    low = lambda n: F.lower(F.coalesce(n, F.lit("")))
    return F.concat_ws("::", U.strip_query(F.coalesce("source_url", F.lit(""))), low("offer_title"), low("coupon_code"))
