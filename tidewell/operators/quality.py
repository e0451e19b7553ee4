"""Normalising, scoring, gating and routing of offer rows, as column expressions over one table.

An offer row has the columns of `OFFER`; missing ones are added as nulls by `offers()`. All reasons a row fails for
are collected in one array; routing is a column, so one plan serves every outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import constants as C
from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.functions.keys import canonical_key, dedupe_hash, round3, snapshot_hash

OFFER = {
    "source_url": "string", "source_type": "string", "bank_name": "string", "card_name": "string", "merchant_name": "string", "offer_title": "string",
    "offer_description": "string", "discount_type": "string", "discount_value": "string", "currency": "string", "coupon_code": "string",
    "min_spend": "string", "cap_value": "string", "terms_url": "string", "valid_from": "string", "valid_to": "string", "payment_methods": "array<string>",
    "eligible_mcc_list": "array<string>", "categories": "array<string>", "stackable": "boolean", "parser_confidence": "double", "parser_name": "string",
    "page_type": "string", "crawl_depth": "int", "page_length": "int", "scraped_at": "string", "raw_text": "string", "discovery_query": "string",
    "discovery_source": "string", "serp_rank": "int", "from_discovery": "boolean",
}
# what makes a change of an offer material, and what a fuller row is judged by
SNAPSHOT = ["offer_title", "offer_description", "discount_type", "discount_value", "valid_to", "coupon_code", "merchant_name", "min_spend", "cap_value"]
FILLED = ["offer_title", "merchant_name", "discount_type", "discount_value", "valid_to", "coupon_code", "offer_description"]
KNOWN_CATEGORIES = ["bank", "network", "coupon", "merchant"]


def offers(df: DataFrame) -> DataFrame:
    """df with every offer column; other columns are kept."""
    return df.withColumns({k: (F.col(k) if k in df.columns else F.lit(None)).cast(v) for k, v in OFFER.items()})


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def body() -> Column:
    return F.concat_ws(" ", _text("offer_title"), _text("offer_description"), _text("raw_text"))


def _filled(name: str) -> Column:
    return _text(name) != ""


def garbage_title(x: Column) -> Column:
    t = T.clean_text(x)
    return (F.length(t) < 4) | T.any_of(t, C.GARBAGE_TITLES)


def has_value() -> Column:
    return _filled("discount_value")


def number(name: str) -> Column:
    return F.col(name).try_cast("double")


def normalize_offers(df: DataFrame) -> DataFrame:
    """Raw crawl rows to normalised ones; adds normalized_url."""
    df = offers(df)
    kind = F.coalesce(F.nullif(F.col("source_type"), F.lit("")), U.source_type(F.col("source_url")))
    df = df.withColumns({"normalized_url": U.normalize_url(F.col("source_url")), "source_type": kind, "offer_title": F.nullif(T.clean_text(F.col("offer_title")), F.lit("")), "offer_description": F.nullif(T.clean_text(F.col("offer_description")), F.lit(""))})
    words = F.concat_ws(" ", _text("offer_title"), _text("offer_description"))
    seen = T.once(words, lambda x: T.infer_discount(x, T.normalize_discount_type(F.col("discount_type")), F.nullif(F.col("discount_value"), F.lit(""))))
    found = T.distinct_filled(F.concat(F.coalesce("categories", F.array()), T.categories(body())))
    coupon = F.nullif(F.upper(T.clean_text(F.col("coupon_code"))), F.lit(""))
    return df.withColumns(
        {
            "discount_type": seen["type"],
            "discount_value": seen["value"],
            "bank_name": F.coalesce(T.normalize_bank(F.col("bank_name")), T.lookup(F.col("source_type"), C.BANK_BY_SOURCE)),
            "card_name": T.normalize_card(F.col("card_name")),
            "merchant_name": T.normalize_merchant(F.col("merchant_name")),
            "coupon_code": F.when(T.valid_coupon(coupon), coupon),
            "currency": T.normalize_currency(F.col("currency"), body()),
            "min_spend": T.to_number(F.col("min_spend")),
            "cap_value": T.to_number(F.col("cap_value")),
            "valid_from": T.parse_date(F.col("valid_from")).cast("string"),
            "valid_to": T.parse_date(F.col("valid_to")).cast("string"),
            "categories": found,
            "eligible_mcc_list": T.distinct_filled(F.concat(F.coalesce("eligible_mcc_list", F.array()), T.category_codes(found))),
            "payment_methods": T.distinct_filled(F.coalesce("payment_methods", F.array())),
            "stackable": F.coalesce("stackable", F.lit(False)),
            "parser_confidence": F.coalesce("parser_confidence", F.lit(0.0)),
            "crawl_depth": F.coalesce("crawl_depth", F.lit(0)),
            "page_length": F.coalesce("page_length", F.lit(0)),
        }
    )


def category_header() -> Column:
    t = T.clean_text(F.col("offer_title"))
    return (t != "") & (T.any_of(t, C.CATEGORY_TITLES) | (T.matches(t, "offers?$") & ~_filled("merchant_name") & ~F.coalesce(number("discount_value") != 0, has_value())))


def network_detail() -> Column:
    return F.coalesce((F.col("source_type") == "visaUAE") & (F.coalesce("crawl_depth", F.lit(0)) >= 1), F.lit(False)) & T.matches(T.clean_text(F.col("offer_title")), C.NETWORK_DETAIL_TITLE)


def confidence(registry: str | None = None, status: str | None = None) -> Column:
    """Additive score of a normalised row, 0 to 1; registry: column of the source's confidence, if it has a source."""
    plus = lambda cond, x: F.when(cond, F.lit(float(x))).otherwise(0.0)
    reliability = F.coalesce(T.lookup(F.col("source_type"), C.RELIABILITY), F.lit(C.DEFAULT_RELIABILITY)) * 0.2
    source = F.when(F.coalesce(F.col(registry) > 0, F.lit(False)), F.col(registry) * 0.15).otherwise(reliability) if registry else reliability
    length = F.coalesce("page_length", F.lit(0))
    score = F.lit(0.1) + source + F.least(F.lit(0.2), F.coalesce("parser_confidence", F.lit(0.0)) * 0.2)
    score = score + F.when(F.coalesce("crawl_depth", F.lit(0)) >= 1, 0.12).otherwise(0.05)
    score = score + F.when(length >= 1500, 0.08).when(length < 400, -0.1).otherwise(0.0)
    score = score + plus(F.length(_text("offer_title")) >= 6, 0.08) + plus(_filled("merchant_name"), 0.08) + plus(_filled("bank_name") | _filled("card_name"), 0.05)
    score = score + plus(_filled("discount_type"), 0.08) + plus(has_value(), 0.08) + plus(_filled("valid_to"), 0.05) + plus(_filled("coupon_code"), 0.06)
    score = score + plus(F.length(_text("offer_description")) > 40, 0.04) + plus(F.size(F.coalesce("categories", F.array())) > 0, 0.03)
    score = score + plus(T.matches(body(), C.PATTERNS["signal"]), 0.06)
    score = score + plus(category_header(), -0.2) + plus(network_detail(), -0.25) + plus(T.matches(_text("offer_title"), C.PATTERNS["help_title"]), -0.3)
    score = score + plus(T.matches(body(), C.PATTERNS["login_text"]) & ~has_value(), -0.05)
    if registry:
        score = F.when(F.col(registry).isNotNull(), blended(score, F.col(registry), F.col(status))).otherwise(score)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), round3(score)))


def blended(base: Column, registry: Column, status: Column) -> Column:
    """70 % own and 30 % the source's confidence, less for sources on probation or rejected."""
    mixed = base * 0.7 + registry * 0.3
    return round3(F.when(status == "probation", mixed * 0.92).when(status == "rejected", mixed * 0.5).otherwise(mixed))


def checkout_signal() -> Column:
    value, b = number("discount_value"), body()
    kind, merchant = F.col("discount_type"), _filled("merchant_name")
    facts = ((kind == "cashback") & (value > 1)) | (merchant & (value > 0)) | _filled("valid_to") | F.array_contains(F.coalesce("categories", F.array()), "instalment_plan") | (kind.isin("emi", "complimentary") & merchant)
    words = T.any_of(b, [C.ZERO_RATE, r"interest\s+payment\s+plan|easy\s+payment\s+plan|flexi\s+instalment", rf"{C.CURRENCIES}\s*\d+(?:[.,]\d+)?\s*cashback", r"starting\s+from\s+(?:AED|Dhs)\s*\d"])
    more = (T.matches(b, "cashback") & T.matches(b, rf"{C.CURRENCIES}\s*\d")) | (T.matches(b, r"buy\s+\d+\s+get\s+\d+|bogo|complimentary") & merchant)
    return F.coalesce(facts, F.lit(False)) | words | more


def strong_signals() -> Column:
    return has_value() | F.coalesce(T.valid_coupon(F.col("coupon_code")), F.lit(False)) | _filled("bank_name") | (_filled("merchant_name") & _filled("discount_type"))


def minimum_fields() -> Column:
    t = T.clean_text(F.col("offer_title"))
    return ((t != "") & ~garbage_title(F.col("offer_title"))) | (T.clean_text(F.col("discount_type")) != "") | F.coalesce(T.valid_coupon(F.col("coupon_code")), F.lit(False)) | (F.length(T.clean_text(F.col("merchant_name"))) >= 2) | (T.clean_text(F.col("bank_name")) != "")


def sane_date(name: str) -> Column:
    return F.coalesce(F.year(F.substring(F.col(name), 1, 10).try_cast("date")).between(2001, 2099), F.lit(False))


def absurd() -> Column:
    value = number("discount_value")
    low = lambda n: F.coalesce(number(n) < 0, F.lit(False))
    return F.coalesce((F.col("discount_type") == "percent") & (value > 100), F.lit(False)) | low("min_spend") | low("cap_value") | F.coalesce(value > 10000, F.lit(False)) | (F.coalesce(value == 1, F.lit(False)) & T.earn_rate_noise(body()))


def gate_reasons(strict: Column | None = None, score: str = "confidence") -> Column:
    """Every reason a row fails for, in a fixed order; an empty array passes."""
    strong, page = strong_signals(), F.concat_ws(" ", _text("raw_text"), _text("offer_description"))
    strict = F.lit(False) if strict is None else F.coalesce(strict, F.lit(False))
    length = F.coalesce("page_length", F.lit(0))
    bank = F.coalesce(F.col("source_type").isin(C.STRICT_SOURCES), F.lit(False))
    title = F.col("offer_title")
    rules = {
        "missing_minimum_fields": ~minimum_fields(),
        "garbage_title": _filled("offer_title") & garbage_title(title),
        "error_page": T.matches(page, C.PATTERNS["error_page"]),
        "visa_shell_page": T.matches(page, C.PATTERNS["network_shell"]),
        "invalid_coupon": _filled("coupon_code") & ~F.coalesce(T.valid_coupon(F.col("coupon_code")), F.lit(False)),
        "thin_page": (length > 0) & (length < 200) & ~strong,
        "zero_value_junk": ~(strong | (_filled("offer_title") & ~garbage_title(title))),
        "malformed_valid_to": _filled("valid_to") & ~sane_date("valid_to"),
        "malformed_valid_from": _filled("valid_from") & ~sane_date("valid_from"),
        "absurd_values": absurd(),
        "category_header": category_header() & ~strong,
        "generic_visa_detail": network_detail() & ~strong,
        "strict_missing_merchant_and_value": strict & ~_filled("merchant_name") & F.col("discount_value").isNull(),
        "strict_low_confidence": strict & (F.coalesce(F.col(score), F.lit(0.0)) < 0.35),
        "adcb_nav_noise": bank & T.nav_noise(body()),
        "touchpoints_only": bank & T.points_burn(body()) & ~F.array_contains(F.coalesce("categories", F.array()), "touchpoints_burn"),
        "bank_missing_checkout_signal": bank & ~checkout_signal() & (F.col("source_type") != "visaUAE"),
    }
    return F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules.items())), lambda r: r.isNotNull())


def source_floor(status: Column, own: Column) -> Column:
    """The confidence a source's rows need."""
    own = F.coalesce(own, F.lit(C.CONFIDENCE_FLOOR))
    return F.when(status == "rejected", 0.99).when(status == "probation", F.greatest(own, F.lit(0.45))).otherwise(own)


def source_strict(status: Column, own: Column) -> Column:
    return F.when(status == "probation", True).otherwise(F.coalesce(own, F.lit(False)))


def discovery_policy() -> Column:
    """struct(action, type, reason) from source_status, source_type, from_discovery, confidence and the offer's fields."""
    known = F.coalesce(T.lookup(F.col("source_type"), C.SOURCE_CATEGORY), F.lit("generic")).isin(KNOWN_CATEGORIES)
    discovered = F.coalesce("from_discovery", F.lit(False))
    strong = (F.col("confidence") >= 0.65) & (F.length(_text("merchant_name")) >= 2) & (has_value() | _filled("discount_type")) & _filled("parser_name")
    out = lambda action, kind, reason: F.struct(F.lit(action).alias("action"), F.lit(kind).cast("string").alias("type"), F.lit(reason).cast("string").alias("reason"))
    return (
        F.when(F.col("source_status") == "rejected", out("quarantine", "rejected_source", "rejected_source"))
        .when(F.col("source_status").isNotNull(), out("continue", None, None))
        .when(known & ~discovered, out("continue", None, None))
        .when((F.col("source_type") == "generic") & ~discovered, out("quarantine", "discovery_review", "unknown_generic_source"))
        .when(strong, out("continue", None, "auto_accepted"))
        .otherwise(out("quarantine", "discovery_review", "weak_discovery_signals"))
    )


def route(reasons: Column, score: Column, floor: Column) -> Column:
    return F.when(F.size(reasons) > 0, "quality_gate_failed").when(score < floor, "below_confidence_floor").otherwise("offers")


def quarantine_type(reasons: Column) -> Column:
    has = lambda r: F.array_contains(reasons, r)
    return F.when(has("rejected_source"), "rejected_source").when(has("invalid_schema"), "invalid_schema").when(has("below_confidence_floor"), "low_confidence").when(has("weak_discovery_signals") | has("unknown_generic_source"), "discovery_review").otherwise("quality_gate")


def with_keys(df: DataFrame) -> DataFrame:
    """Adds canonical_key, dedupe_hash and snapshot_hash."""
    url = F.coalesce(F.nullif(F.col("normalized_url"), F.lit("")), F.col("source_url"))
    key = canonical_key(url, F.col("merchant_name"), F.col("bank_name"), F.col("offer_title"), F.col("coupon_code"), F.col("discount_type"), F.col("discount_value"))
    return df.withColumns({"canonical_key": key, "dedupe_hash": dedupe_hash(url, F.col("offer_title"), F.col("coupon_code")), "snapshot_hash": snapshot_hash(*SNAPSHOT)})


def filled_fields() -> Column:
    return sum((F.when(_filled(n), 1).otherwise(0) for n in FILLED), F.lit(0))


def title_similarity(a: Column, b: Column) -> Column:
    x, y = T.slugify(a), T.slugify(b)
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).when(x.contains(y) | y.contains(x), 0.9).otherwise(0.0)


def stale_days(source_type: Column) -> Column:
    return F.coalesce(T.lookup(source_type, C.STALE_DAYS), F.lit(C.DEFAULT_STALE_DAYS))


def is_stale(last_seen: Column, source_type: Column, as_of: Column) -> Column:
    return last_seen.isNull() | (F.datediff(as_of, last_seen) > stale_days(source_type))


def valid_now(valid_to: Column, as_of: Column) -> Column:
    return F.coalesce(valid_to.try_cast("date") >= as_of.cast("date"), F.lit(True))
