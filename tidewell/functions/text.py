"""Text, number, date and label expressions. All take and return columns; none fails on odd input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import constants as C


def once(x: Column, make) -> Column:
    """make of a value that is computed once per row, however often make uses it."""
    return F.element_at(F.transform(F.array(x), make), 1)


def step(df: DataFrame, **values: Column) -> DataFrame:
    """df with further columns that are made once a row.

    Columns made by a projection may be made again in every filter and column that uses them; those of an inline are not.
    """
    return df.select("*", F.inline(F.array(F.struct(*(v.alias(k) for k, v in values.items())))))


def matches(x: Column, pattern: str) -> Column:
    """Case-insensitive search; null texts don't match."""
    return F.coalesce(x.rlike(f"(?i){pattern}"), F.lit(False))


def any_of(x: Column, patterns: list[str]) -> Column:
    return matches(x, "(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, trimmed; null without a match."""
    return F.when(matches(x, pattern), F.trim(F.regexp_extract(x, f"(?i){pattern}", group)))


def all_found(x: Column, pattern: str, group: int = 1) -> Column:
    return F.filter(F.transform(F.coalesce(F.regexp_extract_all(x, F.lit(f"(?i){pattern}"), group), F.array()), F.trim), lambda v: v != "")


def lookup(x: Column, table: dict) -> Column:
    """The table's value for x, else null."""
    pairs = [F.lit(v) for k, val in table.items() for v in (k, val)]
    return F.create_map(*pairs)[x] if pairs else F.lit(None)


def clean_text(x: Column) -> Column:
    """White space of any kind as single spaces, trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)[\s ]+", " "))


def literal_references(html: Column, read: str = "lt|gt|amp") -> Column:
    """Markup in which only the references named, each with its semicolon, stand for characters; any other is text as it is written."""
    return F.regexp_replace(html, f"&(?!(?:{read});)", "&amp;")


def slugify(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(clean_text(x)), "[^a-z0-9]+", "-"), "^-|-$", "")


def to_number(x: Column) -> Column:
    """The number that the digits and points of a text begin with; signs are not kept."""
    kept = F.regexp_replace(x.cast("string"), r"[^0-9.]", "")
    return F.regexp_extract(kept, r"^(\d+\.?\d*|\.\d+)", 1).try_cast("double")


def find_currency(x: Column) -> Column:
    return F.when(matches(x, "AED|Dhs|dirham"), "AED").when(matches(x, r"USD|\$|US\s*dollar"), "USD").when(matches(x, "EUR|€"), "EUR")


def normalize_currency(given: Column, text: Column) -> Column:
    return F.coalesce(F.nullif(given, F.lit("")), find_currency(text), F.lit("AED"))


def parse_date(x: Column) -> Column:
    """Day-first numeric dates, ISO dates and dates with month names; else null. Years after 2000."""
    t = F.regexp_replace(clean_text(x), r"(?i)(\d{1,2})(st|nd|rd|th)\b", "$1")
    t = F.regexp_replace(t, ",", " ")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    numeric = F.when(t.rlike(r"^\d{1,2}[/.\-]\d{1,2}[/.\-]\d{4}$"), F.try_to_timestamp(F.regexp_replace(t, "[/.]", "-"), F.lit("d-M-yyyy")).cast("date"))
    named = F.initcap(t)
    formats = ["yyyy-MM-dd", "d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy/MM/dd"]
    tries = [F.try_to_timestamp(named, F.lit(f)).cast("date") for f in formats]
    stamp = F.when(t.rlike(r"^\d{4}-\d\d-\d\dT"), F.substring(t, 1, 10).try_cast("date"))
    late = lambda d: F.when(F.year(d) > 2000, d)
    return F.coalesce(numeric, *(late(d) for d in [stamp, *tries]))


def normalize_bank(x: Column) -> Column:
    return F.nullif(F.coalesce(lookup(F.lower(clean_text(x)), C.BANK_ALIASES), clean_text(x)), F.lit(""))


def normalize_card(x: Column) -> Column:
    return F.nullif(F.coalesce(lookup(F.lower(clean_text(x)), C.CARD_ALIASES), clean_text(x)), F.lit(""))


def normalize_merchant(x: Column) -> Column:
    t = clean_text(x)
    return F.when((F.length(t) >= 2) & ~matches(t, C.NOT_MERCHANTS), t)


def normalize_discount_type(x: Column) -> Column:
    return F.when(F.lower(x).isin(C.DISCOUNT_TYPES), F.lower(x))


def labels(x: Column, table: dict[str, str]) -> Column:
    """The keys whose pattern occurs, in the table's order."""
    return F.filter(F.array(*(F.when(matches(x, p), F.lit(k)) for k, p in table.items())), lambda k: k.isNotNull())


def categories(x: Column) -> Column:
    return labels(x, C.CATEGORY_WORDS)


def page_categories(x: Column) -> Column:
    return labels(x, C.PAGE_CATEGORY_WORDS)


def category_codes(names: Column) -> Column:
    """Merchant category codes of category names, each once, in order."""
    table = F.create_map(*(v for k, codes in C.CATEGORY_CODES.items() for v in (F.lit(k), F.array(*map(F.lit, codes)))))
    return F.array_distinct(F.flatten(F.filter(F.transform(names, lambda c: table[F.lower(c)]), lambda a: a.isNotNull())))


def distinct_filled(xs: Column) -> Column:
    return F.array_distinct(F.filter(xs, lambda v: v.isNotNull() & (v != "")))


def valid_coupon(x: Column) -> Column:
    c = F.upper(clean_text(x))
    return c.rlike("^[A-Z][A-Z0-9_-]{3,19}$") & ~c.isin(C.NOT_COUPONS) & (c.rlike("[0-9]") | (F.length(c) >= 6))


def fixed_amount(x: Column) -> Column:
    raw = F.coalesce(found(x, C.PATTERNS["fixed"]), found(x, C.PATTERNS["fixed_off"]))
    return plain_number(F.regexp_replace(raw, ",", "").try_cast("double"))


def plain_number(x: Column) -> Column:
    """A number as text, whole numbers without a point."""
    whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
    return F.when(whole, x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def detect_discount(x: Column) -> Column:
    """struct(type, value) by the first rule that holds; both null if none does."""
    p = C.PATTERNS
    pair = lambda kind, value: F.struct(F.lit(kind).cast("string").alias("type"), value.cast("string").alias("value"))
    none = F.lit(None).cast("string")
    cash = F.coalesce(found(x, p["cashback"]), found(x, p["foreign_cashback"]), fixed_amount(x), found(x, p["percent"]))
    percent = F.coalesce(found(x, p["percent_off"]), found(x, p["percent"]))
    return (
        F.when(matches(x, p["instalment"]) & ~matches(x, r"(?:\d+\s*%|cashback)"), pair(None, none))
        .when(matches(x, p["cashback_any"]), pair("cashback", cash))
        .when(percent.isNotNull(), pair("percent", percent))
        .when(fixed_amount(x).isNotNull(), pair("fixed", fixed_amount(x)))
        .when(matches(x, p["starting"]), pair("fixed", F.regexp_replace(found(x, p["starting"]), ",", "")))
        .when(matches(x, C.ZERO_RATE), pair("emi", F.lit("0%")))
        .when(matches(x, p["complimentary"]), pair("complimentary", none))
        .when(matches(x, p["emi"]), pair("emi", found(x, p["emi"], 0)))
        .when(matches(x, p["points"]), pair("points", F.regexp_replace(found(x, p["points"]), ",", "")))
        .when(matches(x, p["coupon"]), pair("coupon", none))
        .otherwise(pair(None, none))
    )


def infer_discount(x: Column, kind: Column, value: Column) -> Column:
    """struct(type, value): given ones if the value is positive, else those that the text tells."""
    t = F.trim(F.coalesce(x, F.lit("")))
    cash = rf"{C.CURRENCIES}\s*(\d+(?:[.,]\d+)?)\s*cashback"
    pair = lambda k, v: F.struct(k.cast("string").alias("type"), v.cast("string").alias("value"))
    given = F.coalesce(value.try_cast("double") > 0, F.lit(False)) | (t == "")
    number = lambda v: plain_number(F.regexp_replace(v, ",", "").try_cast("double"))
    percent = r"(\d{1,2})\s*%\s*(?:off|interest|epp|discount)?"
    return (
        F.when(given, pair(kind, value))
        .when(matches(t, cash), pair(F.lit("cashback"), number(found(t, cash))))
        .when(matches(t, C.PATTERNS["starting"]), pair(F.coalesce(kind, F.lit("fixed")), number(found(t, C.PATTERNS["starting"]))))
        .when(matches(t, C.ZERO_RATE), pair(F.lit("emi"), F.coalesce(value, F.lit("0%"))))
        .when(matches(t, percent) & (kind.isNull() | (kind == "percent")), pair(F.lit("percent"), number(found(t, percent))))
        .otherwise(pair(kind, value))
    )


def stackable(x: Column) -> Column:
    return F.when(matches(x, r"cannot be combined|not (?:be )?combin|not valid with|not stackable"), False).otherwise(matches(x, r"can be combined|stackable|combine with"))


def payment_methods(x: Column) -> Column:
    """Labels of the cards that a text names."""
    kinds = F.array_distinct(F.transform(F.coalesce(F.regexp_extract_all(x, F.lit(r"(?i)(credit\s+card|debit\s+card|prepaid\s+card|mastercard|visa\s+infinite|visa\s+signature)"), 1), F.array()), payment_label))
    more = [F.when(matches(x, r"emirates\s*nbd|enbd"), "Emirates NBD Card"), F.when(matches(x, r"\bfab\b|first\s+abu\s+dhabi"), "FAB Card"), F.when(matches(x, r"\bvisa\b") & ~matches(x, r"visa\s+(?:infinite|signature|platinum)"), "Visa"), F.when(matches(x, r"\bmastercard\b"), "Mastercard")]
    return distinct_filled(F.concat(kinds, F.array(*more)))


def payment_label(x: Column) -> Column:
    low = F.lower(x)
    out = F.when(low.contains("credit"), "Credit Card").when(low.contains("debit"), "Debit Card").when(low.contains("prepaid"), "Prepaid Card")
    return out.when(low.contains("infinite"), "Visa Infinite").when(low.contains("signature"), "Visa Signature").when(low.contains("mastercard"), "Mastercard").otherwise(x)


def earn_rate_noise(x: Column) -> Column:
    each = matches(x, r"every\s+aed\s*1\s+spent")
    return (matches(x, r"bonus\s+touchpoint") & each) | matches(x, r"earn\s+\d+\s+bonus\s+touchpoint") | (matches(x, r"for\s+every\s+aed\s*1\s+spent") & ~matches(x, r"(?:%\s*off|cashback)"))


def nav_noise(x: Column) -> Column:
    return any_of(x, [r"adcb\s+logo\s+facebook", r"refer\s+(?:a\s+friend|your\s+friends)", r"touchpoints\s+max"])


def points_burn(x: Column) -> Column:
    return matches(x, r"pay\s+with\s+touchpoints|convert\s+\d[\d,]*\s*touchpoints")
