"""Names as the crawler's side writes them: other alias tables and rules than the back end's in text.py."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions import constants as C
from tidewell.functions.text import clean_text, lookup, matches

# fixed values
BANK_ALIASES = C.BANK_ALIASES | {"dubai islamic bank": "Dubai Islamic Bank", "dib": "Dubai Islamic Bank", "mashreq bank": "Mashreq", "mashreq": "Mashreq"}
CARD_WORDS = [("visa infinite", "Visa Infinite"), ("visa signature", "Visa Signature"), ("visa platinum", "Visa Platinum"), ("mastercard", "Mastercard"), ("world elite", "World Elite Mastercard")]
MERCHANT_EDGES = [r"^(?:at|with|from|for)\s+", r"\s+(?:offer|deal|promotion)$"]
DISCOUNT_WORDS = [(r"cash\s*back", "cashback"), ("%|percent", "percent"), ("fixed|aed|amount", "fixed"), ("coupon|code", "coupon"), ("point|mile", "points"), ("emi|install", "emi"), ("compliment|free", "complimentary")]


def _given(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def bank_name(x: Column) -> Column:
    """By alias, else the cleaned name; null for none."""
    return F.when(_given(x).isNotNull(), F.coalesce(lookup(F.lower(clean_text(x)), BANK_ALIASES), clean_text(x)))


def card_name(x: Column) -> Column:
    """The first card whose words occur, else the cleaned name."""
    out = clean_text(x)
    for words, name in reversed(CARD_WORDS):
        out = F.when(F.contains(F.lower(clean_text(x)), F.lit(words)), name).otherwise(out)
    return F.when(_given(x).isNotNull(), out)


def merchant_name(x: Column) -> Column:
    """Without a leading "at", "with", "from" or "for" and a trailing "offer", "deal" or "promotion"."""
    out = clean_text(x)
    for edge in MERCHANT_EDGES:
        out = F.regexp_replace(out, f"(?i){edge}", "")
    return F.nullif(F.trim(out), F.lit(""))


def discount_type(x: Column) -> Column:
    """A known type as it is, else the first whose words occur, else other; null only for none."""
    out = F.lit("other")
    for pattern, kind in reversed(DISCOUNT_WORDS):
        out = F.when(matches(x, pattern), kind).otherwise(out)
    return F.when(_given(x).isNotNull(), F.when(F.lower(x).isin(C.DISCOUNT_TYPES), F.lower(x)).otherwise(out))
