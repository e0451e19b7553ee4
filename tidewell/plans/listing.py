"""Validated list queries over the offers, quarantine and sources tables, and views of them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.url import normalize_domain
from tidewell.operators.quality import valid_now
from tidewell.operators.relational import contains, contains_any, page

TRUE, FALSE = {"true", "1", "yes"}, {"false", "0", "no"}


@dataclass
class Paged:
    """Bounds of every list: pages of 1 to 100 rows, counted from 1."""

    sort: str = ""
    order: str = "desc"
    page: int = 1
    limit: int = 20

    SORTS = ()
    NULLS_LAST = False

    def __post_init__(self):
        self.page, self.limit = int(self.page), int(self.limit)
        self.sort = self.sort or self.SORTS[0]
        if self.page < 1 or not 1 <= self.limit <= 100:
            raise ValueError("page counts from 1, limit is 1 to 100")
        if self.sort not in self.SORTS or self.order not in ("asc", "desc"):
            raise ValueError(f"sort is one of {', '.join(self.SORTS)}; order asc or desc")
        for f in fields(self):
            if f.name.startswith("confidence_") and getattr(self, f.name) is not None:
                value = float(getattr(self, f.name))
                if not 0 <= value <= 1:
                    raise ValueError(f"{f.name} is 0 to 1")
                setattr(self, f.name, value)

    def given(self, name: str):
        value = getattr(self, name)
        return None if value in (None, "") else value

    def ordering(self, tie: str) -> list[Column]:
        c = F.col(self.sort)
        if self.order == "desc":
            return [c.desc_nulls_last() if self.NULLS_LAST else c.desc_nulls_first(), F.col(tie)]
        return [c.asc_nulls_last(), F.col(tie)]

    def run(self, df: DataFrame, tie: str) -> tuple[DataFrame, DataFrame]:
        """(the page, a row with total and pages)."""
        rows = df.where(self.condition())
        total = rows.agg(F.count("*").alias("total")).withColumn("pages", F.ceil(F.col("total") / self.limit))
        return page(rows, self.ordering(tie), self.page, self.limit), total

    def condition(self) -> Column:
        out = F.lit(True)
        for c in self.conditions():
            out = out & F.coalesce(c, F.lit(False))
        return out


@dataclass
class OfferQuery(Paged):
    source_type: str | None = None
    merchant: str | None = None
    bank: str | None = None
    card: str | None = None
    coupon: str | None = None
    category: str | None = None
    freshness: str | None = None
    discovery_query: str | None = None
    confidence_min: float | None = None
    confidence_max: float | None = None
    valid_now: bool | str | None = None
    as_of: str | None = None
    q: str | None = None

    SORTS = ("last_seen_at", "confidence", "valid_to", "first_seen_at", "offer_title")

    def __post_init__(self):
        super().__post_init__()
        if isinstance(self.valid_now, str):
            if self.valid_now.lower() not in TRUE | FALSE:
                raise ValueError("valid_now is true or false")
            self.valid_now = self.valid_now.lower() in TRUE
        if self.valid_now and not self.as_of:
            raise ValueError("valid_now needs as_of, the day it is asked for")

    def conditions(self):
        g = self.given
        for name in ("source_type", "freshness"):
            if g(name):
                yield F.col(name) == g(name)
        for name, column in (("merchant", "merchant_name"), ("bank", "bank_name"), ("card", "card_name"), ("discovery_query", "discovery_query")):
            if g(name):
                yield contains(column, g(name))
        if g("coupon"):
            yield F.upper("coupon_code") == g("coupon").upper()
        if g("category"):
            yield F.exists("categories", lambda c: F.contains(F.lower(c), F.lit(g("category").lower())))
        if g("confidence_min") is not None:
            yield F.col("confidence") >= g("confidence_min")
        if g("confidence_max") is not None:
            yield F.col("confidence") <= g("confidence_max")
        if self.valid_now:
            yield valid_now(F.col("valid_to"), F.lit(self.as_of))
        if g("q"):
            yield contains_any(["offer_title", "offer_description", "merchant_name", "bank_name"], g("q"))


@dataclass
class QuarantineQuery(Paged):
    """Filters of quarantined records; run is a column of the caller's table, discovery is read from the payload."""

    run_id: str | None = None
    source_type: str | None = None
    discovery_query: str | None = None
    quarantine_type: str | None = None
    review_status: str | None = None
    url: str | None = None
    confidence_min: float | None = None
    confidence_max: float | None = None
    q: str | None = None

    SORTS = ("row_id", "confidence")

    def conditions(self):
        g = self.given
        for name in ("run_id", "source_type", "quarantine_type", "review_status"):
            if g(name):
                yield F.col(name) == g(name)
        if g("url"):
            yield contains("source_url", g("url"))
        if g("discovery_query"):
            found = F.get_json_object("payload", "$.discovery_query")
            yield F.coalesce(F.contains(F.lower(found), F.lit(g("discovery_query").lower())), F.lit(False))
        if g("confidence_min") is not None:
            yield F.col("confidence") >= g("confidence_min")
        if g("confidence_max") is not None:
            yield F.col("confidence") <= g("confidence_max")
        if g("q"):
            yield contains_any(["source_url", "payload"], g("q"))


@dataclass
class SourceQuery(Paged):
    status: str | None = None
    source_type: str | None = None
    category: str | None = None
    domain: str | None = None
    confidence_min: float | None = None
    confidence_max: float | None = None

    SORTS = ("priority", "confidence", "source_name")
    NULLS_LAST = True

    def __post_init__(self):
        super().__post_init__()
        if self.status not in (None, "", "approved", "probation", "rejected"):
            raise ValueError("status is approved, probation or rejected")

    def conditions(self):
        g = self.given
        for name in ("status", "source_type", "category"):
            if g(name):
                yield F.col(name) == g(name)
        if g("domain"):
            yield F.col("domain") == normalize_domain(F.lit(g("domain")))
        if g("confidence_min") is not None:
            yield F.col("confidence") >= g("confidence_min")
        if g("confidence_max") is not None:
            yield F.col("confidence") <= g("confidence_max")


def offers_for_payment(offers: DataFrame, merchant: str, category: str | None, as_of: str, most: int = 50) -> tuple[DataFrame, DataFrame]:
    """Fresh, valid offers of the merchant, its category, then any, each once; split into card offers and coupons."""
    from tidewell.operators.relational import union_first

    live = offers.where((F.col("freshness") == "fresh") & valid_now(F.col("valid_to"), F.lit(as_of)))
    best = [F.col("confidence").desc(), F.col("canonical_key")]
    parts = [live.where(contains("merchant_name", merchant)).orderBy(*best).limit(most)]
    if category:
        parts.append(live.where(F.array_contains("categories", category)).orderBy(*best).limit(most))
    parts += [live.orderBy(*best).limit(2 * most), live.where("coupon_code is not null").orderBy(*best).limit(most)]
    rows = union_first(parts, ["canonical_key"], best)
    return rows.where("coupon_code is null"), rows.where("coupon_code is not null")


def coupons_of(offers: DataFrame) -> DataFrame:
    """Coupon offers as coupon instruments; shares of one are taken as percents."""
    value = F.col("discount_value").try_cast("double")
    percent = F.coalesce(F.col("discount_type") != "fixed", F.lit(True))
    return offers.select(F.upper("coupon_code").alias("code"), F.when(percent, "percent").otherwise("fixed").alias("kind"), F.coalesce(F.when(percent & (value > 0) & (value <= 1), value * 100).otherwise(value), F.lit(0.0)).alias("value"), F.col("min_spend").try_cast("double").alias("min_spend"), F.col("cap_value").try_cast("double").alias("cap"), F.lit(True).alias("enabled"), (F.col("confidence") < 0.65).alias("verify"))
