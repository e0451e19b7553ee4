"""URL expressions. Malformed URLs give null or the documented fallback, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions import constants as C
from tidewell.functions.text import matches


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def hostname(url: Column) -> Column:
    return F.lower(part(url, "HOST"))


def domain(url: Column) -> Column:
    """Host without www; texts that are no URL are taken as a host themselves."""
    bare = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z]+://)?([^/?#]*)", 1)
    return F.regexp_replace(F.coalesce(hostname(url), bare), r"^www\.", "")


def normalize_domain(x: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(x)), r"^www\.", "")


def base_url(url: Column) -> Column:
    return F.concat(part(url, "PROTOCOL"), F.lit("://"), hostname(url), F.coalesce(F.nullif(part(url, "PATH"), F.lit("")), F.lit("/")))


def belongs_to(url: Column, site: Column) -> Column:
    d, s = domain(url), normalize_domain(site)
    return F.coalesce((d == s) | d.endswith(F.concat(F.lit("."), s)), F.lit(False))


def allowed(url: Column, domains: Column) -> Column:
    """Host is one of the domains or below one; an empty list allows all."""
    return (F.size(domains) == 0) | F.exists(domains, lambda d: belongs_to(url, d))


def normalize_url(url: Column) -> Column:
    """Lower case, without fragment, tracking parameters and a final slash of the path; null is empty."""
    params = F.split(part(url, "QUERY"), "&")
    kept = F.array_join(F.filter(params, lambda p: (p != "") & ~F.lower(F.element_at(F.split(p, "="), 1)).isin(C.TRACKING_PARAMS)), "&")
    path = F.coalesce(F.nullif(part(url, "PATH"), F.lit("")), F.lit("/"))
    whole = F.concat(part(url, "PROTOCOL"), F.lit("://"), part(url, "AUTHORITY"), path, F.when(F.coalesce(kept, F.lit("")) != "", F.concat(F.lit("?"), kept)).otherwise(""))
    trimmed = F.when(whole.endswith("/") & (path != "/"), F.regexp_replace(whole, "/$", "")).otherwise(whole)
    plain = F.regexp_extract(F.lower(url), r"^[^#?]*", 0)
    return F.when(F.coalesce(url, F.lit("")) == "", "").otherwise(F.coalesce(F.lower(trimmed), plain))


def strip_query(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^[^#?]*", 0)


def discovery_keys(url: Column) -> Column:
    """Up to three lookup keys of a URL: as it is, normalised, host and path."""
    whole = F.concat(hostname(url), F.lower(F.coalesce(part(url, "PATH"), F.lit(""))))
    return F.array_distinct(F.filter(F.array(url, normalize_url(url), F.regexp_replace(whole, "/$", "")), lambda k: k.isNotNull() & (k != "")))


def source_type(url: Column) -> Column:
    """The kind of source that a URL belongs to, by the first rule that matches."""
    low = F.lower(F.coalesce(url, F.lit("")))
    first, *rest = C.SOURCE_BY_URL
    out = F.when(matches(low, first[0]), first[1])
    for pattern, name in rest:
        out = out.when(matches(low, pattern), name)
    return out.otherwise("generic")


def empty_path(url: Column) -> Column:
    return F.coalesce(part(url, "PATH"), F.lit("")).rlike(r"^/?(?:index\.[a-z]+)?$")


def is_pdf(url: Column) -> Column:
    return matches(url, r"\.pdf(?:[?#]|$)")
