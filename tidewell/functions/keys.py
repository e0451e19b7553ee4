"""Keys, hashes and roundings that must come out alike wherever they are computed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.text import plain_number


def round2(x: Column) -> Column:
    """Half up on the binary double."""
    return F.floor(x * 100 + 0.5) / 100


def round3(x: Column) -> Column:
    return F.floor(x * 1000 + 0.5) / 1000


def joined(*parts: Column) -> Column:
    return F.concat_ws("::", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def number_text(x: Column) -> Column:
    """Texts that are whole numbers with a point lose it, so that 20.0 and 20 give one key."""
    return F.coalesce(plain_number(x.try_cast("double")), x.cast("string"))


def canonical_key(url: Column, merchant: Column, bank: Column, title: Column, coupon: Column, kind: Column, value: Column) -> Column:
    return F.sha2(joined(url, F.lower(merchant), F.lower(bank), F.lower(title), F.lower(coupon), kind, number_text(value)), 256)


def dedupe_hash(url: Column, title: Column, coupon: Column) -> Column:
    return F.sha2(joined(url, F.lower(title), F.lower(coupon)), 256)


def snapshot_hash(*columns: str) -> Column:
    """Of the named columns as JSON with sorted keys; nulls are kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
