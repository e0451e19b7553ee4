"""Wallets, merchants and checkout: instruments per user, look-ups, changes, and a session's recommendation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import clean_text
from tidewell.operators import payment as P
from tidewell.operators.relational import contains, merge

# fixed values
PROGRAMS = {"abc loyalty rewards": "abc_loyalty", "abc rewards": "abc_loyalty", "smiles": "smiles", "adib miles": "adib_miles", "etihad guest": "etihad_guest", "skywards": "skywards", "enbd rewards": "enbd_rewards"}
NETWORKS = {"visa": "Visa", "mastercard": "Mastercard", "master card": "Mastercard", "mc": "Mastercard", "amex": "Amex", "american express": "Amex"}
BANKS = {"adcb": "ADCB", "adcb bank": "ADCB", "fab": "First Abu Dhabi Bank", "first abu dhabi bank": "First Abu Dhabi Bank", "emirates nbd": "Emirates NBD", "enbd": "Emirates NBD", "mashreq": "Mashreq", "mashreq bank": "Mashreq", "rak bank": "RAK Bank", "rakbank": "RAK Bank", "cbd": "CBD", "hsbc": "HSBC", "citibank": "Citibank", "citi": "Citibank"}


def positive(x: Column) -> Column:
    v = x.try_cast("double")
    return F.coalesce(F.when((v >= 0) & ~F.isnan(v) & (v < float("inf")), v), F.lit(0.0))


def instruments(users: DataFrame, loyalty: DataFrame, cards: DataFrame, banks: DataFrame, coupons: DataFrame, memberships: DataFrame) -> DataFrame:
    """A row per user with arrays of its instruments, as the rules engine takes them.

    Each array is gathered by its own aggregate; a user's instruments are few by nature.
    """
    gather = lambda df, name, *fields: df.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
    e = F.coalesce("enabled", F.lit(True)).alias("enabled")
    parts = [
        gather(loyalty, "loyalty", "program", positive(F.col("balance_coins")).alias("balance_coins"), F.col("max_coins").try_cast("double").alias("max_coins"), F.coalesce(F.nullif(positive(F.col("rate")), F.lit(0.0)), F.lit(100.0)).alias("rate"), e, (positive(F.col("earn_rate")) if "earn_rate" in loyalty.columns else F.lit(0.0)).alias("earn_rate")),
        gather(cards, "cards", "id", "bank", network(F.col("network")).alias("network"), positive(F.col("points_rate")).alias("points_rate"), positive(F.col("gold_rate")).alias("gold_rate"), e),
        gather(banks.where("id is not null"), "banks", "id", "bank", e),
        gather(coupons.where(F.coalesce("code", F.lit("")) != ""), "coupons", F.upper("code").alias("code"), discount_kind(F.col("kind")).alias("kind"), positive(F.col("value")).alias("value"), F.col("min_spend").try_cast("double").alias("min_spend"), F.col("cap").try_cast("double").alias("cap"), e),
        memberships.groupBy("user_id").agg(F.max(F.when(F.coalesce("enabled", F.lit(True)), positive(F.col("percent")))).alias("membership")),
    ]
    out = users.select("user_id")
    for p in parts:
        out = out.join(p, "user_id", "left")
    return out


def _known(x: Column, table: dict) -> Column:
    from tidewell.functions.text import lookup

    return lookup(F.lower(F.trim(x)), table)


def bank(x: Column) -> Column:
    """A bank by its usual name; others as they are, spaces evened."""
    return F.coalesce(_known(clean_text(x), BANKS), F.nullif(clean_text(x), F.lit("")))


def network(x: Column) -> Column:
    return F.coalesce(_known(clean_text(x), NETWORKS), F.nullif(clean_text(x), F.lit("")))


def tier(x: Column) -> Column:
    """A membership's tier, in capitals."""
    return F.nullif(F.upper(clean_text(x)), F.lit(""))


def program(x: Column) -> Column:
    return F.coalesce(_known(x, PROGRAMS), F.regexp_replace(F.lower(F.trim(x)), r"\s+", "_"))


def discount_kind(x: Column) -> Column:
    low = F.lower(F.coalesce(x, F.lit("")))
    return F.when(F.contains(low, F.lit("fix")) | F.contains(low, F.lit("flat")), "fixed").when(F.contains(low, F.lit("cashback")), "cashback").otherwise("percent")


def preferred_methods(local: DataFrame, remote: DataFrame, key: str, arrays: list[str]) -> DataFrame:
    """Per key the remote arrays where they have rows, else the local ones."""
    r = remote.select(key, *(F.col(a).alias(f"_{a}") for a in arrays))
    pick = {a: F.when(F.size(F.coalesce(f"_{a}", F.array())) > 0, F.col(f"_{a}")).otherwise(F.col(a)) for a in arrays}
    return local.join(r, key, "left").withColumns(pick).drop(*(f"_{a}" for a in arrays))


def add_cards(cards: DataFrame, new: DataFrame, products: DataFrame) -> DataFrame:
    """cards with new ones, whose rates are their product's if it is known."""
    p = products.select(F.col("product_id"), F.col("points_rate").alias("_p"), F.col("gold_rate").alias("_g"))
    rated = new.join(p, "product_id", "left").withColumns({"points_rate": F.coalesce("_p", "points_rate", F.lit(0.0)), "gold_rate": F.coalesce("_g", "gold_rate", F.lit(0.0))}).drop("_p", "_g")
    return cards.unionByName(rated, allowMissingColumns=True)


def upsert_coupons(coupons: DataFrame, new: DataFrame) -> DataFrame:
    up = lambda df: df.withColumn("code", F.upper("code"))
    columns = [c for c in coupons.columns if c not in ("user_id", "code")]
    return merge(up(coupons), up(new), ["user_id", "code"], columns, F.lit(True))


def replace_for_users(rows: DataFrame, new: DataFrame, key: str = "user_id") -> DataFrame:
    """All rows of the users in new are replaced by these."""
    return rows.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def delete_owned(rows: DataFrame, gone: DataFrame, keys: tuple[str, ...] = ("user_id", "id")) -> DataFrame:
    """rows without those whose owner and id are in gone."""
    return rows.join(gone.select(*keys), list(keys), "left_anti")


def register_merchants(merchants: DataFrame, aliases: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merchants and aliases with new(name, category, mcc, aliases[]); a known alias stays with its merchant."""
    fresh = new.withColumn("merchant_id", F.sha2(F.lower("name"), 256)).withColumn("qr_code", F.substring(F.sha2(F.concat(F.lit("qr"), F.lower("name")), 256), 1, 16))
    known = merchants.unionByName(fresh.drop("aliases").join(merchants.select("merchant_id"), "merchant_id", "left_anti"), allowMissingColumns=True)
    more = fresh.select("merchant_id", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array())))).alias("alias"))
    more = more.groupBy(F.lower("alias").alias("alias")).agg(F.min("merchant_id").alias("merchant_id"))
    return known, aliases.unionByName(more.join(aliases.select("alias"), "alias", "left_anti").select(aliases.columns))


def merchant_names(merchants: DataFrame, aliases: DataFrame, term: str) -> DataFrame:
    """Every name a merchant that matches the term is known by, the term included."""
    hit = merchants.join(aliases, "merchant_id", "left").where(contains("name", term) | contains("alias", term))
    names = hit.select(F.explode(F.array("name", "alias")).alias("name")).where("name is not null")
    return names.unionByName(names.sparkSession.range(1).select(F.lit(term).alias("name"))).distinct()


def session_requests(sessions: DataFrame, wallets: DataFrame) -> DataFrame:
    """Open sessions as requests: the share of coins in use, the chosen card and coupon (else the first coupon only), the merchant and mcc if sessions have them."""
    df = sessions.where("status = 'open'").join(wallets, "user_id")
    share = F.least(F.greatest(F.coalesce("loyalty_percent", F.lit(100)), F.lit(0)), F.lit(100)) / 100
    loyalty = F.transform("loyalty", lambda a: a.withField("balance_coins", F.floor(a["balance_coins"] * share).cast("double")))
    chosen = F.filter("coupons", lambda c: c["code"] == F.upper("coupon_code"))
    coupons = F.when(F.coalesce("use_coupons", F.lit(True)), F.when(F.col("coupon_code").isNotNull(), chosen).otherwise(F.slice("coupons", 1, 1))).otherwise(F.slice("coupons", 1, 0))
    cards = F.when(F.col("card_id").isNotNull(), F.filter("cards", lambda c: c["id"] == F.col("card_id"))).otherwise(F.col("cards"))
    member = F.when(F.coalesce("use_membership", F.lit(True)), F.col("membership"))
    return df.select(F.col("session_id").alias("request_id"), F.col("amount").cast("double").alias("amount"), loyalty.alias("loyalty"), coupons.alias("coupons"), member.alias("membership"), cards.alias("cards"), "banks", *((F.col(x) if x in sessions.columns else F.lit(None).cast("string")).alias(x) for x in ("merchant", "mcc")))


def confirmed(sessions: DataFrame, wallets: DataFrame, offers: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Open sessions with what their best combination takes off, card offers on as_of included, leaves to pay and earns."""
    best = P.best_combination(session_requests(sessions, wallets), offers, as_of)
    return best.select(F.col("request_id").alias("session_id"), F.lit("confirmed").alias("status"), F.col("amount").alias("gross_amount"), F.col("pay").alias("net_amount"), "loyalty_aed", "coupon_aed", F.col("member_aed").alias("membership_aed"), "offer_aed", "loyalty_earned")


def explanation(best: DataFrame) -> DataFrame:
    """A sentence per request on its best combination."""
    text = F.format_string("Pay %.2f instead of %.2f and save %.2f (loyalty %.2f, coupon %.2f, membership %.2f), earning %d points.", "pay", "amount", "total", "loyalty_aed", "coupon_aed", "member_aed", "points")
    return best.withColumn("explanation", text)


def parse_answer(x: Column, schema: str = "bestIndex int, reason string") -> Column:
    """The JSON object in a free text, from its first to its last brace; null if there is none."""
    return F.from_json(F.regexp_extract(x, r"(?s)\{.*\}", 0), schema)


def new_sessions(asked: DataFrame, merchants: DataFrame) -> DataFrame:
    """Open sessions for asked(session_id, user_id, merchant_id, amount, currency, session_type) of known merchants with an amount."""
    df = asked.where(F.col("merchant_id").isNotNull() & (F.col("amount") > 0)).join(merchants.select("merchant_id"), "merchant_id", "left_semi")
    return df.select("session_id", "user_id", "merchant_id", "amount", F.coalesce("currency", F.lit("AED")).alias("currency"), F.coalesce("session_type", F.lit("online")).alias("session_type"), F.lit("open").alias("status"))


def patched_sessions(sessions: DataFrame, patches: DataFrame, columns: list[str]) -> DataFrame:
    """sessions with what patches(session_id, user_id, columns) set; nulls leave a value, and only the owner's patches count."""
    p = patches.select(F.col("session_id"), F.col("user_id"), *(F.col(c).alias(f"_{c}") for c in columns))
    return sessions.join(p, ["session_id", "user_id"], "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).select(sessions.columns)


def backfilled(rows: DataFrame, value: str = "amount", columns: tuple[str, ...] = ("gross_amount", "net_amount")) -> DataFrame:
    """Missing amounts take the value; given ones stay."""
    return rows.withColumns({c: F.coalesce(c, value) for c in columns})


def add_banks(banks: DataFrame, new: DataFrame) -> DataFrame:
    """banks with new(user_id, id, bank, enabled): known ids of a user stay, names are the usual ones."""
    rows = new.where("id is not null").withColumn("bank", bank(F.col("bank"))).withColumn("enabled", F.coalesce("enabled", F.lit(True)))
    return banks.unionByName(rows.select(banks.columns).join(banks, ["user_id", "id"], "left_anti").select(banks.columns))
