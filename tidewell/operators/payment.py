"""The payment rules engine: for each request, all combinations of instruments, their economics, and the best.

A request row carries its wallet as arrays. Options are exploded within the row (with a null option where leaving an
instrument out is allowed), so the product never leaves the row's task before it is reduced; layers are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.keys import round2
from tidewell.functions.text import plain_number
from tidewell.operators.containment import containments

MAX_SHARE = 0.9  # of the amount that may be taken off


def _or0(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def loyalty_value(account: Column, amount: Column) -> Column:
    """What an account's coins are worth here; null if under a cent."""
    coins = F.least(account["balance_coins"], F.coalesce(account["max_coins"], account["balance_coins"]), amount * account["rate"])
    aed = coins / account["rate"]
    return F.when(account["enabled"] & (aed >= 0.01), round2(aed))


def coupon_value(coupon: Column, remaining: Column, original: Column) -> Column:
    raw = F.when(coupon["kind"] == "fixed", coupon["value"]).otherwise(remaining * coupon["value"] / 100)
    capped = F.least(raw, F.coalesce(coupon["cap"], raw), remaining)
    return F.when(coupon["enabled"] & (original >= F.coalesce(coupon["min_spend"], F.lit(0.0))) & (capped > 0), round2(capped))


def membership_value(percent: Column, remaining: Column) -> Column:
    value = round2(remaining * percent / 100)
    return F.when(value > 0, value)


def loyalty_earned(accounts: Column, pay: Column) -> Column:
    """Coins that each enabled account with an earn rate gains from what is paid, by program; of accounts of one program the last counts."""
    coins = F.transform(F.filter(F.coalesce(accounts, F.array()), lambda a: a["enabled"] & (a["earn_rate"] > 0) & a["program"].isNotNull()), lambda a: F.struct(a["program"].alias("program"), F.floor(pay * a["earn_rate"] + 1e-9).cast("long").alias("coins")))
    some = F.filter(coins, lambda e: e["coins"] > 0)
    return F.map_from_entries(F.filter(some, lambda e, i: ~F.exists(F.slice(some, i + 2, F.size(some)), lambda later: later["program"] == e["program"])))


def options(requests: DataFrame) -> DataFrame:
    """Every combination of a request(request_id, amount, loyalty[], coupons[], membership, cards[], banks[]).

    Cards come before banks, and within these the given order; `ord` numbers the combinations, each by a number of its
    own however many accounts and coupons there are; instrument_at is the place of its card or bank. Requests of
    `with_card_offers` give card_discount too.
    """
    usable = lambda xs, cond: F.filter(F.coalesce(xs, F.array()), cond)
    cards = usable(F.col("cards"), lambda c: c["enabled"])
    banks = usable(F.col("banks"), lambda b: b["enabled"])
    none = F.array(F.lit(None).cast("string"))
    live = usable(F.col("loyalty"), lambda a: a["enabled"] & (a["balance_coins"] > 0))
    member = F.when(F.coalesce(F.col("membership") > 0, F.lit(False)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # all lists are made once a request, below the explodes: functions with lambdas have no generated code, and would break it up
    out = requests.withColumns({"_cards": cards, "_banks": F.when(F.size(banks) > 0, F.transform(banks, lambda b: b["id"])).otherwise(none), "_l": live, "_c": usable(F.col("coupons"), lambda c: c["enabled"]), "_ms": member})
    out = out.withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("_cards") + F.size("_banks") - 1)))
    out = out.withColumn("card", F.when(F.col("_i") < F.size("_cards"), F.try_element_at("_cards", F.col("_i") + 1))).withColumn("bank_id", F.when(F.col("_i") >= F.size("_cards"), F.try_element_at("_banks", F.col("_i") - F.size("_cards") + 1)))
    if "card_discounts" in requests.columns:
        out = out.withColumn("card_discount", F.when(F.col("_i") < F.size("_cards"), F.try_element_at("card_discounts", F.col("_i")))).drop("card_discounts")
    out = out.withColumn("_j", F.explode(F.sequence(F.lit(0), F.size("_l")))).withColumn("account", F.when(F.col("_j") > 0, F.try_element_at("_l", F.greatest(F.col("_j"), F.lit(1)))))
    out = out.withColumn("_k", F.explode(F.sequence(F.lit(0), F.size("_c")))).withColumn("coupon", F.when(F.col("_k") > 0, F.try_element_at("_c", F.greatest(F.col("_k"), F.lit(1)))))
    out = out.withColumn("_m", F.explode("_ms"))
    place = (F.col("_i").cast("long") * (F.size("_l") + 1) + F.col("_j")) * (F.size("_c") + 1) + F.col("_k")
    out = out.withColumns({"ord": place * 2 + F.col("_m"), "instrument_at": F.col("_i")})
    return out.withColumn("member_percent", F.when(F.col("_m") == 1, F.col("membership"))).drop("_cards", "_banks", "_i", "_l", "_j", "_c", "_k", "_m", "_ms")


def layers(combos: DataFrame) -> DataFrame:
    """Adds the four layers, what is paid, totals and rewards to combinations (card_discount: of the best card offer), and loyalty_earned where accounts have a program and an earn rate.

    Combinations that would cost more than the amount are left out. Each step is a projection over the one before; the last goes through a generator of one row, past which no later
    filter is pushed: pushed filters would repeat all steps in each reference.
    """
    amount, df = F.col("amount"), combos
    if "card_discount" not in df.columns:
        df = df.withColumn("card_discount", F.lit(None).cast("double"))
    c = F.col
    df = df.withColumn("_l", _or0(loyalty_value(c("account"), amount)))
    df = df.withColumn("_r1", round2(amount - c("_l")))
    df = df.withColumn("_c", _or0(coupon_value(c("coupon"), c("_r1"), amount)))
    df = df.withColumn("_r2", round2(c("_r1") - c("_c")))
    df = df.withColumn("_m", _or0(membership_value(c("member_percent"), c("_r2"))))
    df = df.withColumn("_r3", round2(c("_r2") - c("_m")))
    df = df.withColumn("_o", F.when(c("card_discount").isNotNull() & c("card").isNotNull(), F.least(c("card_discount"), c("_r3"))).otherwise(0.0))
    df = df.withColumn("_r4", round2(c("_r3") - c("_o"))).withColumn("_over", F.greatest(F.lit(0.0), round2(c("_l") + c("_c") + c("_m") + c("_o") - amount * MAX_SHARE)))
    # what is over the share comes off the last layer that applied
    cut = lambda x: round2(F.greatest(F.lit(0.0), c(x) - c("_over")))
    o, m, k = c("_o") > 0, c("_m") > 0, c("_c") > 0
    df = df.withColumns(
        {
            "_l5": F.when(o | m | k, c("_l")).otherwise(cut("_l")),
            "_c5": F.when(~o & ~m & k, cut("_c")).otherwise(c("_c")),
            "_m5": F.when(~o & m, cut("_m")).otherwise(c("_m")),
            "_o5": F.when(o, cut("_o")).otherwise(c("_o")),
            "_pay": round2(F.greatest(F.lit(0.0), c("_r4") + c("_over"))),
        }
    )
    base = F.greatest(F.lit(0.0), c("_pay") - (c("_c5") + c("_m5")))
    df = df.withColumns({"_points": base * c("card")["points_rate"], "_gold": base * c("card")["gold_rate"]})
    total = round2(c("_l5") + c("_c5") + c("_m5") + c("_o5"))
    out = F.struct(
        c("_l5").alias("loyalty_aed"),
        c("_c5").alias("coupon_aed"),
        c("_m5").alias("member_aed"),
        c("_o5").alias("offer_aed"),
        c("_pay").alias("pay"),
        F.when(o, F.least(total, round2(amount * MAX_SHARE))).otherwise(total).alias("total"),
        F.floor(_or0(c("_points")) + 1e-9).alias("points"),
        round2(_or0(c("_gold"))).alias("gold_mg"),
    )
    out = df.select(*combos.columns, F.inline(F.array(out))).where(c("pay") <= amount)
    return out.withColumn("loyalty_earned", loyalty_earned(c("loyalty"), c("pay"))) if _earns(combos) else out


def _earns(df: DataFrame) -> bool:
    return "loyalty" in df.columns and {"program", "earn_rate"} <= set(df.schema["loyalty"].dataType.elementType.names)


def ranked(evaluated: DataFrame) -> DataFrame:
    """Of equal card, bank and total the first; rank by total, then enumeration."""
    same = Window.partitionBy("request_id", F.col("card.id"), "bank_id", "total").orderBy("ord")
    best = Window.partitionBy("request_id").orderBy(F.col("total").desc(), "ord")
    kept = evaluated.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")
    return kept.withColumn("rank", F.row_number().over(best))


ORDS = 1 << 22  # combinations of a request that a score tells apart


def score(total: Column, ord_: Column) -> Column:
    """One number for the order of combinations: by total in cents, of equal ones the first.

    A number so that the best is found by a hash aggregate, without sorts. A request of more than ORDS combinations, or
    a total beyond 2 * 10^10, is an error that says so.
    """
    cents = F.round(total * 100).cast("long")
    known = (ord_ < ORDS) & (F.abs(total) < 2e10)
    return F.when(known, cents * ORDS + (ORDS - 1 - ord_)).otherwise(F.raise_error(F.lit("a request has too many combinations or too large a total")).cast("long"))


def instrument_ids(requests: DataFrame) -> Column:
    """(card_id, bank_id) by instrument_at: enabled cards, then enabled banks or a single missing one."""
    pair = lambda card, bank: F.struct(card.cast("string").alias("card_id"), bank.cast("string").alias("bank_id"))
    none = F.lit(None)
    on = lambda name: F.filter(F.coalesce(F.col(name), F.array()), lambda x: x["enabled"])
    banks = F.transform(on("banks"), lambda b: pair(none, b["id"]))
    return F.concat(F.transform(on("cards"), lambda c: pair(c["id"], none)), F.when(F.size(on("banks")) > 0, banks).otherwise(F.array(pair(none, none))))


AMOUNTS = ["loyalty_aed", "coupon_aed", "member_aed", "offer_aed", "total", "pay", "points", "gold_mg"]


def best_combination(requests: DataFrame, offers: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """The best combination per request, by hash aggregates of numbers: nothing is sorted, a row per request and task moves.

    offers: card offers to choose from, valid on as_of, as `with_card_offers` takes them.
    """
    requests = requests if offers is None else with_card_offers(requests, offers, as_of)
    combos = options(requests.withColumn("_ids", instrument_ids(requests)))
    earns = _earns(combos)
    # what is the same for all combinations of a request goes along as a key; ids and coins follow from the numbers
    same = ["request_id", "amount", "_ids", *(["loyalty"] if earns else [])]
    rows = layers(combos.select(*same, *(c for c in combos.columns if c not in same and c in USED))).withColumn("_s", score(F.col("total"), F.col("ord")))
    best = rows.groupBy(*same).agg(*(F.max_by(c, "_s").alias(c) for c in (*AMOUNTS, "instrument_at")), F.count("*").alias("combinations"))
    ids = F.try_element_at("_ids", F.col("instrument_at") + 1)
    earned = loyalty_earned(F.col("loyalty"), F.col("pay")) if earns else F.create_map().cast("map<string,bigint>")
    return best.select("request_id", "amount", "combinations", ids["card_id"].alias("card_id"), ids["bank_id"].alias("bank_id"), *AMOUNTS, earned.alias("loyalty_earned"))


USED = ["ord", "instrument_at", "account", "coupon", "member_percent", "card", "bank_id", "card_discount"]


def top_combinations(requests: DataFrame, n: int = 5) -> DataFrame:
    """The n best combinations of each request with their rank; of equal card, bank and total only the first.

    Requests are dealt out by their id before they are combined: a row per request moves, and no combination. Their
    number of parts is fixed, as Spark would join small parts that are large once combined, and their sorts would spill.
    """
    parts = 4 * int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranked(layers(options(requests.repartition(parts, "request_id")))).where(F.col("rank") <= n)


def per_instrument(evaluated: DataFrame) -> DataFrame:
    """The best combination of each card and bank, and whether it is the best of all.

    A request's instruments, one row each, come together as an array; nothing is sorted.
    """
    rows = evaluated.withColumns({"instrument": F.coalesce(F.col("card.id"), F.col("bank_id"), F.lit("none")), "_s": score(F.col("total"), F.col("ord"))})
    own = rows.groupBy("request_id", "instrument").agg(F.max("_s").alias("_s"), F.max_by("total", "_s").alias("total"), F.max_by("pay", "_s").alias("pay"))
    each = own.groupBy("request_id").agg(F.collect_list(F.struct("_s", "instrument", "total", "pay")).alias("_all"))
    each = each.withColumns({"_top": F.array_max(F.transform("_all", lambda x: x["_s"])), "_x": F.explode("_all")})
    return each.select("request_id", "_x.instrument", "_x.total", "_x.pay", (F.col("_x._s") == F.col("_top")).alias("recommended"))


def offer_fits_card(offer_bank: Column, offer_card: Column, card_bank: Column, network: Column) -> Column:
    fold = lambda x: F.regexp_replace(F.lower(x), r"\s+", "")
    return F.when(offer_bank.isNotNull(), fold(offer_bank) == fold(card_bank)).otherwise(F.coalesce(F.contains(F.lower(offer_card), F.lower(network)), F.lit(False)))


def merchants_match(a: Column, b: Column) -> Column:
    fold = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "")
    return F.coalesce((fold(a) != "") & (fold(b) != "") & (F.contains(fold(a), fold(b)) | F.contains(fold(b), fold(a))), F.lit(False))


def offer_rejection(as_of: Column) -> Column:
    """The first reason a card offer doesn't apply to a card and request; null if it does.

    Over columns offer.* (categories, merchant, bank, card, mcc[], min_spend, freshness, valid_to), card.* (bank,
    network), merchant, mcc and amount.
    """
    o, c = (lambda n: F.col(f"offer.{n}")), (lambda n: F.col(f"card.{n}"))
    fold = lambda x: F.regexp_replace(F.lower(x), r"\s+", "")
    return (
        F.when(F.array_contains(F.coalesce(o("categories"), F.array()), "touchpoints_burn"), "points_burn")
        .when(o("merchant").isNull() & o("bank").isNull(), "no_merchant_or_bank")
        .when(o("bank").isNotNull() & c("bank").isNotNull() & (fold(o("bank")) != fold(c("bank"))), "bank_mismatch")
        .when(o("card").isNotNull() & c("network").isNotNull() & ~F.contains(F.lower(o("card")), F.lower(c("network"))), "network_mismatch")
        .when(o("merchant").isNotNull() & F.col("merchant").isNotNull() & ~merchants_match(o("merchant"), F.col("merchant")), "merchant_mismatch")
        .when((F.size(F.coalesce(o("mcc"), F.array())) > 0) & F.col("mcc").isNotNull() & ~F.array_contains(o("mcc"), F.col("mcc")), "mcc_mismatch")
        .when(F.col("amount") < F.coalesce(o("min_spend"), F.lit(0.0)), "min_spend")
        .when(o("freshness") == "stale", "stale")
        .when(o("valid_to") < as_of, "expired")
    )


def offer_discount(amount: Column) -> Column:
    """What offer.* (kind, value, cap) takes off the original amount; null if nothing."""
    o = lambda n: F.col(f"offer.{n}")
    raw = F.when(o("kind").isin("percent", "cashback"), amount * (o("value") / 100)).when(o("kind") == "fixed", o("value"))
    value = round2(F.least(raw, F.coalesce(o("cap"), raw), amount))
    return F.when(raw.isNotNull() & ~F.isnan(raw) & (value > 0), value)


def _containing(wholes: DataFrame, parts: DataFrame) -> DataFrame:
    """(whole, part) of texts where one contains the other, both of one column."""
    one = lambda df: df.toDF("text").withColumn("block", F.lit(1))
    return containments(one(wholes), one(parts), ["block"], "text").select(F.col("x").alias("whole"), F.col("y").alias("part"))


def with_card_offers(requests: DataFrame, offers: DataFrame, as_of: Column) -> DataFrame:
    """requests(.., merchant, mcc, cards[id, bank, network, enabled]) with card_discounts: by place among the enabled cards, the discount of the best offer.

    offers: stored offers, or the card offers of `listing.offers_for_payment`; those with a coupon code are none of
    a card. Cards meet offers by bank, or by network where an offer has no bank, and by merchant: all are equi-joins.
    """
    if as_of is None:
        raise ValueError("card offers need as_of, the day they are asked for")
    c = F.col
    text = lambda x: F.nullif(x, F.lit(""))
    number = lambda name: c(name).try_cast("double")
    squeezed = lambda x: F.regexp_replace(F.lower(x), r"\s+", "")
    plain = lambda x: F.coalesce(F.regexp_replace(F.lower(x), "[^a-z0-9]", ""), F.lit(""))
    instrument = lambda kind, x: F.concat(F.lit(kind), x)
    offer = F.struct(
        text(c("merchant_name")).alias("merchant"), text(c("bank_name")).alias("bank"), text(c("card_name")).alias("card"), c("categories").alias("categories"), c("eligible_mcc_list").alias("mcc"),
        number("min_spend").alias("min_spend"), c("freshness").alias("freshness"), c("valid_to").cast("string").try_cast("date").alias("valid_to"),
        c("discount_type").alias("kind"), number("discount_value").alias("value"), number("cap_value").alias("cap"), F.coalesce(c("confidence"), F.lit(0.0)).alias("confidence"), c("canonical_key").alias("key"),
    )
    open_offers = offers.where(F.coalesce("coupon_code", F.lit("")) == "").select(offer.alias("offer"))
    open_offers = open_offers.withColumns({"_m": plain(c("offer.merchant")), "_k": F.when(c("offer.bank").isNotNull(), instrument("bank ", squeezed(c("offer.bank")))).otherwise(instrument("card ", F.lower("offer.card")))})
    cards = requests.select("request_id", "amount", text(c("merchant")).alias("merchant"), text(c("mcc")).alias("mcc"), F.posexplode(F.filter(F.coalesce("cards", F.array()), lambda x: x["enabled"])).alias("_at", "card"))
    cards = cards.withColumns({"_own": plain(c("merchant")), "_net": F.lower("card.network")})
    own, theirs = cards.select("_own").distinct(), open_offers.select("_m").distinct()
    meets = _containing(own, theirs).toDF("_own", "_m").unionByName(_containing(theirs, own).toDF("_m", "_own")).unionByName(own.select("_own", F.lit("").alias("_m")))
    # a request without a merchant takes offers of any
    meets = meets.unionByName(theirs.select(F.lit("").alias("_own"), "_m")).distinct()
    nets = _containing(open_offers.where("offer.bank is null").select(F.lower("offer.card")), cards.select("_net")).select(c("part").alias("_net"), instrument("card ", c("whole")).alias("_k"))
    keyed = cards.where("card.bank != ''").withColumn("_k", instrument("bank ", squeezed(c("card.bank")))).unionByName(cards.join(nets, "_net"))
    found = keyed.join(meets, "_own").join(open_offers, ["_m", "_k"])
    found = found.where(offer_fits_card(c("offer.bank"), c("offer.card"), c("card.bank"), c("card.network")) & offer_rejection(as_of).isNull()).withColumn("discount", offer_discount(c("amount"))).where("discount is not null")
    best = found.groupBy("request_id", "_at").agg(F.min_by("discount", F.struct(-c("discount"), -c("offer.confidence"), "offer.key")).alias("discount"))
    by_card = best.groupBy("request_id").agg(F.map_from_entries(F.collect_list(F.struct("_at", "discount"))).alias("card_discounts"))
    return requests.join(by_card, "request_id", "left")


def merged_coupons(wallet: DataFrame, crawled: DataFrame) -> DataFrame:
    """One row per owner and upper-case code; the wallet's wins."""
    from tidewell.operators.relational import union_first

    up = lambda df: df.withColumn("code", F.upper("code"))
    return union_first([up(wallet), up(crawled)], ["owner", "code"], [F.col("value").desc()])


def reward_label(points: Column, gold: Column) -> Column:
    """What a payment earns, in words."""
    parts = F.array_compact(F.array(F.when(points > 0, F.concat(plain_number(points.cast("double")), F.lit(" points"))), F.when(gold > 0, F.concat(plain_number(gold), F.lit(" mg GOLD")))))
    return F.when(F.size(parts) > 0, F.array_join(parts, " + ")).otherwise("0 points")


def card_rewards(requests: DataFrame) -> DataFrame:
    """(request_id, card_id, points, gold_mg, label) of each card if it paid the whole amount."""
    cards = requests.select("request_id", "amount", F.explode("cards").alias("card"))
    points, gold = F.floor(_or0(F.col("amount") * F.col("card.points_rate")) + 1e-9), round2(_or0(F.col("amount") * F.col("card.gold_rate")))
    return cards.select("request_id", F.col("card.id").alias("card_id"), points.alias("points"), gold.alias("gold_mg"), reward_label(points, gold).alias("label"))


def recommended(best: DataFrame) -> DataFrame:
    """best_combination's rows with which instruments they use."""
    used = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    return best.select("request_id", used("loyalty_aed").alias("loyalty"), used("coupon_aed").alias("coupon"), used("member_aed").alias("membership"), "card_id", "bank_id")
