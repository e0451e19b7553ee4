import json
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tidewell.operators import health as H
from tidewell.operators import payment as P
from tidewell.operators import quality as Q
from tidewell.operators import relational as R
from tidewell.operators import wallet as W
from tidewell.plans import ingestion as I
from tidewell.sources import crawl
from tidewell.streaming.ingest import apply_batch, offers_table, stream

GOOD = {"sourceUrl": "https://www.adcb.com/offers/x?utm_source=a", "sourceType": "adcb", "offerTitle": "20% off at Carrefour", "merchantName": "Carrefour", "discountType": "percent", "discountValue": 20, "validTo": "31/12/2027", "confidence": 0.8, "pageLength": 2000, "crawlDepth": 1, "scrapedAt": "2026-01-01T00:00:00Z", "parserName": "adcb"}


@pytest.fixture(scope="module")
def registry(spark):
    return crawl.registry(spark, rows=[("ADCB", "adcb.com", "https://adcb.com", "adcb", "bank", "approved", 5, 0.8, 0.45, True), ("ADCB 2", "adcb.com", "https://adcb.com", "adcb", "bank", "probation", 9, 0.1, 0.45, True), ("Bad", "bad.com", "https://bad.com", "couponFeed", "coupon", "rejected", 1, 0.2, None, False)])


def write(folder, records):
    folder.mkdir(exist_ok=True)
    for name, r in records.items():
        (folder / f"{name}.json").write_text(r if isinstance(r, str) else json.dumps(r))
    return str(folder)


def rows_of(spark, records, registry, tmp_path):
    return I.evaluated(crawl.crawl_records(spark, write(tmp_path / "in", records)), registry)


CASES = {
    "good": (GOOD, "offers", []),
    "no_url": ({**GOOD, "sourceUrl": None}, "quarantine", ["invalid_schema"]),
    "broken": ("{oops", "quarantine", ["invalid_schema"]),
    "absurd": ({**GOOD, "discountValue": 150}, "quarantine", ["absurd_values"]),
    "generic": ({**GOOD, "sourceType": "generic", "sourceUrl": "https://blog.example.com/p"}, "quarantine", ["unknown_generic_source"]),
    "rejected": ({**GOOD, "sourceType": "couponFeed"}, "quarantine", ["rejected_source"]),
    "header": ({**GOOD, "sourceType": "groupon", "offerTitle": "Seasonal Offers", "merchantName": None, "discountType": None, "discountValue": None}, "quarantine", ["category_header"]),
    "months": ({**GOOD, "discountType": "emi", "discountValue": "6 months"}, "offers", []),
}


def test_routes(spark, registry, tmp_path):
    rows = rows_of(spark, {k: r for k, (r, _, _) in CASES.items()}, registry, tmp_path)
    got = {r.file.rsplit("/", 1)[1][:-5]: (r.route, r.reasons) for r in rows.select("file", "route", "reasons").collect()}
    assert got == {k: (route, reasons) for k, (_, route, reasons) in CASES.items()}
    stats = I.run_stats(rows).first()
    assert (stats.total, stats.accepted) == (8, 2) and sum(stats.by_type.values()) == 6
    again = I.replay(I.quarantined(rows), registry)
    assert again.where("route = 'offers'").count() == 0 and again.count() == 6


def test_upsert_and_snapshots(spark, registry, tmp_path):
    seen = lambda day: F.lit(f"2026-01-0{day}").cast("timestamp")
    (tmp_path / "1").mkdir()
    first = rows_of(spark, {"a": GOOD, "b": {**GOOD, "offerTitle": "30% off at Lulu", "merchantName": "Lulu", "discountValue": 30}}, registry, tmp_path / "1")
    empty = I.preferred(first).withColumns({"first_seen_at": seen(1), "last_seen_at": seen(1), "freshness": F.lit("fresh")}).limit(0)
    one = I.upsert(empty, first, seen(1))
    assert {r.action for r in one.collect()} == {"inserted"} and one.count() == 2
    (tmp_path / "2").mkdir()
    second = rows_of(spark, {"a": {**GOOD, "validTo": "31/12/2028"}}, registry, tmp_path / "2")
    two = I.upsert(one.drop("action"), second, seen(2))
    got = {r.merchant_name: (r.action, r.valid_to, str(r.first_seen_at)[:10], str(r.last_seen_at)[:10]) for r in two.collect()}
    assert got == {"Carrefour": ("updated", "2028-12-31", "2026-01-01", "2026-01-02"), "Lulu": ("kept", "2027-12-31", "2026-01-01", "2026-01-01")}
    assert I.snapshots(two, seen(2)).count() == 1
    stale = I.mark_stale(two.drop("action"), F.lit("2026-01-16").cast("date"))
    assert {r.merchant_name: r.freshness for r in stale.collect()} == {"Carrefour": "fresh", "Lulu": "stale"}


def test_likely_duplicates_are_merged(spark, registry, tmp_path):
    """By host, merchant, bank and title, or by URL, title and coupon: into the stored offer, one row per offer."""
    seen = lambda day: F.lit(f"2026-01-0{day}").cast("timestamp")
    for n in "12":
        (tmp_path / n).mkdir()
    no_shop = {**GOOD, "sourceUrl": "https://www.adcb.com/offers/z", "offerTitle": "15% cashback on fuel", "merchantName": None, "discountType": "cashback", "discountValue": 15}
    first = rows_of(spark, {"a": GOOD, "b": {**GOOD, "offerTitle": "30% off at Lulu", "merchantName": "Lulu", "discountValue": 30}, "c": no_shop}, registry, tmp_path / "1").persist()
    empty = I.preferred(first).withColumns({"first_seen_at": seen(1), "last_seen_at": seen(1), "freshness": F.lit("fresh")}).limit(0)
    one = I.upsert(empty, first, seen(1)).drop("action").persist()
    assert one.count() == 3
    other = {**GOOD, "sourceUrl": "https://www.adcb.com/offers/y", "offerTitle": "20% off at Carrefour this week"}
    batch = {"longer": other, "again": {**other, "sourceUrl": "https://www.adcb.com/offers/w"}, "value": {**no_shop, "discountValue": 16}, "host": {**other, "sourceUrl": "https://shop.adcb.com/offers/y"}, "shop": {**other, "merchantName": "Ikea"}}
    two = I.upsert(one, rows_of(spark, batch, registry, tmp_path / "2").persist(), seen(2)).persist()
    old = {r.canonical_key for r in one.collect()}
    # "shop" has the page of "longer" and goes with it; which of the two gives the name depends on their files' names
    assert sorted(((r.merchant_name or "").replace("Ikea", "Carrefour"), r.action, r.canonical_key in old) for r in two.collect()) == [("", "updated", True), ("Carrefour", "inserted", False), ("Carrefour", "updated", True), ("Lulu", "kept", True)]


def test_chains_of_duplicates_within_a_batch_are_one_offer(spark, registry, tmp_path):
    """A is like B and B like C, though A is not like C; D has only the page of C; E is of another shop."""
    seen = F.lit("2026-01-01").cast("timestamp")
    for n in "12":
        (tmp_path / n).mkdir()
    at = lambda n, title, **more: {**GOOD, "sourceUrl": f"https://www.adcb.com/offers/{n}", "offerTitle": title, **more}
    batch = {"a": at(1, "20% off at Carrefour this week only"), "b": at(2, "20% off at Carrefour"), "c": at(3, "Get 20% off at Carrefour"), "d": at(3, "Get 20% off at Carrefour", merchantName="Carrefour UAE", offerDescription="the fullest row of all"), "e": at(4, "20% off at Carrefour", merchantName="Ikea")}
    rows = rows_of(spark, batch, registry, tmp_path / "1").persist()
    assert rows.where("route = 'offers'").select("canonical_key").distinct().count() == 5
    empty = I.preferred(rows).withColumns({"first_seen_at": seen, "last_seen_at": seen, "freshness": F.lit("fresh")}).limit(0)
    one = I.upsert(empty, rows, seen).persist()
    got = sorted((r.merchant_name, r.offer_description, r.action) for r in one.collect())
    assert got == [("Carrefour UAE", "the fullest row of all", "inserted"), ("Ikea", None, "inserted")]
    # what comes later goes with its group into the stored offer; a stored key stays with its own offer
    late = {"x": at(9, "20% off at Carrefour on Mondays", merchantName="Carrefour UAE"), "y": at(8, "Get 20% off at Carrefour on Mondays", merchantName="Carrefour UAE"), "e": batch["e"]}
    two = I.upsert(one.drop("action"), rows_of(spark, late, registry, tmp_path / "2"), seen).collect()
    assert sorted(r.canonical_key for r in two) == sorted(r.canonical_key for r in one.collect())


def test_stream_equals_batch(spark, registry, tmp_path):
    records = {k: r for k, (r, _, _) in CASES.items()}
    folder = write(tmp_path / "in", records)
    stream(spark, folder, registry, str(tmp_path / "out")).awaitTermination()
    batch = I.evaluated(crawl.crawl_records(spark, folder), registry).checkpoint()
    none = offers_table(spark, str(tmp_path / "none")).read()
    keys = lambda df: sorted(r.canonical_key for r in df.select("canonical_key").collect())
    assert keys(offers_table(spark, str(tmp_path / "out")).read()) == keys(I.upsert(none, batch.where("route = 'offers'"), F.lit(None).cast("timestamp")))
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 6
    write(tmp_path / "in", {"more": {**GOOD, "offerTitle": "A new one at Carrefour"}})
    stream(spark, folder, registry, str(tmp_path / "out")).awaitTermination()
    assert offers_table(spark, str(tmp_path / "out")).read().count() == 2


def test_a_batch_that_runs_again_changes_nothing(spark, registry, tmp_path):
    out = str(tmp_path / "out")
    batch = lambda n, records: crawl.crawl_records(spark, write(tmp_path / f"in{n}", records))
    apply_batch(batch(0, {"a": GOOD}), registry, out, 0)
    second = batch(1, {"a": {**GOOD, "offerDescription": "now with a description"}})
    apply_batch(second, registry, out, 1)
    log = lambda: sorted(tuple(r) for r in spark.read.parquet(f"{out}/snapshots").collect())
    table = lambda: sorted(map(repr, offers_table(spark, out).read().collect()))
    before = log(), table()
    assert len(before[0]) == 1 and "now with" in before[0][0][2]
    apply_batch(second, registry, out, 1)
    assert (log(), table()) == before


def test_promotion(spark, registry, tmp_path):
    """What passes now becomes an offer and is reviewed; what fails stays; unknown ids are told."""
    from tidewell.plans.listing import QuarantineQuery

    rejected = crawl.registry(spark, rows=[("ADCB", "adcb.com", "https://adcb.com", "adcb", "bank", "rejected", 5, 0.1, 0.99, True)])
    rows = I.evaluated(crawl.crawl_records(spark, write(tmp_path / "in", {"a": {**GOOD, "discoveryQuery": "best Cafés"}, "b": {**GOOD, "discountValue": 150}})), rejected).checkpoint()
    held = I.quarantined(rows).checkpoint()
    assert held.count() == 2
    ids = held.select("row_id").unionByName(spark.createDataFrame([("unknown",)], "row_id string"))
    none = offers_table(spark, str(tmp_path / "none")).read()
    offers, after, outcomes = I.promoted(held, ids, registry, none, F.lit("2026-01-01").cast("timestamp"))
    assert sorted((r.outcome, r.reasons) for r in outcomes.collect()) == [("not_found", None), ("promoted", None), ("still_fails_gate", ["absurd_values"])]
    assert [r.action for r in offers.collect()] == ["inserted"] and sorted(r.review_status for r in after.collect()) == ["pending", "promoted"]
    found = lambda **f: held.where(reduce(lambda a, b: a & b, QuarantineQuery(**f).conditions())).count()
    assert (found(discovery_query="cafés"), found(discovery_query="x"), found(source_type="adcb")) == (1, 0, 2)


def test_a_file_delivered_twice_counts_once(spark, registry, tmp_path):
    folder = write(tmp_path / "in", {"a": GOOD, "copy": GOOD, "list": [{**GOOD, "offerTitle": "30% off at Lulu", "merchantName": "Lulu"}, {**GOOD, "discountValue": 150}]})
    run = lambda: stream(spark, folder, registry, str(tmp_path / "out")).awaitTermination()
    run()
    table, log = offers_table(spark, str(tmp_path / "out")), lambda: spark.read.parquet(str(tmp_path / "out/quarantine")).count()
    assert table.read().count() == 2 and log() == 1
    before = sorted(map(repr, table.read().collect()))
    write(tmp_path / "in", {"again": {**GOOD}, "list-again": [{**GOOD, "offerTitle": "30% off at Lulu", "merchantName": "Lulu"}, {**GOOD, "discountValue": 150}]})
    run()
    assert sorted(map(repr, table.read().collect())) == before and log() == 1


def test_bytes_written_follow_the_batch(spark, registry, tmp_path):
    """Two hosts; a batch of one leaves the other's buckets alone, and readers find the table whatever a batch left."""
    out, table = str(tmp_path / "out"), offers_table(spark, str(tmp_path / "out"))
    other = {**GOOD, "sourceUrl": "https://offers.bankfab.com/a", "bankName": "FAB"}
    apply_batch(crawl.crawl_records(spark, write(tmp_path / "in0", {"a": GOOD, "b": other})), registry, out, 0)
    first = {(b, n) for b, n, _ in table.folders()}
    assert table.read().count() == 2 and {n for _, n in first} == {0}
    apply_batch(crawl.crawl_records(spark, write(tmp_path / "in1", {"b": {**other, "offerDescription": "more"}})), registry, out, 1)
    new = {(b, n) for b, n, _ in table.folders()} - first
    assert len(new) == 1 and table.read().count() == 2 and table.done() == [0, 1]
    old = sorted(r.offer_description or "" for r in table.read(upto=0).collect())
    assert old == ["", ""] and sorted(r.offer_description or "" for r in table.read().collect()) == ["", "more"]
    # a batch that stopped before it was done is not seen, and is written over when it runs again
    table.read().limit(0).unionByName(table.read().withColumn("offer_title", F.lit("half"))).withColumns({"bucket": table.bucket(), "batch": F.lit(2)}).write.partitionBy("bucket", "batch").mode("append").parquet(table.path)
    assert table.read().where("offer_title = 'half'").count() == 0


def test_material_changes(spark, registry, tmp_path):
    """A description or coupon makes a change, another spelling of the bank none; of equal scores the fuller row stays."""
    rows = rows_of(spark, {"a": GOOD, "b": {**GOOD, "offerDescription": "more of it"}, "c": {**GOOD, "couponCode": "SAVE20"}, "d": {**GOOD, "bankName": "Other Bank", "cardName": "Gold"}}, registry, tmp_path)
    got = {r.file.rsplit("/", 1)[1][0]: (r.snapshot_hash, r.filled) for r in rows.withColumn("filled", Q.filled_fields()).collect()}
    assert len({got[x][0] for x in "abc"}) == 3 and got["d"][0] == got["a"][0]
    assert [got[x][1] for x in "abcd"] == [5, 6, 6, 5]


def test_reviews_by_content(spark, registry, tmp_path):
    bad = {**GOOD, "discountValue": 150}
    for n in "12":
        (tmp_path / n).mkdir()
    one = I.quarantined(rows_of(spark, {"a": bad}, registry, tmp_path / "1"))
    two = I.quarantined(rows_of(spark, {"a": {**bad, "offerTitle": "Another deal"}}, registry, tmp_path / "2"))
    both = one.unionByName(two)
    ids = [r.row_id for r in both.collect()]
    assert len(set(ids)) == 2 and ids[0] == one.first().row_id
    decided = I.reviewed(both, spark.createDataFrame([(ids[0], "rejected", "ann")], "row_id string, status string, by string"))
    again = I.reviewed(decided, spark.createDataFrame([(ids[1], "promoted", "bob")], "row_id string, status string, by string"))
    assert {r.row_id: (r.review_status, r.reviewed_by) for r in again.collect()} == {ids[0]: ("rejected", "ann"), ids[1]: ("promoted", "bob")}


def test_likely_duplicates_of_many_rows_and_clashing_names(spark):
    df = spark.range(300).selectExpr("id AS a", "'h' AS b", "if(id % 2 = 0, 'Ferrari World', 'ferrari  world') AS m", "cast(null AS string) AS bank", "concat('deal ', id % 3) AS t", "if(id < 2, 'k', null) AS k")
    pairs = R.likely_duplicates(df, "a", "b", "m", "bank", "t", ["k"])
    assert pairs.count() == 3 * (100 * 99 // 2) + 1


def test_frontier_knows_what_was_read(spark):
    from tidewell.operators import extract as X

    page = '<a href="/offers/a">a</a> <a href="/offers/b">b</a> <a href="https://x.com/login">l</a> <a href="/">home</a>'
    pages = spark.createDataFrame([("https://x.com/", page)], "url string, html string")
    urls = lambda df: sorted(r.url for r in df.collect())
    assert urls(X.frontier(pages, "url", "html", 0, 2)) == ["https://x.com/login", "https://x.com/offers/a", "https://x.com/offers/b"]
    known = spark.createDataFrame([("https://X.com/offers/a/?utm_source=z",)], "url string")
    assert urls(X.frontier(pages, "url", "html", 0, 2, known, F.lit("generic"))) == ["https://x.com/offers/b"]
    assert X.frontier(pages, "url", "html", 2, 2).count() == 0


def test_discovery(spark, registry, tmp_path):
    path = tmp_path / "found.json"
    path.write_text(json.dumps({"results": [{"url": "https://www.adcb.com/offers/x", "discoveryQuery": "q1", "serpRank": 3}, {"url": "https://www.adcb.com/offers/x/", "query": "q2", "rank": 1}]}))
    found = crawl.discovery_results(spark, str(path))
    assert found.count() == 2 and crawl.discovery_results(spark, str(tmp_path / "none.json")).count() == 0
    raw = crawl.crawl_records(spark, write(tmp_path / "in", {"a": GOOD}))
    row = I.evaluated(raw, registry, found).first()
    assert (row.discovery_query, row.serp_rank, row.from_discovery) == ("q2", 1, True)


def test_sources(spark, registry, tmp_path):
    index = {r.source_type: (r.status, r.source_name) for r in crawl.source_index(registry).collect()}
    assert index == {"adcb": ("approved", "ADCB"), "couponFeed": ("rejected", "Bad")}
    assert [r.source_name for r in crawl.crawl_plan(registry).collect()] == ["ADCB 2", "ADCB"]
    assert crawl.start_urls(registry).count() == 1
    folder = write(tmp_path / "in", {"a": GOOD, "b": GOOD, "c": {**GOOD, "offerTitle": "x"}})
    files = crawl.file_hashes(spark, folder)
    assert crawl.unseen(files, files.limit(0)).count() == 2
    assert crawl.unseen(files, files.where("file like '%a.json'")).count() == 1
    with pytest.raises(FileNotFoundError):
        crawl.crawl_records(spark, str(tmp_path / "missing"))


def test_worked_payment(spark):
    request = spark.sql(
        """SELECT 1 AS request_id, 200D AS amount, array(named_struct('balance_coins', 4000D, 'max_coins', cast(null AS double), 'rate', 100D, 'enabled', true)) AS loyalty,
        array(named_struct('code', 'A', 'kind', 'percent', 'value', 10D, 'min_spend', 0D, 'cap', cast(null AS double), 'enabled', true)) AS coupons, 10D AS membership,
        array(named_struct('id', 'c', 'points_rate', 2D, 'gold_rate', 0.01D, 'enabled', true)) AS cards, cast(array() AS array<struct<id:string,enabled:boolean>>) AS banks"""
    )
    best = P.best_combination(request).first()
    assert (best.loyalty_aed, best.coupon_aed, best.member_aed, best.pay, best.total, best.points, best.gold_mg, best.card_id) == (40.0, 16.0, 14.4, 129.6, 70.4, 198, 0.99, "c")
    assert best.combinations == 16
    ranked = P.ranked(P.layers(P.options(request))).orderBy("rank").collect()
    assert ranked[0].total == 70.4 and [r.rank for r in ranked] == list(range(1, len(ranked) + 1))
    capped = P.layers(P.options(request).withColumn("card_discount", F.lit(200.0))).agg(F.max("total")).head()[0]
    assert capped == 180.0


def test_card_offers(spark):
    """Best offer per card against brute force, and what it changes in totals, payment and coins earned."""
    names = ["canonical_key", "merchant_name", "bank_name", "card_name", "discount_type", "discount_value", "min_spend", "cap_value", "coupon_code", "freshness", "valid_to", "confidence"]
    rows = [(f"k{i:03}", m, b, n, kind, value, spend, cap, "CODE20" if i % 11 == 5 else None, "stale" if i % 13 == 7 else "fresh", "2025-01-01" if i % 17 == 3 else None, 0.5)
            for i, (m, b, n, kind, value, spend, cap) in enumerate((m, b, n, kind, value, spend, cap) for m in (None, "Lulu", "IKEA") for b in (None, "F A B", "ADCB") for n in (None, "Visa Infinite") for kind, value in (("percent", "20"), ("fixed", "45"), ("cashback", "7"), ("emi", "6 months")) for spend, cap in ((None, None), (150.0, 12.0)))]
    offers = spark.createDataFrame(rows, ", ".join(f"{n} {'double' if n in ('min_spend', 'cap_value', 'confidence') else 'string'}" for n in names)).withColumns({"categories": F.array().cast("array<string>"), "eligible_mcc_list": F.array().cast("array<string>")})
    cards = [("c1", "fab", "Visa"), ("c2", "ADCB", "Mastercard"), ("c3", None, "Visa"), ("c4", "HSBC", "Amex")]
    merchants = ["LULU Hypermarket", None, "Carrefour"]
    requests = [(i, amount, m, None, [("smiles", 0.0, None, 100.0, True, 1.5)], [], None, [(n, b, w, 0.0, 0.0, True) for n, b, w in cards], [("b", True)]) for i, (amount, m) in enumerate((a, m) for a in (40.0, 100.0, 400.0) for m in merchants)]
    schema = "request_id int, amount double, merchant string, mcc string, loyalty array<struct<program:string,balance_coins:double,max_coins:double,rate:double,enabled:boolean,earn_rate:double>>, coupons array<struct<code:string,kind:string,value:double,min_spend:double,cap:double,enabled:boolean>>, membership double, cards array<struct<id:string,bank:string,network:string,points_rate:double,gold_rate:double,enabled:boolean>>, banks array<struct<id:string,enabled:boolean>>"
    df = spark.createDataFrame(requests, schema)
    day = F.lit("2026-01-01").cast("date")

    def discount(amount, merchant, bank, network, o):
        o = dict(zip(names, o))
        fold = lambda x: x.lower().replace(" ", "")
        mine = (bank and fold(o["bank_name"]) == fold(bank)) if o["bank_name"] else (o["card_name"] and network.lower() in o["card_name"].lower())
        wrong = not o["merchant_name"] and not o["bank_name"] or o["card_name"] and network.lower() not in o["card_name"].lower() or o["merchant_name"] and merchant and fold(o["merchant_name"]) not in fold(merchant)
        if not mine or wrong or o["coupon_code"] or o["freshness"] == "stale" or o["valid_to"] or amount < (o["min_spend"] or 0):
            return 0.0
        raw = {"fixed": 45.0, "percent": amount * 0.2, "cashback": amount * 0.07, "emi": 0.0}[o["discount_type"]]
        return round(min(raw, o["cap_value"] or raw, amount), 2)

    expected = {(i, n): max(discount(amount, m, b, w, o) for o in rows) for i, amount, m, *_ in requests for n, b, w in cards}
    combos = P.options(P.with_card_offers(df, offers, day))
    got = {(r.request_id, r.id or r.bank_id): r.d for r in combos.select("request_id", "card.id", "bank_id", F.col("card_discount").alias("d")).collect()}
    assert {k: v or 0.0 for k, v in got.items() if k[1] != "b"} == expected and len(set(expected.values())) > 3
    assert all(v is None for k, v in got.items() if k[1] == "b")
    for r in P.best_combination(df, offers, day).collect():
        amount = requests[r.request_id][1]
        total = min(max(expected[r.request_id, n] for n, *_ in cards), round(amount * 0.9, 2))
        assert (r.total, r.offer_aed, r.pay, r.loyalty_earned) == (total, total, round(amount - total, 2), {"smiles": int((amount - total) * 1.5 + 1e-9)})
    wallets = df.where("request_id = 8").select(F.lit(1).alias("user_id"), "loyalty", "coupons", "membership", "cards", "banks")
    sessions = spark.createDataFrame([(7, 1, 200.0, "open", None, None, None, None, None, "Lulu", None)], "session_id int, user_id int, amount double, status string, loyalty_percent int, coupon_code string, card_id string, use_membership boolean, use_coupons boolean, merchant string, mcc string")
    s = W.confirmed(sessions, wallets, offers, day).first()
    assert (s.offer_aed, s.net_amount, s.loyalty_earned) == (45.0, 155.0, {"smiles": 232})


def test_offer_rejections(spark):
    schema = "id int, offer struct<categories:array<string>,merchant:string,bank:string,card:string,mcc:array<string>,min_spend:double,freshness:string,valid_to:date>, card struct<bank:string,network:string>, merchant string, mcc string, amount double"
    o = lambda **x: {"categories": [], "merchant": "Lulu", "bank": "FAB", "card": None, "mcc": None, "min_spend": None, "freshness": "fresh", "valid_to": None} | x
    offers = [o(), o(categories=["touchpoints_burn"]), o(merchant=None, bank=None), o(bank="ADCB"), o(card="Visa Infinite"), o(merchant="Ikea"), o(mcc=["1"]), o(min_spend=500.0), o(freshness="stale")]
    df = spark.createDataFrame([(i, x, {"bank": "fab", "network": "Mastercard"}, "LULU hyper", "5411", 100.0) for i, x in enumerate(offers)], schema)
    got = [r.why for r in df.select("id", P.offer_rejection(F.lit("2026-01-01").cast("date")).alias("why")).orderBy("id").collect()]
    assert got == [None, "points_burn", "no_merchant_or_bank", "bank_mismatch", "network_mismatch", "merchant_mismatch", "mcc_mismatch", "min_spend", "stale"]


def test_health(spark):
    schema = "source_type string, sample_size int, avg_confidence double, completeness double, merchant_yield double, freshness double, parse_success double, quarantine_rate double, failure_rate double"
    rows = [("x", 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("adcb", 2, 0.9, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("y", 50, 0.95, 0.9, 0.9, 1.0, 1.0, 0.0, 0.0), ("z", 50, 0.5, 0.5, 0.5, 0.5, 0.7, 0.3, 0.3), ("adcb", 50, 0.1, 0.1, 0.1, 0.1, 0.1, 0.9, 0.9), ("w", 50, 0.1, 0.1, 0.1, 0.1, 0.1, 0.9, 0.9)]
    got = [(r.score, r.status) for r in H.classify(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(0.3, "rejected"), (0.55, "approved"), (0.848, "approved"), (0.405, "rejected"), (0.0, "probation"), (0.0, "rejected")]


def test_relational(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "b", 1), (4, None, 9)], "id int, k string, v int")
    assert [r.id for r in R.first_per(df, ["k"], [F.col("v").desc(), F.col("id")]).orderBy("id").collect()] == [1, 3, 4]
    assert [r.id for r in R.page(df, [F.col("v").desc(), F.col("id")], 2, 2).collect()] == [2, 3]
    with pytest.raises(ValueError):
        R.page(df, [F.col("id")], 0)
    assert sorted(tuple(r) for r in R.or_join(df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b"), [("k", "k"), ("v", "v")], "a", "b").where("a < b").collect()) == [(1, 2)]
    assert R.rollups(df, ["k", "v"]).count() == 9
    one = spark.createDataFrame([("x", 1)], "key string, v int")
    two = spark.createDataFrame([("x", 2), ("y", 3)], "key string, v int")
    assert sorted((r.key, r.v) for r in R.union_first([one, two], ["key"]).collect()) == [("x", 1), ("y", 3)]
    merged = R.merge(one, two, ["key"], ["v"], F.col("n_v") > F.col("o_v"))
    assert sorted((r.key, r.v, r.action) for r in merged.collect()) == [("x", 2, "updated"), ("y", 3, "inserted")]


def test_title_similarity(spark):
    got = spark.createDataFrame([("A b", "a-B"), ("a b c", "b"), ("x", "y"), (None, "y")], "a string, b string").select(Q.title_similarity(F.col("a"), F.col("b")).alias("s"))
    assert [r.s for r in got.collect()] == [1.0, 0.9, 0.0, 0.0]


@pytest.mark.parametrize("name", ["pay_layers", "pay_layers_all", "pay_best", "pay_instruments", "pay_top5", "recommended_instruments"])
def test_combinations_run_in_generated_code(spark, name):
    """No function with a lambda, which has no generated code, runs on a combination: only on a request or its result."""
    from tidewell.queries import QUERIES

    lines = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [i for i, line in enumerate(lines) if "Generate inline(array(struct(loyalty_aed" in line]
    first = max(i for i, line in enumerate(lines) if "Generate " in line)
    assert len(made) == 1 and first > made[0]
    assert not [line for line in lines[made[0] : first + 1] if "lambda" in line]


def test_top_combinations_move_requests_only(spark):
    from tidewell.queries import QUERIES

    plan = QUERIES["pay_top5"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate inline")] and "Exchange hashpartitioning(request_id" in plan


def test_pairs_are_made_once_without_an_aggregate(spark):
    columns = "a long, b string, m string, bank string, t string"
    rows = [(1, "h", "m", None, "Spa"), (2, "h", "m", None, "spa"), (3, "h", "m", None, "Spa day"), (4, "h", "m", None, "day"), (5, "g", "m", None, "spa")]
    want = [(1, 2), (1, 3), (2, 3), (3, 4)]
    df = R.likely_duplicates(spark.createDataFrame(rows, columns), "a", "b", "m", "bank", "t", [])
    assert "Aggregate [a#" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, df.collect())) == want
    again = R.likely_duplicates(spark.createDataFrame([*rows, rows[0], (1, "h", "m", None, "spa day")], columns), "a", "b", "m", "bank", "t", [])
    assert sorted(map(tuple, again.collect())) == sorted([*want, (1, 4)])
