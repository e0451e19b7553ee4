"""Ingestion of raw crawl rows as one plan: normalise, look up source and discovery, score, gate, route, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.functions.keys import dedupe_hash, joined
from tidewell.operators import quality as Q
from tidewell.operators import relational as R
from tidewell.operators.containment import containments, groups, with_checkpoints
from tidewell.sources.crawl import discovery_index, source_index

STORED = ["normalized_url", "source_type", "bank_name", "card_name", "merchant_name", "offer_title", "offer_description", "discount_type", "discount_value", "currency", "coupon_code", "min_spend", "cap_value", "valid_from", "valid_to", "payment_methods", "eligible_mcc_list", "categories", "stackable", "confidence", "discovery_query", "discovery_source", "serp_rank", "snapshot_hash"]


def evaluated(raw: DataFrame, sources: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """raw rows with all that is derived: keys, confidence, reasons, route and quarantine_type.

    Rows without a URL, and broken records, are routed to quarantine as invalid_schema.
    """
    df = raw if "_corrupt" in raw.columns else raw.withColumn("_corrupt", F.lit(None).cast("string"))
    # a row's id is that of its content: the same in every run, and of equal rows the same
    content = F.sha2(F.to_json(F.struct(*(c for c in df.columns)), {"ignoreNullFields": "false"}), 256)
    # row_at orders equal rows, and keeps the planner from repeating the steps before it in those after it
    df = Q.normalize_offers(df.withColumn("row_id", content)).withColumn("row_at", F.monotonically_increasing_id())
    if found is not None:
        index = discovery_index(found).select("key", F.col("query").alias("_q"), F.col("source").alias("_s"), F.col("rank").alias("_r"))
        df = R.multi_key_first(df, "row_id", U.discovery_keys(F.col("source_url")), index, "key", ["_q", "_s", "_r"])
        df = df.withColumns({"discovery_query": F.coalesce("discovery_query", "_q"), "discovery_source": F.coalesce("discovery_source", "_s"), "serp_rank": F.coalesce("serp_rank", "_r"), "from_discovery": F.coalesce("from_discovery", F.lit(False)) | F.col("_q").isNotNull()}).drop("_q", "_s", "_r")
    index = source_index(sources).select("source_type", F.col("status").alias("source_status"), F.col("confidence").alias("source_confidence"), F.col("confidence_floor").alias("source_floor"), F.col("strict").alias("source_strict"))
    df = df.join(index, "source_type", "left")
    df = df.withColumn("confidence", Q.confidence("source_confidence", "source_status"))
    policy = Q.discovery_policy()
    gate = Q.gate_reasons(Q.source_strict(F.col("source_status"), F.col("source_strict")))
    df = df.withColumns({"policy": policy, "gate": gate, "floor": Q.source_floor(F.col("source_status"), F.col("source_floor"))})
    invalid = F.col("_corrupt").isNotNull() | (F.coalesce("source_url", F.lit("")) == "")
    stopped = F.col("policy.action") == "quarantine"
    low = F.when(F.col("confidence") < F.col("floor"), F.array(F.lit("below_confidence_floor"))).otherwise(F.array())
    reasons = F.when(invalid, F.array(F.lit("invalid_schema"))).when(stopped, F.array("policy.reason")).when(F.size("gate") > 0, F.col("gate")).otherwise(low)
    df = df.withColumn("reasons", reasons)
    df = df.withColumns({"route": F.when(F.size("reasons") == 0, "offers").otherwise("quarantine"), "quarantine_type": F.when(F.size("reasons") > 0, F.coalesce(F.when(~invalid & stopped, F.col("policy.type")), Q.quarantine_type(F.col("reasons"))))})
    return Q.with_keys(df).drop("policy", "gate")


def preferred(rows: DataFrame) -> DataFrame:
    """One row per canonical key: higher confidence, then more filled fields, then the one read later."""
    order = [F.col("confidence"), F.col("filled"), F.coalesce("scraped_at", F.lit("")), F.col("row_id"), F.col("row_at")]
    return R.best_by(rows.withColumn("filled", Q.filled_fields()), ["canonical_key"], order, [*STORED, "filled"])


def matching(df: DataFrame) -> DataFrame:
    """df with what likely duplicates share: _page and _hash (URL, title and coupon), and _host, _merchant, _bank, _title.

    Two rows are likely duplicates if they have one page or hash, or one host, merchant and bank and similar titles:
    equal slugs, or one within the other. Rows without a host have none of these, rows without a merchant no block.
    """
    slug, url = lambda n: F.coalesce(T.slugify(F.col(n)), F.lit("")), F.nullif(F.col("normalized_url"), F.lit(""))
    host = F.nullif(U.hostname(url), F.lit(""))
    of_host = lambda value: F.when(host.isNotNull(), value)
    return df.withColumns({
        "_page": of_host(joined(url, slug("offer_title"), F.lower(T.clean_text(F.col("coupon_code"))))),
        "_hash": of_host(dedupe_hash(url, F.col("offer_title"), F.col("coupon_code"))),
        "_host": F.when(slug("merchant_name") != "", host),
        "_merchant": slug("merchant_name"),
        "_bank": slug("bank_name"),
        "_title": slug("offer_title"),
    })


BLOCK = ["_host", "_merchant", "_bank"]


def duplicates_of_stored(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """(canonical_key, match): new rows, as matching() gives them, with struct(exact, at, stored_key) of the stored offer of their key, else of the
    last seen of those that they are likely duplicates of.

    Only stored offers of the new rows' hosts can match. They are summed up to one per key, page, hash and title of a block before they meet a new row, and titles
    meet by the containment join, so that no block is compared as a whole.
    """
    c = F.col
    at = F.coalesce(U.hostname(c("normalized_url")), c("normalized_url"), F.lit(""))
    hosts = rows.select(at.alias("_at")).distinct()
    near_by = stored.select("canonical_key", "normalized_url", "offer_title", "coupon_code", "merchant_name", "bank_name", "last_seen_at").withColumn("_at", at)
    old = matching(near_by.join(hosts, "_at", "left_semi")).checkpoint()
    match = lambda exact: F.struct(F.lit(exact).alias("exact"), c("last_seen_at").alias("at"), c("canonical_key").alias("stored_key"))
    keyed = lambda df: F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), c(n).alias("value")) for k, n in (("key", "canonical_key"), ("page", "_page"), ("hash", "_hash")))))  # noqa: E731, ARG005
    latest = old.select(keyed(old).alias("_k"), "last_seen_at", "canonical_key").where("_k.value is not null").groupBy("_k").agg(F.max(match(False)).alias("m"))
    met = rows.select("canonical_key", keyed(rows).alias("_k")).where("_k.value is not null").join(latest, "_k")
    exact = F.struct((c("_k.kind") == "key").alias("exact"), c("m.at").alias("at"), c("m.stored_key").alias("stored_key"))
    by_title = old.groupBy(*BLOCK, "_title").agg(F.max(match(False)).alias("m"))
    titles = containments(rows, old, BLOCK, "_title").select(*BLOCK, c("x").alias("_new"), c("y").alias("_title"))
    titles = titles.unionByName(containments(old, rows, BLOCK, "_title").select(*BLOCK, c("y").alias("_new"), c("x").alias("_title")))
    near = titles.join(by_title, [*BLOCK, "_title"]).groupBy(*BLOCK, c("_new").alias("_title")).agg(F.max("m").alias("m"))
    found = met.select("canonical_key", exact.alias("m")).unionByName(rows.join(near, [*BLOCK, "_title"]).select("canonical_key", "m"))
    return found.groupBy("canonical_key").agg(F.max("m").alias("match"))


def duplicates_within(rows: DataFrame) -> DataFrame:
    """(canonical_key, group_key) of rows of distinct keys, as matching() gives them: likely duplicates of likely duplicates are one group.

    group_key is the key of the group's preferred row: higher confidence, then more filled fields, then the least key.
    """
    found = groups(rows, "canonical_key", F.array("_page", "_hash"), BLOCK, "_title")
    ranked = rows.select("canonical_key", "confidence", "filled").join(found, "canonical_key")
    best = ranked.groupBy("root").agg(F.min_by("canonical_key", F.struct(-F.col("confidence"), -F.col("filled"), "canonical_key")).alias("group_key"))
    return ranked.join(best, "root").select("canonical_key", "group_key")


def upsert(stored: DataFrame, accepted: DataFrame, seen_at: Column) -> DataFrame:
    """The offers table after a batch: stored(canonical_key, STORED, filled, first_seen_at, last_seen_at, freshness).

    action: inserted, updated (the material fields changed), seen, or kept (not in the batch). A row whose key is
    stored updates that offer. Other rows go with their group of likely duplicates within the batch: into the stored
    offer that some row of it matches best, else into one new offer under the key of the preferred row.
    """
    with_checkpoints(accepted.sparkSession)
    rows = matching(preferred(accepted).select("canonical_key", "normalized_url", "offer_title", "coupon_code", "merchant_name", "bank_name", "confidence", "filled")).checkpoint()
    within = duplicates_within(rows)
    known = within.join(duplicates_of_stored(stored, rows), "canonical_key", "left")
    per = known.groupBy("group_key").agg(F.max("match").alias("best"))
    target = F.coalesce(F.when(F.col("match.exact"), F.col("match.stored_key")), F.col("best.stored_key"), F.col("group_key"))
    into = known.join(per, "group_key").select("canonical_key", target.alias("_into")).checkpoint()
    accepted = accepted.join(into, "canonical_key", "left").withColumn("canonical_key", F.coalesce("_into", "canonical_key")).drop("_into")
    new = preferred(accepted).withColumns({"first_seen_at": seen_at, "last_seen_at": seen_at, "freshness": F.lit("fresh")})
    columns = [*STORED, "filled", "first_seen_at", "last_seen_at", "freshness"]
    o, n = (lambda c: F.col(f"o_{c}")), (lambda c: F.col(f"n_{c}"))
    better = F.struct(n("confidence"), n("filled")) >= F.struct(o("confidence"), o("filled"))
    both = R.merge(stored.select("canonical_key", *columns, F.col("snapshot_hash").alias("was")), new.withColumn("was", F.lit(None).cast("string")), ["canonical_key"], [*columns, "was"], better, sticky=["first_seen_at", "discovery_query", "discovery_source", "serp_rank", "was"])
    hit = new.select("canonical_key", F.col("last_seen_at").alias("_seen"))
    both = both.join(hit, "canonical_key", "left").withColumns({"last_seen_at": F.coalesce("_seen", "last_seen_at"), "freshness": F.when(F.col("_seen").isNotNull(), "fresh").otherwise(F.col("freshness"))})
    action = F.when(F.col("action") == "inserted", "inserted").when(F.col("_seen").isNull(), "kept").when(F.col("was") != F.col("snapshot_hash"), "updated").otherwise("seen")
    return both.withColumn("action", action).drop("_seen", "was")


def snapshots(after: DataFrame, seen_at: Column) -> DataFrame:
    """The change log's new rows."""
    return after.where("action = 'updated'").select("canonical_key", "snapshot_hash", F.to_json(F.struct(*Q.SNAPSHOT)).alias("fields"), seen_at.alias("at"))


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where("route = 'quarantine'").select("row_id", "source_url", "normalized_url", "source_type", "quarantine_type", "reasons", "confidence", F.to_json(F.struct(*Q.OFFER)).alias("payload"), F.lit("pending").alias("review_status"))


def replay(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Quarantined records evaluated again from their stored payload, with the record's id as record_id."""
    schema = ", ".join(f"{k} {v}" for k, v in Q.OFFER.items())
    return evaluated(records.select(F.from_json("payload", schema).alias("p"), F.col("row_id").alias("record_id")).select("p.*", "record_id"), sources)


def promoted(quarantine: DataFrame, ids: DataFrame, sources: DataFrame, stored: DataFrame, seen_at: Column, by: str = "api") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(offers, quarantine, outcomes) after promoting the records of ids(row_id).

    A record whose payload now passes is upserted and reviewed as promoted; one that still fails stays as it is.
    outcomes(row_id, outcome, reasons): promoted, still_fails_gate, no_payload or not_found, a row per asked id.
    """
    with_checkpoints(quarantine.sparkSession)
    asked = ids.select("row_id").distinct()
    records = quarantine.join(asked, "row_id", "left_semi")
    rows = replay(records.where("payload is not null"), sources).checkpoint()
    offers = upsert(stored, rows.where("route = 'offers'"), seen_at)
    done = rows.groupBy(F.col("record_id").alias("row_id")).agg(F.max(F.col("route") == "offers").alias("_ok"), F.max("reasons").alias("_why"))
    known = records.groupBy("row_id").agg(F.lit(True).alias("_known"))
    outcome = F.when(F.col("_known").isNull(), "not_found").when(F.col("_ok").isNull(), "no_payload").when(F.col("_ok"), "promoted").otherwise("still_fails_gate")
    outcomes = asked.join(known, "row_id", "left").join(done, "row_id", "left").select("row_id", outcome.alias("outcome"), F.when(~F.col("_ok"), F.col("_why")).alias("reasons")).checkpoint()
    decisions = outcomes.where("outcome = 'promoted'").select("row_id", F.lit("promoted").alias("status"), F.lit(by).alias("by"))
    return offers, reviewed(quarantine, decisions), outcomes


def run_stats(rows: DataFrame) -> DataFrame:
    """Counters of a run: one row, with a map per quarantine type."""
    kinds = rows.groupBy("route", "quarantine_type").count()
    return kinds.agg(F.sum("count").alias("total"), F.coalesce(F.sum(F.when(F.col("route") == "offers", F.col("count"))), F.lit(0)).alias("accepted"), F.map_from_entries(F.filter(F.collect_list(F.struct("quarantine_type", "count")), lambda e: e["quarantine_type"].isNotNull())).alias("by_type"))


def mark_stale(offers: DataFrame, as_of: Column) -> DataFrame:
    gone = (F.col("freshness") == "fresh") & Q.is_stale(F.col("last_seen_at").cast("date"), F.col("source_type"), as_of)
    return offers.withColumn("freshness", F.when(gone, "stale").otherwise(F.col("freshness")))


def reviewed(quarantine: DataFrame, decisions: DataFrame) -> DataFrame:
    """Review states applied by id: decisions(row_id, status, by). Records without a decision stay as they are."""
    before = F.col("reviewed_by") if "reviewed_by" in quarantine.columns else F.lit(None).cast("string")
    d = decisions.select("row_id", F.col("status").alias("_s"), F.col("by").alias("_b"))
    return quarantine.join(d, "row_id", "left").withColumns({"review_status": F.coalesce("_s", "review_status"), "reviewed_by": F.coalesce("_b", before)}).drop("_s", "_b")
