"""The engine's operators over the star-schema, event, document and page tables, each with SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import keys as K
from tidewell.functions import text as T
from tidewell.functions import url as U
from tidewell.operators import crawl_quality as CQ
from tidewell.operators import discovery as D
from tidewell.operators import extract as X
from tidewell.operators import health as H
from tidewell.operators import payment as P
from tidewell.operators import quality as Q
from tidewell.operators import records as N
from tidewell.operators import registry as G
from tidewell.operators import relational as R
from tidewell.operators import site_offers as S
from tidewell.operators import site_rules as SR
from tidewell.operators import wallet as W
from tidewell.plans import ingestion as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- filters, pages, search


@query("""SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE contains(lower(c_mktsegment), 'build') AND o_totalprice >= 1000 ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 50 OFFSET 50""")
def list_filter_page(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").where("o_totalprice >= 1000")
    c = table(spark, sf, "customer").where(R.contains("c_mktsegment", "BUILD")).select("c_custkey", "c_name")
    return R.page(o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice"), [F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey")], 2, 50)


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring') OR contains(lower(p_type), 'ring')")
def search_any_column(spark, sf):
    return table(spark, sf, "part").where(R.contains_any(["p_name", "p_brand", "p_type"], "ring")).select("p_partkey", "p_name", "p_brand")


@query("""SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS valid_to FROM orders)
WHERE valid_to IS NULL OR CAST(valid_to AS DATE) >= DATE '1997-01-01' GROUP BY 1""")
def null_or_range_filter(spark, sf):
    o = table(spark, sf, "orders").withColumn("valid_to", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")))
    return o.where(Q.valid_now(F.col("valid_to"), F.lit("1997-01-01"))).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT route, count(*) AS n FROM (SELECT CASE WHEN event_type IS NULL OR length(event_type) = 0 OR json_extract_string(props, '$.k') IS NULL THEN 'invalid_schema'
WHEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) < 50 THEN 'low' ELSE 'ok' END AS route FROM events) GROUP BY 1""")
def schema_validate_route(spark, sf):
    k = F.get_json_object("props", "$.k")
    route = F.when((F.coalesce("event_type", F.lit("")) == "") | k.isNull(), "invalid_schema").when(k.try_cast("double") < 50, "low").otherwise("ok")
    return table(spark, sf, "events").groupBy(route.alias("route")).agg(F.count("*").alias("n"))


# ---- offers derived from orders: the shape of the offer operators


def order_offers(spark, sf):
    o = table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "O", "percent").when(F.col("o_orderstatus") == "F", "fixed")
    value = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000).cast("string"))
    return Q.offers(
        o.select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 7 == 0, "Error").otherwise(F.col("o_orderpriority")).alias("offer_title"),
            kind.alias("discount_type"),
            value.alias("discount_value"),
            F.lit("generic").alias("source_type"),
            (F.col("o_custkey") % 2000).cast("int").alias("page_length"),
            (F.col("o_orderkey") % 2).cast("int").alias("crawl_depth"),
            (F.col("o_orderkey") % 10 / 10).alias("parser_confidence"),
            F.when(F.col("o_orderkey") % 3 == 0, "SAVE20NOW").when(F.col("o_orderkey") % 3 == 1, "HERE").alias("coupon_code"),
        )
    )


ORDER_OFFERS = """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'Error' ELSE o_orderpriority END AS title,
CASE o_orderstatus WHEN 'O' THEN 'percent' WHEN 'F' THEN 'fixed' END AS kind, CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1000) END AS val,
o_custkey % 2000 AS len, o_orderkey % 2 AS depth, (o_orderkey % 10) / 10.0 AS pc, o_orderkey % 3 AS m FROM orders),
y AS (SELECT *, val IS NOT NULL OR m = 0 AS strong, title = 'Error' AS garbage FROM x),
s AS (SELECT *, floor((0.1 + 0.5 * 0.2 + least(0.2, pc * 0.2) + CASE WHEN depth >= 1 THEN 0.12 ELSE 0.05 END + CASE WHEN len >= 1500 THEN 0.08 WHEN len < 400 THEN -0.1 ELSE 0.0 END
 + CASE WHEN length(title) >= 6 THEN 0.08 ELSE 0.0 END + CASE WHEN kind IS NOT NULL THEN 0.08 ELSE 0.0 END + CASE WHEN val IS NOT NULL THEN 0.08 ELSE 0.0 END + CASE WHEN m < 2 THEN 0.06 ELSE 0.0 END) * 1000 + 0.5) / 1000 AS score FROM y),
r AS (SELECT *, list_filter([CASE WHEN garbage AND kind IS NULL AND m <> 0 THEN 'missing_minimum_fields' END, CASE WHEN garbage THEN 'garbage_title' END,
 CASE WHEN m = 1 THEN 'invalid_coupon' END, CASE WHEN len > 0 AND len < 200 AND NOT strong THEN 'thin_page' END,
 CASE WHEN NOT strong AND garbage THEN 'zero_value_junk' END, CASE WHEN kind = 'percent' AND val > 100 OR val > 10000 THEN 'absurd_values' END], lambda v: v IS NOT NULL) AS reasons FROM s)
"""


@query(ORDER_OFFERS + "SELECT o_orderkey, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS passed FROM r")
def quality_reasons(spark, sf):
    df = order_offers(spark, sf).withColumn("reasons", Q.gate_reasons(score="parser_confidence"))
    return df.select("o_orderkey", F.array_join("reasons", ",").alias("reasons"), (F.size("reasons") == 0).alias("passed"))


@query(ORDER_OFFERS + "SELECT o_orderkey, greatest(0.0, least(1.0, score)) AS confidence FROM r")
def additive_score(spark, sf):
    return order_offers(spark, sf).select("o_orderkey", Q.confidence().alias("confidence"))


@query(ORDER_OFFERS + """SELECT CASE WHEN len(reasons) > 0 THEN 'quality_gate_failed' WHEN score < 0.45 THEN 'below_confidence_floor' ELSE 'offers' END AS route, count(*) AS n FROM r GROUP BY 1""")
def score_floor_route(spark, sf):
    df = order_offers(spark, sf).withColumn("confidence", Q.confidence()).withColumn("reasons", Q.gate_reasons())
    floor = Q.source_floor(F.lit("probation"), F.lit(None).cast("double"))
    return df.groupBy(Q.route(F.col("reasons"), F.col("confidence"), floor).alias("route")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT source, count(*) AS n, floor(avg(n_chars) / 10) / 1000 AS c FROM documents GROUP BY source),
b AS (SELECT source, n, c, CASE WHEN n % 3 = 0 THEN 'approved' WHEN n % 3 = 1 THEN 'probation' ELSE 'rejected' END AS status FROM s)
SELECT source, floor((CASE status WHEN 'probation' THEN (0.6 * 0.7 + c * 0.3) * 0.92 WHEN 'rejected' THEN (0.6 * 0.7 + c * 0.3) * 0.5 ELSE 0.6 * 0.7 + c * 0.3 END) * 1000 + 0.5) / 1000 AS blended,
CAST(CASE status WHEN 'rejected' THEN 0.99 WHEN 'probation' THEN 0.45 ELSE 0.4 END AS DOUBLE) AS floor FROM b""")
def score_blend_floor(spark, sf):
    s = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), (F.floor(F.avg("n_chars") / 10) / 1000).alias("c"))
    s = s.withColumn("status", F.when(F.col("n") % 3 == 0, "approved").when(F.col("n") % 3 == 1, "probation").otherwise("rejected"))
    return s.select("source", Q.blended(F.lit(0.6), F.col("c"), F.col("status")).alias("blended"), Q.source_floor(F.col("status"), F.lit(None).cast("double")).alias("floor"))


@query("""SELECT c.source, CASE WHEN status = 'rejected' THEN 'rejected_source' WHEN status = 'approved' THEN NULL WHEN kind = 'coupon' AND NOT disc THEN NULL
WHEN kind = 'generic' AND NOT disc THEN 'unknown_generic_source' WHEN conf >= 0.65 AND kind <> 'x' THEN 'auto_accepted' ELSE 'weak_discovery_signals' END AS reason, count(*) AS n
FROM (SELECT source, CASE doc_id % 4 WHEN 0 THEN 'rejected' WHEN 1 THEN 'approved' END AS status, CASE WHEN doc_id % 3 = 0 THEN 'generic' ELSE 'coupon' END AS kind, doc_id % 5 < 2 AS disc, (doc_id % 10) / 10.0 AS conf FROM documents) c GROUP BY 1, 2""")
def discovery_policy(spark, sf):
    i = F.col("doc_id")
    d = Q.offers(table(spark, sf, "documents").select("source", F.when(i % 4 == 0, "rejected").when(i % 4 == 1, "approved").alias("source_status"), F.when(i % 3 == 0, "generic").otherwise("picodi").alias("source_type"), (i % 5 < 2).alias("from_discovery"), (i % 10 / 10).alias("confidence"), F.lit("Some shop").alias("merchant_name"), F.lit("percent").alias("discount_type"), F.lit("generic").alias("parser_name")))
    return d.groupBy("source", Q.discovery_policy()["reason"].alias("reason")).agg(F.count("*").alias("n"))


# ---- text


PART_TEXT = "p_name || ' ' || CASE p_size % 5 WHEN 0 THEN 'Dining and hotel' WHEN 1 THEN 'FUEL  retail' WHEN 2 THEN 'cinema' ELSE '' END"


def part_text():
    s = F.col("p_size") % 5
    return F.concat(F.col("p_name"), F.lit(" "), F.when(s == 0, "Dining and hotel").when(s == 1, "FUEL  retail").when(s == 2, "cinema").otherwise(""))


@query(f"""WITH t AS (SELECT p_partkey, lower({PART_TEXT}) AS t FROM part), l AS (SELECT p_partkey, list_filter([CASE WHEN regexp_matches(t, 'dining|restaurant|food|drink|cafe') THEN 'dining' END,
CASE WHEN regexp_matches(t, 'travel|hotel|flight|airline|airport') THEN 'travel' END, CASE WHEN regexp_matches(t, 'shopping|retail|mall|hypermarket') THEN 'shopping' END,
CASE WHEN regexp_matches(t, 'entertainment|theme park|cinema|theatre|theater') THEN 'entertainment' END, CASE WHEN regexp_matches(t, 'fashion|apparel|clothing') THEN 'fashion' END,
CASE WHEN regexp_matches(t, 'fuel|petrol|gas station') THEN 'fuel' END], lambda v: v IS NOT NULL) AS l FROM t)
SELECT p_partkey, array_to_string(l, ',') AS labels, array_to_string(flatten(list_transform(l, lambda c: CASE c WHEN 'dining' THEN ['5812', '5814'] WHEN 'travel' THEN ['3000', '4511', '7011', '4722']
WHEN 'shopping' THEN ['5311', '5331', '5399'] WHEN 'entertainment' THEN ['7832', '7922', '7996'] WHEN 'fashion' THEN ['5651', '5691', '5699'] ELSE ['5541', '5542'] END)), ',') AS codes FROM l""")
def category_labels(spark, sf):
    x = table(spark, sf, "part").select("p_partkey", T.categories(part_text()).alias("l"))
    return x.select("p_partkey", F.array_join("l", ",").alias("labels"), F.array_join(T.category_codes(F.col("l")), ",").alias("codes"))


@query(f"""SELECT p_partkey, trim(regexp_replace({PART_TEXT}, '\\s+', ' ', 'g')) AS cleaned, regexp_replace(regexp_replace(lower(trim(regexp_replace({PART_TEXT}, '\\s+', ' ', 'g'))), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug,
CAST(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) AS brand_number FROM part""")
def text_clean_slug_number(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.clean_text(part_text()).alias("cleaned"), T.slugify(part_text()).alias("slug"), T.to_number(F.col("p_brand")).alias("brand_number"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'percent' WHEN 1 THEN 'fixed' WHEN 2 THEN 'cashback' END AS kind,
CASE l_linenumber % 4 WHEN 3 THEN NULL ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS value FROM lineitem""")
def discount_detect(spark, sf):
    n, q = F.col("l_linenumber") % 4, F.col("l_quantity").cast("int").cast("string")
    text = F.when(n == 0, F.concat(F.lit("Enjoy "), q, F.lit("% off"))).when(n == 1, F.concat(F.lit("Save AED "), q, F.lit(" today"))).when(n == 2, F.concat(F.lit("Up to "), q, F.lit(" % cashback"))).otherwise("nothing here")
    return table(spark, sf, "lineitem").withColumn("d", T.detect_discount(text)).select("l_orderkey", "l_linenumber", F.col("d.type").alias("kind"), F.col("d.value").alias("value"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def date_parse(spark, sf):
    o, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    text = F.when(o == 0, F.date_format(d, "d/M/yyyy")).when(o == 1, F.date_format(d, "yyyy-MM-dd")).otherwise("until sold out")
    shifted = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", text.alias("t"))
    # dates before 2001 are taken for slips, except in the day-first form; these are moved by 400 years and back
    moved = F.regexp_replace(F.regexp_replace(F.col("t"), r"\b19(\d\d)\b", "23$1"), r"\b20(\d\d)\b", "24$1")
    years = F.year("o_orderdate") - F.year(T.parse_date(moved))
    return shifted.select("o_orderkey", F.add_months(T.parse_date(moved), 12 * years).alias("d"))


# ---- URLs


HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"


@query(f"""WITH q AS (SELECT page_id, url, regexp_extract(url, '^[^?#]*') AS bare, list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT list_contains(['utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'gclid', 'fbclid', 'mc_cid', 'mc_eid', 'ref', 'source', 'campaign'], lower(string_split(p, '=')[1]))) AS kept FROM pages),
n AS (SELECT page_id, url, lower(bare || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END) AS u FROM q)
SELECT page_id, CASE WHEN u LIKE '%/' AND NOT regexp_matches(u, '^[a-z]+://[^/]*/$') THEN u[:-2] ELSE u END AS normalized, {HOST} AS host, regexp_replace({HOST}, '^www\\.', '') AS domain FROM n""")
def url_normalize(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", U.normalize_url(u).alias("normalized"), U.hostname(u).alias("host"), U.domain(u).alias("domain"))


@query("""SELECT CASE WHEN regexp_matches(lower(url), 'coupon|promo-code|voucher') THEN 'couponFeed' ELSE 'generic' END AS source_type, regexp_matches(url, '^[a-z]+://[^/?#]*/?([?#]|$)') AS empty_path, count(*) AS n FROM pages GROUP BY 1, 2""")
def url_class(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").groupBy(U.source_type(u).alias("source_type"), U.empty_path(u).alias("empty_path")).agg(F.count("*").alias("n"))


SITES = [("example.com", 1), ("example.org", 2), ("example.net", 3), ("casino-win.example.com", 9)]


@query(f"""WITH d(site, priority) AS (VALUES {", ".join(f"('{a}', {b})" for a, b in SITES)}), h AS (SELECT page_id, {HOST} AS host FROM pages),
m AS (SELECT page_id, site, row_number() OVER (PARTITION BY page_id ORDER BY priority DESC, site) AS n FROM h JOIN d ON host = site OR host LIKE '%.' || site)
SELECT h.page_id, site FROM h LEFT JOIN (SELECT * FROM m WHERE n = 1) m USING (page_id)""")
def domain_match_top1(spark, sf):
    sites = spark.createDataFrame(SITES, "site string, priority int")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return R.suffix_match(pages, "page_id", U.hostname(F.col("url")), sites, "site", [F.col("priority").desc(), F.col("site")]).select("page_id", "site")


@query(f"""WITH h AS (SELECT page_id, {HOST} AS host, regexp_replace({HOST}, '^www\\.', '') AS dom FROM pages), i AS (SELECT DISTINCT dom AS k FROM h WHERE length(dom) % 2 = 0)
SELECT page_id, coalesce(a.k, b.k) AS found FROM h LEFT JOIN i a ON a.k = host LEFT JOIN i b ON b.k = dom""")
def multi_key_first_match(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", U.hostname(F.col("url")).alias("host"), U.domain(F.col("url")).alias("dom"))
    index = pages.where(F.length("dom") % 2 == 0).select(F.col("dom").alias("k"), F.col("dom").alias("found")).distinct()
    return R.multi_key_first(pages, "page_id", F.array("host", "dom"), index, "k", ["found"]).select("page_id", "found")


@query(f"SELECT {HOST} AS host, count(*) AS hits, array_to_string(list(url ORDER BY page_id)[:5], ' ') AS first_urls FROM pages GROUP BY 1")
def host_candidates(spark, sf):
    p = table(spark, sf, "pages").select(U.hostname(F.col("url")).alias("host"), "page_id", "url")
    first = R.first_per(p, ["host"], [F.col("page_id")], 5).groupBy("host").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "url"))), lambda x: x["url"]), " ").alias("first_urls"))
    return p.groupBy("host").agg(F.count("*").alias("hits")).join(first, "host")


# ---- pages


@query("""SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), '') AS title, len(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"#]*)', 1)) AS links FROM pages""")
def html_title_links(spark, sf):
    h = F.col("html")
    return table(spark, sf, "pages").select("page_id", X.title(h).alias("title"), F.size(X.links(h)).cast("long").alias("links"))


VISIBLE = "html"
for _tag in ("script", "style", "nav", "footer", "header", "noscript", "svg", "form", "iframe"):
    VISIBLE = f"regexp_replace({VISIBLE}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}>', ' ', 'g')"


@query(f"""WITH v AS (SELECT page_id, lower(url) AS u, html, trim(regexp_replace(regexp_replace(regexp_replace({VISIBLE}, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM pages)
SELECT page_id, length(t) AS n, CASE WHEN regexp_matches(lower(t), '404 not found|page not found|can''t seem to find the page|access denied') AND length(t) < 2000 THEN 'error' WHEN regexp_matches(u, '/(?:offers?|deals?|promotions?)/?(?:[?#]|$)') THEN 'listing'
WHEN regexp_matches(u, '/(?:offers?|deals?|promotions?)/[^/?#]+') THEN 'detail' WHEN length(t) < 200 AND length(html) > 5000 THEN 'shell' WHEN regexp_matches(lower(t[:80]), '^[^.]{{0,60}}offers?\\b') THEN 'category' ELSE 'unknown' END AS page_type FROM v""")
def html_visible_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.length(X.visible_text(F.col("html"))).alias("n"), X.page_type(F.col("url"), X.visible_text(F.col("html")), F.col("html")).alias("page_type"))


@query("""WITH h AS (SELECT lower(regexp_extract(url, '^[a-z]+://[^/?#]*')) AS site, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"#]*)', 1)) AS h FROM pages),
u AS (SELECT DISTINCT CASE WHEN regexp_matches(h, '^https?://') THEN lower(h) ELSE site || lower(h) END AS url FROM h WHERE regexp_matches(h, '^(https?://|/)'))
SELECT url, 1 AS depth FROM u WHERE url NOT IN (SELECT lower(url) FROM pages)""")
def crawl_frontier(spark, sf):
    return X.frontier(table(spark, sf, "pages"), "url", "html", 0, 2)


@query("""WITH u AS (SELECT page_id, lower(url) AS u, regexp_matches(url, '^[a-z]+://[^/?#]*/?([?#]|$)') AS bare FROM pages)
SELECT page_id, CASE WHEN regexp_matches(u, '/campaigns?/|/utm_|/track(?:ing)?/') THEN 'campaign_or_tracking' WHEN bare THEN 'empty_path'
WHEN regexp_matches(u, '/search|/login|/register|/about-us|/business|/careers|/cookie|/fraud|/loans/|/accounts/|/sitemap|/investor') THEN 'blocked:generic-noise' WHEN regexp_matches(u, '\\.(jpg|jpeg|png|gif|svg|css|js|woff|ico)(\\?|$)') THEN 'blocked:asset'
WHEN NOT regexp_matches(u, 'deal|offer|promo|promotion|benefit|reward|perk|coupon|cashback|discount|campaign|mastercard|visa-offer') THEN 'generic:no-keyword' ELSE 'allowed' END AS reason FROM u""")
def link_rules(spark, sf):
    return table(spark, sf, "pages").select("page_id", D.enqueue(F.col("url"), F.lit("generic"), F.lit(0))["reason"].alias("reason"))


@query(ORDER_OFFERS + """SELECT o_orderkey, greatest(0.0, least(1.0, floor((0.15 + CASE WHEN garbage THEN 0.0 WHEN length(title) >= 10 THEN 0.2 ELSE 0.1 END + CASE WHEN kind IS NOT NULL THEN 0.15 ELSE 0.0 END + CASE WHEN val > 0 THEN 0.1 ELSE 0.0 END + CASE WHEN m < 2 THEN 0.1 ELSE 0.0 END) * 100 + 0.5) / 100)) AS confidence FROM r""")
def crawler_confidence(spark, sf):
    return order_offers(spark, sf).select("o_orderkey", CQ.confidence().alias("confidence"))


@query()
def page_offers(spark, sf):
    pages = table(spark, sf, "pages").withColumn("html", F.concat(F.lit("<h1>20% off at Lulu</h1>"), F.col("html")))
    return S.page_offers(pages).select("source_url", "offer_title", "discount_type", "discount_value", "merchant_name", "parser_reason")


# ---- keys and duplicates


@query("""SELECT p_partkey, sha256(concat_ws('::', 'u/' || p_partkey, lower(p_brand), '', lower(p_name), '', p_type, CAST(p_size AS VARCHAR))) AS key FROM part""")
def canonical_key(spark, sf):
    c = F.col
    return table(spark, sf, "part").select("p_partkey", K.canonical_key(F.concat(F.lit("u/"), c("p_partkey").cast("string")), c("p_brand"), F.lit(None), c("p_name"), F.lit(None), c("p_type"), c("p_size").cast("double").cast("string")).alias("key"))


@query("""SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","note":null}') AS hash FROM customer""")
def snapshot_hash(spark, sf):
    return table(spark, sf, "customer").withColumn("note", F.lit(None).cast("string")).select("c_custkey", K.snapshot_hash("note", "c_name", "c_mktsegment").alias("hash"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY md5(text), lang ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def dedupe_first_wins(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", F.md5("text").alias("h"))
    return R.best_by(d, ["h", "lang"], [-F.col("doc_id")], ["doc_id", "source"]).select("doc_id", "source")


SLUG = "regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"


@query(f"""WITH p AS (SELECT p_partkey, p_brand, p_type, p_size, {SLUG} AS s FROM part) SELECT a.p_partkey AS a, b.p_partkey AS b FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey
WHERE a.s = b.s OR contains(a.s, b.s) OR contains(b.s, a.s)""")
def fuzzy_dedupe_blocked(spark, sf):
    return R.likely_duplicates(R.spread(table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_name")), "p_partkey", "p_brand", "p_type", "p_size", "p_name", [])


@query("""SELECT l_partkey, l_orderkey, l_linenumber, l_discount FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount DESC, l_quantity DESC, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1""")
def preferred_row(spark, sf):
    return R.best_by(table(spark, sf, "lineitem"), ["l_partkey"], [F.col(c) for c in ("l_discount", "l_quantity", "l_orderkey", "l_linenumber")], ["l_orderkey", "l_linenumber", "l_discount"])


# ---- joins and sets


@query("SELECT s_suppkey, coalesce(n_name, 'unknown') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def lookup_left_join(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def semi_exists(spark, sf):
    l = table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(l, "o_orderkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_existing(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@query("SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_suppkey = c_custkey OR CAST(floor(s_acctbal) AS BIGINT) = CAST(floor(c_acctbal) AS BIGINT)")
def or_join_union(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.floor("s_acctbal").alias("s_bal"))
    c = table(spark, sf, "customer").select("c_custkey", F.floor("c_acctbal").alias("c_bal"))
    return R.or_join(s, c, [("s_suppkey", "c_custkey"), ("s_bal", "c_bal")], "s_suppkey", "c_custkey")


@query("""SELECT r_name, o.v AS option_a, p.v AS option_b FROM region, (VALUES (NULL), ('x'), ('y')) o(v), (VALUES (NULL), ('z')) p(v)""")
def cross_option_product(spark, sf):
    none = F.lit(None).cast("string")
    r = table(spark, sf, "region").select("r_name", F.explode(F.array(none, F.lit("x"), F.lit("y"))).alias("option_a"))
    return r.select("*", F.explode(F.array(none, F.lit("z"))).alias("option_b"))


@query("""SELECT c_nationkey AS nation, min(src) AS src FROM (SELECT c_nationkey, 0 AS src FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey, 1 FROM supplier) GROUP BY 1""")
def union_priority_distinct(spark, sf):
    a = table(spark, sf, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"), F.lit(0).alias("src")).distinct()
    return R.union_first([a, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit(1).alias("src")).distinct()], ["nation"], [F.col("src")])


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def set_except(spark, sf):
    dear = table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    return R.missing_from(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), dear, ["k"])


# ---- aggregates and health


@query("""SELECT event_type, bucket, count(*) AS n FROM (SELECT coalesce(event_type, 'unknown') AS event_type, CAST(user_id % 4 AS VARCHAR) AS bucket FROM events) GROUP BY GROUPING SETS ((event_type, bucket), (event_type), (bucket))""")
def group_rollup_stats(spark, sf):
    return R.rollups(table(spark, sf, "events").withColumn("bucket", F.col("user_id") % 4), ["event_type", "bucket"])


@query("""SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05 AND l_quantity > 25) AS strong, count(*) FILTER (WHERE l_discount > 0.05 AND l_quantity > 25) >= 10 AS covered FROM lineitem GROUP BY 1""")
def conditional_count(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if((F.col("l_discount") > 0.05) & (F.col("l_quantity") > 25)).alias("strong"))
    return g.withColumn("covered", F.col("strong") >= 10)


def measured(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    bad = table(spark, sf, "labels").where("quality = 0").select("doc_id")
    d = d.withColumn("c", F.col("n_chars") % 100 / 100)
    filled = F.when(F.col("lang") == "en", 1).otherwise(0) + F.when(F.col("n_chars") > 1000, 1).otherwise(0)
    return H.metrics(d.join(bad, "doc_id", "left_anti"), d.join(bad, "doc_id", "left_semi"), "source", "c", filled, 2, F.col("n_chars") > 500, F.col("doc_id") % 3 != 0)


HEALTH = """WITH d AS (SELECT doc_id, source, lang, n_chars, (n_chars % 100) / 100.0::DOUBLE AS c, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS bad FROM documents),
a AS (SELECT source, count(*) FILTER (WHERE NOT bad) AS n, count(*) FILTER (WHERE bad) AS q, count(*) AS t, avg(c) FILTER (WHERE NOT bad) AS c,
avg(((lang = 'en')::INT + (n_chars > 1000)::INT) / 2.0::DOUBLE) FILTER (WHERE NOT bad) AS f, avg((n_chars > 500)::INT::DOUBLE) FILTER (WHERE NOT bad) AS m, avg((doc_id % 3 <> 0)::INT::DOUBLE) FILTER (WHERE NOT bad) AS r FROM d GROUP BY source),
k AS (SELECT source, n AS sample_size, floor(c * 1000 + 0.5) / 1000 AS avg_confidence, floor(f * 1000 + 0.5) / 1000 AS completeness, floor(m * 1000 + 0.5) / 1000 AS merchant_yield, floor(r * 1000 + 0.5) / 1000 AS freshness,
floor(n / t * 1000 + 0.5) / 1000 AS parse_success, floor(q / t * 1000 + 0.5) / 1000 AS quarantine_rate, q / t AS failure_rate FROM a),
s AS (SELECT *, CASE WHEN sample_size < 3 THEN least(0.55, CASE WHEN avg_confidence > 0 THEN avg_confidence ELSE 0.3 END) ELSE floor(greatest(0.0, least(1.0, avg_confidence * 0.25 + completeness * 0.2 + parse_success * 0.15 + merchant_yield * 0.2 + freshness * 0.1 - quarantine_rate * 0.15 - failure_rate * 0.1)) * 1000 + 0.5) / 1000 END AS score FROM k)
"""


@query(HEALTH + "SELECT source, sample_size, avg_confidence, completeness, merchant_yield, freshness, parse_success, quarantine_rate FROM k")
def health_metrics(spark, sf):
    return measured(spark, sf).drop("failure_rate")


@query(HEALTH + """SELECT source, score, CASE WHEN sample_size < 5 AND source IN ('src1', 'adcb') THEN 'approved' WHEN score >= 0.75 AND quarantine_rate <= 0.15 AND merchant_yield >= 0.6 AND completeness >= 0.5 THEN 'approved' WHEN score >= 0.45 THEN 'probation' ELSE 'rejected' END AS status FROM s""")
def health_classify(spark, sf):
    return H.classify(measured(spark, sf), "source").select("source", "score", "status")


# ---- windows


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3")
def topk_per_group(spark, sf):
    return R.first_per(table(spark, sf, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark, sf):
    return R.best_by(table(spark, sf, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], ["event_id", "event_type"])


@query("SELECT event_id, running FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS running FROM events) WHERE running <= 5 + user_id % 3")
def running_budget(spark, sf):
    return R.within_budget(table(spark, sf, "events"), "user_id", [F.col("ts"), F.col("event_id")], 5 + F.col("user_id") % 3).select("event_id", F.col("running").cast("long").alias("running"))


# ---- changes


@query("""SELECT event_id, CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-01-20') > CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 10 ELSE 14 END THEN 'stale' ELSE 'fresh' END AS freshness FROM events""")
def stale_mark(spark, sf):
    kind = F.when(F.col("event_type") == "click", "couponFeed").when(F.col("event_type") == "view", "merchant").otherwise("x")
    return table(spark, sf, "events").select("event_id", F.when(Q.is_stale(F.col("ts").cast("date"), kind, F.lit("2024-01-20").cast("date")), "stale").otherwise("fresh").alias("freshness"))


@query("SELECT event_id FROM events WHERE NOT (event_type = 'error' AND coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) <= 50)")
def purge_complement(spark, sf):
    k = F.coalesce(T.to_number(F.get_json_object("props", "$.k")), F.lit(0.0))
    return table(spark, sf, "events").where(~F.coalesce((F.col("event_type") == "error") & (k <= 50), F.lit(False))).select("event_id")


@query("""WITH a AS (SELECT o_orderkey, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey, o_totalprice * 2 AS p, 'N' AS s FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
SELECT o_orderkey, CASE WHEN a.o_orderkey IS NULL OR b.p >= 300000 THEN b.p ELSE a.p END AS price, coalesce(a.s, b.s) AS status, CASE WHEN a.o_orderkey IS NULL THEN 'inserted' WHEN b.p >= 300000 THEN 'updated' ELSE 'kept' END AS action FROM a FULL JOIN b USING (o_orderkey)""")
def merge_upsert(spark, sf):
    o = table(spark, sf, "orders")
    old = o.where("o_orderkey % 3 != 0").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    new = o.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"), F.lit("N").alias("status"))
    return R.merge(old, new, ["o_orderkey"], ["price", "status"], F.col("n_price") >= 300000, sticky=["status"])


# ---- payment


WALLET = """array(named_struct('balance_coins', 4000D, 'max_coins', cast(null as double), 'rate', 100D, 'enabled', true)) AS loyalty,
array(named_struct('code', 'A10', 'kind', 'percent', 'value', 10D, 'min_spend', 150D, 'cap', 500D, 'enabled', true), named_struct('code', 'F30', 'kind', 'fixed', 'value', 30D, 'min_spend', cast(null as double), 'cap', cast(null as double), 'enabled', true)) AS coupons,
10D AS membership, array(named_struct('id', 'c1', 'points_rate', 2D, 'gold_rate', 0.01D, 'enabled', true), named_struct('id', 'c2', 'points_rate', 1D, 'gold_rate', 0D, 'enabled', true)) AS cards, array(named_struct('id', 'b1', 'enabled', true)) AS banks"""


def requests(spark, sf):
    return R.spread(table(spark, sf, "orders").select("o_orderkey", "o_totalprice")).selectExpr("o_orderkey AS request_id", "o_totalprice AS amount", *_split(WALLET))


def _split(text: str) -> list[str]:
    """Select items of a comma-separated list, commas inside brackets aside."""
    out, depth, at = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch in "([") - (ch in ")]")
        if ch == "," and not depth:
            out.append(text[at:i])
            at = i + 1
    return [*out, text[at:]]


R2 = "floor(({}) * 100 + 0.5) / 100"
PAY = f"""WITH r AS (SELECT o_orderkey AS request_id, o_totalprice AS amount FROM orders), i(i, card, bank, pr, gr) AS (VALUES (0, 'c1', NULL, 2.0::DOUBLE, 0.01::DOUBLE), (1, 'c2', NULL, 1.0::DOUBLE, 0.0::DOUBLE), (2, NULL, 'b1', NULL, NULL)),
o AS (SELECT r.*, i.*, j, k, m, ((i * 2 + j) * 3 + k) * 2 + m AS ord FROM r, i, (VALUES (0), (1)) x(j), (VALUES (0), (1), (2)) y(k), (VALUES (0), (1)) z(m)),
a AS (SELECT *, CASE WHEN j = 1 AND least(4000.0::DOUBLE, amount * 100) / 100 >= 0.01 THEN {R2.format('least(4000.0::DOUBLE, amount * 100) / 100')} ELSE 0.0::DOUBLE END AS l FROM o),
b AS (SELECT *, {R2.format('amount - l')} AS r1 FROM a),
c AS (SELECT *, CASE WHEN k = 1 AND amount >= 150 THEN {R2.format('least(r1 * 10.0::DOUBLE / 100, 500.0::DOUBLE, r1)')} WHEN k = 2 THEN {R2.format('least(30.0::DOUBLE, r1)')} ELSE 0.0::DOUBLE END AS cp FROM b),
d AS (SELECT *, {R2.format('r1 - cp')} AS r2 FROM c),
e AS (SELECT *, CASE WHEN m = 1 THEN {R2.format('r2 * 10.0::DOUBLE / 100')} ELSE 0.0::DOUBLE END AS mb FROM d),
f AS (SELECT *, {R2.format('r2 - mb')} AS r3, greatest(0.0::DOUBLE, {R2.format('l + cp + mb - amount * 0.9::DOUBLE')}) AS over FROM e),
g AS (SELECT *, CASE WHEN mb > 0 THEN l ELSE CASE WHEN cp > 0 THEN l ELSE {R2.format('greatest(0.0::DOUBLE, l - over)')} END END AS l2, CASE WHEN mb > 0 THEN cp WHEN cp > 0 THEN {R2.format('greatest(0.0::DOUBLE, cp - over)')} ELSE cp END AS cp2, CASE WHEN mb > 0 THEN {R2.format('greatest(0.0::DOUBLE, mb - over)')} ELSE mb END AS mb2, {R2.format('greatest(0.0::DOUBLE, r3 + over)')} AS pay FROM f),
h AS (SELECT *, {R2.format('l2 + cp2 + mb2 + 0.0::DOUBLE')} AS total, greatest(0.0::DOUBLE, pay - (cp2 + mb2)) AS base FROM g),
w AS (SELECT *, CAST(floor(coalesce(base * pr, 0.0::DOUBLE) + 1e-9::DOUBLE) AS BIGINT) AS points, {R2.format('coalesce(base * gr, 0.0::DOUBLE)')} AS gold_mg FROM h WHERE pay <= amount)
"""


@query(PAY + "SELECT request_id, ord, l2 AS loyalty_aed, cp2 AS coupon_aed, mb2 AS member_aed, pay, total, points, gold_mg FROM w")
def pay_layers(spark, sf):
    return P.layers(P.options(requests(spark, sf))).select("request_id", "ord", "loyalty_aed", "coupon_aed", "member_aed", "pay", "total", F.col("points").cast("long").alias("points"), "gold_mg")


@query(PAY + "SELECT request_id, ord, l2 AS loyalty_aed, cp2 AS coupon_aed, mb2 AS member_aed, pay, total, points, gold_mg FROM w")
def pay_layers_all(spark, sf):
    return P.layers(P.options(requests(spark, sf))).select("request_id", "ord", "loyalty_aed", "coupon_aed", "member_aed", "pay", "total", F.col("points").cast("long").alias("points"), "gold_mg")


@query(PAY + "SELECT request_id, card AS card_id, bank AS bank_id, total, pay, points FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY total DESC, ord) AS n FROM w) WHERE n = 1")
def pay_best(spark, sf):
    return P.best_combination(requests(spark, sf)).select("request_id", "card_id", "bank_id", "total", "pay", F.col("points").cast("long").alias("points"))


@query(PAY + """, z AS (SELECT *, coalesce(card, bank) AS instrument, row_number() OVER (PARTITION BY request_id, coalesce(card, bank) ORDER BY total DESC, ord) AS n, row_number() OVER (PARTITION BY request_id ORDER BY total DESC, ord) AS t FROM w)
SELECT request_id, instrument, total, pay, t = 1 AS recommended FROM z WHERE n = 1""")
def pay_instruments(spark, sf):
    return P.per_instrument(P.layers(P.options(requests(spark, sf))))


@query(PAY + """, d1 AS (SELECT *, row_number() OVER (PARTITION BY request_id, card, bank, total ORDER BY ord) AS n FROM w), t5 AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY total DESC, ord) AS rank FROM d1 WHERE n = 1)
SELECT request_id, CAST(rank AS INTEGER) AS rank, card AS card_id, bank AS bank_id, total, pay FROM t5 WHERE rank <= 5""")
def pay_top5(spark, sf):
    return P.top_combinations(requests(spark, sf)).select("request_id", "rank", F.col("card.id").alias("card_id"), "bank_id", "total", "pay")


@query("""SELECT owner, code, max_by(value, pri * 1000000 + value) AS value FROM (SELECT p_brand AS owner, upper(p_type) AS code, p_retailprice AS value, 1 AS pri FROM part WHERE p_size < 25 UNION ALL SELECT p_brand, upper(p_type), p_retailprice, 0 FROM part) GROUP BY 1, 2""")
def coupon_merge_priority(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("owner"), F.col("p_type").alias("code"), F.col("p_retailprice").alias("value"), "p_size")
    return P.merged_coupons(p.where("p_size < 25").drop("p_size"), p.drop("p_size"))


# ---- JSON


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("SELECT event_id, '{\"k\":' || json_extract_string(props, '$.k') || ',\"t\":\"' || event_type || '\"}' AS j FROM events")
def json_roundtrip(spark, sf):
    e = table(spark, sf, "events").withColumn("s", F.from_json("props", "k long"))
    return e.select("event_id", F.to_json(F.struct(F.col("s.k").alias("k"), F.col("event_type").alias("t"))).alias("j"))


# ---- rules by cases: each row of a table takes one case by its key, with the result that the rule says


def _case(column, values):
    """The value of a row's case; Python's None is null."""
    n = len(values)
    out = None
    for i, v in enumerate(values):
        cond = F.pmod(column, F.lit(n)) == i
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def _case_sql(column, values):
    text = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN {text(v)}" for i, v in enumerate(values)) + " END"


DISCOUNTS = [
    ("Enjoy 15% off on all orders", "percent", "15"),
    ("Save AED 40 today", "fixed", "40"),
    ("Get 10% cashback on groceries", "cashback", "10"),
    ("Earn USD 12 cashback abroad", "cashback", "12"),
    ("Rooms starting from AED 1,299 a night", None, None),
    ("0% interest for you", "percent", "0"),
    ("Complimentary lounge visits", "complimentary", None),
    ("Pay in 6 months plan", "emi", "6 months plan"),
    ("Collect 2,500 bonus points", "points", "2500"),
    ("Use code: SUMMER now", "coupon", None),
    ("Nothing to see here", None, None),
    ("Easy payment plan for all", None, None),
    ("", None, None),
    (None, None, None),
]


@query(f"SELECT l_orderkey, l_linenumber, {_case_sql('(l_orderkey + l_linenumber)', [k for _, k, _ in DISCOUNTS])} AS kind, {_case_sql('(l_orderkey + l_linenumber)', [v for *_, v in DISCOUNTS])} AS value FROM lineitem")
def discount_cases(spark, sf):
    text = _case(F.col("l_orderkey") + F.col("l_linenumber"), [t for t, *_ in DISCOUNTS])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", T.detect_discount(text).alias("d")).select("l_orderkey", "l_linenumber", F.col("d.type").alias("kind"), F.col("d.value").alias("value"))


ADDRESSES = [
    ("https://www.emiratesnbd.com/en/deals", "emiratesNbd"),
    ("https://www.bankfab.com/en-ae/offers", "fab"),
    ("HTTPS://WWW.ADCB.COM/offers", "adcb"),
    ("https://www.mashreq.com/neo/offers/x", "mashreq"),
    ("https://rakbank.ae/promotions", "rakBank"),
    ("https://www.dib.ae/offers", "dib"),
    ("https://www.hsbc.ae/offers", "hsbc"),
    ("https://www.citibank.ae/deals", "citibank"),
    ("https://www.cbd.ae/offers", "cbd"),
    ("https://www.visamiddleeast.com/en_ae/x", "visaUAE"),
    ("https://visa.co.ae/offers", "visaUAE"),
    ("https://www.mastercard.ae/x", "mastercard"),
    ("https://www.groupon.ae/x", "groupon"),
    ("https://www.cuponation.ae/x", "cuponation"),
    ("https://www.picodi.com/ae/x", "picodi"),
    ("https://coupons.ae/x", "couponsAe"),
    ("https://www.wethrift.com/x", "wethrift"),
    ("https://smiles.ae/x", "smiles"),
    ("https://www.noon.com/uae-en/deal/x", "noon"),
    ("https://www.noon.com/uae-en/x", "generic"),
    ("https://example.com/voucher/1", "couponFeed"),
    ("https://www.google.com/search?q=x", "discovery"),
    ("https://example.com/", "generic"),
    (None, "generic"),
]


@query(f"SELECT o_orderkey, {_case_sql('o_orderkey', [t for _, t in ADDRESSES])} AS source_type FROM orders")
def url_types(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", U.source_type(_case(F.col("o_orderkey"), [u for u, _ in ADDRESSES])).alias("source_type"))


def _gate(**fields):
    return {"offer_title": "Dinner for two", "merchant_name": "Lulu", "discount_type": "percent", "discount_value": "20", "source_type": "generic", "page_length": 900, "confidence": 0.8} | fields


GATES = [
    (_gate(), ""),
    (_gate(offer_title=None, merchant_name=None, discount_type=None, discount_value=None), "missing_minimum_fields,zero_value_junk"),
    (_gate(offer_title="Oops!"), "garbage_title"),
    (_gate(offer_description="We can't seem to find the page"), "error_page"),
    (_gate(raw_text="Try one of these popular Visa pages instead"), "visa_shell_page"),
    (_gate(coupon_code="HERE"), "invalid_coupon"),
    (_gate(page_length=150, merchant_name=None, discount_value=None), "thin_page"),
    (_gate(valid_to="1999-01-01"), "malformed_valid_to"),
    (_gate(valid_from="soon"), "malformed_valid_from"),
    (_gate(discount_value="120"), "absurd_values"),
    (_gate(offer_title="Seasonal offers", merchant_name=None, discount_type=None, discount_value=None), "category_header"),
    (_gate(source_type="visaUAE", crawl_depth=1, offer_title="Cards & Rewards", merchant_name=None, discount_type=None, discount_value=None), "category_header,generic_visa_detail"),
    (_gate(strict=True, merchant_name=None, discount_value=None), "strict_missing_merchant_and_value"),
    (_gate(strict=True, confidence=0.2), "strict_low_confidence"),
    (_gate(source_type="adcb", raw_text="ADCB logo facebook"), "adcb_nav_noise"),
    (_gate(source_type="adcb", raw_text="Pay with TouchPoints"), "touchpoints_only"),
    (_gate(source_type="fab", merchant_name=None), "bank_missing_checkout_signal"),
    (_gate(min_spend="-5"), "absurd_values"),
]


@query(f"SELECT o_orderkey, {_case_sql('o_orderkey', [r for _, r in GATES])} AS reasons FROM orders")
def gate_cases(spark, sf):
    names = sorted({n for g, _ in GATES for n in g})
    n = F.pmod(F.col("o_orderkey"), F.lit(len(GATES)))
    df = table(spark, sf, "orders").select("o_orderkey", *(_case(F.col("o_orderkey"), [g.get(c) for g, _ in GATES]).alias(c) for c in names), n.alias("case"))
    df = Q.offers(df).withColumn("reasons", Q.gate_reasons(F.col("strict").cast("boolean")))
    return df.select("o_orderkey", F.array_join("reasons", ",").alias("reasons"))


# ---- offers made of orders through the ingestion's own steps


def keyed_offers(spark, sf):
    """Orders as offers: a customer and a status are a shop and a bank, every second order of a customer says no more than the first."""
    o = table(spark, sf, "orders")
    title = F.concat(F.lit("Deal number "), (F.col("o_orderkey") % 7).cast("string"))
    fields = {
        "normalized_url": F.concat(F.lit("https://shop.example/"), (F.col("o_custkey") % 50).cast("string")),
        "merchant_name": F.concat(F.lit("Shop "), F.col("o_custkey").cast("string")),
        "bank_name": F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")),
        "offer_title": title,
        "offer_description": F.when(F.col("o_orderkey") % 3 == 0, "more"),
        "discount_type": F.lit("percent"),
        "discount_value": (F.col("o_orderkey") % 5).cast("string"),
        "coupon_code": F.lit(None).cast("string"),
        "valid_to": F.when(F.col("o_orderkey") % 2 == 0, "2026-01-01"),
    }
    return Q.offers(o.select("o_orderkey", *(x.alias(c) for c, x in fields.items()), F.lit("url").alias("source_url")))


KEYED = """WITH k AS (SELECT o_orderkey, 'https://shop.example/' || (o_custkey % 50) AS url, 'Shop ' || o_custkey AS shop, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS bank, 'Deal number ' || (o_orderkey % 7) AS title,
CASE WHEN o_orderkey % 3 = 0 THEN 'more' END AS about, CAST(o_orderkey % 5 AS VARCHAR) AS val, CASE WHEN o_orderkey % 2 = 0 THEN '2026-01-01' END AS until FROM orders)
"""


@query(KEYED + """SELECT o_orderkey, sha256(concat_ws('::', url, lower(shop), coalesce(lower(bank), ''), lower(title), '', 'percent', val)) AS canonical_key, sha256(concat_ws('::', url, lower(title), '')) AS dedupe_hash,
sha256('{"cap_value":null,"coupon_code":null,"discount_type":"percent","discount_value":"' || val || '","merchant_name":"' || shop || '","min_spend":null,"offer_description":' || coalesce('"' || about || '"', 'null') || ',"offer_title":"' || title || '","valid_to":' || coalesce('"' || until || '"', 'null') || '}') AS snapshot_hash FROM k""")
def offer_keys(spark, sf):
    return Q.with_keys(keyed_offers(spark, sf)).select("o_orderkey", "canonical_key", "dedupe_hash", "snapshot_hash")


@query(KEYED + """SELECT url || shop || coalesce(bank, '') || title || val AS what, max_by(o_orderkey, (CASE WHEN about IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN until IS NOT NULL THEN 1 ELSE 0 END) * 1000000000 + o_orderkey) AS o_orderkey FROM k GROUP BY 1""")
def preferred_offers(spark, sf):
    df = Q.with_keys(keyed_offers(spark, sf)).withColumns({"confidence": F.lit(0.5), "scraped_at": F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), "row_id": F.lit("x"), "row_at": F.lit(0), "discovery_query": F.col("o_orderkey").cast("string")})
    what = F.concat("normalized_url", "merchant_name", F.coalesce("bank_name", F.lit("")), "offer_title", "discount_value")
    return I.preferred(df).select(what.alias("what"), F.col("discovery_query").cast("long").alias("o_orderkey"))


@query("""WITH s AS (SELECT s_suppkey, 'host' || s_nationkey AS host, CASE s_suppkey % 3 WHEN 0 THEN 'Ferrari World' WHEN 1 THEN 'ferrari  world' ELSE '' END AS shop, CASE WHEN s_suppkey % 2 = 0 THEN 'ADCB' END AS bank, CASE s_suppkey % 4 WHEN 0 THEN 'Summer deal' WHEN 1 THEN 'Big summer deal!' WHEN 2 THEN 'Winter' END AS title FROM supplier),
k AS (SELECT *, regexp_replace(regexp_replace(lower(trim(shop)), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS m, regexp_replace(regexp_replace(lower(trim(title)), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS t FROM s)
SELECT x.s_suppkey AS a, y.s_suppkey AS b FROM k x JOIN k y ON x.host = y.host AND x.m = y.m AND coalesce(x.bank, '') = coalesce(y.bank, '') AND x.s_suppkey < y.s_suppkey WHERE x.m <> '' AND x.t <> '' AND y.t <> '' AND (contains(x.t, y.t) OR contains(y.t, x.t))""")
def likely_duplicate_offers(spark, sf):
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("host"), F.col("s_nationkey").cast("string")).alias("host"), F.when(k % 3 == 0, "Ferrari World").when(k % 3 == 1, "ferrari  world").otherwise("").alias("shop"), F.when(k % 2 == 0, "ADCB").alias("bank"), F.when(k % 4 == 0, "Summer deal").when(k % 4 == 1, "Big summer deal!").when(k % 4 == 2, "Winter").alias("title"))
    return R.likely_duplicates(s, "s_suppkey", "host", "shop", "bank", "title", [])


# ---- records of runs, look-ups, registry


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'completed' WHEN c_custkey % 3 = 1 THEN 'failed' ELSE 'running' END AS status, CASE WHEN c_custkey % 3 = 1 THEN 'stopped' END AS error FROM customer""")
def run_states(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    runs = N.started_runs(c, F.lit("2026-01-01"))
    n = F.get_json_object("input", "$.c_custkey").cast("long") % 3
    done = runs.where(n < 2).select("run_id", F.when(n == 0, "completed").otherwise("failed").alias("status"), F.lit("{}").alias("stats"), F.lit("2026-01-02").cast("timestamp").alias("finished_at"), F.when(n == 1, "stopped").alias("error"))
    return N.finished_runs(runs, done).select(F.get_json_object("input", "$.c_custkey").cast("long").alias("c_custkey"), "status", "error")


@query(HEALTH + """SELECT source, 'validation' AS observation_type, m AS metric_name, CASE m WHEN 'avg_confidence' THEN avg_confidence WHEN 'completeness' THEN completeness ELSE quarantine_rate END AS metric_value FROM k, (VALUES ('avg_confidence'), ('completeness'), ('quarantine_rate')) t(m)""")
def health_observations(spark, sf):
    return N.observations(measured(spark, sf), "source", ["avg_confidence", "completeness", "quarantine_rate"])


@query(ORDER_OFFERS + """SELECT 'generic' AS source, reason, count(*) AS n, min(o_orderkey) AS sample FROM (SELECT o_orderkey, unnest(reasons) AS reason FROM r) GROUP BY 2""")
def gate_failures(spark, sf):
    df = order_offers(spark, sf).withColumn("reasons", Q.gate_reasons(score="parser_confidence"))
    return N.failures(df, "source_type", "reasons", "o_orderkey")


@query("""SELECT event_id, coalesce(event_type, 'generic') AS source_type, json_extract_string(payload, '$.k') AS k FROM (SELECT event_id, event_type, props AS payload FROM events)""")
def raw_event_rows(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("source_type"), "props")
    rows = N.raw_events(e, F.lit("r1"))
    return rows.select(F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"), "source_type", F.get_json_object(F.get_json_object("payload", "$.props"), "$.k").alias("k"))


@query(f"SELECT page_id FROM (SELECT page_id, row_number() OVER (PARTITION BY {HOST} ORDER BY page_id DESC) AS n FROM pages) WHERE n <= 20")
def newest_per_host(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return N.newest_per_host(p, U.hostname(F.col("url")), [F.col("page_id").desc()]).select("page_id")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey = 7 AND s_name = (SELECT s_name FROM supplier WHERE s_suppkey = 7)")
def point_lookup(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return N.find(s, s_suppkey=7)


@query("SELECT p_brand AS bank_name, p_name AS product_name, p_partkey FROM part WHERE contains(lower(p_brand), '#1') AND contains(lower(p_type), 'a') ORDER BY p_brand, p_name, p_partkey LIMIT 100")
def card_product_list(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("bank_name"), F.col("p_type").alias("card_network"), F.concat_ws("\u0001", "p_name", F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("product_name"), F.col("p_name").alias("_name"), "p_partkey")
    return N.card_products(p, bank="#1", network="A").select("bank_name", F.col("_name").alias("product_name"), "p_partkey")


@query("""SELECT source_type, least, least_strong, coalesce(n, 0) AS n, coalesce(strong, 0) AS strong, coalesce(n, 0) >= least AND coalesce(strong, 0) >= least_strong AS covered FROM (VALUES ('A', 10, 5), ('N', 100, 100000000), ('missing', 1, 0)) t(source_type, least, least_strong)
LEFT JOIN (SELECT l_returnflag AS source_type, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05 AND l_quantity > 25) AS strong FROM lineitem GROUP BY 1) USING (source_type)""")
def source_coverage(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("source_type"), "l_discount", "l_quantity")
    limits = spark.createDataFrame([("A", 10, 5), ("N", 100, 100_000_000), ("missing", 1, 0)], "source_type string, least int, least_strong int")
    return G.coverage(rows, limits, (F.col("l_discount") > 0.05) & (F.col("l_quantity") > 25)).select("source_type", "least", "least_strong", "n", "strong", "covered")


@query("""SELECT p_partkey FROM part WHERE NOT (contains(lower(p_name), 'ring') OR (p_size % 2 = 0 AND p_size <= 30 AND p_size % 10 <= 1))""")
def purge_noise(spark, sf):
    s = F.col("p_size")
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("offer_title"), F.lit(None).cast("string").alias("offer_description"), F.when(s % 2 == 1, "Shop").alias("merchant_name"), (s % 10).cast("string").alias("discount_value"), F.when(s <= 30, "points").otherwise("percent").alias("discount_type"))
    return G.purge(p, ["ring"]).select("p_partkey")


@query(f"""WITH h AS (SELECT DISTINCT url, regexp_replace({HOST}, '^www\\.', '') AS host FROM pages) SELECT host, hits, array_to_string(list_slice(list_sort(urls), 1, 5), ' ') AS first_urls, queries FROM (SELECT host, list(url) AS urls FROM h GROUP BY 1) JOIN (SELECT regexp_replace({HOST}, '^www\\.', '') AS host, count(*) AS hits, count(DISTINCT page_id % 9) AS queries FROM pages GROUP BY 1) USING (host)""")
def discovery_hosts(spark, sf):
    p = table(spark, sf, "pages").select("url", (F.col("page_id") % 9).cast("string").alias("query"))
    return D.candidates(p).select("host", "hits", F.array_join("urls", " ").alias("first_urls"), "queries")


@query("SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity >= 45 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity <= 5")
def missing_keys(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), "l_quantity")
    return R.missing_from(l.where("l_quantity >= 45"), l.where("l_quantity <= 5"), ["k"])


STATES = ["approved", "probation", "rejected", None, "unknown"]


@query(f"""SELECT c_custkey, st IS NULL OR st <> 'rejected' AS ingests, coalesce(st IN ('approved', 'probation', 'rejected'), false) AS may_change, CASE st WHEN 'approved' THEN 'Continue automated crawl at normal quality gates.' WHEN 'probation' THEN 'Tighter quality gates active. Improve parser for ' || c_mktsegment || ' before promoting.' ELSE 'Excluded from crawl planning. Manual review required to re-enable.' END AS advice
FROM (SELECT c_custkey, c_mktsegment, {_case_sql('c_custkey', STATES)} AS st FROM customer)""")
def source_states(spark, sf):
    st = _case(F.col("c_custkey"), STATES)
    return table(spark, sf, "customer").select("c_custkey", N.may_ingest(st).alias("ingests"), N.may_change(st, F.lit("approved")).alias("may_change"), N.advice(st, F.col("c_mktsegment")).alias("advice"))


@query(f"""SELECT DISTINCT dom AS domain FROM (SELECT 'd' || (s_suppkey % 17) AS dom, {_case_sql('s_suppkey', STATES)} AS st, s_suppkey % 2 = 0 AS auto FROM supplier) WHERE st = 'approved' OR (st = 'probation' AND auto)""")
def crawl_domains(spark, sf):
    k = F.col("s_suppkey")
    return N.approved_domains(table(spark, sf, "supplier").select(F.concat(F.lit("d"), (k % 17).cast("string")).alias("domain"), _case(k, STATES).alias("status"), (k % 2 == 0).alias("auto_crawl")))


BANK_NAMES = [(" ADCB  bank ", "ADCB"), ("fab", "First Abu Dhabi Bank"), ("ENBD", "Emirates NBD"), ("Citi", "Citibank"), ("Other  Bank", "Other Bank"), ("", None), (None, None)]
TIERS = [("gold", "GOLD"), (" Platinum ", "PLATINUM"), ("my  tier", "MY TIER"), (None, None)]
NETWORK_NAMES = [("master card", "Mastercard"), ("American  Express", "Amex"), ("VISA", "Visa"), ("Maestro", "Maestro")]
PROGRAM_NAMES = [("ABC Rewards", "abc_loyalty"), ("Skywards", "skywards"), ("My Own Club", "my_own_club")]


@query(f"""SELECT c_custkey, {_case_sql('c_custkey', [b for _, b in BANK_NAMES])} AS bank, {_case_sql('c_custkey', [b for _, b in TIERS])} AS tier, {_case_sql('c_custkey', [b for _, b in NETWORK_NAMES])} AS network, {_case_sql('c_custkey', [b for _, b in PROGRAM_NAMES])} AS program FROM customer""")
def instrument_names(spark, sf):
    k = F.col("c_custkey")
    at = lambda pairs: _case(k, [a for a, _ in pairs])
    return table(spark, sf, "customer").select("c_custkey", W.bank(at(BANK_NAMES)).alias("bank"), W.tier(at(TIERS)).alias("tier"), W.network(at(NETWORK_NAMES)).alias("network"), W.program(at(PROGRAM_NAMES)).alias("program"))


# ---- rules of single sites


SLUGS = [
    ("hsbc", "https://www.hsbc.ae/special-offers/marina-hotel-25-off-on-rooms-05-06-2027/", "percent", "25", "Marina", "2027-06-05"),
    ("hsbc", "https://www.hsbc.ae/special-offers/airalo-3gb-free/", "fixed", "3", "Airalo", None),
    ("hsbc", "https://www.hsbc.ae/special-offers/cafe-bogo-10-off-x/", "percent", "50", "Cafe", None),
    ("hsbc", "https://www.hsbc.ae/special-offers/entertainer-complimentary-12-month/", "fixed", "12", "Entertainer", None),
    ("fab", "https://www.bankfab.com/offers/red-rose-discount-15", "percent", "15", "Red Rose", None),
    ("fab", "https://www.bankfab.com/offers/blue-sky-20-off", "percent", "20", "Blue Sky", None),
    ("cbd", "https://www.cbd.ae/offers/x-20-off-y", None, None, None, None),
]


@query(f"SELECT c_custkey, {', '.join(_case_sql('c_custkey', [s[i] for s in SLUGS]) + f' AS {n}' for i, n in ((2, 'kind'), (3, 'value'), (4, 'merchant'), (5, 'until')))} FROM customer")
def slug_hint_cases(spark, sf):
    k = F.col("c_custkey")
    h = SR.slug_hints(_case(k, [s[1] for s in SLUGS]), _case(k, [s[0] for s in SLUGS]))
    return table(spark, sf, "customer").select("c_custkey", h.alias("h")).select("c_custkey", F.col("h.type").alias("kind"), "h.value", "h.merchant", F.col("h.until").cast("string").alias("until"))


@query("""SELECT c_custkey, tier FROM (SELECT DISTINCT c_custkey, unnest([c_custkey * 10, 1, c_nationkey, 25]) AS tier FROM customer) WHERE tier > 1""")
def cashback_tiers(spark, sf):
    words = F.concat(F.lit("Up to AED "), F.format_number(F.col("c_custkey") * 10, 0), F.lit(" cashback or AED 1 or AED "), F.col("c_nationkey").cast("string"), F.lit(" cash-back, AED 25"))
    p = table(spark, sf, "customer").select("c_custkey", F.lit("https://www.mashreq.com/neo/offers/early-bird-cashback").alias("page_url"), F.lit("mashreq").alias("source_type"), F.lit("t").alias("title"), words.alias("text"))
    return SR.tier_rows(p).select("c_custkey", "tier")


@query("""SELECT s_suppkey, shop, (5 + s_suppkey % 40) || '% cashback at ' || shop AS shop_title FROM (SELECT s_suppkey, unnest([s_name, 'Lulu']) AS shop FROM supplier)
UNION ALL SELECT s_suppkey, 'Zara on weekends', 'Get ' || (5 + s_suppkey % 40) || '% off at Zara on weekends' FROM supplier UNION ALL SELECT s_suppkey, s_name, (5 + s_suppkey % 40) || '% off — ' || s_name FROM supplier""")
def card_benefits(spark, sf):
    k = F.col("s_suppkey")
    html = F.concat(F.lit("<ul><li>Enjoy "), (5 + k % 40).cast("string"), F.lit("% cashback at "), F.col("s_name"), F.lit(", Lulu and Noon.</li><li>Free lounge access</li><li>Get "), (5 + k % 40).cast("string"), F.lit("% off at Zara on weekends</li></ul><h1>"), F.col("s_name"), F.lit("</h1><p>"), (5 + k % 40).cast("string"), F.lit("% discount " + "on rides " * 15 + "</p>"))
    p = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("https://www.mashreq.com/en/cards/credit-cards/"), k.cast("string")).alias("page_url"), F.lit("mashreq").alias("source_type"), html.alias("html"))
    return SR.benefit_rows(p).select("s_suppkey", "shop", "shop_title")


@query("""SELECT url, title, query, CAST(rank AS INT) AS rank FROM (SELECT 'https://shop' || s_suppkey || '.com/deals' AS url, s_name AS title, 'q' || s_suppkey AS query, 10 * (s_suppkey % 3) + 1 AS rank FROM supplier
UNION ALL SELECT 'https://other.com/offers', 'Other offers', 'q' || s_suppkey, 10 * (s_suppkey % 3) + 2 FROM supplier)""")
def result_page_rows(spark, sf):
    k = F.col("s_suppkey").cast("string")
    html = F.concat(F.lit('<a href="/url?q=https://shop'), k, F.lit('.com/deals&amp;sa=U"><h3>'), F.col("s_name"), F.lit('</h3></a><a href="https://www.facebook.com/x"><h3>Blocked</h3></a><a href="https://other.com/offers"><h3>Other  offers</h3></a> text'))
    return SR.result_rows(table(spark, sf, "supplier").select(html.alias("html"), F.concat(F.lit("q"), k).alias("query"), (10 * (F.col("s_suppkey") % 3)).cast("int").alias("offset"))).select("url", "title", "query", "rank")


# ---- sessions, profiles, rewards


@query("""SELECT o_orderkey AS session_id, o_custkey AS user_id, o_totalprice AS amount, 'AED' AS currency, CASE WHEN o_orderkey % 2 = 0 THEN 'pos' ELSE 'online' END AS session_type, 'open' AS status FROM orders WHERE o_totalprice > 0 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_orderkey % 5 <> 0""")
def new_sessions(spark, sf):
    k = F.col("o_orderkey")
    asked = table(spark, sf, "orders").select(k.alias("session_id"), F.col("o_custkey").alias("user_id"), F.when(k % 5 != 0, F.col("o_custkey")).alias("merchant_id"), F.col("o_totalprice").alias("amount"), F.lit(None).cast("string").alias("currency"), F.when(k % 2 == 0, "pos").alias("session_type"))
    shops = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("merchant_id"))
    return W.new_sessions(asked, shops).drop("merchant_id")


@query("""SELECT o_orderkey AS session_id, CASE WHEN o_orderkey % 3 = 0 THEN 'c9' ELSE 'c1' END AS card_id, CASE WHEN o_orderkey % 6 = 0 THEN 'X' END AS coupon_code FROM orders""")
def session_patches(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    sessions = o.select(k.alias("session_id"), F.col("o_custkey").alias("user_id"), F.lit("c1").alias("card_id"), F.lit(None).cast("string").alias("coupon_code"))
    patches = o.where("o_orderkey % 3 < 2").select(k.alias("session_id"), F.when(k % 3 == 0, F.col("o_custkey")).otherwise(-1).alias("user_id"), F.lit("c9").alias("card_id"), F.when(k % 6 == 0, "X").alias("coupon_code"))
    return W.patched_sessions(sessions, patches, ["card_id", "coupon_code"]).drop("user_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1.5 ELSE o_totalprice END AS gross_amount, o_totalprice AS net_amount FROM orders")
def amount_backfill(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"), F.when(F.col("o_orderkey") % 2 == 0, 1.5).alias("gross_amount"), F.lit(None).cast("double").alias("net_amount"))
    return W.backfilled(o).drop("amount")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE 'old' END AS mode, 'kept' AS other, CASE WHEN s_suppkey % 3 = 0 THEN '2' END AS depth FROM supplier""")
def profile_merge(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("t"), (F.col("s_suppkey") % 3).cast("string")).alias("source_type"), F.create_map(F.lit("mode"), F.lit("old"), F.lit("other"), F.lit("kept")).alias("parser_profile"))
    p = lambda k: F.try_element_at("parser_profile", F.lit(k)).alias(k)
    return G.merged_profiles(s, ["t0"], {"mode": "new", "depth": "2"}).select("s_suppkey", p("mode"), p("other"), p("depth"))


@query(f"""SELECT o_orderkey AS request_id, card AS card_id, CAST(floor(o_totalprice * pr + 1e-9::DOUBLE) AS BIGINT) AS points, {R2.format('o_totalprice * gr')} AS gold_mg, gr > 0 AS gold FROM orders, (VALUES ('c1', 2.0::DOUBLE, 0.01::DOUBLE), ('c2', 1.0::DOUBLE, 0.0::DOUBLE)) i(card, pr, gr)""")
def card_rewards(spark, sf):
    r = P.card_rewards(requests(spark, sf))
    return r.select("request_id", "card_id", F.col("points").cast("long").alias("points"), "gold_mg", F.col("label").endswith(" mg GOLD").alias("gold"))


@query(PAY + "SELECT request_id, l2 > 0 AS loyalty, cp2 > 0 AS coupon, mb2 > 0 AS membership, card AS card_id, bank AS bank_id FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY total DESC, ord) AS n FROM w) WHERE n = 1")
def recommended_instruments(spark, sf):
    return P.recommended(P.best_combination(requests(spark, sf)))


from tidewell import merge_queries as _merge_queries  # noqa: E402,F401  registers more queries
from tidewell import page_queries as _page_queries  # noqa: E402,F401
