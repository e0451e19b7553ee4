"""Queries over duplicates, containment and freshness."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import functions as F

from tidewell.functions import text as T
from tidewell.operators import search_index as X
from tidewell.operators.containment import containments, groups, with_checkpoints
from tidewell.operators.relational import spread
from tidewell.queries import SLUG, query, table
from tidewell.sources.sinks import _files
from tidewell.streaming import freshness as S


@query("""WITH e AS (SELECT user_id, event_type, ts, CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 10 ELSE 14 END AS d FROM events WHERE ts IS NOT NULL),
g AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + d * INTERVAL 1 DAY THEN 1 ELSE 0 END AS new FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n, max(ts) + d * INTERVAL 1 DAY AS stale_at FROM i GROUP BY user_id, event_type, k, d""")
def freshness_episodes(spark, sf):
    """When each user's kind of event was fresh: from a first sighting until its window passed without another."""
    kind = F.when(F.col("event_type") == "click", "couponFeed").when(F.col("event_type") == "view", "merchant").otherwise("x")
    return S.episodes(table(spark, sf, "events").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", S.window_days(kind))


@query(f"""WITH RECURSIVE p AS MATERIALIZED (SELECT p_partkey, p_brand, p_type, {SLUG} AS s FROM part),
l AS MATERIALIZED (SELECT a.p_partkey AS a, b.p_partkey AS b FROM p a JOIN p b USING (p_brand, p_type) WHERE contains(a.s, b.s) OR contains(b.s, a.s)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT a AS p_partkey, min(CAST(b AS VARCHAR)) AS root FROM r GROUP BY 1""")
def duplicate_groups(spark, sf):
    """Each part's class under likely duplication: of one brand and type, one name within the other, and so on."""
    part = spread(table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_name"))
    rows = part.select("p_partkey", "p_brand", "p_type", T.slugify(F.col("p_name")).alias("s"))
    return groups(rows, "p_partkey", F.array().cast("array<string>"), ["p_brand", "p_type"], "s")


@query("""WITH p AS (SELECT p_brand, lower(p_name) AS x, regexp_extract(lower(p_name), '^\\S+\\s+(\\S+)', 1) AS y FROM part), y AS (SELECT DISTINCT p_brand, y FROM p WHERE y <> '')
SELECT p_brand, y.y AS y, count(DISTINCT x) AS n FROM p JOIN y USING (p_brand) WHERE contains(p.x, y.y) GROUP BY 1, 2""")
def name_containments(spark, sf):
    """How many of a brand's names contain each word that is second in some name of it."""
    name = F.lower("p_name")
    whole = table(spark, sf, "part").select("p_brand", name.alias("t"))
    second = table(spark, sf, "part").select("p_brand", F.regexp_extract(name, r"^\S+\s+(\S+)", 1).alias("t"))
    return containments(whole, second, ["p_brand"], "t").groupBy("p_brand", "y").agg(F.count("*").alias("n"))


def _deleted(spark, path):
    try:
        fs, at = _files(spark, path)
        fs.delete(at(path), True)
    except Exception:  # noqa: BLE001  the session may be gone already
        return


@query("SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_name), 'old bolt') OR contains(lower(p_type), 'old bolt')")
def indexed_search(spark, sf):
    """Parts whose name or type contains a text, by way of an index built in the shared folder, those of one name together."""
    with_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/search-{uuid.uuid4().hex}"
    atexit.register(_deleted, spark, path)  # the result reads it until the driver ends
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    X.build(parts, ["p_name", "p_type"], F.col("p_name"), path)
    return X.search(spark, path, "p_partkey long, p_name string, p_type string", ["p_name", "p_type"], "OLD Bolt")
