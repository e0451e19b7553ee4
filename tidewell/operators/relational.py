"""Relational building blocks: filtered pages, lookups, keyed matches, first-wins choices, budgets and merges.

Each is one declarative plan. Ties are always broken by a given order. Disjunctive joins are split into equi-joins,
so none needs a nested loop over two large sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(scan: DataFrame) -> DataFrame:
    """A scan whose rows take long, dealt out over all cores where its files give fewer tasks than there are cores.

    Larger inputs have more tasks than cores and stay where they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan._jdf.rdd().getNumPartitions() < cores else scan


def contains_any(columns: Sequence[str], term: str) -> Column:
    """Case-insensitive search for a text in any of the columns."""
    needle = F.lit(term.lower())
    return F.coalesce(F.greatest(*(F.coalesce(F.contains(F.lower(F.col(c).cast("string")), needle), F.lit(False)) for c in columns)) if len(columns) > 1 else F.contains(F.lower(F.col(columns[0])), needle), F.lit(False))


def contains(column: str, term: str) -> Column:
    return F.coalesce(F.contains(F.lower(F.col(column)), F.lit(term.lower())), F.lit(False))


def page(df: DataFrame, order: Sequence[Column], number: int = 1, size: int = 20) -> DataFrame:
    """One page of an ordered list. Spark keeps only the first number * size rows of each task."""
    if not (1 <= size <= 100 and number >= 1):
        raise ValueError("a page has 1 to 100 rows and pages count from 1")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order. Spark limits groups before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def within_budget(df: DataFrame, key: str, order: Sequence[Column], budget: Column) -> DataFrame:
    """Rows whose running number per key is within the key's budget."""
    return df.withColumn("running", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("running") <= budget)


def best_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """The columns of the greatest row per key, as an aggregate: rows are sorted and combined before the shuffle, so that one row per key and task moves."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_b")).select(*keys, "_b.*")


def multi_key_first(left: DataFrame, left_id: str, keys: Column, index: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """left with the values of the first of its keys that the index (one row per key) has."""
    tried = left.select(left_id, F.posexplode(keys).alias("_at", key))
    hit = tried.join(index.select(key, F.struct(*values).alias("_v")), key).groupBy(left_id).agg(F.min_by("_v", "_at").alias("_v"))
    return left.join(hit, left_id, "left").select(*left.columns, *(F.col(f"_v.{v}").alias(v) for v in values))


def or_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) of rows equal in any of the column pairs, each once."""
    parts = [left.select(left_id, F.col(a).alias("_k")).where("_k is not null").join(right.select(right_id, F.col(b).alias("_k")).where("_k is not null"), "_k").select(left_id, right_id) for a, b in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def missing_from(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The distinct keys of left that right has not; nulls equal nulls."""
    keys = right.select(*(F.col(c).alias(f"_{c}") for c in on)).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return left.select(*on).distinct().join(keys, same, "left_anti")


def union_first(parts: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The union, of rows with one key the one of the first part (then of the given order)."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return first_per(out, keys, [F.col("_part"), *order]).drop("_part")


def suffix_match(urls: DataFrame, url_id: str, host: Column, domains: DataFrame, domain: str, order: Sequence[Column]) -> DataFrame:
    """urls with the best domain row that their host is in or below: a host has few suffixes, each an equi-join key."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keyed = urls.where(host.isNotNull()).select(url_id, F.explode(suffixes).alias(domain))
    best = first_per(keyed.join(domains, domain), [url_id], order)
    return urls.join(best, url_id, "left")


def likely_duplicates(df: DataFrame, row_id: str, host: str, merchant: str, bank: str, title: str, keys: Sequence[str]) -> DataFrame:
    """Pairs (a < b) equal in any key, or of one host and the same merchant and bank by slug, with similar titles.

    Similar titles have equal slugs, or one contains the other. A missing bank equals a missing bank; rows without a
    host, merchant or title match by keys only. Distinct titles meet by a containment join; the pairs of rows are as many
    as there are (containment.groups gives classes in their place).
    """
    from tidewell.functions.text import slugify, step
    from tidewell.operators.containment import containments

    slug = lambda name: F.coalesce(slugify(F.col(name).cast("string")), F.lit(""))
    parts = [or_join(df.select(F.col(row_id).alias("a"), *keys), df.select(F.col(row_id).alias("b"), *keys), [(k, k) for k in keys], "a", "b")] if keys else []
    rows = step(df.select(F.col(row_id).alias("_id"), F.col(host).alias("_host"), *(F.col(c).alias(n) for n, c in (("_m", merchant), ("_b", bank), ("_t", title)))), _merchant=slug("_m"), _bank=slug("_b"), _title=slug("_t")).drop("_m", "_b", "_t")
    rows = rows.where("_host is not null and _merchant != '' and _title != ''")
    block = ["_host", "_merchant", "_bank"]
    met = containments(rows, rows, block, "_title").withColumnsRenamed({"x": "_x", "y": "_y"})
    left, right = rows.withColumnsRenamed({"_id": "_p", "_title": "_x"}), rows.withColumnsRenamed({"_id": "_q", "_title": "_y"})
    # of different texts one is in the other and never both, so only equal texts meet twice: each pair is made once,
    # and the pairs, which may be far more than the rows, need no aggregate unless rows repeat an id or match by keys too
    near = met.join(left, [*block, "_x"]).join(right, [*block, "_y"]).where("_p < _q or _x != _y")
    near = near.select(F.least("_p", "_q").alias("a"), F.greatest("_p", "_q").alias("b")).where("a < b")
    if parts:
        return parts[0].where("a < b").unionByName(near).distinct()
    repeated = df.groupBy(row_id).agg(F.count("*").alias("_n")).where("_n > 1").head(1)
    return near.distinct() if repeated else near


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str], prefer_new: Column, sticky: Sequence[str] = ()) -> DataFrame:
    """Upsert by key: whole rows, new ones where prefer_new holds over o_<column> and n_<column>; sticky columns keep the
    old value unless it is null. action: inserted, updated or kept."""
    o = old.select(*keys, *(F.col(c).alias(f"o_{c}") for c in columns), F.lit(True).alias("_o"))
    n = new.select(*keys, *(F.col(c).alias(f"n_{c}") for c in columns), F.lit(True).alias("_n"))
    both = o.join(n, list(keys), "full_outer")
    take = F.col("_o").isNull() | (F.col("_n").isNotNull() & F.coalesce(prefer_new, F.lit(False)))
    value = lambda c: F.coalesce(F.col(f"o_{c}"), F.col(f"n_{c}")) if c in sticky else F.when(take, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
    action = F.when(F.col("_o").isNull(), "inserted").when(take, "updated").otherwise("kept")
    return both.select(*keys, *(value(c).alias(c) for c in columns), action.alias("action"))


def rollups(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Counts by all levels together and by each alone, in one pass."""
    df = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in levels))
    sets = [list(levels), *([c] for c in levels)]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *levels).agg(F.count("*").alias("n"))
