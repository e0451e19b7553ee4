"""Operators 11 to 13 against brute force, and on odd tables."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import centroids as C
from tidewell.llm import mixing as M
from tidewell.llm import periodic as P


def brute_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[s : i + q]
            if len(stretch) >= max(12, 2 * q) and not any(all(stretch[j] == stretch[j + p] for j in range(len(stretch) - p)) for p in range(1, q)):
                out.add((s, len(stretch), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs))


def word_lists(seed):
    r = random.Random(seed)
    fib = ["a", "b"]
    while len(fib[-1]) < 150:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    for _ in range(7):
        thue += thue.translate(str.maketrans("ab", "ba"))
    yield from (list(fib[-1]), list(thue), ["x"] * 137, ["a", "b"] * 40 + ["c"], list("aaaab" * 30) + list("aaaab" * 9)[2:])
    for _ in range(60):
        n, letters = r.randrange(0, 160), r.choice([1, 2, 3, 30])
        words = [str(r.randrange(letters)) for _ in range(n)]
        for _ in range(r.randrange(4)):
            if n:
                a, p, m = r.randrange(n), r.randrange(1, 30), r.randrange(90)
                for i in range(a + p, min(n, a + p + m)):
                    words[i] = words[i - p]
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    for words in word_lists(seed):
        got = [tuple(r) for r in P.runs_of(P.word_ids([w.encode() for w in words])).tolist()]
        assert got == brute_runs(words), words


def test_runs_of_ranges_meet():
    for words in word_lists(9):
        ids = P.word_ids([w.encode() for w in words])
        parts = [P.runs_of(ids, [r]) for r in P.lag_ranges(len(ids))]
        got = P.smallest(np.concatenate([np.zeros((0, 3), np.int64), *parts]))
        assert got.tolist() == P.runs_of(ids).tolist()


def test_long_periodic_texts_take_no_quadratic_time():
    import time

    for unit in (1, 7, 10, 5000):
        ids = np.tile(np.arange(unit), 300_000 // unit)
        began = time.perf_counter()
        assert P.runs_of(ids).tolist() == [[0, len(ids), unit]]
        assert time.perf_counter() - began < 20


def as_query_says(doc_id, text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_runs_query_equals_brute_force(spark, tmp_path):
    r = random.Random(5)
    texts = [(i, " ".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(0, 120)))) for i in range(150)]
    texts += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a b   c\x1c" * 20), (None, "x y " * 10), (7, texts[7][1]), (1004, "word " * 3000)]
    spark.createDataFrame(texts, "doc_id long, text string").withColumn("runs", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, P.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text in texts:
        words = as_query_says(doc_id, text)
        runs = brute_runs(words) if doc_id != 1004 else [(0, 3000, 1)]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute_kept(words, runs))]
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha, len(words)))
    assert got == sorted(want, key=str)


def test_split_texts_give_the_same(spark, odd_rows, docs):
    rows = [*odd_rows, (20, "a b c " * 200), (21, "q w " * 90 + "z " + "q w " * 80), (21, "q w " * 90 + "z " + "q w " * 80)]
    df = docs(rows)
    whole, split = (sorted(map(str, P.periodic_runs(df, split=s).collect())) for s in (1 << 30, 64))
    assert whole == split and len(whole) == len(rows)
    assert P.periodic_runs(df.where("false")).count() == 0


def brute_targets(sizes, weights, most=3):
    total, fixed, left = sum(sizes), {}, dict(enumerate(weights))
    while left:
        share = Fraction(total - sum(fixed.values()), sum(left.values()))
        over = [i for i, w in left.items() if share * w >= most * sizes[i]]
        if not over:
            return [fixed[i] if i in fixed else share * weights[i] for i in range(len(sizes))]
        for i in over:
            fixed[i] = Fraction(most * sizes[i])
            del left[i]
    return [fixed[i] for i in range(len(sizes))]


def test_mixture_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", "bb", "é", "z", None]) if i % 3 else "hot", r.choice([0, 1, 7, 50, None]) if i % 40 else 3000) for i in range(3000)]
    rows += [(5000, "tiny", 2), (5001, "none", 0), (None, "b", 9), (None, "b", 20), (17, "hot", 5)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("taken", F.lit("mine"))
    got = M.mixture(df, "doc_id", "source", F.col("n")).collect()
    assert len(got) == len(rows) and {x["taken"] for x in got} == {"mine"}
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s))
    sizes = [sum(n or 0 for _, s, n in rows if s == name) for name in names]
    want = dict(zip(names, brute_targets(sizes, [i % 3 + 1 for i in range(len(names))]), strict=True))
    key = lambda i: int(hashlib.sha256(f"{M.SEED}:{'' if i is None else i}".encode()).hexdigest()[:15], 16)
    for name, size in zip(names, sizes, strict=True):
        own = [x for x in got if x["source"] == name]
        assert {x["source_size"] for x in own} == {size} and all(math.isclose(x["target"], want[name], rel_tol=1e-12) for x in own)
        budget = round(float(want[name]) + 1e-9)
        assert budget - 2 <= sum(x["_taken"] for x in own) <= budget
        left = budget - (budget // size if size else 0) * size
        for x in sorted(own, key=lambda x: key(x["doc_id"])):
            if x["doc_id"] is not None and x["doc_id"] != 17:
                whole = (budget // size if size else 0) * x["size"]
                assert x["_taken"] == whole + min(left, x["size"]) and x["_taken"] <= 3 * x["size"]
            left -= min(left, x["size"]) if x["doc_id"] is not None or name != "b" else x["_taken"] - (budget // size) * x["size"]
    again = M.mixture(df.repartition(7), "doc_id", "source", F.col("n")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_epochs_hold_what_is_taken(spark):
    df = spark.createDataFrame([(i, "ab"[i % 5 == 0], 10) for i in range(200)], "doc_id long, source string, n long")
    mixed = M.mixture(df, "doc_id", "source", F.col("n"))
    rows = M.epochs(mixed, "doc_id")
    assert rows.where("words < 1 or words > size").count() == 0
    sums = rows.groupBy("doc_id").agg(F.sum("words").alias("w")).join(mixed, "doc_id")
    assert sums.where("w != taken").count() == 0 and rows.agg(F.sum("words")).head()[0] == 2000
    assert rows.groupBy("epoch").count().count() > 1


def test_mixture_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, n long")
    assert M.mixture(empty, "doc_id", "source", F.col("n")).count() == 0
    nothing = spark.createDataFrame([(1, None, None), (2, "a", 0)], "doc_id long, source string, n long")
    assert [(x["target"], x["taken"]) for x in M.mixture(nothing, "doc_id", "source", F.col("n")).collect()] == [(0.0, 0), (0.0, 0)]
    same = spark.createDataFrame([(1, "a", 3)] * 900 + [(2, "b", 1)], "doc_id long, source string, n long")
    got = M.mixture(same, "doc_id", "source", F.col("n"), columns=["doc_id"])
    assert got.count() == 901 and {x["taken"] for x in got.where("doc_id = 1").collect()} == {2}  # 2698 of 2700 words over 900 equal rows


def test_mixture_runs_no_python(spark, monkeypatch):
    plans, keep, final = [], M.Scratch.keep, M.Scratch.final
    seen = lambda df: plans.append(df._jdf.queryExecution().toString()) or df
    monkeypatch.setattr(M.Scratch, "keep", lambda own, df: keep(own, seen(df)))
    monkeypatch.setattr(M.Scratch, "final", lambda own, df: final(own, seen(df)))
    df = spark.createDataFrame([(1, "a", 3), (2, "b", 3)], "doc_id long, source string, n long")
    M.mixture(df, "doc_id", "source", F.col("n"))
    assert len(plans) > 5 and not any(w in p for p in plans for w in ("Python", "Arrow", "Pandas"))


def brute_centroids(vectors, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centers = [v for _, v in first]
    find = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(find(v)[1], []).append(v)
        for j, vs in own.items():
            centers[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *find(v)) for i, v in kept]
    sums = {}
    for _, d, j in found:
        sums[j] = sums.get(j, 0) + d
    return [(i, j, d, sums[j], sum(sums.values()), hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest()) for i, d, j in found]


def test_centroids_equal_brute_force(spark, tmp_path):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(r.normal(size=64) * (0.2 + (i % 7 == 0)))]) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(200, 230)] + [(3, rows[3][1]), (400, None), (401, [1.0] * 63), (402, [float("nan")] * 64), (403, [float("inf")] + [0.0] * 63), (404, [None] + [0.0] * 63), (405, [0.0] * 64), (406, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x")).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(map(tuple, C.op11_centroids(spark, str(tmp_path)).collect()))
    assert got == sorted(brute_centroids(rows))


def test_centroids_of_odd_tables(spark, tmp_path):
    for n, rows in enumerate(([], [(1, None)], [(None, [0.5] * 64), (2, [1e300] * 64)])):
        spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / f"{n}/embeddings.parquet"))
        assert C.op11_centroids(spark, str(tmp_path / f"{n}")).count() == (2 if n == 2 else 0)


def test_partial_distances_abandon_only_what_is_farther():
    r = np.random.default_rng(1)
    for scale in (2, 300):
        x, c = r.integers(-scale, scale, (500, 64)), r.integers(-scale, scale, (40, 64))
        full = ((x[:, None] - c[None]) ** 2).sum(2)
        at, far = C.nearest(x, c)
        assert (at == full.argmin(1)).all() and (far == full.min(1)).all()
    same = np.zeros((3, 64), np.int64)
    assert C.nearest(same, np.zeros((5, 64), np.int64))[0].tolist() == [0, 0, 0]
