import random
import re

import numpy as np
import pytest

from tidewell.llm import near_dups as nd
from tidewell.llm import near_vectors as nv
from tidewell.llm.common import Scratch
from tidewell.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, links):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    least = {}
    for (k, _), r in zip(rows, root, strict=True):
        if k is not None:
            least[r] = min(k, least.get(r, k))
    return [(k, len(s), least.get(r) if s else k) for (k, _), s, r in zip(rows, sets, root, strict=True)]


def check(df, rows):
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or 0)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(df).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_near_duplicates_like_brute_force(spark, docs, odd_rows):
    r = random.Random(8)
    rows = list(odd_rows)
    for g in range(12):
        words = [f"{r.choice('abcdef')}{r.randrange(500)}" for _ in range(r.randrange(6, 150))]
        for c in range(r.randrange(1, 9)):
            w = list(words)
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
            rows.append((1000 + 10 * g + c, " ".join(w).title() if c % 2 else " ".join(w)))
    check(docs(rows), rows)


def test_one_large_group_of_unlike_versions(spark, docs):
    """Versions of a text at all distances share many buckets without being linked."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(80)] = f"q{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    check(docs(rows), rows)


def test_empty_table(docs):
    assert nd.near_duplicates(docs([])).count() == 0


def test_sketch_estimates_similarity():
    x = np.random.RandomState(0).randint(0, 2**62, 3000).astype(np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[1000:])
    s = nd.registers([a, b, np.union1d(a, b)])
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.15
    assert (np.maximum(s[0], s[1]) == s[2]).all()  # sketches merge
    n = np.array([2000.0])
    assert not nd.plausible(s[:1], s[1:2], n, n, 0.85)[0] and nd.plausible(s[:1], s[:1], n, n, 0.85)[0]


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(r.randrange(400, 700), r.randrange(400, 700)) for _ in range(150)]
    scratch = Scratch(spark)
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
    root = roots(700, links)
    assert got == {i: root[i] for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0
    scratch.drop()


@pytest.mark.parametrize("block", [512, 7])
def test_vectors_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nv, "BLOCK", block)
    r = np.random.RandomState(6)
    base = r.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + 0.12 * r.standard_normal(16)).tolist()) for i in range(240)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, None), (303, [0.0] * 16), (304, [float("nan")] + [1.0] * 15), (305, [float("inf")] * 16), (306, [None] + [1.0] * 15), (307, []), (308, [1.0, 2.0]), (309, [2.0, 4.0]), (None, rows[5][1]), (7, rows[7][1]), (310, [-0.0, 1.0]), (311, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, k string")
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]) and np.dot(rows[i][1], rows[j][1]) >= 0.9 * np.linalg.norm(rows[i][1]) * np.linalg.norm(rows[j][1])]
    root = roots(len(rows), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(rows))
    least = {}
    for (k, _), t in zip(rows, root, strict=True):
        if k is not None:
            least[t] = min(k, least.get(t, k))
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    expected = sorted(((k, int(c), least.get(t)) for (k, _), c, t in zip(rows, n, root, strict=True)), key=key)
    got = sorted(((x.vec_id, x.n_links, x.component_id) for x in nv.near_vectors(df).collect()), key=key)
    assert len(got) == len(expected)
    assert sum(a == b for a, b in zip(got, expected, strict=True)) >= 0.97 * len(expected)
    assert sum(x[1] for x in got) >= 0.98 * 2 * len(links) and all(a[1] <= b[1] for a, b in zip(got, expected, strict=True) if a[0] == b[0] and a[0] is not None and a[0] != 7)


def test_vector_signatures_follow_the_rule():
    bits, tables = nv.tables_for(1_000_000, 0.9)
    assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= 0.999


def test_no_vectors(spark):
    assert nv.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
