"""Elements of pages, selectors against a walk over the tree, cards of sites."""

import random

import pytest

from tidewell.operators import page_tree as PT
from tidewell.operators import site_selectors as SS


def tree_of(html):
    text, rows = PT._Reader().page(html or "")
    return text, rows


def brute(html, selector):
    """Numbers of the elements that match, by walking up and sideways."""
    _, rows = tree_of(html)

    def alone(row, compound):
        for kind, name, *rest in PT._compound(compound):
            have = row[8].get(name)
            ok = {"tag": name in ("*", row[5]), "class": name in row[7], "id": row[6] == name}.get(kind)
            if kind == "attr":
                op, v = rest
                ok = have is not None and (op is None or op == "=" and have == v or bool(v) and (op == "*=" and v in have or op == "^=" and have.startswith(v) or op == "$=" and have.endswith(v) or op == "~=" and v in have.split()))
            if not ok:
                return False
        return True

    def fits(n, chain):
        how, part = chain[-1]
        row = rows[n]
        if not alone(row, part):
            return False
        if len(chain) == 1:
            return True
        rest, near = chain[:-1], []
        if how == ">":
            near = [row[3]]
        elif how == "+":
            near = [row[4]]
        elif how == "~":
            near = [r[0] for r in rows if r[3] == row[3] and r[0] < n]
        else:
            p = row[3]
            while p >= 0:
                near.append(p)
                p = rows[p][3]
        return any(p >= 0 and fits(p, rest) for p in near)

    return {r[0] for r in rows if any(fits(r[0], PT.steps(a)) for a in PT.alternatives(selector))}


def random_page(r, n):
    out = []
    for _ in range(n):
        tag = r.choice(["div", "p", "ul", "li", "span", "a", "b", "h2", "br", "td", "tr", "table"])
        attrs = r.choice(["", ' class="x"', ' class="x y"', " id=z", ' href="/deals/1"', " data-k"])
        out.append(r.choice([f"<{tag}{attrs}>", f"<{tag}{attrs}>", f"</{tag}>", "word ", "&amp; ", "<!-- c -->"]))
    return "".join(out)


SELECTORS = ["p", ".x", "#z", "div p", "div > p", "ul > li", "p + p", "p ~ span", ".x.y", "a[href]", 'a[href*="deals"], #z b', "div .x > a", "ul li + li b", "* > .y", '[href^="/deals"]', '[href$="1"] ~ [data-k]', "table td > b", "div div div span"]


def test_hits_equal_a_walk(spark):
    r = random.Random(2)
    pages = [(i, random_page(r, 60)) for i in range(25)] + [(100, None), (101, ""), (102, "no tags"), (103, "<p"), (104, "<div class=x>" * 50)]
    found = PT.hits(PT.elements(spark.createDataFrame(pages, "page_id long, html string"), "html", "page_id"), "page_id", SELECTORS).collect()
    got = {}
    for row in found:
        got.setdefault((row["page_id"], row["selector"]), []).append(row["pre"])
    for i, html in pages:
        for s in SELECTORS:
            own = got.get((i, s), [])
            assert len(own) == len(set(own)) and set(own) == brute(html, s), (html, s)


def test_numbers_nest():
    _, rows = tree_of(random_page(random.Random(7), 300))
    for row in rows:
        if row[3] >= 0:
            parent = rows[row[3]]
            assert parent[0] < row[0] and parent[1] > row[1] and parent[2] == row[2] - 1 and parent[9] <= row[9] <= row[10] <= parent[10]
    assert sorted(r[1] for r in rows) == list(range(len(rows)))


def test_tags_that_close_others():
    _, rows = tree_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>x<p>y<div>z</div><table><tr><td>1<td>2<tr><td>3</table></b>")
    tags = [(r[5], r[3]) for r in rows]
    assert tags == [("ul", -1), ("li", 0), ("li", 0), ("ul", 2), ("li", 3), ("li", 0), ("p", -1), ("p", -1), ("div", -1), ("table", -1), ("tr", 9), ("td", 10), ("td", 10), ("tr", 9), ("td", 13)]


def test_deep_pages_take_linear_time():
    import time

    for html in ("<div class='a b'><span>x" * 50_000, "<p>" * 100_000, "<b>" * 50_000 + "<p>" * 50_000, "<li>" * 50_000 + "</ul>" * 50_000):
        began = time.perf_counter()
        tree_of(html)
        assert time.perf_counter() - began < 10


@pytest.mark.parametrize("bad", ["a[", "a:hover", ".", "a..b", "p#"])
def test_unknown_selectors_are_errors(bad):
    with pytest.raises(ValueError):
        [PT._compound(c) for _, c in PT.steps(bad)]


def test_first_selector_that_matches(spark):
    pages = spark.createDataFrame([(1, "fab", "<li>a</li><article>b</article>"), (2, "fab", "<li>a</li><li>b</li>"), (3, "dib", "<li>a</li>"), (4, None, "<div class=card>c</div><div class=offer>o</div>"), (5, "fab", None)], "page_id long, kind string, html string")
    got = PT.first_hits(pages, "page_id", "html", SS.CARDS, "kind").select("page_id", "selector", "place", "text").collect()
    assert sorted(map(tuple, got)) == [(1, "article", 3, "b"), (2, "li", 4, "a"), (2, "li", 4, "b"), (4, ".card", 2, "c")]


def test_cards_of_six_sites(spark):
    pages = [
        (1, "https://www.emiratesnbd.com/en/deals", '<a href="/deals/all">All</a><a href="/deals/x" data-ctatext="Go"><h5>20% off at Lulu</h5>Until May</a>'),
        (2, "https://www.visamiddleeast.com/en_ae/visa-offers-and-perks", '<div class="vs-card"><h3>Spa</h3><a href="https://x.ae/1">more</a></div><div class="vs-card"><p>No heading</p></div>'),
        (3, "https://www.mashreq.com/neo/offers", '<div class="ui-card"><h6>Dine</h6><div class="ui-card"><a href="/neo/offers/d">d</a></div></div>'),
        (4, "https://www.dib.ae/offers", '<div class="card-title-info"><h2>Fly</h2></div>'),
        (5, "https://www.picodi.com/ae/x", '<ul><li class="coupon"><h4>Code</h4></li></ul><div class="coupon-item-big"><h4>Other</h4></div>'),
        (6, "https://rakbank.ae/promotions", '<article><h2>Gold</h2><a href="g">g</a></article>'),
        (7, "https://example.com/", "<p>no cards</p>"),
        (8, None, '<article class="card"><h2>A</h2></article>'),
        (9, "https://example.com/", None),
    ]
    got = SS.cards(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    rows = sorted((r["page_id"], r["title"], r["link"]) for r in got if r["link"]) + sorted((r["page_id"], r["title"]) for r in got if not r["link"])
    assert rows == [
        (1, "20% off at Lulu", "https://www.emiratesnbd.com/deals/x"),
        (2, "Spa", "https://x.ae/1"),
        (3, "Dine", "https://www.mashreq.com/neo/offers/d"),
        (6, "Gold", "https://rakbank.ae/g"),
        (2, "No heading"),
        (4, "Fly"),
        (5, "Code"),
        (5, "Other"),
        (8, "A"),
    ]


def test_links_to_follow(spark):
    pages = [(1, "https://www.emiratesnbd.com/en", '<a href="/deals/x">1</a><a href="/deals/">2</a><a href="/campaigns/deals/y">3</a><a href="/cards">4</a><a href="/deals/x">5</a>'), (2, "https://x.example/", '<a href="/login">1</a><a href="/b">2</a><a>3</a><a href="mailto:a@b.c">4</a>'), (3, None, "<a href='/x'>x</a>")]
    got = SS.links_to_follow(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted(map(tuple, got)) == [(1, "https://www.emiratesnbd.com/deals/x"), (2, "https://x.example/b")]


def test_render_plan(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("https://x.ae/", "fab", "listing", False, "static"), ("https://x.ae/", "visaUAE", "listing", None, "static"), ("https://x.ae/", None, "shell", False, "static"), ("https://x.ae/", "none", "detail", True, "browser")], "u string, s string, p string, n boolean, c string")
    got = [r[0] for r in df.select(SS.render_plan(*map(F.col, "uspnc"))).collect()]
    assert [g["needs_browser"] for g in got] == [False, True, True, True] and [g["settle_ms"] for g in got] == [2000, 2500, 2000, 2000]
    assert got[0]["wait_selector"] == 'h1, h2, .offer, [class*="offer"], main' and got[3]["card_selectors"] == SS.CARDS["generic"]
    kinds = spark.createDataFrame([("static", True), ("browser", False), ("auto", True), ("auto", None), (None, None)], "m string, b boolean").select(SS.crawler_type(F.col("m"), F.col("b")))
    assert [r[0] for r in kinds.collect()] == ["static", "browser", "browser", "static", "static"]


def test_cascade_reads_references_as_its_sql_does(spark, tmp_path):
    import duckdb

    from tidewell.queries import QUERIES, SQL

    texts = ["a &quot;b&quot; &amp;quot; &#39;c&#39;", "cut &amp", "R&D &lt;x&gt; &amp;lt; &lt", "plain &copy &nbsp; &&&amp;"]
    hosts = ["a.com", "a.org", "a.net"]
    rows = [(i * 10 + j, f"https://{host}/p", f'<nav><ul><li><a href="/z">z</a></li></ul></nav><div class="ad">{text}</div><article><h1>{text}</h1><p>{text}</p></article>') for i, host in enumerate(hosts) for j, text in enumerate(texts)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.execute(f"SELECT page_id, selector, n, first_text FROM ({SQL['selector_cascade']}) ORDER BY page_id").fetchall()
    got = QUERIES["selector_cascade"](spark, str(tmp_path)).select("page_id", "selector", "n", "first_text").orderBy("page_id").collect()
    assert list(map(tuple, got)) == expected
    assert {r[3] for r in expected} >= {"cut &amp", 'a &quot;b&quot; &quot; &#39;c&#39;'}


def test_pages_are_read_in_portions(monkeypatch):
    import pyarrow as pa

    html = [f"<ul><li>{i}</li></ul>" * (i % 5) for i in range(50)] + [None, "<p>" + "x" * 500 + "</p>", ""]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(html))), "html": pa.array(html, pa.string())})
    whole = [r for b in PT._read([batch]) for r in b.to_pylist()]
    monkeypatch.setattr(PT, "PORTION", 100)
    parts = list(PT._read([batch]))
    assert len(parts) > 20 and max(b.num_rows for b in parts) < len(html)
    assert [r for b in parts for r in b.to_pylist()] == whole
    assert sum(b.num_rows for b in PT._read([batch.slice(0, 0)])) == 0
