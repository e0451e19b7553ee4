import html
import random
import re

import pytest

from tidewell.llm import main_text as mt
from tidewell.llm.main_text_train import MARK, labelled_page, learn

MODEL = mt.load_model()


def test_article_of_the_given_pages(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert mt.main_text(r.html, MODEL) == "\n".join(p for p in parts if p)


def test_held_out_labelled_pages():
    r = random.Random(99)
    pages = [labelled_page(r) for _ in range(200)]
    assert sum(mt.main_text(p, MODEL) == "\n".join(t) for p, t in pages) >= 190


VOCABULARY = "the of and a to in is it you that he was for on are with as his they be at one have this from or had by hot word but what some we can out other were all there when up use your how said an each she which do their time if will way about many then them write would like so these her long make thing see him two has look more day could go come did number sound no most people my over know water than call first who may down side been now find".split()


def english(r, low, high):
    return " ".join(r.choices(VOCABULARY, k=r.randint(low, high)))


def plain_page(r):
    """A page without class names, ids or telling elements, of other words and shape than those of the training."""
    link = lambda: f'<a href="{english(r, 1, 1)}.html">{english(r, 1, 3)}</a>'
    links = lambda n: [link() for _ in range(n)]
    sentence = lambda low, high: english(r, low, high).capitalize() + "."
    main = [english(r, 3, 9).title()]
    inside = f"<h1>{main[0]}</h1>\n"
    for i in range(r.randint(3, 9)):
        if i and r.random() < 0.2:
            main.append(english(r, 2, 5).title())
            inside += f"<h2>{main[-1]}</h2>\n"
        text = " ".join(sentence(6, 25) for _ in range(r.randint(2, 5)))
        main.append(text)
        if r.random() < 0.3:
            a, b, c = text.split(" ", 2)
            text = f"{a} <em>{b}</em> {c}"
        inside += f"<p>{text}</p>\n"
    top = f"<div><a href='/'>{english(r, 1, 3)}</a></div>\n<div>{' '.join(links(r.randint(3, 8)))}</div>"
    side = f"<div><h3>{english(r, 1, 3)}</h3><ul>{''.join(f'<li>{x}</li>' for x in links(r.randint(3, 7)))}</ul></div>"
    promotion = f"<div><a href='/buy'>{sentence(5, 12)}</a></div>"
    form = f"<form action='/s'>{english(r, 1, 2)} <input name='q'> <button>{english(r, 1, 1)}</button></form>"
    foot = f"<div>&copy; 2024 {english(r, 1, 3)} {' | '.join(links(r.randint(2, 5)))}</div>"
    shape = r.randrange(3)
    if shape == 0:
        page = f"{top}{promotion}<div>{inside}</div>{side}{foot}"
    elif shape == 1:
        page = f"<div>{top}</div><div><div>{side}{form}</div><div>{inside}</div></div>{foot}"
    else:
        page = f"{top}<table><tr><td width=200>{side}</td><td>{inside}</td></tr></table>{form}{foot}"
    return f"<html><head><title>{main[0]}</title></head><body>{page}</body></html>", main


def named_page(r):
    """A page with names as common publishing systems write them."""
    page, main = plain_page(r)
    inside = "".join(f"<p>{x}</p>" for x in main[1:])
    link = lambda: f'<a href="/{english(r, 1, 1)}">{english(r, 1, 4)}</a>'
    comments = "".join(f'<li class="comment"><b>{english(r, 1, 2)}</b><p>{english(r, 4, 30)}.</p></li>' for _ in range(r.randint(1, 5)))
    return (
        f'<html><head><title>t</title></head><body class="single"><header class="site-header"><div class="site-branding">{english(r, 1, 3)}</div><nav class="main-navigation"><ul><li>{link()}</li><li>{link()}</li></ul></nav></header>'
        f'<div class="cookie-notice"><p>{english(r, 8, 25)}.</p><button>OK</button></div><div id="content"><article class="post type-post"><h1 class="entry-title">{main[0]}</h1><div class="entry-content">{inside}</div></article>'
        f'<div id="comments" class="comments-area"><ol class="comment-list">{comments}</ol></div></div><aside class="widget-area"><section class="widget"><h2>{english(r, 1, 3)}</h2><ul><li>{link()}</li></ul></section></aside><footer class="site-footer"><p>{english(r, 4, 14)}.</p></footer></body></html>',
        main,
    )


@pytest.mark.parametrize("make", [plain_page, named_page])
def test_pages_of_another_generator(make):
    r = random.Random(2024)
    pages = [make(r) for _ in range(300)]
    right = sum(mt.main_text(p, MODEL) == "\n".join(t) for p, t in pages)
    print(make.__name__, right / len(pages))
    assert right >= 0.95 * len(pages)


def test_training_again_gives_a_like_model():
    r = random.Random(4)
    model = learn([labelled_page(r, MARK) for _ in range(600)])
    w = model["weights"]
    assert w["a:.comment"] < 0 and w["l:0"] > w["l:3"] and w["s:control"] < 0 and len(set(w.values())) > 100
    held = [labelled_page(r) for _ in range(200)]
    assert sum(mt.main_text(p, model) == "\n".join(t) for p, t in held) >= 0.9 * len(held)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<html><head><title>x</title><p>Article one two three</p>", "Article one two three"),
        ("<article><h1>T</h1><p>before <math><mi>x</mi></math> after</p><svg><text>label</text></svg><p>More of it.</p></article>", "T\nbefore x after\nlabel\nMore of it."),
        ("<article><h1>T</h1><canvas>drawn<p>More of the article follows here.</p><object>inside</object></article>", "T\ndrawn\nMore of the article follows here.\ninside"),
        ('<body><div class="x1">Buy now the best new thing of all for less money today</div><article><h1>Head</h1><p>Text of the article. It has a few words.</p></article></body>', "Head\nText of the article. It has a few words."),
        ("<article><h1>Head</h1><select><option>one<option>two<p>The text of the article goes on here.</p></article>", "Head\nThe text of the article goes on here."),
    ],
)
def test_probes(page, text):
    assert mt.main_text(page, MODEL) == text


def test_region_is_the_greatest():
    """The scan against all regions, by block scores."""
    r = random.Random(1)
    for _ in range(50):
        page, _ = labelled_page(r)
        found, containers = mt.read_blocks(page, MODEL["weights"])
        score = mt.word_scores(mt.log_odds(found, containers, MODEL), MODEL)
        total = lambda i, j: sum(score[x] * found[x].size for x in range(i, j)) + MODEL["tag"] * sum(b.tags for b in found[i + 1 : j])  # noqa: B023, E731
        i, j = max(((i, j) for i in range(len(found)) for j in range(i + 1, len(found) + 1)), key=lambda x: total(*x))
        assert mt.main_text(page, MODEL) == ("\n".join(found[x].text for x in range(i, j) if score[x] > 0) if total(i, j) > 0 else "")


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "plain words only"), (5, '<div class="comments"><p>a b c</p></div>'), (6, "<p>x &amp; y<br>z <b>bold"), (7, "<p " * 2000), (7, "<p>twice</p>"), (None, "<p>a\n b c d e f g</p><p>h i j k l m n o")]
    df = spark.createDataFrame([(i, h, "old") for i, h in rows], "page_id long, html string, text string")
    got = mt.extract_main_text(df)
    assert got.columns == ["page_id", "html", "text"]
    assert sorted(r.text for r in got.collect()) == sorted(["", "", "", "plain words only", "", "x & y z bold", "", "twice", "a b c d e f g\nh i j k l m n o"])


LONG = "This is a paragraph of the article with enough words in it to be taken for what it is, a part of the text."


def page(inner):
    return f"<html><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><article><h1>A heading of some words</h1><p>{LONG}</p>{inner}<p>{LONG}</p></article><footer>&copy; x</footer></body></html>"


def lines(inner):
    return mt.main_text(page(inner), mt.load_model()).split("\n")


def test_comments_end_as_the_standard_says():
    whole = lines("")
    for comment in ("<!-->", "<!--->", "<!-- x --!>", "<!-- x -->", "<!---->", "<!-- > -->"):
        assert lines(comment) == whole, comment


def test_a_control_takes_only_its_own_text_along():
    short = "One short paragraph of eleven words that has a control here"
    assert short in " ".join(lines(f"<p>{short} <button>Click me</button></p>"))
    assert not any("Click" in x for x in lines(f"<p>{LONG} <button>Click me</button></p>"))


def test_links_in_an_articles_flow_stay():
    assert "See the full report of the commission" in lines("<p><a href=/r>See the full report of the commission</a></p>")
    got = lines("<ul><li><a href=/1>The first source of this</a></li><li><a href=/2>The second source of this</a></li></ul>")
    assert "The first source of this" in got and "The second source of this" in got
    assert not any("first source" in x for x in lines("<div class=related-links><ul><li><a href=/1>The first source of this</a></li></ul></div>"))


def test_deep_pages_take_linear_time():
    import time

    model = mt.load_model()
    for html in ("<div>x " * 100_000, "".join(f"<div class=n{i}>x " for i in range(60_000)), "<b>" * 100_000 + "</i>" * 100_000, "<div><span>" * 50_000 + "</p>" * 50_000):
        began = time.perf_counter()
        mt.main_text(html, model)
        assert time.perf_counter() - began < 10
