"""Learns the scores of main_text.py from labelled pages and writes models/main_text.json.

    python -m tidewell.llm.main_text_train

The labelled pages are generated: an article among menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, with invented words, in many markups: telling names, meaningless names, none, and tables for layout;
every block is labelled as main text or not. A logistic regression over the features of blocks gives the log odds. The
scale of negative scores, the greatest score and the tag's score are those of SCALES, MOSTS and TAGS that get most
pages of a second set whole.
"""

from __future__ import annotations

import json
import os
import random
from collections import Counter

import numpy as np

from tidewell.llm.main_text import features, log_odds, main_text, read_blocks, region, word_scores

PAGES, RIDGE, LEAST = 6000, 1.0, 30
SCALES, MOSTS, TAG_SCORES = (1.0, 0.5, 0.25, 0.1, 0.03), (3.0, 8.0), (-2.0, -1.0, -0.5, -0.2, -0.05)
MARK = "\ue000"
# fixed values: the names that page parts commonly have
NAMES = {
    "nav": ["nav", "navigation", "menu", "navbar", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "tabs"],
    "header": ["header", "masthead", "topbar", "banner", "branding", "logo"],
    "footer": ["footer", "copyright", "colophon", "bottom", "legal"],
    "aside": ["sidebar", "aside", "widget", "related", "recommended", "popular", "trending", "share", "social", "tags", "author", "newsletter", "subscribe"],
    "notice": ["cookie", "consent", "notice", "gdpr", "alert", "popup", "modal", "overlay", "paywall"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "adsense"],
    "form": ["form", "search", "login", "signup", "contact"],
    "comments": ["comment", "comments", "reply", "replies", "disqus", "respond", "discussion"],
}
TAGS = {"nav": ["nav", "div", "ul", "menu"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "notice": ["div", "section", "dialog"], "ad": ["div", "aside", "section", "ins"], "form": ["form", "div", "fieldset"], "comments": ["div", "section", "ol"]}
MAIN = ["article", "content", "post", "entry", "story", "body", "text", "main"]
SYLLABLES = ["an", "er", "st", "le", "on", "mi", "ta", "ou"]


def _words(r: random.Random, low: int, high: int) -> str:
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))


def _sentence(r: random.Random, low: int, high: int) -> str:
    return _words(r, low, high).capitalize() + r.choice([".", ".", ".", "!", "?", "", ":"])


def _links(r: random.Random, low: int, high: int) -> list[str]:
    return [f"<a href='/{_words(r, 1, 1)}'>{_words(r, 1, 4)}</a>" for _ in range(r.randint(low, high))]


def _inner(r: random.Random, part: str) -> str:
    """What a part of a page holds, without its own element."""
    link = lambda: _links(r, 1, 1)[0]
    if part == "nav" or part == "aside" and r.random() < 0.6:
        items = _links(r, 2, 9)
        return r.choice([f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>", " ".join(items), " | ".join(items), "".join(f"<p>{x}</p>" for x in items), "<br>".join(items)])
    if part == "header":
        return r.choice([f"<a href='/'>{_words(r, 1, 3)}</a>", f"<p>{_words(r, 1, 6)}</p>", f"<h2>{_words(r, 1, 3)}</h2><p>{_words(r, 2, 8)}</p>", _words(r, 1, 5)])
    if part == "footer":
        return r.choice([f"&copy; {r.randint(1999, 2030)} {_words(r, 1, 12)}", f"<p>&copy; {_words(r, 1, 5)}</p>" + " ".join(_links(r, 2, 6)), " &middot; ".join([*_links(r, 1, 5), _words(r, 1, 9)]), f"<p>{_sentence(r, 3, 25)}</p>{link()}"])
    if part == "notice":
        return f"{r.choice(['<p>', '<div>', ''])}{_sentence(r, 4, 25)} {r.choice([link(), ''])}{r.choice(['<button>' + _words(r, 1, 2) + '</button>', link(), ''])}"
    if part == "form":
        return "".join(f"{r.choice(['<label>', '<p>', ''])}{_words(r, 1, 3)} <input name='{_words(r, 1, 1)}'>" for _ in range(r.randint(1, 4))) + f"<button>{_words(r, 1, 2)}</button>"
    if part == "comments":
        return "".join(f"{r.choice(['<li>', '<div>', '<p>'])}{link()} {r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(2001, 2030)}<p>{_sentence(r, 2, 40)}</p>" for _ in range(r.randint(1, 5)))
    if part == "ad":
        return r.choice([f"{_sentence(r, 2, 18)} {link()}", f"<h3>{_words(r, 1, 5)}</h3><p>{_sentence(r, 2, 15)}</p>{link()}", f"<p>{_sentence(r, 3, 20)}</p>", _words(r, 2, 14), f"<a href='/x'>{_sentence(r, 3, 14)}</a>"])
    return f"<h3>{_words(r, 1, 4)}</h3><p>{_sentence(r, 3, 25)} {link()}</p>"


def _other(r: random.Random, part: str, names: str) -> str:
    """A part that is no main text. names: telling, odd or none."""
    tag = r.choice(TAGS[part]) if names == "telling" else r.choice(["div", "div", "div", "section", "ul"])
    attribute = ""
    if names == "telling" and (tag in ("div", "section", "ul", "ol", "fieldset", "dialog", "menu", "ins") or r.random() < 0.4):
        attribute = f' {r.choice(["class", "id"])}="{r.choice(NAMES[part])}{r.choice(["", "-box", " wide", "_1"])}"'
    elif names == "odd":
        attribute = f' class="{"".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(1, 6)))}{r.randrange(99)}"'
    return f"<{tag}{attribute}>{_inner(r, part)}</{tag}>"


def labelled_page(r: random.Random, mark: str = "") -> tuple[str, list[str]]:
    """A page and the blocks of its main text, which begin with the mark in the page."""
    names = r.choices(["telling", "odd", "none"], [5, 2, 3])[0]
    longest = r.choice([3, 12, 60, 90])
    main = [_words(r, 1, 12)] + [_words(r, 1, longest) if r.random() < 0.5 else _sentence(r, 1, longest) for _ in range(r.randint(1 if names == "telling" else 2, 12))]
    around, name = r.choice([("article", ""), ("article", r.choice(MAIN)), ("main", ""), ("div", r.choice(MAIN)), ("section", r.choice(MAIN))]) if names == "telling" else r.choice([("", ""), ("div", ""), ("div", ""), ("section", ""), ("article", ""), ("main", "")])
    if around in ("", "div", "section") and not name:  # without names, an article has running text
        main = [main[0], _sentence(r, 25, 90), *(x if r.random() < 0.2 else _sentence(r, 8, 90) for x in main[2:])]
    body = f"<h1>{mark}{main[0]}</h1>"
    for i, block in enumerate(mark + x for x in main[1:]):
        tag = r.choice(["p"] * 7 + ["h2", "li", "blockquote"])
        if r.random() < 0.1 and block.count(" ") > 12:
            a, b = block.split(" ", 1)
            body += f"<p><a href='/s'>{a}</a> {b}</p>"
        else:
            body += f"<ul><li>{block}</li></ul>" if tag == "li" else f"<{tag}>{block}</{tag}>"
        if 0 < i < len(main) - 2 and r.random() < 0.12:
            body += _other(r, r.choice(["ad", "aside", "notice", "form"]) if names == "telling" else r.choice(["nav", "form"]), names)
    if names == "telling" and r.random() < 0.2:
        body += _other(r, "comments", names)
    before = [_other(r, p, names) for p in r.choices(["header", "nav", "notice", "ad", "aside", "form"], k=r.randint(1, 4))]
    after = [_other(r, p, names) for p in r.choices(["comments", "aside", "footer", "ad", "form"], [3 if names == "telling" else 0.3, 3, 3, 3, 2], k=r.randint(1, 4))]
    if names == "odd" and around == "div":
        name = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 7)))
    if around:
        body = f'<{around} class="{name}">{body}</{around}>' if name else f"<{around}>{body}</{around}>"
    if r.random() < 0.08:  # nothing but the text, marked up or not
        before = after = []
        if r.random() < 0.5:
            main, body = [_sentence(r, 2, 60)], ""
            body = r.choice(["{}", "<p>{}</p>", "<div><p>{}</p></div>"]).format(mark + main[0])
    elif names == "telling" and r.random() < 0.06:  # no article at all
        main, body, after = [], "", r.sample(after, r.randint(0, len(after)))
        before = r.sample(before, r.randint(0 if after else 1, len(before)))
    if names == "none" and r.random() < 0.3:  # a table for layout
        side = [before.pop()] if before else []
        page = "".join(before) + f"<table><tr><td>{''.join(side)}</td><td>{body}</td></tr></table>" + "".join(after)
    elif names != "telling" and r.random() < 0.3:
        page = f"<div>{''.join(before)}</div>{body}<div>{''.join(after)}</div>"
    else:
        page = "".join(before) + body + "".join(after)
    if r.random() < 0.1:
        return page, main
    head = f"<head><title>{"".join(main[:1])}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
    return f"<!DOCTYPE html><html>{head}<body>{page}</body></html>", main


def examples(pages: list[tuple[str, list[str]]]) -> tuple[list[list[str]], list[float]]:
    """Features and label of each block of pages with marks (which are no letters, so they change no feature)."""
    rows, labels = [], []
    for page, _ in pages:
        found, containers = read_blocks(page, {})
        rows += features(found, containers)
        labels += [float(b.text.startswith(MARK)) for b in found]
    return rows, labels


def regression(rows: list[list[str]], labels: list[float]) -> dict:
    """A logistic regression over the names that at least LEAST blocks have."""
    counts = Counter(n for names in rows for n in names)
    known = {n: i for i, n in enumerate(sorted(n for n, c in counts.items() if c >= LEAST))}
    x = np.zeros((len(rows), len(known) + 1))
    x[:, -1] = 1
    for i, names in enumerate(rows):
        x[i, [known[n] for n in names if n in known]] = 1
    y, w = np.array(labels), np.zeros(len(known) + 1)
    ridge = RIDGE * np.eye(len(w))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return {"weights": {n: round(float(w[i]), 3) for n, i in known.items()}, "start": round(float(w[-1]), 3)}


def learn(pages: list[tuple[str, list[str]]]) -> dict:
    half = len(pages) * 2 // 3
    model = regression(*examples(pages[:half]))
    held = []
    for page, main in pages[half:]:
        found, containers = read_blocks(page.replace(MARK, ""), model["weights"])
        held.append((found, log_odds(found, containers, model), "\n".join(main)))
    best = -1
    for scale in SCALES:
        for most in MOSTS:
            scored = [(found, word_scores(odds, {"scale": scale, "most": most}), main) for found, odds, main in held]
            for tag in TAG_SCORES:
                right = sum("\n".join(f[i].text for i in range(*region(f, s, tag)) if s[i] > 0) == m for f, s, m in scored)
                if right > best:
                    best, chosen = right, {"scale": scale, "most": most, "tag": tag}
    print("chosen", chosen, "pages right", round(best / len(held), 4))
    return model | chosen


def main() -> None:
    r = random.Random(5)
    model = learn([labelled_page(r, MARK) for _ in range(PAGES)])
    held = [labelled_page(r) for _ in range(500)]
    print("held out", sum(main_text(page, model) == "\n".join(text) for page, text in held) / len(held), len(model["weights"]))
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "models", "main_text.json")
    with open(path, "w") as f:
        json.dump(model, f, indent=0, sort_keys=True)


if __name__ == "__main__":
    main()
