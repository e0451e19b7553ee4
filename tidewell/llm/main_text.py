"""Operator 3: the main text of web pages, as the contiguous region of greatest score.

A page becomes a sequence of words and tags. A word's score is the log odds that it belongs to the main text, given what
its block is like: names of the elements around it (tags, words of class, id and role), the kind of block, its length,
its share of link text, its neighbours, how much running text its container holds, and where it stands with respect to
an article element and the first heading. A tag's score is negative. One linear scan finds the region of greatest sum;
blocks of negative words within the region, such as adverts, are left out and the others give the text. All weights
are learned from labelled pages by main_text_train.py (models/main_text.json); features that the model doesn't know
count nothing, so pages without telling names are judged by the rest.

Defined results: a null or empty page, and one without a region of positive score, has an empty text; rows with
null or repeated keys are kept; unclosed, misnested and cut-off markup is read as far as it goes, and html, head and
body tags may be left out; a line break tag is white space; text of formulas, drawings and embedded objects is text;
other columns stay, but those named like an output column are replaced.
"""

from __future__ import annotations

import html
import json
import os
import re
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import read, ship, widened

# a comment, declaration or tag; an unclosed one runs to the end
MARKUP = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
# fixed values of HTML: elements whose content is no text, elements that end a block, elements without an end
RAW = frozenset("script style title textarea iframe noscript xmp noembed noframes".split())
SILENT = frozenset("template select option optgroup datalist button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
# elements that a new block of their kind closes, and those whose end closes them
FREE = frozenset("p li dt dd tr td th option b i u em strong a span font small big".split())
# blocks that hold a line of text rather than further blocks
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre figcaption legend hr address summary caption".split())
CONTROLS = frozenset("input label select textarea output meter progress".split())
SPACE = re.compile(r"\s+")
SIZES, SHARES, PARTS = (1, 3, 6, 11, 21, 51, 101, 301), (0.01, 0.25, 0.5, 0.95), (0.1, 0.3, 0.6, 0.95)


class Block:
    """Words between two block borders, and what they stand in."""

    __slots__ = ("container", "control", "keys", "links", "main", "size", "tag", "tags", "text")

    def __init__(self, text: str, links: int, element: Element, tags: int, control: bool):
        self.text, self.size, self.links, self.tags, self.control = text, text.count(" ") + 1, links, tags, control
        self.main, self.tag, self.keys, self.container = element.main, element.line, element.keys, element.container


class Element:
    """An open element, with what it takes over from those around it."""

    __slots__ = ("container", "keys", "line", "link", "main", "name", "silent")

    def __init__(self, name: str, keys: frozenset, around: Element | None, containers: list):
        self.name = name
        self.silent = name in SILENT or around is not None and around.silent
        self.link = name == "a" or around is not None and around.link and name not in BLOCKS
        self.main = name in ("article", "main") or around is not None and around.main
        self.keys = keys if around is None else keys | around.keys if keys else around.keys
        self.line = name if name in BLOCKS else around.line if around is not None else ""
        if around is None or name in BLOCKS and name not in LINES:
            containers.append(around.container if around is not None else -1)
            self.container = len(containers) - 1
        else:
            self.container = around.container


@lru_cache(maxsize=20_000)
def keys_of(name: str, attributes: str) -> frozenset:
    """What an element may be known by: its tag, and words of its class, id and role."""
    found = {f"<{name}>"} if name in BLOCKS else set()
    if "=" in attributes:
        for m in NAMED.finditer(attributes):
            found.update(f".{w}" for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower()))
    return frozenset(found)


def read_blocks(page: str, weights: dict[str, float]) -> tuple[list[Block], list[int]]:
    """The blocks of a page that have words, and the container around each container."""
    found: list[Block] = []
    containers: list[int] = []
    stack = [Element("", frozenset(), None, containers)]
    opened: dict[str, int] = {}
    parts: list[str] = []
    linked: list[str] = []
    tags = at = 0
    control = False
    n = len(page)

    def flush():
        nonlocal parts, linked, tags, control
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                links = len(html.unescape("".join(linked)).split()) if linked else 0
                found.append(Block(text, links, stack[-1], tags, control))
                tags = 0
            parts, linked = [], []
        control = False

    def add(text: str):
        if not stack[-1].silent:
            parts.append(text)
            if stack[-1].link:
                linked.append(text + " ")

    while at < n:
        m = MARKUP.search(page, at)
        end = m.start() if m else n
        if end > at:
            add(page[at:end])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCKS:
            flush()
            tags += 1
        elif name == "br":
            add(" ")
        elif name in CONTROLS:
            control = True
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if opened.get(name) else ():
                if stack[i].name == name:
                    for e in stack[i:]:
                        opened[e.name] -= 1
                    del stack[i:]
                    break
                if stack[i].name not in FREE and stack[i].name not in SILENT and name in FREE:
                    break
        elif name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else n
        elif name not in VOID and not m[3].endswith("/"):
            if name in BLOCKS:
                while stack[-1].name in SILENT and stack[-1].name != "template":
                    opened[stack.pop().name] -= 1
                if name in FREE:
                    while stack[-1].name in FREE and (stack[-1].name not in BLOCKS or stack[-1].name == name):
                        opened[stack.pop().name] -= 1
            keys = keys_of(name, m[3])
            if weights:  # names that no weight knows say nothing, however many a page has
                keys = frozenset(k for k in keys if f"a:{k}" in weights)
            if keys and name not in BLOCKS and any(weights.get(f"a:{k}", 0.0) < -1 for k in keys):
                flush()  # a named part within a line
            opened[name] = opened.get(name, 0) + 1
            stack.append(Element(name, keys, stack[-1], containers))
    flush()
    return found, containers


def features(found: list[Block], containers: list[int]) -> list[list[str]]:
    """The names of what each block is like."""
    whole, direct, linked = ([0] * len(containers) for _ in range(3))
    for b in found:
        direct[b.container] += b.size - min(b.links, b.size)
        whole[b.container] += b.size
        linked[b.container] += b.links
    for c in range(len(containers) - 1, 0, -1):  # a container comes after the one around it
        if containers[c] >= 0:
            whole[containers[c]] += whole[c]
            linked[containers[c]] += linked[c]
    most, total = max(direct, default=0) or 1, max(sum(direct), 1)
    first = next((i for i, b in enumerate(found) if b.tag == "h1"), -1)
    main = any(b.main for b in found)
    kind = lambda b: "link" if b.links * 2 >= b.size else "short" if b.size < 8 else "long"
    kinds = ["none", *map(kind, found), "none"]
    out = []
    for i, b in enumerate(found):
        c = b.container
        p = containers[c] if containers[c] >= 0 else c
        # a page with an article element is judged by other sizes than one without
        x = "in" if b.main else "out" if main else "no"
        size, share = bisect_right(SIZES, b.size), bisect_right(SHARES, b.links / b.size)
        last = b.text[-1]
        out.append(
            [
                f"t:{b.tag}",
                f"n{x}:{size}",
                f"l:{share}",
                f"nl{x}:{size}/{share}",
                "e:stop" if last in ".!?\"”»:;" else "e:open",
                f"w{x}:{bisect_right(SIZES, whole[c])}",
                f"k:{bisect_right(SHARES, linked[c] / max(whole[c], 1))}",
                f"w2{x}:{bisect_right(SIZES, whole[p])}",
                f"k2:{bisect_right(SHARES, linked[p] / max(whole[p], 1))}",
                f"d{x}:{bisect_right(PARTS, direct[c] / most)}",
                f"r{x}:{bisect_right(PARTS, whole[p] / total)}",
                f"h{x}:none" if first < 0 else f"h{x}:at" if i == first else f"h{x}:before" if i < first else f"h{x}:after",
                f"m:{x}",
                f"q:{kinds[i]}/{kinds[i + 1]}",
                f"z:{kinds[i + 1]}/{kinds[i + 2]}",
                *(("s:mark",) if "©" in b.text else ()),
                *(("s:control",) if b.control else ()),
                *(f"a:{k}" for k in b.keys),
            ]
        )
    return out


def log_odds(found: list[Block], containers: list[int], model: dict) -> list[float]:
    weights, start = model["weights"], model["start"]
    return [start + sum(weights.get(f, 0.0) for f in names) for names in features(found, containers)]


def word_scores(odds: list[float], model: dict) -> list[float]:
    """Scores of a word in each block: log odds up to `most`; negative ones, scaled, so that an advert doesn't part a text."""
    return [min(x, model["most"]) if x > 0 else x * model["scale"] for x in odds]


def region(found: list[Block], scores: list[float], tag: float) -> tuple[int, int]:
    """The blocks, from and to, of the greatest sum of scores of words and tags; (0, 0) if none is positive."""
    best, run, start, at = 0.0, 0.0, 0, (0, 0)
    for i, (score, b) in enumerate(zip(scores, found, strict=True)):
        run += tag * b.tags
        if run <= 0:
            run, start = 0.0, i
        run += score * b.size
        if run > best:
            best, at = run, (start, i + 1)
    return at


def main_text(page: str | None, model: dict) -> str:
    found, containers = read_blocks(page or "", model["weights"])
    scores = word_scores(log_odds(found, containers, model), model)
    at = region(found, scores, model["tag"])
    kept = in_flow(found, containers, scores, at, model["weights"])
    return "\n".join(found[i].text for i in range(*at) if kept[i - at[0]])


def in_flow(found: list[Block], containers: list[int], scores: list[float], at: tuple[int, int], weights: dict[str, float]) -> list[bool]:
    """Which blocks of a region are text: those of positive score, and links in the flow of an article.

    Links are in its flow if they stand in an article or main element, between two texts of one container, as paragraphs
    of that container or items of a list right in it, of four words or more each, and nothing around them has a name
    that speaks against them. Such blocks take their neighbours' score; menus and lists of further reading have names,
    places or containers of their own, tags are shorter.
    """
    kept, i = [scores[k] > 0 for k in range(*at)], 0
    while i < len(kept):
        if kept[i]:
            i += 1
            continue
        end = i
        while end < len(kept) and not kept[end]:
            end += 1
        own = found[at[0] + i : at[0] + end]
        if 0 < i and end < len(kept):
            before, after = found[at[0] + i - 1], found[at[0] + end]
            near = lambda b: b.container == before.container or containers[b.container] == before.container  # noqa: E731, B023
            fits = before.container == after.container and before.main and after.main
            if fits and all(b.main and b.tag in ("p", "li") and b.size >= 4 and b.links * 2 >= b.size and not b.control and "|" not in b.text and near(b) and all(weights.get(f"a:{k}", 0.0) > -1 for k in b.keys - before.keys if k.startswith(".")) for b in own):
                kept[i:end] = [True] * (end - i)
        i = end
    return kept


def load_model() -> dict:
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "models", "main_text.json")) as f:
        return json.load(f)


def extract_main_text(pages: DataFrame, model: dict | None = None, column: str = "html") -> DataFrame:
    """pages with text: the main text of each row's whole page."""
    ship(pages.sparkSession)
    model = model or load_model()
    pages = pages.drop("text") if column != "text" else pages
    at = pages.columns.index(column)

    def extract(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(p, model) for p in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])

    return pages.mapInArrow(extract, widened(pages, text="string"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
