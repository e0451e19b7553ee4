"""Pages as tables of numbered elements, and selectors over them as interval comparisons.

elements() gives a page's elements in one row: each with its number in order of opening (pre) and of closing (post),
its parent, the sibling before it, and where its text lies in the page's text. An element is inside another if it opens
later and closes earlier, so selectors need no tree: hits() keeps only elements that match some part of some selector,
then one window per step over a page's elements finds those that have such an element around or beside them.

Markup is read as browsers do where it matters for selecting: void elements, tags that close others (p, li, options,
cells), unmatched end tags (ignored), raw text. Bold and other formatting left open in a paragraph ends with it.

Defined results: a null or empty page has no elements; broken markup gives the elements read so far; repeated page ids
are one page to selectors, so ids must be unique where that matters; attributes and tags compare in lower case, values
as they are; text is without scripts and styles, white space as one space.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.text import clean_text, lookup

# fixed values: elements of HTML
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SILENT = {"script", "style"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th")} | {b: ("p",) for b in BLOCKS}
SCOPES = set("ul ol dl table select td th div article section main aside nav header footer form body".split())
OWN_SCOPE = {"td": {"table"}, "th": {"table"}, "tr": {"table"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}

_FIELDS = [("pre", pa.int32()), ("post", pa.int32()), ("level", pa.int32()), ("parent", pa.int32()), ("before", pa.int32()), ("tag", pa.string()), ("id", pa.string()), ("classes", pa.list_(pa.string())), ("attrs", pa.map_(pa.string(), pa.string())), ("start", pa.int32()), ("end", pa.int32())]
NODES = "array<struct<pre:int,post:int,level:int,parent:int,before:int,tag:string,id:string,classes:array<string>,attrs:map<string,string>,start:int,end:int>>"


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.text, self.size, self.closed = [], [], 0, 0
        self.stack, self.open, self.last = [], {}, {}

    def handle_starttag(self, tag, attrs):
        for other in CLOSES.get(tag, ()):
            at = self.open.get(other)
            if at and at[-1] > max((self.open[s][-1] for s in OWN_SCOPE.get(other, SCOPES) if self.open.get(s)), default=-1):
                self._close(at[-1])
        given = {k.lower(): v or "" for k, v in reversed(attrs)}
        parent = self.stack[-1] if self.stack else -1
        row = [len(self.rows), 0, len(self.stack), parent, self.last.get(parent, -1), tag, given.get("id"), given.get("class", "").split(), given, self.size, self.size]
        self.last[parent] = row[0]
        self.rows.append(row)
        if tag in VOID:
            self._end(row)
        else:
            self.open.setdefault(tag, []).append(len(self.stack))
            self.stack.append(row[0])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.open.get(tag):
            self._close(self.open[tag][-1])

    def handle_data(self, data):
        if not (self.stack and self.rows[self.stack[-1]][5] in SILENT):
            self.text.append(data)
            self.size += len(data)

    def _close(self, depth):
        while len(self.stack) > depth:
            row = self.rows[self.stack.pop()]
            self.open[row[5]].pop()
            self._end(row)

    def _end(self, row):
        row[1], row[10] = self.closed, self.size
        self.closed += 1

    def page(self, html):
        try:
            self.feed(html)
            self.close()
        except (AssertionError, ValueError):  # markup that the parser gives up on
            pass
        self._close(0)
        return "".join(self.text), self.rows


#: code points of pages that are read into elements at a time; elements take some ten bytes for each until they are Arrow arrays
PORTION = 1 << 20


def _portions(html: pa.Array):
    """(start, count) of runs of pages of at most PORTION code points together, or of one longer page."""
    start, size = 0, 0
    for i, n in enumerate(pc.utf8_length(html).to_pylist()):
        if i > start and size + (n or 0) > PORTION:
            yield start, i - start
            start, size = i, 0
        size += n or 0
    yield start, len(html) - start


def _read(batches):
    for whole in batches:
        for start, count in _portions(whole.column(whole.num_columns - 1)):
            batch = whole.slice(start, count)
            texts, rows, ends = [], [], [0]
            for html in batch.column(batch.num_columns - 1):
                text, own = _Reader().page(html.as_py() or "")
                texts.append(text)
                rows += own
                ends.append(len(rows))
            columns = list(zip(*rows, strict=True)) or [[] for _ in _FIELDS]
            columns[8] = [list(a.items()) for a in columns[8]]
            made = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], [n for n, _ in _FIELDS])
            nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), nodes], [*batch.schema.names[:-1], "_text", "_nodes"])


def elements(pages: DataFrame, html: str = "html", *keep: str) -> DataFrame:
    """The kept columns of pages, with _text and _nodes: the page's text and its elements in order."""
    df = pages.select(*keep, F.col(html).alias("_html"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1])
    return df.mapInArrow(_read, f"{kept}{', ' if kept else ''}_text string, _nodes {NODES}")


# ---- selectors

_PART = re.compile(r"""([a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$~]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+)))?\s*\]""")
_STEP = re.compile(r"\s*([>+~])\s*|\s+")


def _compound(text: str) -> list[tuple]:
    """[(kind, name, operator, value)] of what one element must be."""
    out, at = [], 0
    while at < len(text):
        m = _PART.match(text, at)
        if not m:
            raise ValueError(f"selector not understood: {text[at:]}")
        tag, name, ident, attr, op, *values = m.groups()
        if tag and at:
            raise ValueError(f"a tag comes first: {text}")
        out.append(("tag", tag.lower()) if tag else ("class", name) if name else ("id", ident) if ident else ("attr", attr.lower(), op, next((v for v in values if v is not None), "")))
        at = m.end()
    return out


def steps(selector: str) -> list[tuple[str, str]]:
    """[(combinator, compound)] of a selector without commas; the first combinator is empty."""
    guarded = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(" ", "\0").replace(">", "\1").replace("+", "\2").replace("~", "\3"), selector.strip())
    parts, how = [], ""
    at = 0
    for m in _STEP.finditer(guarded):
        parts.append((how, guarded[at : m.start()]))
        how, at = m[1] or " ", m.end()
    parts.append((how, guarded[at:]))
    back = str.maketrans("\0\1\2\3", " >+~")
    return [(h, p.translate(back)) for h, p in parts]


def alternatives(selector: str) -> list[str]:
    return [a.strip() for a in re.split(r",(?![^\[]*\])", selector) if a.strip()]


def _is(node: Column, compound: str) -> Column:
    out = F.lit(True)
    for kind, name, *rest in _compound(compound):
        if kind == "tag":
            out = out & (F.lit(True) if name == "*" else node["tag"] == name)
        elif kind == "class":
            out = out & F.array_contains(node["classes"], name)
        elif kind == "id":
            out = out & F.coalesce(node["id"] == name, F.lit(False))
        else:
            (op, value), have = rest, F.try_element_at(node["attrs"], F.lit(name))
            how = {None: have.isNotNull(), "=": have == value, "*=": F.contains(have, F.lit(value)), "^=": F.startswith(have, F.lit(value)), "$=": F.endswith(have, F.lit(value)), "~=": F.array_contains(F.split(have, r"\s+"), value)}[op]
            out = out & F.coalesce(how, F.lit(False)) & (F.lit(value != "") if op not in (None, "=") else F.lit(True))
    return out


def _beside(df: DataFrame, page: str, mark: str, key: str, out: str) -> DataFrame:
    """df with out: whether the page's element of number `key` is marked. Each element comes once as itself, once as who asks."""
    twice = df.withColumn("_r", F.explode(F.array(F.struct(F.col("pre").alias("at"), F.lit(False).alias("asks")), F.struct(F.col(key).alias("at"), F.lit(True).alias("asks")))))
    found = F.max(~F.col("_r.asks") & F.col(mark)).over(Window.partitionBy(page, "_r.at"))
    return twice.withColumn(out, F.coalesce(found, F.lit(False))).where("_r.asks").drop("_r")


def hits(tree: DataFrame, page: str, selectors: Sequence[str]) -> DataFrame:
    """(page, selector, pre, post, tag, attrs, text) of every element that matches a selector, from elements()."""
    chains = [(s, steps(a)) for s in dict.fromkeys(selectors) for a in alternatives(s)]
    parts = list(dict.fromkeys(c for _, chain in chains for _, c in chain))
    # which parts an element matches is one array, made before the elements become rows: plans stay small, rows few
    flagged = F.transform("_nodes", lambda n: F.struct(n.alias("n"), F.array(*(_is(n, p) for p in parts)).cast("array<boolean>").alias("f")))
    df = tree.select(page, "_text", F.explode(F.filter(flagged, lambda x: F.exists(x["f"], lambda f: f))).alias("_x"))
    last = [parts.index(c) for _, chain in chains for c in (chain[-1][1],)]
    own = F.exists(F.array(*(F.lit(i) for i in dict.fromkeys(last))).cast("array<int>"), lambda i: F.get(F.col("_x.f"), i))
    text = F.when(own, clean_text(F.substr("_text", F.col("_x.n.start") + 1, F.col("_x.n.end") - F.col("_x.n.start"))))
    df = df.select(page, "_x.n.pre", "_x.n.post", "_x.n.parent", "_x.n.before", "_x.n.tag", "_x.n.attrs", text.alias("_words"), F.col("_x.f").alias("_f"))
    is_part = lambda p: F.col("_f")[parts.index(p)]
    ends, found = Window.partitionBy(page).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1), []
    done: dict[tuple, str] = {}
    for selector, chain in chains:
        mark = ""
        for i, (how, part) in enumerate(chain):
            key = tuple(chain[: i + 1])
            if key not in done:
                name = f"_m{len(done)}"
                if not i:
                    df = df.withColumn(name, is_part(part))
                elif how == " ":
                    around = F.max(F.when(F.col(mark), F.col("post"))).over(ends) > F.col("post")
                    df = df.withColumn(name, F.coalesce(around, F.lit(False)) & is_part(part))
                elif how == "~":
                    earlier = F.max(F.col(mark)).over(Window.partitionBy(page, "parent").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1))
                    df = df.withColumn(name, F.coalesce(earlier, F.lit(False)) & is_part(part))
                else:
                    df = _beside(df, page, mark, "parent" if how == ">" else "before", name).withColumn(name, F.col(name) & is_part(part))
                done[key] = name
            mark = done[key]
        found.append(F.when(F.col(mark), F.lit(selector)))
    named = F.array_distinct(F.filter(F.array(*found), lambda s: s.isNotNull())) if found else F.array().cast("array<string>")
    return df.select(page, F.explode(named).alias("selector"), "pre", "post", "tag", "attrs", F.col("_words").alias("text"))


def first_of(found: DataFrame, page: str, lists: Mapping[str, Sequence[str]], kind: Column, default: str) -> DataFrame:
    """Of hits, those of each page's first selector of its kind's list that has any, with its place in the list."""
    places = {f"{k}\0{s}": i for k, v in lists.items() for i, s in reversed(list(enumerate(v, 1)))}
    of = F.when(kind.isin(*lists), kind).otherwise(default)
    placed = found.withColumn("place", lookup(F.concat(of, F.lit("\0"), "selector"), places)).where("place > 0")
    return placed.withColumn("_best", F.min("place").over(Window.partitionBy(page))).where("place = _best").drop("_best")


def first_hits(pages: DataFrame, page: str, html: str, lists: Sequence[str] | Mapping[str, Sequence[str]], kind: str | None = None, default: str = "generic") -> DataFrame:
    """What hits() gives for each page's first selector of its list that matches anything, with its place in the list.

    lists: one list for all pages, or a list for each value of the column `kind` (other values take the default's).
    """
    per = {k: list(v) for k, v in lists.items()} if isinstance(lists, Mapping) else {default: list(lists)}
    typed = pages.select(F.struct(F.col(page).alias("id"), (F.lit(default) if kind is None else F.col(kind)).alias("kind")).alias("_page"), F.col(html).alias("_html"))
    found = hits(elements(typed, "_html", "_page"), "_page", [s for v in per.values() for s in v])
    out = first_of(found, "_page", per, F.col("_page.kind"), default)
    return out.select(F.col("_page.id").alias(page), *([F.col("_page.kind").alias(kind)] if kind else []), *out.columns[1:])
