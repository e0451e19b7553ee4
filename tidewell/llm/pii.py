"""Operator 2: personal data, by rules that stand and boosted trees that add to them. DataFrame and SQL only.

Base spans follow fixed rules per kind. Generators of high recall then propose further spans, which may overlap each
other and the base: obscured addresses, IPv6 in full or with "::", grouped or long card numbers, phone numbers without a plus. Boosted
trees score each proposal by its format and its context; a logistic step per kind calibrates the sum to a
probability; a proposal over its kind's threshold is selected unless it overlaps a base span or a better proposal.
The trees were trained by pii_train.py on generated texts and are read from models/pii_trees.json.

Everything happens in one projection, row by row: no shuffle, no Python. Positions are found from the lengths of
matches and of the gaps between them, summed in blocks, and proposals of texts with many spans are compared within
blocks of spans by place; so long texts with many matches or proposals take no quadratic time.

Defined results: a null text has no spans and stays null when redacted; rows with null or repeated keys are kept;
positions are code points, ends exclusive; other columns stay, but one named like the output column is replaced (out
gives the spans another name).
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import fresh, read

KINDS = ("email", "ip", "card", "phone")

# The base rules' patterns, written so that no text makes them retry: a match may only start at the start of a run of
# its characters or where the last match ended, and repetitions keep what they took. They match as
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on do.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++\x20?(?:(?<=\x20)@|@(?=\x20)|\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[a-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\x20?)[a-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[\x20._/-]{1,3}[0-9]{4}){2,3}(?:[\x20._/-]{1,3}[0-9]{1,4})?|[0-9]{13,19})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\(0?[0-9]{2,4}\)|0{1,2}[0-9]{1,4}|[0-9]{3})[\x20./-]?[0-9]{2,4}(?:[\x20./-][0-9]{2,4}){1,3}(?![0-9])",
}
# context words, looked for in the characters before a proposal (a space before the text's start and after a match;
# where whole words are meant, the character before them is asked for, as the window may cut a word)
HINTS = {
    "email": r"(?i)mail|contact|write|reach|address|kontakt|correo|courriel",
    "ip": r"(?i)(?<=[^a-z])ip\b|ipv6|host|server|addr|ping",
    "card": r"(?i)card|visa|amex|master|credit|debit|karte|carte|tarjeta|payment|(?<=[^a-z])cc\b",
    "phone": r"(?i)phone|tel|call|mobile|cell|fax|dial|whatsapp|appel|anruf|llam",
}
AGAINST = r"(?i)(?<=[^a-z])(?:isbn|order|invoice|serial|version|part|ref|issue|ticket|doi|page|build|id|sku|token|price)\b|#\s*$|[$€£]\s*$"

_SPAN = "array<struct<m:string,s:bigint,e:bigint,before:string,after:string>>"
_BLOCK = 256
_SHIFT = 1 << 32  # a position holds code points above and bytes below this


def _let(name: str, value: str, body: str) -> str:
    """SQL that computes a value once for a body that uses it often."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _total(items: str) -> str:
    return f"aggregate({items}, 0L, (a, v) -> a + v)"


def _found(text: str, pattern: str) -> str:
    """SQL for the matches of a pattern: text, start and end (packed), and the characters around."""
    step = f"(length(g[i]) + length(m)) * {_SHIFT}L + octet_length(g[i]) + octet_length(m)"
    end = f"o[cast(i / {_BLOCK} as int)] + {_total(f'slice(l, i - i % {_BLOCK} + 1, i % {_BLOCK} + 1)')}"
    size = f"(length(m) * {_SHIFT}L + octet_length(m))"
    spans = f"transform(x, (m, i) -> {_let('z', end, f'''named_struct('m', m, 's', z - {size}, 'e', z, 'before', substring(concat(' ', g[i]), -24), 'after', substring(g[i + 1], 1, 2))''')})"
    offsets = _let("b", f"transform(sequence(0, cast((size(x) - 1) / {_BLOCK} as int)), k -> {_total(f'slice(l, k * {_BLOCK} + 1, {_BLOCK})')})", f"transform(b, (v, k) -> {_total('slice(b, 1, k)')})")
    inner = _let("g", f"split({text}, r'{pattern}', -1)", _let("l", f"transform(x, (m, i) -> {step})", _let("o", offsets, spans)))
    return _let("x", f"regexp_extract_all({text}, r'{pattern}', 0)", f"CASE WHEN size(x) = 0 THEN cast(array() as {_SPAN}) ELSE {inner} END")


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """SQL: the check sum of up to 19 digits holds."""
    value = "cast(substring(d, -k, 1) as int) * (2 - k % 2)"
    return _let("d", digits, f"aggregate(sequence(1, length(d)), 0, (a, k) -> a + {_let('w', value, 'w - 9 * cast(w > 9 as int)')}) % 10 = 0")


_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_VALID = {
    "email": "true",
    "ip": f"c.m rlike r'^{_PART}(?:\\.{_PART}){{3}}$'",
    "card": _let("n", _digits("c.m"), f"CASE WHEN length(n) BETWEEN 16 AND 19 THEN {_luhn('n')} ELSE false END"),
    "phone": f"length({_digits('c.m')}) BETWEEN 8 AND 15",
}

FEATURES = {
    "kind": "{kind}",
    "length": "length(c.m)",
    "digits": "length(n)",
    "luhn": "cast(CASE WHEN length(n) BETWEEN 13 AND 19 THEN {luhn} ELSE false END as int)",
    "separators": "length(regexp_replace(c.m, '[0-9A-Za-z]', ''))",
    "letters": "length(regexp_replace(c.m, '[^A-Za-z]', ''))",
    "hint": "cast(c.before rlike r'{hint}' as int)",
    "against": "cast(c.before rlike r'" + AGAINST + "' as int)",
    "joined_before": "cast(c.before rlike r'[0-9A-Za-z_.,:/-]$' as int)",
    "joined_after": "cast(c.after rlike r'^(?:[0-9A-Za-z_]|[.,:/-][0-9A-Za-z])' as int)",
    "tld": "cast(c.m rlike r'(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$' as int)",
    "marked": r"cast(c.m rlike r'(?i)@|[(\[{]at[)\]}]| dot |[(\[{]dot[)\]}]' as int)",
    "parens": "cast(c.m rlike r'^[(]' as int)",
    "first": "coalesce(try_cast(substring(n, 1, 1) as int), -1)",
    "colons": "length(regexp_replace(c.m, '[^:]', ''))",
    "doubled": "cast(contains(c.m, '::') as int)",
    "groups": "size(filter(split(c.m, ':'), p -> length(p) >= 3))",
}


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with, per kind, __base_<kind> (valid matches) and __more_<kind> (proposals with their features as f)."""
    df = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        df = df.withColumn(f"__base_{kind}", F.expr(f"filter({_found('__t', BASE[kind])}, c -> {_VALID[kind]})"))
        values = ", ".join(f"'{name}', cast({x.format(kind=KINDS.index(kind), hint=HINTS[kind], luhn=_luhn('n')) if name in ('kind', 'hint', 'luhn') else x} as double)" for name, x in FEATURES.items())
        scored = _let("n", _digits("c.m"), f"named_struct('m', c.m, 's', c.s, 'e', c.e, 'f', named_struct({values}))")
        proposed = f"transform({_found('__t', PROPOSED[kind])}, c -> {scored})"
        if kind == "card":  # those that are base matches themselves are not proposed again
            proposed = f"filter({proposed}, c -> NOT (c.f.luhn = 1 AND c.f.digits >= 16 AND c.m rlike '^[0-9](?:[ -]?[0-9])+$'))"
        df = df.withColumn(f"__more_{kind}", F.expr(proposed))
    return df


def load_model(path: str | None = None) -> dict:
    path = path or os.path.join(os.path.dirname(os.path.abspath(__file__)), "models", "pii_trees.json")
    with open(path) as f:
        return json.load(f)


def _tree(node) -> str:
    if not isinstance(node, list):
        return repr(float(node))
    name, limit, low, high = node
    return f"CASE WHEN c.f.{name} <= {float(limit)!r} THEN {_tree(low)} ELSE {_tree(high)} END"


def _probability(model: dict, kind: str) -> str:
    a, b = model["calibration"][kind]
    margin = " + ".join([repr(float(model["start"])), *(f"({_tree(t)})" for t in model["trees"])])
    return f"1 / (1 + exp(-({a!r} * ({margin}) + {b!r})))"


def find_personal_data(docs: DataFrame, model: dict | None = None, text: str = "text", out: str = "spans") -> DataFrame:
    """docs with spans: array<struct<kind, start, end, score, base, from_byte, to_byte>>, by kind, then start."""
    model = model or load_model()
    docs = docs.drop(out)
    # the columns travel in one struct, so that none clashes with the steps' own
    df = candidates(docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text")), "__text")

    def shaped(name: str, number: int, score: str, base: str) -> str:
        return f"transform({name}, c -> named_struct('kind', {number}, 'start', shiftright(c.s, 32), 'end', shiftright(c.e, 32), 'score', cast({score} as double), 'base', {base}, 'from_byte', c.s & {_SHIFT - 1}L, 'to_byte', c.e & {_SHIFT - 1}L))"

    df = df.withColumn("__base", F.expr("concat(" + ", ".join(shaped(f"__base_{k}", i, "1.0", "true") for i, k in enumerate(KINDS)) + ")"))
    picked = [f"filter({shaped(f'__more_{k}', i, _probability(model, k), 'false')}, c -> c.score >= {model['thresholds'][k]!r})" for i, k in enumerate(KINDS)]
    df = df.withColumn("__more", F.expr(f"CASE WHEN {' + '.join(f'size(__more_{k})' for k in KINDS)} = 0 THEN slice(__base, 1, 0) ELSE concat({', '.join(picked)}) END"))
    overlap = "c.from_byte < o.to_byte AND o.from_byte < c.to_byte"
    better = "(o.score > c.score OR o.score = c.score AND (o.start < c.start OR o.start = c.start AND o.kind < c.kind))"
    beaten = f"{overlap} AND (o.base OR {better})"
    few = f"filter(__more, c -> NOT exists(__base, o -> {overlap}) AND NOT exists(__more, o -> {overlap} AND {better}))"
    # of many spans, sorted by start, only blocks that reach the proposal are looked into
    slice_of = f"slice(a, cast({{}} * {_BLOCK} as int) + 1, {_BLOCK})"
    blocks = f"transform(sequence(0, cast((size(a) - 1) / {_BLOCK} as int)), k -> named_struct('k', k, 'lo', element_at(a, k * {_BLOCK} + 1).from_byte, 'hi', array_max(transform({slice_of.format('k')}, o -> o.to_byte))))"
    reached = f"filter(__more, c -> NOT exists(h, b -> b.lo < c.to_byte AND c.from_byte < b.hi AND exists({slice_of.format('b.k')}, o -> {beaten})))"
    by_start = "array_sort(concat(__base, __more), (p, q) -> CASE WHEN p.from_byte < q.from_byte THEN -1 WHEN p.from_byte > q.from_byte THEN 1 ELSE 0 END)"
    many = _let("a", by_start, _let("h", blocks, reached))
    chosen = f"CASE WHEN size(__more) = 0 THEN __more WHEN size(__base) + size(__more) <= {2 * _BLOCK} THEN {few} ELSE {many} END"
    names = ", ".join(f"'{k}'" for k in KINDS)
    ordered = _let("u", f"concat(__base, {chosen})", "array_sort(u, (p, q) -> CASE WHEN p.kind < q.kind THEN -1 WHEN p.kind > q.kind THEN 1 WHEN p.start < q.start THEN -1 WHEN p.start > q.start THEN 1 ELSE 0 END)")
    named = f"transform({ordered}, c -> named_struct('kind', element_at(array({names}), c.kind + 1), 'start', c.start, 'end', c.end, 'score', c.score, 'base', c.base, 'from_byte', c.from_byte, 'to_byte', c.to_byte))"
    return df.select("__row.*", F.expr(named).alias(out))


def redacted(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """found, with [KIND] in place of each span of the text; overlapping spans become one, named by the first."""
    before = f"greatest(0L, coalesce(array_max(slice(h, 1, cast(i / {_BLOCK} as int))), 0L), coalesce(array_max(slice(r, i - i % {_BLOCK} + 1, i % {_BLOCK})), 0L))"
    piece = _let("p", before, "CASE WHEN i > 0 AND c.from_byte < p THEN '' ELSE concat(cast(substring(t, int(p + 1), int(c.from_byte - p)) as string), '[', upper(c.kind), ']') END")
    body = _let("r", "transform(q, c -> c.to_byte)", _let("h", f"transform(sequence(0, cast((size(r) - 1) / {_BLOCK} as int)), k -> array_max(slice(r, k * {_BLOCK} + 1, {_BLOCK})))", f"concat(array_join(transform(q, (c, i) -> {piece}), ''), cast(substring(t, int(array_max(r) + 1)) as string))"))
    ordered = f"array_sort(`{spans}`, (p, q) -> CASE WHEN p.from_byte < q.from_byte THEN -1 WHEN p.from_byte > q.from_byte THEN 1 ELSE 0 END)"
    whole = _let("t", f"cast(`{text}` as binary)", _let("q", ordered, body))
    return found.withColumn(text, F.expr(f"CASE WHEN size(`{spans}`) = 0 OR `{text}` IS NULL THEN `{text}` ELSE {whole} END"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read(spark, sf_dir, "documents", "doc_id", "text"))
    joined = "array_join(transform({}, c -> concat(c.kind, ':', c.start, ':', c.end)), ',')"
    base = "filter(spans, c -> c.base)"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, c -> c.base AND c.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS),
        F.expr(f"sha2({joined.format(base)}, 256)").alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span is replaced by its kind in brackets; n_chars follows the text."""
    (spans,) = fresh(docs, "spans")
    out = redacted(find_personal_data(docs, out=spans), spans=spans)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
