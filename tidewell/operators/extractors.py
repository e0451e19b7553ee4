"""An ordered registry of extractors for pages, open to the user's own.

An extractor has an id, a rule (a column expression over the page's columns) and a function from a page to rows. Each page
goes to the extractor that its hint names, else to the first whose rule holds, else to the fallback; routing is one
expression. The functions run in one Python table function over the routed pages, whose result's columns follow from the
registry's fields by analyze(). A page whose function fails gives a row with the error as its warning instead of a failed
task; so does a row that does not fit the fields.

A function gets the page as a dict and returns an iterable of dicts, or a dict with `rows`, `warnings` and `outcome`.

Defined results: a page without rows gives one row without fields if it has a warning or an outcome, else none; null
hints and hints that name no extractor are ignored; rules that are null don't hold; the same id twice is an error; fields
that a row lacks are null, others are left out; pages of one id are pages of their own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeResult


@dataclass(frozen=True)
class Extractor:
    id: str
    rule: Column | None  # None: only by hint or as the fallback
    parse: Callable[[dict], object]
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.id}Parser"


def unwrapped(result: object) -> tuple[list[dict], list[str], str | None]:
    """(rows, warnings, outcome) of what an extractor returned."""
    if result is None:
        return [], [], None
    if isinstance(result, dict):
        rows = result.get("rows")
        if isinstance(rows, dict):  # rows within rows, as a function may pass on another's result
            return unwrapped(rows)[0], [*rows.get("warnings", []), *result.get("warnings", [])], result.get("outcome") or rows.get("outcome")
        return list(rows or []), [str(w) for w in result.get("warnings") or []], result.get("outcome")
    return list(result), [], None


def _fitted(row: dict, fields: T.StructType) -> tuple:
    """A row's values in the order of the fields; a value of another kind is an error that names its field."""
    if not isinstance(row, dict):
        raise TypeError(f"a row is a dict of fields, not {type(row).__name__}")
    out = []
    for f in fields:
        value = row.get(f.name)
        try:
            T._make_type_verifier(f.dataType, nullable=True, name=f.name)(value)
        except Exception as e:
            raise TypeError(str(e)[:200]) from e
        out.append(value)
    return tuple(out)


class Registry:
    """Extractors in order, a fallback, and the fields of their rows as a schema string."""

    def __init__(self, extractors: Sequence[Extractor], fallback: Extractor, fields: str):
        ids = [e.id for e in (*extractors, fallback)]
        if len(set(ids)) < len(ids):
            raise ValueError("two extractors have one id")
        self.extractors, self.fallback, self.fields = tuple(extractors), fallback, fields

    def adding(self, extractor: Extractor, before: str | None = None) -> Registry:
        """A registry with one more extractor, last or before another."""
        ids = [e.id for e in self.extractors]
        at = len(ids) if before is None else ids.index(before)
        return Registry([*self.extractors[:at], extractor, *self.extractors[at:]], self.fallback, self.fields)

    def route(self, hint: Column | None = None) -> Column:
        """struct(extractor, reason): by the hint, the first rule that holds, or the fallback."""
        known = [e.id for e in (*self.extractors, self.fallback)]
        out = F.struct(F.lit(self.fallback.id).alias("extractor"), F.lit("fallback:no-source-match").alias("reason"))
        for e in reversed(self.extractors):
            if e.rule is not None:
                out = F.when(F.coalesce(e.rule, F.lit(False)), F.struct(F.lit(e.id).alias("extractor"), F.lit(f"auto-match:{e.id}").alias("reason"))).otherwise(out)
        if hint is None:
            return out
        named = F.coalesce(hint.isin(*known), F.lit(False))
        return F.when(named, F.struct(hint.alias("extractor"), F.concat(F.lit("userData.sourceType="), hint).alias("reason"))).otherwise(out)

    def _table_function(self, columns: Sequence[str]):
        parse = {e.id: (e.label, e.parse) for e in (*self.extractors, self.fallback)}
        names = list(columns)

        class Extract:
            @staticmethod
            def analyze(page, extractor, fields) -> AnalyzeResult:  # noqa: ARG004
                own = T.StructType.fromJson(json.loads(fields.value))
                return AnalyzeResult(T.StructType([T.StructField("parser", T.StringType()), T.StructField("outcome", T.StringType()), T.StructField("warnings", T.ArrayType(T.StringType())), T.StructField("nth", T.IntegerType()), *own.fields]))

            def __init__(self):
                self.own = None

            def eval(self, page, extractor, fields) -> Iterable[tuple]:
                if self.own is None:
                    self.own = T.StructType.fromJson(json.loads(fields))
                label, run = parse[extractor]
                blank = (None,) * len(self.own)
                try:
                    rows, warnings, outcome = unwrapped(run({n: page[n] for n in names}))
                except Exception as e:  # noqa: BLE001  one page's error is its warning
                    yield (label, "failed", [f"{type(e).__name__}: {e}"[:500]], None, *blank)
                    return
                made = 0
                for row in rows:
                    try:
                        yield (label, outcome, warnings, made, *_fitted(row, self.own))
                    except TypeError as e:
                        yield (label, outcome, [*warnings, str(e)], made, *blank)
                    made += 1
                if not made and (warnings or outcome):
                    yield (label, outcome, warnings, None, *blank)

        return F.udtf(Extract)

    def extract(self, pages: DataFrame, keep: Sequence[str], given: Sequence[str], hint: str | None = None) -> DataFrame:
        """The kept columns of pages with extractor, reason, parser, outcome, warnings, nth (number of the row) and the fields.

        given: the columns that the functions see.
        """
        run, own = self._table_function(given), T._parse_datatype_string(self.fields)
        routed = pages.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.struct(*given).alias("_page"), self.route(F.col(hint) if hint else None).alias("_r"))
        out = routed.lateralJoin(run(F.col("_page").outer(), F.col("_r.extractor").outer(), F.lit(own.json())))
        return out.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "_r.extractor", "_r.reason", "parser", "outcome", "warnings", "nth", *own.names)
