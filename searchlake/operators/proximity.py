"""Span trees (F29–F33): nested proximity operators, spans over several fields, span scores.

A tree of ``Word``, ``OneOf``, ``Near``, ``Masked`` (spans) under ``All``, ``Some``, ``Without`` (documents) is compiled into one plan:
the places of all words of a field come from one scan of its postings with all terms in the filter, written once to the shared scratch
folder; equal subtrees are built once, and written once if they are used more than once. Spans
are rows ``doc_id, start, end``; clauses meet on equal (document, position) keys (see ``textmatch.span_near``).

``w(n, a, b)`` and ``n(n, a, b)`` are the usual distance operators: at most n - 1 other words between neighbours, in order or in any order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators import textmatch as tm
from searchlake.operators.filters import wildcard_to_like
from searchlake.operators.index import Index
from searchlake.operators.util import written


@dataclass(frozen=True)
class Word:
    """A word of a field; ``*`` and ``?`` stand for any characters and for one."""
    text: str
    field: str = "text"


@dataclass(frozen=True)
class OneOf:
    parts: tuple


@dataclass(frozen=True)
class Near:
    parts: tuple
    slop: int
    in_order: bool = True


@dataclass(frozen=True)
class Masked:
    """Spans of one field taken for spans of ``field`` (F31), so that both meet by position in one document."""
    part: object
    field: str


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Some:
    parts: tuple


@dataclass(frozen=True)
class Without:
    part: object
    but: object


def w(distance: int, *parts) -> Near:
    return Near(tuple(map(_node, parts)), distance - 1, True)


def n(distance: int, *parts) -> Near:
    return Near(tuple(map(_node, parts)), distance - 1, False)


def one_of(*parts) -> OneOf:
    return OneOf(tuple(map(_node, parts)))


def _node(x):
    return Word(x) if isinstance(x, str) else x


def _children(node) -> tuple:
    if isinstance(node, Word):
        return ()
    if isinstance(node, Masked):
        return (node.part,)
    return (node.part, node.but) if isinstance(node, Without) else node.parts


def _walk(node) -> Iterator:
    yield node
    for child in _children(node):
        yield from _walk(child)


def field_of(node) -> str:
    """The field of a span tree; clauses of different fields cannot meet unless one is masked."""
    if isinstance(node, Word):
        return node.field
    if isinstance(node, Masked):
        field_of(node.part)
        return node.field
    if isinstance(node, (All, Some, Without)):
        raise ValueError(f"{type(node).__name__} combines documents and cannot stand inside a distance operator")
    fields = {field_of(p) for p in node.parts}
    if len(fields) != 1:
        raise ValueError(f"clauses of several fields in one operator: {sorted(fields)}")
    return fields.pop()


def _is(word: Word) -> Column:
    term = F.col("term")
    return term.like(wildcard_to_like(word.text)) if "*" in word.text or "?" in word.text else term == word.text


class SpanPlan:
    """Compiles trees against the indexes of their fields."""

    def __init__(self, tree, indexes: dict[str, Index]):
        self.tree = tree
        self.built: dict[object, DataFrame] = {}
        self.uses = Counter(_walk(tree))
        words = {x for x in self.uses if isinstance(x, Word)}
        self.places = {f: self._places(indexes[f], [x for x in words if x.field == f]) for f in sorted({x.field for x in words})}

    @staticmethod
    def _places(index: Index, words: list[Word]) -> DataFrame:
        wanted = None
        for x in sorted(words, key=lambda x: x.text):
            wanted = _is(x) if wanted is None else wanted | _is(x)
        rows = index.postings.filter(wanted).select("doc_id", "term", F.explode("positions").alias("start"))
        return written(rows, "spans")

    def spans(self, node=None) -> DataFrame:
        """``doc_id, start, end`` of a span tree."""
        node = self.tree if node is None else node
        if node not in self.built:
            field_of(node)
            out = self._spans(node)
            inner = not isinstance(node, (Word, Masked))
            self.built[node] = written(out, "span") if inner and self.uses[node] > 1 else out
        return self.built[node]

    def _spans(self, node) -> DataFrame:
        if isinstance(node, Word):
            rows = self.places[node.field].filter(_is(node))
            return rows.select("doc_id", "start", (F.col("start") + 1).alias("end")).distinct()
        if isinstance(node, Masked):
            return self.spans(node.part)
        parts = [self.spans(p) for p in node.parts]
        return tm.span_or(parts) if isinstance(node, OneOf) else tm.span_near(parts, node.slop, node.in_order)

    def documents(self, node=None) -> DataFrame:
        """``doc_id`` of the documents that a tree matches."""
        node = self.tree if node is None else node
        if isinstance(node, All):
            out = self.documents(node.parts[0])
            for p in node.parts[1:]:
                out = out.join(self.documents(p), "doc_id", "left_semi")
            return out
        if isinstance(node, Some):
            out = self.documents(node.parts[0])
            for p in node.parts[1:]:
                out = out.unionByName(self.documents(p))
            return out.distinct()
        if isinstance(node, Without):
            return self.documents(node.part).join(self.documents(node.but), "doc_id", "left_anti")
        return self.spans(node).select("doc_id").distinct()


def near_spans(tree, indexes: dict[str, Index]) -> DataFrame:
    """Spans of a distance tree (F32)."""
    return SpanPlan(tree, indexes).spans()


def near_documents(tree, indexes: dict[str, Index]) -> DataFrame:
    """Documents of a tree with All, Some and Without above distance operators (F32)."""
    return SpanPlan(tree, indexes).documents()


# ------------------------------------------------------------------ span scores

def span_frequencies(spans: DataFrame) -> DataFrame:
    """``doc_id, freq``: every match adds 1 / (its length + 1)."""
    return tm.span_hits(spans).withColumnRenamed("score", "freq")


def span_scores(spans: DataFrame, index: Index, terms: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Scored span query: BM25 with the span frequency as tf and the summed idf of the query's distinct terms."""
    size, df = F.col("n_docs").cast("double"), F.col("df").cast("double")
    stats = index.stats_for(sorted(set(terms))).crossJoin(F.broadcast(index.field_stats))
    idf = stats.agg(F.sum(F.ln(F.lit(1.0) + (size - df + 0.5) / (df + 0.5))).alias("idf"), F.first("avgdl").alias("avgdl"))
    lengths = index.terms(sorted(set(terms))).select("doc_id", "dl").distinct()
    j = span_frequencies(spans).join(lengths, "doc_id").crossJoin(F.broadcast(idf))
    norm = F.lit(k1) * (1 - b + b * F.col("dl") / F.col("avgdl"))
    return j.select("doc_id", (F.col("idf") * F.col("freq") * (k1 + 1) / (F.col("freq") + norm)).alias("score"))


def span_payload_check(spans: DataFrame, tokens: DataFrame, payloads: list, ordered: bool = True) -> DataFrame:
    """Spans whose tokens carry exactly the given payloads (F33), in order of position or in any order. ``tokens``: doc_id, pos, payload."""
    from searchlake.operators.synonyms import payloads_of

    wanted = F.array(*[F.lit(p) for p in payloads])
    found = payloads_of(spans, tokens)
    same = F.col("payloads") == wanted if ordered else F.sort_array("payloads") == F.sort_array(wanted)
    return found.filter(same).select("doc_id", "start", "end")
