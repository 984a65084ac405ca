"""Token streams with positions and character offsets (T01, T20, A25): one row per token.

A stream has the columns ``doc_id, pos, term, start, end`` (offsets count code points, end exclusive) and may carry more. Steps
pass start and end on, so ``substring(text, start + 1, end - start)`` is the surface form of a token whatever
happened to its term. Values of a multi-valued column follow each other with a position gap and an offset gap.

Plan: the texts are dealt by ``doc_id`` once, into parts of bounded text; a text is cut into tokens and what stands between them, and
the offsets are running sums of these lengths in one window per document, which reuses that partitioning, as do later
steps that look at a document's neighbouring tokens. Rows never meet across documents.

Defined results: null and empty texts have no tokens; a removed token leaves its position free; documents need a unique id (rows that
share one are taken for values of the same document, in no fixed order).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from searchlake.operators.analysis import DEFAULT_PATTERN, Step
from searchlake.operators.util import dealt

#: Distance between values of a multi-valued field, in positions and characters (a common schema default, and one character).
POSITION_GAP = 100
OFFSET_GAP = 1


def _cut(value: Column, pattern: str) -> Column:
    """Pieces (gap, token) of a text in order; the last one has what follows the last token, and no token."""
    found = F.regexp_extract_all(value, F.lit(pattern), F.lit(0))
    # a text without a token is one gap; matches are never empty
    gaps = F.split(value, pattern, -1)
    return F.arrays_zip(gaps.alias("gap"), found.alias("token"))


def token_stream(docs: DataFrame, id_col: str, text_col: str, pattern: str = DEFAULT_PATTERN, lower: bool = True,
                 position_gap: int = POSITION_GAP, offset_gap: int = OFFSET_GAP, rules: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, pos, term, start, end, value`` of a text or array-of-texts column.

    Positions and offsets run on through the values of a document (``value`` is the number of the value): the next value
    starts ``position_gap`` positions and ``offset_gap`` characters later. ``rules``: a mapping char filter (T20) in front of
    the tokenizer; offsets are then those in the text before it.
    """
    many = isinstance(docs.schema[text_col].dataType, ArrayType)
    values = F.col(text_col) if many else F.array(text_col)
    rows = dealt(docs.select(F.col(id_col).alias("doc_id"), values.alias("values")), "doc_id", "values")
    rows = rows.select("doc_id", F.posexplode("values").alias("value", "text"))
    if rules:
        rows = rows.withColumn("source", F.col("text")).withColumn("text", _mapped(F.col("text"), rules))
    text = F.coalesce("text", F.lit(""))
    pieces = rows.select("doc_id", "value", F.posexplode(_cut(text, pattern)).alias("i", "p"))
    token = F.col("p.token")
    order = Window.partitionBy("doc_id").orderBy("value", "i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    width = F.length("p.gap") + F.when(token.isNull(), offset_gap).otherwise(F.length(token))
    placed = pieces.select(
        "doc_id", "value", token.alias("term"),
        (F.coalesce(F.count(token).over(before), F.lit(0)) + F.col("value") * position_gap).cast("int").alias("pos"),
        (F.coalesce(F.sum(width).over(before), F.lit(0)) + F.length("p.gap")).cast("int").alias("start"))
    out = placed.filter(F.col("term").isNotNull()).select(
        "doc_id", "pos", (F.lower("term") if lower else F.col("term")).alias("term"), "start",
        (F.col("start") + F.length("term")).alias("end"), "value")
    return _corrected(out, rows, rules, offset_gap) if rules else out


# ------------------------------------------------------------------ char filters with an offset map

def _pieces(text: Column, rules: dict[str, str]) -> Column:
    """The text in pieces: matches of the longest rule at each place, and the rest."""
    keys = sorted(rules, key=len, reverse=True)
    first = "".join(sorted({re.escape(k[0]) for k in keys}))
    return F.regexp_extract_all(text, F.lit(f"(?s){'|'.join(map(re.escape, keys))}|[^{first}]+|."), F.lit(0))


def _image(piece: Column, rules: dict[str, str]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]), piece), piece)


def _mapped(text: Column, rules: dict[str, str]) -> Column:
    return F.array_join(F.transform(_pieces(text, rules), lambda p: _image(p, rules)), "")


def _corrected(tokens: DataFrame, rows: DataFrame, rules: dict[str, str], offset_gap: int) -> DataFrame:
    """Offsets in the mapped text -> offsets in the source text.

    A place inside a replacement is the same place of what it replaced, at most its last character; a place outside moves by the
    difference of the lengths before it. The pieces in front of each token's start and end are found by one window over
    pieces and tokens together, not by a range join.
    """
    cut = rows.select("doc_id", "value", F.posexplode(_pieces(F.coalesce("source", F.lit("")), rules)).alias("i", "p"))
    # one more piece per value, the gap to the next one
    ends = rows.select("doc_id", "value", F.lit(2**31 - 1).alias("i"), F.lit(None).cast("string").alias("p"))
    lengths = cut.unionByName(ends).select(
        "doc_id", "value", "i", F.coalesce(F.length("p"), F.lit(offset_gap)).alias("n_in"),
        F.coalesce(F.length(_image(F.col("p"), rules)), F.lit(offset_gap)).alias("n_out"))
    before = Window.partitionBy("doc_id").orderBy("value", "i").rowsBetween(Window.unboundedPreceding, -1)
    start_of = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("int")
    placed = lengths.select("doc_id", start_of("n_in").alias("at_in"), start_of("n_out").alias("at"), "n_in", "n_out")
    held = placed.filter("n_out > 0").select("doc_id", "at", F.lit(0).alias("kind"), F.struct("at_in", "at", "n_in").alias("piece"),
                                             F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("term"),
                                             F.lit(None).cast("int").alias("value"))
    none = F.lit(None).cast("struct<at_in:int,at:int,n_in:int>").alias("piece")
    asks = tokens.select("doc_id", "pos", "term", "value", F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("kind")), F.struct(F.col("end").alias("at"), F.lit(2).alias("kind")))).alias("a"))
    asks = asks.select("doc_id", "a.at", "a.kind", none, "pos", "term", "value")
    seen = Window.partitionBy("doc_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = held.unionByName(asks).withColumn("piece", F.last("piece", True).over(seen)).filter("kind > 0")
    place = F.col("piece.at_in") + F.least(F.col("at") - F.col("piece.at"), F.col("piece.n_in") - 1)
    return met.groupBy("doc_id", "pos", "term", "value").agg(
        F.max(F.when(F.col("kind") == 1, place)).alias("start"), F.max(F.when(F.col("kind") == 2, place)).alias("end")).select(
        "doc_id", "pos", "term", "start", "end", "value")


# ------------------------------------------------------------------ steps on streams

def map_terms(stream: DataFrame, step: Step) -> DataFrame:
    """A token filter of one term to one term; a term that becomes null goes and leaves its position free."""
    return stream.withColumn("term", F.get(step(F.array("term")), F.lit(0))).filter(F.col("term").isNotNull())


def split_terms(stream: DataFrame, parts: Callable[[Column], Column]) -> DataFrame:
    """A step of one token to several: ``parts(term)`` is an array of structs ``term, from, to, inc``.

    ``from`` and ``to`` are offsets inside the token (null: the whole token), ``inc`` the step to the part's position (the first
    part stays at the token's). Later tokens of the document move on by the positions added.
    """
    rows = stream.select(*stream.columns, F.posexplode(parts(F.col("term"))).alias("_i", "_p"))
    order = Window.partitionBy("doc_id").orderBy("pos", "start", "_i")
    added = F.sum(F.when(F.col("_i") == 0, 0).otherwise(F.col("_p.inc"))).over(order)
    whole = F.col("_p.from").isNull()
    return rows.select(*[{
        "pos": (F.col("pos") + added).cast("int"), "term": F.col("_p.term"),
        "start": F.when(whole, F.col("start")).otherwise(F.col("start") + F.col("_p.from")).cast("int"),
        "end": F.when(whole, F.col("end")).otherwise(F.col("start") + F.col("_p.to")).cast("int"),
    }.get(c, F.col(c)).alias(c) for c in stream.columns])


def regex_parts(pattern: str) -> Callable[[Column], Column]:
    """Parts of a token for ``split_terms``: the matches of ``pattern``, each at a position of its own."""
    def parts(term: Column) -> Column:
        width = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["token"]), F.lit(0))

        def placed(pieces: Column) -> Column:
            before = lambda i: F.aggregate(F.slice(pieces, 1, i), F.lit(0), lambda s, p: s + width(p))
            return F.transform(pieces, lambda p, i: F.struct(
                p["token"].alias("term"), (before(i) + F.length(p["gap"])).alias("from"),
                (before(i) + width(p)).alias("to"), F.lit(1).alias("inc")))
        # the array of one element holds the pieces: inside the functions they are a variable, not cut again for each part
        found = F.get(F.transform(F.array(_cut(term, pattern)), placed), F.lit(0))
        return F.filter(found, lambda p: p["term"].isNotNull())
    return parts


def gram_parts(min_gram: int, max_gram: int, edge: bool = False) -> Callable[[Column], Column]:
    """Character n-grams of a token for ``split_terms``, all at the token's position; ``edge``: only those at its front."""
    def parts(term: Column) -> Column:
        n = F.length(term)
        sizes = [F.struct(F.lit(g).alias("g")) for g in range(min_gram, max_gram + 1)]

        def at(s: Column) -> Column:
            last = F.lit(0) if edge else n - s["g"]
            starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
            grams = F.transform(starts, lambda i: F.struct(
                F.substring(term, i + 1, s["g"]).alias("term"), i.alias("from"), (i + s["g"]).alias("to"), F.lit(0).alias("inc")))
            return F.filter(grams, lambda _: s["g"] <= n)
        return F.flatten(F.transform(F.array(*sizes), at))
    return parts


def shingle_stream(stream: DataFrame, size: int, sep: str = " ") -> DataFrame:
    """Shingles of ``size`` neighbouring tokens (T31) with the offsets from the first one's start to the last one's end.
    A position that a filter left free breaks a shingle."""
    order = Window.partitionBy("doc_id").orderBy("pos", "start", "end")
    ahead = lambda c, k: F.lead(c, k).over(order)
    words = F.concat_ws(sep, "term", *[ahead("term", k) for k in range(1, size)])
    rows = stream.select("*", words.alias("_w"), ahead("pos", size - 1).alias("_p"), ahead("end", size - 1).alias("_e"))
    rows = rows.filter(F.col("_p") == F.col("pos") + size - 1)
    return rows.select(*[{"term": F.col("_w"), "end": F.col("_e")}.get(c, F.col(c)).alias(c) for c in stream.columns])


def run_chain(stream: DataFrame, steps: Sequence[Step | tuple[str, object]]) -> DataFrame:
    """Steps in order (T01): a token filter, ``("parts", fn)`` for ``split_terms`` or ``("shingles", size)``."""
    for step in steps:
        if callable(step):
            stream = map_terms(stream, step)
        elif step[0] == "parts":
            stream = split_terms(stream, step[1])
        elif step[0] == "shingles":
            stream = shingle_stream(stream, step[1])
        else:
            raise ValueError(f"unknown step {step[0]!r}")
    return stream


#: Characters in one piece of a text.
PIECE = 64


def surface(stream: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The stream and ``surface``, the text from start to end; the texts join on the document's id, cut into pieces of ``PIECE`` characters:
    a token looks at its own pieces only, not at the text from the front on, which takes the square of a text's length."""
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    text = docs.select(F.col(id_col).alias("doc_id"), pieces.alias("_text"))
    first, last = (F.floor(c / PIECE).cast("int") for c in (F.col("start"), F.col("end") - 1))
    near = F.array_join(F.slice("_text", first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return stream.join(text, "doc_id").withColumn("surface", F.substring(near, F.col("start") % PIECE + 1, F.col("end") - F.col("start"))).drop("_text")


# ------------------------------------------------------------------ term vectors

def term_vectors(stream: DataFrame) -> DataFrame:
    """``doc_id, term, tf, positions, starts, ends, df, tf_idf`` (A25): a document's terms with places, and tf / df."""
    place = F.sort_array(F.collect_list(F.struct("pos", "start", "end")))
    of = lambda c: F.transform("_at", lambda p: p[c])
    vectors = stream.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), place.alias("_at"))
    # three arrays of numbers travel in less space than one of structs
    vectors = vectors.select("doc_id", "term", "tf", of("pos").alias("positions"), of("start").alias("starts"), of("end").alias("ends"))
    df = stream.select("doc_id", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return vectors.join(df, "term").select(
        "doc_id", "term", "tf", "positions", "starts", "ends", "df",
        (F.col("tf") / F.col("df")).alias("tf_idf"))
