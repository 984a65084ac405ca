"""Highlighting from stored places (C03, C04, C06): phrases as intervals, fragments around them, text between boundaries.

The offset table of the hits' documents (``streams.token_stream``) gives every query term's places; phrases are found by
equi-joins on positions. Per document the places become an array, and one linear pass (``_spread``, a small helper in a
pandas UDF, because each choice depends on the one before) drops places that overlap an earlier one and groups the others into
fragments. Scores, ranks, boundaries and tags are column expressions again. The texts are joined to the best
fragments only.

Only documents of the hit list are cut into tokens; a document's places are bounded by its length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.components import html_encode
from searchlake.operators.filters import wildcard_to_like
from searchlake.operators.streams import token_stream
from searchlake.operators.util import fold, written

MARGIN = 6
BOUNDARY_CHARS = ".,!? \t\n"
MAX_SCAN = 10
#: A fragment candidate of the regex fragmenter (a common default) and the factor by which fragments may differ from the size.
FRAGMENT_PATTERN = "[-\\w ,\\n\"']{20,200}"
SLOP = 0.6


@dataclass(frozen=True)
class Clause:
    """A word, or the words of a phrase in order; ``*`` and ``?`` in a word stand for any characters and for one.
    ``slop``: positions that may lie between neighbouring words."""
    words: tuple[str, ...]
    boost: float = 1.0
    slop: int = 0
    field: str | None = None


def clause(text: str, boost: float = 1.0, slop: int = 0, field: str | None = None) -> Clause:
    return Clause(tuple(text.split()), boost, slop, field)


def _is(word: str, term: Column) -> Column:
    return term.like(wildcard_to_like(word)) if "*" in word or "?" in word else term == word


def _any_word(clauses: Sequence[Clause]) -> Column:
    return fold(lambda a, b: a | b, [_is(w, F.col("term")) for c in clauses for w in c.words])


def find_places(stream: DataFrame, clauses: Sequence[Clause]) -> DataFrame:
    """``doc_id, seq, boost, start, end, words`` of every occurrence of every clause; ``words`` has its tokens' pos, term, start, end.

    A phrase goes on from each first word to the nearest next word within ``slop`` positions: the place is enumerated, so
    the joins are on (document, position).
    """
    tokens = stream.filter(_any_word(clauses)).select("doc_id", "pos", F.struct("pos", "term", "start", "end").alias("word"))
    out = None
    for seq, c in enumerate(clauses):
        of = lambda w: tokens.filter(_is(w, F.col("word.term")))
        found = of(c.words[0]).select("doc_id", "pos", F.array("word").alias("words"))
        for w in c.words[1:]:
            ahead = F.explode(F.sequence(F.col("pos") + 1, F.col("pos") + 1 + c.slop))
            found = (found.select("doc_id", ahead.alias("pos"), "words").join(of(w), ["doc_id", "pos"])
                     .groupBy("doc_id", "words").agg(F.min("word").alias("word"))
                     .select("doc_id", F.col("word.pos").alias("pos"), F.concat("words", F.array("word")).alias("words")))
        one = found.select("doc_id", F.lit(seq).alias("seq"), F.lit(float(c.boost)).alias("boost"),
                           F.element_at("words", 1)["start"].alias("start"), F.element_at("words", -1)["end"].alias("end"), "words")
        out = one if out is None else out.unionByName(one)
    return out


def _ranges(words: Column) -> Column:
    """Marked ranges of a place: words at neighbouring positions are one range."""
    starts = F.filter(words, lambda w, i: (i == 0) | (w["pos"] - F.get(words, i - 1)["pos"] != 1))
    ends = F.filter(words, lambda w, i: (i == F.size(words) - 1) | (F.get(words, i + 1)["pos"] - w["pos"] != 1))
    return F.transform(F.arrays_zip(starts.alias("a"), ends.alias("z")), lambda r: F.struct(
        r["a"]["start"].alias("start"), r["z"]["end"].alias("end")))


def _spread(starts, ends, parts, size: int, margin: int) -> list[dict]:
    """Places in order of start, longer ones first -> fragments (from, to, picks).

    A place that overlaps an accepted one goes. A fragment begins at a place and takes those that end within ``size``
    characters, a place in several parts only if the fragment is not longer than ``size`` with it; then it is centred, but
    begins no earlier than the one before ends. A place that begins before that end goes, too.
    """
    picks, reach = [], -1
    for k in range(len(starts)):
        if starts[k] >= reach:
            picks.append(k)
            reach = ends[k]
    out, at, free = [], 0, 0
    while at < len(picks):
        first = starts[picks[at]]
        if first < free:
            at += 1
            continue
        limit = max(ends[picks[at]], max(first - margin, free) + size)
        some, stop, opening = [], first, True
        while at < len(picks) and (opening or ends[picks[at]] <= limit):
            k = picks[at]
            opening, stop, at = False, ends[k], at + 1
            if parts[k] <= 1 or stop - first <= size:
                some.append(k)
        if not some:
            continue
        begin = max(first - max(0, (size - (stop - first)) // 2), free)
        free = begin + max(stop - first, size)
        out.append({"from": int(begin), "to": int(free), "picks": [int(k) for k in some]})
    return out


def _fragments(places: DataFrame, builder: str, size: int, margin: int) -> DataFrame:
    """places per document -> ``doc_id, frag, from, to, places`` (the accepted ones of the fragment, in order)."""
    held = F.struct("start", (-F.col("end")).alias("rank"), "seq", "end", "boost", "words")
    # clauses that meet in one and the same place: the first counts
    docs = places.groupBy("doc_id").agg(F.sort_array(F.collect_list(held)).alias("all"))
    docs = docs.select("doc_id", F.transform("all", lambda p: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), p["seq"].alias("seq"), p["boost"].alias("boost"), p["words"].alias("words"),
        _ranges(p["words"]).alias("ranges"))).alias("all"))
    whole = builder == "single"

    @F.pandas_udf("array<struct<from:int,to:int,picks:array<int>>>")
    def spread(starts: pd.Series, ends: pd.Series, parts: pd.Series) -> pd.Series:
        big = 2**31 - 1
        return pd.Series([_spread(*x, big if whole else size, big if whole else margin)
                          for x in zip(starts, ends, parts, strict=True)])

    of = lambda c: F.transform("all", lambda p: p[c])
    parts = F.transform("all", lambda p: F.size(p["ranges"]))
    cut = docs.withColumn("cut", spread(of("start"), of("end"), parts)).select("doc_id", "all", F.posexplode("cut").alias("frag", "f"))
    return cut.select("doc_id", "frag", F.col("f.from").alias("from"), F.col("f.to").alias("to"),
                      F.transform("f.picks", lambda k: F.get("all", k)).alias("places"))


def _edge_before(text: Column, at: Column, scanner: str, chars: str, max_scan: int) -> Column:
    """Where the fragment may begin: behind the last boundary in front of ``at``."""
    if scanner == "simple":
        seen = F.substring(text, F.greatest(at - max_scan, F.lit(0)) + 1, F.least(F.lit(max_scan), at))
        run = F.length(F.regexp_extract(seen, f"[^{_class(chars)}]*\\z", 0))
        return F.when(run < F.length(seen), at - run).when(at <= max_scan, 0).otherwise(at)
    return F.length(F.regexp_extract(F.substring(text, F.lit(1), at), f"(?s)^.*(?:{_BREAKS[scanner]})", 0))


def _edge_behind(text: Column, at: Column, scanner: str, chars: str, max_scan: int) -> Column:
    if scanner == "simple":
        seen = F.substring(text, at + 1, F.lit(max_scan))
        run = F.length(F.regexp_extract(seen, f"^[^{_class(chars)}]*", 0))
        return F.when(run < F.length(seen), at + run).otherwise(F.least(at, F.length(text)))
    rest = F.substring(text, at + 1, F.length(text))
    upto = F.length(F.regexp_extract(rest, f"(?s)^.*?(?:{_BREAKS[scanner]})", 0))
    return F.when(at >= F.length(text), F.length(text)).when(upto > 0, at + upto).otherwise(F.length(text))


#: Breaks of the scanners that follow the text's own structure: the fragment reaches to the break's end.
_BREAKS = {"sentence": r"[.!?]+\s+|\n+", "word": r"\s+", "line": r"\n"}


def _class(chars: str) -> str:
    import re

    return re.escape(chars)


def _marked(text: Column, frm: Column, to: Column, places: Column, pre: Sequence[str], post: Sequence[str], encode: bool) -> Column:
    """The text from ``frm`` to ``to`` with the places' ranges inside tags; the tags go round with the clause number."""
    shown = html_encode if encode else (lambda c: c)
    cut = lambda a, z: shown(F.substring(text, a + 1, F.greatest(z - a, F.lit(0))))
    tag = lambda tags, seq: F.element_at(F.array(*map(F.lit, tags)), (seq % len(tags)) + 1)
    ranges = F.flatten(F.transform(places, lambda p: F.transform(p["ranges"], lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), p["seq"].alias("seq")))))

    def piece(r: Column, i: Column) -> Column:
        behind = F.when(i == 0, frm).otherwise(F.get(ranges, i - 1)["end"])
        return F.concat(cut(behind, r["start"]), tag(pre, r["seq"]), cut(r["start"], r["end"]), tag(post, r["seq"]))
    return F.concat(F.array_join(F.transform(ranges, piece), ""), cut(F.element_at(ranges, -1)["end"], to))


def _joined(text: Column, many: bool) -> Column:
    """The text the offsets count in: values of a multi-valued field are one character apart."""
    return F.array_join(F.transform(text, lambda v: F.coalesce(v, F.lit(""))), " ") if many else F.coalesce(text, F.lit(""))


def highlight_vector(hits: DataFrame, docs: DataFrame, id_col: str, text_col: str, clauses: Sequence[Clause], fragsize: int = 100,
                     snippets: int = 1, builder: str = "simple", order: str = "score", scanner: str = "simple",
                     boundary_chars: str = BOUNDARY_CHARS, max_scan: int = MAX_SCAN, margin: int = MARGIN, pre: Sequence[str] = ("<em>",),
                     post: Sequence[str] = ("</em>",), encode: bool = False, field_match: bool = False, **stream) -> DataFrame:
    """Vector-style highlighting (C04, C06): ``doc_id, frag, score, start, end, snippet`` of the best ``snippets`` fragments per hit.

    ``builder``: ``simple`` (score: the places' boosts), ``weighted`` (distinct words' idf and boost, times the root of the number
    of words) or ``single`` (the whole text is one fragment). ``order``: ``score`` or ``position`` among the best. ``scanner``: fragments
    are widened to the nearest of ``boundary_chars`` within ``max_scan`` characters (``simple``), or to ``sentence``, ``word`` or ``line``
    breaks. With ``field_match`` only the clauses of this field (or of none) are marked. Only whole clauses are
    marked: a phrase's word outside the phrase is not.
    """
    if builder not in ("simple", "weighted", "single"):
        raise ValueError(f"unknown builder {builder!r}")
    if fragsize < 3 * margin:
        raise ValueError(f"fragsize must be at least {3 * margin}")
    clauses = [c for c in clauses if not field_match or c.field in (None, text_col)]
    found = docs.join(hits.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_semi")
    tokens = token_stream(found, id_col, text_col, **stream)
    if not clauses:
        return tokens.select("doc_id", F.lit(0).alias("frag"), F.lit(0.0).alias("score"), "start", "end", F.col("term").alias("snippet")).limit(0)
    frags = _fragments(find_places(tokens, clauses), builder, fragsize, margin)
    frags = _weighted(frags, docs, id_col, text_col, clauses, stream) if builder == "weighted" else frags.withColumn(
        "score", F.aggregate("places", F.lit(0.0), lambda s, p: s + p["boost"]))
    best = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), F.col("from"))
    frags = frags.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= snippets)
    if order == "position":
        frags = frags.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("from")))
    many = docs.schema[text_col].dataType.typeName() == "array"
    texts = found.select(F.col(id_col).alias("doc_id"), _joined(F.col(text_col), many).alias("text"))
    out = frags.join(texts, "doc_id")
    text = F.col("text")
    if builder == "single":
        begin, stop = F.lit(0), F.length(text)
    else:
        begin = _edge_before(text, F.col("from"), scanner, boundary_chars, max_scan)
        stop = _edge_behind(text, F.least("to", F.length(text)), scanner, boundary_chars, max_scan)
    out = out.withColumns({"start": begin.cast("int"), "end": stop.cast("int")})
    return out.select("doc_id", (F.col("rank") - 1).alias("frag"), "score", "start", "end",
                      _marked(text, F.col("start"), F.col("end"), F.col("places"), pre, post, encode).alias("snippet"))


def _weighted(frags: DataFrame, docs: DataFrame, id_col: str, text_col: str, clauses: Sequence[Clause], stream: dict) -> DataFrame:
    """Scores of the weighted builder; document frequencies are over all documents, for the clauses' terms."""
    tokens = token_stream(docs, id_col, text_col, **stream)
    wanted = None
    for c in clauses:
        for w in c.words:
            wanted = _is(w, F.col("term")) if wanted is None else wanted | _is(w, F.col("term"))
    df = tokens.filter(wanted).groupBy("term").agg(F.count_distinct("doc_id").alias("df"))
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    words = frags.select("doc_id", "frag", F.posexplode("places").alias("i", "p"))
    words = words.select("doc_id", "frag", "i", "p.boost", F.explode("p.words").alias("w")).select("doc_id", "frag", "i", "boost", F.col("w.term").alias("term"))
    # a word counts with the boost of the first place that has it
    once = words.groupBy("doc_id", "frag", "term").agg(F.min_by("boost", "i").alias("boost"), F.count(F.lit(1)).alias("n"))
    idf = F.ln(F.col("n_docs") / (F.col("df") + 1)) + 1
    scored = once.join(df, "term").crossJoin(F.broadcast(n_docs)).groupBy("doc_id", "frag").agg(
        (F.sum(idf * F.col("boost")) * F.sqrt(F.sum("n"))).alias("score"))
    return frags.join(scored, ["doc_id", "frag"])


# ------------------------------------------------------------------ gap and regex fragmenters

def _gaps(ends, jumps, size: int, gap: int) -> list[int]:
    """Fragment number of each token: a token that ends ``size`` or more behind the last break, or stands behind a large position
    jump, begins a new fragment, and its end is the break."""
    out, frag, begin = [], 0, 0
    for end, jump in zip(ends, jumps, strict=True):
        if end >= begin + size or jump > gap:
            frag, begin = frag + 1, end
        out.append(frag)
    return out


def _breaks(ends, jumps, spots, size: int, slop: float, gap: int) -> list[int]:
    """Fragment number of each token.

    A fragment ends where a token reaches the target: the first hot spot at or behind the first token that is long enough (if the
    spot is within the slop), else the size; a large position jump always ends it.
    """
    from bisect import bisect_left

    least, most = int((1 - slop) * size), (1 + slop) * size
    out, frag, begin, target = [], 0, 0, -1
    for end, jump in zip(ends, jumps, strict=True):
        new = jump > gap
        if not new and end - begin >= least:
            if target <= 0:
                at = bisect_left(spots, max(end, begin + least))
                target = spots[at] if at < len(spots) and spots[at] <= int(begin + most) else begin + size
            new = end > target
        if new:
            frag, begin, target = frag + 1, end, -1
        out.append(frag)
    return out


def regex_fragments(stream: DataFrame, docs: DataFrame, id_col: str, text_col: str, fragsize: int = 70, slop: float = SLOP,
                    pattern: str = FRAGMENT_PATTERN, increment: int = 50) -> DataFrame:
    """The stream and ``frag``, the number of the token's fragment by the regex fragmenter (C03): fragments of about ``fragsize``
    characters (by the factor ``slop``) that end at the edges of what ``pattern`` matches; all of the text is looked at."""
    spots = token_stream(docs, id_col, text_col, pattern, lower=False)
    spots = spots.select("doc_id", F.explode(F.array("start", "end")).alias("s")).groupBy("doc_id").agg(F.sort_array(F.collect_set("s")).alias("spots"))

    @F.pandas_udf("array<int>")
    def breaks(ends: pd.Series, jumps: pd.Series, spots: pd.Series) -> pd.Series:
        return pd.Series([_breaks(e, j, [] if s is None else list(s), fragsize, slop, increment)
                          for e, j, s in zip(ends, jumps, spots, strict=True)])

    return _numbered(stream, lambda docs, ends, jumps: docs.join(spots, "doc_id", "left").withColumn("frags", breaks(ends, jumps, "spots")))


def gap_fragments(stream: DataFrame, fragsize: int = 100, increment: int = 50) -> DataFrame:
    """The stream and ``frag``, the number of the token's fragment by the gap fragmenter."""
    @F.pandas_udf("array<int>")
    def breaks(ends: pd.Series, jumps: pd.Series) -> pd.Series:
        return pd.Series([_gaps(e, j, fragsize, increment) for e, j in zip(ends, jumps, strict=True)])

    return _numbered(stream, lambda docs, ends, jumps: docs.withColumn("frags", breaks(ends, jumps)))


def _numbered(stream: DataFrame, number) -> DataFrame:
    """The stream with ``frag``; ``number`` adds ``frags`` to the documents, from their tokens' ends and position steps."""
    others = [c for c in stream.columns if c != "doc_id"]
    docs_ = stream.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", *[c for c in others if c != "pos"]))).alias("toks"))

    jumps = F.transform("toks", lambda t, i: t["pos"] - F.when(i == 0, -1).otherwise(F.get("toks", i - 1)["pos"]))
    ends = F.transform("toks", lambda t: t["end"])
    cut = number(docs_, ends, jumps)
    rows = cut.select("doc_id", F.explode(F.arrays_zip("toks", "frags")).alias("t"))
    return rows.select("doc_id", *[F.col(f"t.toks.{c}").alias(c) for c in others], F.col("t.frags").alias("frag"))


def highlight_fragments(hits: DataFrame, docs: DataFrame, id_col: str, text_col: str, clauses: Sequence[Clause], fragsize: int = 100,
                    snippets: int = 1, pre: str = "<em>", post: str = "</em>", encode: bool = False, merge_contiguous: bool = False,
                    alternate_col: str | None = None, alternate_length: int = 0, fragmenter: str = "gap", **options) -> DataFrame:
    """Highlighting with the gap or the regex fragmenter (C02, C03, C06): ``doc_id, frag, score, start, end, snippet``.

    A fragment scores the sum of its distinct words' boosts; the best ``snippets`` are returned. ``merge_contiguous``: chosen fragments
    that follow each other become one, with the larger score. A hit without a fragment shows ``alternate_col`` (its first ``alternate_length``
    characters, if positive) as fragment -1 with score 0 (C02).
    """
    found = docs.join(hits.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_semi")
    tokens = token_stream(found, id_col, text_col)
    if fragmenter not in ("gap", "regex"):
        raise ValueError(f"unknown fragmenter {fragmenter!r}")
    placed = (regex_fragments(tokens, found, id_col, text_col, fragsize, **options) if fragmenter == "regex"
              else gap_fragments(tokens, fragsize, **options))
    # one pass over the tokens: fragments with their bounds and the clauses' words are written, all that follows reads these
    held = F.collect_list(F.when(_any_word(clauses), F.struct("pos", "term", "start", "end")))
    bounds = written(placed.groupBy("doc_id", "frag").agg(F.min("start").alias("from"), F.max("end").alias("to"), held.alias("words")), "fragments")
    asked = bounds.select("doc_id", "frag", F.explode("words").alias("w")).select("doc_id", "frag", "w.*")
    bounds = bounds.drop("words")
    places = find_places(asked, clauses)
    words = places.select("doc_id", "seq", "boost", F.explode("words").alias("w"))
    words = words.groupBy("doc_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.col("w.term").alias("term")).agg(
        F.max("boost").alias("boost"), F.min("seq").alias("seq"))
    words = words.join(asked.select("doc_id", "start", "end", "frag"), ["doc_id", "start", "end"])
    per_word = words.groupBy("doc_id", "frag", "term").agg(
        F.max("boost").alias("boost"), F.collect_list(F.struct("start", "end", "seq")).alias("at"))
    frags = per_word.groupBy("doc_id", "frag").agg(F.sum("boost").alias("score"), F.sort_array(F.flatten(F.collect_list("at"))).alias("at"))
    best = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), F.col("frag"))
    frags = frags.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= snippets).join(bounds, ["doc_id", "frag"])
    if merge_contiguous:
        run = F.col("frag") - F.row_number().over(Window.partitionBy("doc_id").orderBy("frag"))
        frags = frags.withColumn("run", run).groupBy("doc_id", "run").agg(
            F.min("frag").alias("frag"), F.max("score").alias("score"), F.min("from").alias("from"), F.max("to").alias("to"),
            F.sort_array(F.flatten(F.collect_list("at"))).alias("at"))
    many = docs.schema[text_col].dataType.typeName() == "array"
    texts = found.select(F.col(id_col).alias("doc_id"), _joined(F.col(text_col), many).alias("text"))
    as_places = F.transform("at", lambda r: F.struct(r["seq"].alias("seq"), F.array(F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("ranges")))
    shown = frags.join(texts, "doc_id").select("doc_id", "frag", "score", F.col("from").alias("start"), F.col("to").alias("end"), _marked(
        F.col("text"), F.col("from"), F.col("to"), as_places, (pre,), (post,), encode).alias("snippet"))
    if alternate_col is None:
        return shown
    alt = F.coalesce(F.col(alternate_col), F.lit(""))
    alt = F.substring(alt, F.lit(1), F.lit(alternate_length)) if alternate_length > 0 else alt
    alt = html_encode(alt) if encode else alt
    rest = found.select(F.col(id_col).alias("doc_id"), alt.alias("snippet"), F.length(alt).alias("end")).join(
        shown.select("doc_id").distinct(), "doc_id", "left_anti")
    return shown.unionByName(rest.select("doc_id", F.lit(-1).alias("frag"), F.lit(0.0).alias("score"), F.lit(0).alias("start"), "end", "snippet"))
