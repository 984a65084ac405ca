"""Matching on analyzed text (F02, F04–F07 on terms, F14 scored, F16–F34, J-free).

Hit lists are ``doc_id, score`` DataFrames. Boolean combination, dismax and min-should-match
are a tagged ``union`` of the clause hits followed by ONE ``groupBy(doc_id)`` — no joins between
clause results. Positional operators join token positions on the equi-key
``(doc_id, position)``; sloppy windows enumerate the allowed offsets as extra equi-keys instead
of a band join, so the work stays linear in the number of positions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators import scoring
from searchlake.operators.filters import wildcard_to_like
from searchlake.operators.index import Index


# ------------------------------------------------------------------ single terms and multi-term expansion

def match_term(index: Index, term: str, model: str = "bm25", **params) -> DataFrame:
    """Scored term query on a text field."""
    return scoring.score_terms(index, [term], model, **params)


def vocabulary(index: Index) -> DataFrame:
    """Distinct terms with their statistics — the term dictionary."""
    return index.term_stats


def expand_prefix(index: Index, prefix: str) -> DataFrame:
    return index.term_stats.filter(F.col("term").startswith(prefix)).select("term")


def expand_wildcard(index: Index, pattern: str) -> DataFrame:
    return index.term_stats.filter(F.col("term").like(wildcard_to_like(pattern))).select("term")


def expand_regexp(index: Index, pattern: str) -> DataFrame:
    return index.term_stats.filter(F.col("term").rlike(f"^(?:{pattern})$")).select("term")


def expand_fuzzy(index: Index, term: str, max_edits: int = 2, prefix_length: int = 0,
                 max_expansions: int = 50, transpositions: bool = True) -> DataFrame:
    """Vocabulary terms within ``max_edits`` of ``term`` sharing its first ``prefix_length`` chars.

    Blocking: the length filter and the shared prefix are cheap predicates evaluated before the
    (bounded) ``levenshtein(a, b, k)``. Transposition counts one edit (Damerau, adjacent swap).
    The top ``max_expansions`` terms by similarity (then df desc, term asc) are kept; each carries
    the reference's boost ``1 − edits / min(len)``.
    """
    t = F.lit(term)
    cand = index.term_stats
    if prefix_length:
        cand = cand.filter(F.col("term").startswith(term[:prefix_length]))
    cand = cand.filter(F.abs(F.length("term") - len(term)) <= max_edits)
    lev = F.levenshtein(F.col("term"), t, max_edits)
    edits = F.when(lev >= 0, lev)
    if transpositions:
        edits = F.least(F.coalesce(edits, F.lit(99)), _transposition_distance(F.col("term"), term, max_edits))
        edits = F.when(edits <= max_edits, edits)
    cand = cand.withColumn("edits", edits).filter(F.col("edits").isNotNull())
    sim = F.lit(1.0) - F.col("edits") / F.least(F.length("term"), F.lit(len(term)))
    cand = cand.withColumn("fuzzy_boost", sim)
    w = [F.col("fuzzy_boost").desc(), F.col("df").desc(), F.col("term").asc()]
    return cand.orderBy(*w).limit(max_expansions).select("term", "edits", "fuzzy_boost")


def _transposition_distance(col: Column, term: str, max_edits: int) -> Column:
    """Edit distance with at least one adjacent swap: a swap and plain edits, or two swaps."""
    n = len(term)
    if n < 2:
        return F.lit(99)
    swaps = [term[:i] + term[i + 1] + term[i] + term[i + 2:] for i in range(n - 1)]
    ds = [F.levenshtein(col, F.lit(s), max_edits) for s in swaps]
    best = F.least(*[F.when(d >= 0, d + 1).otherwise(F.lit(99)) for d in ds]) if len(ds) > 1 else \
        F.when(ds[0] >= 0, ds[0] + 1).otherwise(F.lit(99))
    twice = sorted({s[:i] + s[i + 1] + s[i] + s[i + 2:] for s in swaps for i in range(n - 1)})
    return F.when(col.isin(twice) & (best > 2), F.lit(2)).otherwise(best)


def multi_term_hits(index: Index, terms: DataFrame, boost: float = 1.0) -> DataFrame:
    """Constant-score hits of a multi-term expansion (D9): docs containing any expanded term. The expansion can be
    as large as the vocabulary, so it is no broadcast hint: the planner picks by its size."""
    p = index.postings.join(terms.select("term"), "term", "left_semi")
    return p.select("doc_id").distinct().withColumn("score", F.lit(float(boost)))


def fuzzy_hits(index: Index, term: str, **kw) -> DataFrame:
    """Fuzzy query hits (F07): BM25 of each expanded term × its similarity boost, summed per doc.
    The expansion is bounded by ``max_expansions``, so its broadcast is safe."""
    exp = expand_fuzzy(index, term, **kw)
    j = index.postings.join(F.broadcast(exp), "term").select("doc_id", "term", "tf", "dl", "fuzzy_boost")
    j = j.join(F.broadcast(index.term_stats.join(exp.select("term"), "term", "left_semi")), "term") \
        .crossJoin(F.broadcast(index.field_stats)).withColumn("boost", F.col("fuzzy_boost"))
    return j.groupBy("doc_id").agg(F.sum(scoring.bm25_expr()).alias("score"))


# ------------------------------------------------------------------ boolean, dismax, mm

def bool_hits(must=(), should=(), must_not=(), min_should_match: int = 0, coord: bool = False) -> DataFrame:
    """Scored boolean query over clause hit lists.

    One tagged union + one aggregate: score = Σ scores of matching MUST and SHOULD clauses; a doc
    qualifies when all MUST match, at least ``min_should_match`` SHOULD match (1 if no MUST),
    and no MUST_NOT matches. ``coord`` multiplies by matched/total clauses (B02/B09)."""
    parts = []
    for i, h in enumerate(must):
        parts.append(h.select("doc_id", "score", F.lit("m").alias("_k"), F.lit(i).alias("_i")))
    for i, h in enumerate(should):
        parts.append(h.select("doc_id", "score", F.lit("s").alias("_k"), F.lit(i).alias("_i")))
    for i, h in enumerate(must_not):
        parts.append(h.select("doc_id", F.lit(0.0).alias("score"), F.lit("n").alias("_k"), F.lit(i).alias("_i")))
    u = reduce(lambda a, b: a.unionByName(b), parts)
    g = u.groupBy("doc_id").agg(
        F.sum(F.when(F.col("_k") != "n", F.col("score"))).alias("score"),
        F.count_distinct(F.when(F.col("_k") == "m", F.col("_i"))).alias("_nm"),
        F.count_distinct(F.when(F.col("_k") == "s", F.col("_i"))).alias("_ns"),
        F.count_if(F.col("_k") == "n").alias("_nn"))
    k = min_should_match if min_should_match else (0 if must else 1)
    out = g.filter((F.col("_nm") == len(must)) & (F.col("_ns") >= k) & (F.col("_nn") == 0))
    if coord:
        total = len(must) + len(should)
        out = out.withColumn("score", F.col("score") * (F.col("_nm") + F.col("_ns")) / F.lit(float(total)))
    return out.select("doc_id", "score")


def dismax_hits(hits: list[DataFrame], tie: float = 0.0) -> DataFrame:
    """Disjunction-max (F25): max clause score + tie × (sum − max)."""
    u = reduce(lambda a, b: a.unionByName(b), [h.select("doc_id", "score") for h in hits])
    g = u.groupBy("doc_id").agg(F.max("score").alias("_mx"), F.sum("score").alias("_sm"))
    return g.select("doc_id", (F.col("_mx") + F.lit(float(tie)) * (F.col("_sm") - F.col("_mx"))).alias("score"))


def maxscore_hits(must=(), should=(), must_not=(), tie: float = 0.0) -> DataFrame:
    """Max-score parser (F26): SHOULD clauses collapse into one dismax clause; MUST/MUST_NOT kept."""
    should_dm = [dismax_hits(list(should), tie)] if should else []
    if must:
        return bool_hits(list(must) + should_dm, [], must_not) if not should else \
            bool_hits(must, should_dm, must_not)
    return bool_hits([], should_dm, must_not)


def dismax_search(indexes: dict[str, Index], query_terms: list[str], qf: dict[str, float] | None = None,
                  tie: float = 0.0, mm: str | int | None = None, pf: dict[str, float] | None = None,
                  bq: DataFrame | None = None, model: str = "bm25") -> DataFrame:
    """DisMax user query (F27): each query word is a dismax over the ``qf`` fields (field weight as
    boost); words are SHOULD clauses with minimum-should-match ``mm``; ``pf`` adds a phrase boost
    per field for docs containing the whole phrase; ``bq`` adds an extra scored query."""
    from searchlake.operators.filters import min_should_match as msm

    qf = qf or {f: 1.0 for f in indexes}
    words = list(dict.fromkeys(query_terms))
    clauses = []
    for w in words:
        per_field = [scoring.score_terms(indexes[f], [w], model, boosts={w: b}) for f, b in qf.items()]
        clauses.append(dismax_hits(per_field, tie))
    k = msm(len(clauses), mm) if mm is not None else 1
    main = bool_hits([], clauses, [], max(k, 1))
    extras = []
    for f, b in (pf or {}).items():
        if len(words) > 1:
            ph = phrase_hits(indexes[f], words).withColumn("score", F.col("score") * F.lit(float(b)))
            extras.append(ph)
    if bq is not None:
        extras.append(bq)
    if not extras:
        return main
    return bool_hits([main], extras, [])


# ------------------------------------------------------------------ phrases

def _positions(index: Index, terms: list[str]) -> DataFrame:
    """(doc_id, term, pos) for the given terms, restricted to docs containing all of them."""
    return index.terms(list(set(terms))).select("doc_id", "term", F.explode("positions").alias("pos"))


def phrase_freq(index: Index, terms: list[str]) -> DataFrame:
    """Exact phrase (F16): ``doc_id, freq`` = number of start positions where term i sits at pos+i.

    Each step is an equi-join on ``(doc_id, pos)`` (the expected position is part of the key),
    so frequent terms do not multiply rows. Docs first semi-join to those holding every term."""
    toks = _positions(index, terms)
    uniq = list(dict.fromkeys(terms))
    have_all = toks.groupBy("doc_id").agg(F.count_distinct("term").alias("_n")) \
        .filter(F.col("_n") == len(uniq)).select("doc_id")
    toks = toks.join(have_all, "doc_id", "left_semi")
    cur = toks.filter(F.col("term") == terms[0]).select("doc_id", F.col("pos").alias("start"))
    for i, t in enumerate(terms[1:], start=1):
        nxt = toks.filter(F.col("term") == t).select("doc_id", (F.col("pos") - i).alias("start"))
        cur = cur.join(nxt, ["doc_id", "start"], "inner")
    return cur.groupBy("doc_id").agg(F.count(F.lit(1)).alias("freq"))


def multi_phrase_freq(index: Index, slots: list[list[str]]) -> DataFrame:
    """Multi-phrase (F18): alternatives per position; a start matches if some alternative sits at each slot."""
    allt = [t for s in slots for t in s]
    toks = _positions(index, allt)
    cur = toks.filter(F.col("term").isin(slots[0])).select("doc_id", F.col("pos").alias("start")).distinct()
    for i, alts in enumerate(slots[1:], start=1):
        nxt = toks.filter(F.col("term").isin(alts)).select("doc_id", (F.col("pos") - i).alias("start")).distinct()
        cur = cur.join(nxt, ["doc_id", "start"], "inner")
    return cur.groupBy("doc_id").agg(F.count(F.lit(1)).alias("freq"))


def sloppy_phrase_freq(index: Index, terms: list[str], slop: int) -> DataFrame:
    """Sloppy phrase (F17) for distinct terms: matches are position tuples p_i of term i with
    ``max(p_i − i) − min(p_i − i) ≤ slop``; freq = Σ 1/(distance+1) over the matches found from each
    occurrence of the first term (its best, i.e. smallest-distance, completion).

    Offsets are enumerated (``pos − i + d`` for |d| ≤ slop) so every join stays an equi-join on
    ``(doc_id, anchor)``; rows grow by (2·slop+1) per position, never quadratically."""
    toks = _positions(index, terms)
    first = toks.filter(F.col("term") == terms[0]).select("doc_id", F.col("pos").alias("anchor"))
    cur = first.withColumn("lo", F.col("anchor")).withColumn("hi", F.col("anchor")).withColumn(
        "used", F.array("anchor"))  # a repeated term needs a position of its own
    offs = F.sequence(F.lit(-slop), F.lit(slop))
    for i, t in enumerate(terms[1:], start=1):
        occ = toks.filter(F.col("term") == t).select("doc_id", (F.col("pos") - i).alias("rel"))
        occ = occ.select("doc_id", "rel", F.explode(offs).alias("d")).withColumn("anchor", F.col("rel") - F.col("d"))
        cur = cur.join(occ.select("doc_id", "anchor", "rel"), ["doc_id", "anchor"], "inner") \
            .withColumn("lo", F.least("lo", "rel")).withColumn("hi", F.greatest("hi", "rel")) \
            .filter(F.col("hi") - F.col("lo") <= slop)
        if t in terms[:i]:
            cur = cur.filter(~F.array_contains("used", F.col("rel") + i))
        cur = cur.withColumn("used", F.array_append("used", F.col("rel") + i)).drop("rel")
    best = cur.groupBy("doc_id", "anchor").agg(F.min(F.col("hi") - F.col("lo")).alias("dist"))
    return best.groupBy("doc_id").agg(F.sum(F.lit(1.0) / (F.col("dist") + 1)).alias("freq"))


def phrase_hits(index: Index, terms: list[str], slop: int = 0, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Scored phrase: BM25 with the phrase frequency as tf and idf = Σ term idfs."""
    freq = phrase_freq(index, terms) if slop == 0 else sloppy_phrase_freq(index, terms, slop)
    st = index.stats_for(terms).crossJoin(F.broadcast(index.field_stats))
    n, df = F.col("n_docs").cast("double"), F.col("df").cast("double")
    idf = st.agg(F.sum(F.ln(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))).alias("idf"),
                 F.first("avgdl").alias("avgdl"))
    dl = index.terms([terms[0]]).select("doc_id", "dl")
    j = freq.join(dl, "doc_id").crossJoin(F.broadcast(idf))
    tf = F.col("freq").cast("double")
    s = F.col("idf") * tf * (k1 + 1) / (tf + F.lit(k1) * (1 - b + b * F.col("dl") / F.col("avgdl")))
    return j.select("doc_id", s.alias("score"))


def ngram_phrase_terms(grams: list[str], n: int) -> tuple[list[str], list[int]]:
    """N-gram phrase optimisation (F19): keep every n-th gram plus the last (positions returned)."""
    keep = list(range(0, len(grams), n))
    if keep[-1] != len(grams) - 1:
        keep.append(len(grams) - 1)
    return [grams[i] for i in keep], keep


# ------------------------------------------------------------------ spans

def span_term(index: Index, term: str) -> DataFrame:
    """Spans of one term: ``doc_id, start, end`` (end exclusive)."""
    p = index.terms([term]).select("doc_id", F.explode("positions").alias("pos"))
    return p.select("doc_id", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))


def span_or(spans: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), spans).distinct()


def span_near(spans: list[DataFrame], slop: int, in_order: bool = True) -> DataFrame:
    """Near spans (F29/F32): one span from each clause; ordered: each starts at or after the previous
    end; slop = total positions between clauses (ordered) or span length − Σ lengths (unordered).

    Ordered matches are the shortest ones: each clause takes its first span after the previous one, and of
    matches with one end only the latest start stays. Clauses meet on an equi-key: the gap (ordered) or the
    distance of the starts (unordered) is enumerated up to its bound, so rows grow with ``slop``
    and span lengths, never with the square of a document's occurrences."""
    docs = None
    for s in spans:
        d = s.select("doc_id").distinct()
        docs = d if docs is None else docs.join(d, "doc_id", "left_semi")
    spans = [s.join(docs, "doc_id", "left_semi") for s in spans]
    cur = spans[0].select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("_len"))
    for s in spans[1:]:
        nxt = s.select("doc_id", F.col("start").alias("s2"), F.col("end").alias("e2"))
        if in_order:
            first_end = nxt.groupBy("doc_id", "s2").agg(F.min("e2").alias("e2"))
            steps = cur.withColumn("s2", F.explode(F.sequence(F.col("end"), F.col("end") + slop)))
            cur = (steps.join(first_end, ["doc_id", "s2"]).groupBy("doc_id", "start", "end", "_len")
                   .agg(F.min(F.struct("s2", "e2")).alias("n")).select(
                       "doc_id", "start", F.col("n.e2").alias("end"),
                       (F.col("_len") + F.col("n.e2") - F.col("n.s2")).alias("_len")))
        else:
            longest = F.col("e2") - F.col("s2")
            # the later of the two starts at most ``slop`` positions after the other's end
            cell = lambda start, end: F.sequence(start, end + slop)
            left = cur.withColumn("cell", F.explode(cell(F.col("start"), F.col("end"))))
            right = nxt.withColumn("cell", F.col("s2"))
            after = left.join(right, ["doc_id", "cell"])
            before = (nxt.withColumn("cell", F.explode(cell(F.col("s2"), F.col("e2"))))
                      .join(cur.withColumn("cell", F.col("start")), ["doc_id", "cell"]))
            near = after.unionByName(before).distinct().filter(
                ~((F.col("s2") < F.col("end")) & (F.col("start") < F.col("e2")))
                & (F.greatest("end", "e2") - F.least("start", "s2") - F.col("_len") - longest <= slop))
            cur = near.select("doc_id", F.least("start", "s2").alias("start"), F.greatest("end", "e2").alias("end"),
                              (F.col("_len") + longest).alias("_len")).distinct()
    if in_order:
        cur = cur.filter(F.col("end") - F.col("start") - F.col("_len") <= slop)
        return cur.groupBy("doc_id", "end").agg(F.max("start").alias("start")).select("doc_id", "start", "end")
    return cur.select("doc_id", "start", "end").distinct()


def span_first(span: DataFrame, end: int) -> DataFrame:
    """Spans ending at or before position ``end``."""
    return span.filter(F.col("end") <= end)


def span_position_range(span: DataFrame, start: int, end: int) -> DataFrame:
    """Spans with start ≥ ``start`` and end ≤ ``end``."""
    return span.filter((F.col("start") >= start) & (F.col("end") <= end))


def span_not(include: DataFrame, exclude: DataFrame, pre: int = 0, post: int = 0) -> DataFrame:
    """Spans of ``include`` that no ``exclude`` span overlaps within ``pre``/``post`` positions."""
    ex = exclude.select("doc_id", F.col("start").alias("xs"), F.col("end").alias("xe"))
    inc = include.select("doc_id", "start", "end").distinct()
    # equi-join on positions: the widened include span and the exclude span share one
    wide = inc.filter(F.col("end") + post - 1 >= F.col("start") - pre).withColumn(
        "at", F.explode(F.sequence(F.col("start") - pre, F.col("end") + post - 1)))
    taken = ex.filter(F.col("xe") > F.col("xs")).select(
        "doc_id", F.explode(F.sequence("xs", F.col("xe") - 1)).alias("at")).distinct()
    bad = wide.join(taken, ["doc_id", "at"], "left_semi").select("doc_id", "start", "end")
    return inc.join(bad, ["doc_id", "start", "end"], "left_anti")


def span_hits(span: DataFrame) -> DataFrame:
    """Span query as hits: every match adds 1 / (its length + 1)."""
    each = F.lit(1.0) / (F.col("end") - F.col("start") + 1)
    return span.groupBy("doc_id").agg(F.sum(each).alias("score"))


def span_multi(index: Index, terms: DataFrame) -> DataFrame:
    """Spans of a multi-term expansion (F31): every position of any expanded term (prefix,
    wildcard, regexp or fuzzy expansion from the vocabulary), usable inside ``span_near``."""
    p = index.postings.join(terms.select("term").distinct(), "term", "left_semi")
    p = p.select("doc_id", F.explode("positions").alias("pos"))
    return p.select("doc_id", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end")).distinct()
