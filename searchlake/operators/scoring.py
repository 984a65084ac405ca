"""Scoring models (B01–B09) and hit-list helpers.

A score is one expression over ``postings ⋈ term_stats`` plus per-doc length and collection
statistics, summed per doc. The query's terms are few, so their statistics are a bounded
broadcast; the collection statistics are a one-row broadcast. Doc length travels inside the
postings rows (written once at index time), so scoring needs no join with a doc table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def num_found(hits: DataFrame) -> DataFrame:
    """Match count and max score."""
    aggs = [F.count(F.lit(1)).alias("num_found")]
    if "score" in hits.columns:
        aggs.append(F.max("score").alias("max_score"))
    return hits.agg(*aggs)


def positive_only(hits: DataFrame) -> DataFrame:
    """Keep hits with a positive score."""
    return hits.filter(F.col("score") > 0)


def constant_score(hits: DataFrame, c: float = 1.0) -> DataFrame:
    """Replace the score by a constant."""
    return hits.withColumn("score", F.lit(float(c)))


def boost(hits: DataFrame, expr: Column) -> DataFrame:
    """Multiply the score by an expression."""
    return hits.withColumn("score", F.col("score") * expr)


# ------------------------------------------------------------------ per-term statistics join

def _scored_postings(index, terms, boosts=None) -> DataFrame:
    """Postings of the query terms joined with their (broadcast) statistics and the one-row
    collection statistics. Columns: doc_id, term, tf, dl, df, ttf, n_docs, sum_ttf, avgdl, boost."""
    terms = list(dict.fromkeys(terms))
    p = index.terms(terms).select("doc_id", "term", "tf", "dl")
    st = index.stats_for(terms)
    fs = F.broadcast(index.field_stats)
    j = p.join(st, "term").crossJoin(fs)
    if boosts:
        bmap = F.create_map(*[x for t, b in boosts.items() for x in (F.lit(t), F.lit(float(b)))])
        j = j.withColumn("boost", F.coalesce(F.element_at(bmap, F.col("term")), F.lit(1.0)))
    else:
        j = j.withColumn("boost", F.lit(1.0))
    return j


def bm25_expr(k1: float = 1.2, b: float = 0.75) -> Column:
    """BM25 term weight (B01): idf·(k1+1)·tf / (tf + k1·(1 − b + b·dl/avgdl)), idf = ln(1 + (N−df+0.5)/(df+0.5))."""
    tf, dl, df, n, avgdl = (F.col(c).cast("double") for c in ("tf", "dl", "df", "n_docs", "avgdl"))
    idf = F.ln(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    return F.col("boost") * idf * (tf * (k1 + 1)) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / avgdl))


def classic_idf(df: Column, n: Column) -> Column:
    """1 + ln(N/(df+1))."""
    return F.lit(1.0) + F.ln(n / (df + 1))


def lm_dirichlet_expr(mu: float = 2000.0) -> Column:
    """LM Dirichlet (B04): ln(1 + tf/(μ·p)) + ln(μ/(dl+μ)), p = (ttf+1)/(sum_ttf+1); floored at 0."""
    tf, dl, ttf, tot = (F.col(c).cast("double") for c in ("tf", "dl", "ttf", "sum_ttf"))
    p = (ttf + 1) / (tot + 1)
    s = F.ln(F.lit(1.0) + tf / (F.lit(mu) * p)) + F.ln(F.lit(mu) / (dl + F.lit(mu)))
    return F.col("boost") * F.greatest(s, F.lit(0.0))


def lm_jelinek_mercer_expr(lam: float = 0.7) -> Column:
    """LM Jelinek–Mercer (B05): ln(1 + ((1−λ)·tf/dl)/(λ·p))."""
    tf, dl, ttf, tot = (F.col(c).cast("double") for c in ("tf", "dl", "ttf", "sum_ttf"))
    p = (ttf + 1) / (tot + 1)
    return F.col("boost") * F.ln(F.lit(1.0) + (F.lit(1 - lam) * tf / dl) / (F.lit(lam) * p))


def _log2(x: Column) -> Column:
    return F.log2(x)


def dfr_expr(basic: str = "G", after: str = "L", norm: str = "H2", c: float = 1.0) -> Column:
    """Divergence from randomness (B06): basic model × after-effect on a normalized tf."""
    tf, dl, df, ttf, n, avgdl = (F.col(x).cast("double") for x in ("tf", "dl", "df", "ttf", "n_docs", "avgdl"))
    if norm == "H1":
        tfn = tf * avgdl / dl
    elif norm == "H2":
        tfn = tf * _log2(F.lit(1.0) + F.lit(c) * avgdl / dl)
    elif norm == "H3":
        mu = F.lit(c)
        tfn = (tf + mu * (ttf + 1) / (F.col("sum_ttf") + 1)) / (dl + mu) * mu
    elif norm == "Z":
        tfn = tf * F.pow(avgdl / dl, F.lit(c))
    else:
        tfn = tf
    if basic == "G":
        lam = (ttf + 1) / (n + ttf + 1)
        model = _log2(lam + 1) + tfn * _log2((1 + lam) / lam)
    elif basic == "In":
        model = tfn * _log2((n + 1) / (df + 0.5))
    elif basic == "Ine":
        ne = n * (F.lit(1.0) - F.pow((n - 1) / n, ttf))
        model = tfn * _log2((n + 1) / (ne + 0.5))
    elif basic == "IF":
        model = tfn * _log2(F.lit(1.0) + (n + 1) / (ttf + 0.5))
    elif basic == "P":
        lam = (ttf + 1) / (n + 1)
        model = tfn * _log2(tfn / lam) + (lam + F.lit(1.0) / (12 * tfn) - tfn) * F.lit(1.4426950408889634) \
            + F.lit(0.5) * _log2(2 * F.lit(3.141592653589793) * tfn)
    elif basic == "BE":
        f = ttf + 1 + tfn
        big_n = n + f
        model = -_log2(big_n - 1) - F.lit(1.4426950408889634) + _f(big_n + f - 1, big_n + f - tfn - 2) \
            - _f(f, f - tfn)
    else:  # D
        f = ttf + 1 + tfn
        phi = tfn / f
        nphi = 1 - phi
        p = 1.0 / (n + 1)
        d = phi * _log2(phi / p) + nphi * _log2(nphi / (1 - p))
        model = d * f + F.lit(0.5) * _log2(F.lit(1.0) + 2 * F.lit(3.141592653589793) * tfn * nphi)
    if after == "L":
        ae = F.lit(1.0) / (tfn + 1)
    elif after == "B":
        ae = (ttf + 2) / ((df + 1) * (tfn + 1))
    else:
        ae = F.lit(1.0)
    return F.col("boost") * model * ae


def _f(n: Column, m: Column) -> Column:
    return (m + 0.5) * _log2(n / m) + (n - m) * _log2(n)


def ib_expr(distribution: str = "LL", lambda_from: str = "DF", norm: str = "H2", c: float = 1.0) -> Column:
    """Information-based model (B07): −ln-style information of tfn under a log-logistic (LL) or
    smoothed power-law (SPL) distribution with λ from df or ttf."""
    tf, dl, df, ttf, n, avgdl = (F.col(x).cast("double") for x in ("tf", "dl", "df", "ttf", "n_docs", "avgdl"))
    tfn = tf * _log2(F.lit(1.0) + F.lit(c) * avgdl / dl) if norm == "H2" else tf * avgdl / dl
    lam = (df + 1) / (n + 1) if lambda_from == "DF" else (ttf + 1) / (n + 1)
    if distribution == "LL":
        val = -F.ln(lam / (tfn + lam))
    else:
        val = -F.ln((F.pow(lam, tfn / (tfn + 1)) - lam) / (F.lit(1.0) - lam))
    return F.col("boost") * val


def sweet_spot_length_norm(dl: Column, lo: int = 1, hi: int = 1, steepness: float = 0.5) -> Column:
    """Sweet-spot length norm (B03): 1 inside [lo, hi], decaying outside."""
    return F.lit(1.0) / F.sqrt(F.lit(steepness) * (F.abs(dl - lo) + F.abs(dl - hi) - (hi - lo)) + 1.0)


def sweet_spot_expr(lo: int = 1, hi: int = 1, steepness: float = 0.5, tf_min: float = 0.0,
                    tf_base: float = 0.0, hyperbolic: bool = False, tf_max: float = 2.0, xoffset: float = 10.0,
                    hyper_base: float = 1.3) -> Column:
    """Sweet-spot similarity (B03): classic TF-IDF with a plateau length norm and baseline or
    hyperbolic tf."""
    tf, dl, df, n = (F.col(x).cast("double") for x in ("tf", "dl", "df", "n_docs"))
    if hyperbolic:
        tfv = F.lit(tf_min) + (F.lit(tf_max) - tf_min) / 2 * (
            (F.pow(F.lit(hyper_base), tf - xoffset) - F.pow(F.lit(hyper_base), -(tf - xoffset)))
            / (F.pow(F.lit(hyper_base), tf - xoffset) + F.pow(F.lit(hyper_base), -(tf - xoffset))) + 1)
    else:
        tfv = F.when(tf <= tf_min, F.lit(tf_base)).otherwise(F.sqrt(tf + (tf_base * tf_base) - tf_min))
    idf = classic_idf(df, n)
    return F.col("boost") * tfv * idf * idf * sweet_spot_length_norm(dl, lo, hi, steepness)


MODELS = {
    "bm25": bm25_expr,
    "lm_dirichlet": lm_dirichlet_expr,
    "lm_jm": lm_jelinek_mercer_expr,
    "dfr": dfr_expr,
    "ib": ib_expr,
    "sweet_spot": sweet_spot_expr,
}


def score_terms(index, terms, model: str | Column = "bm25", boosts: dict | None = None,
                with_matches: bool = False, **params) -> DataFrame:
    """Score docs containing any of ``terms`` (OR query) under a model; ``doc_id, score[, matched]``.

    The sum per doc is one hash aggregate over the matching postings only (B01–B08).
    ``model`` may also be a callable ``() -> Column`` over the standard columns (V06)."""
    j = _scored_postings(index, terms, boosts)
    if isinstance(model, str):
        expr = MODELS[model](**params)
    elif callable(model):
        expr = model()
    else:
        expr = model
    aggs = [F.sum(expr).alias("score")]
    if with_matches:
        aggs.append(F.count(F.lit(1)).alias("matched"))
    return j.groupBy("doc_id").agg(*aggs)


def bm25(index, terms, k1: float = 1.2, b: float = 0.75, boosts: dict | None = None) -> DataFrame:
    return score_terms(index, terms, "bm25", boosts, k1=k1, b=b)


def tfidf_classic(index, terms, boosts: dict | None = None, coord: bool = True) -> DataFrame:
    """Classic TF-IDF with coord and queryNorm.

    doc score = coord · Σ_t √tf · idf_t² · boost_t · queryNorm · (1/√dl), coord = matched/|terms|,
    queryNorm = 1/√(Σ (idf_t·boost_t)²) — the norm needs all query-term weights first, which is a
    one-row aggregate over the (bounded) query-term statistics."""
    terms = list(dict.fromkeys(terms))
    j = _scored_postings(index, terms, boosts)
    idf = classic_idf(F.col("df").cast("double"), F.col("n_docs").cast("double"))
    st = index.stats_for(terms).crossJoin(F.broadcast(index.field_stats))
    if boosts:
        bmap = F.create_map(*[x for t, b in boosts.items() for x in (F.lit(t), F.lit(float(b)))])
        bcol = F.coalesce(F.element_at(bmap, F.col("term")), F.lit(1.0))
    else:
        bcol = F.lit(1.0)
    qn = st.agg(F.sum(F.pow(idf * bcol, 2)).alias("_ss")).select(
        (F.lit(1.0) / F.sqrt("_ss")).alias("query_norm"))
    w = F.sqrt(F.col("tf").cast("double")) * idf * idf * F.col("boost") / F.sqrt(F.col("dl").cast("double"))
    per_doc = j.groupBy("doc_id").agg(F.sum(w).alias("_s"), F.count(F.lit(1)).alias("_m"))
    out = per_doc.crossJoin(F.broadcast(qn))
    c = (F.col("_m") / F.lit(float(len(terms)))) if coord else F.lit(1.0)
    return out.select("doc_id", (F.col("_s") * F.col("query_norm") * c).alias("score"))


def top_hits(scored: DataFrame, k: int = 10, key: str = "doc_id") -> DataFrame:
    """Top-k by score desc, key asc, with rank (TakeOrderedAndProject)."""
    from searchlake.operators.util import top_k
    return top_k(scored, [F.col("score").desc(), F.col(key).asc()], k)


def explain_scores(index, terms, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Per doc and term: tf, df, idf, the length norm and the BM25 term weight that the doc's score sums (R05). The norm is what
    is added to tf in the weight's denominator."""
    j = _scored_postings(index, terms)
    n, df = F.col("n_docs").cast("double"), F.col("df").cast("double")
    idf = F.ln(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    norm = F.lit(k1) * (1 - b + b * F.col("dl") / F.col("avgdl"))
    return j.select("doc_id", "term", "tf", "df", idf.alias("idf"), norm.alias("norm"), bm25_expr(k1, b).alias("weight"))


def payload_score(index, payload_tokens: DataFrame, terms, fn: str = "avg", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Payload scoring (F34): each matching term's BM25 weight × avg/min/max of its payloads in
    the doc, summed per doc. ``payload_tokens``: ``doc_id, term, payload`` (e.g. from
    ``analysis.delimited_payloads``); only the query terms' rows are aggregated."""
    agg = {"avg": F.avg, "min": F.min, "max": F.max}[fn]
    pl = payload_tokens.filter(F.col("term").isin(list(terms))).groupBy("doc_id", "term") \
        .agg(agg("payload").alias("_pf"))
    j = _scored_postings(index, terms).join(pl, ["doc_id", "term"], "left")
    w = bm25_expr(k1, b) * F.coalesce(F.col("_pf"), F.lit(1.0))
    return j.groupBy("doc_id").agg(F.sum(w).alias("score"))
