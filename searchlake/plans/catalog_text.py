"""Queries over analyzed text: index build, scoring models, term/phrase/boolean/fuzzy matching,
term lists and statistics. The oracle tokenizes with the same ASCII class in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.operators import index as ix
from searchlake.operators import scoring, textmatch as tm
from searchlake.operators.util import top_k
from searchlake.plans.registry import register
from searchlake.session import table as T

# Shared DuckDB CTEs: tokens, doc lengths, postings, term and field statistics.
_TOK = """tok AS (SELECT doc_id, unnest(x) AS term, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos
              FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents)),
dl AS (SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS INTEGER) AS dl FROM documents),
fs AS (SELECT count(*) AS n_docs, sum(dl) AS sum_ttf, sum(dl) / count(*) AS avgdl FROM dl),
tf AS (SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY term, doc_id),
st AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM tf GROUP BY term)"""

_SCORED = """j AS (SELECT tf.doc_id, tf.term, CAST(tf.tf AS DOUBLE) AS tf, CAST(dl.dl AS DOUBLE) AS dl,
                  CAST(st.df AS DOUBLE) AS df, CAST(st.ttf AS DOUBLE) AS ttf, CAST(fs.n_docs AS DOUBLE) AS n_docs,
                  CAST(fs.sum_ttf AS DOUBLE) AS sum_ttf, fs.avgdl AS avgdl, 1.0 AS boost
           FROM tf JOIN st USING (term) JOIN dl USING (doc_id) CROSS JOIN fs WHERE tf.term IN ({terms}))"""

Q3 = ["the", "ment", "eau"]
_Q3_SQL = ", ".join(f"'{t}'" for t in Q3)


def _index(spark, d):
    """The index of the documents, written once per session and read by every text query."""
    return ix.session_index(T(spark, d, "documents"), "doc_id", "text")


def _model_sql(expr: str, limit: int | None = 10) -> str:
    q = f"""WITH {_TOK}, {_SCORED.format(terms=_Q3_SQL)},
s AS (SELECT doc_id, sum({expr}) AS score FROM j GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM s"""
    return q + (f" QUALIFY rank <= {limit}" if limit else "")


def _ranked(df, k=10):
    out = top_k(df, [F.col("score").desc(), F.col("doc_id").asc()], k)
    return out.withColumn("score", F.round("score", 6))


_BM25 = ("boost * ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * (tf * (1.2 + 1)) / "
         "(tf + 1.2 * ((1 - 0.75) + 0.75 * dl / avgdl))")


@register("t50_index_build_postings", f"""
WITH {_TOK}
SELECT t.term, t.doc_id, count(*) AS tf, any_value(dl.dl) AS dl, list(t.pos ORDER BY t.pos) AS positions
FROM tok t JOIN dl USING (doc_id) GROUP BY t.term, t.doc_id
""")
def t50(spark, d):
    return ix.build_index(T(spark, d, "documents"), "doc_id", "text").postings.select("term", "doc_id", "tf", "dl", "positions")


@register("t50_term_stats", f"WITH {_TOK} SELECT term, df, ttf FROM st")
def t50b(spark, d):
    return _index(spark, d).term_stats


@register("t50_field_stats", f"WITH {_TOK} SELECT n_docs, CAST(sum_ttf AS BIGINT) AS sum_ttf, avgdl FROM fs")
def t50c(spark, d):
    return _index(spark, d).field_stats


@register("b01_bm25_three_terms_top10", _model_sql(_BM25))
def b01(spark, d):
    return _ranked(scoring.bm25(_index(spark, d), Q3))


@register("b01_bm25_all_matches", _model_sql(_BM25, None))
def b01b(spark, d):
    s = scoring.bm25(_index(spark, d), Q3)
    from searchlake.operators.util import global_row_number
    return global_row_number(s, [F.col("score").desc(), F.col("doc_id").asc()]).withColumn(
        "score", F.round("score", 6))


@register("b09_bm25_term_boosts", _model_sql(_BM25.replace("boost *", "(CASE term WHEN 'ment' THEN 3.0 ELSE 1.0 END) *")))
def b09(spark, d):
    return _ranked(scoring.bm25(_index(spark, d), Q3, boosts={"ment": 3.0}))


@register("b02_tfidf_classic_coord_querynorm", f"""
WITH {_TOK}, {_SCORED.format(terms=_Q3_SQL)},
qn AS (SELECT 1.0 / sqrt(sum(pow(1.0 + ln(CAST(fs.n_docs AS DOUBLE) / (st.df + 1)), 2))) AS query_norm
       FROM st CROSS JOIN fs WHERE st.term IN ({_Q3_SQL})),
s AS (SELECT doc_id, sum(sqrt(tf) * (1.0 + ln(n_docs / (df + 1))) * (1.0 + ln(n_docs / (df + 1))) * boost / sqrt(dl)) AS s,
             count(*) AS m FROM j GROUP BY doc_id),
r AS (SELECT doc_id, s * query_norm * (m / 3.0) AS score FROM s CROSS JOIN qn)
SELECT doc_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r QUALIFY rank <= 10
""")
def b02(spark, d):
    return _ranked(scoring.tfidf_classic(_index(spark, d), Q3))


@register("b04_lm_dirichlet", _model_sql(
    "boost * greatest(ln(1.0 + tf / (2000.0 * ((ttf + 1) / (sum_ttf + 1)))) + ln(2000.0 / (dl + 2000.0)), 0.0)"))
def b04(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "lm_dirichlet"))


@register("b05_lm_jelinek_mercer", _model_sql(
    "boost * ln(1.0 + ((1 - 0.7) * tf / dl) / (0.7 * ((ttf + 1) / (sum_ttf + 1))))"))
def b05(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "lm_jm", lam=0.7))


_TFN_H2 = "(tf * log2(1.0 + 1.0 * avgdl / dl))"


@register("b06_dfr_in_l_h2", _model_sql(
    f"boost * ({_TFN_H2} * log2((n_docs + 1) / (df + 0.5))) * (1.0 / ({_TFN_H2} + 1))"))
def b06(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="In", after="L", norm="H2"))


_LAM_G = "((ttf + 1) / (n_docs + ttf + 1))"


@register("b06_dfr_g_b_h2", _model_sql(
    f"boost * (log2({_LAM_G} + 1) + {_TFN_H2} * log2((1 + {_LAM_G}) / {_LAM_G})) * ((ttf + 2) / ((df + 1) * ({_TFN_H2} + 1)))"))
def b06b(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="G", after="B", norm="H2"))


_LAM_P = "((ttf + 1) / (n_docs + 1))"


@register("b06_dfr_p_l_h2", _model_sql(
    f"boost * ({_TFN_H2} * log2({_TFN_H2} / {_LAM_P}) + ({_LAM_P} + 1 / (12 * {_TFN_H2}) - {_TFN_H2}) * log2(exp(1.0))"
    f" + 0.5 * log2(2 * pi() * {_TFN_H2})) * (1.0 / ({_TFN_H2} + 1))"))
def b06p(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="P", after="L", norm="H2"))


_F = f"(ttf + 1 + {_TFN_H2})"
_BE_N = f"({_F} + n_docs)"
_BE_F = lambda n, m: f"((({m}) + 0.5) * log2(({n}) / ({m})) + (({n}) - ({m})) * log2({n}))"


@register("b06_dfr_be_l_h2", _model_sql(
    f"boost * (-log2(({_BE_N} - 1) * exp(1.0)) + {_BE_F(f'{_BE_N} + {_F} - 1', f'{_BE_N} + {_F} - {_TFN_H2} - 2')}"
    f" - {_BE_F(_F, f'{_F} - {_TFN_H2}')}) * (1.0 / ({_TFN_H2} + 1))"))
def b06be(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="BE", after="L", norm="H2"))


_PHI = f"({_TFN_H2} / {_F})"


@register("b06_dfr_d_b_h1", _model_sql(
    "boost * " + (f"(({_PHI} * log2({_PHI} / (1.0 / (n_docs + 1))) + (1 - {_PHI}) * log2((1 - {_PHI}) / (1 - 1.0 / (n_docs + 1)))) * {_F}"
                  f" + 0.5 * log2(1 + 2 * pi() * {_TFN_H2} * (1 - {_PHI}))) * ((ttf + 2) / ((df + 1) * ({_TFN_H2} + 1)))"
                  ).replace(_TFN_H2, "(tf * avgdl / dl)")))
def b06d(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="D", after="B", norm="H1"))


@register("b06_dfr_ine_none_h2", _model_sql(
    f"boost * {_TFN_H2} * log2((n_docs + 1) / (n_docs * (1 - pow((n_docs - 1) / n_docs, ttf)) + 0.5))"))
def b06ine(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="Ine", after="none", norm="H2"))


@register("b06_dfr_if_l_h2", _model_sql(
    f"boost * {_TFN_H2} * log2(1 + (n_docs + 1) / (ttf + 0.5)) * (1.0 / ({_TFN_H2} + 1))"))
def b06if(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "dfr", basic="IF", after="L", norm="H2"))


@register("b07_ib_ll_df_h2", _model_sql(
    f"boost * -ln(((df + 1) / (n_docs + 1)) / ({_TFN_H2} + ((df + 1) / (n_docs + 1))))"))
def b07(spark, d):
    return _ranked(scoring.score_terms(_index(spark, d), Q3, "ib", distribution="LL", lambda_from="DF"))


@register("b08_multi_model_sum", _model_sql(
    f"{_BM25} + boost * greatest(ln(1.0 + tf / (2000.0 * ((ttf + 1) / (sum_ttf + 1)))) + ln(2000.0 / (dl + 2000.0)), 0.0)"))
def b08(spark, d):
    idx = _index(spark, d)
    combo = lambda: scoring.bm25_expr() + scoring.lm_dirichlet_expr()
    return _ranked(scoring.score_terms(idx, Q3, combo))


@register("f02_match_term_scored", _model_sql(_BM25, None).replace(f"IN ({_Q3_SQL})", "IN ('eau')"))
def f02(spark, d):
    s = tm.match_term(_index(spark, d), "eau")
    from searchlake.operators.util import global_row_number
    return global_row_number(s, [F.col("score").desc(), F.col("doc_id").asc()]).withColumn(
        "score", F.round("score", 6))


def _term_hits_sql(name, term):
    return f"""{name} AS (SELECT doc_id, {_BM25} AS score FROM ({_SCORED.format(terms=f"'{term}'")[6:-1]}))"""


@register("f14_boolean_scored_must_should_not", f"""
WITH {_TOK}, {_term_hits_sql('h_the', 'the')}, {_term_hits_sql('h_ment', 'ment')},
{_term_hits_sql('h_eau', 'eau')}, {_term_hits_sql('h_lich', 'lich')},
u AS (SELECT doc_id, score, 'm' AS k, 0 AS i FROM h_the UNION ALL SELECT doc_id, score, 's', 0 FROM h_ment
      UNION ALL SELECT doc_id, score, 's', 1 FROM h_eau UNION ALL SELECT doc_id, 0.0, 'n', 0 FROM h_lich),
g AS (SELECT doc_id, sum(score) FILTER (WHERE k <> 'n') AS score, count(DISTINCT i) FILTER (WHERE k = 'm') AS nm,
             count(DISTINCT i) FILTER (WHERE k = 's') AS ns, count(*) FILTER (WHERE k = 'n') AS nn FROM u GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score FROM g WHERE nm = 1 AND ns >= 1 AND nn = 0
""")
def f14s(spark, d):
    idx = _index(spark, d)
    h = {t: tm.match_term(idx, t) for t in ("the", "ment", "eau", "lich")}
    out = tm.bool_hits([h["the"]], [h["ment"], h["eau"]], [h["lich"]], min_should_match=1)
    return out.withColumn("score", F.round("score", 6))


@register("f25_dismax_tie", f"""
WITH {_TOK}, {_term_hits_sql('h_ment', 'ment')}, {_term_hits_sql('h_eau', 'eau')},
u AS (SELECT * FROM h_ment UNION ALL SELECT * FROM h_eau)
SELECT doc_id, round(max(score) + 0.1 * (sum(score) - max(score)), 6) AS score FROM u GROUP BY doc_id
""")
def f25(spark, d):
    idx = _index(spark, d)
    out = tm.dismax_hits([tm.match_term(idx, "ment"), tm.match_term(idx, "eau")], tie=0.1)
    return out.withColumn("score", F.round("score", 6))


@register("f16_phrase_exact_freq", f"""
WITH {_TOK}
SELECT a.doc_id, count(*) AS freq FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
WHERE a.term = 'of' AND b.term = 'the' GROUP BY a.doc_id
""")
def f16(spark, d):
    return tm.phrase_freq(_index(spark, d), ["of", "the"])


@register("f16_phrase_three_terms", f"""
WITH {_TOK}
SELECT a.doc_id, count(*) AS freq FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
JOIN tok c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2
WHERE a.term = 'the' AND b.term = 'the' AND c.term = 'the' GROUP BY a.doc_id
""")
def f16b(spark, d):
    return tm.phrase_freq(_index(spark, d), ["the", "the", "the"])


@register("f18_multi_phrase", f"""
WITH {_TOK}
SELECT doc_id, count(*) AS freq FROM (SELECT DISTINCT a.doc_id, a.pos FROM tok a
  JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
  WHERE a.term IN ('of', 'in') AND b.term IN ('the', 'a')) GROUP BY doc_id
""")
def f18(spark, d):
    return tm.multi_phrase_freq(_index(spark, d), [["of", "in"], ["the", "a"]])


@register("f17_sloppy_phrase_two_terms", f"""
WITH {_TOK},
m AS (SELECT a.doc_id, a.pos AS anchor, min(abs((b.pos - 1) - a.pos)) AS dist
      FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND abs((b.pos - 1) - a.pos) <= 2
      WHERE a.term = 'the' AND b.term = 'of' GROUP BY a.doc_id, a.pos)
SELECT doc_id, round(sum(1.0 / (dist + 1)), 6) AS freq FROM m GROUP BY doc_id
""")
def f17(spark, d):
    out = tm.sloppy_phrase_freq(_index(spark, d), ["the", "of"], 2)
    return out.withColumn("freq", F.round("freq", 6))


@register("f04_prefix_on_text_constant_score", f"""
WITH {_TOK}
SELECT DISTINCT doc_id, 1.0 AS score FROM tok WHERE starts_with(term, 'therin')
""")
def f04t(spark, d):
    idx = _index(spark, d)
    return tm.multi_term_hits(idx, tm.expand_prefix(idx, "therin"))


@register("f05_wildcard_on_text", f"""
WITH {_TOK}
SELECT DISTINCT doc_id, 1.0 AS score FROM tok WHERE term LIKE 'th_r%n'
""")
def f05t(spark, d):
    idx = _index(spark, d)
    return tm.multi_term_hits(idx, tm.expand_wildcard(idx, "th?r*n"))


@register("f06_regexp_on_text", f"""
WITH {_TOK}
SELECT DISTINCT doc_id, 1.0 AS score FROM tok WHERE regexp_full_match(term, 'eau(x|ment)')
""")
def f06t(spark, d):
    idx = _index(spark, d)
    return tm.multi_term_hits(idx, tm.expand_regexp(idx, "eau(x|ment)"))


@register("f07_fuzzy_term_expansion", f"""
WITH {_TOK}
SELECT term, CAST(levenshtein(term, 'therin') AS INTEGER) AS edits,
       round(1.0 - levenshtein(term, 'therin') / least(length(term), 6), 6) AS fuzzy_boost FROM st
WHERE abs(length(term) - 6) <= 2 AND levenshtein(term, 'therin') <= 2
ORDER BY fuzzy_boost DESC, df DESC, term LIMIT 50
""")
def f07(spark, d):
    out = tm.expand_fuzzy(_index(spark, d), "therin", 2, 0, 50, transpositions=False)
    return out.withColumn("fuzzy_boost", F.round("fuzzy_boost", 6))


# DuckDB measures bytes: letters outside ASCII become single upper-case ones first
def _one_byte(c: str) -> str:
    return f"translate({c}, 'äöüßéèêëçóíñáúàâîôûùïœæ', 'ABCDEFGHIJKLMNOPQRSTUVW')"


_ONE_BYTE = _one_byte("term")


@register("f07_fuzzy_with_transpositions", f"""
WITH {_TOK},
c AS (SELECT term, df, damerau_levenshtein({_ONE_BYTE}, 'htern') AS k, length(term) AS n FROM st)
SELECT term, CAST(k AS INTEGER) AS edits, round(1.0 - k / least(n, 5), 6) AS fuzzy_boost FROM c WHERE k <= 2
ORDER BY 1.0 - k / least(n, 5) DESC, df DESC, term LIMIT 50
""")
def f07t(spark, d):
    out = tm.expand_fuzzy(_index(spark, d), "htern", 2, 0, 50)
    return out.withColumn("fuzzy_boost", F.round("fuzzy_boost", 6))


@register("f29_span_near_ordered", f"""
WITH {_TOK}
, n AS (SELECT a.doc_id, a.pos AS start, min(b.pos) + 1 AS e FROM tok a JOIN tok b ON a.doc_id = b.doc_id
  WHERE a.term = 'the' AND b.term = 'of' AND b.pos >= a.pos + 1 GROUP BY a.doc_id, a.pos)
SELECT doc_id, max(start) AS start, e AS "end" FROM n WHERE e - 1 - (start + 1) <= 2 GROUP BY doc_id, e
""")
def f29(spark, d):
    idx = _index(spark, d)
    return tm.span_near([tm.span_term(idx, "the"), tm.span_term(idx, "of")], slop=2, in_order=True)


@register("f30_span_first", f"""
WITH {_TOK}
SELECT doc_id, pos AS start, pos + 1 AS "end" FROM tok WHERE term = 'the' AND pos + 1 <= 5
""")
def f30(spark, d):
    return tm.span_first(tm.span_term(_index(spark, d), "the"), 5)


@register("f30_span_not", f"""
WITH {_TOK}
SELECT DISTINCT a.doc_id, a.pos AS start, a.pos + 1 AS "end" FROM tok a WHERE a.term = 'the'
AND NOT EXISTS (SELECT 1 FROM tok b WHERE b.doc_id = a.doc_id AND b.term = 'of'
                AND b.pos < a.pos + 1 + 1 AND b.pos + 1 > a.pos - 1)
""")
def f30b(spark, d):
    idx = _index(spark, d)
    return tm.span_not(tm.span_term(idx, "the"), tm.span_term(idx, "of"), pre=1, post=1)


# ------------------------------------------------------------------ term lists and profiles

@register("a22_terms_list_prefix_by_count", f"""
WITH {_TOK}
SELECT term, df, row_number() OVER (ORDER BY df DESC, term) AS rank FROM st WHERE starts_with(term, 'th') AND df >= 1
QUALIFY rank <= 10
""")
def a22(spark, d):
    from searchlake.operators.terms import terms_list
    return terms_list(_index(spark, d), prefix="th", limit=10)


@register("a22_terms_list_range_index_order", f"""
WITH {_TOK}
SELECT term, df, row_number() OVER (ORDER BY term) AS rank FROM st
WHERE term >= 'ea' AND term < 'eb' AND df >= 2 AND df <= 50 AND regexp_full_match(term, '[a-z]+')
QUALIFY rank <= 25
""")
def a22b(spark, d):
    from searchlake.operators.terms import terms_list
    return terms_list(_index(spark, d), lower="ea", upper="eb", upper_incl=False, mincount=2, maxcount=50,
                      regex="[a-z]+", sort="index", limit=25)


@register("a24_collection_profile_df_histogram", f"""
WITH {_TOK}
SELECT CAST(pow(2, ceil(log2(df))) AS BIGINT) AS df_bucket, count(*) AS terms FROM st GROUP BY 1
""")
def a24(spark, d):
    from searchlake.operators.terms import df_histogram
    return df_histogram(_index(spark, d))


@register("a24_collection_profile_summary", f"""
WITH {_TOK}
SELECT (SELECT count(DISTINCT doc_id) FROM tok) AS docs_with_field, (SELECT count(*) FROM st) AS distinct_terms,
       (SELECT n_docs FROM fs) AS n_docs
""")
def a24b(spark, d):
    from searchlake.operators.terms import field_profile
    return field_profile(_index(spark, d))


@register("a25_term_vectors_report", f"""
WITH {_TOK}
SELECT tf.doc_id, tf.term, tf.tf, st.df, round(tf.tf / st.df, 6) AS tf_idf FROM tf JOIN st USING (term)
""")
def a25(spark, d):
    tv = ix.term_vectors(_index(spark, d))
    return tv.select("doc_id", "term", "tf", "df", F.round("tf_idf", 6).alias("tf_idf"))


@register("t44_auto_stop_words", f"""
WITH {_TOK}
SELECT term FROM st WHERE df > 0.4 * (SELECT n_docs FROM fs)
""")
def t44(spark, d):
    idx = _index(spark, d)
    n = idx.field_stats.select("n_docs").first()[0]
    from searchlake.operators.analysis import auto_stop_words
    return auto_stop_words(idx.term_stats, n, 0.4)


@register("f31_span_multi_prefix_in_near", f"""
WITH {_TOK}, n AS (SELECT a.doc_id, a.pos AS start, min(b.pos) + 1 AS e FROM tok a JOIN tok b ON a.doc_id = b.doc_id
  WHERE starts_with(a.term, 'ther') AND b.term = 'the' AND b.pos >= a.pos + 1 GROUP BY a.doc_id, a.pos)
SELECT doc_id, max(start) AS start, e AS "end" FROM n WHERE e - 1 - (start + 1) <= 3 GROUP BY doc_id, e
""")
def f31(spark, d):
    idx = _index(spark, d)
    return tm.span_near([tm.span_multi(idx, tm.expand_prefix(idx, "ther")), tm.span_term(idx, "the")], 3, True)
