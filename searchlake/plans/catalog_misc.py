"""Queries for analysis chains (T*), result components (C*), sources/sinks (S*), search log (A29) and
streaming ingest (Q*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.operators import analysis as an
from searchlake.operators import components as cp
from searchlake.operators import index as ix
from searchlake.operators import scoring
from searchlake.plans.catalog_text import _one_byte
from searchlake.plans.registry import register
from searchlake.session import scratch_dir
from searchlake.session import table as T

_Q3 = ["the", "ment", "eau"]


def _docs(spark, d):
    return T(spark, d, "documents")


def _index(spark, d):
    return ix.session_index(_docs(spark, d), "doc_id", "text")


def _per_doc_counts(tokens_df):
    return tokens_df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                           F.count_distinct("term").alias("n_distinct"),
                                           F.sum("pos").cast("long").alias("pos_sum"))


# ------------------------------------------------------------------ analysis chains (T*)

@register("t02_whitespace_tokenizer_counts", r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS x FROM documents)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t) GROUP BY doc_id
""")
def t02(spark, d):
    toks = an.token_table(_docs(spark, d), "doc_id", "text", an.Analyzer(an.split_tokenizer(r"\s+")),
                          with_length=False)
    return _per_doc_counts(toks)


@register("t03_letter_lowercase_tokenizer_counts", r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS x FROM documents)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t) GROUP BY doc_id
""")
def t03(spark, d):
    toks = an.token_table(_docs(spark, d), "doc_id", "text", an.Analyzer(an.letter_tokenizer(lower=True)),
                          with_length=False)
    return _per_doc_counts(toks)


_STOP_SQL = ", ".join(f"'{w}'" for w in an.ENGLISH_STOP_WORDS)


@register("t14_stop_filter_keeps_position_holes", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
u AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM u WHERE term NOT IN ({_STOP_SQL}) GROUP BY doc_id
""")
def t14(spark, d):
    a = an.Analyzer(an.pattern_tokenizer(), [an.stop_filter()])
    return _per_doc_counts(an.token_table(_docs(spark, d), "doc_id", "text", a, with_length=False))


@register("t15_t17_keep_words_and_length_filter", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
u AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM u WHERE length(term) BETWEEN 4 AND 8 AND term NOT IN ('that', 'with') GROUP BY doc_id
""")
def t15(spark, d):
    a = an.Analyzer(an.pattern_tokenizer(), [an.length_filter(4, 8), an.stop_filter(["that", "with"])])
    return _per_doc_counts(an.token_table(_docs(spark, d), "doc_id", "text", a, with_length=False))


@register("t18_limit_token_count", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+')[1:50] AS x FROM documents)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t) GROUP BY doc_id
""")
def t18(spark, d):
    a = an.Analyzer(an.pattern_tokenizer(), [an.limit_token_count(50)])
    return _per_doc_counts(an.token_table(_docs(spark, d), "doc_id", "text", a, with_length=False))


@register("t24_reverse_terms_vocabulary", """
SELECT DISTINCT reverse(unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+'))) AS term FROM documents
""")
def t24(spark, d):
    a = an.Analyzer(an.pattern_tokenizer(), [an.reverse_filter()])
    return an.token_table(_docs(spark, d), "doc_id", "text", a, with_length=False).select("term").distinct()


@register("t31_word_bigram_shingles", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
s AS (SELECT doc_id, unnest(list_transform(range(1, len(x)), lambda i: x[i] || ' ' || x[i + 1])) AS shingle FROM t)
SELECT shingle, count(*) AS count FROM s GROUP BY shingle
""")
def t31(spark, d):
    sh = an.shingles(2, 2, unigrams=False)
    toks = _docs(spark, d).select(F.regexp_extract_all(F.lower("text"), F.lit("[\\pL\\pN]+"), 0).alias("toks"))
    return toks.select(F.explode(F.flatten(sh(F.col("toks")))).alias("shingle")).groupBy("shingle") \
        .agg(F.count(F.lit(1)).alias("count"))


@register("t10_t11_ngrams_and_edge_ngrams", """
WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT p_partkey, word, list_transform(range(1, least(3, length(word)) + 1), lambda g: left(word, g)) AS edges,
       list_transform(range(1, length(word) - 2 + 2), lambda i: substr(word, i, 2)) AS bigrams FROM w
""")
def t10(spark, d):
    p = T(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    edge = an.edge_ngrams(1, 3)(F.array("word"))[0]
    grams = an.ngrams_of_tokens(2, 2)(F.array("word"))[0]
    return p.select("p_partkey", "word", edge.alias("edges"), grams.alias("bigrams"))


@register("t09_path_hierarchy_of_urls", r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)?', 1) AS path FROM pages),
s AS (SELECT page_id, string_split(path, '/') AS parts FROM p)
SELECT page_id, list_filter(list_transform(range(1, len(parts) + 1), lambda i: array_to_string(parts[1:i], '/')), lambda p: p <> '') AS prefixes FROM s
""")
def t09(spark, d):
    p = T(spark, d, "pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://[^/?#]+(/[^?#]*)?", 1).alias("path"))
    return p.select("page_id", an.path_hierarchy("/")(F.col("path")).alias("prefixes"))


@register("t36_elision_french", """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-zàâçéèêëîïôûùüÿœ'']+')) AS term FROM documents WHERE lang = 'fr')
SELECT regexp_replace(term, '^(jusqu|quoiqu|lorsqu|puisqu|qu|l|m|t|n|s|j|d|c)''', '') AS term, count(*) AS count FROM t GROUP BY 1
""")
def t36(spark, d):
    """French elision: documents with ``lang = 'fr'`` only, as part of the feature."""
    docs = _docs(spark, d).filter(F.col("lang") == "fr")
    a = an.Analyzer(an.pattern_tokenizer("[a-zàâçéèêëîïôûùüÿœ']+"), [an.elision()])
    toks = an.token_table(docs, "doc_id", "text", a, with_length=False)
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


@register("t40_english_minimal_stemming_vocabulary", """
WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents WHERE lang = 'en')
SELECT term, CASE WHEN length(term) < 3 OR right(term, 1) <> 's' THEN term
  WHEN substr(term, length(term) - 1, 1) IN ('u', 's') THEN term
  WHEN substr(term, length(term) - 1, 1) = 'e' AND length(term) > 3 AND substr(term, length(term) - 2, 1) = 'i'
       AND substr(term, length(term) - 3, 1) NOT IN ('a', 'e') THEN substr(term, 1, length(term) - 3) || 'y'
  WHEN substr(term, length(term) - 1, 1) = 'e' AND substr(term, length(term) - 2, 1) IN ('i', 'a', 'o', 'e') THEN term
  ELSE substr(term, 1, length(term) - 1) END AS stem FROM v
""")
def t40(spark, d):
    """The English minimal stemmer: an English feature, so documents with ``lang = 'en'`` only."""
    docs = _docs(spark, d).filter(F.col("lang") == "en")
    vocab = an.token_table(docs, "doc_id", "text", with_length=False).select("term").distinct()
    return vocab.select("term", an.english_minimal_stem(F.col("term")).alias("stem"))


@register("t44_t49_standard_preset_counts", r"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{Nd}]+(?:[''’.][\p{L}\p{Nd}]+)*') AS x FROM documents),
u AS (SELECT doc_id, lower(unnest(x)) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM u WHERE term NOT IN ({stop}) GROUP BY doc_id
""".replace("{stop}", _STOP_SQL))
def t49(spark, d):
    return _per_doc_counts(an.token_table(_docs(spark, d), "doc_id", "text", an.preset("standard"), with_length=False))


@register("t51_per_field_chains_conversations", r"""
WITH a AS (SELECT conv_id * 1000 + turn AS doc_id, 'text' AS field, regexp_extract_all(lower(text), '[\pL\pN]+') AS x FROM conversations
           UNION ALL SELECT conv_id * 1000 + turn, 'role', [role] FROM conversations)
SELECT field, count(*) AS n_tokens, count(DISTINCT term) AS n_distinct FROM (SELECT field, unnest(x) AS term FROM a) GROUP BY field
""")
def t51(spark, d):
    c = T(spark, d, "conversations").withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn"))
    toks = an.per_field_tokens(c, "doc_id", {"text": an.default_analyzer(), "role": an.Analyzer(an.keyword_tokenizer())})
    return toks.groupBy("field").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_distinct("term").alias("n_distinct"))


@register("t19_ascii_folding_vocabulary")
def t19(spark, d):
    a = an.Analyzer(an.pattern_tokenizer(an.UNICODE_WORD), [an.ascii_folding()])
    return an.token_table(_docs(spark, d), "doc_id", "text", a, with_length=False).select("term").distinct()


# ------------------------------------------------------------------ components (C*)

_TOK = """tok AS (SELECT doc_id, unnest(x) AS term FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents)),
dl AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS dl FROM documents),
fs AS (SELECT count(*) AS n_docs, sum(dl) / count(*) AS avgdl FROM dl),
tf AS (SELECT term, doc_id, count(*) AS tf FROM tok GROUP BY term, doc_id),
st AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"""

_TOP10 = """bm AS (SELECT doc_id FROM (SELECT tf.doc_id, sum(ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * (tf.tf * 2.2)
        / (tf.tf + 1.2 * (0.25 + 0.75 * dl.dl / avgdl))) AS s FROM tf JOIN st USING (term) JOIN dl USING (doc_id) CROSS JOIN fs
        WHERE term IN ('the', 'ment', 'eau') GROUP BY tf.doc_id) ORDER BY s DESC, doc_id LIMIT 10)"""


def _top10(spark, d, idx):
    return scoring.top_hits(scoring.bm25(idx, _Q3), 10).select("doc_id")


@register("c09_interesting_terms_of_page", f"""
WITH {_TOK}, {_TOP10}
SELECT tf.doc_id, term, tf.tf, df, round(tf.tf * (1.0 + ln(n_docs / (df + 1.0))), 9) AS weight,
       row_number() OVER (PARTITION BY tf.doc_id ORDER BY tf.tf * (1.0 + ln(n_docs / (df + 1.0))) DESC, term) AS rank
FROM tf JOIN st USING (term) CROSS JOIN fs WHERE tf.doc_id IN (SELECT doc_id FROM bm) AND tf.tf >= 2 AND df >= 5
QUALIFY rank <= 25
""")
def c09(spark, d):
    idx = _index(spark, d)
    it = cp.interesting_terms(idx, _top10(spark, d, idx))
    return it.withColumn("weight", F.round("weight", 9))


@register("c07_c08_more_like_this_for_page", f"""
WITH {_TOK}, {_TOP10},
it AS (SELECT tf.doc_id AS source_id, term, df FROM tf JOIN st USING (term) CROSS JOIN fs
       WHERE tf.doc_id IN (SELECT doc_id FROM bm) AND tf.tf >= 2 AND df >= 5
       QUALIFY row_number() OVER (PARTITION BY tf.doc_id ORDER BY tf.tf * (1.0 + ln(n_docs / (df + 1.0))) DESC, term) <= 25),
h AS (SELECT it.source_id, p.doc_id, sum(sqrt(p.tf) * (1.0 + ln(n_docs / (df + 1.0))) * (1.0 + ln(n_docs / (df + 1.0)))
             / sqrt(dl.dl)) AS score
      FROM it JOIN tf p USING (term) JOIN dl ON dl.doc_id = p.doc_id CROSS JOIN fs WHERE p.doc_id <> it.source_id
      GROUP BY it.source_id, p.doc_id)
SELECT source_id, doc_id, round(score, 6) AS score,
       row_number() OVER (PARTITION BY source_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM h QUALIFY rank <= 5
""")
def c07(spark, d):
    idx = _index(spark, d)
    m = cp.more_like_these(idx, _top10(spark, d, idx), k=5, hot_df=100)
    return m.withColumn("score", F.round("score", 6))


_QWORDS_SQL = r"""qw AS (SELECT conv_id, turn, unnest(x) AS word, generate_subscripts(x, 1) - 1 AS pos FROM (
  SELECT conv_id, turn, regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace(text, '\b\w+:', ' ', 'g'),
         '[\^~][0-9.]*', ' ', 'g'), '\b(AND|OR|NOT)\b', ' ', 'g')), '[\pL\pN]+') AS x FROM conversations WHERE role = 'user'))"""


def _qwords(spark, d):
    c = T(spark, d, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    return cp.query_words(c, "text")


@register("c19_query_words_from_log", f"WITH {_QWORDS_SQL} SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word FROM qw")
def c19(spark, d):
    return _qwords(spark, d)


@register("c10_spell_suggest_from_vocabulary", f"""
WITH {_TOK}, {_QWORDS_SQL},
w AS (SELECT DISTINCT word FROM qw WHERE length(word) >= 4),
wd AS (SELECT w.word, coalesce(st.df, 0) AS word_df FROM w LEFT JOIN st ON st.term = w.word),
chk AS (SELECT * FROM wd WHERE word_df <= 0.01 * (SELECT n_docs FROM fs)),
c AS (SELECT chk.word, st.term, st.df, CAST(levenshtein({_one_byte('chk.word')}, {_one_byte('st.term')}) AS INTEGER) AS edits FROM chk JOIN st
      ON left(st.term, 1) = left(chk.word, 1) AND abs(length(st.term) - length(chk.word)) <= 2 AND st.term <> chk.word),
s AS (SELECT *, 1.0 - edits / greatest(length(word), length(term)) AS score FROM c WHERE edits <= 2)
SELECT word, term AS suggestion, edits, round(score, 9) AS score, df AS freq,
       row_number() OVER (PARTITION BY word ORDER BY score DESC, df DESC, term) AS rank
FROM s WHERE score >= 0.5 QUALIFY rank <= 5
""")
def c10(spark, d):
    idx = _index(spark, d)
    n = idx.field_stats.select("n_docs").first()[0]
    out = cp.spell_suggest(idx.term_stats, _qwords(spark, d), n_docs=n)
    return out.withColumn("score", F.round("score", 9)).withColumn("rank", F.col("rank").cast("long"))


def _gram_sql(c: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({c}) - 2, 1) + 1), lambda i: substr({c}, i, 3)))"


@register("c12_spell_ngram_candidates", f"""
WITH {_TOK}, {_QWORDS_SQL},
w AS (SELECT DISTINCT word, {_gram_sql('word')} AS g FROM qw WHERE word <> ''),
v AS (SELECT term, df, {_gram_sql('term')} AS g FROM st),
c AS (SELECT word, term, df, 1.0 - levenshtein({_one_byte('word')}, {_one_byte('term')}) / greatest(length(word), length(term)) AS score
      FROM w JOIN v ON abs(length(word) - length(term)) <= 0.3 * greatest(length(word), length(term)) + 1e-9
      WHERE word <> term AND list_has_any(w.g, v.g))
SELECT word, term AS suggestion, round(score, 9) AS score, df AS freq, row_number() OVER (PARTITION BY word ORDER BY score DESC, df DESC, term) AS rank
FROM c WHERE score >= 0.7 QUALIFY rank <= 3
""")
def c12(spark, d):
    idx = _index(spark, d)
    words = _qwords(spark, d).select("word").distinct()
    out = cp.spell_ngram(idx.term_stats, words, 3, 3, 0.7)
    return out.withColumn("score", F.round("score", 9)).withColumn("rank", F.col("rank").cast("long"))


@register("c13_word_break_suggestions", f"""
WITH {_TOK}, {_QWORDS_SQL},
w AS (SELECT DISTINCT word FROM qw),
sp AS (SELECT word, substr(word, 1, i) AS l, substr(word, i + 1) AS r FROM (SELECT word, unnest(range(1, length(word))) AS i FROM w))
SELECT sp.word, sp.l AS "left", sp.r AS "right", least(a.df, b.df) AS freq FROM sp JOIN st a ON a.term = sp.l JOIN st b ON b.term = sp.r
""")
def c13(spark, d):
    idx = _index(spark, d)
    return cp.word_break_suggest(idx.term_stats, _qwords(spark, d))


@register("c14_merge_suggestions", f"""
WITH {_TOK}, {_QWORDS_SQL},
w AS (SELECT DISTINCT word, {_gram_sql('word')} AS g FROM qw WHERE word <> ''),
v AS (SELECT term, df, {_gram_sql('term')} AS g FROM st),
c AS (SELECT word, term, df, w.g AS g, v.g AS h, CAST(levenshtein({_one_byte('word')}, {_one_byte('term')}) AS INTEGER) AS edits FROM w JOIN v
      ON abs(length(word) - length(term)) <= greatest(2, 0.4 * greatest(length(word), length(term)) + 1e-9) AND word <> term),
a AS (SELECT word, term, 1.0 - edits / greatest(length(word), length(term)) AS score, df FROM c
      WHERE length(word) >= 4 AND left(term, 1) = left(word, 1) AND edits <= 2 AND 1.0 - edits / greatest(length(word), length(term)) >= 0.5),
b AS (SELECT word, term, 1.0 - edits / greatest(length(word), length(term)) AS score, df FROM c
      WHERE list_has_any(g, h) AND 1.0 - edits / greatest(length(word), length(term)) >= 0.6),
u AS (SELECT word, term, row_number() OVER (PARTITION BY word ORDER BY score DESC, df DESC, term) AS r, 0 AS src FROM a QUALIFY r <= 3
      UNION ALL SELECT word, term, row_number() OVER (PARTITION BY word ORDER BY score DESC, df DESC, term) AS r, 1 FROM b QUALIFY r <= 3),
m AS (SELECT word, term, min(r * 2 + src) AS k FROM u GROUP BY word, term)
SELECT word, term AS suggestion, CAST(row_number() OVER (PARTITION BY word ORDER BY k, term) AS INTEGER) AS rank FROM m
""")
def c14(spark, d):
    idx = _index(spark, d)
    words = _qwords(spark, d).select("word")
    a = cp.spell_suggest(idx.term_stats, words, count=3)
    b = cp.spell_ngram(idx.term_stats, words, 3, 3, 0.6)
    return cp.merge_suggestions([a, b])


@register("c16_prefix_suggester", f"""
WITH {_TOK}
SELECT term, df AS weight, row_number() OVER (ORDER BY df DESC, term) AS rank FROM st WHERE starts_with(term, 'ther')
QUALIFY rank <= 10
""")
def c16(spark, d):
    return cp.suggest_prefix(_index(spark, d).term_stats, "ther", 10)


@register("c17_fuzzy_prefix_suggester", f"""
WITH {_TOK}
SELECT term, df AS weight, row_number() OVER (ORDER BY df DESC, term) AS rank FROM st
WHERE starts_with(term, 't') AND levenshtein(left(term, 4), 'thar') <= 1
QUALIFY rank <= 10
""")
def c17(spark, d):
    return cp.suggest_fuzzy(_index(spark, d).term_stats, "thar", 10, 1, 1)


@register("c02_c06_highlight_gap_fragments")
def c02(spark, d):
    idx = _index(spark, d)
    hits = _top10(spark, d, idx)
    return cp.highlight(hits, _docs(spark, d), "doc_id", "text", _Q3, fragsize=100, snippets=2)


@register("c05_passage_highlight", f"""
WITH {_TOK}, {_TOP10},
s AS (SELECT doc_id, unnest(x) AS sentence, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS sent_no FROM (
  SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1) || '|\\n+') AS x
  FROM documents WHERE doc_id IN (SELECT doc_id FROM bm))),
w AS (SELECT doc_id, sent_no, sentence, unnest(regexp_extract_all(lower(sentence), '[\\pL\\pN]+')) AS term FROM s),
c AS (SELECT doc_id, sent_no, sentence, term, count(*) AS tf FROM w WHERE term IN ('the', 'ment', 'eau') GROUP BY ALL)
SELECT doc_id, sent_no, sentence, round(sum(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length(sentence) / 87))), 6) AS score FROM c GROUP BY doc_id, sent_no, sentence
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sum(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length(sentence) / 87))) DESC, sent_no) <= 2
""")
def c05(spark, d):
    idx = _index(spark, d)
    out = cp.highlight_passages(_top10(spark, d, idx), _docs(spark, d), "doc_id", "text", _Q3, snippets=2)
    return out.withColumn("score", F.round("score", 6))


# ------------------------------------------------------------------ sources and sinks

@register("s03_s11_csv_roundtrip_multivalues", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CASE p_type WHEN 'SMALL' THEN 'S' ELSE p_type END AS p_type, CAST(p_size AS VARCHAR) AS p_size,
       CAST(p_retailprice AS VARCHAR) AS p_retailprice, string_split(p_name, ' ') AS words, 'csv' AS source FROM part
""")
def s03(spark, d):
    from searchlake.sources import writers as w
    path = scratch_dir(spark, "csv")
    p = T(spark, d, "part").withColumn("words", F.split("p_name", " "))
    w.write_csv(p, path, mv_sep="|")
    return w.read_csv_docs(spark, path, split={"words": r"\|"}, value_map={"p_type": {"SMALL": "S"}},
                           literals={"source": "csv"}, trim=True)


@register("s07_s12_json_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate, o_orderpriority FROM orders
""")
def s07(spark, d):
    from searchlake.sources import writers as w
    path = scratch_dir(spark, "json")
    w.write_json(T(spark, d, "orders"), path)
    return w.read_json_docs(spark, path, multi_line=False)


@register("s08_s13_xml_roundtrip")
def s08(spark, d):
    from searchlake.sources import writers as w
    path = scratch_dir(spark, "xml")
    w.write_xml(T(spark, d, "customer"), path)
    return spark.read.format("xml").option("rowTag", "doc").load(path)


@register("s09_external_score_file")
def s09(spark, d):
    from searchlake.sources import writers as w
    path = scratch_dir(spark, "scores")
    T(spark, d, "supplier").select(F.concat_ws("=", F.col("s_suppkey").cast("string"),
                                               (F.col("s_acctbal") / 1000).cast("string"))).write.text(path)
    return w.read_score_file(spark, path)


@register("s14_search_log_rows")
def s14(spark, d):
    from searchlake.sources import writers as w
    c = T(spark, d, "conversations").filter(F.col("role") == "user")
    req = c.select(F.concat_ws(".", F.lit("10"), F.lit("1"), (F.col("conv_id") % 256).cast("string"), F.lit("7"))
                   .alias("user_ip"), F.concat(F.lit("user"), (F.col("conv_id") % 17).cast("string")).alias("user_name"),
                   F.col("text").alias("query_full"), F.col("text").alias("q"), F.lit("").alias("fq"),
                   F.lit(10).alias("rows"), (F.length("text") % 25).alias("hits"), (F.col("turn") % 2 == 0).alias("facet"))
    return w.search_log_rows(req)


@register("s16_split_by_hash_shards")
def s16(spark, d):
    from searchlake.sources import writers as w
    path = scratch_dir(spark, "shards")
    w.split_by_hash(T(spark, d, "orders"), "o_orderkey", 4, path)
    return spark.read.parquet(path).groupBy("shard").agg(F.count(F.lit(1)).alias("docs"))


@register("a29_search_log_report", """
WITH log AS (SELECT 'user' || CAST(conv_id % 17 AS VARCHAR) AS user_name, text AS query_q,
                    CAST(least(10, length(text) % 25) AS INTEGER) AS result_cnt, turn % 2 = 0 AS facet FROM conversations WHERE role = 'user')
SELECT 'top_query' AS report, query_q AS key, count(*) AS n FROM log GROUP BY query_q
UNION ALL SELECT 'zero_hits', query_q, count(*) FROM log WHERE result_cnt = 0 GROUP BY query_q
UNION ALL SELECT 'facet_use', CASE WHEN facet THEN 'Y' ELSE 'N' END, count(*) FROM log GROUP BY 2
UNION ALL SELECT 'per_user', user_name, count(*) FROM log GROUP BY user_name
""")
def a29(spark, d):
    from searchlake.operators.searchlog import search_log_report
    c = T(spark, d, "conversations").filter(F.col("role") == "user")
    log = c.select(F.concat(F.lit("user"), (F.col("conv_id") % 17).cast("string")).alias("user_name"),
                   F.col("text").alias("query_q"),
                   F.least(F.lit(10), F.length("text") % 25).cast("int").alias("result_cnt"),
                   F.when(F.col("turn") % 2 == 0, "Y").otherwise("N").alias("facet_yn"))
    return search_log_report(log)


# ------------------------------------------------------------------ streaming (Q01–Q04)

def _events_stream(spark, d):
    schema = T(spark, d, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/events*.parquet")


@register("q01_stream_upsert_events", """
SELECT event_id, ts, user_id, upper(event_type) AS event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
""")
def q01(spark, d):
    from searchlake.streaming.ingest import stream_upsert
    base = scratch_dir(spark, "stream-upsert")
    s = _events_stream(spark, d).withColumn("event_type", F.upper("event_type"))
    q, current = stream_upsert(s, f"{base}/table", "user_id", f"{base}/ckpt", order="ts")
    q.awaitTermination()
    return current()


@register("q02_stream_dedupe_within_watermark")
def q02(spark, d):
    from searchlake.streaming.ingest import stream_dedupe
    base = scratch_dir(spark, "stream-dedupe")
    s = _events_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp")) \
        .withColumn("sig", F.md5(F.concat_ws("|", "user_id", "event_type")))
    out = stream_dedupe(s, "sig", "ts", "1 day")
    q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("q03_stream_versioned_updates", """
WITH e AS (SELECT user_id, CASE WHEN event_type = 'error' THEN -event_id ELSE event_id END AS version, event_type FROM events WHERE event_id > 0),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY abs(version) DESC) = 1)
SELECT user_id, version, event_type FROM l WHERE version > 0
""")
def q03(spark, d):
    from searchlake.streaming.ingest import live_rows, stream_versioned
    base = scratch_dir(spark, "stream-versioned")
    version = F.when(F.col("event_type") == "error", -F.col("event_id")).otherwise(F.col("event_id"))  # errors delete
    s = _events_stream(spark, d).filter("event_id > 0").select(F.col("user_id"), version.alias("version"), "event_type")
    q, current = stream_versioned(s, f"{base}/table", "user_id", "version", f"{base}/ckpt")
    q.awaitTermination()
    return live_rows(current(), "version")


@register("q04_stream_rolling_latency", """
SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS requests, round(avg(value), 6) AS mean
FROM events GROUP BY 1, 2
""")
def q04(spark, d):
    from searchlake.streaming.ingest import stream_latency
    base = scratch_dir(spark, "stream-latency")
    s = _events_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = stream_latency(s, "ts", "value", "1 hour", "1 hour", "event_type")
    # complete mode: every window so far, open ones too, replaces the report
    q = out.writeStream.outputMode("complete").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True) \
        .foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{base}/out")).start()
    q.awaitTermination()
    report = spark.read.parquet(f"{base}/out")
    return report.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "requests",
                         F.round("mean", 6).alias("mean"))


# ------------------------------------------------------------------ token-table steps

SYNONYM_RULES = ["der, die, das => the", "le, la, les", "eau => water, eau"]


@register("t33_t29_synonym_expansion_counts", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
u AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t),
r AS (SELECT * FROM (VALUES ('der', 'the'), ('die', 'the'), ('das', 'the'), ('le', 'le'), ('le', 'la'), ('le', 'les'),
      ('la', 'le'), ('la', 'la'), ('la', 'les'), ('les', 'le'), ('les', 'la'), ('les', 'les'), ('eau', 'water'),
      ('eau', 'eau')) v(f, t)),
e AS (SELECT DISTINCT u.doc_id, u.pos, coalesce(r.t, u.term) AS term FROM u LEFT JOIN r ON r.f = u.term)
SELECT term, count(*) AS count FROM e GROUP BY term
""")
def t33(spark, d):
    toks = an.token_table(_docs(spark, d), "doc_id", "text", with_length=False)
    rules = spark.createDataFrame(an.parse_synonym_rules(SYNONYM_RULES), "from string, to string")
    out = an.remove_duplicate_tokens(an.apply_synonyms(toks, rules))
    return out.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


@register("t35_dictionary_decompounding_german", """
WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents WHERE lang = 'de'),
dict AS (SELECT term FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term, doc_id FROM documents WHERE lang = 'de')
         GROUP BY term HAVING count(DISTINCT doc_id) >= 20 AND length(term) >= 3),
s AS (SELECT term, st, ln, substr(term, st, ln) AS part FROM v, range(1, 40) a(st), range(3, 16) b(ln)
      WHERE length(term) >= 8 AND st + ln - 1 <= length(term))
SELECT term, CAST(st - 1 AS INTEGER) AS start, part FROM s WHERE part <> term AND part IN (SELECT term FROM dict)
""")
def t35(spark, d):
    """German compounds: documents with ``lang = 'de'`` only, as part of the feature. There is no given dictionary, so the terms of
    3 or more characters in 20 or more German documents are it; words of 8 or more characters are cut, parts have 3 to 15."""
    docs = _docs(spark, d).filter(F.col("lang") == "de")
    toks = an.token_table(docs, "doc_id", "text", with_length=False)
    dictionary = toks.groupBy("term").agg(F.count_distinct("doc_id").alias("n")) \
        .filter((F.col("n") >= 20) & (F.length("term") >= 3)).select("term")
    return an.decompound(toks.select("term"), dictionary, min_word=8, min_sub=3, max_sub=15)


@register("t25_reversed_wildcard_leading_match", """
WITH v AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents)
SELECT DISTINCT doc_id FROM v WHERE starts_with(reverse(term), reverse('tion'))
""")
def t25(spark, d):
    toks = an.token_table(_docs(spark, d), "doc_id", "text", with_length=False)
    both = an.reversed_wildcard_terms(toks)
    # leading wildcard "*tion" becomes a prefix query on the reversed, marked form
    return both.filter(F.col("term").startswith("\u0001" + "tion"[::-1])).select("doc_id").distinct()


@register("t30_stemmer_override_and_keywords", """
WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents WHERE lang = 'en')
SELECT term, CASE WHEN term IN ('ores', 'was') THEN term WHEN term = 'shes' THEN 'she'
  WHEN length(term) < 3 OR right(term, 1) <> 's' THEN term
  WHEN substr(term, length(term) - 1, 1) IN ('u', 's') THEN term
  WHEN substr(term, length(term) - 1, 1) = 'e' AND length(term) > 3 AND substr(term, length(term) - 2, 1) = 'i'
       AND substr(term, length(term) - 3, 1) NOT IN ('a', 'e') THEN substr(term, 1, length(term) - 3) || 'y'
  WHEN substr(term, length(term) - 1, 1) = 'e' AND substr(term, length(term) - 2, 1) IN ('i', 'a', 'o', 'e') THEN term
  ELSE substr(term, 1, length(term) - 1) END AS term_stem FROM v
""")
def t30(spark, d):
    """English stems with protected words and overrides: an English feature, so documents with ``lang = 'en'`` only."""
    docs = _docs(spark, d).filter(F.col("lang") == "en")
    vocab = an.token_table(docs, "doc_id", "text", with_length=False).select("term").distinct()
    protected = spark.createDataFrame([("ores",), ("was",)], "term string")
    overrides = spark.createDataFrame([("shes", "she")], "term string, stem string")
    stemmed = an.stem_with_override(vocab.withColumn("orig", F.col("term")), an.english_minimal_stem,
                                    protected, overrides)
    return stemmed.select(F.col("orig").alias("term"), F.col("term").alias("term_stem"))


@register("t32_common_grams_index_mode", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
g AS (SELECT unnest(list_transform(range(1, len(x)), lambda i: CASE WHEN x[i] IN ('the', 'of', 'and') OR x[i + 1] IN ('the', 'of', 'and')
                                                               THEN x[i] || '_' || x[i + 1] END)) AS gram FROM t)
SELECT gram, count(*) AS count FROM g WHERE gram IS NOT NULL GROUP BY gram
""")
def t32(spark, d):
    toks = _docs(spark, d).select(F.regexp_extract_all(F.lower("text"), F.lit("[\\pL\\pN]+"), 0).alias("toks"))
    grams = toks.select(F.explode(F.flatten(an.common_grams(["the", "of", "and"])(F.col("toks")))).alias("gram"))
    return grams.filter(F.col("gram").contains("_")).groupBy("gram").agg(F.count(F.lit(1)).alias("count"))


@register("t28_word_delimiter_parts")
def t28(spark, d):
    p = T(spark, d, "part").select("p_partkey", F.array("p_brand").alias("toks"))
    wd = an.word_delimiter(catenate_all=True, preserve_original=True)
    return p.select("p_partkey", F.flatten(wd(F.col("toks"))).alias("parts"))


@register("t48_analysis_report_per_step", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
u AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos FROM t),
s AS (SELECT 0 AS step, 'tokenizer' AS step_name, * FROM u
      UNION ALL SELECT 1, 'stop', * FROM u WHERE term NOT IN ({_STOP_SQL})
      UNION ALL SELECT 2, 'length', * FROM u WHERE term NOT IN ({_STOP_SQL}) AND length(term) BETWEEN 3 AND 12)
SELECT step, step_name, count(*) AS n_tokens, count(*) FILTER (WHERE term IN ('eau', 'ment')) AS n_match,
       CAST(sum(pos) AS BIGINT) AS pos_sum FROM s GROUP BY step, step_name
""")
def t48(spark, d):
    rep = an.analysis_report(_docs(spark, d), "doc_id", "text", an.pattern_tokenizer(),
                             [("stop", an.stop_filter()), ("length", an.length_filter(3, 12))], ["eau", "ment"])
    return rep.groupBy("step", "step_name").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_if("match").alias("n_match"),
                                                F.sum("pos").cast("long").alias("pos_sum"))


@register("t39_f34_delimited_payload_scoring")
def t39(spark, d):
    docs = _docs(spark, d)
    # payload-tagged text derived from the documents: each token carries (position mod 3) + 1
    toks = an.token_table(docs, "doc_id", "text", with_length=False)
    tagged = toks.withColumn("term", F.concat("term", F.lit("|"), ((F.col("pos") % 3) + 1).cast("string")))
    pl = an.delimited_payloads(tagged)
    idx = _index(spark, d)
    s = scoring.payload_score(idx, pl, _Q3, "avg")
    return scoring.top_hits(s, 10).withColumn("score", F.round("score", 6))
