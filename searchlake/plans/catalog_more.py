"""Entries for composite queries (F19–F28, F38–F39, X17, X18), further analysis steps (T*), sources (S*) and plug-in points (V*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.operators import analysis as an
from searchlake.operators import components as cp
from searchlake.operators import dismax as dm
from searchlake.operators import filters as flt
from searchlake.operators import ingest as ing
from searchlake.operators import scoring
from searchlake.operators import textmatch as tm
from searchlake.plans.catalog_misc import _QWORDS_SQL, _qwords
from searchlake.plans.catalog_text import _SCORED, _TOK, _index
from searchlake.plans.registry import register
from searchlake.session import scratch_dir
from searchlake.session import table as T

_BM25 = ("ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * (tf * (1.2 + 1)) / (tf + 1.2 * ((1 - 0.75) + 0.75 * dl / avgdl))")


def _docs(spark, d):
    return T(spark, d, "documents")


def _round(df):
    return df.withColumn("score", F.round("score", 6))


def _phrase(name: str, *words: str) -> str:
    """CTEs: ``<name>(doc_id, score)``, BM25 of an exact phrase with the summed idf of its words."""
    joins = "".join(f" JOIN tok t{i} ON t{i}.doc_id = t0.doc_id AND t{i}.pos = t0.pos + {i} AND t{i}.term = '{w}'"
                    for i, w in enumerate(words) if i)
    idfs = " + ".join(f"(SELECT ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) FROM st CROSS JOIN fs WHERE term = '{w}')" for w in words)
    return (f"{name}_f AS (SELECT t0.doc_id, CAST(count(*) AS DOUBLE) AS tf FROM tok t0{joins} WHERE t0.term = '{words[0]}' GROUP BY t0.doc_id),\n"
            f"{name} AS (SELECT doc_id, ({idfs}) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS score\n"
            f"  FROM {name}_f JOIN dl USING (doc_id) CROSS JOIN fs)")


def _words(*words: str) -> str:
    return _SCORED.format(terms=", ".join(f"'{w}'" for w in words)) + f",\nw AS (SELECT doc_id, term, {_BM25} AS score FROM j)"


# ------------------------------------------------------------------ composite queries

@register("f20_field_query_phrase", f"""
WITH {_TOK}, {_phrase('p', 'of', 'the')}
SELECT doc_id, round(score, 6) AS score FROM p
""")
def f20(spark, d):
    return _round(dm.field_query(_index(spark, d), "Of the"))


@register("f20_field_query_term", f"WITH {_TOK}, {_words('eau')} SELECT doc_id, round(score, 6) AS score FROM w")
def f20b(spark, d):
    return _round(dm.field_query(_index(spark, d), "EAU!"))


@register("f21_constant_score", f"WITH {_TOK} SELECT DISTINCT doc_id, 2.5 AS score FROM tok WHERE term = 'eau'")
def f21(spark, d):
    return scoring.constant_score(tm.match_term(_index(spark, d), "eau"), 2.5)


@register("f23_function_score", "SELECT doc_id, round(ln(1.0 + n_chars), 6) AS score FROM documents")
def f23(spark, d):
    return _round(dm.function_hits(_docs(spark, d), "doc_id", F.ln(1 + F.col("n_chars"))))


@register("x17_query_score_or_default", f"""
WITH {_TOK}, {_words('eau')}
SELECT doc_id, round(coalesce(w.score, 0.25), 6) AS value FROM documents LEFT JOIN w USING (doc_id)
""")
def x17(spark, d):
    out = dm.query_value(_docs(spark, d).select("doc_id"), "doc_id", tm.match_term(_index(spark, d), "eau"), 0.25)
    return out.withColumn("value", F.round("value", 6))


@register("x18_f24_boosted_query", f"""
WITH {_TOK}, {_words('eau')}
SELECT doc_id, round(w.score * sqrt(n_chars), 6) AS score FROM w JOIN documents USING (doc_id)
""")
def x18(spark, d):
    return _round(dm.boosted_query(tm.match_term(_index(spark, d), "eau"), _docs(spark, d), "doc_id", F.sqrt("n_chars")))


@register("f24_multiplicative_boost", f"WITH {_TOK}, {_words('eau')} SELECT doc_id, round(score * (1 + doc_id % 3), 6) AS score FROM w")
def f24(spark, d):
    return _round(scoring.boost(tm.match_term(_index(spark, d), "eau"), 1 + F.col("doc_id") % 3))


@register("f26_maxscore", f"""
WITH {_TOK}, {_words('the', 'of', 'in')},
g AS (SELECT doc_id, max(score) FILTER (term = 'the') AS must, max(score) FILTER (term <> 'the') AS mx, sum(score) FILTER (term <> 'the') AS sm
      FROM w GROUP BY doc_id)
SELECT doc_id, round(must + coalesce(mx + 0.3 * (sm - mx), 0), 6) AS score FROM g WHERE must IS NOT NULL
""")
def f26(spark, d):
    idx = _index(spark, d)
    hits = {w: tm.match_term(idx, w) for w in ("the", "of", "in")}
    return _round(tm.maxscore_hits(must=[hits["the"]], should=[hits["of"], hits["in"]], tie=0.3))


@register("f27_dismax_min_should_match", f"""
WITH {_TOK}, {_words('the', 'of', 'in')}, {_phrase('p', 'the', 'of', 'in')},
m AS (SELECT doc_id, sum(2.0 * score) AS score FROM w GROUP BY doc_id HAVING count(*) >= 2)
SELECT doc_id, round(m.score + coalesce(1.5 * p.score, 0), 6) AS score FROM m LEFT JOIN p USING (doc_id)
""")
def f27(spark, d):
    return _round(tm.dismax_search({"text": _index(spark, d)}, ["the", "of", "in"], {"text": 2.0}, mm="2", pf={"text": 1.5}))


@register("f28_edismax_shingled_phrases", f"""
WITH {_TOK}, {_words('the', 'of', 'in', 'eau')}, {_phrase('p1', 'the', 'of')}, {_phrase('p2', 'of', 'in')}, {_phrase('p3', 'the', 'of', 'in')},
m AS (SELECT doc_id, sum(score) AS score FROM w GROUP BY doc_id
      HAVING count(*) FILTER (term = 'the') = 1 AND count(*) FILTER (term = 'eau') = 0 AND count(*) FILTER (term IN ('of', 'in')) >= 1)
SELECT doc_id, round((m.score + coalesce(2 * p1.score, 0) + coalesce(2 * p2.score, 0) + coalesce(3 * p3.score, 0) + ln(1.0 + n_chars)) *
                     (CASE WHEN lang = 'en' THEN 1.5 ELSE 1.0 END), 6) AS score
FROM m JOIN documents USING (doc_id) LEFT JOIN p1 USING (doc_id) LEFT JOIN p2 USING (doc_id) LEFT JOIN p3 USING (doc_id)
""")
def f28(spark, d):
    docs = _docs(spark, d)
    english = docs.filter("lang = 'en'").select("doc_id", F.lit(1.5).alias("score"))
    return _round(dm.edismax({"text": _index(spark, d)}, ["the", "of", "in"], {"body": 1.0}, mm="50%", must=["the"], must_not=["eau"],
                             pf2={"text": 2.0}, pf3={"text": 3.0}, bf=[dm.function_hits(docs, "doc_id", F.ln(1 + F.col("n_chars")))],
                             boost=english, uf=["text"], aliases={"body": {"text": 1.0, "title": 2.0}}))


@register("f19_ngram_phrase", """
WITH g AS (SELECT doc_id, unnest(range(1, len(text) + 1)) AS i, lower(text) AS t FROM documents),
h AS (SELECT doc_id FROM g WHERE substr(t, i, 6) = 'therin')
SELECT doc_id, count(*) AS freq FROM h GROUP BY doc_id
""")
def f19(spark, d):
    from searchlake.operators import index as ix
    chain = an.Analyzer(an.ngram_tokenizer(2, 2), [an.lowercase()])
    idx = ix.build_index(_docs(spark, d), "doc_id", "text", chain)
    return dm.ngram_phrase_freq(idx, ["th", "he", "er", "ri", "in"], 2)


@register("f38_geohash_cells", """
SELECT user_id, cell FROM (SELECT user_id, event_id, substr('u33d9qjb', 1, CAST(1 + event_id % 8 AS INTEGER)) AS cell FROM events)
WHERE starts_with(cell, 'u33d') OR starts_with(cell, 'u33d9q')
""")
def f38(spark, d):
    cell = F.substring(F.lit("u33d9qjb"), F.lit(1), (1 + F.col("event_id") % 8).cast("int"))
    e = T(spark, d, "events").select("user_id", cell.alias("cell"))
    return e.filter(flt.geohash_filter("cell", ["u33d", "u33d9q"]))


_RATES = [("USD", "EUR", 0.9), ("GBP", "USD", 1.25)]


@register("f39_s10_currency_range", """
WITH o AS (SELECT o_orderkey, o_totalprice, CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS code FROM orders),
c AS (SELECT *, CASE code WHEN 'USD' THEN o_totalprice WHEN 'EUR' THEN o_totalprice * (1.0 / 0.9) WHEN 'GBP' THEN o_totalprice * 1.25 END AS usd FROM o)
SELECT o_orderkey, o_totalprice, code FROM c WHERE usd BETWEEN 1000 AND 90000
""")
def f39(spark, d):
    from searchlake.functions.scalar import currency_range
    from searchlake.sources.writers import read_rates
    path = scratch_dir(spark, "rates")
    spark.createDataFrame(_RATES, "from string, to string, rate double").write.json(path)
    code = F.element_at(F.array(*map(F.lit, ("USD", "EUR", "GBP", "JPY"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice", code.alias("code"))
    return currency_range(o, "o_totalprice", "code", read_rates(spark, path), "USD", 1000.0, 90000.0)


@register("b03_sweet_spot_tfidf", f"""
WITH {_TOK}, {_SCORED.format(terms="'the', 'eau'")},
s AS (SELECT doc_id, sum(sqrt(tf) * pow(1.0 + ln(n_docs / (df + 1)), 2) / sqrt(0.5 * (abs(dl - 50) + abs(dl - 200) - 150) + 1.0)) AS score
      FROM j GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score FROM s
""")
def b03(spark, d):
    return _round(scoring.score_terms(_index(spark, d), ["the", "eau"], "sweet_spot", lo=50, hi=200))


# ------------------------------------------------------------------ analysis steps

def _tokens(spark, d, analyzer):
    return _docs(spark, d).select("doc_id", F.explode(analyzer.array(F.col("text"))).alias("term")).filter("term is not null")


def _counts(df):
    return df.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


_SPACED = "list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')"


def _term_counts(expr: str, where: str = "") -> str:
    return f"WITH t AS (SELECT unnest({expr}) AS term FROM documents) SELECT term, count(*) AS count FROM t WHERE term IS NOT NULL {where} GROUP BY term"


@register("t08_pattern_tokenizer_group", _term_counts("regexp_extract_all(text, '(\\pL+)[.,]', 1)"))
def t08(spark, d):
    return _counts(_tokens(spark, d, an.Analyzer(an.pattern_tokenizer(r"(\pL+)[.,]", 1, lower=False))))


@register("t13_turkish_lowercase", _term_counts(f"list_transform({_SPACED}, lambda x: lower(replace(replace(x, 'İ', 'i'), 'I', 'ı')))"))
def t13(spark, d):
    return _counts(_tokens(spark, d, an.Analyzer(an.split_tokenizer(), [an.turkish_lowercase()])))


@register("t16_type_filter_numbers", _term_counts(
    f"list_filter({_SPACED}, lambda x: regexp_full_match(x, '\\p{{Nd}}[\\p{{Nd}}.,\\-/]*') AND NOT regexp_full_match(x, '[0-9]+([.][0-9]+)+'))"))
def t16(spark, d):
    out = _tokens(spark, d, an.Analyzer(an.split_tokenizer(), [an.type_filter(["<NUM>"])]))
    return _counts(out.filter(~F.col("term").rlike(r"^[0-9]+([.][0-9]+)+$")))


@register("t20_mapping_char_filter", _term_counts(
    "regexp_split_to_array(trim(regexp_replace(replace(replace(replace(replace(text, 'ae', '\u0001'), 'ß', 'ss'), 'é', 'e'), '\u0001', 'ä'), "
    "'\\s+', ' ', 'g')), ' ')", "AND term <> ''"))
def t20(spark, d):
    rules = {"ae": "ä", "ß": "ss", "é": "e"}
    return _counts(_tokens(spark, d, an.Analyzer(an.split_tokenizer(), char_filters=[an.mapping_char_filter(rules)])))


@register("t21_pattern_replace_char_filter", _term_counts(
    "list_filter(regexp_split_to_array(regexp_replace(text, '([a-z])[.]', '\\1 ', 'g'), '\\s+'), lambda x: x <> '')"))
def t21(spark, d):
    chain = an.Analyzer(an.split_tokenizer(), char_filters=[an.pattern_replace_char_filter("([a-z])[.]", "$1 ")])
    return _counts(_tokens(spark, d, chain))


@register("t22_pattern_capture_groups", _term_counts(
    f"flatten(list_transform({_SPACED}, lambda x: list_distinct(list_concat([x], list_filter(list_concat("
    "regexp_extract_all(x, '(\\d+)-(\\w+)', 1), regexp_extract_all(x, '(\\d+)-(\\w+)', 2)), lambda y: y <> '')))))"))
def t22(spark, d):
    toks = _docs(spark, d).select(an.split_tokenizer()(F.col("text")).alias("a"))
    grams = an.pattern_capture([r"(\d+)-(\w+)"], 2)(F.col("a"))
    return _counts(toks.select(F.explode(F.flatten(grams)).alias("term")))


@register("t26_capitalization", _term_counts(f"list_transform({_SPACED}, lambda x: CASE WHEN left(x, 1) = 'ß' THEN 'Ss' || lower(substr(x, 2)) ELSE upper(left(x, 1)) || lower(substr(x, 2)) END)"))
def t26(spark, d):
    return _counts(_tokens(spark, d, an.Analyzer(an.split_tokenizer(), [an.capitalization()])))


@register("t27_hyphenated_words", """
WITH h AS (SELECT p_partkey, p_name || '- ' || p_brand || '-' AS text FROM part),
t AS (SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\\S)-\\s+(\\S)', '\\1\\2', 'g'), '\\s+')) AS term FROM h)
SELECT term, count(*) AS count FROM t GROUP BY term
""")
def t27(spark, d):
    p = T(spark, d, "part").select(F.concat("p_name", F.lit("- "), "p_brand", F.lit("-")).alias("text"))
    return _counts(p.select(F.explode(an.split_tokenizer()(an.hyphenated_words(F.col("text")))).alias("term")))


@register("t37_german_normalization", """
WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\pL]+')) AS w FROM documents WHERE lang = 'de'),
a AS (SELECT w, regexp_replace(w, '([ao])e', '\\1', 'g') AS x FROM t),
b AS (SELECT w, regexp_replace(x, '(^|[^aeiouyqäöü])ue', '\\1u', 'g') AS x FROM a)
SELECT w AS term, replace(translate(x, 'äöü', 'aou'), 'ß', 'ss') AS normal FROM b
""")
def t37(spark, d):
    """German normalization: documents with ``lang = 'de'`` only, as part of the feature."""
    words = _docs(spark, d).filter("lang = 'de'").select(F.explode(an.letter_tokenizer(lower=True)(F.col("text"))).alias("term")).distinct()
    return words.select("term", F.element_at(an.german_normalization()(F.array("term")), 1).alias("normal"))


@register("t46_position_reset", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents)
SELECT doc_id, 0 AS pos, CAST(len(x) AS BIGINT) AS tokens FROM t WHERE len(x) > 0
""")
def t46(spark, d):
    out = an.position_filter(an.token_table(_docs(spark, d), "doc_id", "text", with_length=False))
    return out.groupBy("doc_id", "pos").agg(F.count(F.lit(1)).alias("tokens"))


@register("t45_token_sink_by_position", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM documents),
u AS (SELECT doc_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos, unnest(x) AS term FROM t)
SELECT doc_id, pos, term FROM u WHERE pos BETWEEN 0 AND 3
""")
def t45(spark, d):
    toks = an.token_table(_docs(spark, d), "doc_id", "text", with_length=False)
    return an.token_sink(toks, pos_range=(0, 4)).select("doc_id", "pos", "term")


# ------------------------------------------------------------------ components, sources, plug-ins

@register("c13_word_breaks_whole", f"""
WITH {_TOK}, {_QWORDS_SQL},
w AS (SELECT term AS word FROM st UNION SELECT word FROM qw),
c AS (SELECT word, unnest(range(1, length(word))) AS i FROM w),
a AS (SELECT word, term AS p1, df AS d1, substr(word, i + 1) AS rest FROM c JOIN st ON st.term = substr(word, 1, i)),
e AS (SELECT word, p1, d1, rest, unnest(range(1, length(rest))) AS i FROM a)
SELECT word, [p1, rest] AS parts, 1 AS changes, least(d1, st.df) AS freq FROM a JOIN st ON st.term = rest
UNION ALL
SELECT word, [p1, m.term, r.term], 2, least(d1, m.df, r.df) FROM e JOIN st m ON m.term = substr(rest, 1, i) JOIN st r ON r.term = substr(rest, i + 1)
""")
def c13_whole(spark, d):
    """Every word of the documents (all languages and lengths) and of the users' queries, cut once or twice into terms of the
    whole vocabulary; ``min_break_length`` and ``min_suggestion_freq`` are 1. The vocabulary is written once and read by every turn."""
    path = scratch_dir(spark, "c13-vocabulary")
    an.document_frequencies(_docs(spark, d), "text").write.parquet(path)
    vocab = spark.read.parquet(path)
    words = vocab.select(F.col("term").alias("word")).unionByName(_qwords(spark, d).select("word")).distinct()
    return cp.word_breaks(vocab, words, max_changes=2)


@register("c15_collate_queries")
def c15(spark, d):
    idx = _index(spark, d)
    words = spark.createDataFrame([("thee",), ("onrr",)], "word string")
    s = cp.spell_suggest(idx.term_stats, words, count=3)
    return cp.collate(s, ["thee", "onrr"], per_word=3, max_collations=5, hits_index=idx)


@register("p01_select_fields", "SELECT l_shipdate, l_returnflag, l_linestatus FROM lineitem")
def p01(spark, d):
    from pyspark.sql.types import StringType
    li = T(spark, d, "lineitem")
    return li.select(*ing.select_fields(li, ["l_shipdate"], types=[StringType]))


@register("s04_s05_csv_split_and_map", """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE p_brand WHEN 'Brand#1' THEN 'one' ELSE p_brand END AS brand, string_split(p_name, ' ') AS words, 'csv' AS origin
FROM part
""")
def s04(spark, d):
    from searchlake.sources import writers as w
    path = scratch_dir(spark, "csv-split")
    T(spark, d, "part").select("p_partkey", "p_brand", "p_name").write.csv(path)
    return w.read_csv_docs(spark, path, fieldnames=["id", "brand", "words"], split={"words": " "},
                           value_map={"brand": {"Brand#1": "one"}}, literals={"origin": "csv"})


@register("s15_merge_collections", "SELECT n_name AS name, n_nationkey AS key FROM nation UNION ALL SELECT r_name, NULL FROM region")
def s15(spark, d):
    from searchlake.sources.readers import merge_tables
    n = T(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"))
    return merge_tables([n, T(spark, d, "region").select(F.col("r_name").alias("name"))])


@register("v03_v05_pipeline_and_token_plugins", """
WITH t AS (SELECT unnest(regexp_extract_all(lower(translate(text, '0123456789', '9876543210')), '[\\pL\\pN]+')) AS term FROM documents)
SELECT reverse(term) AS term, count(*) AS count FROM t GROUP BY 1
""")
def v03(spark, d):
    chain = an.Analyzer(an.pattern_tokenizer(), [lambda a: F.transform(a, F.reverse)])
    docs = ing.Pipeline([lambda df: df.withColumn("text", F.translate("text", "0123456789", "9876543210"))])(_docs(spark, d))
    return _counts(docs.select(F.explode(chain.array(F.col("text"))).alias("term")))
