"""Entries for token streams with offsets (T01, T20, A25), fragments (C03, C04, C06), span trees (F29, F31, F32), vocabulary
jobs (T40–T43) and rule tables (T33). All of them read whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.operators import analysis as an
from searchlake.operators import fragments as fr
from searchlake.operators import index as ix
from searchlake.operators import morphology as mo
from searchlake.operators import proximity as px
from searchlake.operators import stemming as stem
from searchlake.operators import streams as st
from searchlake.operators import synonyms as sy
from searchlake.operators.components import _hash_bitmap, _maybe_known
from searchlake.operators.util import dealt, written
from searchlake.plans.catalog_text import _TOK, _index
from searchlake.plans.registry import register
from searchlake.session import table as T


def _docs(spark, d):
    return T(spark, d, "documents")


# Tokens with offsets: a text's tokens and the pieces between them, and running sums of their lengths.
def _stream_sql(source: str = "SELECT doc_id, 0 AS value, text FROM documents", gap: int = 100) -> str:
    return f"""vals AS ({source}),
cut AS (SELECT doc_id, value, regexp_extract_all(coalesce(text, ''), '[\\pL\\pN]+') AS t,
               string_split_regex(coalesce(text, ''), '[\\pL\\pN]+') AS g FROM vals),
pieces AS (SELECT doc_id, value, unnest(g) AS gap, unnest(list_append(t, NULL)) AS tok, generate_subscripts(g, 1) AS i FROM cut),
placed AS (SELECT doc_id, value, tok, length(gap) AS lead_in,
  coalesce(count(tok) OVER w, 0) + value * {gap} AS pos,
  coalesce(sum(length(gap) + CASE WHEN tok IS NULL THEN 1 ELSE length(tok) END) OVER w, 0) AS before FROM pieces
  WINDOW w AS (PARTITION BY doc_id ORDER BY value, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, lower(tok) AS term, CAST(before + lead_in AS INTEGER) AS "start",
             CAST(before + lead_in + length(tok) AS INTEGER) AS "end", CAST(value AS INTEGER) AS value FROM placed WHERE tok IS NOT NULL)"""


_LINES = """SELECT doc_id, value, text FROM (SELECT doc_id, unnest(x) AS text, generate_subscripts(x, 1) - 1 AS value
            FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))"""


# ------------------------------------------------------------------ T01, T20, A25

@register("t01_token_offsets", f"WITH {_stream_sql()} SELECT doc_id, pos, term, \"start\", \"end\" FROM s")
def t01(spark, d):
    """Every token of every document with position and offsets."""
    return st.token_stream(_docs(spark, d), "doc_id", "text").select("doc_id", "pos", "term", "start", "end")


@register("t01_token_surfaces", f"""
WITH {_stream_sql()}
SELECT doc_id, count(*) AS tokens, count(*) AS same FROM s GROUP BY doc_id
""")
def t01_surface(spark, d):
    """Per document the tokens, and those that equal the text between their offsets (all of them)."""
    docs = _docs(spark, d)
    s = st.surface(st.token_stream(docs, "doc_id", "text"), docs, "doc_id", "text")
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("tokens"), F.count_if(F.lower("surface") == F.col("term")).alias("same"))


@register("t01_multivalue_gaps", f"WITH {_stream_sql(_LINES)} SELECT doc_id, pos, term, \"start\", \"end\", value FROM s")
def t01_gaps(spark, d):
    """The lines of every document as values of a multi-valued field."""
    docs = _docs(spark, d).select("doc_id", F.split("text", "\n").alias("lines"))
    return st.token_stream(docs, "doc_id", "lines")


_PARTS = r"[^aeiou]*[aeiou]+"


@register("t01_chain_parts_shift_positions", f"""
WITH {_stream_sql()},
k AS (SELECT doc_id, pos, term, "start", "end" FROM s WHERE length(term) > 3),
p AS (SELECT doc_id, pos, "start", unnest(regexp_extract_all(term, '{_PARTS}')) AS part, generate_subscripts(regexp_extract_all(term, '{_PARTS}'), 1) AS i FROM k),
q AS (SELECT *, sum(CASE WHEN i = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos, "start", i ROWS UNBOUNDED PRECEDING) AS added,
             coalesce(sum(length(part)) OVER (PARTITION BY doc_id, pos ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS skip FROM p)
SELECT doc_id, CAST(pos + added AS INTEGER) AS pos, part AS term, CAST("start" + skip AS INTEGER) AS "start",
       CAST("start" + skip + length(part) AS INTEGER) AS "end" FROM q
""")
def t01_chain(spark, d):
    """A chain with a length filter and a step that cuts tokens into parts: offsets inside the token, later positions moved on."""
    s = st.token_stream(_docs(spark, d), "doc_id", "text").drop("value")
    return st.run_chain(s, [an.length_filter(4, 1000), ("parts", st.regex_parts(_PARTS))])


@register("t31_shingles_with_offsets", f"""
WITH {_stream_sql()},
n AS (SELECT *, lead(term) OVER w AS t2, lead("end") OVER w AS e2 FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, pos, term || ' ' || t2 AS term, "start", e2 AS "end" FROM n WHERE t2 IS NOT NULL
""")
def t31_offsets(spark, d):
    s = st.token_stream(_docs(spark, d), "doc_id", "text").drop("value")
    return st.shingle_stream(s, 2)


# Letters and the letters that stand for them.
_MAP = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "œ": "oe", "é": "e", "è": "e", "ñ": "ny", "'": "", ".": " . "}


@register("t20_offsets_behind_char_filter", f"""
WITH chars AS (SELECT doc_id, unnest(x) AS c, generate_subscripts(x, 1) - 1 AS i FROM (SELECT doc_id, string_split(text, '') AS x FROM documents WHERE text <> '')),
m AS (SELECT doc_id, i, coalesce(map {{{', '.join(f"'{k.replace(chr(39), chr(39) * 2)}': '{v}'" for k, v in _MAP.items())}}}[c], c) AS o FROM chars),
o AS (SELECT doc_id, i, length(o) AS n, sum(length(o)) OVER (PARTITION BY doc_id ORDER BY i) - length(o) AS pl FROM m),
back AS (SELECT doc_id, i, unnest(range(CAST(pl AS BIGINT), CAST(pl + n AS BIGINT))) AS pl FROM o),
ends AS (SELECT doc_id, max(i) + 1 AS i, CAST(sum(n) AS BIGINT) AS pl FROM o GROUP BY doc_id),
pts AS (SELECT * FROM back UNION ALL SELECT doc_id, i, pl FROM ends),
{_stream_sql("SELECT doc_id, 0 AS value, string_agg(o, '' ORDER BY i) AS text FROM m GROUP BY doc_id")}
SELECT s.doc_id, pos, term, CAST(a.i AS INTEGER) AS "start", CAST(z.i AS INTEGER) AS "end" FROM s
JOIN pts a ON a.doc_id = s.doc_id AND a.pl = s."start" JOIN pts z ON z.doc_id = s.doc_id AND z.pl = s."end"
""")
def t20_offsets(spark, d):
    """Tokens of the mapped text with offsets in the text before the mapping."""
    return st.token_stream(_docs(spark, d), "doc_id", "text", rules=_MAP).drop("value")


@register("a25_term_vectors_with_offsets", f"""
WITH {_stream_sql()},
v AS (SELECT doc_id, term, count(*) AS tf, list(pos ORDER BY pos) AS positions, list("start" ORDER BY pos) AS starts, list("end" ORDER BY pos) AS ends
      FROM s GROUP BY doc_id, term),
f AS (SELECT term, count(*) AS df FROM v GROUP BY term)
SELECT doc_id, term, tf, positions, starts, ends, df, round(tf / df, 9) AS tf_idf FROM v JOIN f USING (term)
""")
def a25(spark, d):
    out = st.term_vectors(st.token_stream(_docs(spark, d), "doc_id", "text"))
    return out.withColumn("tf_idf", F.round("tf_idf", 9))


# ------------------------------------------------------------------ C04, C06, C03

_WORDS = ["eau", "ment", "lich"]
_CLAUSES = [fr.clause(w) for w in _WORDS]
_BEFORE = "substr(text, greatest(a - 10, 0) + 1, least(10, a))"
_RUN_A = f"length(regexp_extract({_BEFORE}, '[^.,!? \\t\\n]*$'))"
_RUN_Z = "length(regexp_extract(substr(text, zz + 1, 10), '^[^.,!? \\t\\n]*'))"


def _vector_sql(score: str, extra: str = "") -> str:
    """Fragments of single words (their places never overlap): the fold over a document's places is a recursion."""
    words = ", ".join(f"'{w}'" for w in _WORDS)
    seq = " ".join(f"WHEN '{w}' THEN {i}" for i, w in enumerate(_WORDS))
    return f"""
WITH RECURSIVE {_stream_sql()}{extra},
q AS (SELECT doc_id, list({{'s': "start", 'e': "end", 't': term}} ORDER BY "start") AS l FROM s WHERE term IN ({words}) GROUP BY doc_id),
f AS (SELECT doc_id, 0 AS frag, 0 AS free, 0 AS a, 0 AS z, l AS rest, l AS took FROM q
  UNION ALL
  SELECT doc_id, frag + 1, begin_at + greatest(stop - first, 100), begin_at, begin_at + greatest(stop - first, 100), list_filter(r, lambda x: x.e > stop), took2 FROM (
    SELECT *, greatest(first - greatest(0, (100 - (stop - first)) // 2), free) AS begin_at FROM (
      SELECT *, took2[-1].e AS stop FROM (
        SELECT *, list_filter(r, lambda x: x.e <= lim) AS took2 FROM (
          SELECT *, greatest(r[1].e, greatest(r[1].s - 6, free) + 100) AS lim, r[1].s AS first FROM (
            SELECT *, list_filter(rest, lambda x: x.s >= free) AS r FROM f) WHERE len(r) > 0))))),
n AS (SELECT doc_id, frag, a, z, took, {score} AS score FROM f WHERE frag > 0),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, a) - 1 AS rank FROM n QUALIFY rank < 2),
x AS (SELECT b.*, text, least(z, length(text)) AS zz FROM b JOIN documents USING (doc_id)),
y AS (SELECT *, CASE WHEN {_RUN_A} < length({_BEFORE}) THEN a - {_RUN_A} WHEN a <= 10 THEN 0 ELSE a END AS st,
             CASE WHEN {_RUN_Z} < length(substr(text, zz + 1, 10)) THEN zz + {_RUN_Z} ELSE zz END AS en FROM x)
SELECT doc_id, CAST(rank AS INTEGER) AS frag, round(score, 6) AS score, CAST(st AS INTEGER) AS "start", CAST(en AS INTEGER) AS "end",
       array_to_string(list_transform(took, lambda p, i: substr(text, CASE WHEN i = 1 THEN st ELSE took[i - 1].e END + 1,
           p.s - CASE WHEN i = 1 THEN st ELSE took[i - 1].e END) || '<em>' || substr(text, p.s + 1, p.e - p.s) || '</em>'), '')
       || substr(text, took[-1].e + 1, greatest(en - took[-1].e, 0)) AS snippet
FROM y"""


def _all_hits(spark, d, words=tuple(_WORDS)):
    """Every document with one of the words."""
    return _index(spark, d).terms(list(words)).select("doc_id").distinct()


def _vector(spark, d, clauses=None, **kw):
    out = fr.highlight_vector(_all_hits(spark, d), _docs(spark, d), "doc_id", "text", clauses or _CLAUSES, snippets=2, **kw)
    return out.withColumn("score", F.round("score", 6)).withColumn("frag", F.col("frag").cast("int"))


@register("c04_vector_highlight_simple", _vector_sql("CAST(len(took) AS DOUBLE)"))
def c04(spark, d):
    """Two fragments of every document that has a word of the query; every place counts 1."""
    return _vector(spark, d)


@register("c04_vector_highlight_weighted", _vector_sql(
    "list_sum(list_transform(list_distinct(list_transform(took, lambda p: p.t)), lambda t: idf[t])) * sqrt(len(took))",
    """,
i AS (SELECT map_from_entries(list((term, ln((SELECT count(*) FROM documents) / (df + 1)) + 1))) AS idf
      FROM (SELECT term, count(DISTINCT doc_id) AS df FROM s GROUP BY term))""").replace("FROM f WHERE frag > 0", "FROM f, i WHERE frag > 0"))
def c04_weighted(spark, d):
    """The weighted builder: distinct words' idf, times the root of the number of words."""
    return _vector(spark, d, builder="weighted")


@register("c04_vector_highlight_single", f"""
WITH {_stream_sql()},
q AS (SELECT doc_id, list({{'s': "start", 'e': "end"}} ORDER BY "start") AS took FROM s WHERE term IN ({', '.join(f"'{w}'" for w in _WORDS)}) GROUP BY doc_id)
SELECT doc_id, 0 AS frag, CAST(len(took) AS DOUBLE) AS score, 0 AS "start", CAST(length(text) AS INTEGER) AS "end",
       array_to_string(list_transform(took, lambda p, i: substr(text, CASE WHEN i = 1 THEN 0 ELSE took[i - 1].e END + 1,
           p.s - CASE WHEN i = 1 THEN 0 ELSE took[i - 1].e END) || '<em>' || substr(text, p.s + 1, p.e - p.s) || '</em>'), '')
       || substr(text, took[-1].e + 1) AS snippet
FROM q JOIN documents USING (doc_id)
""")
def c04_single(spark, d):
    """The whole text as one fragment."""
    return _vector(spark, d, builder="single")


@register("c06_phrases_and_wildcards_highlighted")
def c06(spark, d):
    """A phrase, a sloppy phrase and a wildcard in every document with one of their words: only whole clauses are marked, with
    tags by clause, sentences around, HTML escaped. Compared with brute force in the tests."""
    clauses = [fr.clause("of the", 2.0), fr.clause("in the", 1.0, 2), fr.clause("ther*", 0.5)]
    out = fr.highlight_vector(_all_hits(spark, d, ("of", "in", "the")), _docs(spark, d), "doc_id", "text", clauses, snippets=3, scanner="sentence",
                              order="position", pre=("<b>", "<i>", "<u>"), post=("</b>", "</i>", "</u>"), encode=True)
    return out.withColumn("score", F.round("score", 6))


@register("c03_regex_fragments")
def c03(spark, d):
    """The regex fragmenter's best fragment of every document with a word of the query; documents without show their
    source. Compared with brute force in the tests."""
    docs = _docs(spark, d)
    out = fr.highlight_fragments(docs.select("doc_id"), docs, "doc_id", "text", _CLAUSES, 70, alternate_col="source", alternate_length=3, fragmenter="regex")
    return out.withColumn("score", F.round("score", 6))


@register("c02_gap_fragments_merged")
def c02(spark, d):
    """The gap fragmenter's three best fragments of every document with a phrase or a word, neighbouring ones merged, others with their
    language as alternate. Compared with brute force in the tests."""
    docs = _docs(spark, d)
    clauses = [fr.clause("of the", 2.0), fr.clause("eau"), fr.clause("lich")]
    out = fr.highlight_fragments(docs.select("doc_id"), docs, "doc_id", "text", clauses, snippets=3, merge_contiguous=True, alternate_col="lang", encode=True)
    return out.withColumn("score", F.round("score", 6))


# ------------------------------------------------------------------ F29, F31, F32

@register("f29_span_near_scored", f"""
WITH {_TOK}, n AS (SELECT a.doc_id, a.pos AS start, min(b.pos) + 1 AS e FROM tok a JOIN tok b ON a.doc_id = b.doc_id
  WHERE a.term = 'the' AND b.term = 'of' AND b.pos >= a.pos + 1 GROUP BY a.doc_id, a.pos),
m AS (SELECT doc_id, max(start) AS start, e FROM n WHERE e - 1 - (start + 1) <= 4 GROUP BY doc_id, e),
f AS (SELECT doc_id, sum(1.0 / (e - start + 1)) AS tf FROM m GROUP BY doc_id),
i AS (SELECT sum(ln(1.0 + (n_docs - df + 0.5) / (df + 0.5))) AS idf, any_value(avgdl) AS avgdl FROM st CROSS JOIN fs WHERE term IN ('the', 'of'))
SELECT f.doc_id, round(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score FROM f JOIN dl USING (doc_id) CROSS JOIN i
""")
def f29(spark, d):
    """Spans scored: every match adds 1 / (its length + 1) to the frequency."""
    idx = _index(spark, d)
    spans = px.near_spans(px.w(5, "the", "of"), {"text": idx})
    return px.span_scores(spans, idx, ["the", "of"]).withColumn("score", F.round("score", 6))


@register("f32_nested_proximity_tree", f"""
WITH {_TOK},
inner_ AS (SELECT DISTINCT a.doc_id, least(a.pos, b.pos) AS s, greatest(a.pos, b.pos) + 1 AS e FROM tok a JOIN tok b ON a.doc_id = b.doc_id
  WHERE a.term = 'of' AND b.term IN ('in', 'a') AND abs(a.pos - b.pos) BETWEEN 1 AND 3),
fe AS (SELECT doc_id, s, min(e) AS e FROM inner_ GROUP BY doc_id, s),
n AS (SELECT t.doc_id, t.pos AS start, min(fe.s) AS s, arg_min(fe.e, fe.s) AS e FROM tok t JOIN fe ON fe.doc_id = t.doc_id AND fe.s BETWEEN t.pos + 1 AND t.pos + 5
  WHERE t.term LIKE 'the%' GROUP BY t.doc_id, t.pos)
SELECT doc_id, max(start) AS start, e AS "end" FROM n GROUP BY doc_id, e
""")
def f32(spark, d):
    """5w(the*, 3n(of, in or a)): nested distance operators over one scan of the words' postings."""
    tree = px.w(5, "the*", px.n(3, "of", px.one_of("in", "a")))
    return px.near_spans(tree, {"text": _index(spark, d)})


@register("f32_proximity_documents", f"""
WITH {_TOK},
x AS (SELECT DISTINCT a.doc_id FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 3 WHERE a.term = 'the' AND b.term = 'of'),
y AS (SELECT DISTINCT a.doc_id FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND abs(b.pos - a.pos) BETWEEN 1 AND 2 WHERE a.term = 'in' AND b.term = 'a'),
z AS (SELECT DISTINCT doc_id FROM tok WHERE term = 'an')
SELECT doc_id FROM (SELECT doc_id FROM x UNION SELECT doc_id FROM y) WHERE doc_id NOT IN (SELECT doc_id FROM z)
""")
def f32_documents(spark, d):
    """(3w(the, of) or 2n(in, a)) without an."""
    tree = px.Without(px.Some((px.w(3, "the", "of"), px.n(2, "in", "a"))), px.Word("an"))
    return px.near_documents(tree, {"text": _index(spark, d)})


@register("f31_field_masking", f"""
WITH {_TOK}, n AS (SELECT a.doc_id, a.pos AS start, min(b.pos) + 1 AS e FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos > a.pos
  WHERE a.term = 'the' AND left(b.term, 3) = 'one' GROUP BY a.doc_id, a.pos)
SELECT doc_id, max(start) AS start, e AS "end" FROM n WHERE e - start - 2 <= 3 GROUP BY doc_id, e
""")
def f31(spark, d):
    """A word of the text near a word whose first three letters, a second field of the same positions, are given."""
    docs = _docs(spark, d)
    heads = an.Analyzer(an.pattern_tokenizer(), [lambda a: F.transform(a, lambda t: F.left(t, F.lit(3)))])
    indexes = {"text": ix.build_index(docs, "doc_id", "text"), "heads": ix.build_index(docs, "doc_id", "text", heads)}
    tree = px.w(4, "the", px.Masked(px.Word("one", "heads"), "text"))
    return px.near_spans(tree, indexes)


# ------------------------------------------------------------------ T33

_RULES_SQL = f"""{_TOK},
bi AS (SELECT a.term || ' ' || b.term AS k, [a.term, b.term] AS w, count(*) AS n FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 GROUP BY ALL),
tri AS (SELECT [a.term, b.term, c.term] AS w, count(*) AS n FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
        JOIN tok c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2 GROUP BY ALL),
rules AS (SELECT w FROM bi WHERE n BETWEEN 10 AND 60 UNION ALL SELECT w FROM tri WHERE n BETWEEN 5 AND 60)"""


def _phrase_rules(tokens):
    """Frequent word pairs and triples: each is replaced by itself joined by ``_``, and by its first word."""
    here = F.lead("term", 1), F.lead("term", 2)
    from pyspark.sql import Window
    w = Window.partitionBy("doc_id").orderBy("pos")
    near = tokens.select("term", here[0].over(w).alias("b"), here[1].over(w).alias("c"))
    # a triple in 5 places has pairs in 5 places: few triples travel, and a key is one string
    joined = lambda *c: F.concat_ws("\u0001", *c)
    counted = near.filter("b is not null").groupBy(joined("term", "b").alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 5")
    often = written(counted, "pairs")
    bitmap = written(_hash_bitmap(often.select(F.xxhash64("k").alias("h"))), "pairs-bitmap")
    near = near.filter("c is not null")
    for pair in (("term", "b"), ("b", "c")):
        near = _maybe_known(near.withColumn("h", F.xxhash64(joined(*pair))), bitmap).drop("h")
    triples = near.groupBy(joined("term", "b", "c").alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("n between 5 and 60")
    words = often.filter("n between 10 and 60").unionByName(triples).select(F.split("k", "\u0001").alias("words"))
    return words.select("words", F.array(F.array(F.array_join("words", "_")), F.slice("words", 1, 1)).alias("outputs"))


@register("t33_multiword_rule_table", f"""
WITH RECURSIVE {_RULES_SQL},
cand AS (SELECT a.doc_id, a.pos, 2 AS n, [a.term, b.term] AS w FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
         UNION ALL SELECT a.doc_id, a.pos, 3, [a.term, b.term, c.term] FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
         JOIN tok c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2),
m AS (SELECT doc_id, pos, max(n) AS n, arg_max(cand.w, n) AS w FROM cand SEMI JOIN rules ON rules.w = cand.w GROUP BY doc_id, pos),
nxt AS (SELECT m.doc_id, m.pos, m.n, m.w, x.pos AS then_ FROM m ASOF LEFT JOIN m x ON m.doc_id = x.doc_id AND x.pos >= m.pos + m.n),
used AS (SELECT nxt.* FROM nxt JOIN (SELECT doc_id, min(pos) AS pos FROM m GROUP BY doc_id) f USING (doc_id, pos)
         UNION ALL SELECT nxt.* FROM used JOIN nxt ON nxt.doc_id = used.doc_id AND nxt.pos = used.then_),
cover AS (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM used)
SELECT doc_id, pos, term FROM (SELECT doc_id, pos, term FROM tok ANTI JOIN cover USING (doc_id, pos)
  UNION SELECT doc_id, pos, array_to_string(w, '_') FROM used UNION SELECT doc_id, pos, w[1] FROM used)
""")
def t33_table(spark, d):
    """Thousands of multi-word rules (frequent pairs and triples of the corpus) applied to every document."""
    tokens = an.token_table(dealt(_docs(spark, d), "doc_id", "text"), "doc_id", "text", with_length=False)
    return sy.apply_rule_table(tokens, _phrase_rules(tokens))


# ------------------------------------------------------------------ T40: stemmers over the whole vocabulary

def _stems(spark, d, name):
    return stem.vocabulary_stems(an.token_table(_docs(spark, d), "doc_id", "text", with_length=False), name)


_VOCABULARY = "v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents)"


@register("t40_german_light_stems", f"""
WITH {_VOCABULARY},
a AS (SELECT term, translate(term, 'äàáâöòóôïìíîüùúû', 'aaaaooooiiiiuuuu') AS w FROM v),
b AS (SELECT term, CASE WHEN length(w) > 5 AND w LIKE '%ern' THEN left(w, length(w) - 3)
   WHEN length(w) > 4 AND regexp_matches(w, 'e[mnrs]$') THEN left(w, length(w) - 2)
   WHEN length(w) > 3 AND w LIKE '%e' THEN left(w, length(w) - 1)
   WHEN length(w) > 3 AND regexp_matches(w, '[bdfghklmnt]s$') THEN left(w, length(w) - 1) ELSE w END AS w FROM a)
SELECT term, CASE WHEN length(w) > 5 AND w LIKE '%est' THEN left(w, length(w) - 3)
   WHEN length(w) > 4 AND regexp_matches(w, 'e[rn]$') THEN left(w, length(w) - 2)
   WHEN length(w) > 4 AND regexp_matches(w, '[bdfghklmnt]st$') THEN left(w, length(w) - 2) ELSE w END AS stem FROM b
""")
def t40_de_light(spark, d):
    return _stems(spark, d, "de_light")


@register("t40_german_minimal_stems", f"""
WITH {_VOCABULARY}, a AS (SELECT term, translate(term, 'äöü', 'aou') AS w FROM v)
SELECT term, CASE WHEN length(term) < 5 THEN term WHEN length(w) > 6 AND w LIKE '%nen' THEN left(w, length(w) - 3)
   WHEN length(w) > 5 AND regexp_matches(w, '(en|se|es|er)$') THEN left(w, length(w) - 2)
   WHEN regexp_matches(w, '[nesr]$') THEN left(w, length(w) - 1) ELSE w END AS stem FROM a
""")
def t40_de_minimal(spark, d):
    return _stems(spark, d, "de_minimal")


@register("t40_spanish_light_stems", f"""
WITH {_VOCABULARY}, a AS (SELECT term, translate(term, 'àáâäòóôöèéêëùúûüìíîï', 'aaaaooooeeeeuuuuiiii') AS w FROM v)
SELECT term, CASE WHEN length(term) < 5 THEN term WHEN regexp_matches(w, '[oae]$') THEN left(w, length(w) - 1)
   WHEN w LIKE '%eses' THEN left(w, length(w) - 2) WHEN w LIKE '%ces' THEN left(w, length(w) - 3) || 'z'
   WHEN regexp_matches(w, '[oae]s$') THEN left(w, length(w) - 2) ELSE w END AS stem FROM a
""")
def t40_es_light(spark, d):
    return _stems(spark, d, "es_light")


_CHOP = lambda c, ch: f"CASE WHEN right({c}, 1) = '{ch}' THEN left({c}, length({c}) - 1) ELSE {c} END"


@register("t40_french_minimal_stems", f"""
WITH {_VOCABULARY}, a AS (SELECT term, {_CHOP('term', 's')} AS w FROM v), b AS (SELECT term, {_CHOP('w', 'r')} AS w FROM a),
c AS (SELECT term, {_CHOP('w', 'e')} AS w FROM b), e AS (SELECT term, {_CHOP('w', 'é')} AS w FROM c)
SELECT term, CASE WHEN length(term) < 6 THEN term WHEN term LIKE '%aux' THEN left(term, length(term) - 2) || 'l'
   WHEN term LIKE '%x' THEN left(term, length(term) - 1)
   WHEN right(w, 1) = substr(w, length(w) - 1, 1) THEN left(w, length(w) - 1) ELSE w END AS stem FROM e
""")
def t40_fr_minimal(spark, d):
    return _stems(spark, d, "fr_minimal")


@register("t40_french_light_stems")
def t40_fr_light(spark, d):
    """Compared with brute force in the tests."""
    return _stems(spark, d, "fr_light")


@register("t40_english_porter_stems")
def t40_porter(spark, d):
    """Compared with brute force and the published examples in the tests."""
    return _stems(spark, d, "en_porter")


# ------------------------------------------------------------------ T41–T43

_DICT = "st_ AS (SELECT term FROM st WHERE df >= 5)"
# Endings that the query strips.
_SUFFIXES = ["s", "es", "ed", "ing", "ly", "en", "er", "ern", "e", "lich", "ment", "ments", "ción", "ciones", "ée", "ées", "tion", "tions", "ung", "ungen"]


def _terms(spark, d):
    return _index(spark, d).term_stats.select("term", "df")


@register("t41_dictionary_suffix_strip", f"""
WITH {_TOK}, {_DICT}, x AS (SELECT unnest(['', {', '.join(f"'{s}'" for s in _SUFFIXES)}]) AS suffix),
c AS (SELECT term, substr(term, 1, i) AS stem, substr(term, i + 1) AS suffix FROM (SELECT term, unnest(range(1, length(term) + 1)) AS i FROM st))
SELECT c.term, arg_max(c.stem, length(c.suffix)) AS stem, arg_max(c.suffix, length(c.suffix)) AS suffix
FROM c JOIN x ON x.suffix = c.suffix JOIN st_ ON st_.term = c.stem GROUP BY c.term
""")
def t41(spark, d):
    """All terms, split into a term of five or more documents and the longest ending of a table."""
    terms = _terms(spark, d)
    suffixes = spark.createDataFrame([(s,) for s in _SUFFIXES], "suffix string")
    return mo.strip_suffixes(terms, terms.filter("df >= 5").select(F.col("term").alias("stem")), suffixes)


@register("t42_compound_segmentation", f"""
WITH RECURSIVE {_TOK}, dict AS (SELECT term FROM st WHERE df >= 5 AND length(term) >= 2 AND length(term) <= 20),
p AS (SELECT term, s, unnest(range(s + 2, least(s + 20, length(term)) + 1)) AS e FROM (SELECT term, unnest(range(0, length(term) - 1)) AS s FROM st)),
edges AS MATERIALIZED (SELECT p.term, s, e FROM p JOIN dict ON dict.term = substr(p.term, CAST(s AS INTEGER) + 1, CAST(e - s AS INTEGER)) WHERE e - s < length(p.term)),
-- the best path to the end from every place, one part more a turn; a path is two digits a part, smaller for longer parts
walk AS (SELECT term, CAST(length(term) AS BIGINT) AS pl, '' AS back, 0 AS n FROM st
  UNION ALL
  SELECT w.term, g.s AS pl, min(lpad(CAST(99 - (g.e - g.s) AS VARCHAR), 2, '0') || w.back) AS back, any_value(w.n) + 1 AS n
  FROM walk w JOIN edges g ON g.term = w.term AND g.e = w.pl GROUP BY w.term, g.s),
best AS (SELECT term, min(n) AS n, arg_min(back, n) AS back FROM walk WHERE pl = 0 AND n > 0 GROUP BY term),
cut AS (SELECT term, n, list_transform(range(0, n), lambda i: 99 - CAST(substr(back, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)) AS z FROM best)
SELECT term, list_transform(z, lambda x, i: substr(term, CAST(coalesce(list_sum(z[1:i - 1]), 0) + 1 AS INTEGER), CAST(x AS INTEGER))) AS parts,
       CAST(n AS INTEGER) AS n_parts FROM cut
""")
def t42(spark, d):
    """All terms as the fewest terms of five or more documents (2 to 20 characters)."""
    terms = _terms(spark, d)
    return mo.segment_compounds(terms, terms.filter("df >= 5 and length(term) between 2 and 20"))


@register("t43_character_readings", f"""
WITH {_TOK},
r AS (SELECT c AS char, min(term) AS reading FROM (SELECT term, c FROM (SELECT term, unnest(string_split(term, '')) AS c FROM st) WHERE c > 'z') GROUP BY c),
x AS (SELECT term, c, i FROM (SELECT term, unnest(string_split(term, '')) AS c, generate_subscripts(string_split(term, ''), 1) AS i FROM st))
SELECT x.term, string_agg(coalesce(r.reading, x.c), '' ORDER BY i) AS reading FROM x LEFT JOIN r ON r.char = x.c GROUP BY x.term HAVING count(r.reading) > 0
""")
def t43(spark, d):
    """All terms with every character beyond ``z`` replaced by its reading; the table, here the smallest term with the character, is data."""
    terms = _terms(spark, d)
    chars = terms.select("term", F.explode(F.split("term", "")).alias("char")).filter(F.col("char") > "z")
    readings = chars.groupBy("char").agg(F.min("term").alias("reading"))
    return mo.character_readings(terms, readings)
