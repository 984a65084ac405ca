"""Further entries: tokenizers and letters (T06, T07, T12, T38, T47), WordNet sets and payloads (T34, T39, F33), word files (C11), sources
(S06–S08), profiles (A24), entities (P17) and function plug-ins (V01). All of them read whole tables; where a feature needs another script
or a file, Spark derives it from these tables."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import functions as F

from searchlake.functions import registry as fnr
from searchlake.operators import analysis as an
from searchlake.operators import components as cp
from searchlake.operators import ingest as ing
from searchlake.operators import joins as jn
from searchlake.operators import letters
from searchlake.operators import proximity as px
from searchlake.operators import streams as st
from searchlake.operators import synonyms as sy
from searchlake.operators import terms as tr
from searchlake.operators.util import dealt
from searchlake.plans.catalog_misc import _QWORDS_SQL, _qwords
from searchlake.plans.catalog_streams import _stream_sql
from searchlake.plans.catalog_text import _TOK, _index, _one_byte
from searchlake.plans.registry import register
from searchlake.session import scratch_dir
from searchlake.session import table as T
from searchlake.sources import writers as wr


def _docs(spark, d):
    return T(spark, d, "documents")


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------------ T06, T07

_CLASSIC = "|".join([an._EMAIL, an._HOST, an._ACRONYM, an._NUM, an._WORD])
_URLS = "|".join([an._URL, an._EMAIL, an._WORD])


@register("t06_classic_tokenizer", f"""
WITH t AS (SELECT unnest(regexp_extract_all(text, {_literal(_CLASSIC)})) AS t FROM documents)
SELECT CASE WHEN regexp_matches(t, {_literal('^' + an._ACRONYM + '$')}) THEN replace(t, '.', '') ELSE regexp_replace(t, '''[sS]$', '') END AS term, count(*) AS n
FROM t GROUP BY 1
""")
def t06(spark, d):
    """Terms of the classic tokenizer and filter over all documents."""
    toks = _docs(spark, d).select(F.explode(an.classic_tokenizer()(F.col("text"))).alias("term"))
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@register("t07_url_email_tokenizer_types", f"""
WITH t AS (SELECT unnest(regexp_extract_all(text, {_literal(_URLS)})) AS term FROM documents)
SELECT term, CASE WHEN regexp_matches(term, {_literal('^' + an._URL + '$')}) THEN '<URL>' WHEN regexp_matches(term, {_literal('^' + an._EMAIL + '$')}) THEN '<EMAIL>'
  WHEN regexp_matches(term, {_literal('^' + an._HOST + '$')}) THEN '<HOST>' WHEN regexp_matches(term, '^\\p{{Nd}}[\\p{{Nd}}.,\\-/]*$') THEN '<NUM>' ELSE '<ALPHANUM>' END AS type,
  count(*) AS n FROM t GROUP BY ALL
""")
def t07(spark, d):
    """Terms and types of the URL and e-mail tokenizer over all documents."""
    a = an.url_email_tokenizer()(F.col("text"))
    rows = _docs(spark, d).select(a.alias("a")).select(F.explode(F.arrays_zip(F.col("a").alias("t"), an.token_types(F.col("a")).alias("k"))).alias("z"))
    return rows.groupBy(F.col("z.t").alias("term"), F.col("z.k").alias("type")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ T12, T49 (cjk)

_ABC = "abcdefghijklmnopqrstuvwxyz"
_KANA = "あいうえおかきくけこさしすせそたちつてとなにぬねのは"


@register("t12_t49_cjk_preset", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(lower(text), '{_ABC}', '{_KANA}'), '[あ-は]+|[\\pL\\pN]') AS x FROM documents),
p AS (SELECT doc_id, unnest(x) AS w FROM (SELECT doc_id, regexp_extract_all(translate(lower(text), '{_ABC}', '{_KANA}'), '[あ-は]+|[ß-ÿœ0-9]+') AS x FROM t JOIN documents USING (doc_id))),
g AS (SELECT doc_id, unnest(CASE WHEN regexp_matches(w, '^[あ-は]') AND length(w) > 1 THEN list_transform(range(1, length(w)), lambda i: substr(w, CAST(i AS INTEGER), 2)) ELSE [w] END) AS term FROM p)
SELECT doc_id, term, count(*) AS n FROM g GROUP BY ALL
""")
def t12(spark, d):
    """The cjk preset over the documents with Latin letters written as Kana: counts of letter pairs and other tokens per document."""
    kana = _docs(spark, d).select("doc_id", F.translate(F.lower("text"), _ABC, _KANA).alias("text"))
    toks = kana.select("doc_id", F.explode(an.preset("cjk").array(F.col("text"))).alias("term")).filter("term is not null")
    return toks.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ T38

_ARABIC = "ابتثجحخدذرزسشصضطظعغفقكلمةي"
_ARABIC_2 = "اآأإىةبتثجحخدذرزسشصضطظعغـًْ"
_PERSIAN = "ابتثجحخدذرزسشصضطظعغفقیےکۀۂ"
_HINDI = "अआइईकखगघङचनऩ़ीूै्ऐऔऋॠपफयॄँ"


@register("t38_arabic_letters", f"""
WITH {_TOK}, w AS (SELECT term, translate(term, '{_ABC}', '{_ARABIC_2}') AS t FROM st)
SELECT term, regexp_replace(translate(t, 'آأإىة', 'اااية'), '[ـً-ْ]', '', 'g') AS norm FROM w
""".replace("اااية", "ااايه"))
def t38_arabic(spark, d):
    """All terms with Latin letters written as Arabic ones, normalized."""
    return _lettered(spark, d, _ARABIC_2, an.arabic_normalization())


@register("t38_persian_letters", f"""
WITH {_TOK}, w AS (SELECT term, translate(term, '{_ABC}', '{_PERSIAN}') AS t FROM st)
SELECT term, replace(translate(t, 'یےکۀہ', 'ييكهه'), 'ٔ', '') AS norm FROM w
""")
def t38_persian(spark, d):
    return _lettered(spark, d, _PERSIAN, an.persian_normalization())


@register("t38_hindi_letters", f"""
WITH {_TOK}, w AS (SELECT term, translate(term, '{_ABC}', '{_HINDI}') AS t FROM st)
SELECT term, regexp_replace(translate(replace(t, 'न्', 'ं'), '{letters._HINDI_FROM}', '{letters._HINDI_TO}'), '{letters._HINDI_GONE}', '', 'g') AS norm FROM w
""")
def t38_hindi(spark, d):
    """All terms with Latin letters written as Devanagari ones, normalized."""
    return _lettered(spark, d, _HINDI, letters.hindi_normalization())


@register("t38_indic_letters")
def t38_indic(spark, d):
    """The same through the Indic normalization first. Compared with brute force in the tests."""
    both = lambda a: letters.hindi_normalization()(letters.indic_normalization()(a))
    return _lettered(spark, d, _HINDI, both)


def _lettered(spark, d, alphabet, step):
    terms = _index(spark, d).term_stats.select("term")
    return terms.select("term", F.get(step(F.array(F.translate("term", _ABC, alphabet))), F.lit(0)).alias("norm"))


# ------------------------------------------------------------------ T47

def _wiki_sql(c: str) -> str:
    x = f"regexp_replace({c}, '<a href=\"/([^\"]*)\">([^<]*)</a>', '[[\\1|\\2]]', 'g')"
    x = f"regexp_replace({x}, '<h1>([^<=]*)</h1>', '==\\1==', 'g')"
    x = f"regexp_replace({x}, '<title>([^<]*)</title>', '[[Category:\\1]]', 'g')"
    x = f"regexp_replace({x}, '<b>([^<'']*)<', '''''''\\1'''''' <', 'g')"
    x = f"regexp_replace({x}, '<footer>([^<}}]*)</footer>', '{{{{\\1}}}}', 'g')"
    return f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"


def _wiki(c):
    x = F.regexp_replace(c, '<a href="/([^"]*)">([^<]*)</a>', "[[$1|$2]]")
    x = F.regexp_replace(x, "<h1>([^<=]*)</h1>", "==$1==")
    x = F.regexp_replace(x, "<title>([^<]*)</title>", "[[Category:$1]]")
    x = F.regexp_replace(x, "<b>([^<']*)<", "'''$1''' <")
    x = F.regexp_replace(x, "<footer>([^<}]*)</footer>", "{{$1}}")
    return F.regexp_replace(x, "<[^>]*>", " ")


_WIKI_REGION = "|".join([r for _, r, _ in letters._REGIONS] + [an.DEFAULT_PATTERN])


@register("t47_wiki_tokenizer", f"""
WITH w AS (SELECT {_wiki_sql('html')} AS text FROM pages),
p AS (SELECT unnest(regexp_extract_all(text, {_literal(_WIKI_REGION)})) AS p FROM w),
k AS (SELECT p, CASE WHEN starts_with(p, '[[Category:') THEN 'c' WHEN starts_with(p, '[[') THEN 'il' WHEN starts_with(p, '[') THEN 'el' WHEN starts_with(p, '{{{{') THEN 'ci'
  WHEN starts_with(p, '===') THEN 'sh' WHEN starts_with(p, '==') THEN 'h' WHEN starts_with(p, '''''''''''') THEN 'bi' WHEN starts_with(p, '''''''') THEN 'b'
  WHEN starts_with(p, '''''') THEN 'i' ELSE 'word' END AS type FROM p),
t AS (SELECT type, unnest(regexp_extract_all(CASE WHEN type = 'c' THEN substr(p, 12) ELSE p END, '[\\pL\\pN]+')) AS term FROM k)
SELECT type, term, count(*) AS n FROM t GROUP BY ALL
""")
def t47(spark, d):
    """Types and terms of all pages, their markup rewritten as wiki markup: links, titles as categories, headings, bold, footers as citations."""
    toks = T(spark, d, "pages").select(F.explode(letters.wiki_tokens(_wiki(F.col("html")))).alias("t"))
    return toks.groupBy("t.type", "t.term").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ T34, F33, T39

@register("t34_wordnet_synonyms", f"""
WITH {_TOK}, s AS (SELECT left(term, 6) AS k, list(term ORDER BY term) AS words FROM st WHERE length(term) > 7 AND df >= 2 GROUP BY 1 HAVING count(*) > 1),
r AS (SELECT unnest(words) AS term, words FROM s)
SELECT doc_id, pos, term FROM tok ANTI JOIN r USING (term)
UNION ALL SELECT doc_id, pos, unnest(words) FROM tok JOIN r USING (term)
""")
def t34(spark, d):
    """A WordNet prolog file of the vocabulary (terms of one beginning are a set), read and applied to all documents."""
    path = scratch_dir(spark, "wordnet")
    terms = _index(spark, d).term_stats.filter("length(term) > 7 and df >= 2").select("term")
    key = F.abs(F.xxhash64(F.left("term", F.lit(6)))).cast("string")
    terms.select(F.concat(F.lit("s("), key, F.lit(",1,'"), F.replace("term", F.lit("'"), F.lit("''")), F.lit("',n,1,0)."))).write.text(path)
    rules = sy.wordnet_rules(sy.read_wordnet(spark, path))
    return sy.apply_rule_table(an.token_table(dealt(_docs(spark, d), "doc_id", "text"), "doc_id", "text", with_length=False), rules)


@register("f33_span_payload_check", f"""
WITH {_TOK}
SELECT a.doc_id, a.pos AS start, b.pos + 1 AS "end" FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
WHERE a.term = 'of' AND b.term = 'the' AND a.pos % 3 = 0
""")
def f33(spark, d):
    """Spans of a phrase whose tokens carry given payloads; a token's payload, here from its position, is data."""
    toks = an.token_table(_docs(spark, d), "doc_id", "text", with_length=False).filter(F.col("term").isin("of", "the"))
    toks = toks.withColumn("payload", F.concat(F.lit("p"), (F.col("pos") % 3).cast("string")))
    spans = px.near_spans(px.w(1, "of", "the"), {"text": _index(spark, d)})
    return px.span_payload_check(spans, toks, ["p0", "p1"])


@register("t39_numeric_and_offset_payloads", f"""
WITH {_stream_sql()}
SELECT doc_id, pos, CASE WHEN regexp_matches(term, '^\\p{{Nd}}+$') THEN CAST(2.5 AS FLOAT) END AS weight,
       printf('%08x', "start") || printf('%08x', "end") AS payload FROM s
""")
def t39(spark, d):
    """Numbers carry a weight, and every token its offsets."""
    s = st.token_stream(_docs(spark, d), "doc_id", "text")
    s = s.withColumn("type", F.when(F.col("term").rlike(r"^\p{Nd}+$"), "<NUM>").otherwise("<ALPHANUM>"))
    s = an.numeric_payload(s, "<NUM>", 2.5).withColumnRenamed("payload", "weight")
    return an.offsets_as_payload(s).select("doc_id", "pos", "weight", "payload")


# ------------------------------------------------------------------ C11

@register("c11_spell_from_word_file", f"""
WITH {_TOK}, {_QWORDS_SQL},
v AS (SELECT term FROM st WHERE df >= 3),
w AS (SELECT DISTINCT word FROM qw WHERE length(word) >= 4),
c AS (SELECT w.word, v.term, CAST(levenshtein({_one_byte('w.word')}, {_one_byte('v.term')}) AS INTEGER) AS edits FROM w JOIN v
      ON left(v.term, 1) = left(w.word, 1) AND abs(length(v.term) - length(w.word)) <= 2 AND v.term <> w.word),
s AS (SELECT *, 1.0 - edits / greatest(length(word), length(term)) AS score FROM c WHERE edits <= 2)
SELECT word, term AS suggestion, edits, round(score, 9) AS score, CAST(1 AS BIGINT) AS freq,
       row_number() OVER (PARTITION BY word ORDER BY score DESC, term) AS rank
FROM s WHERE score >= 0.5 QUALIFY rank <= 5
""")
def c11(spark, d):
    """Suggestions for all words of the query log from a word file, here the terms of three or more documents."""
    path = scratch_dir(spark, "words")
    _index(spark, d).term_stats.filter("df >= 3").select("term").write.text(path)
    out = cp.spell_suggest(wr.read_word_file(spark, path), _qwords(spark, d))
    return out.withColumn("score", F.round("score", 9)).withColumn("rank", F.col("rank").cast("long"))


# ------------------------------------------------------------------ S06–S08

@register("s06_csv_row_ids_and_literals", """
SELECT count(*) AS docs, count(*) AS ids, CAST(100 AS BIGINT) AS first_id, 99 + count(*) AS last_id, count(*) AS with_literal FROM supplier
""")
def s06(spark, d):
    """Documents read from CSV files with a literal field and row ids from 100 on."""
    path = scratch_dir(spark, "csv")
    wr.write_csv(T(spark, d, "supplier"), path)
    df = wr.read_csv_docs(spark, path, literals={"origin": "csv"}, rowid="row_id", rowid_offset=100)
    return df.agg(F.count(F.lit(1)).alias("docs"), F.count_distinct("row_id").alias("ids"), F.min("row_id").alias("first_id"),
                  F.max("row_id").alias("last_id"), F.count_if(F.col("origin") == "csv").alias("with_literal"))


_PARTS_SQL = "SELECT p_partkey, p_name, p_size FROM part"


@register("s07_json_array_and_add_forms", f"{_PARTS_SQL} UNION ALL {_PARTS_SQL}")
def s07(spark, d):
    """Documents from files that hold an array, and from add commands."""
    part = T(spark, d, "part").select("p_partkey", "p_name", "p_size")
    many, adds = scratch_dir(spark, "json-array"), scratch_dir(spark, "json-add")
    group = part.groupBy(F.pmod(F.xxhash64("p_partkey"), F.lit(16)).alias("f"))  # files of a bounded number of documents
    group.agg(F.collect_list(F.to_json(F.struct(*part.columns))).alias("rows")).select(
        F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")).alias("value")).repartition(16).write.text(many)
    part.select(F.to_json(F.struct(F.struct(F.struct(*part.columns).alias("doc")).alias("add"))).alias("value")).write.text(adds)
    read = [wr.read_json_docs(spark, many, multi_line=False), wr.read_json_docs(spark, adds, multi_line=False)]
    kind = {f.name: f.dataType for f in part.schema.fields}
    return read[0].select(*[F.col(c).cast(t) for c, t in kind.items()]).unionByName(read[1].select(*[F.col(c).cast(t) for c, t in kind.items()]))


@register("s08_xml_add_documents", "SELECT p_partkey, p_name, [p_brand, p_type] AS tags FROM part")
def s08(spark, d):
    """Documents from add commands in XML, a repeated field among them."""
    path = scratch_dir(spark, "xml-add")
    safe = lambda c: F.replace(F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    field = lambda name, c: F.concat(F.lit(f'<field name="{name}">'), safe(c), F.lit("</field>"))
    doc = F.concat(F.lit("<doc>"), field("key", "p_partkey"), field("name", "p_name"), field("tag", "p_brand"), field("tag", "p_type"), F.lit("</doc>"))
    part = T(spark, d, "part").withColumn("f", F.pmod(F.xxhash64("p_partkey"), F.lit(16)))  # one root per file
    whole = F.concat(F.lit("<add>\n"), F.array_join(F.collect_list(doc), "\n"), F.lit("\n</add>"))
    part.groupBy("f").agg(whole.alias("value")).repartition("f").write.partitionBy("f").text(path)
    f = F.col("fields")
    return wr.read_xml_docs(spark, path).select(f["key"][0].cast("long").alias("p_partkey"), f["name"][0].alias("p_name"), f["tag"].alias("tags"))


@register("r06_editorial_markers", """
SELECT doc_id, CAST(n_chars AS DOUBLE) AS score, coalesce(doc_id % 7 = 0 AND doc_id % 77 <> 0, false) AS elevated, coalesce(doc_id % 77 = 0, false) AS excluded FROM documents
""")
def r06(spark, d):
    """All documents marked by the rules of one query: every seventh is elevated, of these every eleventh excluded."""
    docs = _docs(spark, d)
    seventh = docs.filter("doc_id % 7 = 0").select(F.lit("q").alias("query"), "doc_id", (F.col("doc_id") % 11 == 0).alias("exclude"))
    rules = seventh.unionByName(docs.select(F.lit("other").alias("query"), "doc_id", F.lit(True).alias("exclude")))
    return jn.mark_editorial(docs.select("doc_id", F.col("n_chars").cast("double").alias("score")), "doc_id", rules, "q")


# ------------------------------------------------------------------ A24, P17, V01

@register("a24_profiles_of_several_fields", """
WITH t AS (SELECT 'text' AS field, doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents
  UNION ALL SELECT 'lang', doc_id, lang FROM documents WHERE lang IS NOT NULL UNION ALL SELECT 'source', doc_id, source FROM documents WHERE source IS NOT NULL),
f AS (SELECT field, term, count(DISTINCT doc_id) AS df FROM t GROUP BY ALL)
SELECT field, (SELECT count(DISTINCT doc_id) FROM t WHERE t.field = f.field) AS docs_with_field, count(*) AS distinct_terms,
       (SELECT count(*) FROM t WHERE t.field = f.field) AS tokens, arg_min(term, (-df, term)) AS top_term, (SELECT count(*) FROM documents) AS n_docs FROM f GROUP BY field
""")
def a24(spark, d):
    chains = {"text": an.default_analyzer(), "lang": an.preset("keyword"), "source": an.preset("keyword")}
    return tr.field_profiles(_docs(spark, d), "doc_id", chains)


@register("p17_html_entities_of_pages", f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '&#?[A-Za-z0-9]+;|[^&]+|&') AS p FROM pages),
m AS (SELECT map_from_entries([{', '.join(f"({_literal('&' + k + ';')}, {_literal(chr(v))})" for k, v in sorted({**name2codepoint, 'apos': 39}.items()))}]) AS m)
SELECT page_id, array_to_string(list_transform(p, lambda e: coalesce(m[e], CASE WHEN regexp_full_match(e, '&#[0-9]+;') THEN chr(regexp_extract(e, '[0-9]+')::INTEGER) END, e)), '') AS text FROM x, m
""")
def p17(spark, d):
    """All character references of all pages decoded."""
    return T(spark, d, "pages").select("page_id", ing.decode_entities(F.col("html")).alias("text"))


@register("v01_registered_function", """
SELECT l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS line_id FROM lineitem
""")
def v01(spark, d):
    """A function of the user's own, registered by name and called like a built-in one."""
    fnr.register_function("packed", lambda high, low, width: high * width + low, 3, replace=True)
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", fnr.call("packed", "l_orderkey", "l_linenumber", 8).alias("line_id"))
