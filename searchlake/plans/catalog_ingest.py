"""Queries for ingest transforms (P*), signatures and dedupe, table mutation (M*) and join filters (J*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from searchlake.operators import ingest as ing
from searchlake.operators import joins as jn
from searchlake.operators import mutate as mu
from searchlake.operators import signatures as sig
from searchlake.plans.registry import register
from searchlake.session import table as T


def _part(spark, d):
    return T(spark, d, "part")


# ------------------------------------------------------------------ P02–P16

@register("p02_clone_fields_into_multivalue", "SELECT p_partkey, [p_brand, p_type] AS tags FROM part")
def p02(spark, d):
    return ing.clone_field(_part(spark, d), ["p_brand", "p_type"], "tags").select("p_partkey", "tags")


@register("p03_copy_field_max_chars", "SELECT p_partkey, substr(p_name, 1, 5) AS short_name FROM part")
def p03(spark, d):
    return ing.copy_field(_part(spark, d), "p_name", "short_name", 5).select("p_partkey", "short_name")


@register("p04_concat_multivalues", "SELECT p_partkey, array_to_string(string_split(p_name, ' '), ', ') AS words FROM part")
def p04(spark, d):
    p = _part(spark, d).withColumn("words", F.split("p_name", " "))
    return ing.concat_values(p, "words").select("p_partkey", "words")


@register("p05_count_values", "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM part")
def p05(spark, d):
    p = _part(spark, d).withColumn("words", F.split("p_name", " "))
    return ing.count_values(p, "words", "n_words").select("p_partkey", "n_words")


@register("p06_field_length", "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS name_len FROM part")
def p06(spark, d):
    return ing.field_length(_part(spark, d), "p_name", "name_len").select("p_partkey", "name_len")


@register("p07_p08_first_last_value", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word FROM part
""")
def p07(spark, d):
    p = _part(spark, d).withColumn("first_word", F.split("p_name", " ")).withColumn("last_word", F.split("p_name", " "))
    p = ing.last_value(ing.first_value(p, "first_word"), "last_word")
    return p.select("p_partkey", "first_word", "last_word")


@register("p09_p10_min_max_value", """
SELECT p_partkey, list_min([p_size, (p_size * 7) % 50, 25]) AS lo, list_max([p_size, (p_size * 7) % 50, 25]) AS hi FROM part
""")
def p09(spark, d):
    arr = F.array(F.col("p_size"), (F.col("p_size") * 7) % 50, F.lit(25))
    p = _part(spark, d).withColumn("lo", arr).withColumn("hi", arr)
    return ing.max_value(ing.min_value(p, "lo"), "hi").select("p_partkey", "lo", "hi")


@register("p11_uniq_values_first_seen", """
SELECT p_partkey, CASE WHEN p_brand = p_type THEN [p_brand] ELSE [p_brand, p_type] END AS vals FROM part
""")
def p11(spark, d):
    p = _part(spark, d).withColumn("vals", F.array("p_brand", "p_type", "p_brand"))
    return ing.uniq_values(p, "vals").select("p_partkey", "vals")


@register("p12_trim", "SELECT c_custkey, trim(c_name) AS c_name FROM customer")
def p12(spark, d):
    c = T(spark, d, "customer").withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" \t")))
    return ing.trim_fields(c, ["c_name"]).select("c_custkey", "c_name")


@register("p13_truncate", "SELECT c_custkey, substr(c_name, 1, 12) AS c_name FROM customer")
def p13(spark, d):
    return ing.truncate_fields(T(spark, d, "customer"), ["c_name"], 12).select("c_custkey", "c_name")


@register("p14_remove_blank", "SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS p_type FROM part")
def p14(spark, d):
    p = _part(spark, d).withColumn("p_type", F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(F.col("p_type")))
    return ing.remove_blank(p, ["p_type"]).select("p_partkey", "p_type")


@register("p15_ignore_fields_glob", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def p15(spark, d):
    return ing.ignore_fields(T(spark, d, "lineitem"), "l_t*")


@register("p16_regex_replace_all", "SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '*', 'g') AS p_name FROM part")
def p16(spark, d):
    return ing.regex_replace(_part(spark, d), ["p_name"], "[aeiou]", "*").select("p_partkey", "p_name")


def _html_sql(col: str) -> str:
    x = f"regexp_replace({col}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    x = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for k, v in ing.HTML_ENTITIES.items():
        if k != "&amp;":
            x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return f"replace({x}, '&amp;', '&')"


@register("p17_html_strip_pages", f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def p17(spark, d):
    return ing.html_strip(T(spark, d, "pages"), "html", "text").select("page_id", "text")


@register("p18_default_value", "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_linenumber, 3), 0) AS ln FROM lineitem")
def p18(spark, d):
    li = T(spark, d, "lineitem").withColumn("ln", F.nullif(F.col("l_linenumber"), F.lit(3)))
    return ing.default_value(li, "ln", 0).select("l_orderkey", "l_linenumber", "ln")


@register("p19_timestamp_default", """
SELECT event_id, coalesce(CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END, TIMESTAMP '2024-06-01 12:00:00') AS ts FROM events
""")
def p19(spark, d):
    e = T(spark, d, "events").withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("timestamp")))
    return ing.timestamp_default(e, "ts", dt.datetime(2024, 6, 1, 12, 0, 0)).select("event_id", "ts")


@register("p20_uuid_default")
def p20(spark, d):
    e = T(spark, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string"))
                                     .alias("uid"))
    return ing.uuid_default(e, "uid")


@register("p21_infer_types_all_values", """
SELECT CAST(event_id AS BIGINT) AS a, value AS b, value > 5 AS c, CAST(ts AS TIMESTAMP) AS t, event_type AS e FROM events
""")
def p21(spark, d):
    e = T(spark, d, "events").select(
        F.col("event_id").cast("string").alias("a"), F.col("value").cast("string").alias("b"),
        F.when(F.col("value") > 5, "true").otherwise("false").alias("c"),
        F.col("ts").cast("string").alias("t"), F.col("event_type").alias("e"))
    return ing.infer_types(e)


@register("p22_parse_boolean", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS flag,
       CASE WHEN event_id % 3 = 2 THEN 'maybe' END AS flag_unparsed FROM events
""")
def p22(spark, d):
    e = T(spark, d, "events").select("event_id", F.element_at(F.array(F.lit(" Yes"), F.lit("OFF"), F.lit("maybe")),
                                                              (F.col("event_id") % 3 + 1).cast("int")).alias("flag"))
    return ing.parse_boolean(e, "flag")


@register("p23_parse_date_format_list", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d, NULL::VARCHAR AS d_unparsed FROM orders
""")
def p23(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0,
                                                          F.date_format("o_orderdate", "yyyy/MM/dd"))
                                     .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("d"))
    return ing.parse_date(o, "d", ["yyyy/MM/dd", "dd.MM.yyyy"])


@register("p24_parse_double_grouping", "SELECT o_orderkey, o_totalprice AS p, NULL::VARCHAR AS p_unparsed FROM orders")
def p24(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("p"))
    return ing.parse_number(o, "p", "double")


@register("p25_parse_float_keeps_unparsed", """
SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS FLOAT) END AS size,
       CASE WHEN p_partkey % 5 = 0 THEN 'size ' || p_size END AS size_unparsed FROM part
""")
def p25(spark, d):
    size = F.col("p_size").cast("string")
    p = T(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("size "), size))
                                   .otherwise(size).alias("size"))
    return ing.parse_number(p, "size", "float")


@register("p26_p27_parse_int_long", """
SELECT l_orderkey, l_linenumber AS n, NULL::VARCHAR AS n_unparsed, CAST(l_orderkey AS BIGINT) AS k, NULL::VARCHAR AS k_unparsed
FROM lineitem""")
def p26(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit(" "), F.col("l_linenumber").cast("string")).alias("n"),
                                        F.col("l_orderkey").cast("string").alias("k"))
    return ing.parse_number(ing.parse_number(li, "n", "int"), "k", "bigint")


@register("p28_signature_md5_fields", "SELECT p_partkey, md5('p_name' || p_name || 'p_brand' || p_brand) AS signature FROM part")
def p28(spark, d):
    return sig.signature_md5(_part(spark, d), ["p_name", "p_brand"]).select("p_partkey", "signature")


@register("p29_signature_hash64")
def p29(spark, d):
    return sig.signature_hash64(_part(spark, d), ["p_name", "p_brand"]).select("p_partkey", "signature")


_PROFILE_SQL = r"""
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+')) AS tok FROM documents),
c AS (SELECT doc_id, tok, CAST(count(*) AS INTEGER) AS c FROM t WHERE length(tok) > 2 GROUP BY doc_id, tok),
m AS (SELECT doc_id, max(c) AS mx FROM c GROUP BY doc_id),
q AS (SELECT doc_id, CASE WHEN floor(mx * 0.01 + 0.5) < 2 THEN CASE WHEN mx > 1 THEN 2 ELSE 1 END
                          ELSE CAST(floor(mx * 0.01 + 0.5) AS INTEGER) END AS q FROM m),
k AS (SELECT c.doc_id, tok, CAST(floor(c.c / q.q) * q.q AS INTEGER) AS cq FROM c JOIN q USING (doc_id)
      WHERE floor(c.c / q.q) * q.q >= q.q),
p AS (SELECT doc_id, string_agg(tok || ' ' || CAST(cq AS VARCHAR), chr(10) ORDER BY cq DESC, tok) AS prof FROM k GROUP BY doc_id),
s AS (SELECT d.doc_id, md5(coalesce(p.prof, '')) AS signature FROM documents d LEFT JOIN p USING (doc_id))"""


@register("p30_text_profile_signature", f"WITH {_PROFILE_SQL} SELECT doc_id, signature FROM s")
def p30(spark, d):
    return sig.signature_text_profile(T(spark, d, "documents"), "doc_id", "text").select("doc_id", "signature")


@register("p31_dedupe_by_text_profile_latest_wins", f"""
WITH {_PROFILE_SQL} SELECT max(doc_id) AS doc_id, signature FROM s GROUP BY signature
""")
def p31(spark, d):
    s = sig.signature_text_profile(T(spark, d, "documents"), "doc_id", "text").select("doc_id", "signature")
    return sig.dedupe_by_signature(s, "signature", "doc_id")


@register("p31_dedupe_exact_md5_conversations", """
WITH s AS (SELECT conv_id, turn, md5('text' || text) AS signature FROM conversations)
SELECT arg_max(conv_id * 1000 + turn, conv_id * 1000 + turn) AS k, signature FROM s GROUP BY signature
""")
def p31b(spark, d):
    c = T(spark, d, "conversations").withColumn("k", F.col("conv_id") * 1000 + F.col("turn"))
    s = sig.signature_md5(c, ["text"]).select("k", "signature")
    return sig.dedupe_by_signature(s, "signature", "k")


_URL_SQL = r"""
WITH u AS (SELECT page_id, url,
  regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') AS nq,
  regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1) AS host,
  regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1) AS scheme FROM pages),
v AS (SELECT *, regexp_extract(nq, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/.*)?$', 1) AS path FROM u),
w AS (SELECT *, regexp_replace(regexp_replace(lower(path), '({landing})$', ''), '/+$', '') AS bare,
  NOT contains(regexp_replace(url, '#.*$', ''), '?') AS plain FROM v),
x AS (SELECT *, regexp_matches(lower(path), '({landing})$') AND plain AS landing FROM w)
SELECT page_id, CAST(length(url) AS INTEGER) AS url_length,
  CAST(length(bare) - length(replace(bare, '/', '')) AS INTEGER) AS url_levels, bare = '' AND plain AS url_toplevel,
  landing AS url_landingpage, lower(host) AS url_domain,
  lower(scheme) || '://' || lower(host) ||
    CASE WHEN (CASE WHEN landing THEN regexp_replace(path, '[^/]*$', '') ELSE path END) = '' THEN '/'
         ELSE (CASE WHEN landing THEN regexp_replace(path, '[^/]*$', '') ELSE path END) END AS url_canonical
FROM x
"""


@register("p32_url_classify", _URL_SQL.replace("{landing}", "|".join(
    p.replace(".", r"\.") for p in ing.LANDING_PAGES)))
def p32(spark, d):
    p = ing.url_classify(T(spark, d, "pages"), "url")
    return p.select("page_id", "url_length", "url_levels", "url_toplevel", "url_landingpage", "url_domain",
                    "url_canonical")


@register("p33_regex_boost_product", """
SELECT p_partkey, 1.0 * (CASE WHEN regexp_full_match(p_name, '.*widget.*') THEN 2.0 ELSE 1.0 END)
                      * (CASE WHEN regexp_full_match(p_name, '(red|blue) .*') THEN 1.5 ELSE 1.0 END)
                      * (CASE WHEN regexp_full_match(p_name, 'small.*') THEN 0.5 ELSE 1.0 END) AS boost
FROM part
""")
def p33(spark, d):
    rules = [(".*widget.*", 2.0), ("(red|blue) .*", 1.5), ("small.*", 0.5)]
    return ing.regex_boost(_part(spark, d), "p_name", rules).select("p_partkey", "boost")


@register("p34_preanalyzed_tokens", """
WITH t AS (SELECT item_id, regexp_extract_all(lower(text), '[\\pL\\pN]+') AS x FROM benchmark)
SELECT item_id AS doc_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos, unnest(x) AS term FROM t
""")
def p34(spark, d):
    b = T(spark, d, "benchmark")
    toks = F.regexp_extract_all(F.lower("text"), F.lit("[\\pL\\pN]+"), 0)
    js = F.to_json(F.struct(F.lit("1").alias("v"),
                            F.transform(toks, lambda t: F.struct(t.alias("t"), F.lit(1).alias("i"))).alias("tokens")))
    pre = b.select("item_id", js.alias("pre"))
    return ing.explode_preanalyzed(pre, "item_id", "pre").select("doc_id", "pos", "term")


@register("p35_validate_required_fields", """
SELECT l_orderkey, 'ln' AS field, 'missing required field' AS reason FROM lineitem WHERE nullif(l_linenumber, 3) IS NULL
""")
def p35(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(3)).alias("ln"))
    return ing.validate_docs(li, "l_orderkey", ["ln"])


# ------------------------------------------------------------------ mutation

def _updates(spark, d):
    """Update batch derived from the table: urgent open orders get a new priority and price."""
    o = T(spark, d, "orders")
    return o.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")) \
        .withColumn("o_orderpriority", F.lit("0-TOP")).withColumn("o_totalprice", F.col("o_totalprice") + 1)


@register("m01_upsert_overwrite_by_key", """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '0-TOP' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def m01(spark, d):
    return mu.upsert(T(spark, d, "orders"), _updates(spark, d), "o_orderkey")


@register("m02_append_without_overwrite", """
SELECT * FROM orders UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, '0-TOP' FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
""")
def m02(spark, d):
    return mu.append(T(spark, d, "orders"), _updates(spark, d))


@register("m03_delete_by_ids", """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)
""")
def m03(spark, d):
    ids = T(spark, d, "lineitem").filter(F.col("l_quantity") >= 50).select(F.col("l_orderkey").alias("o_orderkey"))
    return mu.delete_by_ids(T(spark, d, "orders"), ids, "o_orderkey")


@register("m04_delete_by_query", "SELECT * FROM orders WHERE NOT coalesce(o_totalprice < 10000 OR o_orderstatus = 'P', false)")
def m04(spark, d):
    return mu.delete_by_query(T(spark, d, "orders"), (F.col("o_totalprice") < 10000) | (F.col("o_orderstatus") == "P"))


@register("m05_m07_atomic_set_inc", """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 2.5 ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 5 = 0 THEN '9-BULK' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def m05(spark, d):
    o = T(spark, d, "orders")
    ops = o.filter(F.col("o_orderkey") % 5 == 0).select("o_orderkey", F.lit("o_orderpriority").alias("field"),
                                                        F.lit("set").alias("op"), F.lit("9-BULK").alias("value")) \
        .unionByName(o.filter(F.col("o_orderkey") % 7 == 0).select(
            "o_orderkey", F.lit("o_totalprice").alias("field"), F.lit("inc").alias("op"), F.lit("2.5").alias("value")))
    return mu.atomic_update(o, ops, "o_orderkey").select(*o.columns)


@register("m06_atomic_add_to_multivalue", """
SELECT p_partkey, CASE WHEN p_size > 45 THEN [p_brand, 'big'] ELSE [p_brand] END AS tags FROM part
""")
def m06(spark, d):
    p = _part(spark, d).select("p_partkey", F.array("p_brand").alias("tags"))
    ops = _part(spark, d).filter(F.col("p_size") > 45).select(
        "p_partkey", F.lit("tags").alias("field"), F.lit("add").alias("op"), F.lit("big").alias("value"))
    return mu.atomic_update(p, ops, "p_partkey").select("p_partkey", "tags")


@register("m08_versioned_update_conflicts", """
WITH base AS (SELECT o_orderkey, o_orderkey % 3 + 1 AS version FROM orders),
upd AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 2 WHEN o_orderkey % 4 = 1 THEN -1 ELSE 0 END AS version
        FROM orders WHERE o_totalprice > 450000)
SELECT u.o_orderkey, u.version, b.version AS current_version FROM upd u LEFT JOIN base b USING (o_orderkey)
WHERE NOT (u.version IS NULL OR u.version = 0 OR (u.version = 1 AND b.version IS NOT NULL)
           OR (u.version < 0 AND b.version IS NULL) OR u.version = b.version)
""")
def m08(spark, d):
    o = T(spark, d, "orders")
    base = o.select("o_orderkey", (F.col("o_orderkey") % 3 + 1).alias("version"))
    upd = o.filter(F.col("o_totalprice") > 450000).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, 2).when(F.col("o_orderkey") % 4 == 1, -1)
        .otherwise(0).cast("long").alias("version"))
    return mu.upsert_versioned(base, upd, "o_orderkey")["conflicts"].select("o_orderkey", "version", "current_version")


@register("m09_get_by_ids", """
SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0.1 AND l_tax = 0.08)
""")
def m09(spark, d):
    ids = T(spark, d, "lineitem").filter((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)) \
        .select(F.col("l_orderkey").alias("o_orderkey"))
    return mu.get_by_ids(T(spark, d, "orders"), ids, "o_orderkey")


# ------------------------------------------------------------------ joins

@register("j01_join_filter_same_table", """
SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)
""")
def j01(spark, d):
    o = T(spark, d, "orders")
    return jn.join_filter(o, "o_custkey", o.filter(F.col("o_totalprice") > 490000), "o_custkey")


@register("j02_join_filter_cross_collection", """
SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 480000)
""")
def j02(spark, d):
    o = T(spark, d, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 480000))
    return jn.join_filter(T(spark, d, "customer"), "c_custkey", o, "o_custkey", check_size=True)


@register("j03_block_join_to_parent", """
SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity >= 50)
""")
def j03(spark, d):
    return jn.to_parent(T(spark, d, "lineitem"), T(spark, d, "orders"), "o_orderkey", "l_orderkey",
                        F.col("l_quantity") >= 50)


@register("j04_block_join_to_child", """
SELECT * FROM lineitem l WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
                                       AND o.o_orderstatus = 'F' AND o.o_totalprice > 450000)
""")
def j04(spark, d):
    return jn.to_child(T(spark, d, "lineitem"), T(spark, d, "orders"), "o_orderkey", "l_orderkey",
                       (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 450000))


@register("j05_joindf_link_counts", """
SELECT c.c_custkey, coalesce(n.joindf, 0) AS joindf FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS joindf FROM orders GROUP BY o_custkey) n ON n.o_custkey = c.c_custkey
""")
def j05(spark, d):
    c = T(spark, d, "customer").select("c_custkey")
    return jn.joindf(c, "c_custkey", T(spark, d, "orders"), "o_custkey")


@register("j06_external_score_default", """
SELECT l.l_orderkey, l.l_linenumber, coalesce(s.s_acctbal / 1000, -1.0) AS external_score
FROM lineitem l LEFT JOIN (SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l.l_suppkey
""")
def j06(spark, d):
    scores = T(spark, d, "supplier").filter(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("key"), (F.col("s_acctbal") / 1000).alias("score"))
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey"))
    return jn.external_score(li, "l_suppkey", scores, -1.0).select("l_orderkey", "l_linenumber", "external_score")


@register("j07_elevation_include_exclude", """
WITH h AS (SELECT o_orderkey, o_totalprice AS score FROM orders WHERE o_orderpriority = '1-URGENT'),
r AS (SELECT * FROM (VALUES (2::BIGINT, 1, false), (5::BIGINT, 2, false), (0::BIGINT, NULL, true)) t(doc_id, erank, excl)),
h2 AS (SELECT * FROM h WHERE o_orderkey NOT IN (SELECT doc_id FROM r WHERE excl)
       UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey IN (SELECT doc_id FROM r WHERE NOT excl)
                 AND o_orderkey NOT IN (SELECT o_orderkey FROM h))
SELECT h2.o_orderkey, h2.score, r.erank IS NOT NULL AS elevated, false AS excluded,
       row_number() OVER (ORDER BY r.erank NULLS LAST, h2.score DESC NULLS LAST, h2.o_orderkey) AS rank
FROM h2 LEFT JOIN (SELECT * FROM r WHERE NOT excl) r ON r.doc_id = h2.o_orderkey
""")
def j07(spark, d):
    o = T(spark, d, "orders")
    hits = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", F.col("o_totalprice").alias("score"))
    rules = spark.createDataFrame([("q", 2, 1, False), ("q", 5, 2, False), ("q", 0, None, True)],
                                  "query string, doc_id long, rank int, exclude boolean")
    return jn.elevate(hits, o.select("o_orderkey"), "o_orderkey", rules, "q")
