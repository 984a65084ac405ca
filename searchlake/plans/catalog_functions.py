"""Queries for the function-query language (X01–X55) and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchlake.functions import datemath
from searchlake.functions import scalar as fn
from searchlake.operators import index as ix
from searchlake.operators import project as pj
from searchlake.plans.registry import register
from searchlake.session import table as T

_LN = "coalesce(CAST(nullif(l_linenumber, 3) AS DOUBLE), 0)"


def _li(spark, d):
    return T(spark, d, "lineitem").withColumn("ln", F.nullif(F.col("l_linenumber"), F.lit(3)))


@register("x01_x02_literal_and_field_missing_zero", f"""
SELECT l_orderkey, l_linenumber, 7 AS lit7, {_LN} AS ln0 FROM lineitem
""")
def x01(spark, d):
    return _li(spark, d).select("l_orderkey", "l_linenumber", fn.literal(7).alias("lit7"), fn.field("ln").alias("ln0"))


@register("x03_x04_ord_rord", """
WITH v AS (SELECT DISTINCT p_size FROM part),
o AS (SELECT p_size, row_number() OVER (ORDER BY p_size) AS ord, row_number() OVER (ORDER BY p_size DESC) AS rord FROM v)
SELECT p.p_partkey, o.ord, o.rord FROM part p JOIN o USING (p_size)
""")
def x03(spark, d):
    p = T(spark, d, "part").select("p_partkey", "p_size")
    p = fn.ord_(p, "p_size", "ord")
    p = fn.ord_(p, "p_size", "rord", reverse=True)
    return p.select("p_partkey", "ord", "rord")


@register("x06_x07_linear_recip", f"""
SELECT l_orderkey, l_linenumber, 2.0 * l_quantity + 3.0 AS lin,
       CASE WHEN 0.5 * l_quantity + 1.0 <> 0 THEN 10.0 / (0.5 * l_quantity + 1.0) END AS rec FROM lineitem
""")
def x06(spark, d):
    li = T(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", fn.linear("l_quantity", 2, 3).alias("lin"),
                     fn.recip("l_quantity", 0.5, 10, 1).alias("rec"))


@register("x08_scale_global_min_max", """
WITH m AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders)
SELECT o_orderkey, round((o_totalprice - mn) * 100.0 / (mx - mn) + 0.0, 9) AS scaled FROM orders, m
""")
def x08(spark, d):
    o = fn.scale(T(spark, d, "orders"), "o_totalprice", 0, 100)
    return o.select("o_orderkey", F.round("scaled", 9).alias("scaled"))


@register("x09_x10_div_mod_ieee", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN CAST(l_linenumber - 4 AS DOUBLE) <> 0 THEN l_tax / CAST(l_linenumber - 4 AS DOUBLE)
       WHEN l_tax > 0 THEN 'Infinity'::DOUBLE WHEN l_tax < 0 THEN '-Infinity'::DOUBLE ELSE 'NaN'::DOUBLE END AS q,
  CASE WHEN l_linenumber - 4 <> 0 THEN CAST(l_orderkey AS DOUBLE) - CAST(l_linenumber - 4 AS DOUBLE) * trunc(CAST(l_orderkey AS DOUBLE) / CAST(l_linenumber - 4 AS DOUBLE)) ELSE 'NaN'::DOUBLE END AS r
FROM lineitem
""")
def x09(spark, d):
    li = T(spark, d, "lineitem")
    den = F.col("l_linenumber") - 4
    return li.select("l_orderkey", "l_linenumber", fn.div(F.col("l_tax"), den).alias("q"),
                     fn.mod(F.col("l_orderkey"), den).alias("r"))


@register("x11_map_range", """
SELECT p_partkey, CASE WHEN p_size >= 10 AND p_size <= 20 THEN 1.0 ELSE 0.0 END AS m1,
       CASE WHEN p_size >= 10 AND p_size <= 20 THEN 100.0 ELSE CAST(p_size AS DOUBLE) END AS m2 FROM part
""")
def x11(spark, d):
    p = T(spark, d, "part")
    return p.select("p_partkey", fn.map_range("p_size", 10, 20, 1.0, 0.0).alias("m1"),
                    fn.map_range("p_size", 10, 20, 100.0).alias("m2"))


@register("x12_x16_arith_vector", f"""
SELECT l_orderkey, l_linenumber, abs(l_discount - 0.05) AS a, l_quantity + l_tax + {_LN} AS s,
       l_quantity * l_discount * 2.0 AS p, l_extendedprice - l_quantity AS d, [l_quantity, l_tax] AS v FROM lineitem
""")
def x12(spark, d):
    li = _li(spark, d)
    return li.select("l_orderkey", "l_linenumber", fn.abs_(F.col("l_discount") - 0.05).alias("a"),
                     fn.sum_("l_quantity", "l_tax", "ln").alias("s"), fn.product("l_quantity", "l_discount", 2.0).alias("p"),
                     fn.sub("l_extendedprice", "l_quantity").alias("d"), fn.vector("l_quantity", "l_tax").alias("v"))


@register("x19_x22_max_min_pow_hypot_atan2", """
SELECT p_partkey, greatest(CAST(p_size AS DOUBLE), 25.0) AS mx, least(CAST(p_size AS DOUBLE), 25.0) AS mn,
       pow(CAST(p_size AS DOUBLE), 2.0) AS pw, round(sqrt(p_size * p_size + 9.0), 9) AS hy,
       round(atan2(CAST(p_size AS DOUBLE), 7.0), 9) AS at FROM part
""")
def x19(spark, d):
    p = T(spark, d, "part")
    return p.select("p_partkey", fn.max_("p_size", 25.0).alias("mx"), fn.min_("p_size", 25.0).alias("mn"),
                    fn.pow_("p_size", 2.0).alias("pw"), F.round(F.hypot(fn.field("p_size"), F.lit(3.0)), 9).alias("hy"),
                    F.round(F.atan2(fn.field("p_size"), F.lit(7.0)), 9).alias("at"))


@register("x23_x30_math_functions", """
SELECT p_partkey, round(radians(p_size), 9) AS rad, round(degrees(p_size / 10.0), 9) AS deg, round(sqrt(p_size), 9) AS sq,
  round(cbrt(p_size), 9) AS cb, round(log10(p_size), 9) AS lg, round(ln(p_size), 9) AS lnv, round(exp(p_size / 10.0), 9) AS ex,
  round(sin(p_size), 9) AS si, round(cos(p_size), 9) AS co, round(tan(p_size / 100.0), 9) AS ta,
  round(asin(p_size / 50.0), 9) AS asn, round(acos(p_size / 50.0), 9) AS acs, round(atan(p_size), 9) AS atn,
  round(sinh(p_size / 10.0), 9) AS sh, round(cosh(p_size / 10.0), 9) AS ch, round(tanh(p_size / 10.0), 9) AS th,
  ceil(p_retailprice / 7) AS ce, floor(p_retailprice / 7) AS fl, round_even(p_size / 2.0, 0) AS ri,
  round(pi() * p_size, 9) AS pi_x, round(exp(1) * p_size, 9) AS e_x FROM part
""")
def x23(spark, d):
    p = T(spark, d, "part")
    s = fn.field("p_size")
    r9 = lambda c: F.round(c, 9)
    return p.select(
        "p_partkey", r9(F.radians(s)).alias("rad"), r9(F.degrees(s / 10)).alias("deg"), r9(F.sqrt(s)).alias("sq"),
        r9(F.cbrt(s)).alias("cb"), r9(fn.log(s)).alias("lg"), r9(fn.ln(s)).alias("lnv"), r9(F.exp(s / 10)).alias("ex"),
        r9(F.sin(s)).alias("si"), r9(F.cos(s)).alias("co"), r9(F.tan(s / 100)).alias("ta"),
        r9(F.asin(s / 50)).alias("asn"), r9(F.acos(s / 50)).alias("acs"), r9(F.atan(s)).alias("atn"),
        r9(F.sinh(s / 10)).alias("sh"), r9(F.cosh(s / 10)).alias("ch"), r9(F.tanh(s / 10)).alias("th"),
        F.ceil(F.col("p_retailprice") / 7).cast("double").alias("ce"),
        F.floor(F.col("p_retailprice") / 7).cast("double").alias("fl"), fn.rint(s / 2).alias("ri"),
        r9(F.pi() * s).alias("pi_x"), r9(F.e() * s).alias("e_x"))


@register("x31_x35_logic_exists_if_def", f"""
SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 3) IS NOT NULL AS ex,
  NOT (l_quantity > 25) AS n, (l_quantity > 25) AND (l_discount > 0.05) AS a, (l_quantity > 25) OR (l_discount > 0.05) AS o,
  ((l_quantity > 25) OR (l_discount > 0.05)) AND NOT ((l_quantity > 25) AND (l_discount > 0.05)) AS x,
  CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END AS i,
  coalesce(nullif(l_linenumber, 3), l_suppkey) AS df, true AS t, false AS f FROM lineitem
""")
def x31(spark, d):
    li = _li(spark, d)
    q, dd = F.col("l_quantity") > 25, F.col("l_discount") > 0.05
    return li.select("l_orderkey", "l_linenumber", fn.exists("ln").alias("ex"), fn.not_(q).alias("n"),
                     fn.and_(q, dd).alias("a"), fn.or_(q, dd).alias("o"), fn.xor(q, dd).alias("x"),
                     fn.if_(F.col("l_returnflag") == "R", "l_quantity", 0.0).alias("i"),
                     fn.def_("ln", "l_suppkey").alias("df"), F.lit(True).alias("t"), F.lit(False).alias("f"))


@register("x36_ms_date_difference", """
SELECT o_orderkey, epoch_ms(o_orderdate) AS ms_a, epoch_ms(o_orderdate) - epoch_ms(TIMESTAMP '1995-01-01') AS ms_ab FROM orders
""")
def x36(spark, d):
    o = T(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    return o.select("o_orderkey", fn.ms("t").alias("ms_a"),
                    fn.ms(F.col("t"), F.lit("1995-01-01 00:00:00").cast("timestamp")).alias("ms_ab"))


_V = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
_W = "list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 0.5 + 0.25)"


@register("x37_x38_vector_distances", f"""
WITH e AS (SELECT vec_id, {_V} AS a, {_W} AS b FROM embeddings),
z AS (SELECT vec_id, list_transform(list_zip(a, b), lambda p: abs(p[1] - p[2])) AS dd FROM e)
SELECT vec_id, round(list_sum(list_transform(dd, lambda x: CASE WHEN x <> 0 THEN 1.0 ELSE 0.0 END)), 6) AS d0,
  round(list_sum(dd), 6) AS d1, round(sqrt(list_sum(list_transform(dd, lambda x: x * x))), 6) AS d2,
  round(list_max(dd), 6) AS dinf, round(list_sum(list_transform(dd, lambda x: x * x)), 6) AS sq FROM z
""")
def x37(spark, d):
    e = T(spark, d, "embeddings")
    a = F.transform("embedding", lambda x: x.cast("double"))
    b = F.transform("embedding", lambda x: x.cast("double") * 0.5 + 0.25)
    r6 = lambda c: F.round(c, 6)
    return e.select("vec_id", r6(fn.dist(0, a, b)).alias("d0"), r6(fn.dist(1, a, b)).alias("d1"),
                    r6(fn.dist(2, a, b)).alias("d2"), r6(fn.dist(float("inf"), a, b)).alias("dinf"),
                    r6(fn.sqedist(a, b)).alias("sq"))


_GEO = "CAST(c_custkey % 180 AS DOUBLE) - 90 + 0.5"
_GEO_LON = "CAST((c_custkey * 7) % 360 AS DOUBLE) - 180 + 0.25"


@register("x39_x40_haversine_geodist", f"""
WITH g AS (SELECT c_custkey, {_GEO} AS lat, {_GEO_LON} AS lon FROM customer),
h AS (SELECT c_custkey, pow(sin((radians(48.85) - radians(lat)) / 2), 2)
        + cos(radians(lat)) * cos(radians(48.85)) * pow(sin((radians(2.35) - radians(lon)) / 2), 2) AS h FROM g)
SELECT c_custkey, round(2 * 6371.0087714 * atan2(sqrt(h), sqrt(1 - h)), 6) AS geodist,
       round(2 * 1.0 * atan2(sqrt(h), sqrt(1 - h)), 9) AS hsin_unit FROM h
""")
def x39(spark, d):
    c = T(spark, d, "customer")
    lat = (F.col("c_custkey") % 180).cast("double") - 90 + 0.5
    lon = ((F.col("c_custkey") * 7) % 360).cast("double") - 180 + 0.25
    return c.select("c_custkey", F.round(fn.geodist(lat, lon, 48.85, 2.35), 6).alias("geodist"),
                    F.round(fn.hsin(1.0, lat, lon, F.lit(48.85), F.lit(2.35)), 9).alias("hsin_unit"))


@register("x41_geohash_encode")
def x41(spark, d):
    c = T(spark, d, "customer")
    lat = (F.col("c_custkey") % 180).cast("double") - 90 + 0.5
    lon = ((F.col("c_custkey") * 7) % 360).cast("double") - 180 + 0.25
    return c.select("c_custkey", fn.geohash(lat, lon, 9).alias("geohash"))


@register("x42_geohash_haversine")
def x42(spark, d):
    c = T(spark, d, "customer")
    lat = (F.col("c_custkey") % 180).cast("double") - 90 + 0.5
    lon = ((F.col("c_custkey") * 7) % 360).cast("double") - 180 + 0.25
    g = c.select("c_custkey", fn.geohash(lat, lon, 9).alias("gh"))
    return g.select("c_custkey", fn.ghhsin(6371.0087714, F.col("gh"), F.lit("u09tvw0f6")).alias("km"))


@register("x43_strdist_edit", """
SELECT p_partkey, round(CASE WHEN greatest(length(p_name), length(p_type)) = 0 THEN 1.0
  ELSE 1.0 - levenshtein(p_name, lower(p_type)) / greatest(length(p_name), length(p_type)) END, 9) AS sim FROM part
""")
def x43(spark, d):
    p = T(spark, d, "part")
    return p.select("p_partkey", F.round(fn.strdist_edit(F.col("p_name"), F.lower("p_type")), 9).alias("sim"))


@register("x44_strdist_jaro_winkler_distinct_pairs", """
WITH pairs AS (SELECT DISTINCT p_name, lower(p_type) AS t FROM part)
SELECT p_name, t, round(jaro_winkler_similarity(p_name, t), 6) AS jw FROM pairs
""")
def x44(spark, d):
    pairs = T(spark, d, "part").select("p_name", F.lower("p_type").alias("t")).distinct()
    return pairs.select("p_name", "t", F.round(fn.strdist_jw(F.col("p_name"), F.col("t")), 6).alias("jw"))


@register("x45_strdist_ngram_distinct_pairs")
def x45(spark, d):
    pairs = T(spark, d, "part").select("p_name", F.lower("p_type").alias("t")).distinct()
    return pairs.select("p_name", "t", fn.strdist_ngram(F.col("p_name"), F.col("t"), 2).alias("ng"))


@register("x46_currency_convert", """
WITH r AS (SELECT * FROM (VALUES ('EUR', 'USD', 1.25), ('USD', 'JPY', 150.0), ('GBP', 'USD', 1.5)) t(f, "to", rate)),
c AS (SELECT c_custkey, c_acctbal, CASE c_nationkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS code FROM customer)
SELECT c_custkey, code, round(c_acctbal * CASE WHEN code = 'USD' THEN 1.0 WHEN code = 'EUR' THEN 1.25
  WHEN code = 'GBP' THEN 1.5 WHEN code = 'JPY' THEN 1.0 / 150.0 END, 6) AS converted FROM c
""")
def x46(spark, d):
    c = T(spark, d, "customer")
    code = F.element_at(F.array(*[F.lit(x) for x in ("USD", "EUR", "GBP", "JPY")]), (F.col("c_nationkey") % 4 + 1).cast("int"))
    c = c.select("c_custkey", "c_acctbal", code.alias("code"))
    rates = spark.createDataFrame([("EUR", "USD", 1.25), ("USD", "JPY", 150.0), ("GBP", "USD", 1.5)],
                                  "from string, to string, rate double")
    out = fn.convert_currency(c, "c_acctbal", "code", "USD", rates)
    return out.select("c_custkey", "code", F.round("converted", 6).alias("converted"))


_TOK = """tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents),
dl AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS dl FROM documents)"""


@register("x47_x53_index_functions", f"""
WITH {_TOK},
st AS (SELECT count(DISTINCT doc_id) AS df, count(*) AS ttf FROM tok WHERE term = 'eau'),
tf AS (SELECT doc_id, count(*) AS tf FROM tok WHERE term = 'eau' GROUP BY doc_id)
SELECT dl.doc_id, st.df AS docfreq, st.ttf AS totaltermfreq, (SELECT count(*) FROM tok) AS sumtotaltermfreq,
  round(1.0 + ln((SELECT count(*) FROM documents) / (st.df + 1.0)), 9) AS idf,
  coalesce(tf.tf, 0) AS termfreq, round(sqrt(coalesce(tf.tf, 0)), 9) AS tf,
  round(CASE WHEN dl.dl > 0 THEN 1.0 / sqrt(dl.dl) END, 9) AS norm,
  (SELECT count(*) FROM documents) AS maxdoc, (SELECT count(*) FROM documents) AS numdocs
FROM dl CROSS JOIN st LEFT JOIN tf USING (doc_id)
""")
def x47(spark, d):
    from searchlake.functions import index_functions as xf
    idx = ix.build_index(T(spark, d, "documents"), "doc_id", "text")
    return xf.index_function_table(idx, T(spark, d, "documents").select("doc_id"), "eau")


@register("x54_date_math_on_columns", """
SELECT o_orderkey,
  date_trunc('day', o_orderdate) + INTERVAL 6 MONTH + INTERVAL 3 DAY AS a,
  date_trunc('day', o_orderdate + INTERVAL 6 MONTH + INTERVAL 3 DAY) AS b,
  date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS c,
  o_orderdate + INTERVAL 2 YEAR - INTERVAL 1 HOUR AS e FROM orders
""")
def x54(spark, d):
    o = T(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    ntz = lambda c: c.cast("timestamp_ntz")
    return o.select("o_orderkey", ntz(datemath.date_math("t", "/DAY+6MONTHS+3DAYS")).alias("a"),
                    ntz(datemath.date_math("t", "+6MONTHS+3DAYS/DAY")).alias("b"),
                    ntz(datemath.date_math("t", "/MONTH-1DAY")).alias("c"),
                    ntz(datemath.date_math("t", "+2YEARS-1HOUR")).alias("e"))


@register("x55_date_sortable_string_resolution", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month_res, strftime(o_orderdate, '%Y%m%d%H%M%S') AS second_res FROM orders
""")
def x55(spark, d):
    o = T(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    return o.select("o_orderkey", datemath.to_sortable_string("t", "MONTH").alias("month_res"),
                    datemath.to_sortable_string("t", "SECOND").alias("second_res"))


# ------------------------------------------------------------------ projections

@register("r01_field_list_glob_rename", "SELECT l_orderkey AS id, l_quantity AS qty, l_returnflag, l_linestatus FROM lineitem")
def r01(spark, d):
    return pj.project(T(spark, d, "lineitem"), "id:l_orderkey, qty:l_quantity, l_*flag, l_linestatus")


@register("r02_r04_function_and_value_pseudo_fields", """
SELECT o_orderkey, o_totalprice / 1000 AS k_price, CAST(42 AS INTEGER) AS answer, 'web' AS src FROM orders
""")
def r02(spark, d):
    o = T(spark, d, "orders")
    out = pj.project(o, "o_orderkey", k_price=F.col("o_totalprice") / 1000)
    out = pj.with_value(out, "answer", 42, "int")
    return pj.with_value(out, "src", "web", "string")


@register("r03_score_pseudo_field", """
WITH s AS (SELECT o_orderkey, o_totalprice / 500000 AS score FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, score FROM s
""")
def r03(spark, d):
    o = T(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    from searchlake.operators.scoring import num_found  # noqa: F401
    hits = o.select("o_orderkey", (F.col("o_totalprice") / 500000).alias("score"))
    return pj.project(hits, "o_orderkey, score")


@register("r05_explain_bm25_per_term", f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS term FROM documents),
dl AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS dl FROM documents),
fs AS (SELECT count(*) AS n, sum(dl) / count(*) AS avgdl FROM dl),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term IN ('ment', 'eau') GROUP BY ALL),
st AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT tf.doc_id, tf.term, tf.tf, st.df, round(ln(1.0 + (fs.n - st.df + 0.5) / (st.df + 0.5)), 9) AS idf,
  round(1.2 * (0.25 + 0.75 * dl.dl / fs.avgdl), 9) AS norm,
  round(ln(1.0 + (fs.n - st.df + 0.5) / (st.df + 0.5)) * (tf.tf * 2.2) / (tf.tf + 1.2 * (0.25 + 0.75 * dl.dl / fs.avgdl)), 9) AS weight
FROM tf JOIN st USING (term) JOIN dl USING (doc_id) CROSS JOIN fs
""")
def r05(spark, d):
    from searchlake.operators.scoring import explain_scores
    idx = ix.build_index(T(spark, d, "documents"), "doc_id", "text")
    e = explain_scores(idx, ["ment", "eau"])
    return e.select("doc_id", "term", "tf", "df", F.round("idf", 9).alias("idf"), F.round("norm", 9).alias("norm"), F.round("weight", 9).alias("weight"))


@register("r07_source_marker")
def r07(spark, d):
    return pj.with_source(T(spark, d, "region"))
