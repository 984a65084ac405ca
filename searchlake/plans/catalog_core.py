"""Queries over the star-schema tables: scans, predicates, facets, stats, grouping, sorting, sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from searchlake.operators import facets as fc
from searchlake.operators import filters as flt
from searchlake.operators import grouping as grp
from searchlake.operators import sets, sorting, stats
from searchlake.plans.registry import register
from searchlake.plans.search import Search
from searchlake.session import table as T


# ------------------------------------------------------------------ flagship

def flagship(spark, d):
    orders = T(spark, d, "orders")
    s = (Search(orders, "o_orderkey")
         .query(flt.term("o_orderstatus", "O"))
         .filter(flt.num_range("o_totalprice", 100000.0, 400000.0))
         .sort("o_totalprice desc")
         .page(0, 10)
         .facet_field("o_orderpriority")
         .facet_range("o_orderdate", "1995-01-01T00:00:00Z", "2002-01-01T00:00:00Z", "+1YEAR")
         .stats("o_totalprice"))
    return s.summary()


register("c01_search_orders_flagship", """
WITH m AS (SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 100000.0 AND o_totalprice <= 400000.0),
yrs AS (SELECT range AS low, range + INTERVAL 1 YEAR AS high
        FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 YEAR))
SELECT 'num_found' AS section, '' AS name, NULL::VARCHAR AS label, count(*) AS count, NULL::DOUBLE AS value FROM m
UNION ALL
SELECT 'response', CAST(o_orderkey AS VARCHAR), CAST(rank AS VARCHAR), NULL, o_totalprice FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM m
) WHERE rank <= 10
UNION ALL
SELECT 'facet_field', 'o_orderpriority', o_orderpriority, count(*), NULL FROM m WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
UNION ALL
SELECT 'facet_range', 'o_orderdate', strftime(y.low, '%Y-%m-%d %H:%M:%S'), count(m.o_orderdate), NULL
FROM yrs y LEFT JOIN m ON m.o_orderdate >= y.low AND m.o_orderdate < y.high GROUP BY y.low
UNION ALL
SELECT 'stats', 'o_totalprice', s.label, s.count, s.value FROM (
  SELECT 'min' AS label, count(o_totalprice) AS count, round(min(o_totalprice), 6) AS value FROM m
  UNION ALL SELECT 'max', count(o_totalprice), round(max(o_totalprice), 6) FROM m
  UNION ALL SELECT 'sum', count(o_totalprice), round(sum(o_totalprice), 6) FROM m
  UNION ALL SELECT 'mean', count(o_totalprice), round(avg(o_totalprice), 6) FROM m
  UNION ALL SELECT 'stddev', count(o_totalprice), round(coalesce(stddev_samp(o_totalprice), 0), 6) FROM m
) s
""")(flagship)


# ------------------------------------------------------------------ scans

@register("s01_scan_all_orders", "SELECT * FROM orders")
def s01(spark, d):
    return T(spark, d, "orders")


@register("s02_scan_many_union_by_name", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name, NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal
FROM customer
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def s02(spark, d):
    from searchlake.sources.readers import scan_many
    return scan_many(spark, [f"{d}/customer.parquet", f"{d}/supplier.parquet"])


# ------------------------------------------------------------------ predicates

@register("f01_term_untokenized", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def f01(spark, d):
    return T(spark, d, "orders").filter(flt.term("o_orderpriority", "1-URGENT")).select("o_orderkey", "o_orderpriority")


@register("f03_terms_set", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (1, 7, 42, 99)")
def f03(spark, d):
    return T(spark, d, "lineitem").filter(flt.terms("l_suppkey", [1, 7, 42, 99])) \
        .select("l_orderkey", "l_linenumber", "l_suppkey")


@register("f04_prefix", "SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1')")
def f04(spark, d):
    return T(spark, d, "part").filter(flt.prefix("p_brand", "Brand#1")).select("p_partkey", "p_brand")


@register("f05_wildcard", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'sm_ll %g%'")
def f05(spark, d):
    return T(spark, d, "part").filter(flt.wildcard("p_name", "sm?ll *g*")).select("p_partkey", "p_name")


@register("f06_regexp_whole_term",
          "SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#(1[0-9]|2[05])')")
def f06(spark, d):
    return T(spark, d, "part").filter(flt.regexp("p_brand", "Brand#(1[0-9]|2[05])")).select("p_partkey", "p_brand")


@register("f08_term_range_lexicographic", """
SELECT c_custkey, c_name FROM customer WHERE c_name >= 'Customer#000000100' AND c_name < 'Customer#000000250'
""")
def f08(spark, d):
    return T(spark, d, "customer").filter(
        flt.term_range("c_name", "Customer#000000100", "Customer#000000250", True, False)).select("c_custkey", "c_name")


@register("f09_numeric_range", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 20
""")
def f09(spark, d):
    return T(spark, d, "lineitem").filter(flt.num_range("l_quantity", 10.0, 20.0, True, False)) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@register("f11_multivalued_any_in_range", """
SELECT p_partkey FROM part WHERE list_has_any([p_size, p_size * 3], [40,41,42,43,44,45,46,47,48,49,50])
""")
def f11(spark, d):
    p = T(spark, d, "part").withColumn("sizes", F.array(F.col("p_size"), F.col("p_size") * 3))
    return p.filter(flt.any_in_range("sizes", 40, 50)).select("p_partkey")


@register("f12_date_range_date_math", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-07-01 00:00:00'
""")
def f12(spark, d):
    now = dt.datetime(1998, 8, 2, 13, 45, 10)
    pred = flt.date_range("o_orderdate", "NOW/YEAR-1YEAR", "NOW/YEAR-18MONTHS+12MONTHS", True, False, now=now)
    return T(spark, d, "orders").filter(pred).select("o_orderkey", "o_orderdate")


@register("f13_missing_value", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE nullif(l_linenumber, 3) IS NULL
""")
def f13(spark, d):
    li = T(spark, d, "lineitem").withColumn("ln", F.nullif(F.col("l_linenumber"), F.lit(3)))
    return li.filter(flt.missing("ln")).select("l_orderkey", "l_linenumber")


@register("f14_boolean_must_should_not", """
SELECT o_orderkey FROM orders
WHERE o_orderstatus = 'O'
  AND ((o_orderpriority = '1-URGENT')::INT + (o_orderpriority = '2-HIGH')::INT + (o_totalprice > 400000)::INT) >= 1
  AND NOT (o_totalprice < 50000)
""")
def f14(spark, d):
    pred = flt.bool_query(must=[F.col("o_orderstatus") == "O"],
                          should=[F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH",
                                  F.col("o_totalprice") > 400000],
                          must_not=[F.col("o_totalprice") < 50000], min_should_match=1)
    return T(spark, d, "orders").filter(pred).select("o_orderkey")


@register("f15_min_should_match_percent", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE ((l_returnflag = 'R')::INT + (l_quantity > 25)::INT + (l_discount >= 0.05)::INT + (l_tax > 0.04)::INT) >= 3
""")
def f15(spark, d):
    should = [F.col("l_returnflag") == "R", F.col("l_quantity") > 25, F.col("l_discount") >= 0.05,
              F.col("l_tax") > 0.04]
    k = flt.min_should_match(len(should), "75%")
    return T(spark, d, "lineitem").filter(flt.bool_query(should=should, min_should_match=k)) \
        .select("l_orderkey", "l_linenumber")


@register("f22_function_range", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE coalesce(CAST(nullif(l_linenumber, 3) AS DOUBLE), 0) + l_discount * 10 >= 1.0
  AND coalesce(CAST(nullif(l_linenumber, 3) AS DOUBLE), 0) + l_discount * 10 < 2.0
""")
def f22(spark, d):
    from searchlake.functions import scalar as fn
    li = T(spark, d, "lineitem").withColumn("ln", F.nullif(F.col("l_linenumber"), F.lit(3)))
    expr = fn.sum_(fn.field("ln"), fn.product("l_discount", 10))
    return li.filter(flt.frange(expr, 1.0, 2.0, True, False)).select("l_orderkey", "l_linenumber")


@register("f40_positive_scores_only", """
SELECT o_orderkey, o_totalprice / 100000 - 2 AS score FROM orders WHERE o_totalprice / 100000 - 2 > 0
""")
def f40(spark, d):
    from searchlake.operators.scoring import positive_only
    hits = T(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 100000 - 2).alias("score"))
    return positive_only(hits)


# geo columns derived deterministically from keys, in Spark and in SQL alike
GEO_SQL = "CAST(c_custkey % 180 AS DOUBLE) - 90 + 0.5"
GEO_LON_SQL = "CAST((c_custkey * 7) % 360 AS DOUBLE) - 180 + 0.25"


def _geo_customers(spark, d):
    c = T(spark, d, "customer")
    return c.withColumn("lat", (F.col("c_custkey") % 180).cast("double") - 90 + 0.5) \
        .withColumn("lon", ((F.col("c_custkey") * 7) % 360).cast("double") - 180 + 0.25)


_HAV = ("2 * 6371.0087714 * asin(least(1.0, sqrt(pow(sin((radians({la}) - radians(lat)) / 2), 2) + "
        "cos(radians(lat)) * cos(radians({la})) * pow(sin((radians({lo}) - radians(lon)) / 2), 2))))")


@register("f35_geofilt_circle", f"""
WITH g AS (SELECT c_custkey, {GEO_SQL} AS lat, {GEO_LON_SQL} AS lon FROM customer)
SELECT c_custkey FROM g WHERE {_HAV.format(la=10.0, lo=175.0)} <= 2500
""")
def f35(spark, d):
    return _geo_customers(spark, d).filter(flt.geofilt("lat", "lon", 10.0, 175.0, 2500.0)).select("c_custkey")


@register("f36_bbox_dateline", f"""
WITH g AS (SELECT c_custkey, {GEO_SQL} AS lat, {GEO_LON_SQL} AS lon FROM customer)
SELECT c_custkey FROM g WHERE lat BETWEEN {{la_lo}} AND {{la_hi}} AND ({{lon_pred}})
""")
def f36(spark, d):
    return _geo_customers(spark, d).filter(flt.bbox("lat", "lon", 10.0, 175.0, 2500.0)).select("c_custkey")


def _bbox_sql():
    la_lo, la_hi, lons = flt.bbox_ranges(10.0, 175.0, 2500.0)
    lon_pred = " OR ".join(f"(lon >= {a!r} AND lon <= {b!r})" for a, b in lons)
    from searchlake.plans import registry
    registry.ORACLE["f36_bbox_dateline"] = registry.ORACLE["f36_bbox_dateline"].replace(
        "{la_lo}", repr(la_lo)).replace("{la_hi}", repr(la_hi)).replace("{lon_pred}", lon_pred)


_bbox_sql()


@register("f37_point_rectangle_range", f"""
WITH g AS (SELECT c_custkey, {GEO_SQL} AS lat, {GEO_LON_SQL} AS lon FROM customer)
SELECT c_custkey FROM g WHERE lat >= -20 AND lat <= 35.5 AND lon >= -100 AND lon <= 20
""")
def f37(spark, d):
    return _geo_customers(spark, d).filter(flt.point_range(["lat", "lon"], [-20, -100], [35.5, 20])) \
        .select("c_custkey")


@register("f41_ip_subnet", """
WITH e AS (SELECT event_id, '10.0.' || CAST(user_id % 4 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS ip
           FROM events)
SELECT event_id, ip FROM e WHERE NOT (ip LIKE '10.0.1.%')
""")
def f41(spark, d):
    e = T(spark, d, "events").withColumn(
        "ip", F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("user_id") % 4).cast("string"),
                          (F.col("event_id") % 256).cast("string")))
    return e.filter(~flt.in_subnet("ip", "10.0.1.0/24")).select("event_id", "ip")


# ------------------------------------------------------------------ facets

@register("a01_num_found_max_score", """
SELECT count(*) AS num_found, max(o_totalprice) AS max_score FROM orders WHERE o_orderstatus = 'O'
""")
def a01(spark, d):
    from searchlake.operators.scoring import num_found
    hits = T(spark, d, "orders").filter(flt.term("o_orderstatus", "O")).withColumnRenamed("o_totalprice", "score")
    return num_found(hits)


@register("a02_facet_field_returnflag", """
SELECT l_returnflag, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) AS rank
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag QUALIFY rank <= 100
""")
def a02(spark, d):
    return fc.facet_field(T(spark, d, "lineitem"), "l_returnflag")


@register("a02_facet_field_limit_offset_index_sort", """
SELECT l_suppkey, count(*) AS count, row_number() OVER (ORDER BY l_suppkey) AS rank
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey QUALIFY rank > 5 AND rank <= 25
""")
def a02b(spark, d):
    return fc.facet_field(T(spark, d, "lineitem"), "l_suppkey", sort="index", offset=5, limit=20)


@register("a02_facet_field_all_values", """
SELECT o_custkey, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS rank
FROM orders GROUP BY o_custkey
""")
def a02c(spark, d):
    return fc.facet_field(T(spark, d, "orders"), "o_custkey", limit=-1)


@register("a03_facet_multivalued_words", """
WITH w AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS words FROM part)
SELECT words, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, words) AS rank
FROM w GROUP BY words QUALIFY rank <= 100
""")
def a03(spark, d):
    p = T(spark, d, "part").withColumn("words", F.split("p_name", " "))
    return fc.facet_field(p, "words")


@register("a06_facet_mincount_zero", """
SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal > 9900) AS count,
       row_number() OVER (ORDER BY count(*) FILTER (WHERE c_acctbal > 9900) DESC, c_mktsegment) AS rank
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment QUALIFY rank <= 100
""")
def a06(spark, d):
    return fc.facet_field(T(spark, d, "customer"), "c_mktsegment", where=F.col("c_acctbal") > 9900)


@register("a07_facet_missing_row", """
SELECT ln, count(*) AS count,
       CASE WHEN ln IS NULL THEN NULL ELSE row_number() OVER (ORDER BY ln IS NULL, count(*) DESC, ln) END AS rank
FROM (SELECT nullif(l_linenumber, 3) AS ln FROM lineitem) GROUP BY ln
""")
def a07(spark, d):
    li = T(spark, d, "lineitem").select(F.nullif(F.col("l_linenumber"), F.lit(3)).alias("ln"))
    return fc.facet_field(li, "ln", missing=True)


@register("a08_facet_prefix", """
SELECT p_brand, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rank
FROM part WHERE starts_with(p_brand, 'Brand#2') GROUP BY p_brand QUALIFY rank <= 100
""")
def a08(spark, d):
    return fc.facet_field(T(spark, d, "part"), "p_brand", prefix="Brand#2")


@register("a09_facet_listed_terms", """
SELECT t.o_orderpriority, count(o.o_orderkey) AS count
FROM (VALUES ('1-URGENT'), ('5-LOW'), ('9-NONE')) t(o_orderpriority)
LEFT JOIN orders o ON o.o_orderpriority = t.o_orderpriority AND o.o_orderstatus = 'F'
GROUP BY t.o_orderpriority
""")
def a09(spark, d):
    return fc.facet_terms(T(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW", "9-NONE"],
                          where=F.col("o_orderstatus") == "F")


@register("a10_facet_queries", """
SELECT 'small' AS name, count(*) FILTER (WHERE l_quantity < 10) AS count FROM lineitem
UNION ALL SELECT 'mid', count(*) FILTER (WHERE l_quantity >= 10 AND l_quantity <= 30) FROM lineitem
UNION ALL SELECT 'discounted', count(*) FILTER (WHERE l_discount > 0.05) FROM lineitem
""")
def a10(spark, d):
    q = {"small": F.col("l_quantity") < 10, "mid": F.col("l_quantity").between(10, 30),
         "discounted": F.col("l_discount") > 0.05}
    return fc.facet_queries(T(spark, d, "lineitem"), q)


_RANGE_NUM_SQL = """
WITH b AS (SELECT CAST(i AS INTEGER) AS bucket, CAST(i * 50000 AS DOUBLE) AS low, CAST((i + 1) * 50000 AS DOUBLE) AS high
           FROM range(0, 10) t(i))
SELECT b.bucket, 'range' AS label, b.low, b.high, count(o.o_totalprice) AS count
FROM b LEFT JOIN orders o ON o.o_totalprice {lo_op} b.low AND o.o_totalprice {hi_op} b.high
GROUP BY b.bucket, b.low, b.high
UNION ALL SELECT NULL, 'before', NULL, NULL, count(*) FILTER (WHERE o_totalprice {before}) FROM orders
UNION ALL SELECT NULL, 'after', NULL, NULL, count(*) FILTER (WHERE o_totalprice {after}) FROM orders
UNION ALL SELECT NULL, 'between', NULL, NULL, count(*) FILTER (WHERE o_totalprice {between}) FROM orders
"""


@register("a11_facet_range_numeric", _RANGE_NUM_SQL.format(
    lo_op=">=", hi_op="<", before="< 0", after=">= 500000", between=">= 0 AND o_totalprice < 500000"))
def a11(spark, d):
    return fc.facet_range(T(spark, d, "orders"), "o_totalprice", 0, 500000, 50000, other="all")


@register("a11_facet_range_include_upper_outer", _RANGE_NUM_SQL.format(
    lo_op=">", hi_op="<=", before="<= 0", after=">= 500000", between="> 0 AND o_totalprice <= 500000"))
def a11b(spark, d):
    return fc.facet_range(T(spark, d, "orders"), "o_totalprice", 0, 500000, 50000,
                          include=["upper", "outer"], other="all")


@register("a11_facet_range_hardend_edge", """
WITH b AS (SELECT CAST(i AS INTEGER) AS bucket, CAST(1000 + i * 30000 AS DOUBLE) AS low,
                  CAST(least(1000 + (i + 1) * 30000, 100000) AS DOUBLE) AS high FROM range(0, 4) t(i))
SELECT b.bucket, 'range' AS label, b.low, b.high, count(o.o_totalprice) AS count
FROM b LEFT JOIN orders o ON o.o_totalprice >= b.low
  AND (o.o_totalprice < b.high OR (b.bucket = 3 AND o.o_totalprice = b.high))
GROUP BY b.bucket, b.low, b.high
""")
def a11c(spark, d):
    return fc.facet_range(T(spark, d, "orders"), "o_totalprice", 1000, 100000, 30000,
                          hardend=True, include=["lower", "edge"])


@register("a12_facet_range_date_month", """
WITH b AS (SELECT CAST(row_number() OVER (ORDER BY range) - 1 AS INTEGER) AS bucket, range AS low,
                  range + INTERVAL 1 MONTH AS high
           FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-09-01', INTERVAL 1 MONTH))
SELECT b.bucket, 'range' AS label, b.low, b.high, count(o.o_orderdate) AS count
FROM b LEFT JOIN orders o ON o.o_orderdate >= b.low AND o.o_orderdate < b.high
GROUP BY b.bucket, b.low, b.high
UNION ALL SELECT NULL, 'before', NULL, NULL, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1995-01-01') FROM orders
UNION ALL SELECT NULL, 'after', NULL, NULL, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-09-01') FROM orders
UNION ALL SELECT NULL, 'between', NULL, NULL,
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2001-09-01') FROM orders
""")
def a12(spark, d):
    return fc.facet_range(T(spark, d, "orders"), "o_orderdate", "1995-01-01T00:00:00Z",
                          "2001-09-01T00:00:00Z", "+1MONTH", other="all")


_PIVOT_SQL = """
SELECT 1 AS level, l_returnflag, NULL::VARCHAR AS l_linestatus, NULL::INTEGER AS l_linenumber, count(*) AS count,
       row_number() OVER (ORDER BY count(*) DESC, l_returnflag) AS rank
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
UNION ALL
SELECT 2, l_returnflag, l_linestatus, NULL, count(*),
       row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_linestatus)
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY l_returnflag, l_linestatus
UNION ALL
SELECT 3, l_returnflag, l_linestatus, l_linenumber, count(*),
       row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY count(*) DESC, l_linenumber)
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_returnflag, l_linestatus, l_linenumber
"""


@register("a13_facet_pivot_three_levels", _PIVOT_SQL)
def a13(spark, d):
    return fc.facet_pivot(T(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@register("a13_facet_pivot_limit_mincount", """
WITH l1 AS (SELECT o_orderstatus, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS rank
            FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1 QUALIFY rank <= 2),
l2 AS (SELECT o_orderstatus, o_orderpriority, count(*) AS count,
              row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority) AS rank
       FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2 QUALIFY rank <= 2),
k1 AS (SELECT * FROM l1 WHERE count >= 2 AND (SELECT count(*) FROM l2 WHERE l2.o_orderstatus = l1.o_orderstatus) >= 2)
SELECT 1 AS level, o_orderstatus, NULL::VARCHAR AS o_orderpriority, count, rank FROM k1
UNION ALL
SELECT 2, o_orderstatus, o_orderpriority, count, rank FROM l2
WHERE count >= 2 AND o_orderstatus IN (SELECT o_orderstatus FROM k1)
""")
def a13b(spark, d):
    return fc.facet_pivot(T(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], mincount=2, limit=2)


@register("a14_facet_grouped_distinct_customers", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS count,
       row_number() OVER (ORDER BY count(DISTINCT o_custkey) DESC, o_orderpriority) AS rank
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus = 'P' GROUP BY o_orderpriority
""")
def a14(spark, d):
    return fc.facet_field(T(spark, d, "orders"), "o_orderpriority", where=F.col("o_orderstatus") == "P",
                          group_by="o_custkey")


@register("a15_facet_query_grouped", """
SELECT 'big' AS name, count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 300000) AS count FROM orders
UNION ALL SELECT 'urgent', count(DISTINCT o_custkey) FILTER (WHERE o_orderpriority = '1-URGENT') FROM orders
""")
def a15(spark, d):
    q = {"big": F.col("o_totalprice") > 300000, "urgent": F.col("o_orderpriority") == "1-URGENT"}
    return fc.facet_queries(T(spark, d, "orders"), q, group_by="o_custkey")


@register("a16_multi_select_tag_exclude", """
SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, count(*) AS count FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000 GROUP BY o_orderstatus
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 100000 GROUP BY o_orderpriority
""")
def a16(spark, d):
    from searchlake.operators.facets import multi_select_facets
    filters = {"st": F.col("o_orderstatus") == "O", "pr": F.col("o_orderpriority") == "1-URGENT",
               None: F.col("o_totalprice") > 100000}
    return multi_select_facets(T(spark, d, "orders"), filters,
                               {"o_orderstatus": ["st"], "o_orderpriority": ["pr"]})


# ------------------------------------------------------------------ stats

@register("a17_stats_numeric", """
SELECT min(l_extendedprice) AS min, max(l_extendedprice) AS max, count(l_extendedprice) AS count,
       count(*) - count(l_extendedprice) AS missing, round(sum(l_extendedprice), 4) AS sum,
       round(sum(l_extendedprice * l_extendedprice), 0) AS sum_of_squares,
       round(avg(l_extendedprice), 6) AS mean, round(coalesce(stddev_samp(l_extendedprice), 0), 6) AS stddev
FROM lineitem
""")
def a17(spark, d):
    s = stats.stats_field(T(spark, d, "lineitem"), "l_extendedprice")
    return s.select("min", "max", "count", "missing", F.round("sum", 4).alias("sum"),
                    F.round("sum_of_squares", 0).alias("sum_of_squares"),
                    F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"))


@register("a18_stats_date", """
SELECT min(o_orderdate) AS min, max(o_orderdate) AS max, count(o_orderdate) AS count,
       count(*) - count(o_orderdate) AS missing, CAST(sum(epoch_ms(o_orderdate)) AS BIGINT) AS sum,
       epoch_ms(CAST(floor(sum(epoch_ms(o_orderdate)) / count(o_orderdate)) AS BIGINT)) AS mean,
       round(coalesce(stddev_samp(epoch_ms(o_orderdate)), 0) / 86400000.0, 6) AS stddev_days
FROM orders
""")
def a18(spark, d):
    s = stats.stats_field(T(spark, d, "orders"), "o_orderdate")
    return s.select("min", "max", "count", "missing", "sum", "mean",
                    F.round(F.col("stddev") / 86400000.0, 6).alias("stddev_days"))


@register("a19_stats_string", """
SELECT min(c_name) AS min, max(c_name) AS max, count(c_name) AS count, count(*) - count(c_name) AS missing
FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name FROM customer)
""")
def a19(spark, d):
    c = T(spark, d, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")))
    return stats.stats_field(c, "c_name")


@register("a20_stats_per_facet_value", """
SELECT l_returnflag, min(l_quantity) AS min, max(l_quantity) AS max, count(l_quantity) AS count,
       round(sum(l_quantity), 4) AS sum, round(avg(l_quantity), 6) AS mean,
       round(coalesce(stddev_samp(l_quantity), 0), 6) AS stddev
FROM lineitem GROUP BY l_returnflag
""")
def a20(spark, d):
    s = stats.stats_field(T(spark, d, "lineitem"), "l_quantity", facet="l_returnflag")
    return s.select("l_returnflag", "min", "max", "count", F.round("sum", 4).alias("sum"),
                    F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"))


@register("a21_stats_multivalued", """
WITH x AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN []::INTEGER[] ELSE [p_size, p_size * 2] END AS arr FROM part),
v AS (SELECT CAST(unnest(arr) AS DOUBLE) AS x FROM x)
SELECT (SELECT min(x) FROM v) AS min, (SELECT max(x) FROM v) AS max, (SELECT count(x) FROM v) AS count,
       (SELECT count(*) FILTER (WHERE len(arr) = 0) FROM x) AS missing,
       (SELECT round(sum(x), 4) FROM v) AS sum, (SELECT round(avg(x), 6) FROM v) AS mean,
       (SELECT round(stddev_samp(x), 6) FROM v) AS stddev
""")
def a21(spark, d):
    p = T(spark, d, "part").withColumn(
        "arr", F.when(F.col("p_size") % 5 == 0, F.array().cast("array<int>"))
        .otherwise(F.array(F.col("p_size"), F.col("p_size") * 2)))
    s = stats.stats_field(p, "arr")
    return s.select("min", "max", "count", "missing", F.round("sum", 4).alias("sum"),
                    F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"))


@register("a26_latency_stats_per_type", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL),
q AS (SELECT event_type, n, x.name, x.q, x.q * (n + 1) AS pos FROM (SELECT DISTINCT event_type, n FROM r)
      CROSS JOIN (VALUES ('median', 0.5), ('p75', 0.75), ('p95', 0.95), ('p99', 0.99), ('p999', 0.999)) x(name, q)),
v AS (SELECT q.event_type, q.name,
             CASE WHEN q.pos < 1 THEN (SELECT value FROM r WHERE r.event_type = q.event_type AND rn = 1)
                  WHEN q.pos >= q.n THEN (SELECT value FROM r WHERE r.event_type = q.event_type AND rn = q.n)
                  ELSE (SELECT value FROM r WHERE r.event_type = q.event_type AND rn = floor(q.pos))
                       + (q.pos - floor(q.pos)) *
                       ((SELECT value FROM r WHERE r.event_type = q.event_type AND rn = floor(q.pos) + 1)
                        - (SELECT value FROM r WHERE r.event_type = q.event_type AND rn = floor(q.pos))) END AS val
      FROM q)
SELECT e.event_type, count(*) AS requests, count(*) FILTER (WHERE e.event_type = 'error') AS errors,
       round(avg(e.value), 6) AS mean,
       round(any_value(m.median), 6) AS median, round(any_value(m.p75), 6) AS p75, round(any_value(m.p95), 6) AS p95,
       round(any_value(m.p99), 6) AS p99, round(any_value(m.p999), 6) AS p999
FROM events e JOIN (SELECT event_type, max(val) FILTER (name = 'median') AS median, max(val) FILTER (name = 'p75') AS p75,
  max(val) FILTER (name = 'p95') AS p95, max(val) FILTER (name = 'p99') AS p99, max(val) FILTER (name = 'p999') AS p999
  FROM v GROUP BY event_type) m ON m.event_type = e.event_type
GROUP BY e.event_type
""")
def a26(spark, d):
    s = stats.latency_stats(T(spark, d, "events"), "value", group="event_type",
                            error=F.col("event_type") == "error")
    return s.select("event_type", "requests", "errors", F.round("mean", 6).alias("mean"),
                    *[F.round(c, 6).alias(c) for c in ("median", "p75", "p95", "p99", "p999")])


@register("a27_ewma_rates", """
WITH t AS (SELECT event_type, CAST(floor(epoch(ts) / 5) AS BIGINT) AS tick, count(*) AS x FROM events GROUP BY 1, 2),
s AS (SELECT *, min(tick) OVER (PARTITION BY event_type) AS f, max(tick) OVER (PARTITION BY event_type) AS l FROM t)
SELECT event_type, max(l) - min(f) + 1 AS ticks,
  round(sum(x / 5.0 * CASE WHEN tick = f THEN pow(1 - (1 - exp(-5 / 60.0 / 1)), l - tick)
       ELSE (1 - exp(-5 / 60.0 / 1)) * pow(1 - (1 - exp(-5 / 60.0 / 1)), l - tick) END), 9) AS m1_rate,
  round(sum(x / 5.0 * CASE WHEN tick = f THEN pow(1 - (1 - exp(-5 / 60.0 / 5)), l - tick)
       ELSE (1 - exp(-5 / 60.0 / 5)) * pow(1 - (1 - exp(-5 / 60.0 / 5)), l - tick) END), 9) AS m5_rate,
  round(sum(x / 5.0 * CASE WHEN tick = f THEN pow(1 - (1 - exp(-5 / 60.0 / 15)), l - tick)
       ELSE (1 - exp(-5 / 60.0 / 15)) * pow(1 - (1 - exp(-5 / 60.0 / 15)), l - tick) END), 9) AS m15_rate
FROM s GROUP BY event_type
""")
def a27(spark, d):
    r = stats.ewma_rates(T(spark, d, "events"), "ts", 5, group="event_type")
    return r.select("event_type", "ticks", *[F.round(c, 9).alias(c) for c in ("m1_rate", "m5_rate", "m15_rate")])


@register("a28_reservoir_sample_per_type")
def a28(spark, d):
    return stats.reservoir_sample(T(spark, d, "events"), 5, "event_id", seed=7, group="event_type")


@register("a28_decayed_sample")
def a28b(spark, d):
    return stats.decayed_sample(T(spark, d, "events"), 20, "event_id", "ts", alpha=0.015, seed=3)


# ------------------------------------------------------------------ grouping

@register("w01_group_top3_orders_per_customer", """
WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS doc_rank FROM orders),
h AS (SELECT o_custkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS group_rank FROM r WHERE doc_rank = 1)
SELECT r.o_orderkey, r.o_custkey, r.o_totalprice, r.o_custkey AS group_value, h.group_rank, r.doc_rank
FROM r JOIN h USING (o_custkey) WHERE r.doc_rank <= 3
""")
def w01(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return grp.group_by_field(o, "o_custkey", key="o_orderkey", sort="o_totalprice desc", limit=-1, group_limit=3)


@register("w02_group_by_function_value", """
WITH g AS (SELECT o_orderkey, o_totalprice, CAST(floor(o_totalprice / 100000) AS BIGINT) AS group_value FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY group_value ORDER BY o_totalprice DESC, o_orderkey) AS doc_rank FROM g),
h AS (SELECT group_value, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS group_rank FROM r
      WHERE doc_rank = 1 QUALIFY group_rank <= 3)
SELECT r.o_orderkey, r.o_totalprice, r.group_value, h.group_rank, r.doc_rank
FROM r JOIN h USING (group_value) WHERE r.doc_rank <= 2
""")
def w02(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice")
    g = F.floor(F.col("o_totalprice") / 100000).cast("long")
    return grp.group_by_field(o, g, key="o_orderkey", sort="o_totalprice desc", limit=3, group_limit=2)


@register("w03_group_by_query", """
WITH t AS (SELECT o_orderkey, o_totalprice, 'urgent' AS group_value, 1 AS group_rank FROM orders WHERE o_orderpriority = '1-URGENT'
           UNION ALL SELECT o_orderkey, o_totalprice, 'cheap', 2 FROM orders WHERE o_totalprice < 20000)
SELECT o_orderkey, o_totalprice, group_value, CAST(group_rank AS BIGINT) AS group_rank, doc_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY group_value ORDER BY o_totalprice DESC, o_orderkey) AS doc_rank FROM t)
WHERE doc_rank <= 4
""")
def w03(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    q = {"urgent": F.col("o_orderpriority") == "1-URGENT", "cheap": F.col("o_totalprice") < 20000}
    return grp.group_by_query(o, q, key="o_orderkey", sort="o_totalprice desc", group_limit=4) \
        .select("o_orderkey", "o_totalprice", "group_value", "group_rank", "doc_rank")


@register("w04_null_group_kept", """
WITH g AS (SELECT l_orderkey, l_linenumber, l_extendedprice, nullif(l_linenumber, 3) AS group_value FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY group_value ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS doc_rank FROM g),
h AS (SELECT group_value, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS group_rank FROM r WHERE doc_rank = 1)
SELECT r.l_orderkey, r.l_linenumber, r.l_extendedprice, r.group_value, h.group_rank, r.doc_rank
FROM r JOIN h ON r.group_value IS NOT DISTINCT FROM h.group_value WHERE r.doc_rank <= 2
""")
def w04(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    li = li.withColumn("key", F.struct("l_orderkey", "l_linenumber"))
    g = F.nullif(F.col("l_linenumber"), F.lit(3))
    out = grp.group_by_field(li, g, key="key", sort="l_extendedprice desc", limit=-1, group_limit=2)
    return out.drop("key")


@register("w05_ngroups", """
SELECT count(DISTINCT nullif(l_linenumber, 3)) + max(CASE WHEN nullif(l_linenumber, 3) IS NULL THEN 1 ELSE 0 END) AS ngroups,
       count(*) AS matches FROM lineitem WHERE l_quantity > 10
""")
def w05(spark, d):
    li = T(spark, d, "lineitem").withColumn("g", F.nullif(F.col("l_linenumber"), F.lit(3)))
    return grp.n_groups(li, "g", where=F.col("l_quantity") > 10)


@register("w06_group_simple_format", """
WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS doc_rank FROM orders),
h AS (SELECT o_custkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS group_rank FROM r
      WHERE doc_rank = 1 QUALIFY group_rank > 10 AND group_rank <= 30)
SELECT r.o_orderkey, r.o_custkey, r.o_totalprice, r.o_custkey AS group_value, h.group_rank, r.doc_rank - 1 AS doc_rank
FROM r JOIN h USING (o_custkey) WHERE r.doc_rank > 1 AND r.doc_rank <= 3
""")
def w06(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return grp.group_by_field(o, "o_custkey", key="o_orderkey", sort="o_totalprice desc", limit=20, offset=10,
                              group_limit=2, group_offset=1, fmt="simple")


@register("w07_group_truncate_then_facet", """
WITH h AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1)
SELECT o_orderpriority, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS rank
FROM h GROUP BY o_orderpriority
""")
def w07(spark, d):
    heads = grp.truncate_groups(T(spark, d, "orders"), "o_custkey", key="o_orderkey", sort="o_totalprice desc")
    return fc.facet_field(heads, "o_orderpriority")


# ------------------------------------------------------------------ sorting

@register("o01_sort_multi_key", """
SELECT c_custkey, c_mktsegment, c_acctbal,
       row_number() OVER (ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey) AS rank FROM customer
""")
def o01(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return sorting.sort_docs(c, "c_mktsegment asc, c_acctbal desc", "c_custkey")


@register("o02_sort_missing_first", """
SELECT l_orderkey, l_linenumber, ln,
       row_number() OVER (ORDER BY ln DESC NULLS FIRST, l_orderkey, l_linenumber) AS rank
FROM (SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 3) AS ln FROM lineitem)
""")
def o02(spark, d):
    li = T(spark, d, "lineitem") \
        .select("l_orderkey", "l_linenumber", F.nullif(F.col("l_linenumber"), F.lit(3)).alias("ln"))
    li = li.withColumn("key", F.struct("l_orderkey", "l_linenumber"))
    return sorting.sort_docs(li, "ln desc", "key", missing="first").drop("key")


@register("o04_sort_by_function", """
SELECT o_orderkey, round(o_totalprice / (1 + o_custkey % 10), 6) AS f,
       row_number() OVER (ORDER BY round(o_totalprice / (1 + o_custkey % 10), 6) DESC, o_orderkey) AS rank
FROM orders QUALIFY rank <= 50
""")
def o04(spark, d):
    o = T(spark, d, "orders").withColumn("f", F.round(F.col("o_totalprice") / (1 + F.col("o_custkey") % 10), 6))
    return sorting.page(o.select("o_orderkey", "f"), "f desc", "o_orderkey", 0, 50)


@register("o05_random_sort_seeded")
def o05(spark, d):
    return sorting.random_sort(T(spark, d, "customer").select("c_custkey"), 42, "c_custkey")


@register("o06_collated_sort")
def o06(spark, d):
    c = T(spark, d, "nation").withColumn("k", sorting.collated_sort_key(F.lower("n_name"), "UNICODE_CI"))
    return sorting.sort_docs(c, [F.col("k").asc()], "n_nationkey").drop("k")


@register("o07_sort_by_distance", f"""
WITH g AS (SELECT c_custkey, {GEO_SQL} AS lat, {GEO_LON_SQL} AS lon FROM customer)
SELECT c_custkey, round(dist, 6) AS dist, row_number() OVER (ORDER BY dist, c_custkey) AS rank FROM (
  SELECT c_custkey, 2 * 6371.0087714 * atan2(sqrt(h), sqrt(1 - h)) AS dist FROM (
    SELECT c_custkey, pow(sin((radians(40.7) - radians(lat)) / 2), 2)
      + cos(radians(lat)) * cos(radians(40.7)) * pow(sin((radians(-74.0) - radians(lon)) / 2), 2) AS h FROM g))
QUALIFY rank <= 25
""")
def o07(spark, d):
    from searchlake.functions import scalar as fn
    g = _geo_customers(spark, d).withColumn("dist", fn.geodist("lat", "lon", 40.7, -74.0))
    out = sorting.page(g.select("c_custkey", "dist"), "dist asc", "c_custkey", 0, 25)
    return out.withColumn("dist", F.round("dist", 6))


@register("o08_page_start_rows", """
SELECT o_orderkey, o_totalprice, rank FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank > 20 AND rank <= 30
""")
def o08(spark, d):
    return sorting.page(T(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice desc",
                        "o_orderkey", start=20, rows=10)


@register("o09_search_after_cursor", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders
WHERE o_totalprice < 300000 OR (o_totalprice = 300000 AND o_orderkey > 0)
QUALIFY rank <= 15
""")
def o09(spark, d):
    return sorting.search_after(T(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                                [("o_totalprice", "desc")], "o_orderkey", [300000.0, 0], rows=15)


# ------------------------------------------------------------------ set operations

_A = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'"
_B = "SELECT o_orderkey FROM orders WHERE o_totalprice > 250000"


def _ab(spark, d):
    o = T(spark, d, "orders")
    return (o.filter(F.col("o_orderstatus") == "O").select("o_orderkey"),
            o.filter(F.col("o_totalprice") > 250000).select("o_orderkey"))


@register("u01_intersection", f"{_A} INTERSECT {_B}")
def u01(spark, d):
    a, b = _ab(spark, d)
    return sets.intersect_sets(a, b, "o_orderkey")


@register("u02_union", f"{_A} UNION {_B}")
def u02(spark, d):
    a, b = _ab(spark, d)
    return sets.union_sets(a, b, "o_orderkey")


@register("u03_difference_and_not", f"{_A} EXCEPT {_B}")
def u03(spark, d):
    a, b = _ab(spark, d)
    return sets.difference_sets(a, b, "o_orderkey")


@register("u04_set_sizes", f"""
SELECT (SELECT count(*) FROM ({_A} INTERSECT {_B})) AS intersection_size,
       (SELECT count(*) FROM ({_A} UNION {_B})) AS union_size,
       (SELECT count(*) FROM ({_A} EXCEPT {_B})) AS and_not_size,
       (SELECT count(*) FROM ({_A} INTERSECT {_B})) > 0 AS intersects
""")
def u04(spark, d):
    a, b = _ab(spark, d)
    return sets.set_sizes(a, b, "o_orderkey")


@register("u05_filter_chain_xor", """
SELECT o_orderkey FROM orders WHERE ((o_orderstatus = 'O') AND NOT (o_totalprice > 250000))
   OR (NOT (o_orderstatus = 'O') AND (o_totalprice > 250000))
""")
def u05(spark, d):
    pred = flt.chain([F.col("o_orderstatus") == "O", F.col("o_totalprice") > 250000], ["XOR"])
    return T(spark, d, "orders").filter(pred).select("o_orderkey")
