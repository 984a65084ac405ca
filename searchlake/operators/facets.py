"""Facets over a match set.

Shapes chosen for scale:

* field facets are one hash aggregate (partial + final) on the facet column;
  ``where=`` turns mincount=0 into the same single pass (``count_if`` over the whole
  table lists zero-count values without a join);
* range facets never join: the bucket of a value is computed arithmetically and checked
  exactly against edge literals, then one aggregate;
* pivots aggregate once at the finest level and roll the (small) result up.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.functions import datemath
from searchlake.operators.util import as_col, global_row_number, is_array, null_false, rank_small


def _facet_values(df: DataFrame, col: str) -> tuple[DataFrame, str]:
    """Explode multi-valued fields so each doc counts once per distinct value."""
    if is_array(df, col):
        return df.withColumn(col, F.explode_outer(F.array_distinct(F.col(col)))), col
    return df, col


def facet_field(df: DataFrame, col: str, *, limit: int = 100, offset: int = 0, mincount: int = 0,
                sort: str = "count", prefix: str | None = None, missing: bool = False,
                where: Column | None = None, group_by: str | None = None) -> DataFrame:
    """Count per value of ``col``.

    ``df`` is the match set, or — with ``where`` — the whole table plus the match predicate,
    in which case values with zero matches are listed too (mincount=0 semantics).
    ``group_by`` counts distinct groups instead of docs (A14).
    Output: ``col, count, rank``; the missing row (``missing=True``) has a NULL value and rank.
    """
    base, c = _facet_values(df, col)
    if prefix is not None:
        base = base.filter(F.col(c).startswith(prefix) | F.col(c).isNull())
    match = null_false(where) if where is not None else F.lit(True)
    if group_by is None:
        cnt = F.count_if(match)
    else:
        cnt = F.count_distinct(F.when(match, F.col(group_by)))
    counts = base.groupBy(c).agg(cnt.cast("long").alias("count"))
    listed = counts.filter(F.col(c).isNotNull())
    if where is None and mincount <= 0:
        mincount = 1 if group_by is None else 0
    if mincount > 0:
        listed = listed.filter(F.col("count") >= mincount)
    order = ([F.col("count").desc(), F.col(c).asc()] if sort == "count" else [F.col(c).asc()])
    if limit is not None and limit >= 0:
        ranked = listed.orderBy(*order)
        if offset:
            ranked = ranked.offset(offset)
        ranked = rank_small(ranked.limit(limit), order, "rank", offset)
    else:
        if offset:
            raise ValueError("offset needs a limit")
        ranked = global_row_number(listed, order, "rank")
    if missing:
        miss = counts.filter(F.col(c).isNull()).withColumn("rank", F.lit(None).cast("long"))
        ranked = ranked.unionByName(miss)
    return ranked


def facet_terms(df: DataFrame, col: str, terms: list, where: Column | None = None) -> DataFrame:
    """Facet restricted to listed terms; every listed term appears, zero if absent."""
    base, c = _facet_values(df, col)
    match = null_false(where) if where is not None else F.lit(True)
    hits = base.filter(F.col(c).isin(terms)).select(c, F.when(match, 1).otherwise(0).alias("_w"))
    spark = df.sparkSession
    dtype = df.schema[col].dataType
    if is_array(df, col):
        dtype = dtype.elementType
    listed = spark.createDataFrame([(t,) for t in terms], f"{c} {dtype.simpleString()}") \
        .withColumn("_w", F.lit(0))
    return hits.unionByName(listed).groupBy(c).agg(F.sum("_w").cast("long").alias("count"))


def facet_queries(df: DataFrame, queries: dict[str, Column], group_by: str | None = None) -> DataFrame:
    """Count per named predicate in one pass (A10/A15). Output: ``name, count``."""
    aggs = []
    for name, pred in queries.items():
        p = null_false(pred)
        a = F.count_if(p) if group_by is None else F.count_distinct(F.when(p, F.col(group_by)))
        aggs.append(a.cast("long").alias(name))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in queries)
    return wide.selectExpr(f"stack({len(queries)}, {stack}) as (name, count)")


# ------------------------------------------------------------------ range facets

INCLUDE_ALL = {"lower", "upper", "edge", "outer"}


def _includes(include) -> set[str]:
    inc = {include} if isinstance(include, str) else set(include or ())
    inc = {i.lower() for i in inc}
    if "all" in inc:
        return set(INCLUDE_ALL)
    return inc or {"lower"}


def range_edges(start, end, gap, *, hardend: bool = False, tz: str = "UTC"):
    """Bucket edges as scalars: their number is what the user asked for.

    The k-th edge is the start advanced k times by the gap, up to the first edge at or after ``end``. That last
    edge is the end of the last bucket, or ``end`` itself with ``hardend``. Returns ``(lows, highs, end)``.
    """
    if isinstance(gap, str):
        start, end = datemath.resolve(start, tz=tz), datemath.resolve(end, tz=tz)
        advance = lambda t: datemath.add_gap(t, gap, tz)
    else:
        advance = lambda t: t + gap
    if end < start:
        raise ValueError("range facet end before start")
    edges = [start]
    while edges[-1] < end:
        edges.append(advance(edges[-1]))
        if not edges[-1] > edges[-2]:
            raise ValueError("range facet gap does not advance")
    if hardend and len(edges) > 1:
        edges[-1] = end
    return edges[:-1], edges[1:], edges[-1] if len(edges) > 1 else end


def _num(c: Column, is_date: bool) -> Column:
    return F.unix_micros(c.cast("timestamp")) if is_date else c.cast("double")


def _lit_num(v, is_date: bool):
    if is_date:
        return int((v - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    return float(v)


def facet_range(df: DataFrame, col: str, start, end, gap, *, hardend: bool = False,
                include=("lower",), other=(), mincount: int = 0, where: Column | None = None,
                group_by: str | None = None, tz: str = "UTC") -> DataFrame:
    """Range facet (A11/A12/A15): counts per ``[low, high)`` bucket, plus before/after/between.

    No join and no broadcast of data: the candidate bucket of a value is
    ``floor((v − start) / mean_gap)`` ± 2 (exact for fixed gaps, within one bucket for calendar
    gaps), and membership is checked exactly against literal edge arrays with the inclusion
    flags, so a value on an edge may land in two buckets or in none, as in the reference.
    Output: ``bucket (0-based, NULL for others), label ('lower'|'before'|'after'|'between'),
    low, high, count``.
    """
    inc = _includes(include)
    is_date = isinstance(gap, str)
    lows, highs, end_v = range_edges(start, end, gap, hardend=hardend, tz=tz)
    start_v = lows[0] if lows else (datemath.resolve(start, tz=tz) if is_date else start)
    n = len(lows)
    lo_n = [_lit_num(x, is_date) for x in lows]
    hi_n = [_lit_num(x, is_date) for x in highs]
    s_n, e_n = _lit_num(start_v, is_date), _lit_num(end_v, is_date)
    inc_lo = [("lower" in inc) or ("edge" in inc and lows[i] == start_v) for i in range(n)]
    inc_hi = [("upper" in inc) or ("edge" in inc and highs[i] == end_v) for i in range(n)]

    match = null_false(where) if where is not None else F.lit(True)
    mean_gap = (hi_n[-1] - lo_n[0]) / n if n else 1.0
    lo_arr = F.array(*[F.lit(x) for x in lo_n]).cast("array<double>")
    hi_arr = F.array(*[F.lit(x) for x in hi_n]).cast("array<double>")
    il_arr = F.array(*[F.lit(x) for x in inc_lo])
    ih_arr = F.array(*[F.lit(x) for x in inc_hi])

    def member(b):
        lo, hi = F.get(lo_arr, b), F.get(hi_arr, b)
        inside = (b >= 0) & (b < n) & (((v > lo) & (v < hi)) | ((v == lo) & F.get(il_arr, b))
                                        | ((v == hi) & F.get(ih_arr, b)))
        return F.coalesce(inside, F.lit(False))

    key = F.col(group_by) if group_by else F.lit(1)
    tagged = df.select(F.col(col).alias("_v"), key.alias("_g"), match.alias("_m")) \
        .filter(F.col("_v").isNotNull())
    v = _num(F.col("_v"), is_date)
    guess = F.floor((v - F.lit(s_n)) / F.lit(mean_gap)).cast("int")
    cands = F.array(*[guess + F.lit(d) for d in (-2, -1, 0, 1, 2)])
    hits = tagged.select(F.explode(F.filter(cands, member)).alias("bucket"), "_g", "_m")
    spark = df.sparkSession
    edges = spark.range(n).select(F.col("id").cast("int").alias("bucket"))
    if group_by is None:
        per = hits.groupBy("bucket").agg(F.count_if("_m").cast("long").alias("count"))
    else:
        per = hits.groupBy("bucket").agg(
            F.count_distinct(F.when(F.col("_m"), F.col("_g"))).cast("long").alias("count"))
    counts = edges.join(per, "bucket", "left").select(
        "bucket", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    counts = counts.filter(F.col("count") >= mincount) if mincount > 0 else counts
    low_c = F.get(lo_arr, F.col("bucket"))
    high_c = F.get(hi_arr, F.col("bucket"))
    if is_date:
        low_c, high_c = F.timestamp_micros(low_c.cast("long")), F.timestamp_micros(high_c.cast("long"))
    out = counts.select("bucket", F.lit("range").alias("label"), low_c.alias("low"),
                        high_c.alias("high"), "count")

    others = {o.lower() for o in ([other] if isinstance(other, str) else other)}
    if "none" in others or not others:
        return out
    if "all" in others:
        others = {"before", "after", "between"}
    s, e = F.lit(s_n), F.lit(e_n)
    conds = {}
    if "before" in others:
        incl = ("outer" in inc) or not ({"lower", "edge"} & inc)
        conds["before"] = (v <= s) if incl else (v < s)
    if "after" in others:
        incl = ("outer" in inc) or not ({"upper", "edge"} & inc)
        conds["after"] = (v >= e) if incl else (v > e)
    if "between" in others:
        il = bool({"lower", "edge"} & inc)
        ih = bool({"upper", "edge"} & inc)
        conds["between"] = ((v >= s) if il else (v > s)) & ((v <= e) if ih else (v < e))
    aggs = []
    for name, cond in conds.items():
        p = cond & F.col("_m")
        a = F.count_if(p) if group_by is None else F.count_distinct(F.when(p, F.col("_g")))
        aggs.append(a.cast("long").alias(name))
    wide = tagged.agg(*aggs)
    null_ts = F.lit(None).cast("timestamp" if is_date else "double")
    rows = [wide.select(F.lit(None).cast("int").alias("bucket"), F.lit(name).alias("label"),
                        null_ts.alias("low"), null_ts.alias("high"), F.col(name).alias("count"))
            for name in conds]
    for r in rows:
        out = out.unionByName(r)
    return out


# ------------------------------------------------------------------ pivots

def facet_pivot(df: DataFrame, fields: list[str], *, mincount: int = 1, limit: int = -1) -> DataFrame:
    """Hierarchical facet (A13): one aggregate at the finest level, rolled up level by level.

    Each node: ``level, f1..fk (NULL below its level), count, rank`` (rank within its parent,
    by count desc then value asc). Per parent only the top ``limit`` children are kept; a node
    needs ``count >= mincount`` and, unless it is a leaf, at least ``mincount`` listed children.
    The finest aggregate (one row per distinct value combination) is written to the scratch folder
    once; every roll-up and window reads these rows, so the documents are scanned a single time. The
    first level has no parent to partition its ranking by: it takes a top-k with a limit, a distributed ranking without.
    """
    from searchlake.operators.util import global_row_number, rank_small
    from searchlake.session import scratch_dir

    if len(fields) < 2:
        raise ValueError("pivot needs at least two fields")
    path = scratch_dir(df.sparkSession, "pivot")
    df.groupBy(*fields).agg(F.count(F.lit(1)).alias("count")).write.parquet(path)
    finest = df.sparkSession.read.parquet(path)
    limited = limit is not None and limit >= 0
    levels = []
    for k in range(1, len(fields) + 1):
        keys = fields[:k]
        lvl = finest.filter(F.col(fields[k - 1]).isNotNull()) \
            .groupBy(*keys).agg(F.sum("count").cast("long").alias("count"))
        order = [F.col("count").desc(), F.col(keys[-1]).asc()]
        if k > 1:
            lvl = lvl.withColumn("rank", F.row_number().over(Window.partitionBy(*keys[:-1]).orderBy(*order)).cast("long"))
            lvl = lvl.filter(F.col("rank") <= limit) if limited else lvl
        else:
            lvl = rank_small(lvl.orderBy(*order).limit(limit), order) if limited else global_row_number(lvl, order)
        levels.append(lvl.filter(F.col("count") >= 1))
    # bottom-up: a non-leaf node needs >= mincount listed children
    kept = [None] * len(fields)
    kept[-1] = levels[-1].filter(F.col("count") >= mincount)
    for k in range(len(fields) - 2, -1, -1):
        keys = fields[:k + 1]
        n_child = levels[k + 1].groupBy(*keys).agg(F.count(F.lit(1)).alias("_nc"))
        kept[k] = levels[k].filter(F.col("count") >= mincount) \
            .join(n_child, keys, "inner").filter(F.col("_nc") >= mincount).drop("_nc")
    # top-down: a node is listed only under a listed parent
    listed = [kept[0]]
    for k in range(1, len(fields)):
        parent_keys = fields[:k]
        listed.append(kept[k].join(listed[k - 1].select(*parent_keys), parent_keys, "left_semi"))
    out = None
    for k, lvl in enumerate(listed):
        cols = [F.lit(k + 1).alias("level")]
        for i, f in enumerate(fields):
            cols.append(F.col(f) if i <= k else F.lit(None).cast(df.schema[f].dataType).alias(f))
        part = lvl.select(*cols, "count", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def multi_select_facets(df: DataFrame, filters: dict, facets: dict[str, list[str]]) -> DataFrame:
    """Tag/exclude facets (A16): each facet counts over the match set without its excluded filters.

    ``filters``: ``{tag: predicate}`` (tag ``None`` = never excluded); ``facets``: ``{column: [tags
    to exclude]}``. One scan: every facet's own match predicate becomes a ``count_if`` flag, and
    the facets are produced together by a single grouping-sets style aggregate (explode of
    ``(facet, value, flag)`` then one ``groupBy``). Output: ``facet, value, count``.
    """
    entries = []
    for col, excl in facets.items():
        preds = [null_false(p) for t, p in filters.items() if t is None or t not in excl]
        m = preds[0]
        for p in preds[1:]:
            m = m & p
        entries.append(F.struct(F.lit(col).alias("facet"), F.col(col).cast("string").alias("value"),
                                m.alias("hit")))
    rows = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(F.col("hit"))
    return rows.filter(F.col("value").isNotNull()).groupBy("facet", "value") \
        .agg(F.count(F.lit(1)).alias("count"))
