"""Field statistics (A17–A21) and request/event statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from searchlake.operators.util import bounded_broadcast, is_array


def _numeric_aggs(x: Column, n_rows: Column) -> list[Column]:
    cnt = F.count(x)
    s = F.sum(x)
    ss = F.sum(x * x)
    return [
        F.min(x).alias("min"), F.max(x).alias("max"), cnt.alias("count"),
        (n_rows - cnt).alias("missing"), s.alias("sum"), ss.alias("sum_of_squares"),
        (s / F.when(cnt > 0, cnt)).alias("mean"),
        F.when(cnt > 0, F.coalesce(F.stddev_samp(x), F.lit(0.0))).alias("stddev"),
    ]


def stats_field(df: DataFrame, col: str, facet: str | None = None) -> DataFrame:
    """One aggregate pass of min/max/count/missing/sum/sumOfSquares/mean/stddev.

    * numeric: values as double; stddev is the sample form and 0 when only one value;
    * timestamp: min/max as timestamps, sum/mean/stddev on epoch milliseconds (A18, D5);
    * string: min, max, count, missing only (A19);
    * array: values exploded, ``missing`` counts docs without any value (A21);
    * ``facet``: the same per value of the facet column (A20), one row per value.
    """
    dtype = df.schema[col].dataType
    keys = [facet] if facet else []
    if is_array(df, col):
        elem = dtype.elementType
        docs = df.select(*keys, F.col(col).alias("_arr"))
        miss = F.count_if(F.coalesce(F.size("_arr"), F.lit(0)) <= 0).alias("_miss")
        exploded = docs.select(*keys, F.explode("_arr").alias("_x"))
        inner = stats_field(exploded, "_x", facet)
        missing = docs.groupBy(*keys).agg(miss) if keys else docs.agg(miss)
        if keys:
            # the facet's NULL value is one group: null-safe join on the renamed key
            right = missing.withColumnRenamed(facet, "_facet")
            joined = inner.drop("missing").join(right, F.col(facet).eqNullSafe(F.col("_facet")), "right")
            return joined.withColumn(facet, F.col("_facet")).drop("_facet").withColumn(
                "count", F.coalesce("count", F.lit(0).cast("long"))).withColumnRenamed("_miss", "missing")
        return inner.drop("missing").crossJoin(F.broadcast(missing)).withColumnRenamed("_miss", "missing")
    n_rows = F.count(F.lit(1))
    if isinstance(dtype, StringType):
        x = F.col(col)
        aggs = [F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("count"),
                (n_rows - F.count(x)).alias("missing")]
    elif isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        ms = F.unix_millis(F.col(col).cast("timestamp"))
        cnt = F.count(ms)
        aggs = [F.min(col).alias("min"), F.max(col).alias("max"), cnt.alias("count"),
                (n_rows - cnt).alias("missing"), F.sum(ms).alias("sum"),
                F.sum(ms.cast("double") * ms.cast("double")).alias("sum_of_squares"),
                F.timestamp_millis(F.floor(F.sum(ms) / F.when(cnt > 0, cnt)).cast("long")).alias("mean"),
                F.when(cnt > 0, F.coalesce(F.stddev_samp(ms), F.lit(0.0))).alias("stddev")]
    elif isinstance(dtype, NumericType):
        aggs = _numeric_aggs(F.col(col).cast("double"), n_rows)
    else:
        raise TypeError(f"no stats for {dtype}")
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


# ------------------------------------------------------------------ A26 request statistics

def latency_stats(df: DataFrame, value: str, group: str | None = None, ts: str | None = None,
                  error: Column | None = None) -> DataFrame:
    """Requests, errors, mean, median, p75/p95/p99/p999 per group.

    Quantiles use the reference's rule pos = q·(n+1), linear between the two neighbours,
    clamped to the first/last value (D7). Exact and distributed: values are ranked by a window
    *partitioned by the group* (no global sort), and the two neighbours are picked by rank.
    ``ts`` adds a mean rate (requests per second between first and last event).
    """
    keys = [group] if group else []
    qs = {"median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    g = keys if keys else []
    base = df.select(*g, F.col(value).cast("double").alias("_v"),
                     *([F.col(ts).alias("_t")] if ts else []),
                     (F.coalesce(error, F.lit(False)) if error is not None else F.lit(False)).alias("_err"))
    # Rank values inside each group without a per-group window: a global range-partitioned
    # row number over (group, value) splits a hot group across many tasks; subtracting each
    # group's first global rank (one small row per group) gives the rank inside the group.
    from searchlake.operators.util import global_row_number

    vals = base.filter(F.col("_v").isNotNull())
    # the random tie-break lets one frequent value fill many ranges; which of equal values has which rank is all one
    ranked = global_row_number(vals, [*(F.col(k).asc_nulls_first() for k in g), F.col("_v").asc(), F.rand(1).asc()], "_gr")
    if g:
        starts = ranked.groupBy(F.col(group).alias("_g")).agg(F.min("_gr").alias("_start"))
        ranked = ranked.join(bounded_broadcast(starts), F.col(group).eqNullSafe(F.col("_g")), "inner").drop("_g")
    else:
        ranked = ranked.withColumn("_start", F.lit(1))
    ranked = ranked.withColumn("_r", (F.col("_gr") - F.col("_start") + 1).cast("double")).drop("_gr", "_start")
    summary = base.groupBy(*g).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("_err").alias("errors"),
        F.avg("_v").alias("mean"), F.count("_v").alias("_n"),
        *([((F.count(F.lit(1)) - 1) / F.greatest(
            (F.unix_micros(F.max("_t").cast("timestamp")) - F.unix_micros(F.min("_t").cast("timestamp"))) / 1e6, F.lit(1e-9))).alias("mean_rate")]
          if ts else []))
    if g:
        sizes = summary.select(F.col(group).alias("_g"), "_n")
        j = ranked.join(bounded_broadcast(sizes), F.col(group).eqNullSafe(F.col("_g")), "inner").drop("_g")
    else:
        j = ranked.crossJoin(F.broadcast(summary.select("_n")))
    aggs = []
    for name, q in qs.items():
        pos = F.lit(q) * (F.col("_n") + 1)
        lo = F.least(F.greatest(F.floor(pos), F.lit(1)), F.col("_n"))
        hi = F.least(F.greatest(F.floor(pos) + 1, F.lit(1)), F.col("_n"))
        frac = F.when(pos < 1, 0.0).when(pos >= F.col("_n"), 0.0).otherwise(pos - F.floor(pos))
        lo_v = F.max(F.when(F.col("_r") == lo, F.col("_v")))
        hi_v = F.max(F.when(F.col("_r") == hi, F.col("_v")))
        aggs.append((lo_v + F.first(frac) * (hi_v - lo_v)).alias(name))
    # Only the two neighbour rows per quantile matter: keep them before aggregating.
    need = None
    for q in qs.values():
        pos = F.lit(q) * (F.col("_n") + 1)
        lo = F.least(F.greatest(F.floor(pos), F.lit(1)), F.col("_n"))
        cond = (F.col("_r") == lo) | (F.col("_r") == F.least(lo + 1, F.col("_n")))
        need = cond if need is None else need | cond
    quant = j.filter(need).groupBy(*g).agg(*aggs) if g else j.filter(need).agg(*aggs)
    if not g:
        return summary.crossJoin(quant).drop("_n")
    quant = quant.withColumnRenamed(group, "_g")
    return summary.join(quant, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_n", "_g")


def ewma_rates(df: DataFrame, ts: str, tick_seconds: int = 5, group: str | None = None) -> DataFrame:
    """1/5/15-minute exponentially weighted event rates at the last tick.

    Events are counted per ``tick_seconds`` window (one aggregate); the EWMA recursion
    ``r ← r + α(x/Δ − r)`` started at the first tick has the closed form
    ``Σ α(1−α)^(n−i) x_i/Δ`` (first tick seeds the rate), evaluated as an aggregate with
    per-tick weights, so no sequential loop is needed. Empty ticks contribute 0 and only
    shift the exponent. First and last tick are a small aggregate joined back, never a window over
    all ticks of a key. Output: ``[group,] ticks, m1_rate, m5_rate, m15_rate`` in events/second.
    """
    import math

    keys = [group] if group else []
    tick = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / tick_seconds).cast("long")
    per_tick = df.groupBy(*keys, tick.alias("_tick")).agg(F.count(F.lit(1)).alias("_x"))
    ends = [F.min(tick).alias("_first"), F.max(tick).alias("_last")]
    if keys:
        bounds = df.groupBy(F.col(group).alias("_g")).agg(*ends)
        spans = per_tick.join(bounded_broadcast(bounds), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    else:
        spans = per_tick.crossJoin(F.broadcast(df.agg(*ends)))  # one row
    out_cols = []
    for minutes, name in ((1, "m1_rate"), (5, "m5_rate"), (15, "m15_rate")):
        alpha = 1 - math.exp(-tick_seconds / 60.0 / minutes)
        k = F.col("_last") - F.col("_tick")  # ticks after this one
        rate = F.col("_x") / F.lit(float(tick_seconds))
        # seed tick enters with weight (1-α)^k, every later tick with α(1-α)^k
        weight = F.when(F.col("_tick") == F.col("_first"), F.pow(F.lit(1 - alpha), k)) \
            .otherwise(F.lit(alpha) * F.pow(F.lit(1 - alpha), k))
        out_cols.append(F.sum(rate * weight).alias(name))
    aggs = [(F.max("_last") - F.min("_first") + 1).alias("ticks"), *out_cols]
    return spans.groupBy(*keys).agg(*aggs) if keys else spans.agg(*aggs)


def reservoir_sample(df: DataFrame, k: int, key: str, seed: int = 0, weight: str | None = None,
                     group: str | None = None) -> DataFrame:
    """Uniform (or weighted) sample of ``k`` rows per group.

    Priority sampling: each row gets a reproducible pseudo-random u from ``xxhash64(seed, key)``;
    uniform keeps the k smallest u, weighted keeps the k largest ``u^(1/w)`` (Efraimidis–Spirakis,
    the form behind the forward-decaying sample). ``row_number() <= k`` plans a partial top-k
    before the shuffle, so even a hot group ships only k rows per map task.
    """
    u = (F.abs(F.xxhash64(F.lit(seed), F.col(key))) % F.lit(1 << 52)).cast("double") / float(1 << 52)
    u = F.greatest(u, F.lit(1e-12))
    prio = -u if weight is None else F.pow(u, F.lit(1.0) / F.col(weight))
    keys = [group] if group else []
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(F.desc("_prio"), F.col(key))
    if not keys:
        return df.withColumn("_prio", prio).orderBy(F.desc("_prio"), F.col(key)).limit(k).drop("_prio")
    return df.withColumn("_prio", prio).withColumn("_rn", F.row_number().over(w)) \
        .filter(F.col("_rn") <= k).drop("_prio", "_rn")


def decayed_sample(df: DataFrame, k: int, key: str, ts: str, alpha: float = 0.015, seed: int = 0,
                   group: str | None = None) -> DataFrame:
    """Forward-decaying sample: weight ``exp(α·(t − t0))`` favours recent rows."""
    t0 = F.lit(0)
    w = F.exp(F.lit(alpha) * (F.unix_seconds(F.col(ts).cast("timestamp")) - t0) / 3600.0)
    return reservoir_sample(df.withColumn("_w", w), k, key, seed, "_w", group).drop("_w")
