"""Table mutation as MERGE-like DataFrame jobs.

An update batch is joined to the base table once on the unique key. The batch is usually far
smaller than the table; it is broadcast only after a bounded size check, otherwise both sides
shuffle on the key (AQE splits skewed keys). Results are new DataFrames — write them out (or
checkpoint them into the shared folder) to commit, the analogue of a commit opening a new searcher.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.util import bounded_broadcast, null_false, written


def latest_per_key(updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Last update per key wins (``max_by`` on a struct: partial aggregation, skew-safe). Without an ``order`` column the
    order of arrival counts: the rows' order in ``updates``."""
    if order is None:
        last = latest_per_key(updates.withColumn("_arrival", F.monotonically_increasing_id()), key, "_arrival")
        return last.drop("_arrival")
    others = [c for c in updates.columns if c != key]
    best = updates.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r"))
    return best.select(key, "_r.*").select(*updates.columns)


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Add with overwrite by unique key (M01): base rows whose key is updated are replaced."""
    latest = latest_per_key(updates, key, order)
    keys = bounded_broadcast(latest.select(key))
    kept = base.join(keys, key, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def append(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Add without overwrite."""
    return base.unionByName(updates, allowMissingColumns=True)


def delete_by_ids(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Delete by id."""
    return base.join(bounded_broadcast(ids.select(key)), key, "left_anti")


def delete_by_query(base: DataFrame, pred: Column | None) -> DataFrame:
    """Delete by query (M04); ``None`` (``*:*``) clears the table."""
    if pred is None:
        return base.limit(0)
    return base.filter(~null_false(pred))


def get_by_ids(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Real-time get by id(s)."""
    return base.join(bounded_broadcast(ids.select(key).distinct()), key, "left_semi")


def atomic_update(base: DataFrame, ops: DataFrame, key: str) -> DataFrame:
    """Atomic field updates (M05–M07). ``ops``: ``key, field, op ('set'|'add'|'inc'), value (string)``.

    ``set`` replaces (NULL value removes the field), ``add`` appends to a multi-valued field,
    ``inc`` adds numerically (missing → the increment itself). Operations of one key apply in
    arrival order (column ``seq`` if present, else the rows' order). A key that the table lacks gets a new row.
    Ops are pivoted per (key, field) into one row per key, then joined once to the base table."""
    fields = [r[0] for r in ops.select("field").distinct().collect()]  # user op batch: bounded list of names
    order = F.col("seq") if "seq" in ops.columns else F.monotonically_increasing_id()
    per = ops.withColumn("_o", order).groupBy(key, "field").agg(
        F.sort_array(F.collect_list(F.struct("_o", "op", "value"))).alias("_ops"))
    wide = per.groupBy(key).pivot("field", fields).agg(F.first("_ops"))
    j = base.join(wide.withColumnsRenamed({f: f"_ops_{f}" for f in fields}), key, "full_outer")
    for f in fields:
        if f not in base.columns:
            j = j.withColumn(f, F.lit(None).cast("string"))
        dtype = base.schema[f].dataType if f in base.columns else None
        cur = F.col(f)
        ops_c = F.coalesce(F.col(f"_ops_{f}"), F.array())

        def make(dtype):
            def apply(acc, o):
                return _apply_op(acc, o, dtype)
            return apply
        j = j.withColumn(f, F.aggregate(ops_c, cur, make(dtype))).drop(f"_ops_{f}")
    return j


def _apply_op(acc, o, dtype):
    """One atomic operation applied to the running value of a field."""
    if dtype is not None and dtype.typeName() == "array":
        elem = dtype.elementType
        return F.when(o["op"] == "set", F.when(o["value"].isNull(), F.lit(None).cast(dtype))
                      .otherwise(F.array(o["value"].cast(elem)))) \
            .when(o["op"] == "add", F.concat(F.coalesce(acc, F.array().cast(dtype)),
                                             F.array(o["value"].cast(elem)))) \
            .otherwise(acc)
    t = dtype if dtype is not None else "string"
    num = "double" if dtype is None else dtype
    return F.when(o["op"] == "set", o["value"].cast(t)) \
        .when(o["op"] == "inc", (F.coalesce(acc.cast(num), F.lit(0)) + o["value"].cast(num)).cast(t)) \
        .when(o["op"] == "add", o["value"].cast(t)) \
        .otherwise(acc)


def _accepted_versions(current, wanted) -> list:
    """Version after each update of one key in order, None where it conflicts."""
    out, cur = [], None if pd.isna(current) else int(current)
    for v in wanted:
        fine = v is None or pd.isna(v) or v == 0 or (v == 1 and cur is not None) or (v < 0 and cur is None) or v == cur
        cur = (cur or 0) + 1 if fine else cur
        out.append(cur if fine else None)
    return out


def upsert_versioned(base: DataFrame, updates: DataFrame, key: str, version: str = "version", order: str | None = None) -> dict:
    """Optimistic concurrency (M08). An update's ``version`` must be: exactly the stored version,
    or 1 (doc must exist), or negative (doc must not exist), or 0/NULL (no check). Returns
    ``{"accepted": DataFrame, "conflicts": DataFrame, "table": DataFrame}``; accepted updates get
    a new version = stored + 1 (or 1 for new docs).

    Updates of one key count one after another (by ``order``, else as they arrive), each against the version that the one before
    left, so the second of two updates with one exact version conflicts. Only versions are gathered per key, never the rows.
    Conflicts show the version they met as ``current_version``."""
    arrival = F.col(order) if order else F.monotonically_increasing_id()
    batch = written(updates.withColumn("_o", arrival).withColumn("_n", F.monotonically_increasing_id()), "updates")
    asked = batch.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_o", "_n", F.col(version).cast("long").alias("v")))).alias("_a"))
    known = base.select(key, F.col(version).cast("long").alias("_cur"))

    @F.pandas_udf("array<long>")
    def fold(current: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([_accepted_versions(c, list(w)) for c, w in zip(current, wanted, strict=True)])

    told = asked.join(known, key, "left").withColumn("_new", fold("_cur", F.transform("_a", lambda a: a["v"])))
    # what a conflict met: the last accepted version before it, else the stored one
    each = told.select("_cur", F.posexplode(F.arrays_zip("_a", "_new")).alias("_i", "_z"), "_new")
    met = F.coalesce(F.array_max(F.slice("_new", 1, F.col("_i"))), F.col("_cur"))
    verdicts = each.select(F.col("_z._a._n").alias("_n"), F.col("_z._new").alias("_new"), met.alias("current_version"))
    flagged = batch.join(verdicts, "_n").drop("_o", "_n")
    kind = updates.schema[version].dataType
    accepted = flagged.filter("_new is not null").withColumn(version, F.col("_new").cast(kind)).drop("_new", "current_version")
    conflicts = flagged.filter("_new is null").drop("_new").withColumn("current_version", F.col("current_version").cast(kind))
    return {"accepted": accepted, "conflicts": conflicts, "table": upsert(base, accepted, key, version)}
