"""Result grouping.

Docs are ranked inside their group by a window partitioned by the group key, filtered with
``rank <= offset + limit`` right above the window so Spark plans a partial
``WindowGroupLimit`` before the shuffle: a hot group ships at most that many rows per map
task. Groups are ordered by their head document under the main sort, which is again a
top-1-per-group window followed by a bounded top-k (or a distributed row number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.util import global_row_number, null_false, parse_sort, rank_small


def _order(sort, key: str) -> list[Column]:
    cols = parse_sort(sort)
    return cols + [F.col(key).asc()]


def group_by_field(df: DataFrame, group: str | Column, *, key: str, sort="score desc",
                   group_sort=None, limit: int = 10, offset: int = 0, group_limit: int = 1,
                   group_offset: int = 0, fmt: str = "grouped", group_name: str = "group_value") -> DataFrame:
    """Top ``group_limit`` docs (from ``group_offset``) of each of the first ``limit`` groups.

    ``group`` may be a column name or an expression (group by function value, W02). NULL is
    a group of its own (W04). Groups are ordered by their best doc under ``sort`` (ties by
    ``key``), docs inside a group by ``group_sort`` (default: ``sort``). ``limit=-1`` keeps all
    groups. Output: input columns + ``group_value, group_rank, doc_rank``; ``fmt='simple'``
    drops nothing but is meant to be read in ``(group_rank, doc_rank)`` order (W06).
    """
    gcol = F.col(group) if isinstance(group, str) else group
    data = df.withColumn(group_name, gcol)
    main = _order(sort, key)
    inner = _order(group_sort, key) if group_sort is not None else main
    part = Window.partitionBy(group_name)
    # group heads under the main sort: top-1 per group (partial WindowGroupLimit)
    heads = data.withColumn("_h", F.row_number().over(part.orderBy(*main))).filter(F.col("_h") <= 1).drop("_h")
    if limit is not None and limit >= 0:
        picked = heads.orderBy(*main)
        if offset:
            picked = picked.offset(offset)
        picked = rank_small(picked.limit(limit), main, "group_rank", offset)
        groups = F.broadcast(picked.select(group_name, "group_rank"))  # at most `limit` rows
    else:
        groups = global_row_number(heads, main, "group_rank").select(group_name, "group_rank")
    top = group_offset + group_limit
    docs = data.withColumn("doc_rank", F.row_number().over(part.orderBy(*inner)).cast("long")) \
        .filter(F.col("doc_rank") <= top).filter(F.col("doc_rank") > group_offset)
    out = docs.join(groups, docs[group_name].eqNullSafe(groups[group_name]), "inner") \
        .drop(groups[group_name])
    if fmt == "simple":
        return out.withColumn("doc_rank", F.col("doc_rank") - F.lit(group_offset))
    return out


def group_by_query(df: DataFrame, queries: dict[str, Column], *, key: str, sort="score desc",
                   group_limit: int = 1) -> DataFrame:
    """One group per named predicate (W03): top ``group_limit`` matching docs of each."""
    names = list(queries)
    tags = F.filter(F.array(*[F.when(null_false(p), F.lit(n)) for n, p in queries.items()]),
                    lambda x: x.isNotNull())
    exploded = df.withColumn("group_value", F.explode(tags))
    w = Window.partitionBy("group_value").orderBy(*_order(sort, key))
    ranked = exploded.withColumn("doc_rank", F.row_number().over(w).cast("long")) \
        .filter(F.col("doc_rank") <= group_limit)
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("group_value"))
    return ranked.withColumn("group_rank", order.cast("long"))


def n_groups(df: DataFrame, group: str, where: Column | None = None) -> DataFrame:
    """``ngroups`` (NULL counts as one group) and ``matches``."""
    d = df if where is None else df.filter(null_false(where))
    return d.agg(
        (F.count_distinct(F.col(group)) + F.max(F.when(F.col(group).isNull(), 1).otherwise(0))).cast("long")
        .alias("ngroups"),
        F.count(F.lit(1)).alias("matches"))


def truncate_groups(df: DataFrame, group: str, *, key: str, sort="score desc") -> DataFrame:
    """Keep only each group's head doc (W07) — facets/stats then run over the heads."""
    w = Window.partitionBy(group).orderBy(*_order(sort, key))
    return df.withColumn("_h", F.row_number().over(w)).filter(F.col("_h") <= 1).drop("_h")
