"""Join filters (J01–J07): the reference has filtering joins, not general joins.

All are semi/anti joins or left joins against a small side. Small sides built from user rules
are broadcast; data-derived sides are broadcast only after a bounded size check
(``bounded_broadcast``), otherwise a shuffle join is planned (and AQE may still convert it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from searchlake.operators.util import bounded_broadcast


def _keys(df: DataFrame, col: str, name: str) -> DataFrame:
    if isinstance(df.schema[col].dataType, ArrayType):
        return df.select(F.explode(F.col(col)).alias(name))
    return df.select(F.col(col).alias(name))


def join_filter(to_df: DataFrame, to: str, from_df: DataFrame, from_: str, check_size: bool = False) -> DataFrame:
    """Keep docs of ``to_df`` whose ``to`` value equals a ``from_`` value of the matched ``from_df``
    docs (J01/J02), constant score, each doc once. Multi-valued fields on either side are
    exploded; the distinct ``from`` keys are the build side of a semi join."""
    keys = _keys(from_df, from_, "_k").filter(F.col("_k").isNotNull()).distinct()
    if check_size:
        keys = bounded_broadcast(keys)
    if isinstance(to_df.schema[to].dataType, ArrayType):
        # the distinct arrays that hold a matching element; equal documents stay separate rows
        arrays = to_df.select(F.col(to).alias("_a")).distinct()
        hit = (arrays.withColumn("_k", F.explode("_a")).join(keys, "_k", "left_semi")
               .select("_a").distinct())
        return to_df.join(hit, to_df[to] == hit["_a"], "left_semi")
    return to_df.join(keys, to_df[to] == keys["_k"], "left_semi")


def to_parent(children: DataFrame, parents: DataFrame, parent_key: str, child_parent_col: str,
              child_pred: Column | None = None) -> DataFrame:
    """Block join to parents (J03): parents having at least one child matching ``child_pred``."""
    c = children if child_pred is None else children.filter(F.coalesce(child_pred, F.lit(False)))
    return parents.join(c.select(F.col(child_parent_col).alias(parent_key)).distinct(), parent_key, "left_semi")


def to_child(children: DataFrame, parents: DataFrame, parent_key: str, child_parent_col: str,
             parent_pred: Column | None = None) -> DataFrame:
    """Block join to children (J04): children whose parent matches ``parent_pred``."""
    p = parents if parent_pred is None else parents.filter(F.coalesce(parent_pred, F.lit(False)))
    keys = p.select(F.col(parent_key).alias(child_parent_col))
    return children.join(keys, child_parent_col, "left_semi")


def joindf(df: DataFrame, id_col: str, link_df: DataFrame, link_col: str, name: str = "joindf") -> DataFrame:
    """Number of docs linking to each doc's id (J05): ``groupBy(link).count()`` left-joined, 0 if none."""
    counts = link_df.groupBy(F.col(link_col).alias(id_col)).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, id_col, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def external_score(df: DataFrame, key: str, scores: DataFrame, default: float = 0.0,
                   name: str = "external_score") -> DataFrame:
    """External float per key with a default (J06); the score file is broadcast after a size check."""
    s = bounded_broadcast(scores.select(F.col("key").alias(key), F.col("score").cast("double").alias(name)))
    return df.join(s, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(float(default))))


def elevate(hits: DataFrame, docs: DataFrame, key: str, rules: DataFrame, query: str,
            force: bool = True, exclusive: bool = False) -> DataFrame:
    """Editorial elevation (J07). ``rules``: ``query, doc_id, rank, exclude``. For the given query,
    excluded docs leave the hit list, elevated docs are added (``force``) and sorted first by
    their rule rank, then everyone else by score desc; ``exclusive`` keeps only elevated docs.
    Output: hits + ``elevated``, ``excluded`` markers (R06) and a final ``rank``."""
    r = bounded_broadcast(rules.filter(F.col("query") == query)
                          .select(F.col("doc_id").alias(key), F.col("rank").alias("_erank"), "exclude"))
    excl = r.filter(F.col("exclude")).select(key)
    elev = r.filter(~F.col("exclude")).select(key, "_erank")
    h = hits.join(excl, key, "left_anti")
    if force:
        extra = docs.join(elev.select(key), key, "left_semi").join(h.select(key), key, "left_anti") \
            .select(key).withColumn("score", F.lit(None).cast("double"))
        h = h.unionByName(extra, allowMissingColumns=True)
    h = h.join(elev, key, "left").withColumn("elevated", F.col("_erank").isNotNull()) \
        .withColumn("excluded", F.lit(False))
    if exclusive:
        h = h.filter("elevated")
    from searchlake.operators.util import global_row_number
    order = [F.col("_erank").asc_nulls_last(), F.col("score").desc_nulls_last(), F.col(key).asc()]
    return global_row_number(h, order, "rank").drop("_erank")


def mark_editorial(hits: DataFrame, key: str, rules: DataFrame, query: str) -> DataFrame:
    """``[elevated]`` / ``[excluded]`` markers without changing the hit list."""
    r = bounded_broadcast(rules.filter(F.col("query") == query).select(F.col("doc_id").alias(key), "exclude"))
    j = hits.join(r, key, "left")
    return j.withColumn("elevated", F.coalesce(~F.col("exclude"), F.lit(False))) \
        .withColumn("excluded", F.coalesce(F.col("exclude"), F.lit(False))).drop("exclude")
