"""Match-set algebra (U01–U04): sets of keys as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intersect_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in both (U01): semi join, then de-duplicate (a set has each key once)."""
    return a.select(key).join(b.select(key), key, "left_semi").distinct()


def union_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in either."""
    return a.select(key).unionByName(b.select(key)).distinct()


def difference_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of ``a`` not in ``b`` (U03, andNot)."""
    return a.select(key).join(b.select(key), key, "left_anti").distinct()


def set_sizes(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """|a∩b|, |a∪b|, |a−b| and whether they intersect, from one tagged union + two aggregates.

    No join: tag each side, collapse per key (which sides hold it), then count the patterns.
    """
    tagged = a.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    per_key = tagged.groupBy(key).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    both = (F.col("_a") == 1) & (F.col("_b") == 1)
    return per_key.agg(
        F.count_if(both).alias("intersection_size"),
        F.count(F.lit(1)).alias("union_size"),
        F.count_if((F.col("_a") == 1) & (F.col("_b") == 0)).alias("and_not_size"),
        (F.count_if(both) > 0).alias("intersects"))
