"""Document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All docs of a collection."""
    return spark.read.parquet(path)


def scan_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several collections as one (S02/S15): union by column name, missing columns as NULL."""
    out = None
    for p in paths:
        d = spark.read.parquet(p)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def merge_tables(tables: list[DataFrame]) -> DataFrame:
    """Merge collections into one table."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
