"""Return-field projections."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, spec: str = "*", **functions: Column) -> DataFrame:
    """Field list (R01/R02): names, ``*``, globs (``l_*flag``), renames ``new:old``, plus
    function pseudo-fields given as keyword Columns. Unknown names are ignored like the reference."""
    cols: list[Column] = []
    seen = set()
    for item in [s.strip() for s in spec.split(",") if s.strip()]:
        if ":" in item:
            new, old = [x.strip() for x in item.split(":", 1)]
            if old in df.columns:
                cols.append(F.col(old).alias(new))
                seen.add(new)
            continue
        for c in df.columns:
            if (item == "*" or fnmatch.fnmatchcase(c, item)) and c not in seen:
                cols.append(F.col(c))
                seen.add(c)
    for name, expr in functions.items():
        cols.append(expr.alias(name))
    return df.select(*cols)


def with_value(df: DataFrame, name: str, value, type_: str = "string") -> DataFrame:
    """Constant pseudo-field ``[value v= t=]`` (R04): int, long, float, double, date, string."""
    t = {"int": "int", "long": "bigint", "float": "float", "double": "double", "date": "timestamp",
         "string": "string"}[type_]
    return df.withColumn(name, F.lit(value).cast(t))


def with_source(df: DataFrame, name: str = "_source") -> DataFrame:
    """Source-of-row marker (R07): the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path"))
