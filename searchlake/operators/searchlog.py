"""Search-log analytics (A29): top queries, zero-hit queries, facet use, searches per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def search_log_report(log: DataFrame) -> DataFrame:
    """One long table ``report, key, n`` from a single scan: each log row is tagged with the
    report keys it contributes to (explode of a small fixed array), then one aggregate."""
    tags = F.array(
        F.struct(F.lit("top_query").alias("report"), F.col("query_q").alias("key")),
        F.when(F.col("result_cnt") == 0, F.struct(F.lit("zero_hits").alias("report"), F.col("query_q").alias("key"))),
        F.struct(F.lit("facet_use").alias("report"), F.col("facet_yn").alias("key")),
        F.struct(F.lit("per_user").alias("report"), F.col("user_name").alias("key")))
    rows = log.select(F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("t")).select("t.*")
    return rows.groupBy("report", "key").agg(F.count(F.lit(1)).alias("n"))
