"""Index-statistics functions (X47–X53) as per-doc columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def index_function_table(index, docs: DataFrame, term: str, id_col: str = "doc_id") -> DataFrame:
    """docfreq, totaltermfreq, sumtotaltermfreq, idf (classic 1+ln(N/(df+1))), termfreq, tf (√freq),
    norm (1/√len), maxdoc, numdocs — per doc, for one term (X47–X53).

    Collection-level values are a one-row aggregate broadcast to every doc; the per-doc term
    frequency is a left join of the term's postings (a filtered, small side)."""
    st = index.term_stats.filter(F.col("term") == term).select("df", "ttf")
    one = index.field_stats.select("n_docs", "sum_ttf").crossJoin(
        st.agg(F.coalesce(F.max("df"), F.lit(0)).alias("docfreq"),
               F.coalesce(F.max("ttf"), F.lit(0)).alias("totaltermfreq")))
    p = index.terms([term]).select(F.col("doc_id").alias(id_col), "tf")
    lens = index.postings.select("doc_id", "dl").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", id_col)
    j = docs.select(id_col).join(p, id_col, "left").join(lens, id_col, "left").crossJoin(F.broadcast(one))
    n = F.col("n_docs").cast("double")
    return j.select(
        id_col, F.col("docfreq").cast("long").alias("docfreq"), F.col("totaltermfreq").cast("long").alias("totaltermfreq"),
        F.col("sum_ttf").cast("long").alias("sumtotaltermfreq"),
        F.round(F.lit(1.0) + F.ln(n / (F.col("docfreq") + 1.0)), 9).alias("idf"),
        F.coalesce(F.col("tf"), F.lit(0)).cast("long").alias("termfreq"),
        F.round(F.sqrt(F.coalesce(F.col("tf"), F.lit(0)).cast("double")), 9).alias("tf"),
        F.round(F.when(F.col("dl") > 0, F.lit(1.0) / F.sqrt(F.col("dl").cast("double"))), 9).alias("norm"),
        F.col("n_docs").cast("long").alias("maxdoc"), F.col("n_docs").cast("long").alias("numdocs"))
