"""Term dictionary reports (A22, A24): term lists, df histograms, field profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.operators.util import global_row_number, rank_small


def terms_list(index, *, lower: str | None = None, upper: str | None = None, lower_incl: bool = True,
               upper_incl: bool = True, prefix: str | None = None, regex: str | None = None,
               mincount: int = 1, maxcount: int = -1, limit: int = 10, sort: str = "count") -> DataFrame:
    """Terms of a field with their doc frequency (A22): bounds, prefix, regex, min/max df,
    sorted by count (df desc, term asc) or index (term asc), top ``limit`` (−1 = all)."""
    t = index.term_stats.select("term", "df")
    if lower is not None:
        t = t.filter(F.col("term") >= lower if lower_incl else F.col("term") > lower)
    if upper is not None:
        t = t.filter(F.col("term") <= upper if upper_incl else F.col("term") < upper)
    if prefix:
        t = t.filter(F.col("term").startswith(prefix))
    if regex:
        t = t.filter(F.col("term").rlike(f"^(?:{regex})$"))
    if mincount > 0:
        t = t.filter(F.col("df") >= mincount)
    if maxcount >= 0:
        t = t.filter(F.col("df") <= maxcount)
    order = [F.col("df").desc(), F.col("term").asc()] if sort == "count" else [F.col("term").asc()]
    if limit is not None and limit >= 0:
        return rank_small(t.orderBy(*order).limit(limit), order)
    return global_row_number(t, order)


def df_histogram(index) -> DataFrame:
    """Number of terms per power-of-two doc-frequency bucket."""
    b = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("df").cast("double")))).cast("long")
    return index.term_stats.groupBy(b.alias("df_bucket")).agg(F.count(F.lit(1)).alias("terms"))


def field_profile(index) -> DataFrame:
    """Docs having the field, distinct terms, total docs (A24) — three small aggregates, one row."""
    docs_with = index.postings.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("docs_with_field"))
    n_terms = index.term_stats.agg(F.count(F.lit(1)).alias("distinct_terms"))
    return docs_with.crossJoin(n_terms).crossJoin(index.field_stats.select("n_docs"))


def field_profiles(docs: DataFrame, id_col: str, chains: dict) -> DataFrame:
    """Profile of several fields in one pass (A24): ``field, docs_with_field, distinct_terms, tokens, top_term, n_docs``.
    ``chains``: the analyzer of each field. One aggregate per (field, term) carries the documents' share; the most frequent term
    (ties: the smallest) is its ``top_term``."""
    from searchlake.operators.analysis import per_field_tokens

    tokens = per_field_tokens(docs, id_col, chains)
    per_doc = tokens.groupBy("field", "doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    terms = per_doc.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))
    own = terms.groupBy("field").agg(
        F.count(F.lit(1)).alias("distinct_terms"), F.sum("ttf").alias("tokens"), F.min(F.struct((-F.col("df")).alias("m"), "term"))["term"].alias("top_term"))
    with_field = per_doc.groupBy("field", "doc_id").agg(F.lit(1).alias("one")).groupBy("field").agg(F.count(F.lit(1)).alias("docs_with_field"))
    return with_field.join(own, "field").crossJoin(F.broadcast(docs.agg(F.count(F.lit(1)).alias("n_docs"))))


def top_terms(index, n: int = 10) -> DataFrame:
    """Top ``n`` terms by df (A24 top terms)."""
    return terms_list(index, limit=n)
