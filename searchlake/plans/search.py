"""One-call search (C01): q + fq + sort + page + facets + stats over one match set.

``Search`` only composes the operators; ``run()`` returns a dict of lazy DataFrames that all
read the same match set. With ``cache=True`` the match set is persisted once (the analogue of
the reference's DocSet reuse); otherwise each output re-reads the scan, which Catalyst prunes
to the columns that output needs.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators import facets as fc
from searchlake.operators import sorting, stats
from searchlake.operators.util import null_false


class Search:
    def __init__(self, docs: DataFrame, key: str):
        self.docs = docs
        self.key = key
        self.q: Column | None = None
        self.scored: DataFrame | None = None
        self.filters: list[tuple[Column, str | None]] = []
        self.sort_spec = None
        self.start, self.rows = 0, 10
        self.field_facets: list[tuple[str, dict]] = []
        self.range_facets: list[tuple[str, tuple, dict]] = []
        self.query_facets: dict[str, Column] = {}
        self.stats_fields: list[tuple[str, str | None]] = []

    # ---- request building
    def query(self, q) -> "Search":
        """Main query: a predicate Column, or a scored ``(key, score)`` DataFrame."""
        if isinstance(q, DataFrame):
            self.scored = q
        else:
            self.q = q
        return self

    def filter(self, pred: Column, tag: str | None = None) -> "Search":
        self.filters.append((pred, tag))
        return self

    def sort(self, spec) -> "Search":
        self.sort_spec = spec
        return self

    def page(self, start: int, rows: int) -> "Search":
        self.start, self.rows = start, rows
        return self

    def facet_field(self, col: str, **kw) -> "Search":
        self.field_facets.append((col, kw))
        return self

    def facet_range(self, col: str, start, end, gap, **kw) -> "Search":
        self.range_facets.append((col, (start, end, gap), kw))
        return self

    def facet_query(self, name: str, pred: Column) -> "Search":
        self.query_facets[name] = pred
        return self

    def stats(self, col: str, facet: str | None = None) -> "Search":
        self.stats_fields.append((col, facet))
        return self

    # ---- execution
    def match_set(self, exclude_tags=()) -> DataFrame:
        d = self.docs
        if self.scored is not None:
            d = d.join(self.scored, self.key, "inner")
        elif self.q is not None:
            d = d.filter(null_false(self.q))
        for pred, tag in self.filters:
            if tag is None or tag not in exclude_tags:
                d = d.filter(null_false(pred))
        return d

    def run(self, cache: bool = False) -> dict[str, DataFrame]:
        m = self.match_set()
        if cache:
            m = m.persist(StorageLevel.MEMORY_AND_DISK)
        out: dict[str, DataFrame] = {}
        has_score = "score" in m.columns
        sort = self.sort_spec or ("score desc" if has_score else None)
        agg = [F.count(F.lit(1)).alias("num_found")]
        if has_score:
            agg.append(F.max("score").alias("max_score"))
        out["num_found"] = m.agg(*agg)
        out["response"] = sorting.page(m, sort, self.key, self.start, self.rows)
        for col, kw in self.field_facets:
            ex = kw.get("exclude", ())
            base = self.match_set(ex) if ex else m
            out[f"facet_field:{col}"] = fc.facet_field(base, col, **{k: v for k, v in kw.items() if k != "exclude"})
        for col, (s, e, g), kw in self.range_facets:
            out[f"facet_range:{col}"] = fc.facet_range(m, col, s, e, g, **kw)
        if self.query_facets:
            out["facet_queries"] = fc.facet_queries(m, self.query_facets)
        for col, facet in self.stats_fields:
            out[f"stats:{col}"] = stats.stats_field(m, col, facet)
        return out

    def summary(self, cache: bool = False) -> DataFrame:
        """All outputs in one long table: ``section, name, label, count, value``."""
        res = self.run(cache)
        parts = []
        nf = res["num_found"]
        parts.append(nf.select(F.lit("num_found").alias("section"), F.lit("").alias("name"),
                               F.lit(None).cast("string").alias("label"),
                               F.col("num_found").cast("long").alias("count"),
                               F.lit(None).cast("double").alias("value")))
        resp = res["response"]
        sort_col = None
        if isinstance(self.sort_spec, str):
            sort_col = self.sort_spec.split(",")[0].split()[0]
        parts.append(resp.select(F.lit("response").alias("section"), F.col(self.key).cast("string").alias("name"),
                                 F.col("rank").cast("string").alias("label"),
                                 F.lit(None).cast("long").alias("count"),
                                 (F.col(sort_col).cast("double") if sort_col else F.lit(None).cast("double"))
                                 .alias("value")))
        for k, d in res.items():
            if k.startswith("facet_field:"):
                col = k.split(":", 1)[1]
                parts.append(d.select(F.lit("facet_field").alias("section"), F.lit(col).alias("name"),
                                      F.col(col).cast("string").alias("label"), F.col("count").cast("long"),
                                      F.lit(None).cast("double").alias("value")))
            elif k.startswith("facet_range:"):
                col = k.split(":", 1)[1]
                parts.append(d.select(F.lit("facet_range").alias("section"), F.lit(col).alias("name"),
                                      F.coalesce(F.col("low").cast("string"), F.col("label")).alias("label"),
                                      F.col("count").cast("long"), F.lit(None).cast("double").alias("value")))
            elif k.startswith("stats:"):
                col = k.split(":", 1)[1]
                stat_cols = [c for c in ("min", "max", "sum", "mean", "stddev") if c in d.columns]
                for sc in stat_cols:
                    parts.append(d.select(F.lit("stats").alias("section"), F.lit(col).alias("name"),
                                          F.lit(sc).alias("label"), F.col("count").cast("long"),
                                          F.round(F.col(sc).cast("double"), 6).alias("value")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
