"""Sort, paging and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators.util import global_row_number, parse_sort, rank_small


def sort_keys(sort, key: str | None = None, missing: str = "last") -> list[Column]:
    """Sort spec → Columns; ``missing`` places NULLs ``first``/``last`` on every key.

    Ties are always broken by ``key`` ascending (D4)."""
    cols = []
    for c in parse_sort(sort):
        cols.append(c)
    if missing == "first":
        fixed = []
        for spec in (sort.split(",") if isinstance(sort, str) else []):
            bits = spec.split()
            name, d = bits[0], (bits[1].lower() if len(bits) > 1 else "asc")
            fixed.append(F.col(name).desc_nulls_first() if d == "desc" else F.col(name).asc_nulls_first())
        cols = fixed or cols
    if key is not None:
        cols.append(F.col(key).asc())
    return cols


def sort_docs(df: DataFrame, sort, key: str, missing: str = "last") -> DataFrame:
    """Full sort with an explicit 1-based ``rank`` (distributed row number, no single partition)."""
    return global_row_number(df, sort_keys(sort, key, missing), "rank")


def page(df: DataFrame, sort, key: str, start: int = 0, rows: int = 10, missing: str = "last") -> DataFrame:
    """``start``/``rows`` page (O08): ``orderBy.offset.limit`` → TakeOrderedAndProject, rank column kept."""
    order = sort_keys(sort, key, missing)
    q = df.orderBy(*order)
    if start:
        q = q.offset(start)
    return rank_small(q.limit(rows), order, "rank", start)


def search_after(df: DataFrame, sort: list[tuple[str, str]], key: str, after: list, rows: int = 10) -> DataFrame:
    """Deep paging by cursor (O09): rows strictly after the last seen sort values (and key).

    ``sort`` = ``[(col, 'asc'|'desc'), ...]``; ``after`` = values of those columns plus the key.
    Lexicographic predicate is pushed into the scan where possible, then a top-k.
    """
    spec = list(sort) + [(key, "asc")]
    pred = None
    for i in range(len(spec)):
        name, d = spec[i]
        c = F.col(name)
        cmp = c < F.lit(after[i]) if d == "desc" else c > F.lit(after[i])
        for j in range(i):
            cmp = cmp & (F.col(spec[j][0]) == F.lit(after[j]))
        pred = cmp if pred is None else pred | cmp
    order = [F.col(n).desc() if d == "desc" else F.col(n).asc() for n, d in spec]
    return rank_small(df.filter(pred).orderBy(*order).limit(rows), order, "rank")


def random_sort(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Reproducible shuffle (O05): order by ``xxhash64(seed, key)``; rank column kept."""
    r = F.xxhash64(F.lit(seed), F.col(key))
    return global_row_number(df.withColumn("_rnd", r), [F.col("_rnd"), F.col(key)], "rank").drop("_rnd")


def collated_sort_key(c, collation: str = "UNICODE_CI") -> Column:
    """Locale-aware sort key (O06): Spark collations, e.g. ``UNICODE_CI``, ``UNICODE_CI_AI``, ``de_CI``."""
    x = F.col(c) if isinstance(c, str) else c
    return F.collate(x, collation)
