r"""Operator 12, source divergence audit: an Arrow compute pipeline and merged columnar shards.

Terms are ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` after A-Z are lower-cased; a language keeps the terms that stand in at least
``min_docs`` of its documents. Within a language every source's smoothed term frequencies
``p = 1 + floor(ONE * (count + 2) / (N + 2 V))`` are compared with every other source's and with the language's by
``f = floor((p - q)^2 / (p + q))``, summed over the kept terms; all in integers.

1. ``partial_counts``: in ``mapInArrow`` the texts go through ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and
   two hash ``group_by`` (document and term, then language, source and term). A task merges its partial counts and hands
   them on when they exceed ``HELD_ROWS`` rows.
2. Spark adds the partial counts per (language, source, term): a hot source or word sends one row per task and flush. Then
   the document frequency per (language, term), over at most one row per source, decides which terms are kept.
3. The kept counts, written once, are dealt to shards by (language, hash of the term, block of ``SOURCE_BLOCK`` sources);
   each shard meets its language's table of sources (denominators) in a cogrouped Arrow task, builds dense
   columns of at most ``CELLS`` cells for some terms at a time, and returns for its sources the summed divergences to the later sources
   and the ten best terms. Sums over shards and the ranking are Spark's.

Defined results: null text, language and source are the empty string; a source without terms, or a language without kept
terms, still has its pairs (value 0 in the latter case); equal rows count each; ties are ranked by the item's UTF-8 bytes; an
empty table gives an empty result; long texts are whole; extra columns are ignored. Counts may exceed what fits
the scaled 64-bit division: then the shard calculates with Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_groups, release_memory, ship_package, stage, text_or_empty

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
ONE = 1_000_000_000
TOP_TERMS = 10
GROUP_BYTES = 4 << 20
HELD_ROWS = 400_000
SHARD_ROWS = 200_000
SOURCE_BLOCK = 256
CELLS = 1 << 21
KEYS = ["lang", "source", "term"]


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """lang, source, term, n (occurrences), docs (rows that hold the term) of some documents."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), NO_TERM)
    row, term = pc.list_parent_indices(words), pc.list_flatten(words).dictionary_encode()
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    width = len(source.dictionary)
    site = pc.add(pc.multiply(lang.indices.cast(pa.int64()), width), source.indices)
    each = pa.table({"row": row, "term": term.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    each = each.append_column("site", site.take(each["row"]))
    total = each.group_by(["site", "term"], use_threads=False).aggregate([("count_all", "sum"), ("row", "count")])
    of_lang = pc.divide(total["site"], width)
    of_source = pc.subtract(total["site"], pc.multiply(of_lang, width))
    out = pa.table({"lang": _taken(lang, of_lang), "source": _taken(source, of_source), "term": _taken(term, total["term"]),
                    "n": total["count_all_sum"], "docs": total["row_count"]})
    # a text that starts or ends with a separator gives an empty word
    return out.filter(pc.not_equal(out["term"], ""))


def _taken(coded: pa.DictionaryArray, at: pa.ChunkedArray) -> pa.Array:
    return coded.dictionary.take(at.combine_chunks()).cast(pa.string())


def added(tables: list[pa.Table]) -> pa.Table:
    """Partial counts merged."""
    out = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select([*KEYS, "n", "docs"])


def partial_counts(docs: DataFrame) -> DataFrame:
    """docs(lang, source, text) -> partial counts lang, source, term, n, docs."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            for a, z in byte_groups(b.column(2), GROUP_BYTES):
                held.append(count_terms(*b.slice(a, z - a).columns))
                rows += len(held[-1])
                if rows >= HELD_ROWS:
                    held = [added(held)]
                    rows = len(held[0])
                    if rows >= HELD_ROWS // 2:
                        yield from held[0].combine_chunks().to_batches()
                        held, rows = [], 0
                        release_memory()
        if held:
            yield from added(held).combine_chunks().to_batches()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def smoothed(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(ONE * (n + 2) / total), exactly."""
    if int(n.max(initial=0)) + 2 > (1 << 62) // ONE:
        n, total = n.astype(object), np.asarray(total).astype(object)
    return (1 + ONE * (n + 2) // total).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); p and q are at most ONE + 1, so the square fits."""
    d = p - q
    return d * d // (p + q)


def compare_shard(sources: list[str], totals: np.ndarray, lang_total: int, terms: list[str], at_term: np.ndarray,
                  at_source: np.ndarray, n: np.ndarray, low: int, high: int, top: int):
    """Pair sums and best terms of the sources [low, high).

    sources in order with their denominators; terms in order; (at_term, at_source, n) the sparse counts.
    Returns {(i, j): value} for j > i as arrays (i, j, value), and a list of (i, term, value).
    """
    width = len(sources)
    sums = np.zeros((high - low, width), np.int64)
    best: list[list[tuple[int, int]]] = [[] for _ in range(high - low)]
    order = np.argsort(at_term, kind="stable")
    at_term, at_source, n = at_term[order], at_source[order], n[order]
    step = max(1, CELLS // max(1, width))
    for first in range(0, len(terms), step):
        a, z = np.searchsorted(at_term, [first, first + step])
        count = np.zeros((width, min(step, len(terms) - first)), np.int64)
        count[at_source[a:z], at_term[a:z] - first] = n[a:z]
        p = smoothed(count, totals[:, None])
        whole = smoothed(count.sum(axis=0), np.array([lang_total]))
        for i in range(low, high):
            sums[i - low, i + 1:] += divergence(p[i + 1:], p[i]).sum(axis=1)
            more = np.flatnonzero((count[i] > 0) & (p[i] > whole))
            value = divergence(p[i][more], whole[more])
            keep = np.argsort(-value, kind="stable")[:top]
            found = best[i - low] + list(zip((-value[keep]).tolist(), (more[keep] + first).tolist(), strict=True))
            best[i - low] = sorted(found)[:top]
    i, j = np.nonzero(np.arange(width)[None, :] > np.arange(low, high)[:, None])
    return (i + low, j, sums[i, j]), [(k + low, terms[t], -v) for k, some in enumerate(best) for v, t in some]


def _shard_task(top: int):
    def run(key, counts: pa.Table, sites: pa.Table) -> pa.Table:
        block = key[2].as_py()
        sites = sites.sort_by("source")
        sources = sites["source"].to_pylist()
        low, high = block * SOURCE_BLOCK, min(len(sources), (block + 1) * SOURCE_BLOCK)
        kinds = counts["term"].combine_chunks().dictionary_encode()
        terms = kinds.dictionary.to_pylist()
        order = sorted(range(len(terms)), key=terms.__getitem__)
        place = np.empty(len(terms), np.int64)
        place[order] = np.arange(len(terms))
        at_source = pc.index_in(counts["source"], sites["source"].combine_chunks()).to_numpy()
        totals = sites["total"].to_numpy()
        lang_total = sites["lang_total"][0].as_py() if len(sites) else 0
        (i, j, value), best = compare_shard(
            sources, totals, lang_total, [terms[k] for k in order], place[kinds.indices.to_numpy()], at_source.astype(np.int64),
            counts["n"].to_numpy(), low, max(low, high), top)
        lang = key[0].as_py()
        names = pa.array(sources, pa.string())
        rows = len(i) + len(best)
        source = pa.concat_arrays([names.take(pa.array(i, pa.int64())), pa.array([sources[b[0]] for b in best], pa.string())])
        item = pa.concat_arrays([names.take(pa.array(j, pa.int64())), pa.array([b[1] for b in best], pa.string())])
        part = pa.array(["pair"] * len(i) + ["term"] * len(best), pa.string())
        values = pa.concat_arrays([pa.array(value, pa.int64()), pa.array([b[2] for b in best], pa.int64())])
        return pa.table({"lang": pa.array([lang] * rows, pa.string()), "source": source, "part": part, "item": item, "value": values})
    return run


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
          top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    ship_package(docs.sparkSession)
    rows = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("text"))
    counts = partial_counts(rows).groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    one_term = Window.partitionBy("lang", "term")
    head = F.row_number().over(one_term.orderBy("source")) == 1
    kept = stage(counts.withColumns({"df": F.sum("docs").over(one_term), "head": head}).where(F.col("df") >= min_docs)
                 .select(*KEYS, "n", F.col("head").cast("long").alias("head")), "op12-kept")

    per_lang = kept.groupBy("lang").agg(F.sum("head").alias("v"), F.sum("n").alias("lang_n"))
    per_site = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    sites = stage(rows.select("lang", "source").distinct().join(per_site, ["lang", "source"], "left").join(per_lang, "lang", "left").select(
        "lang", "source", (F.coalesce("n", zero) + 2 * F.coalesce("v", zero)).alias("total"),
        (F.coalesce("lang_n", zero) + 2 * F.coalesce("v", zero)).alias("lang_total")), "op12-sites")

    shards = max(1, -(-kept.count() // SHARD_ROWS))
    widest = sites.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    blocks = F.explode(F.sequence(F.lit(0), F.lit(-(-widest // SOURCE_BLOCK) - 1))).alias("block")
    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard")
    dealt = kept.select("lang", "source", "term", "n", shard, blocks).groupBy("lang", "shard", "block")
    every = sites.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).select("*", blocks)
    found = stage(dealt.cogroup(every.groupBy("lang", "shard", "block")).applyInArrow(
        _shard_task(top_terms), "lang string, source string, part string, item string, value long"), "op12-found")

    pairs = (found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")))
    back = pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(back).withColumn("rank", F.row_number().over(ranked)).unionByName(terms)
