"""Inverted-index build (T50) and the statistics scoring needs.

``postings``   ``term, doc_id, tf, dl, positions`` — one shuffle (``groupBy(doc_id, term)``, whose
               partial aggregate collapses each doc's tokens map-side, so the shuffle carries
               exactly the postings); ``dl`` (doc length) rides along so scoring never joins a
               doc table.
``term_stats`` ``term, df, ttf`` — aggregate of postings by term; map-side combine absorbs hot terms.
``field_stats``one row ``n_docs, sum_ttf, avgdl`` computed from doc lengths (no explode, no shuffle).

Nothing here is materialized; ``write_index`` persists it (postings sorted by term inside
files so a term filter prunes Parquet row groups) and ``read_index`` reads it back.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.operators.analysis import Analyzer, default_analyzer, token_table
from searchlake.operators.util import PART_BYTES, dealt, parts_of
from searchlake.session import scratch_dir


@dataclass
class Index:
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    tokens: DataFrame | None = None
    parts: int | None = None
    texts: DataFrame | None = None
    analyzer: Analyzer | None = None

    def terms(self, terms) -> DataFrame:
        """Postings of the given terms only: the filter reaches the scan, and in a term-dealt index only the folders of
        these terms are opened."""
        terms = list(terms)
        some = self.postings.filter(F.col("term").isin(terms))
        if self.parts is None:
            return some
        if not terms:
            return some.drop("part")
        return some.filter(F.col("part").isin([part_of(F.lit(t), self.parts) for t in terms])).drop("part")

    def stats_for(self, terms) -> DataFrame:
        """Statistics of the query's terms: at most ``len(terms)`` rows, safe to broadcast."""
        return F.broadcast(self.term_stats.filter(F.col("term").isin(list(terms))))


def build_index(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer | None = None,
                with_positions: bool = True, colocate: bool = True) -> Index:
    """Build postings, term statistics and field statistics for one text field.

    ``colocate``: hash-partition the documents by key once, into parts of bounded text; tokenizing then runs on every
    partition in parallel and the (term, doc) aggregate needs no further exchange, because
    hash partitioning on ``doc_id`` already clusters every ``(term, doc_id)`` group. That is
    the single shuffle of the build (raw docs instead of postings, about the same bytes).
    ``n_docs`` counts every doc, empty ones too; ``sum_ttf`` = Σ tf over the postings.
    """
    an = analyzer or default_analyzer()
    base = docs.select(id_col, text_col)
    if colocate:
        base = dealt(base, id_col, text_col)
    toks = token_table(base, id_col, text_col, an)
    aggs = [F.count(F.lit(1)).alias("tf")]
    if with_positions:
        aggs.append(F.sort_array(F.collect_list("pos")).alias("positions"))
    postings = toks.groupBy("term", "doc_id", "dl").agg(*aggs)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) if with_positions else None
    term_stats = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))
    field_stats = _field_stats(docs.select(id_col), postings)
    return Index(postings, term_stats, field_stats, toks, texts=texts, analyzer=an)


def _field_stats(doc_keys: DataFrame, postings: DataFrame) -> DataFrame:
    n = doc_keys.agg(F.count(F.lit(1)).alias("n_docs"))
    tot = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).cast("long").alias("sum_ttf"))
    return n.crossJoin(tot).withColumn("avgdl", F.col("sum_ttf") / F.col("n_docs"))


def write_index(index: Index, path: str, docs: DataFrame | None = None, id_col: str = "doc_id",
                mode: str = "overwrite") -> Index:
    """Persist an index with ONE tokenization pass, and return it re-read from storage.

    Postings are written first, sorted by term inside each file (``sortWithinPartitions``;
    no extra shuffle), so a query's ``term IN (...)`` filter reaches only the matching row
    groups. Term and field statistics are then aggregated from the *written* postings rather
    than by re-tokenizing the documents."""
    spark = index.postings.sparkSession
    index.postings.sortWithinPartitions("term", "doc_id").write.mode(mode).parquet(f"{path}/postings")
    postings = spark.read.parquet(f"{path}/postings")
    postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf")) \
        .write.mode(mode).parquet(f"{path}/term_stats")
    keys = docs.select(id_col) if docs is not None else postings.select("doc_id").distinct()
    _field_stats(keys, postings).write.mode(mode).parquet(f"{path}/field_stats")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    return Index(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/term_stats"),
                 spark.read.parquet(f"{path}/field_stats"))


# ------------------------------------------------------------------ postings dealt by term

def part_of(term: Column, parts: int) -> Column:
    """Number of the folder that holds a term's postings."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


#: Bytes of text in a part of documents whose tokens are grouped by Arrow batches, about one batch: larger ones repeat a term less often.
LIST_BYTES = 8 * PART_BYTES


def _term_lists(texts: DataFrame, an: Analyzer, files: int) -> DataFrame:
    """``file, term, docs, dls, places, positions``: the postings of an Arrow batch of documents, two rows at most for each term: its documents
    that hold it once, with their ``places``, and the others with their arrays of ``positions``.

    In this form postings travel to their term's folder: the term once for a batch, no row for a posting, no array for a single place. ``file``
    is a hash of the document; a batch's tokens bound a row. The documents (``doc_id, text``) are dealt first, so that a task holds the lists
    of ``LIST_BYTES`` of text whatever the files are. Rows of one ``doc_id`` need not meet here; their postings do where they arrive."""
    def lists(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def cut(values, starts):
            return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype("int32")), values)

        for b in batches:
            toks = b.column("toks")
            terms, row = toks.flatten(), pc.list_parent_indices(toks).to_numpy()
            first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False))])
            place, held = np.arange(len(row)) - first[row], pc.is_valid(terms).to_numpy(zero_copy_only=False)
            coded, row, place = terms.filter(pa.array(held)).dictionary_encode(), row[held], place[held].astype("int32")
            dl = np.bincount(row, minlength=len(toks)).astype("int32")
            group = b.column("file").to_numpy()[row].astype("int64") * len(coded.dictionary) + coded.indices.to_numpy()
            order = np.lexsort((row, group))  # stable: places stay in order
            group, row, place = group[order], row[order], place[order]
            start = np.flatnonzero(np.diff(group, prepend=-1) | np.diff(row, prepend=-1))
            tf = np.diff(start, append=len(row))
            for once in (True, False):
                mine = np.flatnonzero((tf == 1) == once)
                at = start[mine]
                heads = np.flatnonzero(np.diff(group[at], prepend=-1))
                file, code = np.divmod(group[at][heads], max(1, len(coded.dictionary)))
                if once:
                    places, positions = cut(pa.array(place[at]), heads), pa.nulls(len(heads), pa.list_(pa.list_(pa.int32())))
                else:
                    all_places = pa.array(place[np.repeat(tf != 1, tf)])
                    places, positions = pa.nulls(len(heads), pa.list_(pa.int32())), cut(cut(all_places, np.cumsum(tf[mine]) - tf[mine]), heads)
                yield from pa.table({
                    "file": pa.array(file.astype("int32")), "term": coded.dictionary.take(pa.array(code)),
                    "docs": cut(b.column("doc_id").take(pa.array(row[at])), heads), "dls": cut(pa.array(dl[row[at]]), heads),
                    "places": places, "positions": positions}).to_batches(10_000)

    texts = texts.repartition(parts_of(texts, "text", LIST_BYTES), "doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    file = F.pmod(F.xxhash64("doc_id"), F.lit(files)).cast("int").alias("file")
    return texts.select("doc_id", an.array(F.col("text")).alias("toks"), file).mapInArrow(
        lists, f"file int, term string, docs array<{kind}>, dls array<int>, places array<int>, positions array<array<int>>")


def write_term_index(index: Index, path: str, docs: DataFrame, id_col: str, docs_a_part: int = 20_000, docs_a_file: int = 500_000,
                     least_parts: int = 16, text_col: str | None = None) -> Index:
    """Persist an index dealt by term, and return it re-read from storage.

    A term's postings lie in one folder (``part``, a hash of the term); a term query opens its terms' folders only, and there the row
    groups whose range of terms has them. Postings travel once, as ``_term_lists``; an index without texts deals its postings. Every folder has a file for each ``docs_a_file`` documents (dealt by a hash of the document),
    so the postings of a term that stands in all documents are many files, not one. The number of folders grows with the documents, and
    with ``text_col`` with the bytes of their texts; a task sorts and writes one file."""
    spark = index.postings.sparkSession
    n_docs = docs.count()
    files = max(1, -(-n_docs // docs_a_file))
    parts = max(least_parts, -(-n_docs // docs_a_part), -(-parts_of(docs, text_col) // files) if text_col else 0)
    if index.texts is None:
        dealt_by = part_of(F.col("term"), parts) * files + F.pmod(F.xxhash64("doc_id"), F.lit(files)).cast("int")
        rows = index.postings.repartitionById(parts * files, dealt_by)
    else:
        dealt_by = (part_of(F.col("term"), parts) * files + F.col("file")).alias("dealt")
        lists = _term_lists(index.texts, index.analyzer, files).select(dealt_by, "term", "docs", "dls", "places", "positions")
        positions = F.coalesce("positions", F.transform("places", lambda p: F.array(p))).alias("positions")
        rows = (lists.repartitionById(parts * files, "dealt").select("dealt", "term", "docs", "dls", positions)
                .select("dealt", "term", F.explode(F.arrays_zip("docs", "dls", "positions")).alias("t"))
                .groupBy("dealt", "term", F.col("t.docs").alias("doc_id"), F.col("t.dls").alias("dl"))
                .agg(F.sort_array(F.flatten(F.collect_list("t.positions"))).alias("positions"))
                .select("term", "doc_id", "dl", F.size("positions").cast("long").alias("tf"), "positions"))
    (rows.withColumn("part", part_of(F.col("term"), parts)).sortWithinPartitions("part", "term", "doc_id")
     .write.partitionBy("part").option("compression", "zstd").parquet(f"{path}/postings"))
    postings = spark.read.parquet(f"{path}/postings")
    postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf")).sortWithinPartitions("term") \
        .write.parquet(f"{path}/term_stats")
    _field_stats(docs.select(id_col), postings).withColumn("parts", F.lit(parts)).write.parquet(f"{path}/field_stats")
    return read_term_index(spark, path)


def read_term_index(spark: SparkSession, path: str) -> Index:
    fields = spark.read.parquet(f"{path}/field_stats")
    return Index(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/term_stats"), fields.drop("parts"), parts=fields.first()["parts"])


_WRITTEN: dict[tuple, str] = {}


def session_index(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer | None = None, name: str = "default") -> Index:
    """The term-dealt index of a table read from files, written once per application and list of files (and ``name``, which
    stands for the analyzer) to the shared scratch folder; every further call reads it. A folder that has gone is written anew."""
    spark = docs.sparkSession
    key = (spark.sparkContext.applicationId, tuple(sorted(docs.inputFiles())), id_col, text_col, name)
    if key in _WRITTEN:
        try:
            return read_term_index(spark, _WRITTEN[key])
        except (AnalysisException, Py4JJavaError):
            del _WRITTEN[key]
    path = scratch_dir(spark, "index")
    index = write_term_index(build_index(docs, id_col, text_col, analyzer), path, docs, id_col, text_col=text_col)
    _WRITTEN[key] = path
    return index


def term_vectors(index: Index, doc_ids: list | None = None) -> DataFrame:
    """Per-doc term report (A25): tf, positions, df, and tf/df (the report's own "tf-idf")."""
    p = index.postings if doc_ids is None else index.postings.filter(F.col("doc_id").isin(doc_ids))
    j = p.join(index.term_stats, "term")
    return j.select("doc_id", "term", "tf", "positions", "df", (F.col("tf") / F.col("df")).alias("tf_idf"))
