"""The corpus pipeline: quality classifier, line dedup, near-dedup, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet and
reads again as the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.llm import bagminhash, line_dedup, mixing, packing, quality
from searchlake.llm.common import ship_package
from searchlake.session import ensure_checkpoint_dir, scratch_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents with a quality posterior below the threshold go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: cross-site boilerplate lines go; the character count follows the text."""
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        changed = F.col(out.columns[-1])["n_removed"] > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each near-duplicate group stays."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return bagminhash.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every document as often as the mix takes it."""
    return mixing.take_copies(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: pieces in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("source_mix", mix_stage),
    ("packing", pack_stage),
]

#: The regression, the signatures and the random rounding have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
