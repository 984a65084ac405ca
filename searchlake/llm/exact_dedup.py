"""Operator 1, exact dedup: 128-bit content hash, smallest stable id, byte comparison.

Texts are equal when identical after replacing each run of ``[\\x20\\x09-\\x0D]`` by one space;
null counts as empty. Plan: (1) hash every text and aggregate ``hash -> (smallest id, rows)``
with map-side combining, so a hot group ships one row per task; (2) join the texts with the
hashes that occur more than once (one shuffle of the texts; a hot hash is a skewed side that
adaptive execution splits); (3) compare every member's text with the text of the group's
smallest id; members whose hash agrees but whose text differs (collisions) are grouped again
by the text itself.

Defined results: null ids sort last, so a group of null ids keeps a null id; equal rows with one
and the same id form a group of which exactly one row is kept; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stage, text_or_empty


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(col), SPACE, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                content_hash: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``content_hash`` maps the normalised text to the grouping hash; a weak one gives the same
    result through the comparison of texts (tests use that).
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hashed = docs.withColumn("h", content_hash(normalised()))
    repeated = stage(
        hashed.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "op1-repeated")
    norm = normalised()
    rows = stage(
        hashed.join(repeated.hint("merge"), "h", "left").select(
            "doc_id", "h", "first_id", "n", F.sha2(norm, 256).alias("text_sha256"),
            F.when(F.col("n").isNotNull(), norm).alias("norm")),
        "op1-rows")

    single = rows.where("n is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")

    member = rows.where("n is not null")
    first = stage(member.where("doc_id <=> first_id").groupBy("h").agg(F.min("norm").alias("first_norm")), "op1-first")
    compared = stage(
        member.join(first, "h").select(
            "doc_id", "h", "first_id", "n", "text_sha256", (F.col("norm") == F.col("first_norm")).alias("same"),
            F.when(F.col("norm") != F.col("first_norm"), F.col("norm")).alias("norm")),
        "op1-compared")
    collided = compared.where("not same")
    off = collided.groupBy("h").agg(F.count(F.lit(1)).alias("off"))
    regrouped = collided.groupBy("h", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classed = (
        compared.where("same").join(off, "h", "left").select(
            "doc_id", F.col("first_id").alias("keep_id"),
            (F.col("n") - F.coalesce("off", F.lit(0))).alias("group_size"), "text_sha256")
        .unionByName(collided.join(regrouped, ["h", "norm"]).select(
            "doc_id", "keep_id", "group_size", "text_sha256")))
    dropped = classed.where("not (doc_id <=> keep_id)").withColumn("kept", F.lit(False))
    # rows that carry the smallest id itself: one stays, equal rows with the same id go
    stays = (
        classed.where("doc_id <=> keep_id")
        .groupBy("doc_id", "keep_id", "group_size", "text_sha256").agg(F.count(F.lit(1)).alias("m"))
        .select("doc_id", "keep_id", "group_size",
                F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("i"), "text_sha256")
        .select("doc_id", "keep_id", "group_size", (F.col("i") == 1).alias("kept"), "text_sha256"))
    return single.unionByName(stays).unionByName(dropped.select(single.columns))
