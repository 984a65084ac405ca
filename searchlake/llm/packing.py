"""Operator 6, packing into optimal length buckets.

Documents become pieces of at most ``max_len`` tokens (longer ones are cut, nothing is dropped). The
global histogram of piece lengths (at most ``max_len`` rows) goes to the driver, where dynamic
programming finds the bucket boundaries with the least padding. Inside a bucket, pieces fill batches
of ``batch_tokens`` padded tokens. Places come from one distributed ranking by (bucket, hash, id, piece):
the rank minus the pieces of the buckets before (known from the histogram) is the place in the bucket,
so a bucket with a third of all rows is no single task's work, and only a bucket's last batch can be
short.

A document's length is its words plus one for the end mark (callers may give another length column).

Defined results: null and empty texts have length 1; null lengths count as 0 and become one piece of
length 1; equal rows are separate pieces; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import global_row_number
from .common import stage, word_count

MAX_LEN = 8192
BUCKETS = 16
BATCH_TOKENS = 65_536


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ascending boundaries (the last is the largest length) with the least padding; ties to fewer, then lower ones."""
    if not lengths:
        return []
    size = np.array(lengths, np.int64)
    upto = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
    n = len(size)
    cost = np.concatenate([[0], np.full(n, np.iinfo(np.int64).max // 2)])  # padded tokens of the first j lengths
    choice, finals = [], []
    for _ in range(min(buckets, n)):
        new, back = np.full_like(cost, np.iinfo(np.int64).max // 2), np.zeros(n + 1, np.int64)
        new[0] = 0
        for j in range(1, n + 1):
            trial = cost[:j] + size[j - 1] * (upto[j] - upto[:j])
            back[j] = int(np.argmin(trial))
            new[j] = trial[back[j]]
        cost = new
        choice.append(back)
        finals.append(int(cost[n]))
    k, j, out = int(np.argmin(finals)), n, []
    while j > 0:
        out.append(int(size[j - 1]))
        j, k = int(choice[k][j]), k - 1
    return out[::-1]


def pieces_of(docs: DataFrame, length: Column, id_col: str, max_len: int) -> DataFrame:
    """doc_id, piece, piece_start, length: every document cut into pieces of at most ``max_len``."""
    total = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(1))
    return (docs.select(F.col(id_col).alias("doc_id"), total.alias("total"))
            .select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / max_len))).alias("piece"))
            .select("doc_id", "piece", (F.col("piece") * max_len).alias("piece_start"),
                    F.least(F.lit(max_len), F.col("total") - F.col("piece") * max_len).cast("long").alias("length")))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
         max_len: int = MAX_LEN, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, seed: int = 6) -> DataFrame:
    """doc_id, piece, piece_start, length, bucket_len, batch, place (row of the piece in its batch)."""
    length = word_count(text_col) + 1 if length is None else length
    pieces = stage(pieces_of(docs, length, id_col, max_len), "op6-pieces")
    hist = sorted(map(tuple, pieces.groupBy("length").agg(F.count(F.lit(1))).collect()))  # max_len rows at most
    bounds = best_boundaries([h[0] for h in hist], [h[1] for h in hist], buckets)

    table, before, batch = [], 0, 0
    for low, high in zip([0, *bounds], bounds, strict=False):
        rows = sum(n for size, n in hist if low < size <= high)
        room = max(1, batch_tokens // high)
        table.append((high, before, room, batch))
        before, batch = before + rows, batch + -(-rows // room)
    bucket = F.coalesce(*[F.when(F.col("length") <= b, F.struct(*[F.lit(x).cast("long").alias(n) for x, n in zip(
        (b, skip, room, first), ("bucket_len", "skip", "room", "first"), strict=True)])) for b, skip, room, first in table]) \
        if table else F.lit(None).cast("struct<bucket_len:long,skip:long,room:long,first:long>")
    placed = pieces.withColumn("b", bucket)
    order = [F.col("b.bucket_len"), F.xxhash64("doc_id", "piece", F.lit(seed)), F.col("doc_id"), F.col("piece")]
    at = F.col("rank") - 1 - F.col("b.skip")
    return global_row_number(placed, order, "rank").select(
        "doc_id", "piece", "piece_start", "length", F.col("b.bucket_len").alias("bucket_len"),
        (F.col("b.first") + F.floor(at / F.col("b.room"))).cast("long").alias("batch"),
        (at % F.col("b.room")).cast("long").alias("place"))
