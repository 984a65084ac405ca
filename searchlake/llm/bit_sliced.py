"""Operator 7, exact top-k by integer inner product on a bit-sliced index.

Vectors are quantised to integers. The index holds blocks of rows; inside a block every attribute
(vector component) is a set of bitmaps, one per bit of its two's complement, one bit per row.
A query is evaluated on all rows of a block at once: each component of the query is written with
signed binary digits (no two adjacent ones set), every digit contributes the attribute's slices,
shifted, and complemented where the weight is negative; the slices of equal weight are summed
with bitmap full adders into the bit slices of the score. The k best rows are selected from the most
significant score slice downwards; where the boundary falls into rows of one score, the smaller
ids are taken.

Query vectors are grouped into chunks; every chunk meets every block once (an equi-join on the
numbers of the block and of a set of chunks), so nothing is broadcast, and a task holds one block and one set. Each block returns
at most k rows per query; the final ranking keeps k per query and combines before the shuffle.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null id,
take no part; shorter vectors count as padded with zeros; equal rows are separate candidates;
ties go to the smaller id; an empty table gives an empty result; components whose
scores might not fit 62 bits raise an error before any score is built.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, stage

BLOCK_ROWS = 16_384
CHUNK = 128
SET = 4
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, values (array<long>), peak (largest absolute value, as double) of the rows that take part."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias("values"),
        # doubles do not saturate, longs would
        F.coalesce(F.array_max(F.transform(v, lambda x: F.abs(x.cast("double") * float(scale)))), F.lit(0.0)).alias("peak"))


def pack(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in ascending id order -> (ids, slices[component, bit, word]) in two's complement."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    width = max(int(values.max(initial=0)).bit_length(), int(-1 - values.min(initial=0)).bit_length()) + 1
    rows = -(-len(ids) // 64) * 64
    bits = np.zeros((values.shape[1], width, rows), np.uint8)
    for b in range(width):
        bits[:, b, :len(ids)] = ((values >> b) & 1).T
    return ids, np.packbits(bits, axis=2, bitorder="little").view("<u8")


def signed_digits(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-adjacent form: bit masks of the +1 and the -1 digits."""
    a = np.abs(q)
    half = a >> 1
    three = a + half
    c = half ^ three
    plus, minus = three & c, half & c
    return np.where(q < 0, minus, plus), np.where(q < 0, plus, minus)


def add_slices(stack: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sum bitmaps of one weight: the one that is left, and the carries to the next weight."""
    now, carries = np.concatenate(stack), []
    while len(now) > 1:
        k = len(now) // 3
        if k:
            a, b, c = now[0:3 * k:3], now[1:3 * k:3], now[2:3 * k:3]
            ab = a ^ b
            carries.append((a & b) | (c & ab))
            now = np.concatenate([ab ^ c, now[3 * k:]])
        else:
            carries.append((now[:1] & now[1:]))
            now = now[:1] ^ now[1:]
    return now, carries


def score_slices(slices: np.ndarray, q: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Bit slices of score - bias for all rows of a block, and the bias."""
    dims = min(len(q), slices.shape[0])
    width = slices.shape[1]
    plus, minus = signed_digits(q[:dims])
    weights: dict[int, list[np.ndarray]] = {}
    bias = 0
    for digit in range(int(np.bitwise_or.reduce(plus | minus, initial=0)).bit_length()):
        for dim, positive in ((np.flatnonzero((plus >> digit) & 1), True), (np.flatnonzero((minus >> digit) & 1), False)):
            if len(dim):
                for bit in range(width):
                    rows, top = slices[dim, bit], bit == width - 1
                    if positive != top:  # a weight of +2**(digit + bit)
                        weights.setdefault(digit + bit, []).append(rows)
                    else:  # -x = ~x - 1 on one bit
                        weights.setdefault(digit + bit, []).append(~rows)
                        bias -= len(dim) << (digit + bit)
    out, w = [], 0
    while weights:
        left, carries = add_slices(weights.pop(w, None) or [np.zeros((1, slices.shape[2]), np.uint64)])
        out.append(left[0])
        if carries:
            weights.setdefault(w + 1, []).extend(carries)
        w += 1
    return out, bias


def top_rows(score: list[np.ndarray], live: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best live rows, ties to the smaller position."""
    sure, open_ = np.zeros_like(live), live
    for s in reversed(score):
        ahead = open_ & s
        n = int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(ahead).sum())
        if n > k:
            open_ = ahead
        else:
            sure = sure | ahead
            open_ = open_ & ~s
            if n == k:
                break
    at = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    first = at(sure)
    return np.concatenate([first, at(open_)[:k - len(first)]])


def search_block(ids: np.ndarray, slices: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query id, id, score) arrays of each query's best rows in the block."""
    words = slices.shape[2]
    every = np.zeros(words * 64, np.uint8)
    every[:len(ids)] = 1
    every = np.packbits(every, bitorder="little").view("<u8")
    out = []
    for qid, q in zip(query_ids.tolist(), queries, strict=True):
        live = every
        lo, hi = np.searchsorted(ids, qid), np.searchsorted(ids, qid, side="right")
        if lo < hi:
            live = every.copy()
            for i in range(lo, hi):
                live[i >> 6] &= ~np.uint64(1 << (i & 63))
        score, bias = score_slices(slices, q)
        rows = top_rows(score, live, k)
        value = np.full(len(rows), bias, np.int64)
        for w, s in enumerate(score):
            value += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << w
        out.append((np.full(len(rows), qid), ids[rows], value))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _matrix(values: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(values), dims), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def build_index(rows: DataFrame, dims: int, blocks: int) -> DataFrame:
    """rows(id, values) -> one row per block: block, ids, shape, slices."""
    def build(group: pd.DataFrame) -> pd.DataFrame:
        ids, slices = pack(group["id"].to_numpy(np.int64), _matrix(group["values"], dims))
        return pd.DataFrame({"block": [group["block"].iloc[0]], "ids": [ids.astype("<i8").tobytes()],
                             "width": [slices.shape[1]], "slices": [slices.tobytes()]})

    spread = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    return rows.withColumn("block", spread).groupBy("block").applyInPandas(
        build, "block int, ids binary, width int, slices binary")


def top_k(vectors: DataFrame, query_if, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row where ``query_if(id)`` holds."""
    ship_package(vectors.sparkSession)
    rows = stage(quantised(vectors, id_col, vector_col, scale), "op7-rows")
    n, dims, asked, peak = rows.agg(
        F.count(F.lit(1)), F.max(F.size("values")), F.count_if(query_if(F.col("id"))), F.max("peak")).first()
    dims = dims or 0
    if peak and dims * (peak + 1) ** 2 >= 2.0 ** 62:
        raise ValueError(f"components of up to {peak:.3g} after scaling, in {dims} dimensions, give scores beyond 62 bits")
    blocks = max(1, -(-n // BLOCK_ROWS))
    index = stage(build_index(rows, dims, blocks), "op7-index")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "query_ids": [group["id"].to_numpy(np.int64).astype("<i8").tobytes()],
                             "queries": [_matrix(group["values"], dims).astype("<i8").tobytes()]})

    # a repeated query row asks the same question: one is enough
    queries = rows.where(query_if(F.col("id"))).dropDuplicates(["id", "values"])
    n_chunks = max(1, -(-asked // CHUNK))
    chunk = F.pmod(F.xxhash64("id", "values"), F.lit(n_chunks)).cast("int")
    chunks = stage(queries.withColumn("chunk", chunk).groupBy("chunk").applyInPandas(gather, "chunk int, query_ids binary, queries binary"), "op7-queries")
    # a task holds one block and SET chunks at most, so few blocks are no few tasks
    part = F.floor(F.col("chunk") / SET).cast("int").alias("part")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = chunks.select("query_ids", "queries", part, every(blocks).alias("block"))
    asked_of = index.select("block", "ids", "slices", "width", every(-(-n_chunks // SET)).alias("part"))
    met = asking.join(asked_of.hint("merge"), ["block", "part"]).select("ids", "slices", "width", "query_ids", "queries")

    def search(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids, slices, width, query_ids, queries = (b.column(c)[r].as_py() for c in range(5))
                ids = np.frombuffer(ids, "<i8")
                query_ids = np.frombuffer(query_ids, "<i8")
                found = search_block(ids, np.frombuffer(slices, "<u8").reshape(dims, width, -1), query_ids,
                                     np.frombuffer(queries, "<i8").reshape(len(query_ids), dims), k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
