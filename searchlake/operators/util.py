"""Small plan-shaping helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows above which a table built on the driver is no longer broadcast.
BROADCAST_MAX_ROWS = 100_000


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_false(pred: Column) -> Column:
    """Two-valued logic: a NULL predicate counts as false (the reference has no NULL state)."""
    return F.coalesce(pred, F.lit(False))


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only after checking it really is small.

    The check is a bounded action (``limit(max_rows + 1).count()``). Above the bound the
    DataFrame is returned unhinted, so Spark/AQE fall back to a shuffle join.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


#: Bytes of text in one part of documents that are cut into tokens: the tokens of a part are sorted in the memory of one task.
PART_BYTES = 4 << 20


def parts_of(docs: DataFrame, text_col: str, part_bytes: int = PART_BYTES) -> int:
    """Number of parts of about ``part_bytes`` of text (a text or array-of-texts column), at least one per core."""
    text = F.array_join(text_col, "") if is_array(docs, text_col) else F.col(text_col).cast("string")
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // part_bytes))


def dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` dealt by key into ``parts_of`` parts. The number is given, as adaptive execution would merge parts by the size of
    the texts, and a text's tokens take many times its size."""
    return docs.repartition(parts_of(docs, text_col), id_col)


def join_keys(big: DataFrame, small: DataFrame, on, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Inner join of exploded keys: ``small`` is broadcast if it has at most ``max_rows`` rows, else both sides are sorted.

    The size that the optimizer takes for exploded rows is that of the rows before; left to itself it may gather many times
    its broadcast threshold on the driver."""
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), on)
    return big.join(small.hint("merge"), on)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: used several times without being computed again."""
    from ..session import scratch_dir

    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parse_sort(spec) -> list[Column]:
    """``"a desc, b asc"`` or a list of Columns → list of sort Columns (nulls last on desc)."""
    if spec is None:
        return []
    if isinstance(spec, Column):
        return [spec]
    if not isinstance(spec, str):
        out = []
        for s in spec:
            out.extend(parse_sort(s))
        return out
    cols = []
    for part in spec.split(","):
        part = part.strip()
        if not part:
            continue
        bits = part.split()
        name = bits[0]
        direction = bits[1].lower() if len(bits) > 1 else "asc"
        c = F.col(name)
        cols.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
    return cols


def rank_small(df: DataFrame, order: list[Column], name: str = "rank", offset: int = 0) -> DataFrame:
    """Row number over an already bounded result (top-k output). Single-partition window is fine here
    because the input has at most k rows; never call this on data-sized input."""
    w = Window.orderBy(*order)
    return df.withColumn(name, (F.row_number().over(w) + F.lit(offset)).cast("long"))


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank",
                      offset: int = 0) -> DataFrame:
    """Dense 1-based row number over a data-sized input without a single-partition window.

    The input is range-sorted once and *written* to the shared scratch folder together with
    ``monotonically_increasing_id()`` (partition number << 33 | position in the partition).
    Everything after that reads the written rows, so the per-partition counts and the rows
    can never disagree about where a partition starts, whatever AQE does. One shuffle; the
    counts are one row per written partition.
    """
    from ..session import scratch_dir

    spark = df.sparkSession
    path = scratch_dir(spark, "rank")
    df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).write.parquet(path)
    ranked = spark.read.parquet(path)
    part = F.shiftright("_mid", 33)
    counts = ranked.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition of the sorted write: bounded by spark.sql.shuffle.partitions
    out = ranked.withColumn("_pid", part).join(F.broadcast(offsets), "_pid")
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return out.withColumn(name, (F.col("_off") + local + F.lit(offset)).cast("long")).drop("_pid", "_mid", "_off")


def top_k(df: DataFrame, order: list[Column], k: int, offset: int = 0, rank: str | None = "rank") -> DataFrame:
    """orderBy + offset + limit (plans as TakeOrderedAndProject), with an explicit rank column."""
    limited = df.orderBy(*order)
    if offset:
        limited = limited.offset(offset)
    limited = limited.limit(k)
    if rank is None:
        return limited
    return rank_small(limited, order, rank, offset)


def is_array(df: DataFrame, col: str) -> bool:
    from pyspark.sql.types import ArrayType

    return isinstance(df.schema[col].dataType, ArrayType)


def fold(op, cols: Iterable[Column]) -> Column:
    cols = list(cols)
    out = cols[0]
    for c in cols[1:]:
        out = op(out, c)
    return out
