"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: The white space that splits words: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of an Arrow batch between the JVM and a Python worker.
ARROW_BYTES = 8 << 20
WORD = r"[^\x20\x09-\x0D]+"


def byte_groups(texts, most: int):
    """Cut an Arrow column of texts or bytes into (from, to) ranges of about ``most`` bytes."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(texts).to_pylist()
    at = size = 0
    for i, n in enumerate(sizes):
        size += n or 0
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(sizes):
        yield at, len(sizes)


def release_memory() -> None:
    """Give memory that a Python worker no longer uses back to the system: workers live on and share an executor's
    memory with the JVM, and freed arrays otherwise stay with the allocator."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, wherever they run, and bound the bytes that travel
    to a worker at once (whole texts are long rows)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_searchlake_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name))
    sc._searchlake_shipped = True


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with a table that every executor can read again, so a lost executor
    costs one task, not the job; the planner also gets the table's true size, and joins that
    read it keep plain exchanges on both sides, which adaptive execution can split when skewed.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(col: str = "text") -> Column:
    """Words of a text, ``[^\\x20\\x09-\\x0D]+``; null counts as empty."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (column expressions have no local names)."""
    return F.transform(F.array(value), body)[0]
