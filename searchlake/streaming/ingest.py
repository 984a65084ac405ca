"""Structured Streaming ingest (Q01–Q04).

A stream is read with ``readStream``, transformed with the same column steps as batch ingest, and committed per
micro-batch with ``foreachBatch`` into a bucketed, versioned Parquet table in the shared folder.

Nothing about the table lives in the driver's memory. A table is cut into buckets by a hash of its key (``buckets``, fixed
when it is begun). Micro-batch ``n`` writes new files only for the buckets that its keys touch, below ``data/v<n>``, and then a manifest
``manifest/v<n>``: for every bucket the version that holds it. Untouched buckets are carried over by name. The stream's
checkpoint numbers micro-batches without gaps, also over restarts, so the base of batch ``n`` is manifest ``n - 1`` in
storage, and a batch that is run again after a failure overwrites its own version with the same rows. The one-row pointer table
``current`` names the last committed version; readers that opened an older one keep a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.operators import mutate


BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, target: str, version: int) -> dict[int, int]:
    """Bucket -> version of its files, after that micro-batch; a missing version is an error, not an empty table."""
    if version < 0:
        return {}
    rows = spark.read.parquet(f"{target}/manifest/v{version}").collect()  # at most one row per bucket
    return {r["key_bucket"]: r["version"] for r in rows if r["key_bucket"] >= 0}


def _read_buckets(spark: SparkSession, target: str, held: dict[int, int], schema) -> DataFrame:
    paths = [f"{target}/data/v{v}/key_bucket={b}" for b, v in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _commit(batch: DataFrame, target: str, epoch: int, key: str, buckets: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Merge a micro-batch into the buckets that it touches, and name them in a new manifest."""
    spark = batch.sparkSession
    before = _manifest(spark, target, epoch - 1)
    if epoch and (known := spark.read.parquet(f"{target}/manifest/v{epoch - 1}").first()["buckets"]) != buckets:
        raise ValueError(f"the table has {known} buckets, not {buckets}")
    touched = sorted(r[0] for r in batch.select(_bucket(key, buckets).alias("b")).distinct().collect())  # at most ``buckets`` numbers
    if touched:
        base = _read_buckets(spark, target, {b: before[b] for b in touched if b in before}, batch.schema)
        merged = merge(base, batch)
        # a bucket's rows go to one file, which a hot key does not change: a key has one row after the merge
        (merged.withColumn("key_bucket", _bucket(key, buckets)).repartition("key_bucket").write.mode("overwrite")
         .partitionBy("key_bucket").parquet(f"{target}/data/v{epoch}"))
    after = {**before, **dict.fromkeys(touched, epoch)}
    rows = [(b, v, buckets) for b, v in sorted(after.items())] or [(-1, epoch, buckets)]
    spark.createDataFrame(rows, "key_bucket int, version long, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/v{epoch}")
    spark.createDataFrame([(epoch,)], "version long").coalesce(1).write.mode("overwrite").parquet(f"{target}/current")


def read_table(spark: SparkSession, target: str, schema, version: int | None = None) -> DataFrame:
    """The table after its last committed micro-batch, or after micro-batch ``version``."""
    if version is None:
        version = spark.read.parquet(f"{target}/current").first()[0]
    return _read_buckets(spark, target, _manifest(spark, target, version), schema)


def _start(stream: DataFrame, commit, checkpoint: str, available_now: bool, processing_time: str | None):
    w = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")).start()


def stream_upsert(stream: DataFrame, target: str, key: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, order: str | None = None,
                  available_now: bool = True, processing_time: str | None = None, buckets: int = BUCKETS):
    """Streaming upsert (Q01): each micro-batch (the auto-commit unit) is transformed, reduced to the latest row per
    key and merged into the buckets of ``target`` that it touches (M01). Returns the query and a function that reads the table.

    Without ``order`` later batches win; with it, a stored row with a higher order value stays."""
    spark = stream.sparkSession
    kind = (transform(stream) if transform else stream).schema

    def merge(base: DataFrame, batch: DataFrame) -> DataFrame:
        return mutate.upsert(base, batch, key) if order is None else mutate.latest_per_key(base.unionByName(batch), key, order)

    def commit(batch: DataFrame, epoch: int):
        _commit(transform(batch) if transform else batch, target, epoch, key, buckets, merge)

    q = _start(stream, commit, checkpoint, available_now, processing_time)
    return q, lambda: read_table(spark, target, kind)


def stream_dedupe(stream: DataFrame, sig: str, ts: str, watermark: str = "1 hour") -> DataFrame:
    """Streaming duplicate drop by signature (Q02): first arrival wins within the watermark."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([sig])


def stream_versioned(stream: DataFrame, target: str, key: str, version: str, checkpoint: str, buckets: int = BUCKETS):
    """Reordered-update protection (Q03): the row with the highest absolute version per key counts,
    whatever the order of arrival. Negative versions are deletes; they stay in the table as tombstones, so
    a late older update cannot bring the row back. ``live_rows`` leaves them out."""
    spark = stream.sparkSession

    def merge(base: DataFrame, batch: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*batch.columns), F.struct(F.abs(F.col(version)), -F.col(version)))
        return base.unionByName(batch).groupBy(key).agg(newest.alias("_r")).select("_r.*")

    def commit(batch: DataFrame, epoch: int):
        _commit(batch, target, epoch, key, buckets, merge)

    q = _start(stream, commit, checkpoint, True, None)
    return q, lambda: read_table(spark, target, stream.schema)


def live_rows(table: DataFrame, version: str) -> DataFrame:
    """A versioned table without its tombstones."""
    return table.where(F.col(version) > 0)


def latency_windows(events: DataFrame, ts: str, value: str, window: str, group: str | None = None) -> DataFrame:
    """Per event-time window: requests, mean and approximate median/p95/p99 (Q04), for a stream or a table."""
    keys = [F.window(F.col(ts), window)] + ([F.col(group)] if group else [])
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"), F.avg(value).alias("mean"),
        F.percentile_approx(value, [0.5, 0.95, 0.99], 10000).alias("quantiles"))


def stream_latency(stream: DataFrame, ts: str, value: str, window: str = "1 minute",
                   watermark: str = "5 minutes", group: str | None = None) -> DataFrame:
    """Rolling request metrics (Q04). Write it in update or complete mode to see open windows too; append mode gives a
    window only when the watermark has passed its end, so the last windows stay open until later events arrive."""
    return latency_windows(stream.withWatermark(ts, watermark), ts, value, window, group)
