"""Session defaults and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "searchlake") -> SparkSession:
    """A session with the settings every operator here assumes.

    UTC session time zone (date math and the oracle both work in UTC), AQE on
    (coalescing, skew-join splitting), UI off. On a cluster the caller's own
    settings win: ``getOrCreate`` keeps an existing session.
    """
    master = master or os.environ.get("SEARCHLAKE_MASTER", "local[8]")
    cores = 8
    if master.startswith("local[") and master[6:-1].isdigit():
        cores = int(master[6:-1])
    parts = shuffle_partitions or max(8, 2 * cores)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SEARCHLAKE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("FATAL")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    we never replace it. Only local runs (tests, bench) get a fresh temp folder; on any
    other master an unset folder is an error, because executors do not see the driver's disk.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        cur = tempfile.mkdtemp(prefix="searchlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def scratch_dir(spark: SparkSession, name: str = "tmp") -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in (names or TABLES)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
