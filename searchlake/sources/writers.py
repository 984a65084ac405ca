"""Result sinks (S11–S14, S16) and extra document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from searchlake.operators.util import bounded_broadcast, written


def _flatten_multi(df: DataFrame, mv_sep: str) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            cols.append(F.array_join(F.col(f.name).cast("array<string>"), mv_sep).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mv_sep: str = "|", header: bool = True, null_value: str = "") -> None:
    """CSV sink (S11): multi-values joined with ``mv_sep``, NULLs as ``null_value``."""
    _flatten_multi(df, mv_sep).write.mode("overwrite").option("header", header) \
        .option("nullValue", null_value).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON-lines sink."""
    df.write.mode("overwrite").json(path)


def write_xml(df: DataFrame, path: str, row_tag: str = "doc", root_tag: str = "response") -> None:
    """XML sink (S13): one ``<doc>`` element per row."""
    df.write.mode("overwrite").format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def split_by_hash(df: DataFrame, key: str, n: int, path: str) -> None:
    """Split a collection into ``n`` shards by key hash (S16): ``shard=pmod(hash(key), n)`` partitions."""
    df.withColumn("shard", F.pmod(F.hash(F.col(key)), F.lit(n))).write.mode("overwrite") \
        .partitionBy("shard").parquet(path)


def read_csv_docs(spark: SparkSession, path: str, *, separator: str = ",", header: bool = True,
                  fieldnames: list[str] | None = None, encapsulator: str = '"', escape: str = "\\",
                  skip: list[str] = (), skip_lines: int = 0, trim: bool = False, keep_empty: bool = False,
                  split: dict | None = None, value_map: dict | None = None, literals: dict | None = None,
                  rowid: str | None = None, rowid_offset: int = 0) -> DataFrame:
    """CSV documents (S03–S06): separator, header or explicit field names, quote/escape, skipped
    fields, skipped leading lines, trimming, empty→missing, per-field multi-value split, value
    maps, literal fields and a row id (distributed row number, no single-partition window).
    ``skip_lines`` counts the lines in front of the header, in every file; with it a record is one line."""
    options = {"sep": separator, "quote": encapsulator, "escape": escape}
    if skip_lines:
        df = _csv_behind_lines(spark, path, skip_lines, header and fieldnames is None, fieldnames, options)
    else:
        df = spark.read.options(**options).option("header", header and fieldnames is None).csv(path)
        if fieldnames is not None:
            df = df.toDF(*fieldnames[:len(df.columns)])
    df = df.drop(*[c for c in skip if c in df.columns])
    for c in df.columns:
        v = F.trim(F.col(c)) if trim else F.col(c)
        if not keep_empty:
            v = F.nullif(v, F.lit(""))
        df = df.withColumn(c, v)
    for c, sep in (split or {}).items():
        df = df.withColumn(c, F.split(F.col(c), sep))
    for c, m in (value_map or {}).items():
        expr = F.col(c)
        for a, b in m.items():
            expr = F.when(F.col(c) == a, F.lit(b)).otherwise(expr)
        df = df.withColumn(c, expr)
    for c, v in (literals or {}).items():
        df = df.withColumn(c, F.lit(v))
    if rowid:
        from searchlake.operators.util import global_row_number
        df = global_row_number(df, [F.monotonically_increasing_id()], rowid, rowid_offset - 1 + 0)
    return df


def _csv_behind_lines(spark: SparkSession, path: str, skip_lines: int, header: bool, fieldnames: list[str] | None,
                      options: dict) -> DataFrame:
    """CSV records behind the first ``skip_lines`` lines of each file (and a header line).

    The lines are written once with their number in the task that read them; a file's first lines are all in its first block, so one
    small aggregate (a row per file) tells where it begins."""
    import csv

    lines = written(spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") == 0).alias("first"), F.monotonically_increasing_id().alias("n")), "csv-lines")
    begin = lines.filter("first").groupBy("file").agg(F.min("n").alias("n0"))
    placed = lines.join(bounded_broadcast(begin), "file")
    nth = F.when(F.col("first"), F.col("n") - F.col("n0"))
    rest = placed.filter(F.coalesce(nth >= skip_lines + int(header), F.lit(True)))
    head = placed.filter(nth == skip_lines).orderBy("file").select("line").first()
    first = next(csv.reader([head[0]], delimiter=options["sep"], quotechar=options["quote"], escapechar=options["escape"])) if head else []
    names = first if header else fieldnames or [f"_c{i}" for i in range(len(first))]
    # records without a value at all are blank lines, which the CSV reader leaves out
    parsed = rest.filter(F.trim("line") != "").select(F.from_csv("line", ", ".join(f"`{c}` string" for c in names), options).alias("r"))
    return parsed.select(*[F.col("r").getField(c).alias(c) for c in names])


def read_json_docs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """JSON documents (S07): an array of docs or ``{"add": {"doc": {...}}}`` commands."""
    df = spark.read.option("multiLine", multi_line).json(path)
    if "add" in df.columns:
        df = df.select("add.doc.*")
    return df


def read_xml_docs(spark: SparkSession, path: str) -> DataFrame:
    """XML documents (S08): ``<add><doc><field name="f">v</field>…</doc></add>``, one root per file. Output ``fields``, a map from names to
    arrays of values: repeated names become multi-values."""
    kind = "field array<struct<_VALUE: string, _name: string>>"  # text as it stands: nothing is guessed to be a number
    raw = spark.read.format("xml").option("rowTag", "doc").schema(kind).load(path)
    names = F.array_distinct(F.transform("field", lambda x: x["_name"]))
    values = F.transform(names, lambda n: F.transform(F.filter("field", lambda x: x["_name"] == n), lambda x: x["_VALUE"]))
    return raw.select(F.map_from_arrays(names, values).alias("fields"))


def read_word_file(spark: SparkSession, path: str) -> DataFrame:
    """Word list for spelling (C11): one word per line, lower-cased, blank lines left out; ``term, df`` (1 for all)."""
    words = spark.read.text(path).select(F.lower(F.trim("value")).alias("term")).filter("term != ''").distinct()
    return words.withColumn("df", F.lit(1).cast("long"))


def read_score_file(spark: SparkSession, path: str) -> DataFrame:
    """External float file (S09): lines ``key=value``; malformed lines are skipped."""
    t = spark.read.text(path)
    parts = F.split(F.col("value"), "=", 2)
    return t.select(F.trim(parts[0]).alias("key"), F.trim(F.try_element_at(parts, F.lit(2))).try_cast("float")
                    .alias("score")).filter(F.col("score").isNotNull())


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Exchange rates (S10) from JSON lines ``{"from":..,"to":..,"rate":..}``."""
    return spark.read.json(path).select("from", "to", F.col("rate").cast("double"))


def search_log_rows(requests: DataFrame) -> DataFrame:
    """Search-log rows (S14): one per successful search; rows returned = min(rows, hits);
    facet flag Y/N. ``requests`` columns: user_ip, user_name, query_full, q, fq, rows, hits, facet."""
    return requests.select(
        F.expr("uuid()").alias("log_id"), F.current_timestamp().alias("added_date"), "user_ip", "user_name",
        "query_full", F.col("q").alias("query_q"), F.col("fq").alias("query_fq"),
        F.least(F.col("rows"), F.col("hits")).cast("int").alias("result_cnt"),
        F.when(F.col("facet"), "Y").otherwise("N").alias("facet_yn"))
