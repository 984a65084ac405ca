"""Document signatures and duplicate removal.

Text-profile signatures are computed per document with one shuffle of the documents by key:
after ``repartition(key)`` the per-(doc, token) count and the per-doc profile aggregates both
reuse that partitioning (hash partitioning on ``doc_id`` satisfies clustering on
``(doc_id, token)``), so no token-level shuffle happens. Duplicate removal keeps the latest
arrival per signature with ``max_by`` — a hash aggregate with a map-side partial, so one
signature shared by a third of all rows still costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters or digits, like a per-character "is letter or digit" test.
PROFILE_TOKEN = r"[\p{L}\p{Nd}]+"


def signature_md5(df: DataFrame, cols: list[str], name: str = "signature") -> DataFrame:
    """Exact signature (P28): MD5 hex of field name + value for every present field, in the
    given order (NULL fields contribute nothing; multi-values contribute each element)."""
    parts = []
    for c in cols:
        v = F.col(c)
        if isinstance(df.schema[c].dataType, __import__("pyspark.sql.types", fromlist=["ArrayType"]).ArrayType):
            val = F.array_join(F.transform(v, lambda x: x.cast("string")), "")
            parts.append(F.when(v.isNotNull(), F.concat(F.lit(c), val)))
        else:
            parts.append(F.when(v.isNotNull(), F.concat(F.lit(c), v.cast("string"))))
    return df.withColumn(name, F.md5(F.concat_ws("", *parts)))


def signature_hash64(df: DataFrame, cols: list[str], name: str = "signature") -> DataFrame:
    """Fast 64-bit signature (P29): ``xxhash64`` of the field names and values (hex)."""
    args = []
    for c in cols:
        args += [F.lit(c), F.col(c)]
    return df.withColumn(name, F.lower(F.hex(F.xxhash64(*args))))


def text_profile(text: Column, quant_rate: float = 0.01, min_token_len: int = 2) -> Column:
    """Profile string of one text (no shuffle; for short fields): ``token count`` lines.

    Per-row array form of the same rule as :func:`signature_text_profile`; cost grows with
    tokens × distinct tokens, so long texts should use the table form."""
    toks = F.filter(F.regexp_extract_all(F.lower(text), F.lit(PROFILE_TOKEN), 0),
                    lambda t: F.length(t) > min_token_len)
    uniq = F.array_distinct(toks)
    counted = F.transform(uniq, lambda t: F.struct(F.size(F.filter(toks, lambda x: x == t)).alias("c"),
                                                   t.alias("t")))
    max_f = F.array_max(F.transform(counted, lambda s: s["c"]))
    q = _quant(max_f, quant_rate)
    kept = F.filter(F.transform(counted, lambda s: F.struct((F.floor(s["c"] / q) * q).cast("int").alias("c"),
                                                            s["t"].alias("t"))),
                    lambda s: s["c"] >= q)
    ordered = F.array_sort(kept, lambda a, b: F.when(a["c"] > b["c"], -1).when(a["c"] < b["c"], 1)
                           .when(a["t"] < b["t"], -1).when(a["t"] > b["t"], 1).otherwise(0))
    return F.array_join(F.transform(ordered, lambda s: F.concat(s["t"], F.lit(" "), s["c"].cast("string"))), "\n")


def _quant(max_freq: Column, quant_rate: float) -> Column:
    q = F.floor(max_freq * F.lit(quant_rate) + F.lit(0.5)).cast("int")
    return F.when(q < 2, F.when(max_freq > 1, F.lit(2)).otherwise(F.lit(1))).otherwise(q)


def signature_text_profile(df: DataFrame, key: str, col: str, quant_rate: float = 0.01,
                           min_token_len: int = 2, name: str = "signature",
                           with_profile: bool = False) -> DataFrame:
    """Fuzzy text-profile signature.

    Tokens: lower-cased runs of letters/digits longer than ``min_token_len``. With maxFreq the
    highest token count, quant = round(maxFreq·quant_rate), at least 2 (or 1 when maxFreq = 1);
    counts are floored to multiples of quant and tokens below quant dropped; the rest, sorted
    by count desc then token asc (D6), become ``token count`` lines joined by newlines, MD5-hashed.
    Docs without any kept token get the MD5 of the empty string. Output: input + ``name``.
    """
    docs = df.repartition(key)
    toks = docs.select(key, F.explode(F.filter(
        F.regexp_extract_all(F.lower(F.col(col)), F.lit(PROFILE_TOKEN), 0),
        lambda t: F.length(t) > min_token_len)).alias("_t"))
    counts = toks.groupBy(key, "_t").agg(F.count(F.lit(1)).cast("int").alias("_c"))
    per_doc = counts.groupBy(key).agg(F.max("_c").alias("_mx"),
                                      F.collect_list(F.struct(F.col("_c").alias("c"), F.col("_t").alias("t")))
                                      .alias("_l"))
    q = _quant(F.col("_mx"), quant_rate)
    kept = F.filter(F.transform("_l", lambda s: F.struct((F.floor(s["c"] / q) * q).cast("int").alias("c"),
                                                         s["t"].alias("t"))),
                    lambda s: s["c"] >= q)
    ordered = F.array_sort(kept, lambda a, b: F.when(a["c"] > b["c"], -1).when(a["c"] < b["c"], 1)
                           .when(a["t"] < b["t"], -1).when(a["t"] > b["t"], 1).otherwise(0))
    profile = F.array_join(F.transform(ordered, lambda s: F.concat(s["t"], F.lit(" "), s["c"].cast("string"))),
                           "\n")
    sigs = per_doc.select(key, profile.alias("_profile"))
    out = docs.join(sigs, key, "left")
    out = out.withColumn(name, F.md5(F.coalesce(F.col("_profile"), F.lit(""))))
    return out if with_profile else out.drop("_profile")


def dedupe_by_signature(df: DataFrame, sig: str, order_col: str) -> DataFrame:
    """Overwrite duplicates (P31): one row per signature, the one with the highest ``order_col``
    (latest arrival). ``max_by`` over a struct of the row: partial aggregation map-side."""
    others = [c for c in df.columns if c != sig]
    packed = F.struct(*[F.col(c) for c in others])
    best = df.groupBy(sig).agg(F.max_by(packed, F.col(order_col)).alias("_row"))
    return best.select(sig, "_row.*").select(*df.columns)
