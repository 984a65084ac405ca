"""Operator 9, mixing sources to target weights by pivotal dependent rounding.

Every source gets a target share of all words (weights by source order, a cap of three times
the source's own words, the excess reshared by weight). A document is to be taken
``target / source words`` times: the whole part always, the fraction by pivotal rounding. Two
documents with fractional probabilities trade word mass until one of them is 0 or 1; the other
goes on to the next. Chunks of ``FAN`` documents run that chain inside one row's array, each
leaves one fractional document, and these residuals meet in the next level of a reduction tree
whose depth is log_FAN(documents). Mass moves in whole units, so a source's expected words
are kept exactly until its last residual, which is decided by its own probability: the taken
words differ from the target by at most that one document (and 2**-24 per word).

All choices come from hashes of ranks and a seed, so reruns agree. Chunks are cut from a
distributed ranking by (source, hash, id), never larger than ``FAN``, so a source with a third
of all rows is spread like any other.

Defined results: null text has size 0; documents of size 0 are taken 0 words; the null source
is a source of its own and orders last; equal rows are separate documents; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.util import global_row_number
from .common import let, stage, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
UNIT = 1 << 24
FAN = 256


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): shares by weight, capped, the excess reshared."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = global_row_number(src, [F.col("source").asc_nulls_last()], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    src = stage(src.select("source", "source_size", w.alias("w")), "op9-sources")
    limit = F.col("source_size") * float(cap)
    total, wsum, n = src.agg(F.sum("source_size"), F.sum("w"), F.count(F.lit(1))).first()
    share = (total or 0) / wsum if wsum else 0.0
    held = 0
    while n:  # each turn fixes at least one more source at its cap
        above = F.col("w") * share > limit
        fixed, rest, now = src.agg(
            F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("w"))), F.count_if(above)).first()
        if now == held or not rest:
            break
        held, share = now, (total - (fixed or 0.0)) / rest
    return src.select("source", "source_size", F.least(F.col("w") * share, limit).alias("target"))


def _pivot(state: Column, x: Column, seed: int) -> Column:
    """One trade between the current fractional document and the next."""
    c = state["cur"]
    up = F.least(c["cap"] - c["mass"], x["mass"])  # what x can give to c
    down = F.least(c["mass"], x["cap"] - x["mass"])  # what c can give to x
    draw = F.pmod(F.xxhash64(c["rank"], x["rank"], F.lit(seed)), up + down)
    gain = F.when(draw < down, up).otherwise(-down)

    def settle(d):
        c2 = c.withField("mass", c["mass"] + d)
        x2 = x.withField("mass", x["mass"] - d)
        whole = lambda r: (r["mass"] == 0) | (r["mass"] == r["cap"])
        done = F.concat(state["done"], F.filter(F.array(c2, x2), whole))
        open_ = F.filter(F.array(c2, x2), lambda r: ~whole(r))
        return F.struct(F.get(open_, 0).alias("cur"), done.alias("done"))

    return F.when(c.isNull(), F.struct(x.alias("cur"), state["done"].alias("done"))).otherwise(let(gain, settle))


def _round_level(parts: DataFrame, kind: str, seed: int, name: str) -> DataFrame:
    """parts(source, chunk, doc struct) -> one row per (source, chunk): cur, done."""
    grouped = parts.groupBy("source", "chunk").agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    zero = F.expr(f"named_struct('cur', cast(null as {kind}), 'done', cast(array() as array<{kind}>))")
    out = F.aggregate("docs", zero, lambda s, x: _pivot(s, x, seed))
    return stage(grouped.select("source", "chunk", out.alias("r")).select("source", "chunk", "r.cur", "r.done"), name)


def pivotal_counts(rows: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: int = 9) -> DataFrame:
    """rows(key, source, size) -> key, size, source_size, target, copies (how often each row is taken)."""
    rows = stage(rows.select("key", "source", F.col("size").cast("long").alias("size")), "op9-sizes")
    targets = stage(source_targets(rows, weights, cap), "op9-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source")).select(
        "key", "r.source", "size", "source_size", "target", ratio.alias("ratio"))
    order = [F.col("source").asc_nulls_last(), F.xxhash64("key", F.lit(seed)).asc(), F.col("key").asc()]
    whole = F.floor("ratio").cast("long")
    part = F.round((F.col("ratio") - F.floor("ratio")) * UNIT).cast("long")
    ranked = (
        global_row_number(joined, order, "rank")
        .withColumn("whole", whole + (part == UNIT).cast("long"))
        .withColumn("part", F.when(part == UNIT, 0).otherwise(part)))
    keep = ["key", "size", "source_size", "target"]
    open_ = (F.col("part") > 0) & (F.col("size") > 0)
    out = ranked.where(~open_).select(*keep, F.col("whole").alias("copies"))

    doc = F.struct("rank", (F.col("size") * UNIT).alias("cap"), (F.col("size") * F.col("part")).alias("mass"),
                   "whole", *keep)
    level = ranked.where(open_).select("source", doc.alias("doc"), F.floor((F.col("rank") - 1) / FAN).alias("chunk"))
    kind = level.schema["doc"].dataType.simpleString()
    copies = (F.col("d.whole") + (F.col("d.mass") == F.col("d.cap")).cast("long")).alias("copies")
    fields = [F.col(f"d.{c}") for c in keep]
    chunks, depth = -(-max(1, rows.count()) // FAN), 0
    while True:
        rounded = _round_level(level, kind, seed, f"op9-level{depth}")
        out = out.unionByName(rounded.select(F.explode("done").alias("d")).select(*fields, copies))
        level = rounded.where("cur is not null").select(
            "source", F.col("cur").alias("doc"), F.floor(F.col("chunk") / FAN).alias("chunk"))
        if chunks <= 1:
            break
        chunks, depth = -(-chunks // FAN), depth + 1
    last = level.select(F.col("doc").alias("d"))
    luck = F.pmod(F.xxhash64(F.col("d.rank"), F.lit(seed)), F.col("d.cap")) < F.col("d.mass")
    return out.unionByName(last.select(*fields, (F.col("d.whole") + luck.cast("long")).alias("copies")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, cap: int = CAP, seed: int = 9) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), copies."""
    rows = docs.select(F.col(id_col).alias("key"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    out = pivotal_counts(rows, weights, cap, seed)
    return out.select(F.col("key").alias("doc_id"), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _hashable(docs: DataFrame, c: str) -> Column:
    """The column in a form that Spark hashes (it hashes no maps)."""
    return F.to_json(F.struct(c)) if "map<" in docs.schema[c].dataType.simpleString() else F.col(c)


def take_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
                cap: int = CAP, seed: int = 9) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the input's columns.

    The random order is that of the row's id, then of two hashes of the row, then of its number among equal rows, so the mix depends
    neither on the order of the rows nor on files and tasks, and reruns agree. Equal rows are counted, not
    told apart: one of them stands for all.
    """
    cols = docs.columns
    content = [_hashable(docs, c) for c in cols]
    names = {id_col, text_col, source_col} & set(cols)
    rows = stage(docs.select(F.struct(*cols).alias("row"), F.xxhash64(*[F.col(id_col)] if id_col in names else [F.lit(0)]).alias("k0"),
                             F.xxhash64(*content).alias("k1"), F.xxhash64(F.lit(1), *content[::-1]).alias("k2"),
                             F.monotonically_increasing_id().alias("at")), "op9-rows")
    keys = ["k0", "k1", "k2"]
    one = F.struct("at", F.col("row")[source_col].alias("source"), F.col("size"))
    groups = stage(rows.withColumn("text", F.col("row")[text_col]).withColumn("size", word_count("text"))
                   .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one")), "op9-groups")
    sizes = groups.select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"), "one").select(
        F.struct(*keys, "nth").alias("key"), "one.source", "one.size")
    counts = pivotal_counts(sizes, weights, cap, seed).where("copies > 0")
    total = counts.groupBy(*[F.col(f"key.{k}").alias(k) for k in keys]).agg(F.sum("copies").alias("copies"))
    taken = stage(total.join(groups, keys).select(F.col("one.at").alias("at"), "copies"), "op9-copies")
    return (rows.select("row", "at").join(taken, "at")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*"))
