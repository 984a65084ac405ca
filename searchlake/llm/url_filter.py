"""Operator 2, URL filter: rules first, then gradient-boosted trees on lexical features.

Features per URL: length, host length, path depth, digit ratio, character entropy, parameter
count, hyphens and dots of the host, file extension, and suffix statistics (how rare the host's
last label and last two labels are among all URLs). Each is binned by a fixed rule, so training
needs one histogram of gradient sums per tree level: Spark aggregates ``(node, feature,
bin)``, at most nodes x features x bins rows, and the driver picks the splits from these sums.
Gradients are summed as scaled longs, so the trees do not depend on the order of rows. The model
is a SQL ``CASE`` expression; scoring is one projection over all URLs.

The trees are fitted on a bounded sample: ``max_train`` labelled URLs in expectation, chosen by
hash (documented parameter). Suffix counts cover all URLs.

Defined results: null URLs and URLs without ``://`` have an empty host and path, fit no rule and
are scored like any other; without labelled URLs every score is 0.5 and the verdict ``allow``;
equal rows get equal verdicts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Host words that mark a URL as a labelled bad example.
SEED_WORDS = ("adult", "bets", "casino", "pills", "spam", "track")
BINS = 32
FEATURES = ("length", "host_length", "depth", "digits", "entropy", "params", "hyphens", "dots", "extension",
            "rare_label", "rare_domain")
SCALE = 1 << 20
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased A-Z) and path of a URL; both empty for null or no ``://``."""
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, pattern, 1), ASCII_UPPER, ASCII_LOWER)
    return host, F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _entropy(text: Column) -> Column:
    n = F.length(text)
    letters = F.array_distinct(F.split(text, ""))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n == 0, 0.0).otherwise(
        F.aggregate(letters, F.lit(0.0), lambda s, c: F.when(c == "", s).otherwise(s - share(c) * F.log2(share(c)))))


def with_features(urls: DataFrame) -> DataFrame:
    """urls(url, host, path, ...) -> the same rows with one binned column per feature."""
    url = F.coalesce(F.col("url"), F.lit(""))
    labels = F.split("host", r"\.")
    keyed = stage(
        urls.withColumn("label1", F.element_at(labels, -1))
        .withColumn("label2", F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".")),
        "op2-urls")
    total = max(1, keyed.count())
    rare = lambda n: F.log2(F.lit(float(total)) / F.col(n)) * 2
    for key in ("label1", "label2"):
        counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{key}"))
        keyed = keyed.join(stage(counts, f"op2-{key}"), key)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    raw = (F.length(url) / 4, F.length("host") / 2, _count(F.col("path"), "/"),
           F.when(url == "", 0.0).otherwise(_count(url, "0123456789") / F.length(url) * BINS),
           _entropy(F.concat("host", "path")) * 6, _count(query, "="), _count(F.col("host"), "-"),
           _count(F.col("host"), "."), F.col("path").rlike(r"\.[A-Za-z0-9]+$").cast("int"),
           rare("n_label1"), rare("n_label2"))
    binned = [F.least(F.floor(c), F.lit(BINS - 1)).cast("int").alias(n) for n, c in zip(FEATURES, raw, strict=True)]
    return keyed.select(*urls.columns, *binned)


def _descend(tree: list, node: int = 1) -> Column:
    """The node that a row reaches in a tree given as {node: (feature, bin)} splits."""
    if node not in tree:
        return F.lit(node)
    feature, cut = tree[node]
    return F.when(F.col(feature) <= cut, _descend(tree, 2 * node)).otherwise(_descend(tree, 2 * node + 1))


def _value(tree: dict, leaves: dict, node: int = 1) -> Column:
    if node not in tree:
        return F.lit(leaves[node])
    feature, cut = tree[node]
    return F.when(F.col(feature) <= cut, _value(tree, leaves, 2 * node)).otherwise(_value(tree, leaves, 2 * node + 1))


def fit_trees(sample: DataFrame, trees: int = 8, depth: int = 3, rate: float = 0.5, ridge: float = 1.0) -> Column:
    """sample(features..., y) -> the fitted log-odds as a column expression over the features."""
    n, pos = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n:
        return F.lit(0.0)
    margin = F.lit(round(math.log((pos + 1) / (n - pos + 1)), 6))
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES])).alias("c")
    for _ in range(trees):
        p = 1 / (1 + F.exp(-margin))
        graded = stage(sample.select(*FEATURES, "y", F.round((p - F.col("y")) * SCALE).cast("long").alias("g"),
                                     F.round(p * (1 - p) * SCALE).cast("long").alias("h")), "op2-graded")
        tree: dict[int, tuple[str, int]] = {}
        sums: dict[int, tuple[float, float]] = {}
        for level in range(depth):
            rows = (graded.select(_descend(tree).alias("node"), "g", "h", cells)
                    .groupBy("node", "c.f", "c.b").agg(F.sum("g"), F.sum("h")).collect())
            for node in sorted({r[0] for r in rows if r[0] >= 1 << level}):
                best = None
                for f in FEATURES:
                    bins = sorted((r[2], r[3] / SCALE, r[4] / SCALE) for r in rows if r[0] == node and r[1] == f)
                    g, h = sum(b[1] for b in bins), sum(b[2] for b in bins)
                    sums[node], gl, hl = (g, h), 0.0, 0.0
                    for cut, dg, dh in bins[:-1]:
                        gl, hl = gl + dg, hl + dh
                        gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                        if gain > (best[0] if best else 1e-6):
                            best = (gain, f, cut, (gl, hl), (g - gl, h - hl))
                if best:
                    tree[node] = best[1:3]
                    sums[2 * node], sums[2 * node + 1] = best[3:]
        leaves = {k: round(-rate * g / (h + ridge), 6) for k, (g, h) in sums.items()}
        margin = margin + _value(tree, leaves)
    return margin


def judge_urls(pages: DataFrame, labelled: Column, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               max_train: int = 20_000, **fit) -> DataFrame:
    """page_id, host, path, rule, verdict, score.

    ``labelled`` gives a URL's label (1 block, 0 allow, null unlabelled) from the columns
    url, host, path and rule (struct of rule and verdict).
    """
    host, path = split_url(F.col("url"))
    urls = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
            .withColumn("host", host).withColumn("path", path)
            .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("y", labelled.cast("int")))
    rows = stage(with_features(urls), "op2-features")
    known = rows.where("y is not null")
    share = min(1.0, max_train / max(1, known.count()))
    luck = F.pmod(F.xxhash64("url", "page_id"), F.lit(SCALE)) < int(share * SCALE)
    margin = fit_trees(stage(known.where(luck).select(*FEATURES, "y"), "op2-train"), **fit)
    method = F.when(margin > 0, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("rule.rule").alias("rule"),
                       F.coalesce("rule.verdict", method).alias("verdict"),
                       F.round(1 / (1 + F.exp(-margin)), 6).alias("score"))


def rule_and_seed_label(seed_words=SEED_WORDS) -> Column:
    """Labels for the trees: the rule's verdict, else block for hosts with a seed word, else (weakly) allow."""
    seeded = F.col("host").rlike("|".join(rf"\b{w}\b" for w in seed_words))
    return F.when(F.col("rule.verdict").isNotNull(), (F.col("rule.verdict") == "block").cast("int")).otherwise(
        seeded.cast("int"))
