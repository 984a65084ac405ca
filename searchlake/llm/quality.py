"""Operator 3, quality classifier: hierarchical empirical Bayes over document, path and host.

A document's own evidence is a logistic regression on surface features (length, word length, share of
distinct words and lines, capitals, symbols, digits, ...), fitted to labelled documents. The
evidence is averaged over paths and hosts, and shrunk in two steps: the host's mean towards the
global mean, the path's mean towards its host's; how strongly is estimated from the spread between the
groups (method of moments), so sparse sites stay near the prior. A document's posterior adds to its own
log-odds the path's shift from the global log-odds, computed without the document itself.

Host and path come from the source column: ``host/path...``; a source without a path uses
the language as its second level.

The regression is fitted on a bounded sample, ``max_train`` labelled documents in expectation, chosen by
hash (documented parameter); everything else aggregates all documents, combined before the
shuffle. Group tables are joined back on small rows without texts.

Defined results: null text counts as empty; null source and language count as empty strings;
without labels every document's own evidence is 1/2 and all are kept; several labels of one id
all count; rows are judged one by one, so equal rows get equal posteriors; null ids are judged like others;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stage, text_or_empty

FEATURES = ("log_words", "word_length", "distinct_words", "distinct_lines", "capitals", "digits", "symbols",
            "exclamations", "bars", "stops", "words_per_line")
THRESHOLD = 0.2  # rejected documents are gone for good, so the evidence must be clear
SITE_WEIGHT = 0.5
SCALE = 1 << 20


def features(text_col: str = "text") -> Column:
    text = text_or_empty(text_col)
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda w: F.trim(w) != "")
    n_words, n_lines, chars = F.size(words), F.size(lines), F.length(text)
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    chars_of = lambda c: chars - F.length(F.translate(text, c, ""))
    values = (F.log1p(n_words), share(chars, n_words), share(F.size(F.array_distinct(words)), n_words),
              share(F.size(F.array_distinct(lines)), n_lines), share(count(r"\p{Lu}"), chars),
              share(chars_of("0123456789"), chars), share(count(r"[^\p{L}\p{N}\s.,]"), chars),
              share(chars_of("!"), n_words), share(chars_of("|"), n_words), share(chars_of("."), n_words),
              F.log1p(share(n_words, n_lines)))
    return F.array(*[v.cast("double") for v in values])


def host_and_path(source_col: str = "source", lang_col: str = "lang") -> tuple[Column, Column]:
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    path = F.regexp_extract(source, "^[^/]*/([^/]*)", 1)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    return F.substring_index(source, "/", 1), F.when(source.contains("/"), path).otherwise(lang)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, turns: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept on raw features, by Newton steps on standardised features and their squares."""
    mean, sd = x.mean(0), x.std(0)
    sd[sd < 1e-9] = 1.0
    z = (x - mean) / sd
    z = np.clip(z, -8, 8)
    a = np.column_stack([np.ones(len(z)), z])
    w = np.zeros(a.shape[1])
    penalty = np.diag([1e-3] + [ridge] * z.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.column_stack([w[1:], mean, sd]), float(w[0])


def _expand(f: np.ndarray) -> np.ndarray:
    return np.column_stack([f, f ** 2])


def log_odds(model, f: Column) -> Column:
    """The regression as a column over the feature array."""
    weights, start = model
    out = F.lit(round(start, 9))
    for i, (w, mean, sd) in enumerate(weights.tolist()):
        v = f[i % len(FEATURES)]
        v = v if i < len(FEATURES) else v * v
        z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (v - mean) / sd))
        out = out + z * round(w, 9)
    return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), out))


def train(rows: DataFrame, labels: DataFrame, max_train: int = 20_000):
    """rows(doc_id, f) with labels(doc_id, quality) -> model; None without labels of both kinds."""
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
    share = min(1.0, max_train / max(1, labels.count()))
    sample = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SCALE)) < int(share * SCALE))
    got = rows.join(sample, "doc_id").select("doc_id", "f", "quality").collect()  # max_train rows, in expectation
    got.sort(key=lambda r: (r[0], r[1], r[2]))
    y = np.array([r[2] for r in got], float)
    if not len(y) or y.min() == y.max():
        return None
    return fit_logistic(_expand(np.array([r[1] for r in got])), y)


def _spread(groups: DataFrame, n: str, s: str, centre: Column) -> float:
    """Prior weight (pseudo documents) of a group's mean around ``centre``, by the method of moments."""
    m = F.col(s) / F.col(n)
    row = groups.where(f"{n} > 1").agg(
        F.sum(F.col(n) * (m - centre) ** 2), F.sum(n), F.count(F.lit(1)), F.avg(m * (1 - m))).first()
    between, total, k, within = row[0] or 0.0, row[1] or 0, row[2], row[3] or 0.25
    if k < 2:
        return 100.0
    excess = (between - k * within) / total  # the groups' variance beyond that of n draws each
    return float(min(10_000.0, max(1.0, within / excess - 1 if excess > 0 else 10_000.0)))


def site_table(rows: DataFrame) -> tuple[DataFrame, float]:
    """rows(host, path, p) -> (host, path, n_host, s_host, n_path, s_path, k_host, k_path), global mean."""
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"), F.sum("p").alias("s_path"))
    paths = stage(paths, "op3-paths")
    hosts = stage(paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host")), "op3-hosts")
    n, s = hosts.agg(F.sum("n_host"), F.sum("s_host")).first()
    mean = s / n if n else 0.5
    both = stage(paths.join(hosts, "host"), "op3-sites")
    k_host = _spread(hosts, "n_host", "s_host", F.lit(mean))
    k_path = _spread(both, "n_path", "s_path", F.col("s_host") / F.col("n_host"))
    return both.withColumn("k_host", F.lit(k_host)).withColumn("k_path", F.lit(k_path)), mean


def posterior(rows: DataFrame, sites: DataFrame, mean: float, site_weight: float = SITE_WEIGHT) -> DataFrame:
    """rows(..., host, path, odds, p) with their group posteriors and the combined posterior (in ``quality``)."""
    mean = min(1 - 1e-6, max(1e-6, mean))
    host = (F.col("k_host") * mean + F.col("s_host") - F.col("p")) / (F.col("k_host") + F.col("n_host") - 1)
    path = (F.col("k_path") * F.col("host_posterior") + F.col("s_path") - F.col("p")) / (F.col("k_path") + F.col("n_path") - 1)
    logit = lambda p: F.log(F.greatest(F.lit(1e-6), p) / F.greatest(F.lit(1e-6), 1 - p))
    total = F.col("odds") + F.lit(site_weight) * (logit(F.col("path_posterior")) - float(np.log(mean / (1 - mean))))
    fine = [c for c in rows.columns if c not in ("host", "path", "odds", "p")]
    return (rows.join(sites, ["host", "path"]).withColumn("host_posterior", host).withColumn("path_posterior", path)
            .withColumn("posterior", 1 / (1 + F.exp(-total)))
            .select(*fine, F.struct("p", "host_posterior", "path_posterior", "posterior").alias("quality")))


class QualityModel:
    """Fitted on ``docs`` and ``labels``; ``judge`` scores rows of the same kind."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", lang_col: str = "lang", max_train: int = 20_000, feature_col: str | None = None):
        """``feature_col``: a column that holds the documents' ``features`` already."""
        self.source_col, self.lang_col = source_col, lang_col
        self.features = F.col(feature_col) if feature_col else features(text_col)
        host, path = host_and_path(source_col, lang_col)
        rows = docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), path.alias("path"), self.features.alias("f"))
        self.rows = rows if feature_col else stage(rows, "op3-features")
        self.model = train(self.rows, labels, max_train)
        self.scored = self._evidence(self.rows).drop("f")
        self.sites, self.mean = site_table(self.scored)

    def _evidence(self, rows: DataFrame) -> DataFrame:
        odds = log_odds(self.model, F.col("f")) if self.model else F.lit(0.0)
        return rows.withColumn("odds", odds).withColumn("p", F.round(1 / (1 + F.exp(-F.col("odds"))), 9))

    def judged(self) -> DataFrame:
        """doc_id and quality of the rows that the model was fitted on (no text is read again)."""
        return posterior(self.scored, self.sites, self.mean)

    def judge(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` (of the fitted table), with ``quality`` added; column names may clash with ours."""
        host, path = host_and_path(self.source_col, self.lang_col)
        rows = docs.select(F.struct(*docs.columns).alias("row"), host.alias("host"), path.alias("path"),
                           self.features.alias("f"))
        return posterior(self._evidence(rows).drop("f"), self.sites, self.mean)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose posterior is at least ``threshold``, with the input's columns.

    The rows are written once with their features, so that fitting, the site tables and the verdict all read these."""
    f = "f"
    while f in docs.columns:
        f += "_"
    cols = docs.columns
    rows = stage(docs.select(*cols, features().alias(f)), "op3-rows")
    model = QualityModel(rows, labels, feature_col=f)
    return model.judge(rows).where(F.col("quality.posterior") >= threshold).select(*[F.col("row")[c].alias(c) for c in cols])
