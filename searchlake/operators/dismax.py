"""User-facing composite queries (F19–F28, X17, X18) over hit lists ``doc_id, score``.

Words and phrases come as Python lists: there is no query grammar. Every combination is a tagged union
and one aggregate (``textmatch.bool_hits`` / ``dismax_hits``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators import scoring
from searchlake.operators import textmatch as tm
from searchlake.operators.analysis import Analyzer, default_analyzer
from searchlake.operators.filters import min_should_match
from searchlake.operators.index import Index
from searchlake.operators.util import written


def analyzed_words(index: Index, text: str, analyzer: Analyzer | None = None) -> list[str]:
    """The tokens of a query text under an analysis chain (one row, evaluated by Spark)."""
    chain = (analyzer or default_analyzer()).array(F.lit(text))
    return [t for t in index.postings.sparkSession.range(1).select(chain.alias("t")).first().t if t is not None]


def field_query(index: Index, text: str, analyzer: Analyzer | None = None, slop: int = 0) -> DataFrame:
    """Field query (F20): analyze the text; one token is a term query, several are a phrase, none match nothing."""
    words = analyzed_words(index, text, analyzer)
    if not words:
        return index.postings.select("doc_id", F.lit(0.0).alias("score")).limit(0)
    return tm.match_term(index, words[0]) if len(words) == 1 else tm.phrase_hits(index, words, slop)


def function_hits(docs: DataFrame, id_col: str, expr: Column) -> DataFrame:
    """Function query (F23): every document matches, its score is the function's value (missing counts as 0)."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(expr.cast("double"), F.lit(0.0)).alias("score"))


def query_value(docs: DataFrame, id_col: str, hits: DataFrame, default: float = 0.0, name: str = "value") -> DataFrame:
    """The score of a nested query per document, ``default`` where it does not match."""
    scores = hits.select(F.col("doc_id").alias("_hit"), F.col("score").alias("_score"))
    return docs.join(scores, F.col(id_col) == F.col("_hit"), "left").withColumn(
        name, F.coalesce("_score", F.lit(float(default)))).drop("_hit", "_score")


def boosted_query(hits: DataFrame, docs: DataFrame, id_col: str, expr: Column) -> DataFrame:
    """Nested query score times a function of the document (X18); the function sees the document's columns."""
    values = docs.select(F.col(id_col).alias("doc_id"), expr.cast("double").alias("_f"))
    return hits.join(values, "doc_id").select("doc_id", (F.col("score") * F.col("_f")).alias("score"))


def ngram_phrase_freq(index: Index, grams: Sequence[str], n: int) -> DataFrame:
    """N-gram phrase (F19): overlapping grams of size ``n`` as a phrase, checked only at every n-th gram and the last one,
    as those cover all characters: ``doc_id, freq``."""
    kept, places = tm.ngram_phrase_terms(list(grams), n)
    # written: each gram of the phrase would otherwise read the index, or cut all texts, anew
    toks = written(index.terms(list(dict.fromkeys(kept))).select("doc_id", "term", F.explode("positions").alias("pos")), "phrase-grams")
    out = None
    for term, place in zip(kept, places, strict=True):
        starts = toks.filter(F.col("term") == term).select("doc_id", (F.col("pos") - place).alias("start"))
        out = starts if out is None else out.join(starts, ["doc_id", "start"])
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("freq"))


def _fields(weights: dict[str, float], indexes: dict[str, Index], allowed: Sequence[str] | None,
            aliases: dict[str, dict[str, float]] | None) -> dict[str, float]:
    """Field weights with aliases replaced by their fields and fields outside ``allowed`` left out."""
    out: dict[str, float] = {}
    for f, w in weights.items():
        for g, v in (aliases or {}).get(f, {f: 1.0}).items():
            if g in indexes and (allowed is None or g in allowed):
                out[g] = out.get(g, 0.0) + w * v
    return out


def edismax(indexes: dict[str, Index], words: Sequence[str], qf: dict[str, float] | None = None, *, tie: float = 0.0,
            mm: str | int | None = None, must: Sequence[str] = (), must_not: Sequence[str] = (),
            pf: dict[str, float] | None = None, pf2: dict[str, float] | None = None, pf3: dict[str, float] | None = None,
            ps: int = 0, ps2: int | None = None, ps3: int | None = None, bq: Sequence[DataFrame] = (),
            bf: Sequence[DataFrame] = (), boost: DataFrame | None = None, uf: Sequence[str] | None = None,
            aliases: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Extended DisMax.

    Each word is a disjunction-max over the ``qf`` fields; ``must`` words are required, ``must_not`` words exclude, the
    other words need ``mm``. ``pf`` boosts documents with the whole word sequence as a phrase, ``pf2`` and ``pf3`` those
    with word pairs and triples, each with its own slop. ``bq`` and ``bf`` are hit lists whose scores are added
    where they match, ``boost`` one whose score multiplies (1 where absent). ``uf`` limits the fields, ``aliases``
    name weighted groups of fields.
    """
    fields = lambda w: _fields(w, indexes, uf, aliases)
    qf = fields(qf or {f: 1.0 for f in indexes})

    def word(w: str) -> DataFrame:
        return tm.dismax_hits([scoring.score_terms(indexes[f], [w], boosts={w: b}) for f, b in qf.items()], tie)

    words = list(words)
    optional = [w for w in dict.fromkeys(words) if w not in must and w not in must_not]
    need = min_should_match(len(optional), mm) if mm is not None and optional else (0 if must else 1)
    main = tm.bool_hits([word(w) for w in must], [word(w) for w in optional], [word(w) for w in must_not], need)

    extras = list(bq) + list(bf)
    asked = [w for w in words if w not in must_not]
    shingled = ((pf, len(asked), ps), (pf2, 2, ps if ps2 is None else ps2), (pf3, 3, ps if ps3 is None else ps3))
    for weights, size, slop in shingled:
        if not weights or size < 2 or size > len(asked):
            continue
        for i in range(len(asked) - size + 1):
            phrase = asked[i:i + size]
            extras.append(tm.dismax_hits([
                tm.phrase_hits(indexes[f], phrase, slop).withColumn("score", F.col("score") * float(b))
                for f, b in fields(weights).items()], tie))
    out = tm.bool_hits([main], extras, []) if extras else main
    if boost is not None:
        factor = boost.select("doc_id", F.col("score").alias("_f"))
        out = out.join(factor, "doc_id", "left").select("doc_id", (F.col("score") * F.coalesce("_f", F.lit(1.0))).alias("score"))
    return out
