"""The registered queries of this subpackage: thin ``opN_<name>`` queries and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, table
from . import (
    bagminhash,
    bit_sliced,
    decontaminate,
    divergence,
    exact_dedup,
    line_dedup,
    mixing,
    packing,
    quality,
    rans,
    spelling_variants,
    suffix_dedup,
    url_filter,
)
from .common import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return run
    return deco


@_query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
""")
def op1(spark, sf_dir):
    """Equal texts of ``documents``: which row stays, group size, hash of the normalised text."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@_query("op2_url_filter")
def op2(spark, sf_dir):
    """Rule or model verdict for every URL of ``pages``."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rule_and_seed_label())


@_query("op3_quality")
def op3(spark, sf_dir):
    """Quality posterior of every document of ``documents``, and whether it stays."""
    model = quality.QualityModel(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return model.judged().select("doc_id", "quality.*").withColumn("keep", F.col("posterior") >= quality.THRESHOLD)


@_query("op4_near_dedup")
def op4(spark, sf_dir):
    """Near-duplicate class of every document of ``documents``."""
    return bagminhash.near_dedup(table(spark, sf_dir, "documents"))


@_query("op5_rans_token_files")
def op5(spark, sf_dir):
    """Every text's token ids, written to coded files and read back: place, length and checksum."""
    import public_tokenizers

    out = rans.code_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query("op6_length_buckets")
def op6(spark, sf_dir):
    """Bucket, batch and place of every piece of every document of ``documents``."""
    return packing.pack(table(spark, sf_dir, "documents"))


@_query("op7_bit_sliced_topk", r"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op7(spark, sf_dir):
    """The ten rows of ``embeddings`` with the highest integer inner product, for every hundredth id."""
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


@_query("op8_suffix_dedup")
def op8(spark, sf_dir):
    """Bytes of ``documents`` that a 50-byte string of a smaller id covers, and the hash of the rest."""
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


@_query("op9_mix_sources")
def op9(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@_query("op10_line_dedup", r"""
WITH l AS (SELECT doc_id, source, i, string_split(text, chr(10))[i] AS raw
           FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
s AS (SELECT trim(raw) AS line, min(doc_id) AS first_id FROM l WHERE trim(raw) <> ''
      GROUP BY 1 HAVING count(DISTINCT coalesce(source, '')) >= 10),
k AS (SELECT l.*, s.line IS NOT NULL AND l.doc_id <> s.first_id AS gone FROM l LEFT JOIN s ON trim(l.raw) = s.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM k GROUP BY doc_id
""")
def op10(spark, sf_dir):
    """Every document of ``documents`` with cross-site boilerplate lines removed."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("line_dedup.n_lines").alias("n_lines"),
                      F.col("line_dedup.n_removed").alias("n_removed"), "text")


@_query("op11_spelling_variants", r"""
WITH RECURSIVE bits AS (SELECT unnest(range(0, 256))::BIGINT AS c),
tab AS (SELECT list(list_reduce(range(0, 8), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END, c)
                    ORDER BY c) AS t FROM bits),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
           SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
crc AS (SELECT run, n, xor(list_reduce(
            list_transform(range(0, length(x) // 2), lambda i: (16 * (instr('0123456789ABCDEF', x[2*i+1:2*i+1]) - 1)
                                                                + instr('0123456789ABCDEF', x[2*i+2:2*i+2]) - 1)::BIGINT),
            lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM hexed, tab),
words AS (SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM crc),
v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (SELECT word, n, word[1:i-1] AS a, word[i+1:] AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT x.word, y.word AS other, y.n FROM gaps x JOIN gaps y ON x.a = y.a AND x.b = y.b WHERE x.word <> y.word
         UNION SELECT x.word, y.word, y.n FROM gaps x JOIN v y ON x.a || x.b = y.word
         UNION SELECT y.word, x.word, x.n FROM gaps x JOIN v y ON x.a || x.b = y.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS m, min(other) FILTER (n = top) AS other
         FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN other END AS form,
             CASE WHEN m >= 2 * v.n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS d FROM f
          UNION ALL SELECT c.word, f.form, d + 1 FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, max_by(root, d) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN roots USING (word)
""")
def op11(spark, sf_dir):
    """Every frequent word of ``documents`` with its near words' number, its form and the root of its chain of forms."""
    return spelling_variants.spelling_variants(spelling_variants.word_counts(table(spark, sf_dir, "documents")))


@_query("op12_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT s.lang, s.source, coalesce(x.n, 0) + 2 * coalesce(v.v, 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) x USING (lang, source)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // g.total AS p
      FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * max(v.v)) AS q
      FROM c JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (SELECT pairs.lang, pairs.source, 'pair' AS part, pairs.item, coalesce(value, 0)::BIGINT AS value
         FROM pairs LEFT JOIN pv ON pairs.lang = pv.lang AND pairs.source = pv.source AND pairs.item = pv.item
         UNION ALL
         SELECT p.lang, p.source, 'term', p.term, (((p.p - q.q) * (p.p - q.q)) // (p.p + q.q))::BIGINT
         FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""")
def op12(spark, sf_dir):
    """Divergence of every source of ``documents`` from the others of its language, and its ten most typical terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@_query("op13_decontaminate", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens)),
met AS (SELECT dw.doc_id, dw.i, dw.k, win.item FROM dw JOIN win ON dw.k = win.k AND dw.s = win.s),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM met) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op13(spark, sf_dir):
    """Words of every document of ``documents`` inside windows of ``benchmark`` items, and the items."""
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    """The corpus pipeline over ``documents``."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
