"""Search-result components (C02–C19): highlighting, more-like-this, spelling, suggestions.

All of them work on the index tables. Vocabulary-side work (spelling, suggestions) runs on
distinct terms; candidate generation uses blocking keys so no plan is a cross join: spelling
joins on deletion-neighbourhood keys (two strings within k edits share a string obtained by
deleting ≤ k characters from each), then verifies with a bounded ``levenshtein``. As a word's best few suggestions are
asked for, few edits are tried first; only words that more edits could bring a better one go on (``nearest_strings``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.analysis import DEFAULT_PATTERN
from searchlake.operators.index import Index
from searchlake.operators.util import bounded_broadcast, join_keys, written


# ------------------------------------------------------------------ more-like-this

def interesting_terms(index: Index, source_docs: DataFrame, *, min_tf: int = 2, min_df: int = 5,
                      max_df: int | None = None, min_word_len: int = 0, max_word_len: int = 0,
                      max_query_terms: int = 25) -> DataFrame:
    """Top terms of each source doc by tf·idf (C09): ``doc_id, term, tf, df, weight, rank``.

    idf = 1 + ln(N/(df+1)). A per-doc ``row_number() <= max_query_terms`` window: each doc's
    term list is bounded by its length, and the limit is applied map-side (WindowGroupLimit)."""
    p = index.postings.join(source_docs.select("doc_id"), "doc_id", "left_semi").select("doc_id", "term", "tf")
    j = p.join(index.term_stats.select("term", "df"), "term").crossJoin(F.broadcast(index.field_stats.select("n_docs")))
    j = j.filter(F.col("tf") >= min_tf).filter(F.col("df") >= min_df)
    if max_df is not None:
        j = j.filter(F.col("df") <= max_df)
    if min_word_len:
        j = j.filter(F.length("term") >= min_word_len)
    if max_word_len:
        j = j.filter(F.length("term") <= max_word_len)
    idf = F.lit(1.0) + F.ln(F.col("n_docs") / (F.col("df") + 1.0))
    j = j.withColumn("weight", F.col("tf") * idf)
    w = Window.partitionBy("doc_id").orderBy(F.col("weight").desc(), F.col("term").asc())
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max_query_terms) \
        .select("doc_id", "term", "tf", "df", "weight", "rank")


def more_like_these(index: Index, source_docs: DataFrame, k: int = 5, hot_df: int = 1000, **kw) -> DataFrame:
    """Similar docs for each source doc (C07/C08): OR query of its interesting terms scored with
    classic tf-idf weights (√tf · idf² · 1/√dl), the source doc itself excluded; top ``k`` per
    source. Output: ``source_id, doc_id, score, rank``.

    Exact, without joining the postings of hot terms (in more than ``hot_df`` documents) where they cannot matter. The rare terms
    are scored first; the k-th best sum is a bound that the result cannot fall below. A hot term adds at most idf² times its
    largest √tf / √dl. Per source, the hot terms with the smallest bounds whose sum stays below the k-th best bring no new
    document in: only the candidates that could still reach it look their postings up, by (term, document). The other
    hot terms are joined like rare ones."""
    it = written(interesting_terms(index, source_docs, **kw).select(F.col("doc_id").alias("source_id"), "term", "df"), "mlt-terms")
    n = F.broadcast(index.field_stats.select("n_docs"))
    idf = F.lit(1.0) + F.ln(F.col("n_docs") / (F.col("df") + 1.0))
    weight = F.sqrt(F.col("tf").cast("double")) * idf * idf / F.sqrt(F.col("dl").cast("double"))
    postings = index.postings.select("term", "doc_id", "tf", "dl")
    # exact copies score the same up to summation order: compare at 1e-9, then by doc_id
    best = Window.partitionBy("source_id").orderBy(F.round("score", 9).desc(), F.col("doc_id").asc())

    def hits(terms: DataFrame) -> DataFrame:
        j = terms.join(postings, "term").filter(F.col("doc_id") != F.col("source_id")).crossJoin(n)
        return j.select("source_id", "doc_id", weight.alias("score"))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("source_id", "doc_id").agg(F.sum("score").alias("score"))

    hot = it.filter(F.col("df") > hot_df)
    if hot.isEmpty():
        return summed(hits(it)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    partial = written(summed(hits(it.filter(F.col("df") <= hot_df))), "mlt-partial")
    floor = partial.withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select("source_id", F.col("score").alias("floor"))
    peak = postings.join(hot.select("term").distinct(), "term", "left_semi").groupBy("term").agg(
        F.max(F.sqrt(F.col("tf") / F.col("dl"))).alias("peak"))
    bound = hot.join(peak, "term").crossJoin(n).select("source_id", "term", "df", (idf * idf * F.col("peak") * (1 + 1e-9)).alias("bound"))
    up_to = Window.partitionBy("source_id").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    # at most max_query_terms rows per source
    placed = bound.withColumn("sum", F.sum("bound").over(up_to)).join(floor, "source_id", "left")
    placed = written(placed.withColumn("late", F.coalesce(F.col("sum") < F.col("floor") - 1e-8, F.lit(False))), "mlt-bounds")
    early = written(summed(partial.unionByName(hits(placed.filter(~F.col("late")).select("source_id", "term", "df")))), "mlt-early")
    late = placed.filter("late").groupBy("source_id").agg(F.max("sum").alias("rest"), F.max("floor").alias("floor"))
    reach = early.join(late, "source_id").filter(F.col("score") + F.col("rest") >= F.col("floor") - 1e-8).select("source_id", "doc_id")
    asked = reach.join(placed.filter("late").select("source_id", "term", "df"), "source_id")
    more = asked.join(postings, ["term", "doc_id"]).crossJoin(n).select("source_id", "doc_id", weight.alias("score"))
    return summed(early.unionByName(more)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


# ------------------------------------------------------------------ spelling

def deletion_keys(term: Column, max_edits: int = 2, min_prefix: int = 1) -> Column:
    """All strings made by deleting up to ``max_edits`` characters after the first ``min_prefix``
    characters (which must match exactly), prefixed by that head. Array of distinct keys."""
    head = F.substring(term, 1, min_prefix)
    tail = F.when(F.length(term) > min_prefix, F.substring(term, min_prefix + 1, 1 << 20)).otherwise(F.lit(""))
    level = F.array(tail)
    keys = level
    for _ in range(max_edits):
        level = F.array_distinct(F.flatten(F.transform(level, lambda s: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
            lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, 1 << 20))))))
        keys = F.concat(keys, level)
    return F.transform(F.array_distinct(keys), lambda k: F.concat(head, F.lit("|"), k))


def spell_suggest(vocab: DataFrame, words: DataFrame, n_docs_col: str | None = None, *, max_edits: int = 2,
                  min_prefix: int = 1, min_query_length: int = 4, accuracy: float = 0.5,
                  max_query_frequency: float = 0.01, n_docs: int | None = None, threshold_freq: int = 0,
                  count: int = 5, only_more_popular: bool = False) -> DataFrame:
    """Suggestions from the term dictionary.

    ``vocab``: ``term, df``; ``words``: ``word`` (with its own df looked up in ``vocab``).
    A word is checked when its length ≥ ``min_query_length`` and its df ≤ max_query_frequency·N
    (a fraction) — frequent words are taken as correct. Candidates share the first ``min_prefix``
    characters, are within ``max_edits`` (Levenshtein), have similarity 1 − d/max(len) ≥
    ``accuracy`` and df ≥ ``threshold_freq`` (and > the word's df when ``only_more_popular``).
    Order: similarity desc, df desc, term asc; top ``count`` per word.
    Output: ``word, suggestion, edits, score, freq, rank``."""
    w = words.select("word").distinct().filter(F.length("word") >= min_query_length)
    w = w.join(vocab.select(F.col("term").alias("word"), F.col("df").alias("word_df")), "word", "left") \
        .withColumn("word_df", F.coalesce("word_df", F.lit(0)))
    if n_docs is not None:
        w = w.filter(F.col("word_df") <= F.lit(max_query_frequency * n_docs))
    near = nearest_strings(w, vocab.filter(F.col("df") >= threshold_freq), accuracy, count, max_edits=max_edits, head=min_prefix,
                           keep=F.col("df") > F.col("word_df") if only_more_popular else None)
    return near.select("word", F.col("term").alias("suggestion"), "edits", "score", F.col("df").alias("freq"), "rank")


#: Words and terms that are compared at once.
WORD_BLOCK, TERM_BLOCK = 1024, 4096


def _bags(strings: list[str]) -> np.ndarray:
    """How often each string has the characters of each of 64 classes, a row for a class."""
    lengths = np.array([len(x) for x in strings], np.int64)
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4") & 63
    at = codes.astype(np.int64) * len(strings) + np.repeat(np.arange(len(strings)), lengths)
    kind = np.int16 if lengths.max(initial=0) < 1 << 14 else np.int64
    return np.bincount(at, minlength=64 * len(strings)).astype(kind).reshape(64, -1)


def _like_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks ``words, terms, dfs, d`` -> their pairs that have all but ``d`` of the longer one's characters in common, in any order: an edit
    changes one of them."""
    for b in batches:
        for r in range(b.num_rows):
            words, terms, dfs, d = (c[r] for c in b.columns)
            words, of, d = words.as_py(), terms.as_py(), d.as_py()
            bags, longer = _bags(of), max(len(words[0]), len(of[0]))
            pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for i, bag in enumerate(_bags(words).T):
                common = np.zeros(len(of), bags.dtype)
                for c in np.flatnonzero(bag).tolist():
                    common += np.minimum(bags[c], bag[c])
                near = np.flatnonzero(common >= longer - d)
                pairs.append((np.full(len(near), i), near))
            at, near = (np.concatenate(x) for x in zip(*pairs, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()).take(pa.array(at)), pa.array(of, pa.string()).take(pa.array(near)),
                                              pa.array(dfs.as_py(), pa.int64()).take(pa.array(near)), pa.array(np.full(len(at), d), pa.int32())],
                                             ["word", "term", "df", "d"])


def near_strings(words: DataFrame, vocab: DataFrame, accuracy: float) -> DataFrame:
    """Pairs ``word, term, df, score`` with 1 - levenshtein / longer length of at least ``accuracy`` (which must be positive).

    Words and terms stand in blocks of one length; the blocks whose lengths allow the score meet, and a task compares the bags of
    characters of a few blocks at a time, so its memory is bounded and any number of tasks share the work, which is that of all such pairs.
    The pairs that are left are measured with the bound. None is lost. Equal strings are left out.
    """
    if not 0 < accuracy <= 1:
        raise ValueError("accuracy must be above 0 and at most 1")
    edits = lambda a, b: F.floor(F.greatest(a, b) * (1 - accuracy) + 1e-9).cast("int")
    words = written(words.select("word").filter(F.length("word") > 0).distinct(), "near-words")
    v = vocab.select("term", F.col("df").cast("long").alias("df")).filter(F.length("term") > 0).distinct()
    # the lengths that a word and a term may have together: at most the square of the longest word
    pairs = words.select(F.length("word").alias("nw")).distinct().crossJoin(v.select(F.length("term").alias("nt")).distinct())
    pairs = pairs.withColumn("d", edits(F.col("nw"), F.col("nt"))).filter((F.abs(F.col("nw") - F.col("nt")) <= F.col("d")) & (F.col("d") > 0))

    def blocks(rows: DataFrame, c: str, size: int) -> DataFrame:
        many = bounded_broadcast(rows.groupBy(F.length(c).alias("_n")).agg(F.ceil(F.count(F.lit(1)) / size).alias("_m")))
        return rows.join(many, F.length(c) == F.col("_n")).groupBy("_n", F.expr(f"pmod(xxhash64({c}), _m)").alias("_b"))

    wb = blocks(words, "word", WORD_BLOCK).agg(F.collect_list("word").alias("words")).withColumnRenamed("_n", "nw")
    tb = blocks(v, "term", TERM_BLOCK).agg(F.collect_list(F.struct("term", "df")).alias("_t"))
    tb = tb.select(F.col("_n").alias("nt"), F.col("_t.term").alias("terms"), F.col("_t.df").alias("dfs"))
    asked = wb.join(bounded_broadcast(pairs), "nw").select("nt", "d", "words")
    tasks = words.sparkSession.sparkContext.defaultParallelism * 3
    met = join_keys(tb, asked, "nt").select("words", "terms", "dfs", "d").repartition(tasks)
    like = met.mapInArrow(_like_bags, "word string, term string, df long, d int").filter("word <> term")
    lev = like.withColumn("k", F.expr("levenshtein(word, term, d)")).filter("k >= 0")
    sim = F.lit(1.0) - F.col("k") / F.greatest(F.length("word"), F.length("term"))
    return lev.select("word", "term", F.col("df").cast(vocab.schema["df"].dataType).alias("df"), sim.alias("score")).filter(F.col("score") >= accuracy)


#: Edits that are searched by deletion keys, of which a string of n characters has about n**edits / edits!; more are searched by parts.
KEYED_EDITS = 2
#: Rows of keys in one Arrow batch.
KEY_ROWS = 1 << 17
_BASE, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _cut_keys(strings: list[str], edits: int, head: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(numbers of strings, deletions, keys): a key for every way to delete up to ``edits`` characters behind the first ``head``.

    A key is the polynomial hash of what is left, put together from hashes of prefixes; strings of one length are worked on together."""
    lengths = np.array([len(x) for x in strings], np.int64)
    with np.errstate(over="ignore"):
        for n in np.unique(lengths[lengths >= head]).tolist():
            at = np.flatnonzero(lengths == n)
            codes = np.frombuffer("".join([strings[i] for i in at.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(at), n)
            power, prefix = [np.uint64(1)], [np.full(len(at), 1, np.uint64)]
            for i in range(n):
                power.append(power[-1] * _BASE)
                prefix.append(prefix[-1] * _BASE + codes[:, i].astype(np.uint64) * _ODD)
            for cuts in range(min(edits, n - head) + 1):
                for gone in combinations(range(head, n), cuts):
                    ends = (*gone, n)
                    key = prefix[ends[0]]
                    for i, z in zip(gone, ends[1:], strict=True):
                        key = (key - prefix[i + 1]) * power[z - i - 1] + prefix[z]
                    key = (key ^ (key >> np.uint64(32))) * _ODD
                    yield at, cuts, key ^ (key >> np.uint64(29))


def _key_rows(rows: DataFrame, edits: int, head: int, bits: np.ndarray | None = None) -> DataFrame:
    """The rows, whose first column is the string, with ``h`` and ``cuts`` for each of its keys; with ``bits`` (``_hash_bitmap`` as one array)
    only for keys that may be known."""
    shared = rows.sparkSession.sparkContext.broadcast(bits) if bits is not None else None
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared is not None else None
        for b in batches:
            held, size = [], 0

            def flush(b=b):
                at, cuts, keys = (np.concatenate(x) for x in zip(*held, strict=True))
                part = b.take(pa.array(at))
                return pa.RecordBatch.from_arrays([*part.columns, pa.array(keys.view(np.int64)), pa.array(cuts, pa.int32())],
                                                  [*b.schema.names, "h", "cuts"])

            for at, cuts, keys in _cut_keys(b.column(0).to_pylist(), edits, head):
                if known is not None:
                    bit = (keys & np.uint64(BITMAP_BITS - 1)).astype(np.uint32)
                    some = known[bit >> np.uint32(3)] >> (bit & np.uint32(7)).astype(np.uint8) & 1 != 0
                    at, keys = at[some], keys[some]
                held.append((at, np.full(len(at), cuts, np.int32), keys))
                size += len(at)
                if size >= KEY_ROWS:
                    yield flush()
                    held, size = [], 0
            if size:
                yield flush()

    return rows.mapInArrow(run, f"{fields}, h long, cuts int")


def _all_bits(bitmap: DataFrame) -> np.ndarray:
    """The rows of ``_hash_bitmap`` as one array of fixed size."""
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for bucket, bits in bitmap.collect():
        out[(bucket - 1) * len(bits):bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _pairs_within(words: DataFrame, vocab: DataFrame, edits: int, most: Column, head: int) -> DataFrame:
    """The words' rows with the vocabulary's that are at most ``edits``, and ``most``, edits away, behind an equal ``head``: ``edits`` says how many.

    Strings that are at most k edits apart are equal when k characters of the longer one and as many fewer of the other as it is
    shorter are deleted. Only their keys meet; a bitmap of the words' keys leaves out most keys of terms before the shuffle."""
    wk = written(_key_rows(words, edits, head), "near-keys").withColumnRenamed("cuts", "_w")
    bits = _all_bits(_hash_bitmap(wk.select("h")))
    tk = _key_rows(vocab.select("term", "df"), edits, head, bits)
    met = join_keys(tk, wk, "h").filter((F.greatest("cuts", "_w") == edits) | (F.greatest(F.length("word"), F.length("term")) - head < edits))
    met = met.filter((F.col("word") != F.col("term")) & (F.substring("word", 1, head) == F.substring("term", 1, head)))
    met = met.withColumn("edits", F.call_function("levenshtein", "word", "term", F.least(F.lit(edits), most)))
    return met.filter("edits >= 0").select(*words.columns, "term", "df", "edits").distinct()


def nearest_strings(words: DataFrame, vocab: DataFrame, accuracy: float, count: int, *, max_edits: int | None = None, head: int = 0,
                    keep: Column | None = None) -> DataFrame:
    """The words' rows with their ``count`` best terms: ``term, df, edits, score, rank`` by 1 - levenshtein / longer length (at least
    ``accuracy``), then df, then term; the same terms as of all such pairs.

    Turn k looks at all pairs of at most k edits. A term of more edits has a score of at most 1 - (k + 1) / (length + k + 1), so a word whose
    last wanted term is above it is done, as is one that k edits bring down to ``accuracy``; the others take the next turn. Behind
    ``KEYED_EDITS`` turns (``max_edits`` if given), what is left is searched in full (``near_strings``). ``head``: characters that must be equal;
    ``keep``: a condition on pairs."""
    if max_edits is None and not 0 < accuracy <= 1:
        raise ValueError("accuracy must be above 0 and at most 1")
    n, longer = F.length("word"), F.greatest(F.length("word"), F.length("term"))
    most = F.floor(longer * (1 - accuracy) + 1e-9).cast("int")
    reach = F.floor(n * ((1 - accuracy) / accuracy) + 1e-9).cast("int") if accuracy > 0 else F.lit(max_edits)
    if max_edits is not None:
        most, reach = F.least(most, F.lit(max_edits)), F.least(reach, F.lit(max_edits))
    order = Window.partitionBy("word").orderBy(F.col("score").desc(), F.col("df").desc(), F.col("term").asc())
    tasks = vocab.sparkSession.sparkContext.defaultParallelism * 4
    terms = written(vocab.select("term", "df").filter(F.length("term") > 0).repartition(tasks, "term"), "near-terms")

    def best(pairs: DataFrame) -> DataFrame:
        found = pairs.withColumn("score", F.lit(1.0) - F.col("edits") / longer).filter(F.col("score") >= accuracy)
        found = found.filter(keep) if keep is not None else found
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)

    left = written(words.distinct().filter((n > 0) & (reach > 0)), "near-words")
    out, names = [], words.columns
    for k in range(1, max(1, KEYED_EDITS if max_edits is None else max_edits) + 1):
        found = written(best(_pairs_within(left, terms, k, most, head)), "near-found")
        above = (F.col("rank") == count) & (F.col("score") > F.lit(1.0) - F.lit(k + 1.0) / (n + k + 1) + 1e-9)
        done = written(left.join(found.filter(above).select("word"), "word", "left_semi").unionByName(left.filter(reach <= k)).distinct(), "near-done")
        out.append(found.join(done.select("word"), "word", "left_semi"))
        left = written(left.join(done.select("word"), "word", "left_anti").select(*names), "near-left")
        if left.isEmpty():
            break
    else:
        pairs = near_strings(left, terms, accuracy).drop("score").join(left, "word").withColumn("edits", F.levenshtein("word", "term"))
        pairs = pairs.filter(F.substring("word", 1, head) == F.substring("term", 1, head))
        out.append(best(pairs.select(*names, "term", "df", "edits")))
    whole = out[0]
    for some in out[1:]:
        whole = whole.unionByName(some)
    return whole


def spell_ngram(vocab: DataFrame, words: DataFrame, n: int = 3, count: int = 5, accuracy: float = 0.5) -> DataFrame:
    """N-gram candidate spelling (C12): terms that share at least one character n-gram with the word, ranked by
    1 − levenshtein/max(len), then df. The similar pairs are found first (``nearest_strings``), then the grams decide: a frequent
    gram joins nothing."""
    def grams(c):
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))),
                                            lambda i: F.substring(c, i, n)))
    near = nearest_strings(words, vocab, accuracy, count, keep=F.arrays_overlap(grams(F.col("word")), grams(F.col("term"))))
    return near.select("word", F.col("term").alias("suggestion"), "score", F.col("df").alias("freq"), "rank")


def word_break_suggest(vocab: DataFrame, words: DataFrame, min_break_length: int = 1,
                       min_suggestion_freq: int = 1) -> DataFrame:
    """Word-break suggestions (C13): split a word in two where both halves are vocabulary terms
    (one break, ``maxChanges`` 1). Output ``word, left, right, freq`` (min df of the halves)."""
    w = words.select("word").distinct()
    splits = w.select("word", F.explode(F.sequence(F.lit(min_break_length),
                                                   F.greatest(F.length("word") - min_break_length,
                                                              F.lit(min_break_length)))).alias("i")) \
        .filter(F.col("i") < F.length("word")) \
        .select("word", F.substring("word", 1, F.col("i")).alias("left"),
                F.expr("substring(word, i + 1)").alias("right"))
    v = vocab.filter(F.col("df") >= min_suggestion_freq).select("term", "df")
    j = splits.join(v.select(F.col("term").alias("left"), F.col("df").alias("_l")), "left") \
        .join(v.select(F.col("term").alias("right"), F.col("df").alias("_r")), "right")
    return j.select("word", "left", "right", F.least("_l", "_r").alias("freq"))


#: Bits of the vocabulary's bitmap: 8 MB, whatever the size of the vocabulary.
BITMAP_BITS = 1 << 26


def _hash_bitmap(hashes: DataFrame) -> DataFrame:
    """``bucket, bits`` of a column ``h``: a fixed number of bits, at most 2,048 rows of 4 KB."""
    at = F.pmod("h", F.lit(BITMAP_BITS)) + 1
    return hashes.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("at")).groupBy("bucket").agg(
        F.bitmap_construct_agg("at").alias("bits"))


def _maybe_known(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """The rows whose hash ``h`` is in the bitmap: all known ones, and a few others while the vocabulary is small against the bitmap."""
    at = F.pmod("h", F.lit(BITMAP_BITS)) + 1
    met = rows.withColumns({"bucket": F.bitmap_bucket_number(at), "at": F.bitmap_bit_position(at)}).join(F.broadcast(bitmap), "bucket")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return met.filter(F.expr("1 << cast(at % 8 as int)").bitwiseAND(byte) != 0).select(*rows.columns)


def word_breaks(vocab: DataFrame, words: DataFrame, max_changes: int = 1, min_break_length: int = 1,
                min_suggestion_freq: int = 1) -> DataFrame:
    """Word-break suggestions with up to ``max_changes`` breaks (C13): all ways to cut a word into vocabulary terms.

    One turn per break: the rest of each word is cut once more and the left part must be a term, so the rows of a turn are
    only prefixes that the vocabulary confirms. A broadcast bitmap of the terms' hashes, of fixed size, leaves out most parts that
    are no term before the shuffle. What travels is the word, the places of its cuts and a hash of the part; the term that
    meets the hash is then compared with the part itself. Output ``word, parts, changes, freq`` (smallest df of the parts)."""
    terms = vocab.filter(F.col("df") >= min_suggestion_freq).select("term", "df", F.xxhash64("term").alias("h"))
    bitmap = written(_hash_bitmap(terms), "break-bitmap")
    part = lambda a, z: F.substring("word", a + 1, z - a)
    n, last = F.length("word"), F.coalesce(F.try_element_at("cuts", F.lit(-1)), F.lit(0))
    state = words.select("word", F.array().cast("array<int>").alias("cuts"), F.lit(None).cast("long").alias("freq")).distinct()
    out = None
    for changes in range(1, max_changes + 1):
        at = F.sequence(last + min_break_length, n - min_break_length)
        cut = state.filter(n - last >= 2 * min_break_length).withColumn("i", F.explode(at))
        cut = cut.withColumn("h", F.xxhash64(part(last, F.col("i"))))
        state = _maybe_known(cut, bitmap).join(terms, "h").filter(F.col("term") == part(last, F.col("i"))).select(
            "word", F.array_append("cuts", F.col("i")).alias("cuts"), F.least("freq", "df").alias("freq"))
        done = _maybe_known(state.withColumn("h", F.xxhash64(part(last, n))), bitmap).join(terms, "h").filter(F.col("term") == part(last, n)).select(
            "word", "cuts", F.lit(changes).alias("changes"), F.least("freq", "df").alias("freq"))
        out = done if out is None else out.unionByName(done)
    ends = F.concat(F.array(F.lit(0)), "cuts", F.array(n))
    parts = F.transform(F.sequence(F.lit(0), F.size("cuts")), lambda k: part(F.get(ends, k), F.get(ends, k + 1)))
    return out.select("word", parts.alias("parts"), "changes", "freq")


def word_combine_suggest(vocab: DataFrame, pairs: DataFrame) -> DataFrame:
    """Combine suggestions (C13): adjacent words whose concatenation is a vocabulary term."""
    c = pairs.select("w1", "w2", F.concat("w1", "w2").alias("term"))
    return c.join(vocab.select("term", F.col("df").alias("freq")), "term")


def merge_suggestions(lists: list[DataFrame]) -> DataFrame:
    """Merge several checkers' suggestions (C14): union, keep each suggestion's best rank,
    interleave by rank then checker order."""
    tagged = None
    for i, s in enumerate(lists):
        t = s.select("word", "suggestion", "rank", F.lit(i).alias("_src"))
        tagged = t if tagged is None else tagged.unionByName(t)
    best = tagged.groupBy("word", "suggestion").agg(F.min(F.struct("rank", "_src")).alias("_b"))
    win = Window.partitionBy("word").orderBy(F.col("_b.rank"), F.col("_b._src"), F.col("suggestion"))
    return best.withColumn("rank", F.row_number().over(win)).select("word", "suggestion", "rank")


def collate(suggestions: DataFrame, query_words: list[str], per_word: int = 3, max_collations: int = 1,
            hits_index: Index | None = None) -> DataFrame:
    """Rewrite the whole query from the best corrections (C15): the cartesian product of each word's
    top ``per_word`` options (the word itself included) is bounded by per_word^len(words);
    collations rank by the sum of option ranks. With ``hits_index``, only collations whose
    words all occur together in some doc are kept: one exploded (collation, word) list meets the postings on the
    term, and one aggregate counts the words per collation and document."""
    spark = suggestions.sparkSession
    suggestions = written(suggestions.filter(F.col("word").isin(query_words) & (F.col("rank") <= per_word)), "options")
    opts = None
    for pos, wd in enumerate(query_words):
        own = spark.createDataFrame([(wd, 0)], "option string, rank int")
        s = suggestions.filter(F.col("word") == wd).filter(F.col("rank") <= per_word) \
            .select(F.col("suggestion").alias("option"), F.col("rank").cast("int"))
        o = own.unionByName(s).select(F.col("option").alias(f"w{pos}"), F.col("rank").alias(f"r{pos}"))
        opts = o if opts is None else opts.crossJoin(o)  # bounded: ≤ (per_word+1) rows per side
    total = sum(F.col(f"r{i}") for i in range(len(query_words)))
    coll = opts.withColumn("collation", F.concat_ws(" ", *[F.col(f"w{i}") for i in range(len(query_words))])) \
        .withColumn("total_rank", total).filter(F.col("total_rank") > 0)
    if hits_index is not None:
        words = F.array_distinct(F.array(*[F.col(f"w{i}") for i in range(len(query_words))]))
        asked = coll.select("collation", F.size(words).alias("need"), F.explode(words).alias("term"))
        found = (hits_index.postings.select("term", "doc_id").join(asked, "term")
                 .groupBy("collation", "doc_id").agg(F.count(F.lit(1)).alias("have"), F.first("need").alias("need"))
                 .filter("have = need").select("collation").distinct())
        coll = coll.join(found, "collation", "left_semi")
    return coll.select("collation", "total_rank").orderBy("total_rank", "collation").limit(max_collations)


def query_words(df: DataFrame, col: str) -> DataFrame:
    """Words to spell-check from raw query strings (C19): drop operators (AND/OR/NOT, +, -),
    field prefixes (``f:``), boosts (``^2``), fuzzy/proximity suffixes (``~1``) and quotes.
    Output: input key columns + ``pos, word``."""
    q = F.regexp_replace(F.col(col), r"\b\w+:", " ")
    q = F.regexp_replace(q, r"[\^~][0-9.]*", " ")
    q = F.regexp_replace(q, r"\b(AND|OR|NOT)\b", " ")
    toks = F.regexp_extract_all(F.lower(q), F.lit(DEFAULT_PATTERN), 0)
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode(toks).alias("pos", "word"))


# ------------------------------------------------------------------ suggesters

def suggest_prefix(vocab: DataFrame, prefix: str, n: int = 10, threshold: int = 0) -> DataFrame:
    """Prefix completions weighted by frequency (C16): ``term, weight, rank``."""
    c = vocab.filter(F.col("term").startswith(prefix)).filter(F.col("df") >= threshold) \
        .select("term", F.col("df").alias("weight"))
    order = [F.col("weight").desc(), F.col("term").asc()]
    from searchlake.operators.util import rank_small
    return rank_small(c.orderBy(*order).limit(n), order)


def suggest_fuzzy(vocab: DataFrame, prefix: str, n: int = 10, max_edits: int = 1, exact_prefix: int = 1) -> DataFrame:
    """Fuzzy prefix completion (C17): terms whose first len(prefix) chars are within ``max_edits``
    of the prefix (first ``exact_prefix`` chars exact), ranked by weight."""
    L = len(prefix)
    c = vocab.filter(F.col("term").startswith(prefix[:exact_prefix])) \
        .withColumn("_d", F.levenshtein(F.left(F.col("term"), F.lit(L)), F.lit(prefix), max_edits)) \
        .filter(F.col("_d").between(0, max_edits)).select("term", F.col("df").alias("weight"))
    order = [F.col("weight").desc(), F.col("term").asc()]
    from searchlake.operators.util import rank_small
    return rank_small(c.orderBy(*order).limit(n), order)


# ------------------------------------------------------------------ highlighting

def token_offsets(docs: DataFrame, id_col: str, text_col: str, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """Tokens with character offsets for the given (already bounded) docs: ``doc_id, pos, term, start, end``.

    Separators between tokens come from ``split`` on the token pattern; a token's start is the
    running length of everything before it (window per doc; only hit docs are passed in)."""
    low = F.lower(F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.regexp_extract_all(low, F.lit(pattern), 0).alias("_t"),
                       F.split(low, pattern).alias("_s"))
    base = base.select("doc_id", "_t", F.slice("_s", 1, F.size("_t")).alias("_s"))
    z = base.select("doc_id", F.posexplode(F.arrays_zip("_t", "_s")).alias("pos", "z"))
    z = z.select("doc_id", "pos", F.col("z._t").alias("term"),
                 (F.length(F.col("z._t")) + F.length(F.col("z._s"))).alias("_w"), F.length("z._s").alias("_sep"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    z = z.withColumn("_before", F.coalesce(F.sum("_w").over(w), F.lit(0)))
    return z.select("doc_id", "pos", "term", (F.col("_before") + F.col("_sep")).alias("start"),
                    (F.col("_before") + F.col("_sep") + F.length("term")).alias("end"))


def highlight(hits: DataFrame, docs: DataFrame, id_col: str, text_col: str, terms: list[str],
              fragsize: int = 100, snippets: int = 1, pre: str = "<em>", post: str = "</em>",
              merge_contiguous: bool = False, encode: bool = False) -> DataFrame:
    """Gap-fragment highlighting (C02/C06): a fragment holds the tokens that start in one window of ``fragsize``
    characters, whole, from the first token's start to the last one's end; a fragment's score is the number of distinct query terms in it (plus 0.001 per extra hit);
    the best ``snippets`` fragments per doc (score desc, position asc) are returned with matches
    wrapped in ``pre``/``post``, HTML-escaped with ``encode``. Only hit docs are tokenized. Output ``doc_id, frag, score, snippet``."""
    d = docs.join(hits.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_semi")
    toks = token_offsets(d, id_col, text_col).withColumn("frag", F.floor(F.col("start") / fragsize).cast("long"))
    bounds = toks.groupBy("doc_id", "frag").agg(F.min("start").alias("_from"), F.max("end").alias("_to"))
    fr = toks.filter(F.col("term").isin(terms)).groupBy("doc_id", "frag").agg(
        (F.count_distinct("term") + F.lit(0.001) * (F.count(F.lit(1)) - F.count_distinct("term"))).alias("score"))
    win = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), F.col("frag").asc())
    best = fr.withColumn("_r", F.row_number().over(win)).filter(F.col("_r") <= snippets).drop("_r")
    txt = d.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    import re
    alt = "|".join(re.escape(t) for t in terms)
    snippet = F.substring(F.col("_text"), (F.col("_from") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int"))
    if encode:
        snippet = html_encode(snippet)
    marked = F.regexp_replace(snippet, f"(?iu)(?<![\\pL\\pN])({alt})(?![\\pL\\pN])", f"{pre}$1{post}")
    if merge_contiguous:
        marked = F.regexp_replace(marked, f"{post}(\\s*){pre}", "$1")
    best = best.join(bounds, ["doc_id", "frag"])
    return best.join(txt, "doc_id").select("doc_id", "frag", "score", marked.alias("snippet"))


def highlight_passages(hits: DataFrame, docs: DataFrame, id_col: str, text_col: str, terms: list[str],
                       snippets: int = 1, k1: float = 1.2, b: float = 0.75, pivot: float = 87.0) -> DataFrame:
    """Passage highlighting (C05): sentences scored with BM25 over the query terms (length
    normalised around ``pivot`` characters), best ``snippets`` per doc."""
    d = docs.join(hits.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_semi")
    sents = d.select(F.col(id_col).alias("doc_id"),
                     F.posexplode(F.split(F.col(text_col), r"(?<=[.!?])\s+|\n+")).alias("sent_no", "sentence"))
    toks = sents.select("doc_id", "sent_no", "sentence",
                        F.explode(F.regexp_extract_all(F.lower("sentence"), F.lit(DEFAULT_PATTERN), 0)).alias("term")) \
        .filter(F.col("term").isin(terms))
    tf = toks.groupBy("doc_id", "sent_no", "sentence", "term").agg(F.count(F.lit(1)).alias("tf"))
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.length("sentence") / F.lit(pivot))
    s = tf.groupBy("doc_id", "sent_no", "sentence").agg(
        F.sum(F.col("tf") * (k1 + 1) / (F.col("tf") + norm)).alias("score"))
    win = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), F.col("sent_no").asc())
    return s.withColumn("_r", F.row_number().over(win)).filter(F.col("_r") <= snippets).drop("_r")


def html_encode(c: Column) -> Column:
    """HTML-escape snippet text."""
    x = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for k, v in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(k), F.lit(v))
    return x
