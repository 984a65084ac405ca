"""Dictionary jobs over the distinct vocabulary (T41, T42, T43): suffix stripping, compound segmentation, character readings.

All of them take the terms as rows (never the tokens) and dictionaries as tables of the caller; candidates meet the tables by
equality. A term of n characters gives n splits (T41) or at most n times ``longest`` parts (T42), so rows grow with the vocabulary, not
with the square of it; no term meets another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators.components import _hash_bitmap, _maybe_known
from searchlake.operators.util import bounded_broadcast, written


def _distinct_terms(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.select("term").filter(F.col("term").isNotNull() & (F.col("term") != "")).distinct()


# ------------------------------------------------------------------ T41

def strip_suffixes(vocabulary: DataFrame, stems: DataFrame, suffixes: DataFrame, min_stem: int = 1, kinds: bool = False,
                   empty_suffix: bool = True) -> DataFrame:
    """``term, stem, suffix[, kind]``: each term's split into a dictionary stem and a suffix of the table.

    ``stems``: ``stem`` (and ``kind``), ``suffixes``: ``suffix`` (and ``kind``); with ``kinds`` both must be of one kind (nouns take
    particles, verbs take endings). Of several splits the one with the longest suffix wins, then the smallest kind; a term that is itself
    a stem is one with the empty suffix (unless ``empty_suffix`` is off). Terms without a split are left out. Suffixes
    are tried first, because there are few of them.
    """
    terms = _distinct_terms(vocabulary)
    at = F.explode(F.sequence(F.lit(min_stem), F.length("term")))
    splits = terms.filter(F.length("term") >= min_stem).select("term", at.alias("at")).select(
        "term", F.substring("term", F.lit(1), F.col("at")).alias("stem"),
        F.substring(F.col("term"), F.col("at") + 1, F.length("term")).alias("suffix"))
    keys = ["kind"] if kinds else []
    known = suffixes.select("suffix", *keys).distinct()
    if empty_suffix:
        empty = (stems.select("kind").distinct() if kinds else stems.sparkSession.range(1)).select(F.lit("").alias("suffix"), *keys)
        known = known.unionByName(empty).distinct()
    met = splits.join(bounded_broadcast(known), "suffix").join(stems.select("stem", *keys).distinct(), ["stem", *keys])
    best = F.min(F.struct((-F.length("suffix")).alias("n"), *keys, "stem", "suffix"))
    chosen = met.groupBy("term").agg(best.alias("b"))
    return chosen.select("term", "b.stem", "b.suffix", *[f"b.{k}" for k in keys])


# ------------------------------------------------------------------ T42

#: Terms in one part: the places inside of them are gathered in the memory of one task.
TERMS_A_PART = 20_000


def _dealt_terms(vocabulary: DataFrame) -> DataFrame:
    """The distinct terms dealt by term into parts of a bounded number of them, which adaptive execution does not merge."""
    parts = max(vocabulary.sparkSession.sparkContext.defaultParallelism, -(-vocabulary.count() // TERMS_A_PART))
    return _distinct_terms(vocabulary.repartition(parts, "term"))


def _cuts(terms: DataFrame, shortest: int, longest: int, whole: bool) -> DataFrame:
    """``term, start, end, part``: all substrings of ``shortest`` to ``longest`` characters; the term itself counts only with ``whole``."""
    terms = terms.withColumn("n", F.length("term"))
    starts = terms.filter(F.col("n") >= shortest).select("term", "n", F.explode(F.sequence(F.lit(0), F.col("n") - shortest)).alias("start"))
    sizes = F.explode(F.sequence(F.lit(shortest), F.least(F.lit(longest), F.col("n") - F.col("start"))))
    cut = starts.select("term", "n", "start", sizes.alias("size"))
    if not whole:
        cut = cut.filter(F.col("size") < F.col("n"))
    part = F.substring(F.col("term"), F.col("start") + 1, F.col("size")).alias("part")
    return cut.select("term", "start", (F.col("start") + F.col("size")).alias("end"), part)


def _words(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.col("term").alias("part")).filter("part is not null").distinct()


def _part_hashes() -> list[Column]:
    return [F.xxhash64("part"), F.xxhash64("part", F.lit(1))]


def _word_bitmap(words: DataFrame) -> DataFrame:
    return written(_hash_bitmap(words.select(F.explode(F.array(*_part_hashes())).alias("h"))), "compound-bitmap")


def _maybe_words(cut: DataFrame, bitmap: DataFrame) -> DataFrame:
    """The cuts whose part is in the bitmap under both hashes: all words, and few others."""
    for h in _part_hashes():
        cut = _maybe_known(cut.withColumn("h", h), bitmap).drop("h")
    return cut


def parts_of_terms(vocabulary: DataFrame, dictionary: DataFrame, shortest: int = 2, longest: int = 20, whole: bool = False) -> DataFrame:
    """``term, start, end``: the places of dictionary words inside the terms; the term itself counts only with ``whole``.

    A bitmap of fixed size leaves out most parts that are no word before the shuffle."""
    words = _words(dictionary)
    maybe = _maybe_words(_cuts(_dealt_terms(vocabulary), shortest, longest, whole), _word_bitmap(words))
    return maybe.join(words, "part", "left_semi").select("term", "start", "end")


def _shortest_path(n: Column, places: Column) -> Column:
    """Sizes of the fewest places that lead from 0 to n; of several the longer first part, and so on; null if there is none.

    From the end backwards: ``best[0]`` belongs to the place after the current one; each is the least struct of the number of parts
    and the negative sizes.
    """
    none = F.lit(None).cast("struct<n:int,back:array<int>>")
    end = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("back"))

    def step(best: Column, i: Column) -> Column:
        def through(p: Column) -> Column:
            rest = F.get(best, p["end"] - i - 1)
            return F.when(rest.isNotNull(), F.struct(
                (rest["n"] + 1).alias("n"), F.concat(F.array(i - p["end"]), rest["back"]).alias("back")))
        here = F.filter(places, lambda p: p["start"] == i)
        return F.concat(F.array(F.coalesce(F.array_min(F.transform(here, through)), none)), best)

    found = F.get(F.aggregate(F.sequence(n - 1, F.lit(0), F.lit(-1)), F.array(end), step), F.lit(0))
    return F.transform(found["back"], lambda b: -b)


def _paths(places: DataFrame) -> DataFrame:
    """``term, sizes`` of the terms that places ``term, start, end`` cover."""
    held = places.groupBy("term").agg(F.collect_list(F.struct("start", "end")).alias("places"))
    # a term without a place at its start or its end has no path
    n = F.length("term")
    held = held.filter(F.exists("places", lambda p: p["start"] == 0)).filter(F.exists("places", lambda p: p["end"] == n))
    return held.select("term", _shortest_path(n, F.col("places")).alias("sizes")).filter("sizes is not null")


def _path_parts() -> Column:
    begin = lambda i: F.aggregate(F.slice("sizes", 1, i), F.lit(0), lambda s, x: s + x)
    return F.transform("sizes", lambda s, i: F.substring(F.col("term"), begin(i) + 1, s))


def segment_compounds(vocabulary: DataFrame, dictionary: DataFrame, shortest: int = 2, longest: int = 20, whole: bool = False) -> DataFrame:
    """``term, parts, n_parts``: terms as the fewest dictionary words one after another.

    Of several segmentations with as few parts the one with the longer first part wins, then the longer second one, and so on.
    Terms that cannot be covered are left out. A shortest path over the split points, per term over its own places only
    (at most its length times ``longest``).

    Paths are first sought among the parts that a bitmap of the dictionary lets through, which holds every word: no place travels. A path
    of words only is then also the best one among the words; only the parts of the paths meet the dictionary, and a term whose path has
    another part in it is done again with the words alone.
    """
    words = written(_words(dictionary), "compound-words")
    terms = _dealt_terms(vocabulary)
    paths = written(_paths(_maybe_words(_cuts(terms, shortest, longest, whole), _word_bitmap(words))), "compound-paths")
    used = paths.select("term", F.explode(_path_parts()).alias("part"))
    wrong = written(used.join(words, "part", "left_anti").select("term").distinct(), "compound-wrong")
    again = _paths(parts_of_terms(wrong, words.select(F.col("part").alias("term")), shortest, longest, whole))
    sized = paths.join(bounded_broadcast(wrong), "term", "left_anti").unionByName(again)
    return sized.select("term", _path_parts().alias("parts"), F.size("sizes").alias("n_parts"))


# ------------------------------------------------------------------ T43

def character_readings(vocabulary: DataFrame, readings: DataFrame) -> DataFrame:
    """``term, reading``: every character that the table ``char, reading`` knows is replaced by its reading.

    A map from Han characters to their Hangul readings is such a table; of several readings of a character the smallest counts. Terms
    without a known character are left out.
    """
    table = readings.groupBy("char").agg(F.min("reading").alias("reading"))
    chars = _distinct_terms(vocabulary).select("term", F.posexplode(F.split("term", "")).alias("i", "char"))
    met = chars.join(bounded_broadcast(table), "char", "left")
    each = F.sort_array(F.collect_list(F.struct("i", F.coalesce("reading", "char").alias("c"))))
    read = met.groupBy("term").agg(each.alias("cs"), F.count("reading").alias("known")).filter("known > 0")
    return read.select("term", F.array_join(F.transform("cs", lambda c: c["c"]), "").alias("reading"))
