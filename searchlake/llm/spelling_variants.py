r"""Operator 11, spelling variant grouping by permuterm rotations.

Words that differ by one inserted, deleted or replaced code point are near; a word's form is its near word of largest count (ties:
the smallest word) if that count is at least ``RATIO`` times its own, and its root the end of the chain of forms.

1. ``word_counts``: runs of letters of whole texts, counted by Spark's aggregation (combined before the shuffle).
2. A word ``w`` and its terminator are rotated at every place: ``w = a b`` gives the full rotation ``b$a``. Of the rotation
   that ends with a character ``c`` of ``w = a c b``, namely ``b$ac``, the prefix ``b$a`` skips the edited character.
   Sorting by the prefix brings together all words that differ from each other in that place: those with
   another character there (a replacement) and the one without any (whose full rotation is the prefix: an insertion or deletion).
3. Each group of one prefix is scanned once; every member learns how many near words it has there and the best of them, so no pairs
   are made. The prefix tells ``a`` and ``b``, so a group has at most one word per character of the alphabet, and one.
4. Counts and best near words are combined per word. Two words of different length may meet in several groups, where the
   longer has the character twice or more in a row: only the last place of the row counts.
5. Roots by pointer doubling; a form has at least twice the count, so log2 of log2 of the largest count bounds the rounds.

Defined results: null texts have no words; a null id counts as the empty string; repeated rows count each; ties go to the smaller
word in code-point order; an empty table gives an empty result; extra columns are ignored; texts are whole. Code points outside
the Basic Multilingual Plane cannot occur with the given runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Given rule of the query: every 97th (document, word), by checksum, has lost a code point.
SLIP = 97
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
END = "$"


def slipped(doc_id: Column, run: Column) -> Column:
    """The run without the code point h % length where the checksum h of ``<doc_id>:<run>`` is a multiple of SLIP."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, change=slipped) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(text_or_empty(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    lower = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    return (lower.select(word.alias("word")).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """words(word, n) -> prefix, word, n, full (nothing is skipped), last (the skipped character ends a row of equal ones)."""
    def at(i):
        before, behind = F.substring("word", F.lit(1), i), F.substring("word", i + 1, F.char_length("word"))
        c, after = F.substring(behind, F.lit(1), F.lit(1)), F.substring(behind, F.lit(2), F.char_length("word"))
        return F.array(
            F.struct(F.concat(behind, F.lit(END), before).alias("prefix"), F.lit(True).alias("full"), F.lit(False).alias("last")),
            F.struct(F.concat(after, F.lit(END), before).alias("prefix"), F.lit(False).alias("full"),
                     (c != F.substring(after, F.lit(1), F.lit(1))).alias("last")))

    places = F.flatten(F.transform(F.sequence(F.lit(0), F.char_length("word")), at))
    # the full rotation behind the last character exists, but nothing is skipped there
    places = F.slice(places, 1, F.size(places) - 1)
    return words.select("word", "n", F.explode(places).alias("r")).select("word", "n", "r.*")


def near_words(words: DataFrame) -> DataFrame:
    """words(word, n) -> word, n_near, best (struct of -n and word) for words that have a near word."""
    member = F.struct((-F.col("n")).alias("minus"), "word", "full", "last")
    group = F.array_sort(F.collect_list(member)).alias("g")
    groups = rotations(words).groupBy("prefix").agg(group).where(F.size("g") > 1).where(F.exists("g", lambda m: ~m["full"]))
    skipping = F.size(F.filter("g", lambda m: ~m["full"]))
    counted = groups.select("g", skipping.alias("skipping"), F.size(F.filter("g", lambda m: m["last"])).alias("lasts"))
    has_full = (F.size("g") > F.col("skipping")).cast("int")
    told = F.transform("g", lambda m, i: F.struct(
        m["word"].alias("word"),
        F.when(m["full"], F.col("lasts")).otherwise(F.col("skipping") - 1 + F.when(m["last"], has_full).otherwise(0)).alias("near"),
        F.when(i == 0, F.col("g")[1]).otherwise(F.col("g")[0]).alias("other")))
    return (counted.select(F.explode(told).alias("m"))
            .select("m.word", "m.near", F.struct("m.other.minus", "m.other.word").alias("other"))
            .groupBy("word").agg(F.sum("near").alias("n_near"), F.min("other").alias("best")))


def with_roots(forms: DataFrame, largest: int, ratio: int) -> DataFrame:
    """forms(word, form, ...) -> the same and root, by pointer doubling over the words that have a form."""
    jumps = forms.where("form is not null").select("word", F.col("form").alias("root"))
    steps = 1
    longest = 0  # a chain's counts grow by ratio with every step
    while ratio ** longest <= max(1, largest):
        longest += 1
    while steps < longest:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = stage(jumps.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"),
                                                               F.col("ahead").isNotNull().alias("moved")), "op11-jumps")
        if moved.where("moved").isEmpty():
            break
        jumps = moved.select("word", "root")
        steps *= 2
    return forms.join(jumps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """words(word, n), each word once -> word, form, root, n, n_near, form_n."""
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "op11-words")
    near = near_words(words)
    best_n = -F.col("best.minus")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best_n >= ratio * F.col("n"), F.struct(F.col("best.word").alias("form"), best_n.alias("form_n"))).alias("b"))
    forms = stage(found.select("word", "n", "n_near", "b.form", "b.form_n"), "op11-forms")
    largest = words.agg(F.max("n")).first()[0] or 0
    return with_roots(forms, largest, ratio).select("word", "form", "root", "n", "n_near", "form_n")
