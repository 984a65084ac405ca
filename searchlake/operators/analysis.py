"""Text analysis as whole-table jobs.

A chain turns a text column into per-document token *arrays* with JVM higher-order
functions (``regexp_extract_all``, ``transform``, ``filter``): a document's tokens never leave
its row until the final ``posexplode``, so tokenizing needs no shuffle. A removed token is
set to NULL inside the array, which keeps the position hole that phrase matching relies on
(stop words, T14). Steps that depend only on the term string and need Python (stemmers) run
once per *distinct* term (a vocabulary job) and are joined back.

Token table schema: ``doc_id, pos, term`` (+ ``field``, ``type`` where a step adds them).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators.util import bounded_broadcast

# Words are runs of letters and digits of any script; Java and RE2 read the pattern alike.
DEFAULT_PATTERN = r"[\pL\pN]+"
UNICODE_WORD = DEFAULT_PATTERN

Step = Callable[[Column], Column]


# ------------------------------------------------------------------ tokenizers (text → array)

def pattern_tokenizer(pattern: str = DEFAULT_PATTERN, group: int = 0, lower: bool = True) -> Step:
    """Tokens = matches of ``pattern`` (T08 group mode; T03 letter, T05 standard approximations)."""
    def tok(text: Column) -> Column:
        t = F.lower(text) if lower else text
        return F.regexp_extract_all(t, F.lit(pattern), group)
    return tok


def split_tokenizer(pattern: str = r"\s+") -> Step:
    """Tokens = pieces between matches of ``pattern`` (T02 whitespace, T08 split mode); empties dropped."""
    def tok(text: Column) -> Column:
        return F.filter(F.split(text, pattern), lambda x: x != "")
    return tok


def keyword_tokenizer() -> Step:
    """Whole value as one token."""
    return lambda text: F.array(text)


def letter_tokenizer(lower: bool = False) -> Step:
    """Runs of letters (T03); ``lower=True`` is the lower-case tokenizer."""
    return pattern_tokenizer(r"\p{L}+", 0, lower)


def standard_tokenizer(max_token_length: int = 255) -> Step:
    """Word-break approximation (T05): letter/digit runs with inner apostrophes, dots in numbers."""
    pat = r"[\p{L}\p{Nd}]+(?:['’.][\p{L}\p{Nd}]+)*"
    def tok(text: Column) -> Column:
        arr = F.regexp_extract_all(text, F.lit(pat), 0)
        return F.filter(arr, lambda x: F.length(x) <= max_token_length)
    return tok


# Token classes of the classic / URL-email tokenizers, as regex alternatives.
_URL = r"(?:https?|ftp)://[^\s<>\"']+"
_EMAIL = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"
_HOST = r"(?:[\p{L}\p{Nd}-]+\.)+[\p{L}]{2,}"
_ACRONYM = r"(?:\p{L}\.){2,}"
_NUM = r"\p{Nd}+(?:[.,\-/]\p{Nd}+)*"
_WORD = r"[\p{L}\p{Nd}]+(?:'[\p{L}]+)*"


def classic_tokenizer() -> Step:
    """Classic tokenizer + classic filter (T06): emails, hosts, acronyms (dots removed),
    numbers, words with ``'s`` stripped."""
    pat = "|".join([_EMAIL, _HOST, _ACRONYM, _NUM, _WORD])
    def tok(text: Column) -> Column:
        arr = F.regexp_extract_all(text, F.lit(pat), 0)
        return F.transform(arr, lambda t: F.when(t.rlike(f"^{_ACRONYM}$"), F.regexp_replace(t, r"\.", ""))
                           .otherwise(F.regexp_replace(t, "'[sS]$", "")))
    return tok


def url_email_tokenizer() -> Step:
    """URLs and e-mail addresses kept whole, other text split into words."""
    pat = "|".join([_URL, _EMAIL, _WORD])
    return lambda text: F.regexp_extract_all(text, F.lit(pat), 0)


def token_types(tokens: Column) -> Column:
    """Type tag per token: ``<URL> <EMAIL> <HOST> <ACRONYM> <NUM> <ALPHANUM>``."""
    return F.transform(tokens, lambda t: F.when(t.rlike(f"^{_URL}$"), "<URL>")
                       .when(t.rlike(f"^{_EMAIL}$"), "<EMAIL>")
                       .when(t.rlike(f"^{_HOST}$"), "<HOST>")
                       .when(t.rlike(r"^\p{Nd}[\p{Nd}.,\-/]*$"), "<NUM>")
                       .otherwise("<ALPHANUM>"))


def path_hierarchy(delimiter: str = "/", replacement: str | None = None, skip: int = 0,
                   reverse: bool = False) -> Step:
    """Path prefixes ``/a``, ``/a/b``, ``/a/b/c`` (or suffixes when ``reverse``)."""
    rep = replacement if replacement is not None else delimiter
    def tok(text: Column) -> Column:
        parts = F.split(text, F.lit(_re_escape(delimiter)))
        n = F.size(parts)
        none = F.array().cast("array<string>")
        if not reverse:
            paths = F.transform(F.sequence(F.lit(skip + 1), n),
                                lambda i: F.array_join(F.slice(parts, skip + 1, i - skip), rep))
        else:
            paths = F.transform(F.sequence(F.lit(1), n - skip),
                                lambda i: F.array_join(F.slice(parts, i, n - skip - i + 1), rep))
        return F.when(n > skip, F.filter(paths, lambda p: p != "")).otherwise(none)  # "/a" has no empty first path
    return tok


def ngram_tokenizer(min_gram: int = 1, max_gram: int = 2) -> Step:
    """All character n-grams of the whole text, shorter first at each start."""
    def tok(text: Column) -> Column:
        return _grams(text, min_gram, max_gram)
    return tok


def _grams(text: Column, min_gram: int, max_gram: int) -> Column:
    """All substrings of the given lengths; a text shorter than a gram has none of that length."""
    none = F.array().cast("array<string>")
    n = F.length(text)

    def of_length(g: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(n - g + 1, F.lit(1)))
        # the text is cut into characters once (a variable of the outer function): a substring would walk the text for every gram
        found = F.transform(F.array(F.split(text, "")), lambda cs: F.transform(starts, lambda i: F.array_join(F.slice(cs, i, g), "")))
        return F.when(n >= g, F.get(found, F.lit(0))).otherwise(none)

    return F.flatten(F.array(*[of_length(g) for g in range(min_gram, max_gram + 1)]))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


# ------------------------------------------------------------------ token filters (array → array)

def lowercase() -> Step:
    """T13."""
    return lambda a: F.transform(a, lambda t: F.lower(t))


def turkish_lowercase() -> Step:
    """Turkish rule (T13): dotted capital I → i, plain I → dotless ı, then lower-case."""
    return lambda a: F.transform(a, lambda t: F.lower(F.translate(t, "İI", "iı")))


# A common English stop-word list (the usual default analyzer set).
ENGLISH_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
]


def stop_filter(words: Sequence[str] = ENGLISH_STOP_WORDS, ignore_case: bool = False) -> Step:
    """Remove stop words but keep their position holes (T14). Literal ``isin`` becomes a hash set."""
    ws = [w.lower() for w in words] if ignore_case else list(words)
    def step(a: Column) -> Column:
        return F.transform(a, lambda t: F.when(~(F.lower(t) if ignore_case else t).isin(ws), t))
    return step


def keep_words(words: Sequence[str], ignore_case: bool = False) -> Step:
    """Keep only listed words."""
    ws = [w.lower() for w in words] if ignore_case else list(words)
    return lambda a: F.transform(a, lambda t: F.when((F.lower(t) if ignore_case else t).isin(ws), t))


def length_filter(min_len: int = 0, max_len: int = 255) -> Step:
    """Keep tokens whose length (code points) is within bounds."""
    return lambda a: F.transform(a, lambda t: F.when(F.length(t).between(min_len, max_len), t))


def limit_token_count(n: int) -> Step:
    """Only the first ``n`` tokens."""
    return lambda a: F.slice(a, 1, n)


def trim_filter() -> Step:
    return lambda a: F.transform(a, lambda t: F.trim(t))


def reverse_filter() -> Step:
    """T24."""
    return lambda a: F.transform(a, lambda t: F.reverse(t))


def pattern_replace(pattern: str, replacement: str) -> Step:
    """Regex replace inside each token (T21); tokens that become empty are removed."""
    return lambda a: F.transform(a, lambda t: F.nullif(F.regexp_replace(t, pattern, replacement), F.lit("")))


# Elision articles (French default set).
ELISION_ARTICLES = ["l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu"]


def elision(articles: Sequence[str] = ELISION_ARTICLES) -> Step:
    """Strip a leading article + apostrophe such as ``l'``."""
    alt = "|".join(sorted(articles, key=len, reverse=True))
    return lambda a: F.transform(a, lambda t: F.regexp_replace(t, f"(?i)^(?:{alt})['’]", ""))


def english_possessive() -> Step:
    """Strip a trailing ``'s``."""
    return lambda a: F.transform(a, lambda t: F.regexp_replace(t, "['’][sS]$", ""))


def ascii_folding() -> Step:
    """Remove diacritics (T19): Unicode NFD-style folding of Latin letters via ``translate``.

    Covers every character of the basic plane whose compatibility decomposition, without combining marks, is one
    ASCII letter or digit (built from that rule with ``unicodedata``), stroked letters and the ligatures."""
    src, dst = _folding_table()
    def step(a: Column) -> Column:
        return F.transform(a, lambda t: _ligatures(F.translate(t, src, dst)))
    return step


def _ligatures(t: Column) -> Column:
    # Ligature expansions.
    for k, v in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ĳ", "ij"), ("Ĳ", "IJ"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"),
                 ("þ", "th"), ("Þ", "TH"), ("ẞ", "SS")):
        t = F.replace(t, F.lit(k), F.lit(v))
    return t


def _folding_table() -> tuple[str, str]:
    import unicodedata

    src, dst = [], []
    for cp in range(0x80, 0x10000):  # accented, full-width, superscript and enclosed forms of one character
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base.isalnum():
            src.append(ch)
            dst.append(base)
    # Letters with strokes that have no decomposition.
    for k, v in (("ø", "o"), ("Ø", "O"), ("đ", "d"), ("Đ", "D"), ("ł", "l"), ("Ł", "L"), ("ħ", "h"), ("Ħ", "H"), ("ð", "d"), ("Ð", "D"), ("ŧ", "t"), ("Ŧ", "T"), ("ı", "i")):
        src.append(k)
        dst.append(v)
    return "".join(src), "".join(dst)


def german_normalization() -> Step:
    """German normalization (T37): ä→a, ö→o, ü→u, ß→ss; ae and oe → a and o; ue → u unless a vowel or q
    stands before it."""
    def step(a: Column) -> Column:
        return F.transform(a, lambda t: F.replace(
            F.translate(F.regexp_replace(F.regexp_replace(t, "([ao])e", "$1"), "(?<![aeiouyqäöü])ue", "u"), "äöü", "aou"),
            F.lit("ß"), F.lit("ss")))
    return step


def scandinavian_folding() -> Step:
    """Scandinavian folding (T37): å, ä, æ → a; ö, ø, œ → o; aa/ao/ae/oe/oo → a/a/a/o/o."""
    def step(a: Column) -> Column:
        return F.transform(a, lambda t: F.translate(
            F.regexp_replace(F.regexp_replace(t, "(?i)a[aoeå]", "a"), "(?i)o[eo]", "o"),
            "åäæÅÄÆöøœÖØŒ", "aaaAAAooOOOO"))
    return step


def capitalization(keep: Sequence[str] = ()) -> Step:
    """First letter upper, rest lower, unless the word is in ``keep``."""
    ks = list(keep)
    return lambda a: F.transform(a, lambda t: F.when(F.lower(t).isin([k.lower() for k in ks]), t)
                                 .otherwise(F.initcap(t)) if ks else F.initcap(t))


def edge_ngrams(min_gram: int = 1, max_gram: int = 2, side: str = "front") -> Callable[[Column], Column]:
    """Edge n-grams of each token (T11) — returns array of arrays (grams per position)."""
    def step(a: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.transform(a, lambda t: F.when(F.length(t) >= min_gram, F.transform(
            F.sequence(F.lit(min_gram), F.greatest(F.lit(min_gram), F.least(F.lit(max_gram), F.length(t)))),
            lambda g: F.left(t, g) if side == "front" else F.right(t, g))).otherwise(none))
    return step


def ngrams_of_tokens(min_gram: int = 1, max_gram: int = 2) -> Callable[[Column], Column]:
    """Character n-grams of each token (T10 filter) — array of arrays (grams per position)."""
    def step(a: Column) -> Column:
        return F.transform(a, lambda t: _grams(t, min_gram, max_gram))
    return step


def shingles(min_size: int = 2, max_size: int = 2, sep: str = " ", unigrams: bool = True,
             filler: str = "_") -> Callable[[Column], Column]:
    """Word n-grams starting at each position (T31); holes (removed tokens) become ``filler``.
    Returns array of arrays: shingles per start position (unigram first when ``unigrams``).

    Each size is unrolled into ``element_at`` lookups, so the work is linear in the number of
    tokens — pass a column reference (a materialized token array), not a long expression."""
    def step(a: Column) -> Column:
        n = F.size(a)

        def at(t, i):
            grams = []
            for s in range(min_size, max_size + 1):
                parts = [F.coalesce(F.element_at(a, i + 1 + k), F.lit(filler)) for k in range(s)]
                grams.append(F.when(i + s <= n, F.concat_ws(sep, *parts)))
            first = [t] if unigrams else []
            return F.filter(F.array(*first, *grams), lambda x: x.isNotNull())
        return F.transform(a, at)
    return step


def type_filter(types: Sequence[str], keep: bool = True) -> Step:
    """Type filter (T16): keep (or drop) tokens whose ``token_types`` tag is listed; dropped tokens leave holes."""
    wanted = list(types)

    def step(a: Column) -> Column:
        def at(t, k):
            listed = k.isin(wanted)
            return F.when(listed if keep else ~listed, t)
        return F.zip_with(a, token_types(a), at)
    return step


def mapping_char_filter(rules: dict[str, str]) -> Step:
    """Mapping char filter (T20) on the text before the tokenizer: at every place the longest matching rule is applied, once,
    so the output of a rule is not mapped again. One alternation splits the text into matches and the rest."""
    import re
    keys = sorted(rules, key=len, reverse=True)
    if not keys:
        return lambda text: text
    one = "|".join(re.escape(k) for k in keys)
    table = [x for k in keys for x in (F.lit(k), F.lit(rules[k]))]

    def step(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(f"(?s){one}|."), 0)
        mapped = F.transform(pieces, lambda p: F.coalesce(F.element_at(F.create_map(*table), p), p))
        return F.when(text.rlike(one), F.array_join(mapped, "")).otherwise(text)
    return step


def pattern_replace_char_filter(pattern: str, replacement: str) -> Step:
    """Pattern-replace char filter (T21): on the text before the tokenizer."""
    return lambda text: F.regexp_replace(text, pattern, replacement)


def pattern_capture(patterns: Sequence[str], groups: int, preserve_original: bool = True) -> Callable[[Column], Column]:
    """Capture groups (T22): every non-empty group (1 to ``groups``) of every match of every pattern becomes a token at
    the position of the original, which stays first if preserved. Returns array of arrays per position."""
    def step(a: Column) -> Column:
        def at(t):
            found = [F.regexp_extract_all(t, F.lit(p), g) for p in patterns for g in range(1, groups + 1)]
            some = F.filter(F.flatten(F.array(*found)), lambda x: x != "")
            return F.array_distinct(F.concat(F.array(t), some) if preserve_original else F.when(F.size(some) > 0, some).otherwise(F.array(t)))
        return F.transform(a, at)
    return step


def hyphenated_words(text: Column) -> Column:
    """Hyphenated-words joiner (T27) for a white-space tokenizer: a token that ends with a hyphen is joined with the next
    one, without the hyphen; a hyphen at the very end stays. Applied to the text, where the two halves still touch."""
    return F.regexp_replace(text, r"(?<=\S)-\s+(?=\S)", "")


def scandinavian_normalization() -> Step:
    """Scandinavian normalization (T37): ä, æ-like digraphs and ö forms become å, æ, ø."""
    def step(a: Column) -> Column:
        def at(t):
            t = F.regexp_replace(F.regexp_replace(t, "aa|ao", "å"), "AA|Aa|AO|Ao", "Å")
            t = F.regexp_replace(F.regexp_replace(t, "ae", "æ"), "AE|Ae", "Æ")
            t = F.regexp_replace(F.regexp_replace(t, "oe|oo", "ø"), "OE|Oe|OO|Oo", "Ø")
            return F.translate(t, "äÄöÖ", "æÆøØ")
        return F.transform(a, at)
    return step


def arabic_normalization() -> Step:
    """Arabic letter normalization (T38): alef with hamza or madda → alef, dotless yeh → yeh, teh marbuta → heh; the
    stretching mark and the vowel marks go."""
    # Unicode letters (first line to second) and marks.
    return lambda a: F.transform(a, lambda t: F.regexp_replace(F.translate(
        t, "\u0622\u0623\u0625\u0649\u0629", "\u0627\u0627\u0627\u064a\u0647"), "[\u0640\u064b-\u0652]", ""))


def persian_normalization() -> Step:
    """Persian letter normalization (T38): Farsi yeh and yeh barree → yeh, keheh → kaf, heh with yeh and heh goal → heh;
    hamza above goes."""
    return lambda a: F.transform(a, lambda t: F.replace(F.translate(
        t, "\u06cc\u06d2\u06a9\u06c0\u06c1", "\u064a\u064a\u0643\u0647\u0647"), F.lit("\u0654"), F.lit("")))


def position_filter(tokens: DataFrame, increment: int = 0) -> DataFrame:
    """Position reset (T46) on a token table: every token after a document's first moves ``increment`` positions on
    from the one before (0: all alternatives of one place)."""
    from pyspark.sql import Window
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) - 1
    first = F.min("pos").over(Window.partitionBy("doc_id"))
    return tokens.withColumn("pos", (first + nth * increment).cast("int"))


# ------------------------------------------------------------------ chains and token tables

class Analyzer:
    """A tokenizer followed by token filters (T01/T49). Each step is a Column→Column function."""

    def __init__(self, tokenizer: Step, filters: Sequence[Step] = (), char_filters: Sequence[Step] = ()):
        self.tokenizer = tokenizer
        self.filters = list(filters)
        self.char_filters = list(char_filters)

    def array(self, text: Column) -> Column:
        t = text
        for cf in self.char_filters:
            t = cf(t)
        a = self.tokenizer(t)
        for f in self.filters:
            a = f(a)
        return a


def default_analyzer() -> Analyzer:
    """Lower-cased runs of letters and digits of any script."""
    return Analyzer(pattern_tokenizer(DEFAULT_PATTERN))


# Preset chains.
def preset(name: str) -> Analyzer:
    name = name.lower()
    if name == "standard":
        return Analyzer(standard_tokenizer(), [lowercase(), stop_filter()])
    if name == "classic":
        return Analyzer(classic_tokenizer(), [lowercase(), stop_filter()])
    if name == "uax29urlemail":
        return Analyzer(url_email_tokenizer(), [lowercase(), stop_filter()])
    if name == "simple":
        return Analyzer(letter_tokenizer(lower=True))
    if name == "stop":
        return Analyzer(letter_tokenizer(lower=True), [stop_filter()])
    if name == "whitespace":
        return Analyzer(split_tokenizer(r"\s+"))
    if name == "keyword":
        return Analyzer(keyword_tokenizer())
    if name == "en":
        return Analyzer(standard_tokenizer(), [english_possessive(), lowercase(), stop_filter()])
    if name in ("de", "fr", "es"):
        extra = [elision()] if name == "fr" else []
        norm = [german_normalization()] if name == "de" else []
        return Analyzer(standard_tokenizer(), extra + [lowercase()] + norm)
    if name == "cjk":
        from searchlake.operators.letters import cjk_analyzer
        return cjk_analyzer()
    raise KeyError(name)


def token_table(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer | None = None,
                field: str | None = None, with_length: bool = True) -> DataFrame:
    """Explode analyzed arrays into ``doc_id, pos, term[, dl]``.

    ``dl`` = number of kept tokens of the doc (the length norm input), computed on the array
    before exploding, so it costs no aggregate. NULL entries (removed tokens) leave holes.
    """
    an = analyzer or default_analyzer()
    arr = an.array(F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), arr.alias("_toks"))
    if with_length:
        base = base.withColumn("dl", F.size(F.filter("_toks", lambda x: x.isNotNull())))
    cols = ["doc_id"] + (["dl"] if with_length else [])
    out = base.select(*cols, F.posexplode("_toks").alias("pos", "term")).filter(F.col("term").isNotNull())
    if field is not None:
        out = out.withColumn("field", F.lit(field))
    return out


def doc_lengths(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer | None = None) -> DataFrame:
    """``doc_id, dl`` for every doc (empty docs have dl 0) — no explode, no shuffle."""
    an = analyzer or default_analyzer()
    arr = an.array(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.size(F.filter(arr, lambda x: x.isNotNull())), F.lit(0)).alias("dl"))


def per_field_tokens(docs: DataFrame, id_col: str, chains: dict[str, Analyzer]) -> DataFrame:
    """Each text column through its own chain (T51): union of token tables with a ``field`` column."""
    out = None
    for col, an in chains.items():
        t = token_table(docs, id_col, col, an, field=col)
        out = t if out is None else out.unionByName(t)
    return out


# ------------------------------------------------------------------ vocabulary jobs

def vocabulary_map(tokens: DataFrame, fn_udf, name: str = "stem", term_col: str = "term") -> DataFrame:
    """Apply a term→term function once per distinct term (``select distinct`` + pandas UDF).

    Returns ``term, <name>``; callers join it back (broadcast when the vocabulary is small,
    AQE picks a shuffle join otherwise)."""
    vocab = tokens.select(term_col).distinct()
    return vocab.withColumn(name, fn_udf(F.col(term_col)))


def apply_vocabulary(tokens: DataFrame, mapping: DataFrame, name: str = "stem", term_col: str = "term") -> DataFrame:
    """Replace each token by its mapped form (NULL mapping keeps the token)."""
    j = tokens.join(mapping.select(term_col, name), term_col, "left")
    return j.withColumn(term_col, F.coalesce(F.col(name), F.col(term_col))).drop(name)


def document_frequencies(docs: DataFrame, text_col: str, analyzer: Analyzer | None = None) -> DataFrame:
    """``term, df`` of a text column: a document's distinct terms, counted; one combined aggregate, no shuffle of texts or postings."""
    terms = F.array_distinct((analyzer or default_analyzer()).array(F.col(text_col)))
    rows = docs.select(F.explode(terms).alias("term")).filter(F.col("term").isNotNull())
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def auto_stop_words(term_stats: DataFrame, n_docs: int, max_doc_fraction: float = 0.4) -> DataFrame:
    """Terms occurring in more than a fraction of docs."""
    return term_stats.filter(F.col("df") > F.lit(max_doc_fraction * n_docs)).select("term")


def english_minimal_stem(t: Column) -> Column:
    """English minimal (plural) stemmer as one expression (T40): ``-ies`` → ``-y`` (not after a/e),
    keep ``-us``/``-ss`` and ``-aes/-ees/-oes/-ies`` forms, otherwise drop a final ``s``."""
    n = F.length(t)
    c = lambda k: F.substring(t, n - k + 1, 1)  # noqa: E731  k-th char from the end
    plain = F.substring(t, 1, n - 1)
    ies = F.concat(F.substring(t, 1, n - 3), F.lit("y"))
    return (F.when((n < 3) | (c(1) != "s"), t)
            .when(c(2).isin("u", "s"), t)
            .when((c(2) == "e") & (n > 3) & (c(3) == "i") & ~c(4).isin("a", "e"), ies)
            .when((c(2) == "e") & c(3).isin("i", "a", "o", "e"), t)
            .otherwise(plain))


def english_minimal_stemmer() -> Step:
    return lambda a: F.transform(a, english_minimal_stem)


# ------------------------------------------------------------------ token-table steps

def parse_synonym_rules(lines: Sequence[str]) -> list[tuple[str, str]]:
    """Synonym rules (T33): ``a, b => c d`` (explicit: left words map to the right list) and
    ``x, y, z`` (equivalence: every word maps to every word of the list, itself included).
    Returns ``(from, to)`` pairs for single-word sides; multi-word sides are kept as phrases."""
    pairs = []
    for raw in lines:
        line = raw.split("#", 1)[0].strip()
        if not line:
            continue
        if "=>" in line:
            left, right = line.split("=>", 1)
            lhs = [w.strip() for w in left.split(",") if w.strip()]
            rhs = [w.strip() for w in right.split(",") if w.strip()]
            pairs += [(a, b) for a in lhs for b in rhs]
        else:
            words = [w.strip() for w in line.split(",") if w.strip()]
            pairs += [(a, b) for a in words for b in words]
    return list(dict.fromkeys(pairs))


def apply_synonyms(tokens: DataFrame, rules: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Expand tokens with single-word synonym rules at the same position (T33, expand mode).

    ``rules``: ``from, to``. A token with rules is replaced by all its targets (a rule set that
    maps a word to itself keeps it); other tokens pass through. Rules are a user table, broadcast
    after a size check; the join key is the token string."""
    r = rules.select(F.lower("from").alias("_from") if ignore_case else F.col("from").alias("_from"),
                     F.col("to").alias("_to"))
    r = bounded_broadcast(r)
    key = F.lower("term") if ignore_case else F.col("term")
    j = tokens.withColumn("_key", key).join(r, F.col("_key") == F.col("_from"), "left")
    return j.withColumn("term", F.coalesce(F.col("_to"), F.col("term"))).drop("_key", "_from", "_to")


def remove_duplicate_tokens(tokens: DataFrame) -> DataFrame:
    """Drop repeated (term, position) pairs of a doc."""
    keys = [c for c in ("field", "doc_id", "pos", "term") if c in tokens.columns]
    return tokens.dropDuplicates(keys)


def reversed_wildcard_terms(tokens: DataFrame, marker: str = "\u0001") -> DataFrame:
    """Add a reversed copy of each token, prefixed by a marker, at the same position (T25) — lets
    leading-wildcard queries run as prefix queries on the reversed form."""
    rev = tokens.withColumn("term", F.concat(F.lit(marker), F.reverse("term")))
    return tokens.unionByName(rev)


def stem_with_override(tokens: DataFrame, stem: Callable[[Column], Column], protected: DataFrame | None = None,
                       overrides: DataFrame | None = None) -> DataFrame:
    """Keyword marker + stemmer override (T30): protected words are not stemmed; override
    entries (``term, stem``) win over the algorithm; everything else gets ``stem(term)``.
    Runs on the distinct vocabulary and joins back."""
    vocab = tokens.select("term").distinct()
    v = vocab.withColumn("_stem", stem(F.col("term")))
    if overrides is not None:
        v = v.join(overrides.select("term", F.col("stem").alias("_ovr")), "term", "left") \
            .withColumn("_stem", F.coalesce("_ovr", "_stem")).drop("_ovr")
    if protected is not None:
        v = v.join(protected.select("term").withColumn("_kw", F.lit(True)), "term", "left") \
            .withColumn("_stem", F.when(F.col("_kw"), F.col("term")).otherwise(F.col("_stem"))).drop("_kw")
    return tokens.join(v, "term").withColumn("term", F.col("_stem")).drop("_stem")


def decompound(vocab: DataFrame, dictionary: DataFrame, min_word: int = 5, min_sub: int = 2, max_sub: int = 15,
               longest_only: bool = False) -> DataFrame:
    """Dictionary decompounding (T35): for each term of length ≥ ``min_word``, every substring of
    length ``min_sub``..``max_sub`` that is a dictionary word becomes a sub-token (``term, start, part``).
    Substrings are generated from the distinct vocabulary, then semi-joined with the dictionary;
    ``longest_only`` keeps the longest match per start offset."""
    v = vocab.select("term").distinct().filter(F.length("term") >= min_word)
    starts = v.select("term", F.explode(F.sequence(F.lit(1), F.length("term"))).alias("start"))
    subs = starts.select("term", "start", F.explode(F.sequence(F.lit(min_sub), F.lit(max_sub))).alias("len")) \
        .filter(F.col("start") + F.col("len") - 1 <= F.length("term")) \
        .withColumn("part", F.expr("substring(term, start, len)")) \
        .filter(F.col("part") != F.col("term"))
    hit = subs.join(dictionary.select(F.col("term").alias("part")).distinct(), "part", "left_semi")
    if longest_only:
        from pyspark.sql import Window
        w = Window.partitionBy("term", "start").orderBy(F.col("len").desc())
        hit = hit.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    return hit.select("term", (F.col("start") - 1).alias("start"), "part")


def token_sink(tokens: DataFrame, types: Sequence[str] | None = None, pos_range: tuple[int, int] | None = None,
               date_like: bool = False) -> DataFrame:
    """Side tables split off one token stream (T45): by token type, by position range, or
    date-looking tokens (yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy)."""
    t = tokens
    if types is not None:
        t = t.filter(F.col("type").isin(list(types)))
    if pos_range is not None:
        t = t.filter(F.col("pos").between(pos_range[0], pos_range[1] - 1))
    if date_like:
        t = t.filter(F.col("term").rlike(r"^(\d{4}-\d{2}-\d{2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})$"))
    return t


# Word-delimiter token parts (case runs, digit runs).
# A part ends at lower→upper, letter↔digit and punctuation; upper→lower does not split ("ABCDef" stays whole).
_WD_PARTS = r"[\p{Lu}\p{Lt}]*[\p{L}\p{M}&&[^\p{Lu}\p{Lt}]]+|[\p{Lu}\p{Lt}]+|\p{N}+"


def word_delimiter(generate_parts: bool = True, catenate_words: bool = False, catenate_numbers: bool = False,
                   catenate_all: bool = False, preserve_original: bool = False, stem_english_possessive: bool = True) -> Step:
    """Word delimiter (T28): split tokens on case changes, letter/digit transitions and
    punctuation; optionally add catenations and the original. Returns array of arrays (sub-tokens
    per position, like the other multi-output steps)."""
    def step(a: Column) -> Column:
        def parts(t):
            base = F.regexp_replace(t, "['’][sS]$", "") if stem_english_possessive else t
            p = F.regexp_extract_all(base, F.lit(_WD_PARTS), 0)
            words = F.filter(p, lambda x: x.rlike(r"^[\p{L}\p{M}]+$"))
            nums = F.filter(p, lambda x: x.rlike(r"^\p{N}+$"))
            out = p if generate_parts else F.array().cast("array<string>")
            if catenate_words:
                out = F.concat(out, F.when(F.size(words) > 1, F.array(F.array_join(words, ""))).otherwise(F.array()))
            if catenate_numbers:
                out = F.concat(out, F.when(F.size(nums) > 1, F.array(F.array_join(nums, ""))).otherwise(F.array()))
            if catenate_all:
                out = F.concat(out, F.when(F.size(p) > 1, F.array(F.array_join(p, ""))).otherwise(F.array()))
            if preserve_original:
                out = F.concat(F.array(t), out)
            return F.array_distinct(out)
        return F.transform(a, parts)
    return step


def common_grams(common: Sequence[str], sep: str = "_", query_mode: bool = False) -> Step:
    """Common-grams (T32): a bigram ``a_b`` at every position where ``a`` or ``b`` is a common word.
    Index mode keeps every unigram and adds the grams; query mode keeps the grams and drops the
    unigrams they cover. Pass a materialized array column. Returns array of arrays per position."""
    cs = list(common)

    def step(a: Column) -> Column:
        n = F.size(a)

        def at(t, i):
            nxt = F.element_at(a, F.least(i + 2, n))
            is_gram = (i + 1 < n) & (t.isin(cs) | nxt.isin(cs))
            gram = F.when(is_gram, F.concat(t, F.lit(sep), nxt))
            if not query_mode:
                return F.filter(F.array(t, gram), lambda x: x.isNotNull())
            prev_gram = F.when(i > 0, F.element_at(a, F.greatest(i, F.lit(1))).isin(cs) | t.isin(cs))
            covered = is_gram | F.coalesce(prev_gram, F.lit(False))
            return F.filter(F.array(F.when(~covered, t), gram), lambda x: x.isNotNull())
        return F.transform(a, at)
    return step


def cjk_bigrams(output_unigrams: bool = False) -> Step:
    """CJK bigrams (T12): runs of Han/Hiragana/Katakana/Hangul become overlapping 2-char grams;
    other tokens pass through. Returns array of arrays per position."""
    cjk = r"^[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]+$"

    def step(a: Column) -> Column:
        def grams(t):
            n = F.length(t)
            bi = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(t, i, 2))
            uni = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(t, i, 1))
            cj = F.concat(uni, bi) if output_unigrams else F.when(n == 1, F.array(t)).otherwise(bi)
            return F.when(t.rlike(cjk), cj).otherwise(F.array(t))
        return F.transform(a, grams)
    return step


def cjk_width_fold() -> Step:
    """Full-width ASCII → ASCII, half-width Katakana kept (T12 width folding): ``translate`` on a
    generated table (U+FF01..U+FF5E → U+0021..U+007E)."""
    src = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    dst = "".join(chr(c) for c in range(0x21, 0x7F))
    return lambda a: F.transform(a, lambda t: F.translate(t, src, dst))


def analysis_report(docs: DataFrame, id_col: str, text_col: str, tokenizer: Step, filters: Sequence[tuple[str, Step]],
                    query_terms: Sequence[str] = ()) -> DataFrame:
    """Tokens after each chain step (T48): ``step, step_name, doc_id, pos, term, match`` where
    ``match`` flags tokens equal to an analyzed query term. One row set per step, unioned."""
    arr = tokenizer(F.col(text_col))
    steps = [("tokenizer", arr)]
    for name, f in filters:
        arr = f(arr)
        steps.append((name, arr))
    base = docs.select(F.col(id_col).alias("doc_id"), *[a.alias(f"_s{i}") for i, (_, a) in enumerate(steps)])
    out = None
    for i, (name, _) in enumerate(steps):
        part = base.select(F.lit(i).alias("step"), F.lit(name).alias("step_name"), "doc_id",
                           F.posexplode(f"_s{i}").alias("pos", "term")).filter(F.col("term").isNotNull())
        out = part if out is None else out.unionByName(part)
    return out.withColumn("match", F.col("term").isin(list(query_terms)))


def greek_lowercase() -> Step:
    """Greek lower-casing (T13): lower-case, final sigma ς → σ, accented vowels unaccented."""
    return lambda a: F.transform(a, lambda t: F.translate(F.lower(t), "ςάέήίόύώϊϋΐΰ", "σαεηιουωιυιυ"))


def irish_lowercase() -> Step:
    """Irish lower-casing (T13): ``n``/``t`` prefixes before an upper-case vowel get a hyphen
    (``nAthair`` → ``n-athair``), then lower-case."""
    return lambda a: F.transform(a, lambda t: F.lower(F.regexp_replace(t, "^([nt])([AEIOUÁÉÍÓÚ])", "$1-$2")))


def delimited_payloads(tokens: DataFrame, delimiter: str = "|", kind: str = "float") -> DataFrame:
    """Delimited payloads (T39): ``term|1.5`` → ``term`` plus a numeric ``payload`` (NULL if none)."""
    parts = F.split(F.col("term"), _re_escape(delimiter), 2)
    return tokens.withColumn("payload", F.try_element_at(parts, F.lit(2)).try_cast(kind)) \
        .withColumn("term", F.element_at(parts, 1))


def numeric_payload(tokens: DataFrame, type_: str, value: float) -> DataFrame:
    """Tokens of one type carry ``value`` as payload (T39); the others keep theirs, or none."""
    other = F.col("payload") if "payload" in tokens.columns else F.lit(None).cast("float")
    return tokens.withColumn("payload", F.when(F.col("type") == type_, F.lit(float(value)).cast("float")).otherwise(other))


def offsets_as_payload(stream: DataFrame) -> DataFrame:
    """A token's offsets as payload (T39): start and end, big-endian 32-bit, as hexadecimal digits."""
    return stream.withColumn("payload", F.lower(F.concat(*[F.lpad(F.hex(c), 8, "0") for c in ("start", "end")])))


def type_as_payload(tokens: DataFrame) -> DataFrame:
    """Token type copied into the payload."""
    return tokens.withColumn("payload", F.col("type"))
