"""Letters and markup of further languages (T12, T38, T47): CJK tokens, Hindi and Indic letters, wiki markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchlake.operators import analysis as an

CJK = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}"


def cjk_tokenizer() -> an.Step:
    """Runs of CJK letters, and runs of other letters and digits."""
    return lambda text: F.regexp_extract_all(text, F.lit(rf"[{CJK}]+|[\p{{L}}\p{{N}}&&[^{CJK}]]+"), F.lit(0))


def cjk_analyzer(output_unigrams: bool = False) -> an.Analyzer:
    """The cjk preset (T49): width folding on the text, lower case, overlapping pairs of CJK letters (each at a position of its
    own, as the single letters are), stop words."""
    fold = an.cjk_width_fold()
    return an.Analyzer(cjk_tokenizer(), [an.lowercase(), lambda a: F.flatten(an.cjk_bigrams(output_unigrams)(a)), an.stop_filter()],
                       [lambda t: F.get(fold(F.array(t)), F.lit(0))])


# ------------------------------------------------------------------ T38

# Devanagari letters and the letters that stand for them.
_HINDI_FROM = "ँऩऱऴक़ख़ग़ज़ड़ढ़फ़य़ॅॆॉॊऍऎऑऒॲ" \
    "आईऊॠॡऐऔीूॄॣैौ"
_HINDI_TO = "ंनरळकखगजडढफयेेोोएएओओअ" \
    "अइउऋऌएओिुृॢेो"
_HINDI_GONE = "[़्‌‍]"


def hindi_normalization() -> an.Step:
    """Hindi letter normalization (T38): a dead n becomes a nasal sign, long vowels and their signs short ones, letters with a dot below
    their plain form; dots, the vowel killer and joiners go."""
    def word(t: Column) -> Column:
        t = F.replace(t, F.lit("न्"), F.lit("ं"))
        return F.regexp_replace(F.translate(t, _HINDI_FROM, _HINDI_TO), _HINDI_GONE, "")
    return lambda a: F.transform(a, word)


# First letters of the scripts' blocks, by a letter of our own.
_SCRIPTS = {"D": 0x0900, "B": 0x0980, "G": 0x0A00, "J": 0x0A80, "O": 0x0B00, "T": 0x0B80, "E": 0x0C00, "K": 0x0C80, "M": 0x0D00}
# Two or three letters, the letter that they are written for, and the scripts; offsets in the block, ZW the joiner.
_COMPOSED = """
05 3E 45 = 11 DJ; 05 3E 46 = 12 D; 05 3E 47 = 13 DJ; 05 3E 48 = 14 DJ; 05 3E = 06 DBGJO; 05 45 = 72 D; 05 45 = 0D J; 05 46 = 04 D; 05 47 = 0F J;
05 48 = 10 GJ; 05 49 = 11 DJ; 05 4A = 12 D; 05 4B = 13 DJ; 05 4C = 14 DGJ; 06 45 = 11 DJ; 06 46 = 12 D; 06 47 = 13 DJ; 06 48 = 14 DJ; 07 57 = 08 M;
09 41 = 0A D; 09 57 = 0A TM; 0E 46 = 10 M; 0F 45 = 0D D; 0F 46 = 0E D; 0F 47 = 10 D; 0F 57 = 10 O; 12 3E = 13 M; 12 4C = 14 EK; 12 55 = 13 E;
12 57 = 14 TM; 13 57 = 14 O; 15 3C = 58 D; 16 3C = 59 DG; 17 3C = 5A DG; 1C 3C = 5B DG; 21 3C = 5C DBO; 22 3C = 5D DBO; 23 4D ZW = 7A M;
24 4D ZW = 4E B; 28 3C = 29 D; 28 4D ZW = 7B M; 2B 3C = 5E DG; 2F 3C = 5F DB; 2C 41 41 = 0B E; 30 3C = 31 D; 30 4D ZW = 7C M; 32 4D ZW = 7D M;
33 3C = 34 D; 33 4D ZW = 7E M; 35 41 = 2E E; 3E 45 = 49 DJ; 3E 46 = 4A D; 3E 47 = 4B DJ; 3E 48 = 4C DJ; 3F 55 = 40 K; 41 41 = 42 G; 46 3E = 4A TM;
46 42 55 = 4B K; 46 42 = 4A K; 46 46 = 48 M; 46 55 = 47 EK; 46 56 = 48 EK; 46 57 = 4C TM; 47 3E = 4B BOTM; 47 57 = 4C BO; 4A 55 = 4B K; 72 3F = 07 G;
72 40 = 08 G; 72 47 = 0F G; 73 41 = 09 G; 73 42 = 0A G; 73 4B = 13 G
"""


def indic_rules() -> dict[str, str]:
    """Letter sequences of the Indic scripts and the one letter each stands for."""
    out = {}
    for row in _COMPOSED.replace("\n", " ").split(";"):
        left, right = row.split("=")
        to, scripts = right.split()
        for s in scripts:
            letter = lambda x, base=_SCRIPTS[s]: "‍" if x == "ZW" else chr(base + int(x, 16))
            out["".join(map(letter, left.split()))] = letter(to)
    return out


def indic_normalization() -> an.Step:
    """Indic letter normalization (T38): at every place the longest known sequence becomes its letter, once."""
    one = an.mapping_char_filter(indic_rules())
    return lambda a: F.transform(a, one)


# ------------------------------------------------------------------ T47

# Regions of wiki markup and the type of the words in them, in order of trial.
_REGIONS = [("c", r"\[\[Category:[^\]]*\]\]", "[[Category:"), ("il", r"\[\[[^\]]*\]\]", "[["), ("el", r"\[https?://[^\]]*\]", "["),
            ("ci", r"\{\{[^}]*\}\}", "{{"), ("sh", r"===[^=\n]+===", "==="), ("h", r"==[^=\n]+==", "=="),
            ("bi", r"'''''[^'\n]+'''''", "'''''"), ("b", r"'''[^'\n]+'''", "'''"), ("i", r"''[^'\n]+''", "''")]


def wiki_tokens(text: Column) -> Column:
    """Array of structs ``term, type`` (T47): words with the type of the region they stand in, in order: category, internal and external
    link (its address is one token ``elu``), citation, heading, subheading, bold, italics or both; other words are ``word``.
    Regions do not nest."""
    words = lambda t: F.regexp_extract_all(t, F.lit(an.DEFAULT_PATTERN), F.lit(0))
    typed = lambda a, kind: F.transform(a, lambda w: F.struct(w.alias("term"), F.lit(kind).alias("type")))
    pattern = "|".join([r for _, r, _ in _REGIONS] + [an.DEFAULT_PATTERN])

    def piece(p: Column) -> Column:
        out = typed(words(p), "word")
        for kind, _, mark in reversed(_REGIONS):
            if kind == "el":
                url = F.regexp_extract(p, r"^\[(https?://[^\s\]]*)", 1)
                rest = F.substring(p, F.length(url) + 2, F.length(p))
                own = F.concat(typed(F.array(url), "elu"), typed(words(rest), "el"))
            else:
                own = typed(words(F.substring(p, len(mark) + 1, 1 << 30)) if kind == "c" else words(p), kind)
            out = F.when(p.startswith(mark), own).otherwise(out)
        return out

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), piece))
