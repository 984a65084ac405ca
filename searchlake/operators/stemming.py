"""Rule stemmers as column expressions (T40): ordered rules with conditions, compiled and run over the distinct vocabulary.

A stemmer is a list of steps, a step a list of rules. In a step the first rule whose ending fits (and whose word is longer than
``over``) is chosen; if its condition on the stem holds, the ending is replaced. A rule may end the whole procedure up to the
steps marked ``always``, and may be followed by rules of its own. ``compile_rules`` turns this into one expression; every step's result is
bound once (``let``), so the expression grows with the number of rules.

Rules state the published algorithms: Porter's suffix stripping for English, and the light and minimal stemmers for German, French
and Spanish from the UniNE work. Words are expected in lower case.

Defined results: null stays null; words of other scripts come back unchanged where no ending fits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Condition = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """``ending`` (a regular expression, anchored at the end) becomes ``to``."""
    ending: str
    to: str = ""
    over: int = 0
    when: Condition | None = None
    last: bool = False
    then: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class Step:
    rules: tuple[Rule, ...] = ()
    change: Condition | None = None
    over: int = 0
    always: bool = False


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _apply(word: Column, rules: Sequence[Rule]) -> Column:
    """struct(word, last) after one step's rules."""
    out = F.struct(word.alias("w"), F.lit(False).alias("last"))
    for r in reversed(rules):
        fits = word.rlike(f"(?:{r.ending})\\z") & (F.length(word) > r.over)
        stem = F.regexp_replace(word, f"(?:{r.ending})\\z", "")
        new = F.regexp_replace(word, f"(?:{r.ending})\\z", r.to)
        if r.then:
            new = let(new, _following(r.then))
        changed = F.struct(new.alias("w"), F.lit(r.last).alias("last"))
        if r.when is not None:
            changed = F.when(r.when(stem), changed).otherwise(F.struct(word.alias("w"), F.lit(False).alias("last")))
        out = F.when(fits, changed).otherwise(out)
    return out


def _following(rules: tuple[Rule, ...]) -> Callable[[Column], Column]:
    return lambda word: _apply(word, rules)["w"]


def compile_rules(steps: Sequence[Step], shortest: int = 0) -> Callable[[Column], Column]:
    """A word column -> its stem; words of ``shortest`` letters or fewer stay."""
    def run(state: Column, rest: Sequence[Step]) -> Column:
        if not rest:
            return state["w"]
        step = rest[0]
        word = state["w"]
        if step.change is not None:
            new = F.struct(F.when(F.length(word) > step.over, step.change(word)).otherwise(word).alias("w"), state["last"].alias("last"))
        else:
            done = _apply(word, step.rules)
            new = let(done, lambda d: F.struct(d["w"].alias("w"), (d["last"] | state["last"]).alias("last")))
            if step.over:
                new = F.when(F.length(word) > step.over, new).otherwise(state)
        if not step.always:
            new = F.when(state["last"], state).otherwise(new)
        return let(new, lambda s: run(s, rest[1:]))

    def stem(word: Column) -> Column:
        first = F.struct(word.alias("w"), F.lit(False).alias("last"))
        return F.when(F.length(word) > shortest, let(first, lambda s: run(s, list(steps)))).otherwise(word)
    return stem


# ------------------------------------------------------------------ English: Porter

def _sounds(word: Column) -> Column:
    """The word with every ``y`` that stands for a vowel written as ``i``: one behind a consonant."""
    return F.replace(F.regexp_replace(word, "(?<=[^aeiouy])y", "i"), F.lit("yy"), F.lit("yi"))


def measure(stem: Column) -> Column:
    """Number of vowel-consonant sequences."""
    return F.regexp_count(_sounds(stem), F.lit("[aeiou]+[^aeiou]+"))


def _vowel(stem: Column) -> Column:
    return _sounds(stem).rlike("[aeiou]")


def _short(stem: Column) -> Column:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return _sounds(stem).rlike(r"[^aeiou][aeiou][^aeiouwxy]\z")


def _m(least: int) -> Condition:
    return lambda stem: measure(stem) >= least


def _pairs(text: str, when: Condition) -> tuple[Rule, ...]:
    """``ending>replacement`` pairs as rules; the longest ending first."""
    pairs = [p.split(">") for p in text.split()]
    return tuple(Rule(a, b, when=when) for a, b in sorted(pairs, key=lambda p: -len(p[0])))


# Endings of the published algorithm and what replaces them.
_PORTER_2 = """ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize ation>ate
ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble logi>log"""
_PORTER_3 = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
_PORTER_4 = "al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ou> ism> ate> iti> ous> ive> ize>"

_AFTER_ED = (Rule("at", "ate"), Rule("bl", "ble"), Rule("iz", "ize"),
             Rule(r"([bcdfghjkmnpqrtvwx])\1", "$1"), Rule("yy", "y", when=lambda w: _sounds(F.concat(w, F.lit("yy"))).endswith("y")),
             Rule("", "e", when=lambda w: (measure(w) == 1) & _short(w)))

PORTER = [
    Step((Rule("sses", "ss"), Rule("ies", "i"), Rule("ss", "ss"), Rule("s"))),
    Step((Rule("eed", "ee", when=_m(1)), Rule("ed", when=_vowel, then=_AFTER_ED), Rule("ing", when=_vowel, then=_AFTER_ED))),
    Step((Rule("y", "i", when=_vowel),)),
    Step(_pairs(_PORTER_2, _m(1))),
    Step(_pairs(_PORTER_3, _m(1))),
    Step((*_pairs(_PORTER_4, _m(2)), Rule("(?<=[st])ion", when=_m(2)))),
    Step((Rule("e", when=lambda s: (measure(s) > 1) | ((measure(s) == 1) & ~_short(s))),)),
    Step((Rule("ll", "l", when=lambda s: measure(F.concat(s, F.lit("ll"))) > 1),)),
]


# ------------------------------------------------------------------ German, French, Spanish

def _letters(src: str, dst: str) -> Condition:
    return lambda w: F.translate(w, src, dst)


# Letters and the plain ones they stand for, endings, and lengths a word must exceed.
GERMAN_LIGHT = [
    Step(change=_letters("äàáâöòóôïìíîüùúû", "aaaaooooiiiiuuuu")),
    Step((Rule("ern", over=5), Rule("e[mnrs]", over=4), Rule("e", over=3), Rule("(?<=[bdfghklmnt])s", over=3))),
    Step((Rule("est", over=5), Rule("e[rn]", over=4), Rule("(?<=[bdfghklmnt])st", over=4))),
]
GERMAN_MINIMAL = [
    Step(change=_letters("äöü", "aou")),
    Step((Rule("nen", over=6), Rule("en|se|es|er", over=5), Rule("[nesr]"))),
]
SPANISH_LIGHT = [
    Step(change=_letters("àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii")),
    Step((Rule("[oae]"), Rule("(?<=es)es"), Rule("ces", "z"), Rule("[oae]s"))),
]
FRENCH_MINIMAL = [
    Step((Rule("aux", "al", last=True), Rule("x", last=True))),
    Step((Rule("s"),)), Step((Rule("r"),)), Step((Rule("e"),)), Step((Rule("é"),)), Step((Rule(r"(.)\1", "$1"),)),
]


def _final(text: str) -> tuple[Rule, ...]:
    """``ending>replacement>over`` triples as rules that end the procedure, in the given order."""
    return tuple(Rule(a, b, over=int(n), last=True) for a, b, n in (t.split(">") for t in text.split()))


FRENCH_LIGHT = [
    Step((Rule("(?<!e)aux", "al", over=5), Rule("x", over=5))),
    Step((Rule("x", over=3),)),
    Step((Rule("s", over=3),)),
    Step(_final("issement>ir>9 issant>ir>8 ivement>if>7 ement>e>6 ficatrice>fier>11 ficateur>fier>10 catrice>quer>9 cateur>quer>8 "
                "atrice>er>8 ateur>er>7")),
    Step((Rule("trice", "teur", over=6),)),
    Step(_final("ième>>5 teuse>ter>7 teur>ter>6 euse>eu>5 ère>er>8 ive>if>7 folle>fou>4 molle>mou>4 nnelle>n>9 nnel>n>9")),
    Step((Rule("ète", "et", over=4),)),
    Step((Rule("ique", over=8),)),
    Step(_final("esse>e>8 inage>in>7 ualisation>uel>12 isation>>9 isateur>>9 ation>>8 ition>>8")),
    Step(change=lambda w: F.regexp_replace(F.translate(w, "àáâôèéêùûîç", "aaaoeeeuuic"), r"(\p{L})\1+", "$1"), over=4, always=True),
    Step((Rule("ie", over=4),), always=True),
    Step(change=lambda w: F.regexp_replace(F.regexp_replace(w, "e{0,2}r?\\z", ""), r"(\p{L})\1\z", "$1"), over=4, always=True),
]



#: By language and kind; the names of ``vocabulary_stems``.
_TABLES: dict[str, tuple[list[Step], int]] = {
    "en_porter": (PORTER, 2), "de_light": (GERMAN_LIGHT, 0), "de_minimal": (GERMAN_MINIMAL, 4), "fr_light": (FRENCH_LIGHT, 0),
    "fr_minimal": (FRENCH_MINIMAL, 5), "es_light": (SPANISH_LIGHT, 4),
}


def stemmer(name: str) -> Callable[[Column], Column]:
    """The stemmer of that name as a function of a word column."""
    steps, shortest = _TABLES[name]
    return compile_rules(steps, shortest)


def vocabulary_stems(vocabulary: DataFrame, name: str, term_col: str = "term") -> DataFrame:
    """``term, stem`` of the distinct terms."""
    return vocabulary.select(F.col(term_col).alias("term")).distinct().withColumn("stem", stemmer(name)(F.col("term")))


def stem_tokens(tokens: DataFrame, name: str) -> DataFrame:
    """The token table with its terms stemmed: each distinct term once, joined back."""
    return tokens.join(vocabulary_stems(tokens, name), "term").withColumn("term", F.col("stem")).drop("stem")
