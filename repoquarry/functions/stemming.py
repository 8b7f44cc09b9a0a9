"""Suffix stripping after M. F. Porter, "An algorithm for suffix stripping" (1980).

The stemmer is one column of built-in string expressions. Every step binds the
word it works on once, as the variable of a one-element ``transform``, so the
expression grows with the number of steps and not with its powers. The
consonant/vowel tests are the usual regular expressions over word shapes; a
leading ``y`` is written ``Y`` meanwhile because it always is a consonant.

Extensions to the 1980 rules, as common stemming packages apply them: a few
irregular words, words of one or two letters left alone, ``ied`` handled like
``ies``, ``y`` turned to ``i`` only after a consonant that is not the first
letter, and the extra endings ``fulli`` and ``logi``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binding import bound

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# The endings of steps 2, 3 and 4 and what replaces them.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
          "iti", "ous", "ive", "ize")

# Word shapes: C is a run of consonants, V a run of vowels.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
POSITIVE = f"^({_C})?{_V}{_C}"  # measure above 0
ABOVE_ONE = f"^({_C})?{_V}{_C}{_V}{_C}"  # measure above 1
HAS_VOWEL = f"^({_C})?[aeiouy]"
SHORT = f"^({_C}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"  # measure 1, ends consonant-vowel-consonant


def _ending(endings: Iterable[str]) -> str:
    """Pattern that captures the longest of the endings."""
    return "(" + "|".join(sorted(endings, key=len, reverse=True)) + ")$"


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for text in chain.from_iterable(pairs.items())])


def _cut(word: Column, ending: Column) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - F.length(ending))


def _drop(word: Column, count: int) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - count)


def _replace(pattern: str, rule: Callable[[Column, Column, Column], Column]) -> Callable[[Column], Column]:
    """Step that finds an ending ``e`` and lets ``rule(word, base, e)`` decide."""

    def step(word: Column) -> Column:
        found = F.regexp_extract(word, pattern, 1)
        return bound(
            found, lambda e: F.when(e == "", word).otherwise(bound(_cut(word, e), lambda base: rule(word, base, e)))
        )

    return step


def _plural(w: Column) -> Column:
    return (
        F.when(~w.endswith("s") | w.endswith("ss") & ~w.endswith("sses"), w)
        .when(w.rlike("^.ies$"), _drop(w, 1))
        .when(w.rlike("(sses|ies)$"), _drop(w, 2))
        .otherwise(_drop(w, 1))
    )


def _past(w: Column, base: Column, e: Column) -> Column:
    return (
        F.when(e == "ied", F.concat(base, F.when(F.length(w) == 4, "ie").otherwise("i")))
        .when(e == "eed", F.when(base.rlike(POSITIVE), _drop(w, 1)).otherwise(w))
        .when(base.rlike(HAS_VOWEL), _repaired(base))
        .otherwise(w)
    )


def _repaired(w: Column) -> Column:
    """A word whose ``ed`` or ``ing`` is gone, made to look like a word again."""
    return (
        F.when(w.rlike("(at|bl|iz)$") | w.rlike(SHORT), F.concat(w, F.lit("e")))
        .when(w.rlike(r"([^aeiouylsz])\1$"), _drop(w, 1))
        .otherwise(w)
    )


def _final_y(w: Column) -> Column:
    return F.when(w.rlike("^.+[^aeiouy]y$"), F.concat(_drop(w, 1), F.lit("i"))).otherwise(w)


def _alli(w: Column) -> Column:
    return F.when(w.endswith("alli") & _drop(w, 4).rlike(POSITIVE), _drop(w, 2)).otherwise(w)


def _double(w: Column, base: Column, e: Column) -> Column:
    tested = F.when(e == "logi", F.concat(base, F.lit("l"))).otherwise(base)
    return F.when(tested.rlike(POSITIVE), F.concat(base, F.element_at(_table(STEP_2), e))).otherwise(w)


def _derived(w: Column, base: Column, e: Column) -> Column:
    return F.when(base.rlike(POSITIVE), F.concat(base, F.element_at(_table(STEP_3), e))).otherwise(w)


def _suffix(w: Column, base: Column, e: Column) -> Column:
    return F.when(base.rlike(ABOVE_ONE) & ((e != "ion") | base.rlike("[st]$")), base).otherwise(w)


def _final_e(w: Column, base: Column, e: Column) -> Column:
    return F.when(base.rlike(ABOVE_ONE) | (base.rlike(POSITIVE) & ~base.rlike(SHORT)), base).otherwise(w)


def _final_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & _drop(w, 1).rlike(ABOVE_ONE), _drop(w, 1)).otherwise(w)


STEPS = (
    _plural,
    _replace("(ied|eed|ed|ing)$", _past),
    _final_y,
    _alli,
    _replace(_ending(STEP_2), _double),
    _replace(_ending(STEP_3), _derived),
    _replace(_ending(STEP_4), _suffix),
    _replace("(e)$", _final_e),
    _final_l,
)


def porter_stem(word: Column) -> Column:
    """Stem of a lower-case word."""
    stem = F.regexp_replace(word, "^y", "Y")
    for step in STEPS:
        stem = bound(stem, step)
    return (
        F.when(word.isin(*IRREGULAR), F.element_at(_table(IRREGULAR), word))
        .when(F.length(word) <= 2, word)
        .otherwise(F.lower(stem))
    )


def with_stems(words: DataFrame, token: str = "token", stem: str = "stem") -> DataFrame:
    """Add the stem of each word; call it on distinct words."""
    return words.withColumn(stem, porter_stem(F.col(token)))
