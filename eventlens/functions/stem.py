"""Porter stemming in the dialect of the ROUGE scorer.

The rules of Porter (1980) with the changes that the scorer's stemmer is known
for: a list of irregular words, other endings for ``-ies``, ``-ied``, ``-y``,
``-bli``, ``-alli``, ``-fulli`` and ``-logi``, and two-letter stems that count
as closed.  Rules are tables; one interpreter applies the first rule of a table
whose suffix a word has.  As in ROUGE, only tokens longer than three characters
are stemmed.  It runs as an Arrow UDF over token arrays, once for each distinct
token of a batch and with a per-worker memo, and the plan stays map-only (no
explode / distinct / join-back shuffle).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

ROWS_HELD = 256  # rows that are Python objects at a time

_VOWELS = "aeiou"


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC){m}[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _cons(stem, i):
            i += 1
        if i >= n:
            break
        while i < n and _cons(stem, i):
            i += 1
        m += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _closed(w: str) -> bool:
    """Ends consonant, vowel, consonant other than w, x, y; or is a vowel and a consonant alone."""
    n = len(w)
    if n == 2:
        return not _cons(w, 0) and _cons(w, 1)
    return n > 2 and _cons(w, n - 3) and not _cons(w, n - 2) and _cons(w, n - 1) and w[-1] not in "wxy"


# ---- fixed values: irregular words and suffix rules of the scorer's dialect -----
# Irregular words: form -> stem.
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
             "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
             "cannings": "canning", "canning": "canning", "howe": "howe",
             "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}
# Rules: suffix, replacement, condition on what stands before the suffix.
PLURALS = (("sses", "ss", "any"), ("ies", "i", "any"), ("ss", "ss", "any"), ("s", "", "any"))
DERIVED = (("ational", "ate", "m>0"), ("tional", "tion", "m>0"), ("enci", "ence", "m>0"), ("anci", "ance", "m>0"),
           ("izer", "ize", "m>0"), ("bli", "ble", "m>0"), ("alli", "al", "m>0"), ("entli", "ent", "m>0"), ("eli", "e", "m>0"),
           ("ousli", "ous", "m>0"), ("ization", "ize", "m>0"), ("ation", "ate", "m>0"), ("ator", "ate", "m>0"),
           ("alism", "al", "m>0"), ("iveness", "ive", "m>0"), ("fulness", "ful", "m>0"), ("ousness", "ous", "m>0"),
           ("aliti", "al", "m>0"), ("iviti", "ive", "m>0"), ("biliti", "ble", "m>0"), ("fulli", "ful", "m>0"), ("logi", "log", "m>0 with l"))
ADJECTIVES = (("icate", "ic", "m>0"), ("ative", "", "m>0"), ("alize", "al", "m>0"), ("iciti", "ic", "m>0"),
              ("ical", "ic", "m>0"), ("ful", "", "m>0"), ("ness", "", "m>0"))
ENDINGS = tuple((e, "", "m>1 after s or t" if e == "ion" else "m>1") for e in
                ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
                 "ou", "ism", "ate", "iti", "ous", "ive", "ize"))
# ----------------------------------------------------------------------------------

_CONDITIONS = {
    "any": lambda stem: True,
    "m>0": lambda stem: _measure(stem) > 0,
    "m>1": lambda stem: _measure(stem) > 1,
    "m>0 with l": lambda stem: _measure(stem + "l") > 0,
    "m>1 after s or t": lambda stem: _measure(stem) > 1 and stem[-1] in "st",
}


def _first_rule(w: str, rules) -> str:
    """The first rule whose suffix the word has decides, whether its condition holds or not."""
    for suffix, replacement, condition in rules:
        if w.endswith(suffix):
            stem = w[:len(w) - len(suffix)]
            return stem + replacement if _CONDITIONS[condition](stem) else w
    return w


def _past(w: str) -> str:
    """-ied, -eed, -ed and -ing."""
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        stem = w[:len(w) - len(suffix)]
        if w.endswith(suffix) and _has_vowel(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_cons(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _closed(stem) else stem
    return w


def _derived(w: str) -> str:
    """-ational and the like; -alli may leave another of these suffixes."""
    while w.endswith("alli") and _measure(w[:-4]) > 0:
        w = w[:-2]
    return _first_rule(w, DERIVED)


@lru_cache(maxsize=200_000)
def porter_stem(word: str) -> str:
    """Stem one lower-case word (words of one or two letters pass unchanged)."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = word[:-1] if len(word) == 4 and word.endswith("ies") else _first_rule(word, PLURALS)
    w = _past(w)
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        w = w[:-1] + "i"
    w = _first_rule(_first_rule(_derived(w), ADJECTIVES), ENDINGS)
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _closed(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def in_lists(column: pa.Array) -> Iterator:
    """The values of a column as Python objects, ``ROWS_HELD`` at a time: an Arrow batch is as large as its session says."""
    for i in range(0, len(column), ROWS_HELD):
        yield from column.slice(i, ROWS_HELD).to_pylist()


def _stemmed(column: pa.Array) -> pa.Array:
    """A string array with its words of over three characters stemmed; each distinct word once."""
    coded = column.dictionary_encode()
    words = pa.array([porter_stem(t) if t and len(t) > 3 else t for t in coded.dictionary.to_pylist()], pa.string())
    return words.take(coded.indices)


def _in_list(column: pa.ListArray, values: pa.Array) -> pa.ListArray:
    """The lists of ``column`` over other values."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    at = pa.array(np.append(0, np.cumsum(size)).astype(np.int32), mask=np.append(column.is_null().to_numpy(zero_copy_only=False), False))
    return pa.ListArray.from_arrays(at, values)


@arrow_udf(ArrayType(StringType()))
def _stem_arrays(s: pa.Array) -> pa.Array:
    return _in_list(s, _stemmed(s.flatten()))


def porter_stem_array(tokens) -> Column:
    """Column: array of tokens -> array of Porter stems (tokens > 3 chars)."""
    return _stem_arrays(tokens if isinstance(tokens, Column) else F.col(tokens))


@arrow_udf(ArrayType(ArrayType(StringType())))
def _stem_nested(s: pa.Array) -> pa.Array:
    inner = s.flatten()
    return _in_list(s, _in_list(inner, _stemmed(inner.flatten())))


def porter_stem_nested(sentences) -> Column:
    """Column: array of token arrays (sentences) -> stemmed, same shape."""
    return _stem_nested(sentences if isinstance(sentences, Column) else F.col(sentences))
