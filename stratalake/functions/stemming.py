"""English word stems by Porter's five steps (An algorithm for suffix stripping, 1980), and stop words."""

from __future__ import annotations

import re
from functools import lru_cache

#: Common words without meaning of their own.
STOP_WORDS = frozenset("a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split())
#: Fixed values of the published steps: suffixes and what replaces them, the longest that fits a word first.
_PLURALS = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
_SECOND = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
_THIRD = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_FOURTH = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """c or v for each letter; y is a vowel after a consonant."""
    out: list[str] = []
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(word: str) -> int:
    """How often a run of vowels is followed by one of consonants."""
    return len(re.findall("v+c+", _shape(word)))


def _has_vowel(word: str) -> bool:
    return "v" in _shape(word)


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    """Whether a word ends in consonant, vowel, consonant, the last not being w, x or y."""
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _suffix(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _replaced(word: str, rules: tuple[tuple[str, str], ...], least: int) -> str:
    """`word` with its longest suffix replaced, if what stands before it has the least measure."""
    table = dict(rules)
    end = _suffix(word, table)
    if end is None or _measure(word[: len(word) - len(end)]) < least:
        return word
    return word[: len(word) - len(end)] + table[end]


def _past_and_continuous(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    end = _suffix(word, ("ed", "ing"))
    if end is None or not _has_vowel(word[: -len(end)]):
        return word
    word = word[: -len(end)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _doubled(word) and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if _measure(word) == 1 and _short_end(word) else word


def _bare(word: str) -> str:
    end = _suffix(word, _FOURTH)
    if end is None or _measure(word[: -len(end)]) < 2 or (end == "ion" and word[-4:-3] not in ("s", "t")):
        return word
    return word[: -len(end)]


@lru_cache(maxsize=100_000)
def porter(word: str) -> str:
    """The stem of a word in lower case; words of one or two letters, and those with other characters than a-z, stay."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    word = _past_and_continuous(_replaced(word, _PLURALS, 0))
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _bare(_replaced(_replaced(word, _SECOND, 1), _THIRD, 1))
    if word.endswith("e") and (_measure(word[:-1]) > 1 or (_measure(word[:-1]) == 1 and not _short_end(word[:-1]))):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word
