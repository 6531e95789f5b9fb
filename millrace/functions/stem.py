"""English stems by the published Porter2 rules, for words that are lower-cased already."""

from __future__ import annotations

import re
from functools import lru_cache

# The algorithm's word lists, suffixes and letter classes.
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
         "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
         "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
KEPT_AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
FIRST_REGION = re.compile(r"(?:gener|commun|arsen)|.*?[aeiouy][^aeiouy]")
REGION = re.compile(r".*?[aeiouy][^aeiouy]")
VOWEL = re.compile("[aeiouy]")
DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
SHORT = re.compile(r"(?:^|.*[^aeiouy])[aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$")
SECOND = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize",
          "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
          "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
          "fulli": "ful", "lessli": "less", "li": ""}
BEFORE_LI = "cdeghkmnrt"
THIRD = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
         "ative": ""}
FOURTH = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive",
          "ize", "ion")


def _longest(word: str, suffixes) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def _is_short(stem: str) -> bool:
    """Whether it ends in a short syllable."""
    return bool(SHORT.match(stem))


def _regions(word: str) -> tuple[int, int]:
    first = FIRST_REGION.match(word)
    r1 = first.end() if first else len(word)
    second = REGION.match(word, r1)
    return r1, second.end() if second else len(word)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and VOWEL.search(word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    stem = word[:len(word) - len(suffix)]
    if suffix.startswith("eed"):
        return stem + "ee" if len(stem) >= r1 else word
    if not suffix or not VOWEL.search(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if stem.endswith(DOUBLE):
        return stem[:-1]
    return stem + "e" if r1 >= len(stem) and _is_short(stem) else stem


@lru_cache(maxsize=50_000)
def stem(word: str) -> str:
    """The stem of a lower-case word; words of other scripts stay as they are."""
    if len(word) < 3:
        return word
    if word in WHOLE:
        return WHOLE[word]
    # A consonant y is written Y.
    word = re.sub(r"(?:^|(?<=[aeiouy]))y", "Y", word)
    r1, r2 = _regions(word)
    word = _plural(word)
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _past(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in "aeiouy":
        word = word[:-1] + "i"
    suffix = _longest(word, SECOND)
    left = word[:len(word) - len(suffix)]
    if suffix and len(left) >= r1 and (suffix != "ogi" or left.endswith("l")) and (suffix != "li" or left[-1:] in tuple(BEFORE_LI)):
        word = left + SECOND[suffix]
    suffix = _longest(word, THIRD)
    left = word[:len(word) - len(suffix)]
    if suffix and len(left) >= (r2 if suffix == "ative" else r1):
        word = left + THIRD[suffix]
    suffix = _longest(word, FOURTH)
    left = word[:len(word) - len(suffix)]
    if suffix and len(left) >= r2 and (suffix != "ion" or left[-1:] in ("s", "t")):
        word = left
    left = word[:-1]
    if word.endswith("e") and (len(left) >= r2 or len(left) >= r1 and not _is_short(left)):
        word = left
    elif word.endswith("ll") and len(left) >= r2:
        word = left
    return word.replace("Y", "y")
