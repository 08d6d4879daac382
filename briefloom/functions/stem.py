"""Porter stemming (Porter 1980), one word at a time."""

from __future__ import annotations

# The published suffix rules, per step, longest match first by construction.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


# The rules by length, the longest first.
STEP_2, STEP_3 = (tuple(sorted(rules, key=lambda rule: -len(rule[0]))) for rules in (STEP_2, STEP_3))
STEP_4 = tuple(sorted(STEP_4, key=len, reverse=True))


def _kinds(word: str) -> str:
    """Vowel or consonant, letter by letter: ``'trees' -> 'ccvvc'``."""
    out, last = [], ""
    for letter in word:
        last = "v" if letter in "aeiou" or (letter == "y" and last == "c") else "c"
        out.append(last)
    return "".join(out)


def _measure(stem: str) -> int:
    return _kinds(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _kinds(stem)


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _kinds(word)[-1] == "c"


def _short_end(word: str) -> bool:
    """Ends consonant, vowel, consonant, the last not being w, x or y."""
    return len(word) >= 3 and word[-1] not in "wxy" and _kinds(word)[-3:] == "cvc"


def _replace(word: str, rules, least: int) -> str:
    """Apply the longest matching rule if the stem before it is long enough."""
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + new if _measure(stem) >= least else word
    return word


def _plural(word: str) -> str:
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            return word[: len(word) - len(suffix)] + new
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: len(word) - len(suffix)]
        if word.endswith(suffix) and _has_vowel(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
        if word.endswith(suffix):
            return word
    return word


def _drop_ending(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t")))
            return stem if fits else word
    return word


def porter_stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters stay as they are."""
    if len(word) < 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, STEP_2, 1)
    word = _replace(word, STEP_3, 1)
    word = _drop_ending(word)
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word
