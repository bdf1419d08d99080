"""Stems of single words in plain Python (Porter 1980): what the built-in expressions are compared with."""
import re

_VOWEL_RUNS = re.compile("[aeiou]+[^aeiou]+")

# Suffix tables of the published algorithm.
STEP_2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
          ("logi", "log")]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
          ("ness", "")]
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
          "ism", "ate", "iti", "ous", "ive", "ize"]
# The longest suffix that fits decides.
LONGEST_2, LONGEST_3 = (sorted(t, key=lambda p: -len(p[0])) for t in (STEP_2, STEP_3))
LONGEST_4 = sorted(STEP_4, key=len, reverse=True)


def _shape(word):
    """The word with y turned into a vowel or a consonant, as its neighbour decides."""
    out = ""
    for i, ch in enumerate(word):
        if ch == "y":
            ch = "y" if i == 0 or out[-1] in "aeiou" else "i"
        out += ch
    return out


def _measure(base):
    return len(_VOWEL_RUNS.findall(_shape(base)))


def _has_vowel(base):
    return any(ch in "aeiou" for ch in _shape(base))


def _double(word):
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] not in "aeiou"


def _short(word):
    s = _shape(word)
    return len(s) > 2 and s[-1] not in "aeiouwx" and word[-1] != "y" and s[-2] in "aeiou" and s[-3] not in "aeiou"


def _replace_longest(word, table):
    for suffix, new in table:
        if word.endswith(suffix):
            base = word[:-len(suffix)]
            return base + new if _measure(base) > 0 else word
    return word


def stem(word):
    """Stem of a lower-case word; words of up to two letters stay."""
    w = word.lower()
    if len(w) <= 2:
        return w
    # plurals
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    # past tense and -ing
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        for suffix in ("ed", "ing"):
            base = w[:-len(suffix)]
            if w.endswith(suffix) and _has_vowel(base):
                if base.endswith(("at", "bl", "iz")):
                    w = base + "e"
                elif _double(base) and base[-1] not in "lsz":
                    w = base[:-1]
                elif _measure(base) == 1 and _short(base):
                    w = base + "e"
                else:
                    w = base
                break
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _replace_longest(w, LONGEST_2)
    w = _replace_longest(w, LONGEST_3)
    for suffix in LONGEST_4:
        if w.endswith(suffix):
            base = w[:-len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                w = base
            break
    # final e and double l
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w
