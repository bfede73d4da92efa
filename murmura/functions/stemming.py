"""English stemmer after the published Porter2 (Snowball English) description, run on the distinct tokens of a batch."""

from __future__ import annotations

import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Suffixes, endings and exceptional forms of the published algorithm.
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_STEP2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion",
    "biliti": "ble", "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous",
    "iviti": "ive", "fulli": "ful", "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate",
    "alli": "al", "bli": "ble",
}
_STEP3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
_STEP4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic",
)
_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    **{w: w for w in ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")},
}
_STOP_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}

_REGION = re.compile(r"[^aeiouy]*[aeiouy]+[^aeiouy]")
_VOWEL = re.compile(r"[aeiouy]")
_SHORT_END = re.compile(r"(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _regions(w: str) -> tuple[int, int]:
    prefix = re.match(r"gener|commun|arsen", w)
    found = prefix or _REGION.match(w)
    r1 = found.end() if found else len(w)
    second = _REGION.match(w, r1)
    return r1, second.end() if second else len(w)


def _after_deletion(w: str, r1: int) -> str:
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if w.endswith(_DOUBLES):
        return w[:-1]
    return w + "e" if _SHORT_END.search(w) and r1 >= len(w) else w


def stem(word: str) -> str:
    """Stem of one lower-case word."""
    if len(word) <= 2:
        return word
    if word in _SPECIAL:
        return _SPECIAL[word]
    w = word.removeprefix("'")
    w = re.sub(r"^y|(?<=[aeiouy])y", "Y", w)
    r1, r2 = _regions(w)
    for tail in ("'s'", "'s", "'"):
        if w.endswith(tail):
            w = w[: -len(tail)]
            break
    # plurals
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and _VOWEL.search(w[:-2]):
        w = w[:-1]
    if w in _STOP_AFTER_1A:
        return w.lower()
    # past tense and gerund
    for tail in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(tail):
            base = w[: -len(tail)]
            if tail.startswith("eed"):
                w = base + "ee" if len(base) >= r1 else w
            elif _VOWEL.search(base):
                w = _after_deletion(base, r1)
            break
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    # derivational endings
    for tail in sorted([*_STEP2, "ogi", "li"], key=len, reverse=True):
        if w.endswith(tail):
            base = w[: -len(tail)]
            if len(base) >= r1:
                if tail == "ogi":
                    w = w[:-1] if base.endswith("l") else w
                elif tail == "li":
                    w = base if base.endswith(tuple("cdeghkmnrt")) else w
                else:
                    w = base + _STEP2[tail]
            break
    for tail in sorted([*_STEP3, "ative"], key=len, reverse=True):
        if w.endswith(tail):
            base = w[: -len(tail)]
            if tail == "ative":
                w = base if len(base) >= r2 else w
            elif len(base) >= r1:
                w = base + _STEP3[tail]
            break
    for tail in sorted([*_STEP4, "ion"], key=len, reverse=True):
        if w.endswith(tail):
            base = w[: -len(tail)]
            if len(base) >= r2 and (tail != "ion" or base.endswith(("s", "t"))):
                w = base
            break
    # final e and l
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _SHORT_END.search(w[:-1]))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem arrays of tokens; each distinct token of the Arrow batch is stemmed once."""
    encoded = tokens.flatten().dictionary_encode()
    stems = pa.array([stem(t) for t in encoded.dictionary.to_pylist()], pa.string())
    sizes = pa.array([0 if n is None else n for n in tokens.value_lengths().to_pylist()], pa.int32())
    ends = pc.cumulative_sum(sizes).to_pylist()
    offsets = pa.array([0, *ends], pa.int32())
    return pa.ListArray.from_arrays(offsets, stems.take(encoded.indices), mask=tokens.is_null())
