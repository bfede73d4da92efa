"""Text, typing and cleaning expressions. All stay JVM-side."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions.once import let

# Code-point ranges removed as emoji. The last range is wide on
# purpose: it also takes CJK, kana, Hangul and full-width forms.
EMOJI_RANGES = [
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F700, 0x1F77F),
    (0x1F780, 0x1F7FF),
    (0x1F800, 0x1F8FF),
    (0x1F900, 0x1F9FF),
    (0x1FA00, 0x1FA6F),
    (0x1FA70, 0x1FAFF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
]

# The alphabet of the character encoding, in index order.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.,':;"

ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


# Word tokenizer: pattern and replacement, applied in turn.
TREEBANK_STEPS = [
    (r"(\p{L})([nN]'[tT])([^\p{L}\p{N}_]|$)", "$1 $2$3"),
    (r"'([sS]|[mM]|[dD]|[lL][lL]|[rR][eE]|[vV][eE])([^\p{L}\p{N}_]|$)", " '$1$2"),
    (r"([;:@#$%&?!()\[\]{}<>\"*|~`^=+/\\…«»“”„])", " $1 "),
    (r"(--+)", " $1 "),
    (r",([^0-9])", " , $1"),
    (r",$", " ,"),
    (r"\.(\s|$)", " . $1"),
]


# --- cleaning -----------------------------------------------------------------


def strip_emoji(c: Column) -> Column:
    ranges = "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in EMOJI_RANGES)
    return F.regexp_replace(c, f"[{ranges}]+", "")


def strip_urls(c: Column) -> Column:
    """Lower-case, then drop everything from ``http`` or ``www`` to the next space."""
    return F.regexp_replace(F.lower(c), r"http\S+|www\S+", "")


def words(c: Column) -> Column:
    """Lower-cased runs of letters, digits and underscore."""
    spaced = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", " ")
    return F.filter(F.split(spaced, r"\s+"), lambda t: t != "")


def whitespace_tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def tokenize_words(c: Column) -> Column:
    """Treebank-style subset: contractions and punctuation become their own tokens.

    Splits ``n't 's 'm 'd 'll 're 've``, brackets, quotes and the usual marks,
    commas outside numbers and a full stop at the end of a word.
    """
    for pattern, replacement in TREEBANK_STEPS:
        c = F.regexp_replace(c, pattern, replacement)
    return whitespace_tokens(c)


def lemma_rule(t: Column) -> Column:
    """Noun-plural suffix rules; the first that fits wins. ``was`` becomes ``wa`` by design."""
    def cut(n: int, tail: str = "") -> Column:
        return F.concat(F.substring(t, F.lit(1), F.length(t) - n), F.lit(tail))

    return (
        F.when(t.endswith("sses") | t.endswith("xes") | t.endswith("zzes") | t.endswith("ches") | t.endswith("shes"), cut(2))
        .when(t.endswith("ies") & (F.length(t) > 4), cut(3, "y"))
        .when(t.endswith("ss") | t.endswith("us") | t.endswith("is") | (F.length(t) < 3), t)
        .when(t.endswith("s"), cut(1))
        .otherwise(t)
    )


def lemmas(tokens: Column, irregular: dict[str, str] | None = None) -> Column:
    """Lemma of every token as a noun: the irregular form where listed, else the suffix rule."""
    irregular = W.IRREGULAR_PLURALS if irregular is None else irregular
    if not irregular:
        return F.transform(tokens, lemma_rule)
    table = F.create_map(*[F.lit(x) for pair in irregular.items() for x in pair])
    return F.transform(
        tokens, lambda t: F.when(t.isin(*irregular), F.element_at(table, t)).otherwise(lemma_rule(t))
    )


def drop_stopwords(tokens: Column, stopwords: Sequence[str] = W.STOPWORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*stopwords))


def clean_text(c: Column, strip_links: bool = True, stopwords: Sequence[str] = W.STOPWORDS) -> Column:
    """Lower, drop links, tokenize, lemmatize, drop stop words, rejoin. Null becomes ''."""
    base = strip_urls(c) if strip_links else F.lower(c)
    return F.coalesce(F.array_join(drop_stopwords(lemmas(tokenize_words(base)), stopwords), " "), F.lit(""))


@cache
def accent_table() -> tuple[str, str]:
    """Every character whose canonical decomposition is one kept ASCII character plus marks."""
    kept = set(ALPHABET)
    source, target = [], []
    for code in range(0x80, 0x2FA20):
        char = chr(code)
        base = [x for x in unicodedata.normalize("NFD", char) if unicodedata.category(x) != "Mn"]
        if len(base) == 1 and base[0] != char and base[0] in kept:
            source.append(char)
            target.append(base[0])
    return "".join(source), "".join(target)


def ascii_fold(c: Column) -> Column:
    """Decompose, drop marks, keep ASCII letters and ``.,;:'``."""
    source, target = accent_table()
    return F.regexp_replace(F.translate(c, source, target), r"[^A-Za-z.,;:']", "")


def clean_line(c: Column) -> Column:
    """Lower, strip, delete ASCII punctuation and line breaks."""
    return F.translate(F.regexp_replace(F.lower(c), r"^\s+|\s+$", ""), ASCII_PUNCTUATION + "\n", "")


def char_ids(c: Column, alphabet: str = ALPHABET) -> Column:
    """Position of every character in ``alphabet``; -1 where it is not a member."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    return F.transform(chars, lambda x: F.call_function("locate", x, F.lit(alphabet)) - 1)


def char_one_hot(c: Column, alphabet: str = ALPHABET) -> Column:
    """One row of ``len(alphabet)`` marks per character; all zero where it is not a member."""
    places = F.sequence(F.lit(0), F.lit(len(alphabet) - 1))
    return F.transform(char_ids(c, alphabet), lambda x: F.transform(places, lambda k: (k == x).cast("int")))


# --- ingest defaults, dates ---------------------------------------------------


def or_placeholder(c: Column, placeholder: str) -> Column:
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(placeholder)).otherwise(c)


def epoch_timestamp(c: Column) -> Column:
    return F.timestamp_seconds(c)


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def readable_date(ts: Column) -> Column:
    return F.date_format(ts, "dd MMMM yyyy")


def to_iso_z(ts: Column, compat: bool = False) -> Column:
    """ISO-8601 with ``Z``. ``compat`` repeats the seconds in place of the fraction."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'.'ss'Z'" if compat else "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_start_date(c: Column) -> Column:
    """``YYYY-MM-DD`` as the first instant of that day; anything else is null, which means no filter."""
    shaped = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c)
    return F.try_to_timestamp(shaped, F.lit("yyyy-MM-dd"))


# --- labels and numbers -------------------------------------------------------


def sign_label(c: Column) -> Column:
    return F.when(c > 0, "positive").when(c < 0, "negative").otherwise("neutral")


# Label recodings in use.
SENTIMENT_TO_SIGN = {"positive": 1.0, "negative": -1.0}
SIGN_TO_BINARY = {1.0: 1, -1.0: 0}
TEXT_SIGN_TO_BINARY = {"1": 1, "-1": 0}
SIGN_TO_CLASS = {-1: 0, 0: 1, 1: 2}


def recode_label(c: Column, mapping: dict) -> Column:
    """Look a label up in ``mapping``; unlisted labels become null."""
    first, *rest = mapping.items()
    out = F.when(c == F.lit(first[0]), F.lit(first[1]))
    for old, new in rest:
        out = out.when(c == F.lit(old), F.lit(new))
    return out


def coerce_double(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def softmax(scores: Column) -> Column:
    """Class probabilities, shifted by the maximum for stability."""
    exps = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(exps, F.lit(0.0), lambda a, x: a + x)
    return F.transform(exps, lambda x: x / total)


def argmax(scores: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def class_label(index: Column) -> Column:
    """Class 0 is negative; every other class counts as positive."""
    return F.when(index == 0, "negative").when(index.isNotNull(), "positive")


# --- predicates ---------------------------------------------------------------


def min_tokens(c: Column, n: int = 5) -> Column:
    return F.size(whitespace_tokens(c)) >= n


def _holds_any(lowered: Column, terms: Sequence[str]) -> Column:
    """Substring test on lower-cased text. Terms that hold another term are implied by it and skipped."""
    minimal: list[str] = []
    for term in sorted({t.lower() for t in terms}, key=lambda t: (len(t), t)):
        if not any(shorter in term for shorter in minimal):
            minimal.append(term)
    out = F.lit(False)
    for term in minimal:
        out = out | lowered.contains(term)
    return out


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    """Case-insensitive substring test."""
    return let(F.lower(c), lambda t: _holds_any(t, terms))


def tag_topics(c: Column, topics: dict[str, Sequence[str]] | None = None) -> Column:
    """Names of the topics with at least one term in the text, in the order given."""
    topics = W.TOPICS if topics is None else topics

    def names(t: Column) -> Column:
        return F.array(*[F.when(_holds_any(t, terms), F.lit(name)) for name, terms in topics.items()])

    return F.array_compact(let(F.lower(c), names))


def is_opinionated(compound: Column, threshold: float = 0.25) -> Column:
    """Strictly beyond the threshold on either side."""
    return F.abs(compound) > threshold


def meaningful_tokens(tokens: Column, stopwords: Sequence[str] = W.STOPWORDS) -> Column:
    """No stop words, numbers, number-letter mixes such as ``2nd``, single characters or link leftovers."""
    return F.filter(
        tokens,
        lambda t: ~t.isin(*stopwords, *W.LINK_TOKENS) & ~t.rlike(r"^\p{Nd}+[a-z]*$") & (F.length(t) > 1),
    )


def keyword_candidates(c: Column, stopwords: Sequence[str] = W.STOPWORDS) -> Column:
    """Lemmas of alphabetic non-stop tokens, longer than two characters."""
    alphabetic = F.filter(tokenize_words(F.lower(c)), lambda t: t.rlike(r"^\p{L}+$") & ~t.isin(*stopwords))
    return F.filter(lemmas(alphabetic), lambda t: F.length(t) > 2)


# --- grams --------------------------------------------------------------------


def grams_of_sizes(token: Column, sizes: Column) -> Column:
    """All substrings whose length is in the array ``sizes``, repeats included."""
    fitting = F.filter(sizes, lambda n: n <= F.length(token))
    return F.flatten(
        F.transform(
            fitting, lambda n: F.transform(F.sequence(F.lit(1), F.length(token) - n + 1), lambda i: F.substring(token, i, n))
        )
    )


def ngrams(token: Column, low: int = 2, high: int = 15) -> Column:
    """All substrings of length ``low`` to ``high``; shorter tokens yield none."""
    return grams_of_sizes(token, F.array(*[F.lit(n) for n in range(low, high + 1)]))


def entity_names(c: Column, gazetteer: Sequence[str] = W.PLATFORMS) -> Column:
    """Distinct gazetteer names found in the text and capitalised spans of up to three words, sorted."""
    known = F.array_compact(let(F.lower(c), lambda t: F.array(*[F.when(t.contains(name), F.lit(name)) for name in gazetteer])))
    spans = F.regexp_extract_all(c, F.lit(r"(\p{Lu}\p{L}+(?: \p{Lu}\p{L}+){0,2})"), F.lit(1))
    return F.array_sort(F.array_distinct(F.concat(known, spans)))
