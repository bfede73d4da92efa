"""Lexicon sentiment. Scores are rule-based; the lexicon is the caller's table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions import text
from murmura.functions.once import once
from murmura.operators.scale import bounded_rows

# Fixed values of the published rule-based model.
ALPHA = 15.0
NEGATION = -0.74
CAPS = 0.733
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS = 0.18, 0.96
DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
# Fixed values of the averaging model.
NEGATED_POLARITY = -0.5

# A lexicon up to this many words is carried inside the plan; a larger one is joined.
INLINE_LEXICON = 10_000


def one_entry_per_word(lexicon: DataFrame) -> DataFrame:
    """A lexicon with each word once: values of a word listed more often are averaged."""
    word, *values = lexicon.columns
    return lexicon.groupBy(word).agg(*[F.avg(v).alias(v) for v in values])


def _sentiment_tokens(c: Column) -> Column:
    """Whitespace tokens without outer punctuation, case kept. Two passes over the text beat two per token."""
    opened = F.regexp_replace(c, r"(^|\s)[^\p{L}\p{N}\s]+", "$1")
    return text.whitespace_tokens(F.regexp_replace(opened, r"[^\p{L}\p{N}\s]+(\s|$)", "$1"))


def _neighbours(tokens: Column, listed: Sequence[str] | None = None) -> Column:
    """Tokens, lower-cased, with position, case mark and the three tokens before; only those in ``listed`` if given.

    Shifted copies are zipped rather than looked up by index: arrays named
    inside a lambda would be rebuilt for every element.
    """
    lowered = F.transform(tokens, F.lower)

    def shifted(k: int) -> Column:
        return F.concat(F.array_repeat(F.lit(None).cast("string"), k), lowered)

    zipped = F.arrays_zip(
        F.transform(tokens, lambda t, i: i).alias("pos"),
        tokens.alias("token"),
        lowered.alias("word"),
        *[shifted(k).alias(f"b{k}") for k in (1, 2, 3)],
    )
    kept = F.filter(zipped, lambda x: x["word"].isin(*listed) if listed else x["word"].isNotNull())
    return F.transform(
        kept,
        lambda x: F.struct(
            x["pos"].alias("pos"), x["word"].alias("word"), _is_caps(x["token"]).alias("caps"), F.array(x["b1"], x["b2"], x["b3"]).alias("before")
        ),
    )


def _is_caps(t: Column) -> Column:
    return (F.upper(t) == t) & (F.lower(t) != t)


def _negated(t: Column, negations: Sequence[str]) -> Column:
    return t.isin(*negations) | t.endswith("n't")


def _adjusted(valence: Column, before: Column, known: Column, boosters: dict[str, float], negations: Sequence[str]) -> Column:
    """Valence after the boosters and negations in the three words before, nearest first.

    ``known`` flags which of those words are in the lexicon themselves; they do not modify.
    """
    damping = F.array(*[F.lit(DAMPING[k]) for k in (1, 2, 3)])

    def boost(word: Column) -> Column:
        out = F.lit(0.0)
        for size in sorted(set(boosters.values())):
            out = F.when(word.isin(*[w for w, s in boosters.items() if s == size]), size).otherwise(out)
        return out

    def step(v: Column, k: Column) -> Column:
        word = F.element_at(before, k)
        shifted = v + F.signum(v) * boost(word) * F.element_at(damping, k)
        turned = F.when(_negated(word, negations), shifted * NEGATION).otherwise(shifted)
        return F.when(word.isNull() | F.element_at(known, k), v).otherwise(turned)

    return F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), valence, step)


def _punctuation(c: Column) -> Column:
    marks = F.least(F.length(c) - F.length(F.replace(c, F.lit("!"))), F.lit(MAX_EXCLAMATIONS)) * F.lit(EXCLAMATION)
    questions = F.length(c) - F.length(F.replace(c, F.lit("?")))
    asked = F.when(questions > 3, MANY_QUESTIONS).when(questions > 1, questions * QUESTION).otherwise(0.0)
    return marks + asked


def _squash(df: DataFrame, total: Column, c: Column, out: str) -> DataFrame:
    """Add ``out``: the total raised by punctuation and squashed into [-1, 1]."""
    emphasized = once(df, _total=total, _emphasis=_punctuation(c))
    sign = F.signum("_total")
    raised = once(emphasized, _raised=F.col("_total") + sign * F.col("_emphasis"))
    value = F.col("_raised") / F.sqrt(F.col("_raised") * F.col("_raised") + ALPHA)
    return once(raised, **{out: F.coalesce(value, F.lit(0.0))}).drop("_total", "_emphasis", "_raised")


def lexicon_compound(
    df: DataFrame,
    column: str,
    lexicon: DataFrame,
    id_col: str,
    boosters: dict[str, float] | None = None,
    negations: Sequence[str] = tuple(W.NEGATIONS),
    out: str = "compound",
    inline_limit: int = INLINE_LEXICON,
) -> DataFrame:
    """Add a compound score in [-1, 1] from ``lexicon (word, valence)``.

    Word valences are adjusted for capitals, boosters and negations in the three
    words before, weighted around "but", summed, raised by ``!`` and ``?`` and
    squashed. A lexicon within ``inline_limit`` words costs no shuffle; a larger
    one is joined on the word, and only the matched words' partial sums move.
    """
    boosters = W.BOOSTERS if boosters is None else boosters
    c = F.col(column)
    lexicon = one_entry_per_word(lexicon)
    rows = bounded_rows(lexicon, inline_limit)
    tokens = _sentiment_tokens(c)
    mixed_caps = F.exists("_tokens", _is_caps) & ~F.forall("_tokens", _is_caps)
    but = F.array_position(F.transform("_tokens", F.lower), F.lit("but")) - 1

    def weighted(v: Column, pos: Column, caps: Column, mixed: Column, but_pos: Column, before: Column, known: Column) -> Column:
        raised = F.when(caps & mixed, v + F.signum(v) * CAPS).otherwise(v)
        adjusted = _adjusted(raised, before, known, boosters, negations)
        return adjusted * F.when((but_pos < 0) | (pos == but_pos), 1.0).when(pos < but_pos, BUT_BEFORE).otherwise(BUT_AFTER)

    if rows is not None:
        values = {r[0]: float(r[1]) for r in rows}
        if not values:
            return _squash(df, F.lit(0.0), c, out)
        listed = list(values)
        table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
        prepared = once(df, _tokens=tokens)
        hits = _neighbours(F.col("_tokens"), listed)
        prepared = once(prepared, _hits=hits, _mixed=mixed_caps, _but=but)

        def add(acc: Column, h: Column) -> Column:
            known = F.transform(h["before"], lambda w: F.coalesce(w.isin(*listed), F.lit(False)))
            valence = F.element_at(table, h["word"])
            return acc + weighted(valence, h["pos"], h["caps"], F.col("_mixed"), F.col("_but"), h["before"], known)

        return _squash(prepared, F.aggregate("_hits", F.lit(0.0), add), c, out).drop("_tokens", "_hits", "_mixed", "_but")

    entries = lexicon.toDF("_word", "_valence")
    # Each id and text once: rows that share an id are scored by their own text.
    prepared = once(df.select(F.col(id_col).alias("_id"), F.xxhash64(c).alias("_key"), c.alias("_text")).dropDuplicates(["_id", "_key"]), _tokens=_sentiment_tokens(F.col("_text"))).drop("_text")
    # The row's flags come before the words are exploded, or they would be computed once per word.
    found = once(prepared, _mixed=mixed_caps, _but=but).select("_id", "_key", "_mixed", "_but", F.inline(_neighbours(F.col("_tokens")))).join(entries, F.col("word") == F.col("_word"))
    for k in (1, 2, 3):
        named = entries.select(F.col("_word").alias(f"_w{k}"))
        found = found.join(named, F.get("before", F.lit(k - 1)) == F.col(f"_w{k}"), "left")
    known = F.array(*[F.col(f"_w{k}").isNotNull() for k in (1, 2, 3)])
    value = weighted(F.col("_valence").cast("double"), F.col("pos"), F.col("caps"), F.col("_mixed"), F.col("_but"), F.col("before"), known)
    sums = found.groupBy("_id", "_key").agg(F.sum(value).alias("_sum"))
    joined = df.join(sums, df[id_col].eqNullSafe(sums["_id"]) & (F.xxhash64(df[column]) == sums["_key"]), "left")
    return _squash(joined, F.coalesce("_sum", F.lit(0.0)), c, out).drop("_id", "_key", "_sum")


def lexicon_polarity(
    df: DataFrame,
    column: str,
    lexicon: DataFrame,
    id_col: str,
    intensifiers: dict[str, float] | None = None,
    negations: Sequence[str] = tuple(W.NEGATIONS),
    inline_limit: int = INLINE_LEXICON,
) -> DataFrame:
    """Add ``polarity`` and ``subjectivity``: means over the words of ``lexicon (word, polarity, subjectivity)``.

    The word before multiplies both by its intensity; a negation one or two
    words before multiplies the polarity by -0.5. Values stay within bounds.
    """
    intensifiers = {w: 1.3 if s > 0 else 0.7 for w, s in W.BOOSTERS.items()} if intensifiers is None else intensifiers
    lexicon = one_entry_per_word(lexicon)
    rows = bounded_rows(lexicon, inline_limit)

    def scored(p: Column, s: Column, before: Column) -> Column:
        factor = F.lit(1.0)
        for size in sorted(set(intensifiers.values())):
            factor = F.when(F.get(before, F.lit(0)).isin(*[w for w, x in intensifiers.items() if x == size]), size).otherwise(factor)
        turned = F.exists(F.slice(before, 1, 2), lambda w: F.coalesce(_negated(w, negations), F.lit(False)))
        polarity = p * factor * F.when(turned, NEGATED_POLARITY).otherwise(1.0)
        return F.struct(
            F.greatest(F.lit(-1.0), F.least(F.lit(1.0), polarity)).alias("p"),
            F.least(F.lit(1.0), s * factor).alias("s"),
        )

    tokens = _sentiment_tokens(F.col(column))
    if rows is not None:
        if not rows:
            return df.withColumns({"polarity": F.lit(0.0), "subjectivity": F.lit(0.0)})
        values = {r[0]: (float(r[1]), float(r[2])) for r in rows}
        listed = list(values)
        table = F.create_map(*[x for w, (p, s) in values.items() for x in (F.lit(w), F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")))])
        tokenized = once(df, _tokens=tokens)
        hits = _neighbours(F.col("_tokens"), listed)
        marks = F.transform(
            hits, lambda h: scored(F.element_at(table, h["word"])["p"], F.element_at(table, h["word"])["s"], h["before"])
        )

        def mean(name: str) -> Column:
            total = F.aggregate("_marks", F.lit(0.0), lambda a, m: a + m[name])
            return F.coalesce(F.try_divide(total, F.size("_marks")), F.lit(0.0))

        marked = once(tokenized, _marks=marks).drop("_tokens")
        return once(marked, polarity=mean("p"), subjectivity=mean("s")).drop("_marks")

    entries = lexicon.toDF("_word", "_polarity", "_subjectivity")
    texts = df.select(F.col(id_col).alias("_id"), F.xxhash64(column).alias("_key"), F.col(column).alias("_text")).dropDuplicates(["_id", "_key"])
    tokenized = once(texts, _tokens=_sentiment_tokens(F.col("_text")))
    found = tokenized.select("_id", "_key", F.inline(_neighbours(F.col("_tokens")))).join(entries, F.col("word") == F.col("_word"))
    marks = found.select("_id", "_key", scored(F.col("_polarity"), F.col("_subjectivity"), F.col("before")).alias("m"))
    means = marks.groupBy("_id", "_key").agg(F.avg("m.p").alias("_p"), F.avg("m.s").alias("_s"))
    joined = df.join(means, df[id_col].eqNullSafe(means["_id"]) & (F.xxhash64(df[column]) == means["_key"]), "left")
    return joined.withColumns({"polarity": F.coalesce("_p", F.lit(0.0)), "subjectivity": F.coalesce("_s", F.lit(0.0))}).drop("_id", "_key", "_p", "_s")


def majority_sentiment(df: DataFrame, key: str, column: str = "sentiment") -> DataFrame:
    """``(key, sentiment)``: the more frequent of positive and negative; a tie is positive."""
    counts = df.groupBy(key).agg(F.count_if(F.col(column) == "negative").alias("bad"), F.count_if(F.col(column) == "positive").alias("good"))
    return counts.select(key, F.when(F.col("bad") > F.col("good"), "negative").otherwise("positive").alias("sentiment"))
