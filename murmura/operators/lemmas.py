"""Noun lemmas checked against a table of known words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.operators.lookup import map_tokens
from murmura.session import materialize

# Endings of plural nouns and what takes their place (the published detachment rules for nouns).
DETACHMENTS = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]


def lemma_candidates(word: Column) -> Column:
    """The word itself and what each ending that fits leaves of it; an ending is never the whole word."""
    def detached(ending: str, tail: str) -> Column:
        stem = F.substring(word, F.lit(1), F.length(word) - len(ending))
        return F.when(word.endswith(ending) & (F.length(word) > len(ending)), F.concat(stem, F.lit(tail)))

    return F.array_distinct(F.array_compact(F.array(word, *[detached(e, t) for e, t in DETACHMENTS])))


def lemma_map(words: DataFrame, table: DataFrame) -> DataFrame:
    """``(word, lemma)`` of each distinct word that has a lemma in ``table``.

    ``table`` is ``(lemma)`` or ``(form, lemma)``; a form is an irregular one and goes before the rules (the smallest
    lemma where it is listed with several). Of the candidates that are known lemmas the shortest counts, then the
    smallest. Words without any are not in the result.
    """
    asked = words.select("word").filter(F.col("word").isNotNull()).distinct()
    known = table.select(F.col("lemma").alias("candidate")).filter(F.col("candidate").isNotNull()).distinct()
    tried = asked.select("word", F.explode(lemma_candidates(F.col("word"))).alias("candidate")).join(known, "candidate")
    ruled = tried.groupBy("word").agg(F.min(F.struct(F.length("candidate").alias("n"), F.col("candidate"))).alias("best"))
    ruled = ruled.select("word", F.col("best.candidate").alias("ruled"))
    if "form" not in table.columns:
        return ruled.withColumnRenamed("ruled", "lemma")
    forms = table.filter(F.col("form").isNotNull()).groupBy(F.col("form").alias("word")).agg(F.min("lemma").alias("irregular"))
    both = ruled.join(forms.join(asked, "word", "left_semi"), "word", "full_outer")
    return both.select("word", F.coalesce("irregular", "ruled").alias("lemma")).filter(F.col("lemma").isNotNull())


def lemmatize(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """``df`` with the tokens of an array column replaced by their lemmas, in place; unknown words stay as they are.

    A null array stays null, an empty one empty. The rules run once per distinct word, and only words that change travel.
    """
    words = df.select(F.explode(column).alias("word"))
    changed = materialize(lemma_map(words, table).filter("word <> lemma"))
    return map_tokens(df, column, changed.select(F.col("word").alias("token"), F.col("lemma").alias("value")), keep=True)
