"""Profiles of a comment corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions import text


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def word_counts(df: DataFrame, column: str = "comment_body", filtered: bool = False, stopwords: Sequence[str] = W.STOPWORDS) -> DataFrame:
    """``(word, n)``; ``filtered`` keeps meaningful tokens only."""
    tokens = text.words(F.col(column))
    if filtered:
        tokens = text.meaningful_tokens(tokens, stopwords)
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def top_words(df: DataFrame, k: int = 20, column: str = "comment_body", filtered: bool = False) -> DataFrame:
    return word_counts(df, column, filtered).orderBy(F.desc("n"), "word").limit(k)


def word_totals(df: DataFrame, column: str = "comment_body") -> DataFrame:
    """Words and distinct words, from one pass of word counts."""
    return word_counts(df, column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"), F.count("*").alias("distinct_words"))


def approx_distinct_words(df: DataFrame, column: str = "comment_body", rsd: float = 0.02) -> DataFrame:
    """Distinct words by sketch: no shuffle of the vocabulary."""
    exploded = df.select(F.explode(text.words(F.col(column))).alias("word"))
    return exploded.agg(F.count("*").alias("words"), F.approx_count_distinct("word", rsd).alias("distinct_words"))


def meaningful_words(df: DataFrame, stop: DataFrame, column: str = "comment_body") -> DataFrame:
    """Distinct words that are not in the stop table ``(word)``."""
    return word_counts(df, column).select("word").join(stop, "word", "left_anti")


def corpus_profile(df: DataFrame, column: str = "comment_body", stopwords: Sequence[str] = W.STOPWORDS) -> DataFrame:
    """Records, words, distinct words, distinct words without stop words, words per distinct word."""
    profile = word_counts(df, column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("words"),
        F.count("*").alias("distinct_words"),
        F.count_if(~F.col("word").isin(*stopwords)).alias("meaningful_distinct_words"),
    )
    return profile.select(
        record_count(df).scalar().alias("records"),
        "*",
        F.round(F.try_divide("words", "distinct_words"), 2).alias("words_per_type"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``(bin, low, n)`` for equal-width bins from minimum to maximum; the maximum falls in the last bin.

    Bins without rows are left out. A constant column gets a range of one around its value.
    """
    value = F.col(column)
    margin = F.when(F.min(value) == F.max(value), 0.5).otherwise(0.0)
    bounds = df.agg(F.struct((F.min(value) - margin).alias("low"), (F.max(value) + margin).alias("high")).alias("bounds")).scalar()
    ranged = df.filter(value.isNotNull()).select(value.alias("x"), bounds.alias("b"))
    width = (F.col("b.high") - F.col("b.low")) / bins
    binned = ranged.select(
        F.least(F.floor((F.col("x") - F.col("b.low")) / width), F.lit(bins - 1)).cast("int").alias("bin"),
        "b",
    )
    counted = binned.groupBy("bin").agg(F.count("*").alias("n"), F.first("b").alias("b"))
    return counted.select("bin", (F.col("b.low") + F.col("bin") * width).alias("low"), "n")


def sign_summary(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per sign."""
    value = F.col(column)
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(value > 0).alias("positive"),
        F.count_if(value < 0).alias("negative"),
        F.count_if(value == 0).alias("neutral"),
    )
    names = ("positive", "negative", "neutral")
    rows = F.array(*[F.struct(F.lit(n).alias("sentiment"), F.col(n).alias("n"), F.col("total")) for n in names])
    return counts.select(F.inline(rows)).select(
        "sentiment", "n", F.round(F.try_divide(F.col("n") * 100.0, F.col("total")), 2).alias("percent")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows, non-null rows. A single scan."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("rows"),
                F.col(f"`{f.name}`").alias("non_null"),
            )
            for f in df.schema
        ]
    )
    return counts.select(F.inline(rows))
