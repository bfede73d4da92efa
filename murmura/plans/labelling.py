"""Preparation of comments for sentiment classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions import text
from murmura.operators.labels import attach_labels, drop_neutral, drop_zero_label, keep_binary
from murmura.operators.sentiment import lexicon_polarity
from murmura.sources.files import as_text_label


def score_comments(comments: DataFrame, lexicon: DataFrame, strip_links: bool = True, **scoring) -> DataFrame:
    """Add cleaned text, polarity, subjectivity and the sign label."""
    cleaned = comments.withColumn("cleaned_comment", text.clean_text(F.col("comment_body"), strip_links))
    scored = lexicon_polarity(cleaned, "cleaned_comment", lexicon, "comment_id", **scoring)
    return scored.withColumn("sentiment", text.sign_label(F.col("polarity")))


def label_comments(comments: DataFrame, lexicon: DataFrame, **scoring) -> DataFrame:
    """Clean, score, drop neutral rows, list the entities of the rest."""
    kept = drop_neutral(score_comments(comments, lexicon, **scoring))
    return kept.withColumn("entities", text.entity_names(F.col("comment_body")))


def with_manual_labels(labelled: DataFrame, manual: DataFrame, key: str = "comment_id") -> DataFrame:
    """Join manual labels by key, coerce them to numbers, drop missing and zero labels."""
    signed = labelled.withColumn("sentiment", text.recode_label(F.col("sentiment"), text.SENTIMENT_TO_SIGN))
    joined = attach_labels(signed, manual, key)
    return drop_zero_label(joined.withColumn("label", text.coerce_double(F.col("label"))))


def binary_sets(labelled: DataFrame, text_col: str = "comment_body", label_col: str = "label") -> DataFrame:
    """``(split, text, label)`` with labels 1 and -1 recoded to 1 and 0; others are dropped."""
    pairs = as_text_label(labelled, text_col, label_col).withColumn("split", F.lit(None)) if "split" not in labelled.columns else labelled.select(
        F.col(text_col).alias("text"), F.col(label_col).alias("label"), "split"
    )
    numbers = pairs.withColumn("label", text.coerce_double(F.col("label")))
    binary = keep_binary(drop_zero_label(numbers))
    return binary.withColumn("label", text.recode_label(F.col("label"), text.SIGN_TO_BINARY))


def size_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(split, before, after)`` row counts."""
    a = before.groupBy("split").agg(F.count("*").alias("before"))
    b = after.groupBy("split").agg(F.count("*").alias("after"))
    return a.join(b, "split", "left").withColumn("after", F.coalesce("after", F.lit(0)))
