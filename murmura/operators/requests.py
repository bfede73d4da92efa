"""Requests made of clauses: words, phrases, exact values, ranges and match-all, over several fields, in one plan.

A clause table has a row per clause: ``query_id``, ``grp`` (a number), ``must``,
``kind``, ``field``, ``value``, ``low``, ``high``. Clauses of a group are
alternatives. A document answers a request when it satisfies every group with
``must`` and at least one group at all. Kinds:

- ``words``: any analyzed word of ``value`` is held by a token of the field;
- ``phrase``: consecutive tokens of the field hold the analyzed words of ``value``;
- ``exact``: the field is ``value``, case-sensitive;
- ``range``: the field lies between ``low`` and ``high``, both included, null meaning open;
- ``all``: every document.

Words and phrases are scored by BM25, a phrase as one term with its own document
count; the other kinds select and add nothing to the relevance.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.operators.analysis import Analyzer
from murmura.operators.search import SearchIndex, match_term, phrase_hits, query_phrases, query_terms, ranked_page, weighted
from murmura.session import materialize

CLAUSES = "query_id string, grp int, must boolean, kind string, field string, value string, low string, high string"
_TEXT = ("words", "phrase")
_KEY = "_clause"


def _with_key(clauses: DataFrame) -> DataFrame:
    """Clauses with one key each; equal clauses of a group are one."""
    named = clauses.select("query_id", "grp", F.coalesce("must", F.lit(False)).alias("must"), "kind", "field", "value", "low", "high").distinct()
    return named.withColumn(_KEY, F.to_json(F.struct("query_id", "grp", "must", "kind", "field", "value"), {"ignoreNullFields": "false"}))


def _text_hits(indexes: Mapping[str, SearchIndex], clauses: DataFrame, analyzer: Analyzer) -> DataFrame:
    """``(query_id, grp, doc_id, relevance)`` of all words and phrases, field by field."""
    parts = []
    for field, index in indexes.items():
        own = clauses.filter(F.col("field") == field)
        asked = lambda kind: own.filter(F.col("kind") == kind).select(F.col(_KEY).alias("query_id"), F.col("value").alias("query"))  # noqa: B023, E731
        words = match_term(index, query_terms(asked("words"), analyzer)).select("query_id", "term", "boost", "doc_id", "tf", "length")
        phrases = phrase_hits(index, query_phrases(asked("phrase"), analyzer))
        phrases = phrases.select("query_id", F.lit("").alias("term"), F.lit(1).cast("bigint").alias("boost"), "doc_id", "tf", "length")
        hits = materialize(words.unionByName(phrases))
        parts.append(weighted(hits, index.size()).select(F.col("query_id").alias(_KEY), "doc_id", "weight"))
    scored = reduce(DataFrame.unionByName, parts)
    meta = clauses.filter(F.col("kind").isin(*_TEXT)).select(_KEY, "query_id", "grp")
    return scored.join(meta, _KEY).groupBy("query_id", "grp", "doc_id").agg(F.sum("weight").alias("relevance"))


def _holds(docs: DataFrame, clause: Column) -> Column:
    """Does a document's row satisfy an exact, range or match-all clause?"""
    out = clause["kind"] == "all"
    for field in docs.schema.fields:
        kind = field.dataType.simpleString()
        if kind.startswith(("array", "struct", "map")) or field.name == "doc_id":
            continue
        c = F.col(field.name)
        bound = lambda name: clause[name].try_cast(kind)  # noqa: B023, E731
        within = c.isNotNull() & (clause["low"].isNull() | (c >= bound("low"))) & (clause["high"].isNull() | (c <= bound("high")))
        exact = c.cast("string") == clause["value"]
        own = clause["field"] == field.name
        out = out | (own & (clause["kind"] == "exact") & F.coalesce(exact, F.lit(False))) | (own & (clause["kind"] == "range") & F.coalesce(within, F.lit(False)))
    return out


def answer_clauses(indexes: Mapping[str, SearchIndex], docs: DataFrame, clauses: DataFrame, analyzer: Analyzer = Analyzer()) -> DataFrame:
    """``(query_id, doc_id, relevance)`` of every document that answers a request.

    ``indexes`` holds an index per text field, ``docs`` the attributes by ``doc_id``. Where all alternatives of a ``must``
    group are text, its hits are the only candidates, and the other clauses are checked on them; the remaining requests'
    clauses are checked in one pass over the documents.
    """
    keyed = materialize(_with_key(clauses))
    is_text = F.col("kind").isin(*_TEXT)
    groups = keyed.groupBy("query_id", "grp").agg(F.bool_and(is_text).alias("text_only"), F.max("must").alias("must"))
    asked = groups.groupBy("query_id").agg(
        F.bool_or(F.col("text_only") & F.col("must")) | F.bool_and("text_only"), F.collect_list(F.when(F.col("must"), F.col("grp"))).alias("needs")
    )
    asked = materialize(asked.toDF("query_id", "driven", "needs"))
    clause = F.struct("query_id", "grp", "kind", "field", "value", "low", "high")
    checks = keyed.filter(~is_text).join(asked, "query_id")
    text = materialize(_text_hits(indexes, keyed, analyzer).join(asked.select("query_id", "driven"), "query_id"))

    found = text.filter("driven").groupBy("query_id", "doc_id").agg(F.collect_set("grp").alias("groups"), F.sum("relevance").alias("relevance"))
    own = checks.filter("driven").groupBy("query_id").agg(F.collect_list(clause).alias("_clauses"))
    placed = found.join(own, "query_id", "left").join(docs, "doc_id")
    held = F.transform(F.filter(F.coalesce("_clauses", F.array().cast(own.schema["_clauses"].dataType)), lambda c: _holds(docs, c)), lambda c: c["grp"])
    driven = placed.select("query_id", "doc_id", F.array_union("groups", held).alias("groups"), "relevance")

    # One array of the batch's clauses: as large as the requests, whatever the documents.
    rest = checks.filter(~F.col("driven")).agg(F.collect_list(clause)).scalar()
    passed = docs.withColumn("_clauses", rest)
    passed = passed.select("doc_id", F.explode(F.filter("_clauses", lambda c: _holds(docs, c))).alias("c")).select("c.query_id", "c.grp", "doc_id", F.lit(0.0).alias("relevance"))
    both = passed.unionByName(text.filter(~F.col("driven")).select("query_id", "grp", "doc_id", "relevance"))
    scanned = both.groupBy("query_id", "doc_id").agg(F.collect_set("grp").alias("groups"), F.sum("relevance").alias("relevance"))

    whole = driven.unionByName(scanned.select("query_id", "doc_id", "groups", "relevance")).join(asked.select("query_id", "needs"), "query_id")
    return whole.filter(F.size(F.array_except("needs", "groups")) == 0).select("query_id", "doc_id", "relevance")


def clause_page(
    indexes: Mapping[str, SearchIndex], docs: DataFrame, clauses: DataFrame, rows: int = 5, start: int = 0, analyzer: Analyzer = Analyzer()
) -> DataFrame:
    """One page per request of a clause table, by relevance and then id, with ``rank`` and the ``total`` of hits."""
    return ranked_page(materialize(answer_clauses(indexes, docs, clauses, analyzer)), "relevance", rows, start)
