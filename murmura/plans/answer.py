"""Answers to search requests: page, keywords, sentiment, in one plan for a whole batch of requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions import text
from murmura.operators.analysis import Analyzer
from murmura.operators.features import predict_sentiment
from murmura.operators.labels import fuse_keywords
from murmura.operators.scale import broadcast_if_small, top_n_per_group
from murmura.operators.search import SearchIndex, search_page
from murmura.operators.sentiment import lexicon_polarity, majority_sentiment
from murmura.operators.vectors import semantic_keywords
from murmura.session import materialize


def page_documents(page: DataFrame, docs: DataFrame, field: str = "comment_content", id_col: str = "id") -> DataFrame:
    """The page with its comment text: the page's ids are met by the texts, which stay where they are."""
    page = materialize(page)
    ids = broadcast_if_small(page.select("doc_id").distinct())
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(field).alias("text")).join(ids, "doc_id", "left_semi")
    return broadcast_if_small(page).join(texts, "doc_id")


def page_words(found: DataFrame) -> DataFrame:
    """``(query_id, keyword, count, df, n)`` of the keyword candidates on each page."""
    words = found.select("query_id", "doc_id", F.explode(text.keyword_candidates(F.col("text"))).alias("keyword"))
    counts = words.groupBy("query_id", "keyword").agg(F.count("*").alias("count"), F.count_distinct("doc_id").alias("df"))
    sizes = found.groupBy("query_id").agg(F.count("*").alias("n"))
    return counts.join(sizes, "query_id")


def page_topic_keywords(found: DataFrame) -> DataFrame:
    """``(query_id, keyword, count)``: topic words of every page with more than two comments.

    They are the page's words in two or more of its comments but not in nearly
    all, which is what topic models of the page are fitted on. All are returned:
    the fusion ranks them by count anyway, and no request's words depend on the
    others of its batch.
    """
    words = page_words(found).filter((F.col("n") > 2) & (F.col("df") >= 2) & (F.col("df") <= 0.95 * F.col("n")))
    return words.select("query_id", "keyword", "count")


def request_words(requests: DataFrame, filter_words: Sequence[str] = tuple(W.SEARCH_FILTER_WORDS)) -> DataFrame:
    """``(query_id, word)``: the words of the request and the opinion filter."""
    return requests.select("query_id", F.explode(F.concat(text.words(F.col("query")), F.array(*[F.lit(w) for w in filter_words]))).alias("word"))


def answer(
    index: SearchIndex,
    docs: DataFrame,
    requests: DataFrame,
    lexicon: DataFrame | None,
    vectors: DataFrame | None = None,
    rows: int = 5,
    rank: str = "relevance",
    analyzer: Analyzer = Analyzer(),
    opinion_only: bool = True,
    topic_words: bool = True,
    filter_words: Sequence[str] = tuple(W.SEARCH_FILTER_WORDS),
    scoring: dict | None = None,
    model: PipelineModel | None = None,
) -> DataFrame:
    """One row per valid request: overall sentiment, comments, keywords, communities, record count.

    Sentiment comes from ``model``, a fitted text classifier, or else from ``lexicon``, ``(word, polarity, subjectivity)``,
    whose further options are in ``scoring``. A request without hits gets empty lists and count 0.
    """
    page = search_page(index, requests, rows, rank=rank, analyzer=analyzer, opinion_only=opinion_only)
    # A page holds few rows per request and feeds every part of the answer.
    found = materialize(page_documents(page, docs))
    # Class 0 is negative; a neutral comment counts as positive.
    if model is not None:
        labelled = predict_sentiment(found, model)
    else:
        scored = lexicon_polarity(found, "text", lexicon, "doc_id", **(scoring or {}))
        labelled = scored.withColumn("sentiment", F.when(F.col("polarity") < 0, "negative").otherwise("positive"))
    comments = labelled.groupBy("query_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "text", "sentiment"))), lambda c: F.struct(c["text"].alias("text"), c["sentiment"].alias("sentiment"))
        ).alias("comments"),
        F.array_sort(F.collect_set("subreddit")).alias("subreddits"),
        F.max("total").alias("record_count"),
    )
    overall = majority_sentiment(labelled, "query_id")
    keywords = keyword_lists(answer_keywords(found, requests, vectors, topic_words, filter_words))
    asked = requests.filter(F.trim("query") != "").select("query_id")
    joined = asked.join(comments, "query_id", "left").join(overall, "query_id", "left").join(keywords, "query_id", "left")
    return joined.select(
        "query_id",
        F.coalesce("sentiment", F.lit("positive")).alias("sentiment"),
        F.coalesce("comments", F.array().cast("array<struct<text:string,sentiment:string>>")).alias("comments"),
        F.coalesce("keywords", F.array().cast("array<struct<keyword:string,count:bigint>>")).alias("keywords"),
        F.coalesce("subreddits", F.array().cast("array<string>")).alias("subreddits"),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
    )


def answer_keywords(found: DataFrame, requests: DataFrame, vectors: DataFrame | None, topic_words: bool = True, filter_words: Sequence[str] = tuple(W.SEARCH_FILTER_WORDS)) -> DataFrame:
    """``(query_id, keyword, count, rank)``: topic words fused with semantic words, best ten."""
    counts = page_words(found).select("query_id", "keyword", "count")
    if vectors is None:
        return top_n_per_group(counts, ["query_id"], [F.desc("count"), F.col("keyword")], 10)
    semantic = semantic_keywords(request_words(requests, filter_words), counts, vectors).select("query_id", "keyword", "count")
    topical = page_topic_keywords(found) if topic_words else counts.limit(0)
    return fuse_keywords(topical, semantic, keys=["query_id"])


def keyword_lists(ranked: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("rank", "keyword", "count")))
    return ranked.groupBy("query_id").agg(F.transform(ordered, lambda k: F.struct(k["keyword"].alias("keyword"), k["count"].alias("count"))).alias("keywords"))
