"""Schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in fields.items()])


COMMENTS = _struct(
    subreddit=_STRING,
    title=_STRING,
    post_id=_STRING,
    post_url=_STRING,
    post_content=_STRING,
    comment_id=_STRING,
    comment_body=_STRING,
    comment_author=_STRING,
    comment_score=_INT,
    created=_DOUBLE,
    created_iso=_STRING,
    readable_date=_STRING,
    sentiment=_DOUBLE,
)

SEARCH_DOCS = _struct(
    required=("id", "post_id", "title", "comment_id"),
    id=_STRING,
    post_id=_STRING,
    subreddit=_STRING,
    title=_STRING,
    url=_STRING,
    post_content=_STRING,
    comment_id=_STRING,
    comment_content=_STRING,
    comment_author=_STRING,
    score=_INT,
    datetime=T.TimestampType(),
    keywords=T.ArrayType(_STRING),
    keyword_scores=T.ArrayType(T.FloatType()),
    reading_time_minutes=T.FloatType(),
)

REQUESTS = _struct(required=("query_id",), query_id=_STRING, query=_STRING, subreddits=T.ArrayType(_STRING), start_date=_STRING)

VOCABULARY = _struct(token=_STRING, id=_LONG)

_SERIES = T.ArrayType(_DOUBLE)
_METRICS = _struct(accuracy=_SERIES, f1=_SERIES, precision=_SERIES, recall=_SERIES)

RUN_METRICS = _struct(
    train_loss=_SERIES,
    val_loss=_SERIES,
    test_loss=_SERIES,
    train_metrics=_METRICS,
    val_metrics=_METRICS,
    test_metrics=_METRICS,
    steps=T.ArrayType(_LONG),
    val_steps=T.ArrayType(_LONG),
    grad_norms=_SERIES,
    grad_steps=T.ArrayType(_LONG),
)
