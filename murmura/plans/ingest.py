"""From landed comments to an index: filter, clean, add a segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura import schemas
from murmura import wordlists as W
from murmura.functions import text
from murmura.operators.segments import SegmentStore
from murmura.operators.sentiment import lexicon_compound
from murmura.sources import files


def opinion_filter(
    comments: DataFrame,
    lexicon: DataFrame,
    platforms: Sequence[str] = tuple(W.PLATFORMS),
    opinions: Sequence[str] = tuple(W.OPINION_WORDS),
    **scoring,
) -> DataFrame:
    """Comments of five words or more that name a platform, use an opinion word and are not neutral.

    Cheap native predicates come first; the score of the survivors is kept as ``sentiment``.
    """
    body = F.col("comment_body")
    relevant = comments.filter(text.min_tokens(body, 5)).filter(text.contains_any(body, platforms)).filter(text.contains_any(body, opinions))
    scored = lexicon_compound(relevant, "comment_body", lexicon, "comment_id", out="sentiment", **scoring)
    return scored.filter(text.is_opinionated(F.col("sentiment")))


def strip_emojis(comments: DataFrame) -> DataFrame:
    return comments.withColumns({c: text.strip_emoji(F.col(c)) for c in ("post_content", "comment_body")})


def search_documents(comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted search documents, and the rows that lack a required field."""
    return files.enforce_schema(files.to_search_docs(strip_emojis(comments)), schemas.SEARCH_DOCS)


def ingest(comments: DataFrame, lexicon: DataFrame, store: SegmentStore, name: str, **filters) -> int | None:
    """Filter and clean new comments and add them to the stored documents and their index.

    Writes the batch's own rows only; the number of its segment, or None where ``name`` was ingested before.
    """
    kept = opinion_filter(files.with_dates(files.fill_defaults(comments)), lexicon, **filters)
    docs, _ = search_documents(kept)
    return store.add(docs, name)
