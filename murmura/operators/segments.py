"""Documents and their index as segments: a batch writes only its own rows.

Every batch is a segment: Parquet folders of its documents, postings, grams,
vocabulary and attributes. What a batch replaces in older segments is a table of
(segment, doc_id), so nothing older is rewritten. A manifest row commits the
segment; folders without one are leftovers of a failed batch and are
overwritten. Searches read all live segments and leave out what was replaced;
``merge`` writes their live rows as one segment.

One writer at a time. A batch that was committed under the same name is skipped,
so a replayed batch counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.operators.analysis import Analyzer
from murmura.operators.scale import broadcast_if_small
from murmura.operators.search import SearchIndex, build_index
from murmura.session import materialize

_MANIFEST = "segment int, name string, merged array<int>, n bigint, total bigint"
_REPLACED = "of int, doc_id string, length int"
_PARTS = ("documents", "postings", "docs", "grams", "vocabulary")


class SegmentStore:
    """Search documents under ``path``, one row per ``key``: of two versions the one with the highest ``order`` wins, the later batch on a tie."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "id",
        order: str = "datetime",
        field: str = "comment_content",
        analyzer: Analyzer = Analyzer(),
        attributes: Sequence[str] = ("subreddit", "datetime", "score"),
        filter_words: Sequence[str] = tuple(W.SEARCH_FILTER_WORDS),
    ):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order
        self.field, self.analyzer, self.attributes, self.filter_words = field, analyzer, tuple(attributes), tuple(filter_words)

    # --- what is there -------------------------------------------------------------

    def _committed(self) -> list[Row]:
        """Manifest rows, one per batch since the last merge and a few numbers each."""
        try:
            return sorted(self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest").collect())
        except AnalysisException:
            return []

    def segments(self) -> list[int]:
        rows = self._committed()
        gone = {k for r in rows for k in r["merged"]}
        return [r["segment"] for r in rows if r["segment"] not in gone]

    def _read(self, part: str, segments: list[int]) -> DataFrame:
        paths = [f"{self.path}/{part}/segment={k}" for k in segments]
        return self.spark.read.option("basePath", f"{self.path}/{part}").parquet(*paths)

    def replaced(self) -> DataFrame:
        """``(of, doc_id, length)``: rows of live segments that a later one replaced."""
        live = self.segments()
        if not live:
            return self.spark.createDataFrame([], _REPLACED)
        return self._read("replaced", live).filter(F.col("of").isin(*live)).select("of", "doc_id", "length")

    def _live(self, part: str, segments: list[int], id_col: str = "doc_id") -> DataFrame:
        gone = broadcast_if_small(self.replaced().select(F.col("of").alias("segment"), F.col("doc_id").alias(id_col)))
        return self._read(part, segments).join(gone, ["segment", id_col], "left_anti")

    def documents(self) -> DataFrame | None:
        """Live documents; None before the first batch."""
        live = self.segments()
        return self._live("documents", live, self.key).drop("segment") if live else None

    def index(self) -> SearchIndex:
        """The index of all live segments."""
        live = self.segments()
        if not live:
            raise ValueError(f"no segment under {self.path}")
        rows = {r["segment"]: r for r in self._committed()}
        gone = self.replaced().agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"))
        n, total = (sum(rows[k][c] for k in live) for c in ("n", "total"))
        corpus = gone.select((F.lit(n) - F.col("n")).alias("n"), (F.lit(total) - F.col("total")).alias("total"))
        vocabulary = self._read("vocabulary", live).groupBy("token").agg(F.sum("docs").alias("docs"))
        postings, docs = (self._live(part, live).drop("segment") for part in ("postings", "docs"))
        return SearchIndex(postings, docs, self._read("grams", live).drop("segment"), vocabulary, corpus, segmented=len(live) > 1)

    # --- changes -------------------------------------------------------------------

    def add(self, batch: DataFrame, name: str) -> int | None:
        """Write a batch of documents as a segment; its number, or None where ``name`` was committed before."""
        rows = self._committed()
        if any(r["name"] == name for r in rows):
            return None
        live, segment = self.segments(), 1 + max((r["segment"] for r in rows), default=-1)
        latest = batch.groupBy(F.col(self.key).alias("_key")).agg(F.max_by(F.struct(*batch.columns), F.col(self.order)).alias("_row")).select("_row.*")
        latest = materialize(latest)
        replaced = self.spark.createDataFrame([], _REPLACED)
        if live:
            # Narrow columns only: ids, lengths and the order of live documents that the batch brings again.
            order = F.col(self.order)
            ids = broadcast_if_small(latest.select(self.key))
            old = self._live("documents", live, self.key).select(self.key, "segment", order.alias("_old")).join(ids, self.key, "left_semi")
            lengths = self._live("docs", live).select(F.col("doc_id").alias(self.key), "length")
            old = materialize(old.join(lengths, self.key))
            stale = latest.select(self.key, self.order).join(old, self.key).filter(F.col("_old") > order).select(self.key)
            stale = materialize(stale)
            latest = latest.join(broadcast_if_small(stale), self.key, "left_anti").select(*batch.columns)
            replaced = old.join(broadcast_if_small(stale), self.key, "left_anti").select(F.col("segment").alias("of"), F.col(self.key).alias("doc_id"), "length")
        return self._write(latest, replaced, segment, name, [])

    def merge(self) -> int | None:
        """Write the live rows of all segments as one; the old folders are no longer read."""
        live = self.segments()
        if len(live) < 2:
            return None
        segment = 1 + max(r["segment"] for r in self._committed())
        return self._write(self.documents(), self.spark.createDataFrame([], _REPLACED), segment, f"merge-{segment}", live)

    def _write(self, documents: DataFrame, replaced: DataFrame, segment: int, name: str, merged: list[int]) -> int:
        at = f"/segment={segment}"
        documents.write.mode("overwrite").parquet(f"{self.path}/documents{at}")
        stored = self.spark.read.parquet(f"{self.path}/documents{at}")
        index = build_index(stored, self.field, self.key, self.analyzer, self.attributes, self.filter_words).write(self.path, "overwrite", suffix=at)
        replaced.write.mode("overwrite").parquet(f"{self.path}/replaced{at}")
        size = index.size().first()
        row = self.spark.createDataFrame([(segment, name, merged, size["n"], size["total"])], _MANIFEST)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return segment
