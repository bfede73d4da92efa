"""Benchmark decontamination: test items held inside documents.

Items are short and documents long, so a banded signature of a whole document
says nothing about an item in it (their Jaccard similarity is near zero). The
sketch is therefore taken from the item alone: its smallest shingle hashes among
those that the fewest items hold, as many as the partition of its size needs. An item of q shingles with at least
``t * q`` of them in a document misses at most ``q - ceil(t * q)``; of one more
than that many, whichever they are, one is in the document. Looking the item's
sketch up among *all* hashes of the document finds every candidate, and
the exact count of shared shingles then decides.

Documents are scanned in place, without a shuffle. Items travel to the tasks in
blocks of a bounded number of shingles; a larger benchmark takes more scans.

Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z folded.
An item shorter than the shingle width is one shingle of its own length; an item
without words, or null, matches nothing. Null and empty texts hold nothing.
Items that repeat a text are reported each. Empty tables give no pairs. Extra
columns are ignored by ``contained`` and carried through by ``without_items``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import query, table
from murmura.llm.bytescan import ALPHANUMERIC, Words, row_blocks, words
from murmura.session import materialize

THRESHOLD = 0.8
WIDTH = 5

# Item shingles sent to the tasks at once: 12 bytes each.
BLOCK_SHINGLES = 2_000_000

_PAIRS = "doc_id bigint, item_id bigint, n_shingles bigint, n_found bigint, containment double"


def needed(threshold: float, n: int) -> int:
    """Shingles out of ``n`` that reach the threshold (which is read as a decimal fraction)."""
    return math.ceil(round(threshold * n, 9))


def item_shingles(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per item with a word: the width of its shingles and their distinct hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_blocks(whole, "text"):
                found = words(batch.column("text"), ALPHANUMERIC)
                counts, ids = found.counts, batch.column("item_id").to_pylist()
                out = []
                for size in sorted({min(width, int(c)) for c in counts if c}):
                    hashes, at = found.runs(size)
                    owner = found.text_of_word()[at]
                    for i in np.flatnonzero((counts == size) if size < width else (counts >= width)):
                        own = np.unique(hashes[np.searchsorted(owner, i) : np.searchsorted(owner, i, "right")])
                        out.append((ids[i], size, len(own), own.view(np.int64)))
                names = ["item_id", "width", "n", "hashes"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)

    return items.select("item_id", "text").mapInArrow(rows, "item_id bigint, width int, n bigint, hashes array<bigint>")


class Sketches:
    """A block of items: sketches sized by partition, and all shingles for the exact count."""

    def __init__(self, ids: list, widths: np.ndarray, sizes: np.ndarray, hashes: list[np.ndarray], threshold: float):
        self.ids, self.widths, self.sizes, self.threshold = ids, widths, sizes, threshold
        self.hashes = hashes
        self.lookup: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # Items fall into partitions of sizes from a power of two to the next; the largest size of one sets its sketches' depth.
        partition = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
        depth = {p: max(n - needed(threshold, n) + 1 for n in range(2**p, 2 ** (p + 1))) for p in set(partition.tolist())}
        for width in sorted(set(widths.tolist())):
            own = np.flatnonzero(widths == width)
            # Shingles that fewer items hold come first, by hash among equals: what thousands of items share is met last.
            shingles, times = np.unique(np.concatenate([hashes[i] for i in own]), return_counts=True)
            parts = []
            for i in own:
                rarest = np.lexsort((hashes[i], times[np.searchsorted(shingles, hashes[i])]))
                parts.append(hashes[i][rarest[: depth[partition[i]]]])
            owner = np.repeat(own, [len(p) for p in parts])
            flat = np.concatenate(parts)
            order = np.argsort(flat, kind="stable")
            self.lookup[width] = (flat[order], owner[order])

    def candidates(self, hashes: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
        """Pairs (text, item) that share a sketch value, in order, each once."""
        flat, items = self.lookup[width]
        lo = np.searchsorted(flat, hashes)
        hit = np.flatnonzero(flat[np.minimum(lo, len(flat) - 1)] == hashes)
        lo = lo[hit]
        n = np.searchsorted(flat, hashes[hit], "right") - lo
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs = np.stack([np.repeat(owner[hit], n), items[np.repeat(lo, n) + step]], axis=1)
        return np.unique(pairs, axis=0)

    def contained(self, found: Words) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of the pairs that reach the threshold."""
        words_of = found.text_of_word()
        for width in self.lookup:
            hashes, at = found.runs(width)
            if not len(hashes):
                continue
            owner = words_of[at]
            last, own = -1, hashes[:0]
            for text, item in self.candidates(hashes, owner, width):
                if text != last:
                    last = text
                    own = np.sort(hashes[np.searchsorted(owner, text) : np.searchsorted(owner, text, "right")])
                wanted = needed(self.threshold, int(self.sizes[item]))
                if len(own) < wanted:
                    continue
                at_own = np.minimum(np.searchsorted(own, self.hashes[item]), len(own) - 1)
                shared = int(np.count_nonzero(own[at_own] == self.hashes[item]))
                if shared >= wanted:
                    yield int(text), int(item), shared


def sketch_blocks(items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> Iterator[Sketches]:
    """The items' sketches in blocks of about ``BLOCK_SHINGLES`` shingles at most."""
    shingled = materialize(item_shingles(items, width))
    total = shingled.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_SHINGLES)
    for block in range(blocks):
        rows = shingled.filter(F.pmod(F.xxhash64("hashes", "item_id"), F.lit(blocks)) == block).toArrow()
        if rows.num_rows:
            lists = rows.column("hashes").combine_chunks()
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            hashes = np.split(flat, np.cumsum(rows.column("n").to_numpy())[:-1])
            yield Sketches(rows.column("item_id").to_pylist(), rows.column("width").to_numpy(), rows.column("n").to_numpy(), hashes, threshold)


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """Pairs (doc_id, item_id) where the document holds at least ``threshold`` of the item's shingles."""
    spark, out = docs.sparkSession, None
    for sketches in sketch_blocks(items, threshold, width):
        shared = spark.sparkContext.broadcast(sketches)

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for whole in batches:
                for batch in row_blocks(whole, "text"):
                    ids = batch.column("doc_id")
                    pairs = list(block.contained(words(batch.column("text"), ALPHANUMERIC)))
                    if pairs:
                        sizes = [int(block.sizes[i]) for _, i, _ in pairs]
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([t for t, _, _ in pairs], pa.int64())).cast(pa.int64()),
                                pa.array([block.ids[i] for _, i, _ in pairs], pa.int64()),
                                pa.array(sizes, pa.int64()),
                                pa.array([n for _, _, n in pairs], pa.int64()),
                                pa.array([n / size for (_, _, n), size in zip(pairs, sizes, strict=True)], pa.float64()),
                            ],
                            names=["doc_id", "item_id", "n_shingles", "n_found", "containment"],
                        )

        found = docs.select("doc_id", "text").mapInArrow(rows, _PAIRS)
        out = found if out is None else out.unionAll(found)
    return spark.createDataFrame([], _PAIRS) if out is None else out


def without_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    for sketches in sketch_blocks(items, threshold, width):
        shared = docs.sparkSession.sparkContext.broadcast(sketches)

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for whole in batches:
                for batch in row_blocks(whole, "text"):
                    keep = np.ones(batch.num_rows, dtype=bool)
                    keep[[text for text, _, _ in block.contained(words(batch.column("text"), ALPHANUMERIC))]] = False
                    yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs


_FOLD_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_SQL = f"regexp_extract_all({_FOLD_SQL}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
CONTAINED_SQL = f"""item_words AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
item_runs AS (
  SELECT item_id, least(len(w), {WIDTH}) AS width, list_distinct(list_transform(range(1, len(w) - least(len(w), {WIDTH}) + 2),
           lambda i: array_to_string(w[i:i + least(len(w), {WIDTH}) - 1], ' '))) AS runs
  FROM item_words WHERE len(w) > 0),
item_rows AS (SELECT item_id, width, len(runs) AS n, unnest(runs) AS run FROM item_runs),
doc_words AS (SELECT doc_id, text, {_WORDS_SQL} AS w FROM documents),
doc_rows AS (
  SELECT doc_id, text, width, unnest(list_distinct(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' ')))) AS run
  FROM doc_words, (SELECT DISTINCT width FROM item_rows) WHERE len(w) >= width),
pairs AS (
  SELECT d.doc_id, d.text, i.item_id, any_value(i.n) AS n_shingles, count(*) AS n_found
  FROM doc_rows d JOIN item_rows i ON d.run = i.run AND d.width = i.width GROUP BY ALL)"""


@query(
    "op2_benchmark_decontamination",
    f"""WITH {CONTAINED_SQL}
SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(n_found AS BIGINT) AS n_found,
       CAST(n_found AS DOUBLE) / n_shingles AS containment
FROM pairs WHERE n_found >= ceil(round({THRESHOLD} * n_shingles, 9))""",
)
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
