"""Line dedup: lines that many documents share are dropped from all of them.

A line's key is the line without white space at its ends, A-Z lower-cased; keys
travel as two 64-bit hashes. A document is its id together with its text, so
repeated rows count once, and rows that share an id but not the text are apart.

Nulls: a null text is one empty line and becomes an empty text; a null id is an
id like any other. Empty keys are always kept. An empty table stays empty. Extra
columns are carried through. Lines are split at ``\\n`` only, texts of any length
are split whole, and the lines kept are put back by their position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import query, row_key, table
from murmura.llm.bytescan import FOLD_BYTES, row_blocks, utf8
from murmura.session import materialize

MIN_LENGTH = 1
MIN_DOCUMENTS = 10

_WHITE = b" \t\n\x0b\x0c\r"
_LINES = "row_key bigint, high bigint, low bigint, positions array<int>"


def _line_rows(min_length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_blocks(whole, "text"):
                raw, offsets = utf8(batch.column("text"))
                body = raw.tobytes().translate(FOLD_BYTES)
                owners, digests, positions = [], [], []
                for i, owner in enumerate(batch.column("row_key").to_pylist()):
                    found: dict[bytes, list[int]] = {}
                    for at, line in enumerate(body[offsets[i] : offsets[i + 1]].split(b"\n")):
                        key = line.strip(_WHITE)
                        if len(key) >= min_length and (min_length <= 1 or len(key.decode()) >= min_length):
                            found.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                    owners += [owner] * len(found)
                    digests += found.keys()
                    positions += found.values()
                halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(positions, pa.list_(pa.int32()))],
                    names=["row_key", "high", "low", "positions"],
                )

    return rows


def line_keys(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document and distinct key of its lines, with the positions of those lines."""
    return docs.select(row_key().alias("row_key"), "text").mapInArrow(_line_rows(min_length), _LINES)


def shared_keys(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Keys found in at least ``min_documents`` documents; counted per part first, so a hot key is never one task's."""
    counted = lines.groupBy("high", "low").agg(F.countDistinct("row_key").alias("n"))
    return counted.filter(F.col("n") >= min_documents).select("high", "low")


def dropped_positions(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per document that loses lines: the positions of those lines."""
    lines = materialize(line_keys(docs, min_length))
    hot = materialize(shared_keys(lines, min_documents))
    hits = lines.join(hot, ["high", "low"])
    return hits.groupBy("row_key").agg(F.flatten(F.collect_list("positions")).alias("positions"))


def with_kept_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Rows of ``docs`` as a struct ``doc``, with n_lines, n_dropped and the text that is kept."""
    drops = dropped_positions(docs, min_length, min_documents)
    packed = docs.select(F.struct("*").alias("doc"), row_key().alias("row_key"))
    joined = packed.join(drops, "row_key", "left")
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    n_dropped = F.coalesce(F.size(F.array_distinct("positions")), F.lit(0))
    return joined.select(
        "doc",
        n_lines.cast("bigint").alias("n_lines"),
        F.when(F.col("positions").isNull(), F.lit(0)).otherwise(n_dropped).cast("bigint").alias("n_dropped"),
        F.when(F.col("positions").isNull(), text).otherwise(_rejoined(text, F.col("positions"))).alias("kept"),
    )


def _rejoined(text: Column, dropped: Column) -> Column:
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.transform(dropped, lambda p: p + 1))
    return F.array_join(F.transform(kept, lambda p: F.element_at(lines, p)), "\n")


def drop_shared_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` without the lines that at least ``min_documents`` documents share."""
    kept = with_kept_lines(docs, min_length, min_documents)
    return kept.select(*[F.col("kept").alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


LINES_SQL = f"""rows AS (SELECT DISTINCT doc_id, text FROM documents),
lined AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM rows),
keyed AS (
  SELECT doc_id, text, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key, line FROM lined),
shared AS (
  SELECT key FROM (SELECT DISTINCT key, doc_id, text FROM keyed WHERE len(key) >= {MIN_LENGTH})
  GROUP BY key HAVING count(*) >= {MIN_DOCUMENTS}),
flagged AS (
  SELECT d.doc_id, string_split(coalesce(d.text, ''), chr(10)) AS lines,
         list_transform(string_split(coalesce(d.text, ''), chr(10)), lambda l:
           translate(regexp_replace(l, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS keys,
         (SELECT coalesce(list(key), []) FROM shared) AS shared
  FROM documents d),
kept AS (
  SELECT doc_id, lines, list_filter(lines, lambda l, i: NOT list_contains(shared, keys[i])) AS kept FROM flagged)"""


@query(
    "op9_line_dedup",
    f"""WITH {LINES_SQL}
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM kept""",
)
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = with_kept_lines(docs)
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
