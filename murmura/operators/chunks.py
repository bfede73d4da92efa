"""Token arrays as numbers into the words of a chunk of texts: a chunk sends each of its words once, not every text."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.session import materialize

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tokens of a chunk: what a task holds at once. A text is never cut, so a longer one is a chunk of its own.
CHUNK_TOKENS = 1 << 20


def sizes_of(lists: pa.Array) -> np.ndarray:
    """Members of each list, none of a missing one."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_counts(lists: pa.Array, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, code, tf)`` of lists of codes below ``known``, by text and code; missing members do not count."""
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), sizes_of(lists))
    valid = flat.is_valid().to_numpy(zero_copy_only=False)
    codes = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    keys, tf = np.unique(owner[valid] * max(known, 1) + codes[valid], return_counts=True)
    return keys // max(known, 1), keys % max(known, 1), tf


def coded(df: DataFrame, columns: Sequence[str], most: int = CHUNK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``(texts, words)`` of ``df``, written once and where its rows are.

    ``texts`` has ``_chunk`` and numbers for the tokens of ``columns``; other columns, missing arrays and missing tokens
    stay as they are. ``words`` is ``(_chunk, _which, _code, token, docs)``: what a number stands for in a chunk and a
    column, told by its place in ``columns``, and how many rows of the chunk hold it. Drop ``texts`` and both are gone.
    """
    kept = [f for f in df.schema if f.name not in columns]
    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in kept], *[T.StructField(c, numbers) for c in columns], T.StructField("_chunk", T.LongType()),
            T.StructField("_which", T.IntegerType()), T.StructField("_words", T.ArrayType(T.StringType())), T.StructField("_docs", numbers),
        ]
    )

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        taken = np.cumsum(sum(sizes_of(batch.column(c)) for c in columns))
        start = 0
        while start < batch.num_rows:
            before = taken[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(taken, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in parts(batch):
                n = part.num_rows
                lists, words, docs = [], [], []
                for c in columns:
                    column = part.column(c)
                    own = column.flatten().dictionary_encode()
                    # Numbers follow the words' order, so sums by number add up as sums by word do.
                    order = pc.sort_indices(own.dictionary).to_numpy()
                    place = np.empty(len(order), np.int32)
                    place[order] = np.arange(len(order), dtype=np.int32)
                    offsets = pa.array(np.append(0, np.cumsum(sizes_of(column))), pa.int32())
                    lists.append(pa.ListArray.from_arrays(offsets, pa.array(place, pa.int32()).take(own.indices), mask=column.is_null()))
                    words.append(own.dictionary.take(pa.array(order)).to_pylist())
                    docs.append(np.bincount(text_counts(lists[-1], len(order))[1], minlength=len(order)))
                beside = [part.column(f.name) for f in kept]
                texts = [*beside, *lists, pa.array(np.full(n, chunk)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(texts, names=schema.names)
                k = len(columns)
                none = [pa.nulls(k, x.type) for x in (*beside, *lists)]
                held = [pa.array(np.full(k, chunk)), pa.array(range(k), pa.int32()), pa.array(words, pa.list_(pa.string())), pa.array(docs, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*none, *held], names=schema.names)
                chunk += 1

    stored = materialize(df.select(*[F.col(f"`{f.name}`") for f in kept], *[F.col(f"`{c}`") for c in columns]).mapInArrow(numbered, schema))
    words = stored.filter("_which IS NOT NULL").select("_chunk", "_which", F.posexplode(F.arrays_zip("_words", "_docs")).alias("_code", "_word"))
    texts = stored.filter("_which IS NULL").drop("_which", "_words", "_docs")
    return texts, words.select("_chunk", "_which", "_code", F.col("_word._words").alias("token"), F.col("_word._docs").alias("docs"))


def apply_chunks(texts: DataFrame, values: DataFrame, body: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType | str) -> DataFrame:
    """``body(texts, values)`` for each chunk, ``values`` being what the chunk's words have met; a chunk may have none."""
    return texts.groupBy("_chunk").cogroup(values.groupBy("_chunk")).applyInArrow(body, schema)
