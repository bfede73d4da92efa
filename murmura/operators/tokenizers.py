"""Vocabularies and token ids: first-appearance vocabularies, encoding, padding, pair-merge tokenizer."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from murmura.functions import text
from murmura.operators.chunks import apply_chunks, coded, sizes_of
from murmura.operators.lookup import map_tokens
from murmura.operators.scale import consecutive_ids, deal_out, rows_by_repeat
from murmura.session import drop, materialize

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNK, PAD = "<UNK>", "<PAD>"
# Most frequent pairs that a training pass looks at.
PAIRS_PER_PASS = 4096


def text_tokens(df: DataFrame, column: str, id_col: str) -> DataFrame:
    """``(doc_id, pos, token)`` of the word tokenizer on lower-cased text."""
    return df.select(F.col(id_col).alias("doc_id"), F.posexplode(text.tokenize_words(F.lower(column))).alias("pos", "token"))


def _with_specials(vocab: DataFrame, last: DataFrame) -> DataFrame:
    """Append the unknown and padding entries after ``last``, a one-row table of the highest id."""
    entries = [F.struct(F.lit(t).alias("token"), (F.col("last") + i).cast("bigint").alias("id")) for i, t in ((1, UNK), (2, PAD))]
    return vocab.select("token", "id").unionByName(last.select(F.inline(F.array(*entries))))


def build_vocab(tokens: DataFrame, order: str = "doc_id", start: int = 0) -> DataFrame:
    """``(token, id)`` in order of first appearance, then the two special entries. ``order`` is a numeric document order."""
    first = tokens.groupBy("token").agg(F.min(F.struct(F.col(order).alias("doc"), F.col("pos"))).alias("first"))
    placed = materialize(first.select("token", F.col("first.doc").alias("_doc"), F.col("first.pos").alias("_pos")))
    last = placed.agg((F.count("*") + start - 1).alias("last"))
    return _with_specials(consecutive_ids(placed, "_doc", ["_pos"], "id", start), last)


def vocab_from_vectors(vectors: DataFrame) -> DataFrame:
    """Vocabulary of a pretrained table ``(token, id, ...)`` plus the two special entries."""
    last = vectors.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("last"))
    return _with_specials(vectors.select("token", F.col("id").cast("bigint").alias("id")), last)


def encode(df: DataFrame, column: str, id_col: str, vocab: DataFrame) -> DataFrame:
    """``(doc_id, ids)``; tokens that are not in the vocabulary get the unknown id. Texts without tokens get an empty list.

    Texts are tokenized once, and frequent tokens find their ids where the text is.
    """
    unk = vocab.filter(F.col("token") == UNK).agg(F.max("id")).first()[0]
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(text.tokenize_words(F.lower(column)), F.array()).alias("ids"))
    return map_tokens(texts, "ids", vocab.select("token", F.col("id").cast("bigint").alias("value")), default=unk)


def pad_truncate(df: DataFrame, ids: str = "ids", batch: str = "batch", pad: int | Column = 0, max_len: int = 512) -> DataFrame:
    """Cut lists to ``max_len`` and pad them on the right to the longest of their batch."""
    cut = df.withColumn(ids, F.slice(ids, 1, max_len))
    longest = cut.groupBy(batch).agg(F.max(F.size(ids)).alias("_longest"))
    filler = pad if isinstance(pad, Column) else F.lit(pad)
    padded = F.concat(F.col(ids), F.array_repeat(filler, F.col("_longest") - F.size(ids)))
    return cut.join(longest, batch).withColumn(ids, padded).drop("_longest")


# --- pair merges -------------------------------------------------------------------


def word_frequencies(df: DataFrame, column: str) -> DataFrame:
    """``(word, freq)`` of cleaned lines split on single spaces."""
    return (
        df.select(F.explode(F.split(text.clean_line(F.col(column)), " ")).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("freq"))
    )


def _spell(word: Column) -> Column:
    """Pieces between spaces, one on each side: `` a  b ``. Words hold no spaces, so replacing a pair is exact."""
    return F.regexp_replace(word, r"(?s)(.)", " $1 ")


def pieces(spelled: Column) -> Column:
    return F.filter(F.split(spelled, " "), lambda p: p != "")


def pair_counts(words: DataFrame) -> DataFrame:
    """``(left, right, n)`` over adjacent pieces, weighted by word frequency."""
    parts = words.select("freq", pieces(F.col("spelled")).alias("p")).filter(F.size("p") > 1)
    zipped = F.arrays_zip(F.slice("p", F.lit(1), F.size("p") - 1).alias("left"), F.slice("p", F.lit(2), F.size("p") - 1).alias("right"))
    return parts.select("freq", F.inline(zipped)).groupBy("left", "right").agg(F.sum("freq").alias("n"))


def independent_pairs(best: Sequence[tuple[str, str, int]], most: int, spread: float = 1.0) -> list[tuple[str, str, int]]:
    """The pairs of one pass, out of the most frequent ones by falling count and then by the pair.

    A merge of (a, b) touches no other pair than those that end with a or begin with b, and a pair it creates is no more
    frequent than one of these. So with ``spread`` 1 pairs are taken until one meets an earlier one in that way, which
    gives the rules of merging one pair at a time. With less, pairs that meet an earlier one are passed over, down to
    that share of the greatest count.
    """
    taken: list[tuple[str, str, int]] = []
    lefts: set[str] = set()
    rights: set[str] = set()

    def meets(left: str, right: str) -> bool:
        return right in lefts or left in rights

    for k, (left, right, n) in enumerate(best):
        if len(taken) >= most or n < spread * best[0][2] and spread < 1:
            break
        if taken and spread >= 1:
            # Equally frequent pairs count as earlier ones: a created pair might come before them.
            level = [p for p in best[k:] if p[2] == n]
            if any(meets(x, y) for x, y, _ in level) or taken[-1][0] == taken[-1][1]:
                break
        if meets(left, right) or (left == right and (left in lefts or left in rights)):
            continue
        taken.append((left, right, n))
        lefts.add(left)
        rights.add(right)
    return taken


def _merged(parts: list[str], rules: Mapping[tuple[str, str], str]) -> list[str]:
    out, k = [], 0
    while k < len(parts):
        joined = rules.get((parts[k], parts[k + 1])) if k + 1 < len(parts) else None
        out.append(joined or parts[k])
        k += 2 if joined else 1
    return out


_WORDS = "word string, freq bigint, p array<string>, old array<string>"


def _merge_words(words: DataFrame, rules: Mapping[tuple[str, str], str]) -> DataFrame:
    """Words with pairs merged; ``old`` keeps the former pieces of those that changed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("p").to_pylist()
            new = [_merged(p, rules) for p in parts]
            old = [p if len(p) != len(q) else None for p, q in zip(parts, new, strict=True)]
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("freq"), pa.array(new, kind), pa.array(old, kind)], names=["word", "freq", "p", "old"])

    return words.select("word", "freq", "p").mapInArrow(rows, _WORDS)


def _adjacent(words: DataFrame, column: str, sign: int = 1) -> DataFrame:
    """``(left, right, n)``, a row per adjacent pair of a word."""
    p = F.col(column)
    parts = words.filter(F.size(p) > 1).select((F.col("freq") * sign).alias("n"), p.alias("p"))
    zipped = F.arrays_zip(F.slice("p", F.lit(1), F.size("p") - 1).alias("left"), F.slice("p", F.lit(2), F.size("p") - 1).alias("right"))
    return parts.select("n", F.inline(zipped)).select("left", "right", "n")


def train_bpe(df: DataFrame, column: str, merges: int | None = None, vocabulary: int | None = None, spread: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """``(rules, words)``: merge rules ``(step, left, right, n)`` and the pieces of every seen word.

    Published rule: merge the most frequent adjacent pair; ties go to the smaller pair. Training ends after ``merges``
    rules, or when characters and merged pieces reach ``vocabulary``, or when no pair is left. A pass merges all pairs
    that do not depend on each other (``independent_pairs``) and updates the pair counts from the words it changed only.
    The most frequent pairs of each pass reach the driver, and the rules.
    """
    spark = df.sparkSession
    words = word_frequencies(df, column).select("word", "freq", pieces(_spell(F.col("word"))).alias("p"))
    # Every pass rewrites the words, which are few bytes: they are dealt to all tasks once and stay in as many files.
    words = materialize(deal_out(words, F.xxhash64("word")).withColumn("old", F.lit(None).cast("array<string>")))
    pairs = materialize(_adjacent(words, "p").groupBy("left", "right").agg(F.sum("n").alias("n")))
    left_over = merges if merges is not None else 2**31
    if vocabulary is not None:
        left_over = min(left_over, vocabulary - words.select(F.explode("p").alias("c")).distinct().count())
    steps: list[tuple[int, str, str, int]] = []
    while len(steps) < left_over:
        best = [tuple(r) for r in pairs.orderBy(F.desc("n"), "left", "right").limit(PAIRS_PER_PASS).collect()]
        taken = independent_pairs(best, left_over - len(steps), spread)
        if not taken:
            break
        steps += [(len(steps) + k, *pair) for k, pair in enumerate(taken)]
        former, counted = words, pairs
        words = materialize(_merge_words(words, {(a, b): a + b for a, b, _ in taken}))
        changed = words.filter(F.col("old").isNotNull())
        update = _adjacent(changed, "old", -1).unionByName(_adjacent(changed, "p"))
        counts = pairs.unionByName(update).groupBy("left", "right").agg(F.sum("n").alias("n"))
        pairs = materialize(counts.filter("n > 0"))
        # Every pass writes all words anew: of the former pass nothing is read again.
        drop(former, counted)
    drop(pairs)
    rules = spark.createDataFrame(steps, "step int, left string, right string, n bigint")
    return rules, words.select("word", F.col("p").alias("pieces"))


def piece_ids(rules: DataFrame, words: DataFrame) -> DataFrame:
    """``(token, id)`` of a trained tokenizer: characters by code point, merged pieces by step, then the two special entries.

    The characters are those of the words; a piece that two rules make keeps its first id.
    """
    characters = words.select(F.explode(pieces(_spell(F.col("word")))).alias("token")).distinct().select(F.lit(-1).alias("step"), "token")
    merged = rules.groupBy(F.concat("left", "right").alias("token")).agg(F.min("step").alias("step")).select("step", "token")
    # As many rows as the vocabulary was allowed: one task numbers them.
    order = Window.partitionBy(F.lit(0)).orderBy("step", "token")
    vocab = characters.unionByName(merged).withColumn("id", (F.row_number().over(order) - 1).cast("bigint"))
    return _with_specials(vocab, vocab.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("last")))


def encode_bpe_ids(df: DataFrame, column: str, id_col: str, word_pieces: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, ids)``: the ids of the pieces of each word; a word not seen in training is the unknown id.

    Every distinct word is numbered once, before it meets the texts. Texts are numbers into the words of their chunk, a
    chunk sends each of its words once, and the numbers meet the pieces in the chunk. Rows that share an id are one text.
    """
    vocab = materialize(vocab)
    spelled = word_pieces.select("word", F.posexplode("pieces").alias("k", "token")).join(F.broadcast(vocab), "token")
    numbered = spelled.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("k", "id"))).alias("e")).select("word", F.col("e.id").alias("pieces"))
    unknown = vocab.filter(F.col("token") == UNK).agg(F.max("id")).first()[0]
    numbered = materialize(numbered)
    alone, together = rows_by_repeat(df, id_col)
    texts, words = coded(alone.select(F.col(id_col).alias("doc_id"), F.split(column, " ").alias("_ids")), ["_ids"])
    known = materialize(words.join(numbered.withColumnRenamed("word", "token"), "token").select("_chunk", "_code", "pieces"))
    schema = Ty.StructType([texts.schema["doc_id"], Ty.StructField("ids", Ty.ArrayType(Ty.LongType()))])
    encoded = apply_chunks(texts, known, _piece_lists(unknown), schema)
    if together is None:
        drop(numbered)
        return encoded
    return encoded.unionByName(_word_lists(together, column, id_col, numbered, F.array(F.lit(unknown))).withColumnRenamed("pieces", "ids"))


def _piece_lists(unknown: int):
    """Chunk body: the ids of the pieces of each text's words, the unknown id for a word without any."""

    def encode(texts: pa.Table, known: pa.Table) -> pa.Table:
        lists = texts["_ids"].combine_chunks()
        codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        # The last entry is that of words without pieces.
        place = np.full(int(codes.max(initial=-1)) + 1, known.num_rows)
        place[known["_code"].to_numpy()] = np.arange(known.num_rows)
        kind = pa.list_(pa.int64())
        pieces = pa.concat_arrays([*known["pieces"].cast(kind).chunks, pa.array([[unknown]], kind)])
        found = pieces.take(pa.array(place[codes]))
        ends = np.append(0, np.cumsum(sizes_of(found)))[np.append(0, np.cumsum(sizes_of(lists)))]
        return pa.table({"doc_id": texts["doc_id"], "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.flatten())})

    return encode


def _word_lists(df: DataFrame, column: str, id_col: str, word_pieces: DataFrame, unknown: Column) -> DataFrame:
    """``(doc_id, pieces)``: the lists of a text's words, joined in order. A word that repeats in a text is looked up once."""
    words = F.split(column, " ")
    split = df.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(words).alias("pos", "word"))
    once = split.groupBy("doc_id", "word").agg(F.collect_list("pos").alias("at"))
    known = once.join(word_pieces, "word", "left").withColumn("pieces", F.coalesce("pieces", unknown))
    entries = F.transform("at", lambda p: F.struct(p.alias("pos"), F.col("pieces").alias("pieces")))
    grouped = known.groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list(entries))).alias("entries"))
    return grouped.select("doc_id", F.flatten("entries.pieces").alias("pieces"))


def encode_bpe(df: DataFrame, column: str, id_col: str, word_pieces: DataFrame) -> DataFrame:
    """``(doc_id, pieces)``; a word that was not seen in training is one unknown token."""
    return _word_lists(df, column, id_col, word_pieces, F.array(F.lit(UNK)))


TOKENIZERS = {"bpe": encode_bpe, "word2vec": encode, "nltk": encode}
