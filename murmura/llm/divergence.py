"""Source divergence audit: how far the term shares of a language's sources lie apart, and which terms stand out.

Counting. A task scans blocks of whole texts. Terms are packed by length: up to
eight bytes into one uint64, up to sixteen into two, which are radix-sorted by
16-bit digits; longer terms go to buckets by width, each sorted by its bytes.
Sorting is stable and texts come group by group, so one sort gives the runs of a
term, of its groups and of its documents. Blocks are summed by Spark.

Divergence. The value of two sources is a sum over all kept terms, most of which
one of them lacks. With F(a, b) the value of counts a and b it is

    V F(0,0) + sum of F(a,0) - F(0,0) + sum of F(0,b) - F(0,0)
             + sum over terms of both of F(a,b) - F(a,0) - F(0,b) + F(0,0),

so the second and third sums follow from how often each count occurs in a
source, and only terms of both are met pairwise, inside the tasks. All in whole
numbers, exact.

Nulls: a null text, language or source is an empty string. Each row is one
document, so repeated rows count each. Texts without terms leave their group
with zero counts. Empty tables give empty results; extra columns are ignored.
Texts of any length are scanned whole. Equal values rank by the item's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmura.llm.base import broadcast_if_small, query, table
from murmura.llm.bytescan import FOLD_BYTES, LETTERS, Words, row_blocks, words
from murmura.operators.scale import top_n_per_group
from murmura.session import materialize

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200

# Rows of whole terms met pairwise at once, and the pairs made of them at once.
_ROWS, _PAIRS = 1 << 17, 1 << 21


# --- packing and counting ------------------------------------------------------------

_KEEP = np.array([0, *[(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)]], np.uint64)


def packed(body: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to eight bytes at each start as one big-endian uint64, zeros after the end; ``body`` has seven bytes to spare."""
    eight = np.lib.stride_tricks.sliding_window_view(body, 8)[starts]
    return np.ascontiguousarray(eight).view(">u8")[:, 0].astype(np.uint64) & _KEEP[np.clip(lengths, 0, 8)]


def radix_order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by keys, the first one leading: least digits first, sixteen bits at a time."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in (0, 16, 32, 48):
            digit = ((key[order] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit, kind="stable")]
    return order


def _ordered(body: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length bucket: the indexes of its terms in the terms' order, and where a new term begins."""
    one = np.flatnonzero(lengths <= 8)
    key = packed(body, starts[one], lengths[one])
    order = radix_order(key)
    yield one[order], _changes(key[order])
    two = np.flatnonzero((lengths > 8) & (lengths <= 16))
    high, low = packed(body, starts[two], lengths[two]), packed(body, starts[two] + 8, lengths[two] - 8)
    order = radix_order(high, low)
    yield two[order], _changes(high[order]) | _changes(low[order])
    width = 16
    while (lengths > width).any():
        own = np.flatnonzero((lengths > width) & (lengths <= 2 * width))
        width *= 2
        if len(own):
            long = np.array([body[s : s + n].tobytes() for s, n in zip(starts[own].tolist(), lengths[own].tolist(), strict=True)], f"S{width}")
            order = np.argsort(long, kind="stable")
            yield own[order], _changes(long[order])


def _changes(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]


def counted_terms(found: Words, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(a word's index, group, occurrences, documents) per term and group; texts come group by group."""
    body = np.frombuffer(found.raw.tobytes().translate(FOLD_BYTES) + bytes(16), np.uint8)
    owner = found.text_of_word()
    for order, new in _ordered(body, found.starts, found.ends - found.starts):
        if not len(order):
            continue
        text = owner[order]
        own = group[text]
        runs = np.flatnonzero(new | _changes(own))
        documents = np.add.reduceat((new | _changes(text)).astype(np.int64), runs)
        yield order[runs], own[runs], np.diff(np.append(runs, len(order))), documents


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in row_blocks(whole, "text", 16 << 20):
            names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            number = {name: k for k, name in enumerate(dict.fromkeys(names))}
            group = np.array([number[name] for name in names])
            order = np.argsort(group, kind="stable")
            found = words(batch.column("text").take(pa.array(order)), LETTERS)
            langs, sources = (pa.array([name[k] for name in number], pa.string()) for k in (0, 1))
            for at, own, n, documents in counted_terms(found, group[order]):
                own = pa.array(own)
                columns = [langs.take(own), sources.take(own), found.spelled(at), pa.array(n), pa.array(documents)]
                yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)


def named(docs: DataFrame) -> DataFrame:
    """(lang, source, text) without nulls."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the terms in at least ``min_documents`` documents of their language."""
    counts = named(docs).mapInArrow(_count_rows, "lang string, source string, term string, n bigint, docs bigint")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    counts = counts.withColumn("lang_docs", F.sum("docs").over(whole)).withColumn("lang_n", F.sum("n").over(whole))
    return counts.filter(F.col("lang_docs") >= min_documents).select("lang", "source", "term", "n", "lang_n")


# --- shares and divergences ----------------------------------------------------------


def _share(n: Column, total: Column, distinct: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (total + distinct)); null where the language keeps no term."""
    wide = lambda c: c.cast("decimal(19,0)")
    scaled = wide(n + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, F.nullif(wide(total + distinct), wide(F.lit(0)))) + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_shares(docs: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sources (lang, source, total, distinct, zero) with the share of a term they lack, and languages (lang, lang_total, distinct)."""
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang", "term").agg(F.first("lang_n").alias("n"))
    langs = materialize(langs.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("distinct")))
    groups = named(docs).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs.select("lang", "distinct"), "lang", "left")
    groups = groups.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total", "distinct")})
    return materialize(groups.withColumn("zero", _share(F.lit(0), F.col("total"), F.col("distinct")))), langs


def _whole_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole terms, and where each term begins, from rows sorted by language and term."""
    parts, size = [], 0
    for batch in batches:
        parts.append(batch)
        size += batch.num_rows
        if size >= _ROWS:
            rows, new = _starts(parts)
            cut = int(new[-1])
            if cut:
                yield rows.slice(0, cut), new[:-1]
            parts = rows.slice(cut).to_batches()
            size = rows.num_rows - cut
    if size:
        yield _starts(parts)


def _starts(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    rows = pa.Table.from_batches(parts).combine_chunks()
    new = np.ones(rows.num_rows, dtype=bool)
    for c in ("lang", "term"):
        column = rows.column(c).combine_chunks()
        differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        new[1:] = differs if c == "lang" else new[1:] | differs
    return rows, np.flatnonzero(new)


def _met_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value): the last sum of the formula above over the terms at hand."""
    for rows, starts in _whole_terms(batches):
        langs, sources = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
        many = len(sources.dictionary)
        lang, source = langs.indices.to_numpy().astype(np.int64), sources.indices.to_numpy().astype(np.int64)
        p, zero = rows.column("p").to_numpy(), rows.column("zero").to_numpy()
        sizes = np.diff(np.append(starts, rows.num_rows))
        first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        met = np.cumsum(size)
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(met, (met[lo - 1] if lo else 0) + _PAIRS, side="right")))
            n = size[lo:hi]
            a = np.repeat(np.arange(lo, hi), n)
            b = np.repeat(first[lo:hi], n) + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            apart = source[a] != source[b]
            a, b = a[apart], b[apart]
            value = _gaps(p[a], p[b]) - _gaps(p[a], zero[b]) - _gaps(zero[a], p[b]) + _gaps(zero[a], zero[b])
            keys, where = np.unique((lang[a] * many + source[a]) * many + source[b], return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, where, value)
            columns = [
                langs.dictionary.take(pa.array(keys // many**2)),
                sources.dictionary.take(pa.array(keys // many % many)),
                sources.dictionary.take(pa.array(keys % many)),
                pa.array(sums),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "value"])
            lo = hi


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def source_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    shared = broadcast_if_small(groups.select("lang", "source", "total", "distinct", "zero"))
    sized = counts.join(shared, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("distinct")))
    dealt = sized.select("lang", "term", "source", "p", "zero").repartition("lang", "term").sortWithinPartitions("lang", "term")
    met = dealt.mapInArrow(_met_rows, "lang string, source string, item string, value bigint").groupBy("lang", "source", "item").agg(F.sum("value").alias("met"))
    levels = materialize(sized.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")))
    a = groups.select("lang", "source", F.col("zero").alias("zero_a"), "distinct")
    b = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_b"))
    pairs = materialize(a.join(b, "lang").filter("source <> item"))
    none = _gap(F.col("zero_a"), F.col("zero_b"))
    left = pairs.join(levels, ["lang", "source"]).groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (_gap(F.col("p"), F.col("zero_b")) - none)).alias("left"))
    right = pairs.join(levels.withColumnRenamed("source", "item"), ["lang", "item"])
    right = right.groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (_gap(F.col("zero_a"), F.col("p")) - none)).alias("right"))
    key = ["lang", "source", "item"]
    whole = pairs.join(left, key, "left").join(right, key, "left").join(met, key, "left")
    parts = [F.col("distinct") * none, *map(F.col, ("left", "right", "met"))]
    return whole.select(*key, sum((F.coalesce(c, F.lit(0)) for c in parts), F.lit(0).cast("bigint")).alias("value"))


def marked_terms(counts: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of terms with a greater share in a source than in its language."""
    sized = counts.join(broadcast_if_small(groups.select("lang", "source", "total")), ["lang", "source"]).join(broadcast_if_small(langs), "lang")
    p = _share(F.col("n"), F.col("total"), F.col("distinct"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("distinct"))
    shares = sized.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    return shares.select("lang", "source", "item", _gap(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source by divergence, and the terms that mark a source."""
    counts = materialize(term_counts(docs, min_documents))
    groups, langs = group_shares(docs, counts)
    order = [F.col("value").desc(), F.col("item")]
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    pairs = source_pairs(counts, groups).withColumn("rank", ranked)
    terms = top_n_per_group(marked_terms(counts, groups, langs), ["lang", "source"], order, top)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


_SQL = rf"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
occ AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM occ GROUP BY lang, source, term),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n, CAST(1 + ({SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS BIGINT) AS p
  FROM filled WINDOW w AS (PARTITION BY lang, source)),
q AS (
  SELECT lang, term, CAST(1 + ({SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS BIGINT) AS q
  FROM kept WINDOW w AS (PARTITION BY lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
mark AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM mark))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


@query("op13_source_divergence", _SQL)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
