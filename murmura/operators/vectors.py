"""Dense vectors: pooling, out-of-vocabulary handling, nearest neighbours, fuzzy lookup, cluster quality."""

from __future__ import annotations

import difflib
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.operators.scale import deal_out, join_frequent_apart, row_blocks, top_n_per_group
from murmura.session import materialize

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Query vectors carried by each task at once; more are taken in several passes.
QUERY_BLOCK = 2_000
# Edits up to which close words are found by leaving characters out: a word of 14 has 106 such forms.
SHORTENED = 2


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def _vector(c: str) -> Column:
    return array_to_vector(F.col(c).cast("array<double>"))


def mean_vector(c: str) -> Column:
    """Aggregate: element-wise mean of an array column."""
    return vector_to_array(Summarizer.mean(_vector(c)))


def pool_vectors(df: DataFrame, how: str = "mean", key: str = "doc_id", pos: str = "pos", column: str = "vector") -> DataFrame:
    """One vector per text from its token vectors; padding is not in the table, so it does not dilute the mean."""
    pooled = {
        "mean": lambda: mean_vector(column),
        "max": lambda: vector_to_array(Summarizer.max(_vector(column))),
        "last": lambda: F.max_by(F.col(column).cast("array<double>"), pos),
    }[how]()
    return df.filter(F.col(column).isNotNull()).groupBy(key).agg(pooled.alias(column))


# --- embedding tables ------------------------------------------------------------


def embed_vocab(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """``vocab (token, id)`` with ``vectors (token, vector)``; ``oov`` marks tokens without one."""
    joined = vocab.join(vectors.select("token", "vector"), "token", "left")
    return joined.withColumn("oov", F.col("vector").isNull())


def oov_count(embedded: DataFrame) -> DataFrame:
    return embedded.agg(F.count_if("oov").alias("oov"), F.count("*").alias("size"))


def unknown_vector(dim: int, seed: int = 0) -> Column:
    """A fixed vector in [0, 1) drawn from a seeded hash."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(dim)),
        lambda i: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), i.cast("string"))), 1, 8), 16, 10).cast("double") / 4294967296.0,
    )


def oov_using_unk(tokens: DataFrame, dim: int, seed: int = 0) -> DataFrame:
    return tokens.withColumn("vector", F.coalesce(F.col("vector").cast("array<double>"), unknown_vector(dim, seed)))


def oov_average(tokens: DataFrame, dim: int, key: str = "doc_id") -> DataFrame:
    """Unknown vectors become the mean of the text's known ones, or zeros."""
    means = pool_vectors(tokens, "mean", key).withColumnRenamed("vector", "_mean")
    zeros = F.array_repeat(F.lit(0.0), dim)
    filled = F.coalesce(F.col("vector").cast("array<double>"), F.col("_mean"), zeros)
    return tokens.join(means, key, "left").withColumn("vector", filled).drop("_mean")


def oov_average_context(tokens: DataFrame, dim: int, width: int = 5, key: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Unknown vectors become the mean of the known ones within ``width`` positions, or zeros."""
    near = Window.partitionBy(key).orderBy(pos).rowsBetween(-width, width)
    known = F.col("vector").cast("array<double>")
    context = tokens.withColumn("_near", F.when(known.isNull(), F.collect_list(known).over(near)))
    zeros = F.array_repeat(F.lit(0.0), dim)
    mean = F.aggregate(
        "_near",
        F.struct(zeros.alias("sum"), F.lit(0).alias("n")),
        lambda a, v: F.struct(F.zip_with(a["sum"], v, lambda x, y: x + y).alias("sum"), (a["n"] + 1).alias("n")),
        lambda a: F.transform(a["sum"], lambda x: x / F.greatest(a["n"], F.lit(1))),
    )
    return context.withColumn("vector", F.coalesce(known, mean)).drop("_near")


def oov_closest(tokens: DataFrame, vectors: DataFrame, dim: int, cutoff: float = 0.8, seed: int = 0) -> DataFrame:
    """Unknown vectors become that of the closest known word, or the fixed unknown vector where no word is close enough."""
    missing = tokens.filter(F.col("vector").isNull()).select("token").distinct()
    found = closest_word(missing, vectors.select("token"), cutoff).select("token", "match")
    near = found.join(vectors.select(F.col("token").alias("match"), F.col("vector").alias("_near")), "match").select("token", "_near")
    filled = join_frequent_apart(tokens, near, "token", "left").withColumn("vector", F.coalesce("vector", "_near")).drop("_near")
    return oov_using_unk(filled, dim, seed)


def embed_tokens(tokens: DataFrame, vectors: DataFrame, dim: int, oov: str = "unk", key: str = "doc_id", pos: str = "pos") -> DataFrame:
    """``tokens (key, pos, token)`` with the ``vector`` of each, from ``vectors (token, vector)``.

    ``oov`` names what words without a vector get: ``unk`` the fixed unknown vector, ``average`` the mean of the text's
    known ones, ``context`` that of the known ones nearby, ``closest`` the vector of the closest known word.
    """
    known = vectors.select("token", F.col("vector").cast("array<double>").alias("vector"))
    embedded = materialize(join_frequent_apart(tokens, known, "token", "left"))
    ways = {
        "unk": lambda: oov_using_unk(embedded, dim),
        "average": lambda: oov_average(embedded, dim, key),
        "context": lambda: oov_average_context(embedded, dim, key=key, pos=pos),
        "closest": lambda: oov_closest(embedded, known, dim),
    }
    return ways[oov]()


# --- fuzzy vocabulary lookup -----------------------------------------------------


@F.arrow_udf(T.DoubleType())
def matching_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """``2 * matches / total length`` of the longest matching blocks, as the standard library defines it."""
    return pa.array([difflib.SequenceMatcher(None, y, x).ratio() for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def _segments(word: Column, parts: Column) -> Column:
    """Cut a word into ``parts`` near-equal pieces: ``array<struct<i, at, piece>>``."""
    def bound(i: Column) -> Column:
        return F.floor(i * F.length(word) / parts).cast("int")

    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda i: F.struct(
            i.cast("int").alias("i"), bound(i).alias("at"), F.substring(word, bound(i) + 1, bound(i + 1) - bound(i)).alias("piece")
        ),
    )


def closest_word(oov: DataFrame, vocab: DataFrame, cutoff: float = 0.8, similarity: str = "levenshtein") -> DataFrame:
    """``(token, match, similarity)``: the best vocabulary word within one character of length and above ``cutoff``.

    ``similarity`` is ``levenshtein`` (1 - edits / longer length) or ``ratio``
    (matching blocks). Words within ``e`` edits become equal when at most ``e``
    characters are left out of each: up to ``SHORTENED`` edits candidates share
    such a shortened form, which few words do whatever the vocabulary. With more
    they share an exact piece: one of ``e + 1`` pieces of the vocabulary word
    survives unchanged, shifted by at most ``e`` places. Both are exact.
    """
    slack = 1 - cutoff
    left = materialize(oov.select("token").distinct().withColumn("_n", F.length("token")).filter("_n > 0"))
    right = materialize(vocab.select(F.col("token").alias("match")).distinct().withColumn("_m", F.length("match")).filter("_m > 0"))

    def edits(n: Column, m: Column) -> Column:
        size = F.greatest(n, m) if similarity == "levenshtein" else n + m
        return F.floor(size * slack + 1e-9).cast("int")

    lengths = F.array(F.lit(-1), F.lit(0), F.lit(1))
    indexed = (
        right.select("match", "_m", F.explode(F.transform(lengths, lambda d: F.col("_m") + d)).alias("_n"))
        .withColumn("_e", edits(F.col("_n"), F.col("_m")))
        .filter(F.col("_e") > SHORTENED)
        .select("match", "_m", "_n", F.inline(_segments(F.col("match"), F.least(F.col("_e") + 1, F.col("_m")))))
        .select("match", F.struct("_m", "_n", "i", "piece").alias("_block"))
    )

    def windows(e: Column, m: Column) -> Column:
        parts = F.least(e + 1, m)
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), parts - 1),
                lambda i: F.transform(
                    F.sequence(-e, e),
                    lambda s: F.struct(
                        i.cast("int").alias("i"),
                        F.when(
                            F.floor(i * m / parts) + s >= 0,
                            F.substring(
                                F.col("token"),
                                (F.floor(i * m / parts) + s + 1).cast("int"),
                                (F.floor((i + 1) * m / parts) - F.floor(i * m / parts)).cast("int"),
                            ),
                        ).alias("piece"),
                    ),
                ),
            )
        )

    probed = (
        left.select("token", "_n", F.explode(F.transform(lengths, lambda d: F.col("_n") + d)).alias("_m"))
        .filter("_m > 0")
        .withColumn("_e", edits(F.col("_n"), F.col("_m")))
        .filter(F.col("_e") > SHORTENED)
        .select("token", "_m", "_n", F.inline(windows(F.col("_e"), F.col("_m"))))
        .filter(F.col("piece").isNotNull())
        .select("token", F.struct("_m", "_n", "i", "piece").alias("_block"))
        .distinct()
    )

    def shortened(words: DataFrame, word: str, size: str) -> DataFrame:
        """``(word, _form)``: a word without up to as many characters as it may lose against one that is a character longer."""
        most = F.least(edits(F.col(size), F.col(size) + 1), F.lit(SHORTENED))
        forms = deal_out(words.select(word, most.alias("_most"))).filter("_most > 0").withColumn("_form", F.col(word))
        found = [forms]
        for k in range(1, SHORTENED + 1):
            cut = F.transform(
                F.sequence(F.lit(1), F.length("_form")), lambda i: F.concat(F.substring(F.col("_form"), F.lit(1), i - 1), F.substring(F.col("_form"), i + 1, F.length("_form")))
            )
            fewer = found[-1].filter((F.col("_most") >= k) & (F.length("_form") > 0))
            found.append(fewer.select(word, "_most", F.explode(F.array_distinct(cut)).alias("_form")))
        return reduce(DataFrame.unionByName, found).select(word, "_form")

    edit_count = F.levenshtein("token", "match")
    near = shortened(left, "token", "_n").join(shortened(right, "match", "_m"), "_form").select("token", "match")
    near = near.filter(F.abs(F.length("token") - F.length("match")) <= 1)
    pairs = probed.join(indexed, "_block").select("token", "match").unionByName(near).filter("token <> match")
    # Close pairs are few; only they need to be told apart from their repeats.
    close = pairs.filter(edit_count <= edits(F.length("token"), F.length("match"))).distinct()
    if similarity == "levenshtein":
        score = 1 - edit_count / F.greatest(F.length("token"), F.length("match"))
    else:
        score = matching_ratio(F.col("token"), F.col("match"))
    scored = close.withColumn("similarity", score).filter(F.col("similarity") >= cutoff - 1e-9)
    return top_n_per_group(scored, ["token"], [F.desc("similarity"), F.col("match")], 1).drop("rank")


# --- nearest neighbours ------------------------------------------------------------


def _block_topk(queries: list[tuple[object, Sequence[float]]], k: int):
    """Task body: best ``k`` of one partition for every query, by blocks of matrix products."""
    names = [q for q, _ in queries]
    matrix = np.asarray([v for _, v in queries], dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = np.divide(matrix, norms, out=np.full_like(matrix, np.nan), where=norms > 0)

    def best(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(scores) > k:
            floor = np.partition(scores, len(scores) - k)[len(scores) - k]
            kept = scores >= floor
            ids, scores = ids[kept], scores[kept]
        order = np.lexsort((ids, -scores))[:k]
        return ids[order], scores[order]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(names)
        for batch in batches:
            vectors = np.stack(batch["vector"].to_numpy()).astype(np.float64)
            sizes = np.linalg.norm(vectors, axis=1)
            kept = sizes > 0
            if not kept.any():
                continue
            ids = batch["id"].to_numpy()[kept]
            scores = np.round((vectors[kept] / sizes[kept, None]) @ matrix.T, 9)
            for q in range(len(names)):
                pair = (ids, scores[:, q])
                if held[q] is not None:
                    pair = (np.concatenate([held[q][0], ids]), np.concatenate([held[q][1], scores[:, q]]))
                held[q] = best(*pair)
        for name, pair in zip(names, held):
            if pair is not None and not np.isnan(pair[1]).all():
                yield pd.DataFrame({"query_id": [name] * len(pair[0]), "id": pair[0], "cosine": pair[1]})

    return run


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = 20, block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, id, cosine, rank)``: the ``k`` vectors most similar to each query vector, exact.

    Inputs are ``(query_id, vector)`` and ``(id, vector)``. Each task scores its
    vectors against a block of queries as a matrix product and emits only its
    best ``k``, so neither pairs nor vectors are shuffled. Queries beyond
    ``block`` are taken in further passes over the vectors.
    """
    kinds = {f.name: f.dataType for f in (*queries.schema, *vectors.schema)}
    schema = T.StructType(
        [T.StructField("query_id", kinds["query_id"]), T.StructField("id", kinds["id"]), T.StructField("cosine", T.DoubleType())]
    )
    source = vectors.filter(F.col("vector").isNotNull()).select("id", "vector")
    asked = queries.filter(F.col("vector").isNotNull()).select("query_id", "vector").distinct()
    blocks = row_blocks(asked, ["query_id", "vector"], block)
    parts = [source.mapInPandas(_block_topk([(r[0], r[1]) for r in rows], k), schema) for rows in blocks if rows]
    if not parts:
        return source.sparkSession.createDataFrame([], schema.add("rank", T.IntegerType()))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return top_n_per_group(found, ["query_id"], [F.desc("cosine"), F.col("id")], k)


def semantic_keywords(queries: DataFrame, candidates: DataFrame, vectors: DataFrame, k: int = 20) -> DataFrame:
    """Best ``k`` candidate words of each request by similarity to the request, with their counts.

    ``queries (query_id, word)``, ``candidates (query_id, keyword, count)`` and
    ``vectors (token, vector)``. A request's vector is the mean of its words' vectors.
    """
    asked = queries.join(vectors, queries["word"] == vectors["token"]).groupBy("query_id").agg(mean_vector("vector").alias("_q"))
    words = candidates.join(vectors, candidates["keyword"] == vectors["token"]).select("query_id", "keyword", "count", "vector")
    scored = words.join(asked, "query_id").withColumn("similarity", F.round(cosine(F.col("_q"), F.col("vector")), 9)).drop("_q", "vector")
    return top_n_per_group(scored, ["query_id"], [F.desc("similarity"), F.col("keyword")], k)


# --- cluster quality ---------------------------------------------------------------


def centroids(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(cluster, centroid, n)``."""
    return df.groupBy(F.col(cluster).alias("cluster")).agg(mean_vector(vector).alias("centroid"), F.count("*").alias("n"))


def intra_distances(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(cluster, n, spread, centroid)``: mean distance of a cluster's points to its centroid.

    The centroids (a row per cluster) ride along as one map, so the points are not shuffled.
    """
    table = centroids(df, cluster, vector).agg(F.map_from_entries(F.collect_list(F.struct("cluster", "centroid")))).scalar()
    placed = df.select(F.col(cluster).alias("cluster"), F.col(vector).alias("v"), F.element_at(table, F.col(cluster)).alias("centroid"))
    return placed.groupBy("cluster").agg(
        F.count("*").alias("n"), F.avg(distance(F.col("v"), F.col("centroid"))).alias("spread"), F.first("centroid").alias("centroid")
    )


def centroid_distances(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(a, b, distance)`` between all centroids: the square of the number of clusters, not of points."""
    row = centroids(df, cluster, vector).agg(F.collect_list(F.struct("cluster", "centroid")).alias("all"))
    pairs = row.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    return pairs.select(F.col("x.cluster").alias("a"), F.col("y.cluster").alias("b"), distance(F.col("x.centroid"), F.col("y.centroid")).alias("distance"))


def davies_bouldin(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """Mean over clusters of the worst ratio of spreads to centroid distance."""
    row = intra_distances(df, cluster, vector).agg(F.collect_list(F.struct("cluster", "centroid", "spread")).alias("all"))
    pairs = row.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")).filter("x.cluster <> y.cluster")
    ratio = F.try_divide(F.col("x.spread") + F.col("y.spread"), distance(F.col("x.centroid"), F.col("y.centroid")))
    worst = pairs.groupBy("x.cluster").agg(F.max(F.coalesce(ratio, F.lit(0.0))).alias("worst"))
    return worst.agg(F.avg("worst").alias("davies_bouldin"))


def mean_intra_distance(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    return intra_distances(df, cluster, vector).agg(F.avg("spread").alias("mean_intra_distance"))


def silhouette_squared(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """Mean silhouette under squared Euclidean distance.

    The mean squared distance of a point to a cluster follows from the
    cluster's mean and mean square, so one pass over the points is enough.
    """
    own = F.col(vector).cast("array<double>")
    points = df.select(F.col(cluster).alias("cluster"), own.alias("v")).withColumn("sq", dot(F.col("v"), F.col("v")))
    stats = points.groupBy("cluster").agg(mean_vector("v").alias("center"), F.avg("sq").alias("mean_sq"), F.count("*").alias("n"))
    table = stats.agg(F.collect_list(F.struct("cluster", "center", "mean_sq", "n")).alias("t")).scalar()
    spread = F.transform(
        "t", lambda s: F.struct(s["cluster"].alias("c"), s["n"].alias("n"), (F.col("sq") + s["mean_sq"] - 2 * dot(F.col("v"), s["center"])).alias("d"))
    )
    scored = points.withColumn("t", table).withColumn("d", spread)
    mine = F.filter("d", lambda x: x["c"] == F.col("cluster"))
    others = F.filter("d", lambda x: x["c"] != F.col("cluster"))
    ab = scored.select(mine[0]["n"].alias("n"), (mine[0]["d"] * mine[0]["n"]).alias("total"), F.array_min(F.transform(others, lambda x: x["d"])).alias("b"))
    a = F.try_divide(F.col("total"), F.col("n") - 1)
    value = F.when((F.col("n") <= 1) | F.col("b").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - a, F.greatest(a, F.col("b"))), F.lit(0.0)))
    return ab.agg(F.avg(value).alias("silhouette_squared"))
