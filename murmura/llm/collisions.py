"""Embedding near-dedup by counting collisions of one-dimensional projections.

Unit vectors are projected on orthonormal directions. Two of them at cosine c lie
sqrt(2 - 2c) apart, and the squared differences of their projections sum to at
most that distance squared. So of m projections at most f can differ by more
than w = distance / sqrt(f): in windows of half-width w centred at a query, every
pair at the wanted cosine or above collides at least m - f times. That count is
the threshold; its recall is one, not an estimate. Pairs that reach it are
verified by cosine in double precision.

Equal vectors are one class. Classes are sorted by the projection on their
widest direction and cut into blocks; blocks whose ranges lie further apart than
the distance never meet, nor do the parts of two blocks outside each other's
window. Within two blocks the remaining projections are compared by a byte each,
tile by tile. Tasks return link counts and links that join what they have not
joined yet, never all pairs. Where vectors fill all directions alike, every two
blocks meet, and the work grows with the square of the classes.

Vectors that are null, zero, or hold null or non-finite entries link with
nothing and keep their own id. A shorter vector counts as one with zeros at its
end. Repeated rows are vectors of their own, linked with each other; null ids are
carried, and a component of them only has a null id. An empty table stays empty;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import broadcast_if_small, numbered, query, table
from murmura.llm.components import components
from murmura.session import materialize

COSINE = 0.9
PROJECTIONS = 48
# One in so many projections of a linked pair may miss its window.
MISSES_OF = 4
# Classes are cut into so many blocks at least, of so many classes at most: two blocks are held by a task.
LEAST_BLOCKS, BLOCK = 16, 1 << 15
SEED = 12

# Bytes per unit of a projection, and the greatest byte, so that differences never wrap into a window.
_FINE, _GREATEST = 200, 200
_TILE_ROWS, _TILE_COLUMNS = 256, 4096
# Of a tile, as many candidates as make one product of the whole tile cheaper than one by one.
_DENSE = 1 << 15
_SLACK = 1e-9


def _unit(column: pa.Array, d: int) -> np.ndarray:
    """Unit vectors in double precision; entries are scaled by a power of two first, so squares stay finite."""
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), d))
    out[np.arange(d) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    out = np.ldexp(out, -np.frexp(np.abs(out).max(1, initial=0))[1][:, None])
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def classes_of(vectors: DataFrame) -> DataFrame:
    """(embedding, first_id, copies) of the vectors that can be linked."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    sound = F.forall("embedding", entry) & F.exists("embedding", lambda c: c != 0)
    kept = vectors.filter(F.coalesce(F.col("embedding").isNotNull() & sound, F.lit(False)))
    return kept.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))


def directions(classes: DataFrame, d: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Orthonormal directions as columns: the one along which the unit vectors spread most, then random ones."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1))
        for batch in batches:
            u = np.concatenate([_unit(batch.column("embedding"), d), np.ones((batch.num_rows, 1))], axis=1)
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    parts = classes.select("embedding").mapInArrow(rows, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    whole = np.zeros((d + 1, d + 1))
    whole[cells["i"], cells["j"]] = cells["v"]
    mean = whole[:d, d] / whole[d, d]
    _, axes = np.linalg.eigh(whole[:d, :d] / whole[d, d] - np.outer(mean, mean))
    m = min(d, projections)
    rest = np.random.default_rng(seed).standard_normal((d, m))
    rest[:, 0] = axes[:, -1]
    return np.linalg.qr(rest)[0]


def _linked(roots: np.ndarray, parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Join links (a, b): the new roots, and the links that joined something."""
    kept = []
    while True:
        x, y = roots[a], roots[b]
        apart = x != y
        if not apart.any():
            return roots, kept
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        high, low = np.maximum(x, y), np.minimum(x, y)
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
        parent[high[first]] = low[first]
        kept.append((a[first], b[first]))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        roots = parent


def _links(u: np.ndarray, h: np.ndarray, cut: int, cosine: float, misses: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (i, j) between the first ``cut`` unit vectors and the rest, or among all where ``cut`` is zero.

    Both parts are sorted by their first projection ``h[:, 0]``.
    """
    distance = math.sqrt(max(0.0, 2 - 2 * cosine))
    m = h.shape[1]
    window = distance / math.sqrt(misses) if misses else distance
    # A difference of at most ``window`` is one of at most this many bytes.
    reach = min(int(window * _FINE) + 1, 255 - _GREATEST)
    wide = int(window * _FINE) + 1 > 255 - _GREATEST
    coded = np.clip(np.floor(h * _FINE) + _GREATEST // 2, 0, _GREATEST).astype(np.uint8).T.copy()
    lead, n = h[:, 0], len(u)
    own = cut == 0
    first = n if own else cut
    for lo in range(0, first, _TILE_ROWS):
        hi = min(first, lo + _TILE_ROWS)
        begin = 0 if own else cut
        near = lead[begin:]
        left = begin + int(np.searchsorted(near, lead[lo] - distance - _SLACK))
        right = begin + int(np.searchsorted(near, lead[hi - 1] + distance + _SLACK, side="right"))
        for at in range(max(left, lo) if own else left, right, _TILE_COLUMNS):
            to = min(right, at + _TILE_COLUMNS)
            if wide or not misses:
                i, j = (x.ravel() for x in np.mgrid[lo:hi, at:to])
            else:
                hits = np.zeros((hi - lo, to - at), np.uint8)
                gap, flag = np.empty_like(hits), np.empty(hits.shape, bool)
                for k in range(m):
                    np.subtract((coded[k, lo:hi] + np.uint8(reach))[:, None], coded[k, at:to][None, :], out=gap)
                    np.less_equal(gap, 2 * reach, out=flag)
                    np.add(hits, flag.view(np.uint8), out=hits)
                i, j = np.nonzero(hits >= m - misses)
                i, j = i + lo, j + at
            if own:
                upper = i < j
                i, j = i[upper], j[upper]
            if len(i) > _DENSE:
                close = (u[lo:hi] @ u[at:to].T)[i - lo, j - at]
            else:
                close = np.einsum("ij,ij->i", u[i], u[j])
            found = close >= cosine
            if found.any():
                yield i[found], j[found]


def _spans(ends: DataFrame, distance: float) -> DataFrame:
    """(block, first, last): the blocks whose ranges lie within ``distance``. One row of three numbers per block, so one
    for some ten thousand classes, may be gathered."""
    rows = ends.toArrow().sort_by("block")
    low, high = rows.column("low").to_numpy(), rows.column("high").to_numpy()
    first = np.searchsorted(high, low - distance)
    last = np.searchsorted(low, high + distance, side="right") - 1
    return ends.sparkSession.createDataFrame(pa.table({"block": rows.column("block"), "first": first.astype(np.int64), "last": last.astype(np.int64)}))


def linked_classes(blocks: DataFrame, spans: DataFrame, turn: np.ndarray, cosine: float) -> DataFrame:
    """(a, b, links) from classes (rank, block, embedding, copies) and the blocks' reach (block, first, last): rows with
    ``b`` are links that span what is connected, the others count the vectors that class ``a`` links."""
    d, m = turn.shape
    misses = max(1, m // MISSES_OF) if m >= MISSES_OF else 0

    def meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("rank")
        rank, copies, block = (rows.column(c).to_numpy() for c in ("rank", "copies", "block"))
        u = _unit(rows.column("embedding").combine_chunks(), d)
        cut = int((block == block[0]).sum()) % len(block) if len(block) else 0
        if key[0].as_py() != key[1].as_py() and not cut:
            return _LINKS.empty_table()  # a block without a partner: nothing to compare
        counts = np.zeros(len(rank), np.int64)
        parent = np.arange(len(rank))
        roots, edges = parent, []
        for i, j in _links(u, u @ turn, cut, cosine, misses):
            counts += np.bincount(i, copies[j], len(rank)).astype(np.int64) + np.bincount(j, copies[i], len(rank)).astype(np.int64)
            roots, kept = _linked(roots, parent, i, j)
            edges += kept
        some = np.flatnonzero(counts)
        a = np.concatenate([rank[some], *[rank[i] for i, _ in edges]])
        b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), *[pa.array(rank[j], pa.int64()) for _, j in edges]])
        links = pa.array(np.concatenate([counts[some], np.zeros(len(a) - len(some), np.int64)]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": b, "links": links}, schema=_LINKS)

    reach = spans.select("block", "first", "last")
    pairs = reach.agg(F.sum(F.col("last") - F.col("block") + 1)).first()[0] or 1
    # A row meets the later blocks within reach as the lesser side, and the earlier ones as the greater.
    met = F.concat(
        F.transform(F.sequence("block", "last"), lambda x: F.struct(F.col("block").alias("x"), x.alias("y"))),
        F.transform(F.sequence("first", "block"), lambda x: F.struct(x.alias("x"), F.col("block").alias("y"))),
    )
    dealt = blocks.join(F.broadcast(reach), "block").select("rank", "block", "copies", "embedding", F.explode(F.array_distinct(met)).alias("met"))
    dealt = dealt.select("rank", "block", "copies", "embedding", "met.x", "met.y").repartition(int(min(pairs, 10_000)), "x", "y")
    return dealt.groupBy("x", "y").applyInArrow(meet, "a bigint, b bigint, links bigint")


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def near_vectors(vectors: DataFrame, cosine: float = COSINE, projections: int = PROJECTIONS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of a table (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    classes = materialize(classes_of(rows))
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    own = [F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
    if not size["n"]:
        return rows.select("vec_id", *own)
    d = size["d"]
    turn = directions(classes, d, projections)
    lead = turn[:, 0]

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(_unit(batch.column("embedding"), d) @ lead)
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "lead"])

    kind = classes.schema["embedding"].dataType.simpleString()
    leading = classes.mapInArrow(led, f"embedding {kind}, first_id bigint, copies bigint, lead double")
    height = min(BLOCK, math.ceil(size["n"] / LEAST_BLOCKS))
    ranked = numbered(leading, [F.col("lead"), F.col("first_id")], "rank").withColumn("block", F.floor(F.col("rank") / height))
    ranked = materialize(ranked)
    ends = materialize(ranked.groupBy("block").agg(F.min("lead").alias("low"), F.max("lead").alias("high")))
    spans = _spans(ends, math.sqrt(max(0.0, 2 - 2 * cosine)) + _SLACK)
    found = materialize(linked_classes(ranked, spans, turn, cosine))
    links = found.filter("b is null").groupBy(F.col("a").alias("rank")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rank")
    rooted = ranked.select("rank", "first_id").join(roots, "rank", "left").withColumn("root", F.coalesce("root", "rank"))
    rooted = materialize(rooted)
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(first, "root").join(links, "rank", "left").select("rank", "component_id", F.coalesce("links", F.lit(0)).alias("links")))
    by_vector = ranked.select("rank", "embedding", "copies").join(broadcast_if_small(named), "rank")
    by_vector = by_vector.select("embedding", (F.col("links") + F.col("copies") - 1).alias("links"), "component_id", F.lit(True).alias("linked"))
    joined = rows.join(by_vector, "embedding", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


@query("op12_embedding_near_dedup", None)
def op12_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))
