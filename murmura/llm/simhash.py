"""SimHash near-dedup: fingerprints, and the pairs of them within a Hamming budget by a binary trie self-join.

Equal fingerprints are one leaf, so copies are never paired. The trie's top
levels deal the leaves to groups, one per pair of prefixes within the budget;
inside a group the two subtrees are traversed together, a pair of nodes being
dropped once its differing bits exceed the budget. The depth of the top levels
follows the number of leaves under the fullest prefix, so no group outgrows a task.

A fingerprint has at most 64 + 64 * 63 / 2 neighbours at two bits, and each
group returns only links that join what it has not joined yet, closest first.

Nulls: a null or empty text has no words and the fingerprint zero, which is
linked like any other. Null ids are carried; a component of nulls only has a
null id. Rows that repeat an id or a text share its component. Empty tables
give empty results; extra columns are carried through ``drop_near_copies``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import broadcast_if_small, query, table
from murmura.llm.bytescan import FOLD_BYTES, row_blocks, utf8
from murmura.llm.components import components
from murmura.session import materialize

BUDGET = 2
WIDTH = 3
SEED = 42

# Leaves under one prefix: eight bytes each in a task.
GROUP_LEAVES = 250_000
_MIN_DEPTH, _MAX_DEPTH = 4, 20
# Node pairs handled at once, and the pairs of leaves below which a node pair is compared directly.
_CHUNK, _DIRECT = 1 << 16, 32


# --- fingerprints ------------------------------------------------------------------


def _majority(hashes: np.ndarray, weights: np.ndarray | None, bounds: np.ndarray) -> np.ndarray:
    """Per text (rows ``bounds[i]`` to ``bounds[i + 1]``), the bits set in more than half of its weighted hashes."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    at = bounds[full]
    total = np.add.reduceat(weights, at) if weights is not None else np.diff(bounds)[full]
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        bits = np.unpackbits(octets[:, k : k + 1], axis=1)
        for j in range(8):
            column = bits[:, j] * weights if weights is not None else bits[:, j].astype(np.int64)
            ones = np.add.reduceat(column, at)
            out[full] |= (2 * ones > total).astype(np.uint64) << np.uint64(63 - 8 * k - j)
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The numeric columns ``carry`` and the fingerprint: majority bits of the XXH64 of all word shingles, repeats included."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for whole in batches:
            for batch in row_blocks(whole, "text", 2 << 20):
                raw, offsets = utf8(batch.column("text"))
                body = raw.tobytes().translate(FOLD_BYTES)
                hashes, counts = [], []
                for i in range(batch.num_rows):
                    own = body[offsets[i] : offsets[i + 1]].split()  # at the six ASCII white space characters
                    n = len(own) - width + 1
                    line = b" ".join(own)
                    if n > 1:
                        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
                        starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
                        hashes += [digest(line[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
                    elif own:
                        hashes.append(digest(line, seed))
                    counts.append(max(n, 1) if own else 0)
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                prints = _majority(np.array(hashes, np.uint64), None, bounds)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(prints.view(np.int64))], names=[*carry, "fingerprint"])

    numbers = [F.col(c).cast("bigint").alias(c) for c in carry]
    return docs.select(*numbers, "text").mapInArrow(rows, ", ".join(f"{c} bigint" for c in [*carry, "fingerprint"]))


# --- trie self-join ----------------------------------------------------------------


def _direct(a: np.ndarray, b: np.ndarray, node: np.ndarray, budget: int, own: bool) -> np.ndarray:
    """Leaf pairs (i, j, distance) of node pairs small enough to compare one by one."""
    na, nb = node[:, 1] - node[:, 0], node[:, 3] - node[:, 2]
    n = na * nb
    which = np.repeat(np.arange(len(node)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i = node[which, 0] + step // nb[which]
    j = node[which, 2] + step % nb[which]
    if own:
        upper = i < j
        i, j = i[upper], j[upper]
    apart = np.bitwise_count(a[i] ^ b[j]).astype(np.int64)
    near = apart <= budget
    return np.stack([i[near], j[near], apart[near]], axis=1)


def close_pairs(a: np.ndarray, b: np.ndarray | None, budget: int, depth: int = 0) -> Iterator[np.ndarray]:
    """Pairs (i, j, distance) within the budget of two sorted arrays of distinct 64-bit values, or of one with itself.

    A node is a range of leaves that agree in their first ``depth`` bits; its
    children split the range at the next bit. Errors so far are the bits in
    which the two nodes' prefixes differ.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    start = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    stack = [(depth, np.array([[0, len(a), 0, len(b), start]], np.int64))]
    while stack:
        level, node = stack.pop()
        if len(node) > _CHUNK:
            stack += [(level, node[_CHUNK:]), (level, node[:_CHUNK])]
            continue
        small = ((node[:, 1] - node[:, 0]) * (node[:, 3] - node[:, 2]) <= _DIRECT) | (level == 64)
        if small.any():
            pairs = _direct(a, b, node[small], budget, own)
            if len(pairs):
                yield pairs
            node = node[~small]
        if not len(node):
            continue
        bit = np.uint64(63 - level)
        mid_a = _split(a, node[:, 0], node[:, 1], bit)
        mid_b = _split(b, node[:, 2], node[:, 3], bit)
        same = (node[:, 0] == node[:, 2]) & own
        children = []
        for x, y in ((0, 0), (1, 1), (0, 1), (1, 0)):
            errors = node[:, 4] + (x != y)
            lo_a, hi_a = (node[:, 0], mid_a) if x == 0 else (mid_a, node[:, 1])
            lo_b, hi_b = (node[:, 2], mid_b) if y == 0 else (mid_b, node[:, 3])
            live = (errors <= budget) & (hi_a > lo_a) & (hi_b > lo_b)
            if (x, y) == (1, 0):
                live &= ~same  # the mirror of (0, 1)
            children.append(np.stack([lo_a, hi_a, lo_b, hi_b, errors], axis=1)[live])
        stack.append((level + 1, np.concatenate(children)))


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where in each range the next bit turns to one."""
    boundary = ((values[lo] >> bit) | np.uint64(1)) << bit
    return np.clip(np.searchsorted(values, boundary), lo, hi)


def _joining(pairs: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The pairs, closest first, that join parts not joined yet; ``parent`` is updated."""

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, j in pairs[np.argsort(pairs[:, 2], kind="stable"), :2].tolist():
        x, y = find(i), find(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((i, j))
    return np.array(kept, np.int64).reshape(-1, 2)


def _rooted(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return up
        parent = up


def group_links(a: np.ndarray, b: np.ndarray | None, budget: int, depth: int) -> np.ndarray:
    """Links (values) that span what is connected within the budget inside one group."""
    nodes = a if b is None else np.concatenate([a, b])
    shift = 0 if b is None else len(a)
    parent, out = np.arange(len(nodes)), []
    for pairs in close_pairs(a, b, budget, depth):
        pairs[:, 1] += shift
        root = _rooted(parent)
        pairs = pairs[root[pairs[:, 0]] != root[pairs[:, 1]]]
        kept = _joining(pairs, parent)
        out.append(nodes[kept])
    return np.concatenate(out) if out else np.zeros((0, 2), np.uint64)


def _masks(depth: int, budget: int) -> list[int]:
    return [sum(1 << k for k in bits) for n in range(min(budget, depth) + 1) for bits in combinations(range(depth), n)]


def _depth(leaves: DataFrame) -> int:
    """Bits of the top levels: as many as keep the leaves of the fullest prefix under ``GROUP_LEAVES``."""
    total = leaves.count()
    depth = min(_MAX_DEPTH, max(_MIN_DEPTH, math.ceil(math.log2(max(total, 1) / GROUP_LEAVES)) if total else 0))
    while depth < _MAX_DEPTH:
        fullest = leaves.groupBy(F.shiftrightunsigned("fingerprint", 64 - depth)).count().agg(F.max("count")).first()[0] or 0
        if fullest <= GROUP_LEAVES:
            break
        depth += 2
    return depth


def near_links(leaves: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (a, b) between distinct fingerprints; what they connect is what all pairs within the budget connect."""
    leaves = materialize(leaves.select("fingerprint").distinct())
    depth = _depth(leaves)
    prefix = F.shiftrightunsigned("fingerprint", 64 - depth)
    masks = F.array(*[F.lit(m).cast("bigint") for m in _masks(depth, budget)])
    dealt = leaves.select("fingerprint", prefix.alias("own"), F.explode(masks).alias("mask"))
    other = F.col("own").bitwiseXOR(F.col("mask"))
    dealt = dealt.select("fingerprint", F.least("own", other).alias("low"), F.greatest("own", other).alias("high"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (low, high), values in _groups(batches):
            cut = int(np.searchsorted(values, np.uint64(high << (64 - depth)))) if high > low else 0
            links = group_links(values[:cut], values[cut:], budget, depth) if cut else group_links(values, None, budget, depth) if low == high else ()
            if len(links):
                links = links.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return dealt.repartition("low", "high").sortWithinPartitions("low", "high").mapInArrow(joined, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """Groups of a partition that is sorted by (low, high): the key and its sorted fingerprints."""
    key, parts = None, []
    for batch in batches:
        low, high = batch.column("low").to_numpy(), batch.column("high").to_numpy()
        values = batch.column("fingerprint").to_numpy().view(np.uint64)
        cuts = [0, *(np.flatnonzero((low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1).tolist(), len(values)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            own = (int(low[lo]), int(high[lo]))
            if own != key and parts:
                yield key, np.sort(np.concatenate(parts))
                parts = []
            key = own
            parts.append(values[lo:hi])
    if parts:
        yield key, np.sort(np.concatenate(parts))


# --- queries -----------------------------------------------------------------------


def component_roots(leaves: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(fingerprint, root) of distinct fingerprints: the least one that links reach."""
    leaves = materialize(leaves.select("fingerprint"))
    roots = components(near_links(leaves, budget)).withColumnRenamed("node", "fingerprint")
    return materialize(leaves.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")))


def near_components(docs: DataFrame, budget: int = BUDGET, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id that links of fingerprints reach."""
    prints = materialize(fingerprints(docs, width, seed))
    leaves = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    rooted = leaves.join(component_roots(leaves, budget), "fingerprint")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = materialize(rooted.join(named, "root").select("fingerprint", "component_id"))
    return prints.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_copies(docs: DataFrame, budget: int = BUDGET, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``docs`` with one document of each component of near fingerprints: the one of the least id, and of the least hash among rows that share it.

    Rows are named by 128 bits of id and text. What goes is joined against the
    documents, not what stays, so texts move only where very much goes.
    """
    text = F.coalesce("text", F.lit(""))
    key = [F.xxhash64("doc_id", text).alias("_high"), F.xxhash64(F.lit(seed), text, "doc_id").alias("_low")]
    keyed = docs.withColumns({"_high": key[0], "_low": key[1]})
    prints = materialize(fingerprints(keyed.select("doc_id", "_high", "_low", "text"), width, seed, ("doc_id", "_high", "_low")))
    labels = component_roots(prints.select("fingerprint").distinct(), budget)
    rows = materialize(prints.join(labels, "fingerprint").groupBy("root", "doc_id", "_high", "_low").agg(F.count("*").alias("copies")))
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "_high", "_low")).alias("first"))
    kept = materialize(first.select("root", "first._high", "first._low"))
    dropped = materialize(rows.join(kept, ["root", "_high", "_low"], "left_anti").select("_high", "_low").distinct())
    left = keyed.join(broadcast_if_small(dropped), ["_high", "_low"], "left_anti")
    again = materialize(rows.filter("copies > 1").join(kept, ["root", "_high", "_low"]).select("_high", "_low"))
    if again.isEmpty():
        return left.select(*docs.columns)
    again = broadcast_if_small(again)
    once = left.join(again, ["_high", "_low"], "left_anti")
    return once.unionAll(left.join(again, ["_high", "_low"], "left_semi").dropDuplicates(["_high", "_low"]).select(once.columns)).select(*docs.columns)


@query("op7_simhash_near_dedup", None)
def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
