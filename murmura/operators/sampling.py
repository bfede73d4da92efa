"""Samples, splits and pages that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

_TAKE_LIMIT = 100_000


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 8888) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by the order of a seeded hash of ``key``.

    Small samples are a distributed top-n. Larger ones find the hash prefix in
    which row ``n`` falls, keep the prefixes before it whole and rank only that one.
    """
    ranked = df.withColumn("_digest", _digest(key, seed))
    if n <= _TAKE_LIMIT:
        return ranked.orderBy("_digest", key).limit(n).drop("_digest")
    ranked = ranked.withColumn("_prefix", F.substring("_digest", 1, 4))
    sizes = ranked.groupBy("_prefix").count()  # at most 65,536 rows
    before = Window.partitionBy(F.lit(0)).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    room = sizes.select("_prefix", (F.lit(n) - F.coalesce(F.sum("count").over(before), F.lit(0))).alias("_room"), "count")
    kept = ranked.join(F.broadcast(room.filter("_room > 0")), "_prefix")
    whole = kept.filter(F.col("count") <= F.col("_room")).select(*df.columns)
    last = kept.filter(F.col("count") > F.col("_room"))
    rank = F.row_number().over(Window.partitionBy("_prefix").orderBy("_digest", key))
    cut = last.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_room")).select(*df.columns)
    return whole.unionByName(cut)


def hash_fraction(key: str, seed: int, resolution: int = 1000) -> Column:
    """Stable pseudo-random value in [0, resolution) for a row."""
    return F.pmod(F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(resolution))


def split_by_hash(df: DataFrame, key: str, ratios: dict[str, float], seed: int = 42) -> DataFrame:
    """Add ``split``: names of ``ratios`` in order, each taking its share of the hash range."""
    point = hash_fraction(key, seed)
    names = list(ratios)
    total, edge, split = sum(ratios.values()), 0.0, None
    for name in names[:-1]:
        edge += ratios[name]
        bound = round(1000 * edge / total)
        split = F.when(point < bound, name) if split is None else split.when(point < bound, name)
    split = F.lit(names[-1]) if split is None else split.otherwise(names[-1])
    return df.withColumn("split", split)


def train_val_test(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Two successive 10 % cuts: test first, then validation from the rest."""
    return split_by_hash(df, key, {"test": 0.1, "val": 0.09, "train": 0.81}, seed)


def page(df: DataFrame, order: list[Column], rows: int, start: int = 0) -> DataFrame:
    """Rows ``start`` to ``start + rows`` of a total order."""
    return df.orderBy(*order).offset(start).limit(rows) if start else df.orderBy(*order).limit(rows)
