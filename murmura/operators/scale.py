"""Helpers that keep ranks, running totals and consecutive ids exact when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.session import materialize

# Spark ranks within partitions before the shuffle only up to this many rows
# per group (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000


# Rows of a few columns that may be broadcast: some tens of megabytes.
_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A materialised table of few columns, hinted for broadcast up to a counted size and left to a shuffle beyond it."""
    return F.broadcast(df) if df.count() <= _BROADCAST_ROWS else df


def bounded_rows(df: DataFrame, limit: int) -> list | None:
    """The rows when there are at most ``limit``, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def row_blocks(df: DataFrame, columns: Sequence[str], block: int) -> Iterator[list]:
    """Distinct rows in lists of at most ``block``, one at a time: whole when they fit, else by hash of ``columns``; a list
    that is too full is halved by the next hash bit."""
    whole = bounded_rows(df, block)
    if whole is not None:
        yield whole
        return
    bits = max(1, (2 * df.count() // block).bit_length())
    pending = [(part, 1 << bits) for part in range(1 << bits)]
    while pending:
        part, of = pending.pop()
        rows = bounded_rows(df.filter(F.pmod(F.xxhash64(*columns), F.lit(of)) == part), block)
        if rows is None:
            pending += [(part, 2 * of), (part + of, 2 * of)]
        else:
            yield rows


def rows_by_repeat(df: DataFrame, key: str, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``(alone, together)``: the rows whose key no other row has, and those that share one, None where no rows do. Null is a key.

    ``keys`` is the ``key`` column of the same rows, where reading it from ``df`` would compute more than that.
    """
    counts = (df.select(key) if keys is None else keys).groupBy(key).agg(F.count("*").alias("_rows")).filter("_rows > 1")
    shared = materialize(counts.select(F.col(key).alias("_shared"), F.lit(True).alias("_again")))
    if shared.isEmpty():
        return df, None
    marked = df.join(broadcast_if_small(shared), F.col(key).eqNullSafe(F.col("_shared")), "left").drop("_shared")
    return marked.filter(F.col("_again").isNull()).drop("_again"), marked.filter("_again").drop("_again")


def deal_out(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows dealt to all tasks of the session by ``columns``: for a table that is small on disk and much work a row.

    Where ``df`` is grouped by a column, deal by its hash: Spark drops a second exchange by the same column, and may put tasks together then.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *columns)


# Keys told apart as frequent, and the counters of the sketch that finds them: its error is 3.5 rows in 16,384, so every
# key with a thousandth of the rows is among them.
FREQUENT_KEYS, SKETCH_ITEMS = 1_000, 10_000


def frequent_values(df: DataFrame, column: str, most: int = FREQUENT_KEYS) -> DataFrame:
    """``(column)``: at most ``most`` of its most frequent values, by bounded counters per task that are merged."""
    found = df.agg(F.expr(f"approx_top_k(`{column}`, {most}, {max(most, SKETCH_ITEMS)})").alias("top"))
    return found.select(F.inline("top")).select(F.col("item").alias(column))


def join_frequent_apart(left: DataFrame, right: DataFrame, key: str, how: str = "inner", frequent: DataFrame | None = None) -> DataFrame:
    """``left.join(right, key, how)`` for a ``left`` that a few keys dominate, such as the words of texts; ``how`` is inner or left.

    Rows of frequent keys meet their part of ``right`` by broadcast and stay where they are, the rest are shuffled. Which
    keys are frequent decides the way only, never the rows. ``left`` is read up to three times, so it should be a stored
    table; ``frequent`` (at most some thousand keys) saves the pass that finds them. Null keys match nothing and are not
    shuffled either. ``right`` should have few rows a key: its frequent part is broadcast up to a counted size.
    """
    hot = materialize(frequent_values(left, key) if frequent is None else frequent.select(key).distinct())
    marks = F.broadcast(hot.withColumn("_frequent", F.lit(True)))  # bounded by construction
    marked = left.join(marks, key, "left")
    stays = F.col("_frequent").isNotNull() | F.col(key).isNull()
    few = broadcast_if_small(materialize(right.join(F.broadcast(hot), key, "left_semi")))
    apart = marked.filter(stays).drop("_frequent").join(few, key, how)
    rest = marked.filter(~stays).drop("_frequent").join(right, key, how)
    return apart.unionByName(rest)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank", salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank.

    For large ``n`` Spark does not pre-rank before its shuffle, so the group is
    first cut to ``n`` rows in each of ``salts`` parts: no task sorts a whole hot group.
    """
    if n > _GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_part_rank", F.row_number().over(part)).filter(F.col("_part_rank") <= n)
        df = df.drop("_salt", "_part_rank")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


def running(
    df: DataFrame, keys: Sequence[str], order: str, aggregates: dict[str, tuple[str, Column]], width: int = 50_000
) -> DataFrame:
    """Running ``sum`` or ``max`` per key in the order of a numeric column that is unique within the key.

    Totals of stretches of ``width`` order values are accumulated first, so a
    long series spreads over many tasks instead of one sort.
    """
    functions = {"sum": F.sum, "max": F.max}
    combine = {
        "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        "max": lambda a, b: F.greatest(a, b),
    }
    stretched = df.withColumn("_stretch", F.floor(F.col(order) / width))
    totals = stretched.groupBy(*keys, "_stretch").agg(
        *[functions[kind](value).alias(f"_total_{name}") for name, (kind, value) in aggregates.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_stretch",
        *[functions[kind](f"_total_{name}").over(before).alias(f"_before_{name}") for name, (kind, _) in aggregates.items()],
    )
    inside = Window.partitionBy(*keys, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = stretched.join(offsets, [*keys, "_stretch"])
    out = joined.withColumns(
        {name: combine[kind](F.col(f"_before_{name}"), functions[kind](value).over(inside)) for name, (kind, value) in aggregates.items()}
    )
    return out.drop("_stretch", *[f"_before_{name}" for name in aggregates])


def consecutive_ids(df: DataFrame, lead: str, order: Sequence[str], id_col: str = "id", start: int = 0, parts: int = 256) -> DataFrame:
    """Number rows in the global order of ``lead`` (numeric) then ``order``, without a one-task sort.

    Quantiles of ``lead`` cut the rows into ranges; rows are numbered inside
    their range and shifted by the counts of the earlier ones. ``df`` must give
    the same rows each time it is evaluated.
    """
    bounds = sorted(set(df.approxQuantile(lead, [i / parts for i in range(1, parts)], 0.001)))
    # The cut at zero stands in where there are no rows.
    splits = [float("-inf"), *(bounds or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_lead", outputCol="_range").transform(df.withColumn("_lead", F.col(lead).cast("double")))
    counts = ranged.groupBy("_range").count()
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(lead, *order)
    numbered = ranged.join(F.broadcast(offsets), "_range")  # at most ``parts`` rows
    numbered = numbered.withColumn(id_col, (F.row_number().over(inside) - 1 + F.col("_offset") + start).cast("bigint"))
    return numbered.drop("_lead", "_range", "_offset")
