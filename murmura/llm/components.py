"""Connected components of a graph given as links, by alternating stars.

Every round points each node's larger neighbours, then its smaller ones, at its
least neighbour, and ends when no link changes. Rounds are written to the shared
folder, so a lost executor costs a rerun of one round at most. A hub is spread
by partial minima before the shuffle and by the adaptive skew split in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.session import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b): with ``large``, the larger neighbours of each node move to its least; else the smaller ones and the node."""
    if large:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_least")).withColumn("_least", F.least("a", "_least"))
        moved = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("_least"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        moved = moved.unionAll(least.withColumnRenamed("_least", "b"))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link (a, b): the least node it is connected to."""
    links = materialize(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == state:
            break
        state = (row["n"], row["h"])
        if not row["n"]:
            break
        links = materialize(_stars(_stars(links, large=True), large=False))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
