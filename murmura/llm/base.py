"""Registry and helpers of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmura.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}

# Rows per Arrow batch: long texts would make batches of the default 10,000 rows too large for a worker.
_BATCH_ROWS = "1000"

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is None where SQL cannot express the result."""

    def register(fn: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            settle(spark)
            return fn(spark, folder)

        CATALOG[name] = (prepared, sql)
        return fn

    return register


def settle(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """``name`` as ``kind``, or nulls where the table has no such column."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)


def row_key() -> Column:
    """A document's identity: its id together with its text, so repeated rows count once."""
    return F.xxhash64("doc_id", "text")


def numbered(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Rows of a materialised table numbered from 0 in a global order, without a one-task sort.

    Rows are dealt to ranges and numbered inside; the ranges' counts, one row
    per range, give the offsets.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_range").count()
    offsets = counts.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order)
    out = ranged.withColumn("_inside", F.row_number().over(inside)).join(offsets, "_range")
    return out.withColumn(rank, F.col("_offset") + F.col("_inside") - 1).drop("_range", "_inside", "_offset")


def drop(written: DataFrame) -> None:
    """Delete the files of a table of ``materialize`` that no later step reads."""
    spark = written.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in written.inputFiles()}:
        if "/murmura-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Rows of two or three numbers that may be broadcast: some tens of megabytes.
_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A materialised table of a few numbers a row, hinted for broadcast up to a counted size and left to a shuffle beyond it."""
    return F.broadcast(df) if df.count() <= _BROADCAST_ROWS else df
