"""Mixing sources to target weights: whole copies plus one hash-seeded draw per document.

A source's rate is its target over its size. A document is emitted
floor(rate) times and once more with the probability of the fraction; the draw
depends on the document id and the seed only, so reruns agree.

Nulls: a null source is a source of its own, last in the order; a null text has
no words and is emitted like any other. Rows that repeat an id draw alike. An
empty table gives an empty table. Extra columns are carried through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import WORD, numbered, query, table
from murmura.session import materialize

MAX_RATE = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"

# 52 bits of a digest make a fraction that a double holds exactly.
_DIGEST_DIGITS = 13


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the key and the seed."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, _DIGEST_DIGITS), 16, 10).cast("double") / float(16**_DIGEST_DIGITS)


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights handed out in turn to the sources in code point order, null last."""
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "rank")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", turn.cast("bigint")).drop("rank")


def targets(sources: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """Tokens each source (source, source_size, weight) should give: shares of the total by weight.

    A target stops at ``max_rate`` times its source's size and the excess is
    shared anew by weight among the rest. The common level only rises, so each
    round of one aggregate finds more sources at their limit, until none is added.
    """
    sources = materialize(sources)
    limit = F.col("source_size") * max_rate
    level, full = 0.0, -1
    while True:
        at_limit = limit <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(at_limit, limit)).alias("used"),
            F.sum(F.when(~at_limit, F.col("weight"))).alias("weight"),
            F.count(F.when(at_limit, True)).alias("full"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (row["total"] - (row["used"] or 0)) / row["weight"]
    at_limit = limit <= F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(at_limit, limit.cast("double")).otherwise(F.lit(level) * F.col("weight")))


def plan(docs: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """Per document (doc_id, source): its size, its source's size and target, its rate and number of copies."""
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = materialize(targets(cycled_weights(totals), max_rate))
    joined = sized.join(shares.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    joined = joined.drop("_source").withColumn("rate", rate)
    more = draw(F.col("doc_id")) < F.col("rate") - F.floor("rate")
    return joined.withColumn("copies", (F.floor("rate") + more.cast("int")).cast("bigint"))


def mix(docs: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """The mixed table: every document as often as its rate asks, with the columns of ``docs``."""
    sized = docs.select(F.col("source"), n_words(F.col("text")).alias("size"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = materialize(targets(cycled_weights(totals), max_rate)).select(
        F.col("source").alias("_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)).alias("_rate"),
    )
    packed = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), F.col("source").alias("_from"))
    joined = packed.join(shares, F.col("_from").eqNullSafe(F.col("_source")))
    more = draw(F.col("_id")) < F.col("_rate") - F.floor("_rate")
    copies = (F.floor("_rate") + more.cast("int")).cast("int")
    return joined.select("_doc", F.explode(F.array_repeat(F.lit(0), copies))).select("_doc.*")


TARGETS_SQL = f"""sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS weight FROM totals),
steps AS (
  SELECT *, row_number() OVER ordered AS place, coalesce(sum({MAX_RATE} * source_size) OVER earlier, 0) AS used,
         sum(weight) OVER later AS weight_left, sum(source_size) OVER () AS total
  FROM weighed
  WINDOW ordered AS (ORDER BY source_size / weight, source NULLS LAST),
         earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         later AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
levels AS (SELECT *, CAST(total - used AS DOUBLE) / CAST(weight_left AS DOUBLE) AS level FROM steps),
level AS (SELECT arg_min(level, place) FILTER (WHERE level * weight < {MAX_RATE} * source_size) AS level FROM levels),
shares AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL OR {MAX_RATE} * source_size <= level * weight THEN CAST({MAX_RATE} * source_size AS DOUBLE)
              ELSE level * weight END AS target
  FROM weighed, level),
planned AS (
  SELECT d.doc_id, d.size, s.source_size, s.target,
         CASE WHEN s.source_size > 0 THEN s.target / s.source_size ELSE 1.0 END AS rate,
         CAST(CAST('0x' || substr(md5('{SEED}' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, {_DIGEST_DIGITS}) AS BIGINT) AS DOUBLE)
           / CAST({16**_DIGEST_DIGITS} AS DOUBLE) AS draw
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source)"""


@query(
    "op1_mix_sources",
    f"""WITH {TARGETS_SQL}
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM planned""",
)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    planned = plan(table(spark, folder, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
