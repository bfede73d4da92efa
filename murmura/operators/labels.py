"""Manual labels, keyword fusion, evaluation metrics and training-run analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.operators.scale import consecutive_ids, join_frequent_apart, running, top_n_per_group
from murmura.session import materialize


# --- labels --------------------------------------------------------------------


def attach_labels(df: DataFrame, labels: DataFrame, key: str = "comment_id", label: str = "label", dedupe: bool = True) -> DataFrame:
    """Inner join of rows with manual labels. With ``dedupe`` a key labelled twice keeps its smallest label."""
    side = labels.select(key, label)
    if dedupe:
        side = side.groupBy(key).agg(F.min(label).alias(label))
    return df.join(side, key)


def label_index(df: DataFrame, column: str, order: str, out: str = "index") -> DataFrame:
    """Number categories in the order they first appear by ``order``, which is numeric. Rows without a category are left out.

    Categories may be as many as the rows, and one of them may hold most: neither goes to one task.
    """
    first = materialize(df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first")))
    ids = consecutive_ids(first, "_first", [column], out).select(column, F.col(out).cast("int").alias(out))
    return join_frequent_apart(df, ids, column)


def drop_neutral(df: DataFrame, column: str = "sentiment") -> DataFrame:
    return df.filter(F.col(column) != "neutral")


def drop_zero_label(df: DataFrame, column: str = "label") -> DataFrame:
    """Rows with a label other than zero."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != 0))


def keep_binary(df: DataFrame, column: str = "label") -> DataFrame:
    return df.filter(F.col(column).isin(1, -1))


def majority_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """``(key, majority)``: the most frequent label of each group, the smallest on ties."""
    counts = df.groupBy(key, label).agg(F.count("*").alias("_n"))
    return counts.groupBy(key).agg(F.min_by(label, F.struct((-F.col("_n")).alias("n"), F.col(label))).alias("majority"))


def map_clusters(df: DataFrame, cluster: str, label: str, out: str = "predicted") -> DataFrame:
    """Give every row the majority label of its cluster, by a join; rows without a cluster get none."""
    majority = majority_label(df, cluster, label).select(F.col(cluster).alias("_cluster"), F.col("majority").alias(out))
    return df.join(majority, df[cluster] == majority["_cluster"], "left").drop("_cluster")


def fuse_keywords(a: DataFrame, b: DataFrame, boost: float = 2, k: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Union of two ``(keyword, count)`` tables, best ``k``. A word in both scores ``a + boost * b``, else its own count.

    ``keys`` (say, the request) fuses each group on its own.
    """
    left = a.select(*keys, "keyword", F.col("count").alias("_a"))
    right = b.select(*keys, "keyword", F.col("count").alias("_b"))
    both = left.join(right, [*keys, "keyword"], "full_outer")
    score = F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.col("_a") + boost * F.col("_b")).otherwise(
        F.coalesce("_a", "_b")
    )
    scored = both.select(*keys, "keyword", score.cast("bigint").alias("count"))
    if keys:
        return top_n_per_group(scored, keys, [F.desc("count"), F.col("keyword")], k)
    return scored.orderBy(F.desc("count"), "keyword").limit(k)


# --- metrics -------------------------------------------------------------------


def _counts(pred: str, label: str) -> dict[str, Column]:
    p, y = F.col(pred), F.col(label)
    return {
        "tp": F.count_if((p == 1) & (y == 1)),
        "fp": F.count_if((p == 1) & (y == 0)),
        "fn": F.count_if((p == 0) & (y == 1)),
        "correct": F.count_if(p == y),
        "total": F.count(F.lit(1)),
    }


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _accuracy() -> Column:
    return _ratio(F.col("correct"), F.col("total"))


def _precision() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def _f1() -> Column:
    return _ratio(2 * _precision() * _recall(), _precision() + _recall())


METRICS = {"accuracy": _accuracy, "f1": _f1, "precision": _precision, "recall": _recall}


def binary_metrics(df: DataFrame, pred: str, label: str, names: Sequence[str] = tuple(METRICS), keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy over all rows; precision, recall and F1 of class 1 against class 0. Empty denominators give 0."""
    counted = df.groupBy(*keys).agg(*[c.alias(n) for n, c in _counts(pred, label).items()])
    return counted.select(*keys, *[METRICS[n]().alias(n) for n in names])


def confusion(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def weighted_metrics(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Support-weighted precision, recall and F1, and accuracy. A class never predicted has precision 1."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("pred").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when((F.col("label") == F.col("pred")) & (F.col("support") > 0), F.col("n")).otherwise(0)
    classes = (
        confusion(df, pred, label)
        .select("label", "pred", "n", F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum(hit).alias("tp"))
    )
    scored = classes.select(
        "support",
        "tp",
        F.coalesce(F.try_divide("tp", "predicted"), F.lit(1.0)).alias("p"),
        F.coalesce(F.try_divide("tp", "support"), F.lit(1.0)).alias("r"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted")), F.lit(1.0)).alias("f"),
    )

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support"))

    return scored.agg(
        weighted("p").alias("precision"),
        weighted("r").alias("recall"),
        weighted("f").alias("f1"),
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
    )


def random_labels(df: DataFrame, key: str, seed: int = 42, out: str = "random_label") -> DataFrame:
    """A seeded coin per row, 1 or -1, that does not depend on partitioning."""
    coin = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 1), 16, 10).cast("int") % 2
    return df.withColumn(out, F.when(coin == 0, 1).otherwise(-1))


def random_baseline(df: DataFrame, pred: str, key: str, seed: int = 42) -> DataFrame:
    """Weighted metrics of predictions against random labels."""
    return weighted_metrics(random_labels(df, key, seed), pred, "random_label")


def unk_rate(encoded: DataFrame, unk: Column, ids: str = "ids", keys: Sequence[str] = ("split",)) -> DataFrame:
    """Unknown tokens and all tokens per split."""
    unknown = F.size(F.filter(F.col(ids), lambda x: x == unk))
    return encoded.groupBy(*keys).agg(F.sum(unknown).alias("unknown"), F.sum(F.size(ids)).alias("total"))


# --- training runs ---------------------------------------------------------------


def running_metrics(preds: DataFrame, keys: Sequence[str], step: str, pred: str = "pred", label: str = "label") -> DataFrame:
    """Metrics after every step over all rows so far. Rows of one step count together."""
    per_step = preds.groupBy(*keys, step).agg(*[c.alias(f"_{n}") for n, c in _counts(pred, label).items()])
    totals = running(per_step, keys, step, {n: ("sum", F.col(f"_{n}")) for n in _counts(pred, label)})
    return totals.select(*keys, step, *[metric().alias(n) for n, metric in METRICS.items()])


def mean_loss(losses: DataFrame, keys: Sequence[str] = ("run", "epoch"), loss: str = "loss") -> DataFrame:
    return losses.groupBy(*keys).agg(F.avg(loss).alias("mean_loss"))


def early_stop_epoch(
    series: DataFrame, keys: Sequence[str] = ("run",), epoch: str = "epoch", value: str = "value", patience: int = 10, greater_is_better: bool = True,
    min_delta: float = 0.0,
) -> DataFrame:
    """First epoch at which the value has been worse than its best ``patience`` times since the best improved.

    Without ``min_delta`` equal values neither reset nor count. With it a value that is not a new best counts if it is
    below the best plus ``min_delta``; where smaller is better, if it is above the best by more than ``min_delta``. Runs
    that never stop have no row.
    """
    signed = series.withColumn("_v", F.col(value) if greater_is_better else -F.col(value))
    floor = F.lit(0.0) if greater_is_better else F.lit(float("-inf"))
    # Each stage reads its input twice, so its result is written once rather than computed 2, 4, 8 times.
    best = materialize(running(signed, keys, epoch, {"_best": ("max", F.col("_v"))}))
    flagged = materialize(_mark_improvements(best, keys, epoch, floor))
    # The margin widens what counts where greater is better and narrows it where smaller is.
    margin = min_delta if greater_is_better else -min_delta
    counts = ~F.col("_improved") & (F.col("_v") < F.greatest(F.col("_best"), floor) + F.lit(margin))
    worse = running(flagged, keys, epoch, {"_worse": ("sum", F.when(counts, 1).otherwise(0))})
    worse = materialize(worse)
    since = running(worse, keys, epoch, {"_base": ("max", F.when(F.col("_improved"), F.col("_worse")).otherwise(0))})
    stopped = since.filter((F.col("_worse") - F.col("_base") >= patience) & counts)
    return stopped.groupBy(*keys).agg(F.min(epoch).alias("stop_epoch"))


def _mark_improvements(best: DataFrame, keys: Sequence[str], epoch: str, floor: Column) -> DataFrame:
    """Flag improving rows: the first row that reaches each new best above the floor."""
    reached = best.groupBy(*keys, "_best").agg(F.min(epoch).alias("_first")).filter(F.col("_best") > floor)
    first = reached.select(*keys, F.col("_first").alias(epoch), F.lit(True).alias("_mark"))
    return best.join(first, [*keys, epoch], "left").withColumn("_improved", F.coalesce("_mark", F.lit(False))).drop("_mark")


def final_metrics(series: DataFrame, keys: Sequence[str] = ("run", "metric"), step: str = "step", value: str = "value") -> DataFrame:
    """Last value, best value and the step of the best (the earliest on ties) of every series."""
    return series.groupBy(*keys).agg(
        F.max_by(value, step).alias("final"),
        F.max(value).alias("best"),
        F.max_by(step, F.struct(F.col(value), (-F.col(step)).alias("early"))).alias("best_step"),
    )
