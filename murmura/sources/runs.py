"""Experiment runs: one folder per run with a config and a metrics document."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura import schemas
from murmura.sources.files import flatten_struct


def _run_name(document: str) -> Column:
    """Folder above the document, which may be one file or a folder of parts."""
    return F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]+)/{re.escape(document)}(?:/[^/]+)?$", 1))


def read_runs(spark: SparkSession, root: str, config: str = "config.json", metrics: str = "metrics.json") -> DataFrame:
    """Config and metrics of every run folder that holds both, config flattened to dotted names."""
    # Spark infers a schema from small files in one task; their text is read by many.
    texts = spark.read.text(f"{root}/*/{config}", wholetext=True)
    inferred = spark.read.option("multiLine", True).json(texts.rdd.map(lambda r: r[0])).schema
    configs = spark.read.schema(inferred).option("multiLine", True).json(f"{root}/*/{config}")
    configs = flatten_struct(configs.select(_run_name(config).alias("run"), F.struct(*configs.columns).alias("config")))
    series = spark.read.schema(schemas.RUN_METRICS).option("multiLine", True).json(f"{root}/*/{metrics}")
    return configs.join(series.select(_run_name(metrics).alias("run"), "*"), "run")


def metric_series(runs: DataFrame) -> DataFrame:
    """Long form ``(run, metric, step, value)``; steps count from 0."""
    nested = [f"{split}_metrics.{name}" for split in ("train", "val", "test") for name in ("accuracy", "f1", "precision", "recall")]
    series = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).alias("values"))
            for name in ["train_loss", "val_loss", "test_loss", *nested]
        ]
    )
    named = runs.select("run", F.inline(series))
    return named.select("run", "metric", F.posexplode("values").alias("step", "value"))
