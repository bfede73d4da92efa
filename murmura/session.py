"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Spark deletes the shuffle files of a write as it ends; a write plans its own, so no later step reads them.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "murmura") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MURMURA_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's ``spark.checkpoint.dir``.

    Only a local master without that setting falls back to a scratch folder; on
    a cluster a missing setting is an error, since a machine-local folder would
    not survive the loss of its executor.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="murmura-checkpoint-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the write that made them ends."""
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lineage cut that survives executor loss."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/murmura-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    atexit.register(_drop_folder, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*written: DataFrame) -> None:
    """Delete the files of tables of ``materialize`` that no later step reads."""
    for df in written:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            if "/murmura-" in folder:
                _drop_folder(df.sparkSession, folder)


def _drop_folder(spark: SparkSession, path: str) -> None:
    try:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    except Exception:  # the session may be gone already
        pass
