"""The ingest filter over a folder that keeps receiving comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from murmura import schemas
from murmura.operators.segments import SegmentStore
from murmura.plans.ingest import ingest
from murmura.session import shared_folder


def stream_documents(spark: SparkSession, landing: str, lexicon: DataFrame, store: SegmentStore, name: str = "ingest", **filters) -> StreamingQuery:
    """Add newly landed CSV files to the stored documents and their index; ends when the backlog is done.

    A comment that arrives again replaces its older version, and a replayed batch counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest(batch, lexicon, store, f"{name}-{batch_id}", **filters)

    landed = spark.readStream.schema(schemas.COMMENTS).options(header="true", multiLine="true", quote='"', escape='"').csv(landing)
    return (
        landed.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{shared_folder(spark)}/stream-{name}")
        .trigger(availableNow=True)
        .start()
    )
