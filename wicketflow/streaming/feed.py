"""Landing folders as a stream: each micro-batch goes through the batch update."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wicketflow import schemas
from wicketflow.plans.train import Tables
from wicketflow.plans.update import append_to_tables
from wicketflow.session import state_on_disk
from wicketflow.streaming.release import Hold, release

INCOMPLETE = "incomplete"


def stream_updates(spark: SparkSession, landing: str, matches: DataFrame, tables: Tables,
                   checkpoint: str, schema=schemas.DELIVERIES, stage=None,
                   hold: Hold | None = None) -> StreamingQuery:
    """Append the new matches of landed delivery files, then stop.

    With `hold` a match may be spread over many files and runs: it is appended when it is
    whole, and matches that were given up go to the table `incomplete`. Without it a file has
    to hold whole matches. Each batch is one all-or-nothing update under its own name, so a
    batch that is run again after a failure appends nothing twice.
    """
    landed = spark.readStream.schema(schema).parquet(landing)
    rows = landed if hold is None else release(landed, hold)

    def update(batch: DataFrame, batch_id: int) -> None:
        extra = {}
        if hold is not None:
            batch = batch.persist()
            extra = {INCOMPLETE: batch.where("not complete").drop("complete")}
            whole = batch.where("complete").drop("complete")
        else:
            whole = batch
        try:
            append_to_tables(tables, whole, matches, stage=stage, extra=extra,
                             batch=f"{checkpoint}#{batch_id}")
        finally:
            batch.unpersist()

    with state_on_disk(spark):
        return (rows.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
