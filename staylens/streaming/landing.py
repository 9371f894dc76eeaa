"""Incremental landing: newly arrived raw files to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from staylens.session import configure
from staylens.sources import bronze


def raw_stream(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files below ``source``, a bounded number per micro-batch."""
    return (
        configure(spark)
        .readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )


def start_landing(
    rows: DataFrame, dataset: bronze.BronzeDataset, base: str, checkpoint: str
) -> StreamingQuery:
    """Coerce and append everything that has arrived, then stop.

    A run may arrive in any number of files and micro-batches, its files may be
    delivered again, and a batch may be replayed after a failure: it lands once. The
    stream is known by its query id, which its checkpoint keeps.
    """

    def land(batch: DataFrame, epoch: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        bronze.append_epoch(batch, dataset, base, stream, epoch)

    return (
        rows.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
