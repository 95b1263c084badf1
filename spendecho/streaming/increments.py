"""Keyed increments from a growing folder of enriched rows.

The stream's checkpoint remembers which files were taken; each micro-batch
goes through the same watermark and append as the batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.incremental import newer_rows
from ..session import shared_dir
from ..sources.tables import Bucket, append_table


def enriched_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def append_newer(table: str, column: str, bucket: Bucket | None = None):
    """A foreachBatch function: append the rows newer than the table's maximum.

    A batch that is replayed after a failure finds its rows at or below the
    maximum and appends nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if spark.catalog.tableExists(table):
            batch = newer_rows(batch, spark.table(table), column)
        append_table(batch, table, bucket)

    return write


def drain(
    stream: DataFrame,
    table: str,
    column: str,
    label: str,
    bucket: Bucket | None = None,
) -> StreamingQuery:
    """Take everything that is there now, then stop. All new files make one
    micro-batch (no maxFilesPerTrigger): a split would let the first part's
    maximum hide rows of the second."""
    location = f"{shared_dir(stream.sparkSession)}/spendecho/streams/{label}"
    return (
        stream.writeStream.foreachBatch(append_newer(table, column, bucket))
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
