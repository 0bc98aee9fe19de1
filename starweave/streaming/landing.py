"""Incremental Bronze landing with Structured Streaming.

Extract files dropped into a folder are picked up exactly once: the file
source records every processed file in the query's checkpoint, so a
restarted or re-triggered load lands only new files, and a lost executor
replays only the unfinished micro-batch. ``availableNow`` processes what
is there and stops, which fits a scheduled warehouse load; Silver then
de-duplicates the appended history as in the batch path.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.contracts import Contract
from ..sources.csv import CORRUPT_COLUMN


def stream_extract(spark: SparkSession, folder: str, contract: Contract, batch_id: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV reader of one extract folder, with Bronze audit columns.

    ``ingested_at`` is the micro-batch's processing time, so every file of
    one micro-batch shares it and later files land later.
    """
    schema = StructType(contract.schema().fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    reader = (spark.readStream.schema(schema)
              .option("header", "true")
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
              .option("enforceSchema", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder).withColumns({
        "ingested_at": F.current_timestamp(),
        "source_system": F.lit(contract.source_system),
        "batch_id": F.lit(batch_id),
    })


def land(stream: DataFrame, target: str, checkpoint: str, partition_by=()) -> StreamingQuery:
    """Append the stream to a Parquet table; returns the started query
    (``availableNow``: process the backlog, then stop)."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(target)
