"""Ingest of files that have not been seen before."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.sources.files import scan_stream
from ledgerloom.sources.sinks import MAX_RECORDS_PER_FILE
from ledgerloom.specs import TableSpec


def ingest_stream(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    target: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Scan every file not yet in the checkpoint into ``target``, then stop.

    A run without new files writes nothing. The file sink commits each batch
    once, so a restarted run neither loses nor repeats rows.
    """
    query = (
        scan_stream(spark, spec, source, max_files_per_trigger)
        .writeStream.format("parquet")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return query
