"""Shared helpers: the shared scratch folder, stored tables, Arrow slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task turns into Python objects at once.
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only if that is unset and the session is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as a table in the shared folder and read back, which cuts its lineage."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_rows(frame: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``id`` (bigint) and ``text`` (null counts as empty); other columns can clash with nothing."""
    return frame.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded size; a single longer text is a batch of its own."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, rows * most // max(1, batch.nbytes)))
        for start in range(0, rows, step):
            yield batch.slice(start, step)
