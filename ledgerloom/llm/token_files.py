"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on ids.

Documents are range-partitioned and sorted by id, encoded after the shuffle, and
written one file per range. ORC stores the ids with its integer run-length
encoding; each stripe has row indexes with minima and maxima of ``doc_id`` and a
Bloom filter on it, so a reader skips files, stripes and row groups by their
metadata and reads stripes in parallel. ``part`` numbers the ranges in id order.

Null text is empty text (only the end id). Rows without an id come first. Rows
that repeat an id are written each, ordered by their checksum. An empty table
gives files without rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored, text_rows
from ledgerloom.llm.tokens import encoder

END_ID = 0
#: Text bytes that are encoded at once, and pieces that a worker remembers (some 150 bytes each).
ENCODED_BYTES = 4 << 20
REMEMBERED = 1_200_000
SCHEMA = "part int, doc_id bigint, ids array<int>"
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.compress": "ZSTD",
}


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids`` with the end id, in the order of the rows of ``docs(id, text)``."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, REMEMBERED).encode
        for batch in slices(batches, ENCODED_BYTES):
            ids = [x + end for x in encode(batch.column(1).to_pylist())]
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.record_batch(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "ids"]
            )

    return docs.mapInArrow(run, "doc_id bigint, ids array<int>")


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as token files below ``path``."""
    ordered = text_rows(docs, id_col, text_col).repartitionByRange("id").sortWithinPartitions("id")
    rows = encoded(ordered, tokenizer).select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    rows.write.options(**OPTIONS).mode("overwrite").orc(path)


def read(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``part, doc_id, ids``, perhaps only of a range of ids (pruned by the files' metadata)."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        lists = batch.column("ids")
        at = lists.offsets.to_numpy()
        ids = memoryview(lists.values.to_numpy().astype("<u4")).cast("B")
        crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.record_batch(
            [batch.column("part"), batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64)),
             pa.array(crc, pa.int64())],
            ["part", "doc_id", "n_tokens", "ids_crc32"],
        )


def layout(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; start counts all ids before it."""
    rows = stored(
        read(spark, path).mapInArrow(_digest, "part int, doc_id bigint, n_tokens bigint, ids_crc32 bigint"), "digests"
    )
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    firsts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    inside = (
        Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(firsts, "part")
        .select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
