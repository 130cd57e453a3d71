"""A change feed applied to a keyed state table, batch by batch.

The state is kept as parquet folders: a compacted base in buckets by a hash of the key,
and one folder per micro-batch with the latest change per key of that batch. A batch
therefore costs what its own changes cost, and a repeated batch replaces its own folder.
Compaction folds the pending batches into the buckets that they touch; the others stay as
they are. Readers take the latest change per key over base and batches; delete markers stay
in the folders and are filtered on read, because an older change may still
arrive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.cdc import current_state
from ledgerloom.operators.dedup import latest_per_key, union_sources
from ledgerloom.sources.files import read_if_exists
from ledgerloom.sources.scratch import discard, names_in

_STREAM, _BATCH, _VERSION, _BUCKET = "stream", "batch_id", "version", "bucket"
_PUBLISHED = "stream string, upto bigint, bucket bigint, place bigint, buckets int"


def upsert_stream(
    changes: DataFrame,
    state_path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: str,
) -> StreamingQuery:
    """Apply all available changes of a streaming frame to the state, then stop.

    Batches are folders named by the stream's own id and the batch number, so a
    stream with a new checkpoint, whose numbers start again, adds to the state.
    """

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        latest = latest_per_key(batch, keys, order_by)
        latest.write.mode("overwrite").parquet(
            f"{state_path}/changes/{_STREAM}=s{stream}/{_BATCH}={batch_id}"
        )

    query = (
        changes.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_state(
    spark: SparkSession, state_path: str, keys: Sequence[str], order_by: str, op: str
) -> DataFrame:
    """Current rows of the state: latest change per key, deleted keys left out."""
    version = _published(spark, state_path)
    base = _base(spark, state_path, _places(spark, state_path, version))
    parts = [x for x in (_pending(spark, state_path, version), base) if x is not None]
    if not parts:
        raise ValueError(f"no state at {state_path}")
    return current_state(union_sources(parts).drop(_STREAM, _BATCH), keys, order_by, op)


def compact_state(
    spark: SparkSession, state_path: str, keys: Sequence[str], order_by: str, *, buckets: int = 64
) -> int | None:
    """Fold the pending batches into the base; its version, None if nothing is pending.

    The folders are listed once. What is folded and what is published as folded
    both come from that listing, so a batch that lands meanwhile stays pending.
    Buckets with pending changes are written anew under the new version; the version lists
    where each bucket is. It counts once it is published; readers then skip what it
    covers, and ``remove_folded`` removes it. ``buckets`` is fixed by the first compaction.
    """
    version = _published(spark, state_path)
    pending = _pending(spark, state_path, version)
    if pending is None:
        return None
    marks = pending.groupBy(_STREAM).agg(F.max(_BATCH).cast("long").alias("upto")).collect()  # one row per stream
    if not marks:
        return None
    number = (version or 0) + 1
    places = _places(spark, state_path, version)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(next((p["buckets"] for p in places), buckets)))
    folded = reduce(
        lambda a, b: a | b, [(F.col(_STREAM) == m[_STREAM]) & (F.col(_BATCH) <= m["upto"]) for m in marks]
    )
    changes = pending.where(folded).withColumn(_BUCKET, bucket)
    touched = {r[_BUCKET] for r in changes.select(_BUCKET).distinct().collect()}  # at most as many as buckets
    base = _base(spark, state_path, [p for p in places if p[_BUCKET] in touched])
    everything = union_sources([changes] if base is None else [changes, base.withColumn(_BUCKET, bucket)])
    latest = latest_per_key(everything.drop(_STREAM, _BATCH), keys, order_by)
    latest.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(
        f"{state_path}/base/{_VERSION}={number}"
    )
    covered = {m[_STREAM]: m["upto"] for m in _marks(spark, state_path, version)} | {m[_STREAM]: m["upto"] for m in marks}
    now = {p[_BUCKET]: p["place"] for p in places} | dict.fromkeys(touched, number)
    count = next((p["buckets"] for p in places), buckets)
    rows = [(stream, upto, None, None, count) for stream, upto in covered.items()]
    rows += [(None, None, b, place, count) for b, place in sorted(now.items())]
    published = spark.createDataFrame(rows, _PUBLISHED)
    published.coalesce(1).write.mode("overwrite").parquet(f"{state_path}/versions/{_VERSION}={number}")
    return number


def remove_folded(spark: SparkSession, state_path: str) -> int:
    """Remove the batches that the published base covers, and what it has replaced; how many folders went.

    For a time when no reader still works from an older version.
    """
    version = _published(spark, state_path)
    if version is None:
        return 0
    found = read_if_exists(spark, f"{state_path}/changes")
    upto = {m[_STREAM]: m["upto"] for m in _marks(spark, state_path, version)}
    folders = [] if found is None else found.select(_STREAM, _BATCH).distinct().toLocalIterator()
    gone = [
        f"{state_path}/changes/{_STREAM}={f[_STREAM]}/{_BATCH}={f[_BATCH]}"
        for f in folders if f[_BATCH] <= upto.get(f[_STREAM], -1)
    ]
    current = {(p["place"], p[_BUCKET]) for p in _places(spark, state_path, version)}
    for folder in names_in(spark, f"{state_path}/base"):
        place = int(folder.partition("=")[2])
        inside = [n for n in names_in(spark, f"{state_path}/base/{folder}") if n.startswith(f"{_BUCKET}=")]
        old = [n for n in inside if (place, int(n.partition("=")[2])) not in current]
        if place <= version:
            gone += [f"{state_path}/base/{folder}"] if len(old) == len(inside) else [f"{state_path}/base/{folder}/{n}" for n in old]
    gone += [f"{state_path}/versions/{n}" for n in names_in(spark, f"{state_path}/versions") if _is_older(n, version)]
    for folder in gone:
        discard(spark, folder)
    return len(gone)


def _is_older(folder: str, version: int) -> bool:
    name, _, number = folder.partition("=")
    return name == _VERSION and int(number) < version


def _pending(spark: SparkSession, state_path: str, version: int | None) -> DataFrame | None:
    """Batches that the base of ``version`` does not cover."""
    batches = read_if_exists(spark, f"{state_path}/changes")
    if batches is None:
        return None
    for mark in _marks(spark, state_path, version):
        batches = batches.where((F.col(_STREAM) != mark[_STREAM]) | (F.col(_BATCH) > mark["upto"]))
    return batches


def _base(spark: SparkSession, state_path: str, places: Sequence[Row]) -> DataFrame | None:
    """The rows of some buckets of the base."""
    if not places:
        return None
    paths = [f"{state_path}/base/{_VERSION}={p['place']}/{_BUCKET}={p[_BUCKET]}" for p in places]
    return spark.read.parquet(*paths)


def _published(spark: SparkSession, state_path: str) -> int | None:
    versions = read_if_exists(spark, f"{state_path}/versions")
    return None if versions is None else versions.agg(F.max(_VERSION)).first()[0]


def _version_rows(spark: SparkSession, state_path: str, version: int | None) -> list[Row]:
    """One row per stream and one per bucket."""
    return [] if version is None else spark.read.schema(_PUBLISHED).parquet(f"{state_path}/versions/{_VERSION}={version}").collect()


def _marks(spark: SparkSession, state_path: str, version: int | None) -> list[Row]:
    return [r for r in _version_rows(spark, state_path, version) if r[_STREAM] is not None]


def _places(spark: SparkSession, state_path: str, version: int | None) -> list[Row]:
    return [r for r in _version_rows(spark, state_path, version) if r[_BUCKET] is not None]
