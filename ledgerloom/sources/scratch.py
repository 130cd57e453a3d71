"""Folders for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, the session's checkpoint folder is taken; a session
    without either is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, computed once into a scratch table of their own."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(parts: Sequence[DataFrame], path: str) -> DataFrame:
    """The rows of all parts, written one part after the other into the scratch table at ``path``."""
    for df in parts:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark 4.1 and later; earlier ones take no notice of it.
_REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job run inside go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_REMOVES_SHUFFLES, None)
    spark.conf.set(_REMOVES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVES_SHUFFLES)
        else:
            spark.conf.set(_REMOVES_SHUFFLES, before)


def removing_shuffles(run: Callable) -> Callable:
    """``run``, whose first argument is the session, with ``shuffles_removed``."""

    @wraps(run)
    def wrapped(spark: SparkSession, *args, **kwargs):
        with shuffles_removed(spark):
            return run(spark, *args, **kwargs)

    return wrapped


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    folder, files = _opened(spark, path)
    files.delete(folder, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a complete table its place."""
    folder, files = _opened(spark, path)
    place = _opened(spark, target)[0]
    if not files.rename(folder, place) and (files.exists(folder) or not files.exists(place)):
        raise OSError(f"{path} could not be renamed to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _opened(spark, path)
    return files.exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in a folder, none if there is no such folder."""
    folder, files = _opened(spark, path)
    return [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []


def replace(spark: SparkSession, path: str) -> None:
    """Put the complete table beside ``path`` (see ``fresh_path``) in its place.

    The old table is set aside, the new one takes its place, and the old one is
    removed. Whatever step a crash leaves undone, ``recover`` finishes or takes back.
    """
    if exists(spark, path):
        move(spark, path, _aside(path))
    move(spark, fresh_path(path), path)
    discard(spark, _aside(path))


def recover(spark: SparkSession, path: str) -> None:
    """Bring ``path`` back to one complete table after a crash while it was replaced.

    Without the table, the new one takes its place if it is complete and the old one had been
    set aside, else the old one comes back. What is then left beside the table goes.
    """
    if not exists(spark, path) and exists(spark, _aside(path)):
        complete = exists(spark, f"{fresh_path(path)}/_SUCCESS")
        move(spark, fresh_path(path) if complete else _aside(path), path)
    for beside in (fresh_path(path), _aside(path)):
        discard(spark, beside)


def set_aside(spark: SparkSession, path: str) -> bool:
    """Whether a replacement of ``path`` was broken off between its two renames."""
    return not exists(spark, path) and exists(spark, _aside(path))


def fresh_path(path: str) -> str:
    """Where the table that is to replace ``path`` is written: beside it, under a name that readers skip."""
    return _beside(path, "new")


def _aside(path: str) -> str:
    return _beside(path, "old")


def _beside(path: str, kind: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{kind}"


def _opened(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
