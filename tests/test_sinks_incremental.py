import glob
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import (
    batch_label,
    changed_keys,
    next_mark,
    read_mark,
    row_versions,
    since,
    store_mark,
    store_marks,
)
from ledgerloom.sources import list_files, new_files, scratch, scratch_path, write_table
from ledgerloom.sources.sinks import fold_files, replace_partitions
from ledgerloom.sources.listing import manifest_entries
from ledgerloom.sources.files import read_if_exists


def test_empty_overwrite_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(5), path)
    assert not write_table(spark.range(0), path)
    assert spark.read.parquet(path).count() == 5
    assert write_table(spark.range(3), path, mode="append")
    assert spark.read.parquet(path).count() == 8


def test_records_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(100).coalesce(1), path, max_records_per_file=30)
    assert len(glob.glob(f"{path}/*.parquet")) == 4


def test_partitions_are_clustered(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).repartition(4).withColumn("p", F.col("id") % 3)
    write_table(df, path, partition_by=("p",))
    assert len(glob.glob(f"{path}/p=*/*.parquet")) == 3
    update = df.where("p = 1").limit(10)
    write_table(update, path, partition_by=("p",), dynamic_overwrite=True)
    counts = {r.p: r["count"] for r in spark.read.parquet(path).groupBy("p").count().collect()}
    assert counts == {0: 334, 1: 10, 2: 333}


def test_schema_may_grow_but_not_shrink(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).withColumn("v", F.lit("x")), path, keep_schema=True)
    with pytest.raises(ValueError, match="v string"):
        write_table(spark.range(5), path, keep_schema=True)
    with pytest.raises(ValueError, match="id bigint"):
        write_table(spark.range(5).selectExpr("cast(id as int) id", "'x' v"), path, keep_schema=True)
    write_table(spark.range(5).selectExpr("id", "'x' v", "1 as w"), path, keep_schema=True, mode="append")
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    assert set(merged.columns) == {"id", "v", "w"} and merged.where("w is null").count() == 5


def test_new_files(spark, tmp_path):
    name = "in 100% of 2024-01-01"
    path = str(tmp_path / name)
    spark.range(10).coalesce(1).write.parquet(path)
    (tmp_path / name / "empty.parquet").write_bytes(b"")
    listing = list_files(spark, path).where("file_path like '%.parquet'")
    assert listing.count() == 1
    read = spark.read.parquet(listing.first().path).withColumn("f", F.col("_metadata.file_path"))
    manifest = manifest_entries(read, "f")
    assert manifest.first().row_count == 10
    assert new_files(listing, manifest).count() == 0
    spark.range(3).coalesce(1).write.mode("append").parquet(path)
    fresh = new_files(list_files(spark, path).where("file_path like '%.parquet'"), manifest)
    assert fresh.count() == 1


def test_marks(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert read_mark(spark, path, "silver") is None
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 678901)
    store_mark(spark, path, "silver", first)
    store_mark(spark, path, "silver", second)
    store_mark(spark, path, "other", datetime(2025, 1, 1))
    assert read_mark(spark, path, "silver") == second
    assert batch_label(None) == "initial" and batch_label(second) == "20240102T030405678901"


def test_since_is_strict(spark):
    times = [datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    assert since(df, "t", None).count() == 3
    assert since(df, "t", times[0]).count() == 2
    assert since(df, "t", times[0], times[1]).count() == 1
    assert next_mark(since(df, "t", times[0]), "t").first().mark == times[2]
    assert next_mark(since(df, "t", times[2]), "t").first().mark is None


def session_with(**settings):
    named = {k.replace("_", "."): v for k, v in settings.items()}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, default=None: named.get(k, default)),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
    )


def test_scratch_follows_the_session():
    shared = session_with(spark_checkpoint_dir="/shared/place/", spark_master="yarn")
    assert scratch_path(shared, "x").startswith("/shared/place/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_with(spark_master="local[2]"), "x")


def test_missing_table(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None


@pytest.mark.parametrize("step", ["set aside", "in place", "removed"])
def test_replacement_survives_a_crash(spark, tmp_path, monkeypatch, step):
    """A run ends before, between or after the renames; readers and the next run see one whole table."""
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    calls = []

    def stopping(session, *paths):
        calls.append(paths)
        if len(calls) == {"set aside": 1, "in place": 2}.get(step):
            raise OSError("stopped")
        return plain(session, *paths)

    name = "discard" if step == "removed" else "move"
    plain = getattr(scratch, name)

    def not_removed(session, gone):
        if gone.endswith(".old") and scratch.exists(session, gone):
            raise OSError("stopped")
        return plain(session, gone)

    monkeypatch.setattr(scratch, name, not_removed if step == "removed" else stopping)
    with pytest.raises(OSError, match="stopped"):
        write_table(spark.range(8), path)
    monkeypatch.undo()
    count = 5 if step == "set aside" else 8
    assert read_if_exists(spark, path).count() == count
    if step == "in place":
        assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    assert write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_incomplete_replacement_is_taken_back(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    scratch.move(spark, path, scratch._aside(path))
    spark.range(2).write.parquet(scratch.fresh_path(path))
    (tmp_path / ".t.new" / "_SUCCESS").unlink()
    assert read_if_exists(spark, path).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_check_before_the_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)

    def refuse():
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        write_table(spark.range(8), path, check=refuse)
    assert spark.read.parquet(path).count() == 5


def test_replaced_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, None, 1)], "v int, p string, q int")
    write_table(old, path, partition_by=("p", "q"))
    new = spark.createDataFrame([(5, "a", 1)], "v int, p string, q int")
    assert replace_partitions(new, path, ("p", "q"), [("a", 1), ("b", 1), (None, 1)]) == 1
    assert rows(spark.read.parquet(path).select("v", "p", "q")) == [(2, "a", 2), (5, "a", 1)]
    assert replace_partitions(new.limit(0), path, ("p", "q"), [("a", 1)]) == 0
    assert rows(spark.read.parquet(path).select("v")) == [(2,)]


def test_marks_are_folded(spark, tmp_path):
    path = str(tmp_path / "marks")
    for i in range(70):
        store_marks(spark, path, {"a": datetime(2024, 1, 1, 0, i % 60), "b": datetime(2024, 1, 2)})
    assert len(glob.glob(f"{path}/*.parquet")) <= 65
    assert read_mark(spark, path, "a") == datetime(2024, 1, 1, 0, 59) and read_mark(spark, path, "b") == datetime(2024, 1, 2)


def test_file_that_lands_while_folding_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(path)

    def fold(rows):
        spark.range(100, 101).coalesce(1).write.mode("append").parquet(path)
        return rows.distinct()

    assert not fold_files(spark, path, fold, above=6)
    assert fold_files(spark, path, fold, above=5)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4, 5, 100]
    assert len(glob.glob(f"{path}/*.parquet")) == 2


def test_changed_keys(spark, rows):
    before = row_versions(spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", None)], "k int, v string, w string"), "k")
    now = [(1, "a", None), (2, None, "b"), (4, "d", None)]
    versions = row_versions(spark.createDataFrame([(*r, "l") for r in now], "k int, v string, w string, at string"), "k", ["at"])
    assert rows(changed_keys(before, versions, "k")) == [(2,), (3,), (4,)]
    assert rows(changed_keys(None, versions, "k")) == [(1,), (2,), (4,)]
