from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.cdc import current_state, decode_ops, drop_deletes, op_distribution
from ledgerloom.operators.dedup import (
    dedup_by_key,
    latest_per_key,
    union_latest,
    union_sources,
)


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, None, "n"), (2, None, "x"), (None, 1, "k"), (None, 2, "l")],
        "k int, t int, v string",
    )
    expected = [(1, 5, "a"), (2, None, "x"), (None, 2, "l")]
    assert rows(latest_per_key(df, ["k"], "t")) == expected
    assert rows(latest_per_key(df.repartition(3), ["k"], F.col("t"))) == expected
    assert rows(latest_per_key(df, ["k"], "t", [F.col("v").desc()]))[0] == (1, 5, "b")
    assert latest_per_key(df.limit(0), ["k"], "t").count() == 0


def test_dedup_by_key_ignores_unorderable_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "k int, m map<string,int>")
    assert dedup_by_key(df, ["k"]).count() == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5) | st.none(), st.integers(0, 9)), max_size=25))
def test_latest_against_brute_force(spark, rows, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    best = {}
    for k, t, v in data:
        rank = (-1 if t is None else t, -v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    assert rows(latest_per_key(df, ["k"], "t")) == sorted((r for _, r in best.values()), key=repr)


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    b = spark.createDataFrame([(2, "b", 5), (3, "b", None)], "k int, v string, updated_at int")
    merged = union_sources([a, b])
    assert merged.count() == a.count() + b.count()
    assert merged.columns == ["k", "v", "updated_at"]
    timed = a.withColumn("updated_at", F.lit(None).cast("int"))
    assert rows(union_latest([timed, b], "k", "updated_at")) == [
        (1, "a", None), (2, "b", 5), (3, "b", None),
    ]
    tie = [df.withColumn("updated_at", F.lit(1)) for df in (a, a.withColumn("v", F.lit("later")))]
    assert {r.v for r in union_latest(tie, "k", "updated_at").collect()} == {"later"}


@pytest.fixture
def feed(spark):
    t = datetime
    return spark.createDataFrame(
        [
            ("I", 1, t(2023, 1, 1)),
            ("U", 1, t(2023, 1, 3)),
            ("I", 2, t(2023, 1, 1)),
            ("D", 2, t(2023, 1, 2)),
            ("D", 3, t(2023, 1, 1)),
            ("I", 3, t(2023, 1, 2)),
            (None, 4, t(2023, 1, 1)),
            ("X", 5, t(2023, 1, 1)),
        ],
        "_op string, k int, t timestamp",
    )


def test_operations(feed, rows):
    assert rows(op_distribution(feed)) == sorted(
        [("I", 3), ("U", 1), ("D", 2), (None, 1), ("X", 1)], key=repr
    )
    assert drop_deletes(feed).count() == 5
    words = {r.k: r.dms_operation for r in decode_ops(feed).where("k > 3").collect()}
    assert words == {4: "unknown", 5: "unknown"} and "_op" not in decode_ops(feed).columns


def test_current_state(feed):
    latest = {r.k: r._op for r in current_state(feed, ["k"], "t").collect()}
    assert latest == {1: "U", 3: "I", 4: None, 5: "X"}
    records = {r.k: r._op for r in current_state(feed, ["k"], "t", deletes="records").collect()}
    assert records == {1: "U", 2: "I", 3: "I", 5: "X"}
    with pytest.raises(ValueError):
        current_state(feed, ["k"], "t", deletes="some")
