"""One row per key.

All variants are ``row_number() = 1``: Spark then keeps one row per key within
each input partition before the shuffle, so a key that holds a large share of
all rows reaches its task as at most one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROW = "_row"
_SOURCE_RANK = "_source_rank"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column,
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The row with the greatest ``order_by`` per key; NULLs lose.

    Ties go to the lowest ``tie_break`` values, by default all other columns
    in order, so the choice does not depend on how rows are spread over tasks
    and a recomputed task makes the same one.
    """
    newest = F.col(order_by) if isinstance(order_by, str) else order_by
    return _first(df, keys, [newest.desc_nulls_last(), *_ties(df, keys, tie_break)])


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key when no column says which is newest."""
    return _first(df, keys, _ties(df, keys, tie_break))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of same-entity tables; a column absent from one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_latest(
    frames: Sequence[DataFrame],
    key: str,
    order_by: str,
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Latest row per key over several sources.

    On equal times the source listed later wins, and rows without a time lose
    to rows with one. Sources with one row per key need no further
    ``tie_break``; an empty one spares reading all columns to compare them.
    """
    ranked = [df.withColumn(_SOURCE_RANK, F.lit(i)) for i, df in enumerate(frames)]
    merged = union_sources(ranked)
    ties = [F.col(_SOURCE_RANK).desc(), *_ties(merged.drop(_SOURCE_RANK), [key], tie_break)]
    return latest_per_key(merged, [key], order_by, ties).drop(_SOURCE_RANK)


def known_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows that are one per key, in a form that Spark knows to be so: a left join with them
    is left out where none of their columns is read."""
    return df.dropDuplicates([key])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()


def _ties(df: DataFrame, keys, tie_break) -> list[Column]:
    if tie_break is None:
        tie_break = [
            f.name for f in df.schema.fields if f.name not in keys and orderable(f.dataType)
        ]
    return [c if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in tie_break]


def orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def _first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    return df.withColumn(_ROW, F.row_number().over(window)).where(F.col(_ROW) == 1).drop(_ROW)
