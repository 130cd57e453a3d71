"""Joins of large fact rows with one-row-per-key tables.

One equi-join each; which side is sent where is left to Spark. A key with many rows
is split at run time by adaptive execution from the real sizes of the shuffle, also
if a grouping or another join on the same key follows (see ``ledgerloom.session``).
Building a join starts no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.specs import JoinSpec


def join_lookup(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None, how: str = "inner"
) -> DataFrame:
    """``left`` join ``right`` on one key, keeping the left key column only."""
    matched = f"_right_{right_key or left_key}"
    renamed = right.withColumnRenamed(right_key or left_key, matched)
    return left.join(renamed, F.col(left_key) == F.col(matched), how).drop(matched)


def join_chain(frames: Mapping[str, DataFrame], joins: Sequence[JoinSpec]) -> DataFrame:
    """Fold declared joins over named frames.

    The first join names its left side; later ones continue the running
    result. Columns of a right side are renamed as declared, and a name that is
    still taken is an error here instead of an ambiguous reference later.
    """
    if not joins or joins[0].left is None:
        raise ValueError("the first join must name its left side")
    result = frames[joins[0].left]
    for join in joins:
        if join.left is not None and join is not joins[0]:
            raise ValueError("only the first join names its left side")
        right = frames[join.right].withColumnsRenamed(dict(join.rename))
        key = join.rename.get(join.right_key, join.right_key)
        clashes = set(result.columns) & set(right.columns) - {key}
        if clashes:
            raise ValueError(f"join with {join.right}: columns {sorted(clashes)} exist already")
        result = join_lookup(result, right, join.left_key, key, join.how)
    return result
