"""Exact duplicates by content hash, with the bytes compared inside each group.

Rows meet by the 128-bit MD5 of the whole text. Hashes held by one row end there.
Texts are shuffled once, to keep those of the shared hashes; these are grouped by
hash *and* text, so that two texts with one hash are two groups. Both groupings
combine before the shuffle, so a text with a third of all rows is one row per task.

Null text counts as empty. Empty texts equal one another. Rows without an id form
groups like others but are never chosen while the group has an id; a group
without any id keeps all its rows. Rows that repeat id and text share one verdict;
``drop_exact_duplicates`` leaves one of them, also where no row of the group has an
id. An id may stand on several texts; each of them has its own verdict. An empty table gives an empty result.
Other columns are ignored here and carried through by ``drop_exact_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, text_rows


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` names the id of a group that stays: ``smallest`` or ``largest``.
    """
    choose = {"smallest": F.min, "largest": F.max}[keep]
    rows = text_rows(docs, id_col, text_col).withColumn("hash", F.md5("text"))
    digests = rows.select("id", "hash", F.sha2("text", 256).alias("text_sha256"))
    shared = rows.groupBy("hash").count().filter("count > 1").select("hash")
    suspects = stored(rows.join(shared, "hash", "left_semi"), "exact-suspects")
    groups = suspects.groupBy("hash", "text").agg(
        choose("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    members = (
        suspects.select("id", "hash", "text").distinct().join(groups, ["hash", "text"])
        .select(F.col("id").alias("member"), F.col("hash").alias("group_hash"), "keep_id", "group_size")
    )
    same = digests["id"].eqNullSafe(members["member"]) & (digests["hash"] == members["group_hash"])
    joined = digests.join(members, same, "left")
    found = F.col("group_size").isNotNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(found, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.when(found, F.col("id").eqNullSafe(F.col("keep_id"))).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """``docs`` (columns ``doc_id``, ``text`` and any others) without all but one row of each text."""
    verdicts = exact_duplicates(docs, keep=keep).select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("hash"), "kept")
    return without(docs, verdicts, F.sha2(F.coalesce("text", F.lit("")), 256))


def without(docs: DataFrame, verdicts: DataFrame, text_hash: Column) -> DataFrame:
    """``docs`` without the rows that ``verdicts(id, hash, kept)``, one for each row, do not keep.

    Rows are told apart by id and text together. Rows that repeat both share a verdict; one of them stays.
    """
    keys = verdicts.groupBy("id", "hash").agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    keys = stored(keys.filter("not kept or rows > 1"), "verdicts")
    same = docs["doc_id"].cast("bigint").eqNullSafe(keys["id"]) & (text_hash == keys["hash"])
    twice = docs.join(keys.filter("kept"), same, "left_semi").withColumn("_text_hash", text_hash)
    return docs.join(keys, same, "left_anti").unionByName(
        twice.dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")
    )
