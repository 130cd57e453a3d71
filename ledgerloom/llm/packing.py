"""Best-fit packing of documents into token sequences by exact complements.

Documents are encoded, closed with an end id and cut only if longer than the
capacity. How pieces pack depends on their lengths alone, so the plan is made
from the number of pieces of each length, at most ``capacity`` numbers:

1. from the longest length down, the gap is looked up among single lengths, sums
   of two and sums of three; a combination that fills it exactly is used as often
   as the pieces of its lengths allow;
2. what is left is placed by best fit, longest first.

The plan is a list of patterns with a repeat count, whose number does not depend
on the number of documents. Pieces of a length are numbered in parallel (a hot
length is dealt into buckets with known first numbers) and take the plan's places
in that order. Repeated rows are packed each; rows without an id are packed like
others; null text is empty text (its sequence part is the end id alone); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored, text_rows
from ledgerloom.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
#: Buckets in which the pieces of one length are numbered.
BUCKETS = 256

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(tokenizer: str, capacity: int, with_ids: bool) -> Callable:
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, number, at // 4, len(part) // 4, zlib.crc32(part), part))
            doc, number, start, length, crc, parts = zip(*rows, strict=True)
            columns = [
                pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                flat = pa.array(np.frombuffer(b"".join(parts), "<i4"))
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                names.append("ids")
            # Arrow's allocator would keep, in each worker, what the encoder used for a slice and needs no more.
            pa.default_memory_pool().release_unused()
            yield pa.record_batch(columns, names)

    return run


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Each document's pieces: ``doc_id, piece, start, length, ids_crc32`` and perhaps ``ids``."""
    schema = _PIECE + (", ids array<int>" if with_ids else "")
    return text_rows(docs, id_col, text_col).mapInArrow(_cut(tokenizer, capacity, with_ids), schema)


class Complements:
    """Lengths that still have pieces, looked up by the sums of one, two or three of them."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def one(self, gap: int) -> Iterator[tuple[int, ...]]:
        if gap and self.counts[gap]:
            yield (gap,)

    def two(self, gap: int, most: int | None = None) -> Iterator[tuple[int, ...]]:
        """``(a, b)`` with a >= b, a + b = gap and a <= most, longest a first."""
        a = np.arange(min(gap - 1, most or gap), (gap - 1) // 2, -1)
        for x in a[(self.counts[a] > 0) & (self.counts[gap - a] > 0)].tolist():
            if self.counts[x] and self.counts[gap - x]:
                yield x, gap - x

    def three(self, gap: int) -> Iterator[tuple[int, ...]]:
        a = np.arange(gap - 2, (gap - 1) // 3, -1)
        for x in a[self.counts[a] > 0].tolist():
            for pair in self.two(gap - x, x):
                if not self.counts[x]:
                    break
                yield x, *pair


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used; ``counts[n]`` pieces have length n."""
    counts = np.array(counts, np.int64)
    index = Complements(counts)
    patterns: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...]) -> None:
        lengths, copies = np.unique(pattern, return_counts=True)
        times = int((counts[lengths] // copies).min())
        if times:
            counts[lengths] -= copies * times
            patterns.append((pattern, times))

    for length in range(capacity, 0, -1):
        gap = capacity - length
        if not gap and counts[length]:
            use((length,))
        for look in (index.one, index.two, index.three):
            if not counts[length]:
                break
            for rest in look(gap):
                use((length, *rest))
                if not counts[length]:
                    break

    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps = np.zeros(capacity + 1, bool)

    def place(pattern: tuple[int, ...], gap: int, length: int, left: int, bins: int) -> int:
        """Put ``length`` as often as it fits into up to ``bins`` bins; how many pieces are left."""
        fit = gap // length
        for copies, times in ((fit, min(bins, left // fit)), (left % fit, 1)):
            if copies and times and bins > 0 and left >= copies:
                new = gap - copies * length
                open_bins.setdefault(new, []).append((pattern + (length,) * copies, times))
                gaps[new] = True
                left -= copies * times
                bins -= times
            if not left:
                break
        if bins > 0 and pattern:
            open_bins.setdefault(gap, []).append((pattern, bins))
            gaps[gap] = True
        return left

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = np.flatnonzero(gaps[length:])
            if len(at):
                gap = length + int(at[0])
                pattern, bins = open_bins[gap].pop()
                gaps[gap] = bool(open_bins[gap])
                left = place(pattern, gap, length, left, bins)
            else:
                left = place((), capacity, length, left, left)
    patterns += [x for held in open_bins.values() for x in held]
    return patterns


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, in order of piece number: first number, copies a sequence, first sequence, offset."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in patterns:
        lengths, copies = np.unique(pattern, return_counts=True)
        offset = 0
        for length, copy in zip(lengths.tolist(), copies.tolist(), strict=True):
            first = used.get(length, 0)
            rows.setdefault(length, []).append((first, copy, sequence, offset))
            used[length] = first + copy * times
            offset += copy * length
        sequence += times
    return {length: np.array(x, np.int64) for length, x in rows.items()}


def _placed(table: dict[int, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence = np.empty(len(length), np.int64)
            offset = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(rows):
                    continue
                slots = table[int(length[rows[0]])]
                slot = slots[np.searchsorted(slots[:, 0], number[rows], side="right") - 1]
                within = number[rows] - slot[:, 0]
                sequence[rows] = slot[:, 2] + within // slot[:, 1]
                offset[rows] = slot[:, 3] + within % slot[:, 1] * length[rows]
            kept = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    table = places(plan(counts, capacity))
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS))
    dealt = cut.withColumn("bucket", bucket)
    sizes = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        dealt.withColumn("row", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "bucket"])
        .withColumn("number", F.col("first") + F.col("row"))
    )
    return numbered.drop("bucket", "row", "first").mapInArrow(
        _placed(table), _PIECE + ", sequence_id bigint, offset bigint"
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: the packed token sequences; ``doc_id`` must be unique and not null in ``docs``."""
    cut = pieces(docs, tokenizer, capacity, with_ids=True).select("doc_id", "piece", "ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # no more than ``capacity`` ids
    return (
        packed.select("doc_id", "piece", "sequence_id", "offset").join(cut, ["doc_id", "piece"])
        .groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    )
