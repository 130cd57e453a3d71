"""Ranked lexical search with MaxScore and bounds for pairs of terms.

Texts are cut into segments of a bounded number of documents. A segment holds, for
every term that some item asks for, its documents and frequencies (``index``), and
the corpus counts are summed over all segments. When a segment is searched it first
gets, for each term, the largest impact and the ``top``-th largest one, and for the
pairs of frequent terms that items share most, the intersection of their lists with
the largest joint impact.

An item's terms are then ordered by their largest impact. The leading terms whose
bounds together stay below the score of the ``top``-th document so far need not be
visited to find candidates. Two terms with an intersection list are bounded together by
the larger of their joint maximum and either maximum alone, which is often far less
than the sum, so more terms are skipped and candidates are dropped earlier. Scores
are exact integers; a document is only skipped if it must score less than ``top``
others. A task carries its best documents from segment to segment and emits them
once; the best of all tasks remain.

Items are taken in blocks of bounded size, all documents for each block.

A null text has no terms; documents without terms are not counted and never found.
Items without terms, or with none that occurs, have no rows. Equal rows of items are
one item; items that share an id but not the text are ranked each for itself. Each row
of a repeated document id is a document; at equal scores those without an id come
last. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored

#: Items of a block, and the bytes of their texts (one longer text is a block of its own).
BLOCK_ITEMS = 2000
BLOCK_BYTES = 8 << 20
#: Documents and postings of a segment.
SEGMENT_DOCS = 8192
SEGMENT_POSTINGS = 1 << 20
#: Pairs of terms with an intersection list, and the share of documents both terms must at least be in.
PAIRS = 1024
PAIR_SHARE = 1 / 256

_NO_ID = np.iinfo(np.int64).max
#: Letters and digits stay, A-Z are lower-cased, bytes of other signs stay, all else parts terms.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order, repeats included."""
    return (text or "").encode().translate(_FOLDED).split()


_SEGMENT = "ids binary, lengths binary, terms binary, counts binary, places binary, tfs binary"


def _indexed(numbers: dict[bytes, int]) -> Callable:
    """``id, text`` to segments: per document id and length, per term the number, count, places and frequencies."""

    def segment(ids: list[int], lengths: list[int], hits: list[np.ndarray]) -> pa.RecordBatch:
        place = np.repeat(np.arange(len(ids), dtype=np.int64), [len(x) for x in hits])
        key, tf = np.unique(np.concatenate(hits).astype(np.int64) * len(ids) + place, return_counts=True)
        term, count = np.unique(key // len(ids), return_counts=True)
        columns = (
            np.array(ids, "<i8"), np.array(lengths, "<i8"), term.astype("<i4"), count.astype("<i4"),
            (key % len(ids)).astype("<u2"), tf.astype("<i4"),
        )
        names = [x.split()[0] for x in _SEGMENT.split(", ")]
        return pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        lengths: list[int] = []
        hits: list[np.ndarray] = []
        size = 0
        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms(text)
                if not words:
                    continue
                found = np.fromiter((x for x in map(numbers.get, words) if x is not None), np.int32)
                if ids and (len(ids) == SEGMENT_DOCS or size + len(found) > SEGMENT_POSTINGS):
                    yield segment(ids, lengths, hits)
                    ids, lengths, hits, size = [], [], [], 0
                ids.append(_NO_ID if key is None else key)
                lengths.append(len(words))
                hits.append(found)
                size += len(found)
        if ids:
            yield segment(ids, lengths, hits)

    return run


def index(docs: DataFrame, numbers: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of all documents with the postings of the numbered terms, stored in the shared folder."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.filter("text is not null").mapInArrow(_indexed(numbers), _SEGMENT), "segments")


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, all their terms, and the weight of each numbered term."""

    documents: int
    length: int
    weights: np.ndarray
    frequencies: np.ndarray


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, n`` of a partition; term -1 counts documents, -2 their terms."""
    total: Counter[int] = Counter()
    for batch in batches:
        for lengths, numbers, counts in zip(*(batch.column(x).to_pylist() for x in ("lengths", "terms", "counts")), strict=True):
            own = np.frombuffer(lengths, "<i8")
            total[-1] += len(own)
            total[-2] += int(own.sum())
            for number, n in zip(np.frombuffer(numbers, "<i4").tolist(), np.frombuffer(counts, "<i4").tolist(), strict=True):
                total[number] += n
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["term", "n"])


def corpus(segments: DataFrame, terms_asked: int) -> Corpus:
    """Counts over all segments; as many rows reach the driver as terms are asked for."""
    rows = segments.select("lengths", "terms", "counts").mapInArrow(_counted, "term int, n bigint")
    found = dict(map(tuple, rows.groupBy("term").agg(F.sum("n")).collect()))
    n = found.get(-1, 0)
    held = [found.get(i, 0) for i in range(terms_asked)]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held]
    return Corpus(n, found.get(-2, 0), np.array(weights, np.int64), np.array(held, np.int64))


def shared_pairs(items: list[Counter[int]], stats: Corpus) -> list[tuple[int, int]]:
    """The pairs of frequent terms that most items hold, each item pairing its terms by falling frequency."""
    used: Counter[tuple[int, int]] = Counter()
    for item in items:
        often = [t for t in item if stats.frequencies[t] >= max(2, PAIR_SHARE * stats.documents)]
        often.sort(key=lambda t: (-stats.frequencies[t], t))
        used.update((min(a, b), max(a, b)) for a, b in zip(often[::2], often[1::2], strict=False))
    return [pair for pair, _ in sorted(used.items(), key=lambda x: (-x[1], x[0]))[:PAIRS]]


class Segment:
    """A segment's lists with their impacts, its bounds, and the intersection lists of pairs."""

    def __init__(self, row: dict[str, bytes], stats: Corpus, pairs: list[tuple[int, int]], top: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        lengths = np.frombuffer(row["lengths"], "<i8")
        numbers, counts = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["counts"], "<i4")
        ends = np.cumsum(counts, dtype=np.int64)
        places = np.frombuffer(row["places"], "<u2").astype(np.int64)
        tf = np.frombuffer(row["tfs"], "<i4").astype(np.int64)
        m = 75 + 25 * lengths * stats.documents // stats.length
        impacts = np.repeat(stats.weights[numbers], counts) * (1_000_000_000 * tf // (1000 * tf + 12 * m[places]))
        self.lists = {
            t: (places[a:b], impacts[a:b])
            for t, a, b in zip(numbers.tolist(), (ends - counts).tolist(), ends.tolist(), strict=True)
        }
        self.highest = {t: int(own.max()) for t, (_, own) in self.lists.items()}
        self.floor = {t: _nth(own, top) for t, (_, own) in self.lists.items()}
        self.pairs = {}
        dense = np.zeros(len(self.ids), np.int64)
        for a, b in pairs:
            if a in self.lists and b in self.lists:
                (at_a, own_a), (at_b, own_b) = self.lists[a], self.lists[b]
                dense[at_a] = own_a
                both = dense[at_b] > 0
                joint = dense[at_b[both]] + own_b[both]
                dense[at_a] = 0
                self.pairs[a, b] = (at_b[both], joint, int(joint.max(initial=0)), _nth(joint, top))


def _nth(values: np.ndarray, top: int) -> int:
    """The ``top``-th largest value, 0 if there are fewer."""
    return int(np.partition(values, len(values) - top)[-top]) if len(values) >= top else 0


def best_of(segment: Segment, item: Counter[int], top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of all documents that may be among the ``top`` best; those below ``least`` are not needed."""
    asked = sorted((segment.highest[t] * q, t) for t, q in item.items() if segment.highest.get(t))
    if not asked:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = max(1, least, *(segment.floor[t] * item[t] for _, t in asked))
    # bounds[k]: no document scores more by the first k terms alone
    bounds, alone, mates = [0], {}, {t for _, t in asked}
    partner = {}
    for a, b in segment.pairs:
        if a in mates and b in mates and a not in partner and b not in partner:
            partner[a], partner[b] = b, a
            least = max(least, segment.pairs[a, b][3] * min(item[a], item[b]))
    for high, t in asked:
        other = partner.get(t)
        if other in alone:
            pair = segment.pairs[min(t, other), max(t, other)]
            joint = min(high + alone[other], pair[2] * max(item[t], item[other]))
            bounds.append(bounds[-1] - alone[other] + max(joint, high, alone[other]))
        else:
            bounds.append(bounds[-1] + high)
        alone[t] = high
    skipped = max(k for k in range(len(bounds)) if bounds[k] < least)
    score = np.zeros(len(segment.ids), np.int64)
    for _, t in asked[skipped:]:
        at, own = segment.lists[t]
        score[at] += own * item[t]
    found = np.flatnonzero(score)
    for k in range(skipped, 0, -1):
        found = found[score[found] + bounds[k] >= least]
        if not len(found):
            break
        t = asked[k - 1][1]
        at, own = segment.lists[t]
        if len(found) * 16 < len(at):
            near = np.minimum(np.searchsorted(at, found), len(at) - 1)
            score[found] += np.where(at[near] == found, own[near], 0) * item[t]
        else:
            score[at] += own * item[t]
    found = found[score[found] >= least]
    return score[found], found


def _ranked(items: list[Counter[int]], stats: Corpus, pairs: list[tuple[int, int]], top: int) -> Callable:
    """Segments to ``item, id, score``: a task's ``top`` best documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        for batch in batches:
            for start in range(batch.num_rows):
                segment = Segment(batch.slice(start, 1).to_pylist()[0], stats, pairs, top)
                for number, item in enumerate(items):
                    scores, ids = best[number]
                    least = int(scores[-1]) if len(scores) == top else 0
                    more, at = best_of(segment, item, top, least)
                    if len(more):
                        scores, ids = np.concatenate((scores, more)), np.concatenate((ids, segment.ids[at]))
                        order = np.lexsort((ids, -scores))[:top]
                        best[number] = (scores[order], ids[order])
        number = np.repeat(np.arange(len(items)), [len(x) for x, _ in best])
        if len(number):
            yield pa.record_batch(
                [
                    pa.array(number.astype(np.int32)), pa.array(np.concatenate([x for _, x in best])),
                    pa.array(np.concatenate([x for x, _ in best])),
                ],
                ["item", "id", "score"],
            )

    return run


_RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def _search_block(docs: DataFrame, asked: list[tuple[int | None, str]], top: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    items = [Counter(numbers.setdefault(t, len(numbers)) for t in terms(text)) for _, text in asked]
    segments = index(docs, numbers, id_col, text_col)
    stats = corpus(segments, len(numbers))
    if not stats.documents:
        return spark.createDataFrame([], _RESULT)
    found = segments.mapInArrow(
        _ranked(items, stats, shared_pairs(items, stats), top), "item int, id bigint, score bigint"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(x for x, _ in asked)), "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select(  # at most BLOCK_ITEMS rows
        "item_id", "rank", F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "score"
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``top`` highest-scoring documents."""
    rows = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text"))
    rows = rows.filter("text is not null").distinct().orderBy("item_id", "text")
    results, block, size = [], [], 0
    for row in rows.toLocalIterator():  # a block at a time
        if block and (len(block) == BLOCK_ITEMS or size + len(row["text"]) > BLOCK_BYTES):
            results.append(_search_block(docs, block, top, id_col, text_col))
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        results.append(_search_block(docs, block, top, id_col, text_col))
    return reduce(DataFrame.unionByName, results) if results else docs.sparkSession.createDataFrame([], _RESULT)
