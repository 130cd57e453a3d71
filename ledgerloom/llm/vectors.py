"""Embedding near-duplicates by spherical-cap filters.

Filter directions are structured: the coordinates, turned by a fixed rotation, are
cut into parts, each part has a code of random unit vectors, and a direction is one
codeword per part. There are several such codes, each with a rotation of its own. A vector's score for a direction is the sum of its parts'
scores, so the directions above the threshold are list-decoded part by part without
visiting all of them. Vectors that share a filter and a label meet, and their
cosine in double precision decides. Every vector also enters each code's best
direction.

Equal vectors are compared once: rows are grouped by label and vector first, and
the groups' sizes enter the link counts. A filter's group of more than ``TILE``
vectors is dealt into parts, and every two parts meet in a task of their own.
Such a tile emits no pairs: for each vector how many links it has there, and a
spanning forest of them. A link is counted in the smallest filter that both
vectors have, so once.

Null labels, null or zero vectors, and vectors with null or non-finite components
link with nothing. Vectors of other lengths are compared with their own length
only. Rows that repeat an id each are a vector of their own. A row without an id
counts and links like others; its component is the smallest id that it reaches, null
if there is none, and it is kept only then. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.components import components

SEED = 42
TILE = 1024
#: Vectors whose scores are held at once.
ROWS = 256


@dataclass(frozen=True)
class Caps:
    """``turns`` product codes of ``parts`` times ``words`` codewords.

    ``threshold`` is in standard deviations of a random direction's score. More
    codewords and a higher threshold make smaller groups for larger tables.
    """

    turns: int = 8
    parts: int = 2
    words: int = 64
    threshold: float = 3.0

    @lru_cache(maxsize=64)  # noqa: B019  (one of few equal, immutable objects)
    def codes(self, dims: int, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The rotation and the codewords of one code for vectors of so many dimensions."""
        draw = np.random.default_rng([SEED, dims, number])
        turn, _ = np.linalg.qr(draw.standard_normal((dims, dims)))
        codes = []
        for own in np.array_split(np.arange(dims), self.parts):
            code = draw.standard_normal((len(own), self.words))
            norm = np.linalg.norm(code, axis=0, keepdims=True)
            code = code / np.where(norm == 0, 1, norm) * np.sqrt(len(own))
            if len(own) < 2:  # one dimension has two unit vectors, none has one
                code = np.unique(code, axis=1) if len(own) else code[:, :1]
            codes.append(code)
        return turn, codes

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter number of every direction whose score reaches the threshold, best ones included."""
        found = [self._decode(unit, number) for number in range(self.turns)]
        return np.concatenate([row for row, _ in found]), np.concatenate(
            [number + turn * self.words**self.parts for turn, (_, number) in enumerate(found)]
        )

    def _decode(self, unit: np.ndarray, code: int) -> tuple[np.ndarray, np.ndarray]:
        turn, codes = self.codes(unit.shape[1], code)
        turned = unit @ turn
        edges = np.cumsum([0, *(len(c) for c in codes)])
        scores = [turned[:, a:b] @ c for a, b, c in zip(edges[:-1], edges[1:], codes, strict=True)]
        best = [s.max(axis=1) for s in scores]
        # A direction's score never beats its parts' best; what the later parts can add prunes the list.
        later = np.cumsum([np.zeros(len(unit)), *best[::-1]], axis=0)[::-1]
        row, number, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for part, score in enumerate(scores):
            grown = total[:, None] + score[row]
            need = np.minimum(self.threshold, later[0][row] - 1e-9) - later[part + 1][row]
            at, word = np.nonzero(grown >= need[:, None])
            total, number, row = grown[at, word], number[at] * self.words + word, row[at]
        return row, number


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _filters(caps: Caps) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                vectors = part.column("vector").to_pylist()
                sizes = np.array([len(x) for x in vectors])
                for dims in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dims)
                    unit = _unit(np.array([vectors[i] for i in rows], np.float64))
                    at, number = caps.decode(unit)
                    order = np.lexsort((number, at))
                    at, number = at[order], number[order]
                    ends = np.searchsorted(at, np.arange(len(rows) + 1)).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32)))
                    taken = part.take(pa.array(rows[at]))
                    yield pa.record_batch(
                        [pa.array(number), lists.take(pa.array(at)), *taken.columns], ["filter", "filters", *part.schema.names]
                    )

    return run


def _marks(filters: list[np.ndarray], below: int) -> np.ndarray:
    """A bit per vector and filter for those below a number that at least two of the vectors have."""
    row = np.repeat(np.arange(len(filters)), [len(x) for x in filters])
    number = np.concatenate(filters)
    row, number = row[number < below], number[number < below]
    _, where, n = np.unique(number, return_inverse=True, return_counts=True)
    bit = (np.cumsum(n > 1) - 1)[where]
    row, bit = row[n[where] > 1], bit[n[where] > 1]
    marks = np.zeros((len(filters), int(np.count_nonzero(n > 1)) // 64 + 1), np.uint64)
    np.bitwise_or.at(marks, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    return marks


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest vector that each one reaches."""
    root = np.arange(count)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _links(unit: np.ndarray, least: float, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of one tile; pairs inside a part belong to that part's own tile."""
    ends: list[np.ndarray] = [np.empty((2, 0), np.int64)]
    mixed = part.min() != part.max()
    for start in range(0, len(unit), TILE):
        a, b = np.nonzero(unit[start : start + TILE] @ unit.T >= least)
        a += start
        kept = (a < b) & ((part[a] != part[b]) | (not mixed))
        ends.append(np.stack([a[kept], b[kept]]))
    a, b = np.concatenate(ends, axis=1)
    return a, b


def _counts(a: np.ndarray, b: np.ndarray, copies: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Rows linked with each vector by pairs without a common mark."""
    counted = np.zeros(len(copies), np.int64)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        fresh = np.ones(len(x), bool)
        for word in range(marks.shape[1]):
            fresh &= (marks[x, word] & marks[y, word]) == 0
        np.add.at(counted, x[fresh], copies[y[fresh]])
        np.add.at(counted, y[fresh], copies[x[fresh]])
    return counted


def _verified(least: float) -> Callable:
    """Rows sorted by tile to links counted and one edge of the forest per vector."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda name: table[name].to_numpy()
        tile, check, filters = column("tile"), column("check"), column("filter")
        nodes, part, copies = column("node"), column("part"), column("copies")
        lists, vectors = table["filters"].combine_chunks(), table["vector"].combine_chunks()
        own, number = lists.offsets.to_numpy(), lists.values.to_numpy()
        at = vectors.offsets.to_numpy()
        flat = vectors.values.to_numpy().astype(np.float64)
        new = (tile[1:] != tile[:-1]) | (check[1:] != check[:-1]) | (filters[1:] != filters[:-1])
        for rows in np.split(np.arange(len(tile)), np.flatnonzero(new) + 1):
            if len(rows) < 2:
                continue
            unit = _unit(np.stack([flat[at[i] : at[i + 1]] for i in rows]))
            a, b = _links(unit, least, part[rows])
            if not len(a):
                continue
            used, where = np.unique(np.concatenate([a, b]), return_inverse=True)
            a, b, rows = where[: len(a)], where[len(a) :], rows[used]
            marks = _marks([number[own[i] : own[i + 1]] for i in rows], int(filters[rows[0]]))
            counted, root = _counts(a, b, copies[rows], marks), _roots(len(rows), a, b)
            edge = root != np.arange(len(rows))
            kept = edge | (counted > 0)
            if kept.any():
                node = nodes[rows]
                yield pa.record_batch(
                    [pa.array(node[kept]), pa.array(node[root][kept]), pa.array(counted[kept])], ["a", "b", "others"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            table = pa.Table.from_batches(held)
            tile = table["tile"].to_numpy()
            cut = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on
            if cut and size >= 2 * TILE:
                yield from pairs(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size -= cut
        if size:
            yield from pairs(pa.Table.from_batches(held))

    return run


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.93,
    caps: Caps = Caps(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    )
    element = rows.schema["vector"].dataType.elementType
    if element.typeName() not in ("float", "double"):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
        element = rows.schema["vector"].dataType.elementType
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = (
        F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad)
        & F.exists("vector", lambda x: x != 0)
    )
    # -0.0 equals 0.0 as a number but not as bytes
    clean = F.when(F.coalesce(usable, F.lit(False)), F.transform("vector", lambda x: F.when(x == 0, F.lit(0).cast(element)).otherwise(x)))
    rows = stored(rows.select("id", "label", clean.alias("vector")), "vectors")
    good = rows.filter("vector is not null").withColumn("hash", F.md5(F.to_json(F.struct("label", "vector"))))
    nodes = stored(
        good.groupBy("hash").agg(
            F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"), F.first("vector").alias("vector"),
        ).withColumn("node", F.monotonically_increasing_id()),  # fixed once stored
        "vector-nodes",
    )
    met = nodes.select("node", "copies", "label", "vector").mapInArrow(
        _filters(caps),
        f"filter bigint, filters array<int>, node bigint, copies bigint, label string, vector array<{element.simpleString()}>",
    ).withColumns({
        "block": F.xxhash64("filter", "label", F.size("vector")),
        "check": F.xxhash64(F.lit(SEED), F.size("vector"), "label", "filter"),
    })
    sizes = met.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("parts"), F.count(F.lit(1)).alias("n"))
    mine = F.pmod(F.xxhash64("node"), F.col("parts"))
    tiles = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1),
        lambda other: F.xxhash64("block", F.least(mine, other), F.greatest(mine, other)),
    )
    dealt = met.join(sizes.filter("n > 1").select("block", "parts"), "block").select(
        F.explode(tiles).alias("tile"), "check", "filter", "filters", "node", "copies", mine.alias("part"), "vector"
    )
    links = stored(
        dealt.repartition("tile").sortWithinPartitions("tile", "check", "filter")
        .mapInArrow(_verified(least), "a bigint, b bigint, others bigint"),
        "vector-links",
    )
    others = links.groupBy("a").agg(F.sum("others").alias("others")).withColumnRenamed("a", "node")
    groups = nodes.select("hash", "node", "least_id", "copies").join(
        components(links.filter("a <> b").select("a", "b")), "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    smallest = groups.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = groups.join(smallest, "component").join(others, "node", "left").select(
        "hash", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    found = good.select("id", "hash").join(named, "hash").drop("hash")
    alone = rows.filter("vector is null").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return found.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
