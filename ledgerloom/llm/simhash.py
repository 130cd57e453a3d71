"""Near-duplicates by SimHash with bit-sliced comparison.

Fingerprints that share an index key meet in a block. Inside a block the bits are
stored as planes: one machine word holds the same bit of 64 fingerprints. A
query's differences to those 64 are counted together by carry-save adders, eight
planes at a time, into counters that start so high that passing the radius
overflows them; a word whose 64 counters have all overflowed is abandoned.

Keys: the bits are cut into pieces, and every choice of all but ``radius`` of them is a key. Fingerprints
within the radius differ in at most so many pieces and so share a key: no pair is missed,
whatever the number of pieces. More pieces give more and longer keys, hence smaller blocks; the number
follows from that of different fingerprints.

Equal fingerprints are one node, named by its bits. A block larger than ``TILE`` is dealt into parts
and every two parts meet in a task of their own, so no task holds a whole hot
block. A task emits only as many links as join its rows (a forest), never all pairs.

Null text is empty text; a text without words has fingerprint zero and links like
any other. Rows that repeat an id are documents of their own, reported each. Rows without an id link
too; a group's component is its smallest id, null if it has none. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored, text_rows
from ledgerloom.llm.components import components
from ledgerloom.llm.exact import without

SEED = 42
BITS = 64
#: Rows of a block that are compared in one task; larger blocks are dealt into parts of about this size.
TILE = 4096
#: Query-word pairs whose counters are held at once; each has up to 64 near rows.
PAIRS = 1 << 14
#: Shingle hashes that are counted at once.
HASHES = 1 << 15


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words (the whole sequence if there are fewer)."""
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(x) + 1 for x in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    runs = max(1, len(parts) - words + 1)
    last = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts[:runs].tolist(), last.tolist(), strict=True)),
        np.uint64,
        runs,
    )


def fingerprint(hashes: np.ndarray) -> bytes:
    """Bits set in over half of the hashes, highest bit first."""
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES):
        part = hashes[start : start + HASHES, None]
        bits = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")
        for row in range(0, len(bits), 255):
            total += bits[row : row + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits((total * 2 > len(hashes))[::-1]).tobytes()


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``id, hash, print`` of ``docs(id, text, hash)``; the hash tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(shingle_hashes(x, words)) for x in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("id"), batch.column("hash"), pa.array(prints, pa.binary())], ["id", "hash", "print"]
            )

    return docs.mapInArrow(run, "id bigint, hash string, print binary")


def keys_of(radius: int, pieces: int) -> list[np.ndarray]:
    """The bit numbers of each key: all choices of ``pieces - radius`` pieces."""
    cut = np.array_split(np.arange(BITS), pieces)
    return [np.concatenate(chosen) for chosen in combinations(cut, pieces - radius)]


def pieces_for(radius: int, rows: int) -> int:
    """So many pieces that a key has about a value for every ``TILE`` / 4 rows, two more than the radius at most."""
    pieces = radius + 1
    while pieces < radius + 3 and rows > TILE // 4 * 2 ** (BITS * (pieces - radius) // pieces):
        pieces += 1
    return pieces


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints, axis=1, bitorder="little")


def _keyed(keys: list[np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = b"".join(batch.column(1).to_pylist())
            bits = _bits(np.frombuffer(raw, np.uint8).reshape(batch.num_rows, -1))
            for number, places in enumerate(keys):
                value = np.zeros(batch.num_rows, np.int64)
                for place in places:
                    value = value << 1 | bits[:, place]
                block = (value << 16 | number).astype(np.int64)
                yield pa.record_batch([pa.array(block), *batch.columns], ["block", *batch.schema.names])

    return run


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum bit and carry of three words."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def near_pairs(prints: np.ndarray, block: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs i < j of equal ``block`` within ``radius``, part by part; rows are sorted by block.

    ``prints`` holds bytes, one row per fingerprint.
    """
    rows, width = len(prints), prints.shape[1] * 8
    if rows < 2:
        return
    words = -(-rows // 64)
    padded = np.zeros((words * 64, width), np.uint8)
    padded[:rows] = _bits(prints)
    planes = np.packbits(np.ascontiguousarray(padded.T), axis=1, bitorder="little").view("<u8")
    masks = np.where(padded[:rows].T.astype(bool), np.uint64(2**64 - 1), np.uint64(0))
    end = np.searchsorted(block, block, side="right")
    first = np.arange(rows) // 64
    spans = np.where(end - np.arange(rows) > 1, (end - 1) // 64 - first + 1, 0)
    ends = np.cumsum(spans)
    counter_bits = max(4, int(radius + 1).bit_length() + 1)
    start = 2**counter_bits - 1 - radius
    begin = 0
    while begin < rows:
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS, side="right")))
        query = np.repeat(np.arange(begin, stop), spans[begin:stop])
        base = np.cumsum(spans[begin:stop]) - spans[begin:stop]
        word = first[query] + np.arange(len(query)) - np.repeat(base, spans[begin:stop])
        begin = stop
        # Lanes after the query and inside its block; all others count as passed.
        low = np.clip(query + 1 - word * 64, 0, 64)
        high = np.clip(end[query] - word * 64, 0, 64)
        ones = np.uint64(2**64 - 1)
        upto = np.where(high == 64, ones, (np.uint64(1) << (high % 64).astype(np.uint64)) - np.uint64(1))
        below = np.where(low == 64, ones, (np.uint64(1) << (low % 64).astype(np.uint64)) - np.uint64(1))
        passed = ~(upto & ~below)
        count = [np.full(len(query), ones if start >> k & 1 else 0, np.uint64) for k in range(counter_bits)]
        for plane in range(0, width, 8):
            live = np.flatnonzero(passed != ones)
            if len(live) < len(query):
                query, word, passed = query[live], word[live], passed[live]
                count = [x[live] for x in count]
            if not len(query):
                break
            d = [planes[p][word] ^ masks[p][query] for p in range(plane, plane + 8)]
            s1, c1 = _add(d[0], d[1], d[2])
            s2, c2 = _add(d[3], d[4], d[5])
            s3, c3 = d[6] ^ d[7], d[6] & d[7]
            s, c4 = _add(s1, s2, s3)
            t1, e1 = _add(c1, c2, c3)
            t, e2 = t1 ^ c4, t1 & c4
            number = [s, t, e1 ^ e2, e1 & e2]
            carry = np.zeros(len(query), np.uint64)
            for k in range(counter_bits):
                count[k], carry = _add(count[k], number[k] if k < 4 else np.uint64(0), carry)
            passed = passed | carry
        hit = np.flatnonzero(passed != ones)
        if len(hit):
            near = np.unpackbits((~passed[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(near)
            yield query[hit][at], word[hit][at] * 64 + lane


def _joined(low: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``low``, the smallest row that each row reaches, with more links."""
    while True:
        a, b = low[left], low[right]
        open_ = a != b
        if not open_.any():
            return low
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        least = np.minimum(a, b)
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        while (low[low] != low).any():
            low = low[low]


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row with links and the smallest row that its links reach (no row linked to itself)."""
    low = np.arange(rows)
    for left, right in pairs:
        low = _joined(low, left, right)
    moved = np.flatnonzero(low != np.arange(rows))
    return moved, low[moved]


def _links(table: pa.Table, prints: np.ndarray, block: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    ids = table["id"].to_numpy()
    a, b = forest(near_pairs(prints, block, radius), len(ids))
    yield pa.record_batch([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])


def _compared(radius: int) -> Callable:
    """Sorted rows of whole blocks to links; blocks are gathered until a window is full."""

    def links(window: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(window)
        part = table["part"].to_numpy()
        raw = b"".join(table["print"].to_pylist())
        prints = np.frombuffer(raw, np.uint8).reshape(len(part), -1)
        edges = np.flatnonzero(part[1:] != part[:-1]) + 1
        number = np.zeros(len(part), np.int64)
        number[edges] = 1
        yield from _links(table, prints, np.cumsum(number), radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < 4 * TILE:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            part = table["part"].to_numpy()
            cut = int(np.searchsorted(part, part[-1]))  # the last block may go on
            if cut:
                yield from links(table.slice(0, cut).to_batches())
            held = table.slice(cut).to_batches()
            size = table.num_rows - cut
        if size:
            yield from links(held)

    return run


def _dealt(columns: list[str], parts: str = "parts") -> list:
    """Columns that deal a row to every tile of its block: tile (p, q) holds the parts p and q."""
    mine = F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col(parts).cast("int") - 1),
        lambda other: F.least(mine, other) * F.col(parts) + F.greatest(mine, other),
    )
    return [F.col("block"), *columns, F.explode(tiles).alias("tile")]


def _tiles(nodes: DataFrame, keys: list[np.ndarray]) -> DataFrame:
    """``part`` and the columns of ``nodes(id, print, ...)``: every two rows of a block share a part."""
    keyed = nodes.mapInArrow(
        _keyed(keys), "block bigint, " + ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in nodes.schema)
    )
    hot = (
        keyed.groupBy("block").count().filter(F.col("count") > TILE)
        .select(F.col("block").alias("hot"), F.ceil(F.col("count") / TILE).alias("parts"))
    )
    if len(keys) * 2 ** max(map(len, keys)) <= 1 << 18:
        hot = F.broadcast(hot)  # no more rows than keys exist
    return (
        keyed.join(hot, keyed["block"] == hot["hot"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .select(*_dealt(nodes.columns))
        .select(F.xxhash64("block", "tile").alias("part"), *nodes.columns)
    )


def link_prints(nodes: DataFrame, radius: int, pieces: int | None = None) -> DataFrame:
    """``a, b``: links that connect all fingerprints of ``nodes(id, print)`` as the full set of near pairs does."""
    if pieces is None:
        pieces = pieces_for(radius, nodes.count())
    tiles = _tiles(nodes, keys_of(radius, pieces))
    sorted_tiles = tiles.repartition("part").sortWithinPartitions("part")
    return sorted_tiles.mapInArrow(_compared(radius), "a bigint, b bigint")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, words: int, radius: int, pieces: int | None
) -> tuple[DataFrame, DataFrame]:
    """``id, hash, print`` of every row; and ``print, kept_id, kept_hash``: the row of the smallest id in its group."""
    rows = text_rows(docs, id_col, text_col).withColumn("hash", F.md5("text"))
    prints = stored(fingerprints(rows, words), "prints")
    # The row with the smallest id; of rows without an id, or with the same, that with the smallest hash.
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "hash"))
    bits = F.conv(F.hex("print"), 16, -10).cast("bigint")
    nodes = stored(prints.groupBy("print").agg(first.alias("one")).select("print", "one", bits.alias("node")), "nodes")
    groups = components(link_prints(nodes.select(F.col("node").alias("id"), "print"), radius, pieces))
    named = nodes.join(groups, "node", "left").select("print", "one", F.coalesce("component", "node").alias("component"))
    kept = named.groupBy("component").agg(F.min("one").alias("kept"))
    chosen = named.join(kept, "component").select(
        "print", F.col("kept.id").alias("kept_id"), F.col("kept.hash").alias("kept_hash")
    )
    return prints, chosen


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    pieces: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    prints, chosen = _grouped(docs, id_col, text_col, words, radius, pieces)
    return prints.join(chosen, "print").select(
        F.col("id").alias("doc_id"), F.lower(F.hex("print")).alias("fingerprint"), F.col("kept_id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest ``doc_id``; one without an id only if all are."""
    prints, chosen = _grouped(docs, "doc_id", "text", words, radius, None)
    stays = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
    verdicts = prints.join(chosen, "print").select("id", "hash", stays.alias("kept"))
    return without(docs, verdicts, F.md5(F.coalesce("text", F.lit(""))))
