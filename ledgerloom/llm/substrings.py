"""Removal of long byte strings that occur more than once, by suffix arrays.

Which strings can repeat is found first. In every window of ``WINDOW`` bytes the
smallest hash of a ``SEED_BYTES``-byte string is its anchor; equal windows have
equal anchors at equal places, so a window whose anchor's hash occurs once repeats
nowhere. The windows of one anchor are consecutive; the bytes they cover are the
anchor's neighbourhood. Neighbourhoods with equal hashes (64 bits of the anchor and 64
of all bytes) are one class that counts its copies, so a passage in a third of all
documents is one row, and its strings are repeats by these hashes: no array sees them.

An anchor hash with more than ``HOT`` different neighbourhoods is hot: its windows are
keyed by anchor hash, distance of the anchor and a 128-bit hash of the window's bytes,
and keys held by two windows or more are repeats. Equal windows have equal keys, and
keys are counted before the shuffle, so no task holds a hot anchor.

What is left, different neighbourhoods of any other anchor hash, meets in a task, which
sorts their suffixes and compares bytes. Its string has 8-byte symbols that start at multiples of 8 bytes from
the anchor. The suffix array is built by linear grouping: suffixes are grouped by
their Lyndon prefix, the groups processed in descending order with pointers to the
previous smaller suffix, and each group's order is then emitted from the smaller
suffixes; nothing is renamed or solved recursively. Suffixes with the same first
24 symbols are neighbours there. A window that starts d bytes before a symbol
equals another if both have these 192 bytes and the 8 bytes around them (d before
and 8 - d after) in common, so all eight phases are decided by bytes.

Rows are told apart by id and 64 bits of their text, those without an id by 128 bits of it.
Null text is empty. A window is a repeat wherever it starts again, in the same
document too, overlapping or not. Rows that repeat id and text are documents of
their own, and so repeat each other. Rows without an id are treated like others.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored

WINDOW = 200
SEED_BYTES = 64
SYMBOL = 8
#: Symbols that every phase of a window has in common.
SHARED = WINDOW // SYMBOL - 1
#: Symbols sorted at once, if whole groups allow.
SORTED_AT_ONCE = 1 << 17
#: Different neighbourhoods of an anchor hash that are sorted in one task; windows of more are counted.
HOT = 4096
#: Neighbourhoods whose windows are hashed at once.
WINDOW_PIECES = 256
#: Bytes of a text that are hashed at once; the next part overlaps by a window.
PART = 1 << 20

_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    out = np.full(PART + WINDOW, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_BASE)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64))
_PLACE = np.uint64((1 << 24) - 1)


def _seed_hashes(text: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of every ``SEED_BYTES`` bytes."""
    n = len(text)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _POWERS[:n], out=sums[1:])
    value = (sums[SEED_BYTES:] - sums[:-SEED_BYTES]) * _INVERSE[: n + 1 - SEED_BYTES]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ value >> np.uint64(32)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hash, place, first window and last window of each anchor, part by part."""
    for start in range(0, max(1, len(text) - WINDOW + 1), PART):
        part = np.frombuffer(text, np.uint8, min(PART + WINDOW - 1, len(text) - start), start)
        if len(part) < WINDOW:
            return
        value = _seed_hashes(part)
        ranked = (value & ~_PLACE) | np.arange(len(value), dtype=np.uint64)
        chosen = (_sliding_min(ranked, WINDOW - SEED_BYTES + 1) & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(chosen)) + 1))
        last = np.concatenate((first[1:] - 1, [len(chosen) - 1]))
        place = chosen[first]
        yield value[place].view(np.int64), place + start, first + start, last + start


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, class, key, mark, at``; ``at`` packs first window, anchor's distance and number of windows."""
    for batch in slices(batches):
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for key, mark, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            text = text.encode()
            for value, place, first, last in anchors(text):
                digest = [hashlib.blake2b(text[a:b], digest_size=8).digest()
                          for a, b in zip(first.tolist(), (last + WINDOW).tolist(), strict=True)]
                parts[0].append(value)
                parts[1].append(np.frombuffer(b"".join(digest), np.int64))
                parts[2].append(np.full(len(value), key))
                parts[3].append(np.full(len(value), mark))
                parts[4].append(first << 16 | place - first << 8 | last - first)
        if parts[0]:
            yield pa.record_batch(
                [pa.array(np.concatenate(x)) for x in parts], ["hash", "class", "key", "mark", "at"]
            )


def suffix_array(text: list[int], order: list[int]) -> list[int]:
    """Suffixes in ascending order; ``text`` ends with a smallest symbol of its own, ``order`` sorts its symbols."""
    n = len(text)
    suffixes = list(order)  # grouped, groups ascending
    place = [0] * n  # of each suffix among them
    group = [0] * n  # first place of each suffix's group
    size = [0] * n  # by a group's first place
    start = 0
    for at, suffix in enumerate(suffixes):
        if text[suffix] != text[suffixes[start]]:
            start = at
        place[suffix] = at
        group[suffix] = start
        size[start] += 1
    smaller = [-1] * n  # the previous smaller suffix
    end = n
    while end:
        start = group[suffixes[end - 1]]
        children: dict[int, int] = {}
        for suffix in sorted(suffixes[start:end]) if end - start > 1 else (suffixes[start],):
            before = suffix - 1
            while before >= 0 and group[before] >= start:
                before = smaller[before]
            smaller[suffix] = before
            if before >= 0:
                children[before] = children.get(before, 0) + 1
        end = start
        # Parents with more children of this group have the larger Lyndon prefix.
        by_count: dict[int, list[int]] = {}
        for parent, count in children.items():
            by_count.setdefault(count, []).append(parent)
        for count in sorted(by_count, reverse=True):
            parents = by_count[count]
            for parent in parents:  # to the end of their groups
                first = group[parent]
                size[first] -= 1
                last = first + size[first]
                here, other = place[parent], suffixes[last]
                suffixes[here], suffixes[last] = other, parent
                place[other], place[parent] = here, last
            starts = [group[p] + size[group[p]] for p in parents]
            for parent, first in zip(parents, starts, strict=True):
                group[parent] = first
                size[first] += 1
    ordered = [-1] * n
    ordered[0] = n - 1
    free = list(range(n))  # the next place of each group
    done = bytearray(n)
    done[n - 1] = 1
    for at in range(n):
        suffix = ordered[at] - 1
        while suffix >= 0 and not done[suffix]:
            done[suffix] = 1
            first = group[suffix]
            ordered[free[first]] = suffix
            free[first] += 1
            suffix = smaller[suffix]
    return ordered


def repeated_windows(pieces: list[bytes], distances: list[int], windows: list[int]) -> list[np.ndarray]:
    """Of each piece's windows, which occur again; ``distances`` are those of the anchors from the pieces' starts."""
    pads = [-d % SYMBOL for d in distances]
    padded = [bytes(p) + x + bytes(-(p + len(x)) % SYMBOL) for p, x in zip(pads, pieces, strict=True)]
    raw = np.frombuffer(b"".join(padded), ">u8").astype(np.uint64)
    lengths = np.array([len(x) // SYMBOL for x in padded])
    begins = np.cumsum(lengths) - lengths
    ranks = np.unique(raw, return_inverse=True)[1].astype(np.int64) + 1
    symbols = np.append(ranks, 0)
    order = np.argsort(symbols, kind="stable")
    sorted_suffixes = np.array(suffix_array(symbols.tolist(), order.tolist()))
    first = begins * SYMBOL + np.array(pads)  # first byte of each piece's first window
    count = np.array(windows)
    owner = np.repeat(np.arange(len(pieces)), lengths)
    # Symbols that some window starts at or up to seven bytes before.
    inner = np.arange(len(raw)) * SYMBOL
    wanted = (inner >= first[owner]) & (inner - (SYMBOL - 1) < (first + count)[owner])
    chosen = sorted_suffixes[1:]
    chosen = chosen[wanted[chosen]]
    out = [np.zeros(n, bool) for n in windows]
    if len(chosen) < 2:
        return out
    extended = np.concatenate((symbols, np.full(SHARED + 1, -1)))
    same = np.arange(len(chosen) - 1)
    for step in range(SHARED):
        same = same[extended[chosen[same] + step] == extended[chosen[same + 1] + step]]
    differs = np.ones(len(chosen), bool)
    differs[same + 1] = False
    interval = np.cumsum(differs)
    values = np.concatenate((raw, np.zeros(SHARED + 1, np.uint64)))
    flat = np.zeros(int(count.sum()), bool)
    base = np.cumsum(count) - count
    for before in range(SYMBOL):
        window = chosen * SYMBOL - before - first[owner[chosen]]
        valid = np.flatnonzero((window >= 0) & (window < count[owner[chosen]]))
        if not len(valid):
            continue
        at = chosen[valid]
        rest = values[at + SHARED] >> np.uint64(8 * before)
        if before:
            rest = rest | values[at - 1] << np.uint64(64 - 8 * before)
        by = np.lexsort((rest, interval[valid]))
        twin = (rest[by][1:] == rest[by][:-1]) & (interval[valid][by][1:] == interval[valid][by][:-1])
        hit = np.concatenate((twin, [False])) | np.concatenate(([False], twin))
        found = valid[by[hit]]
        flat[base[owner[chosen[found]]] + window[found]] = True
    return np.split(flat, base[1:])


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hash: ``hash, class, at, piece`` to ``hash, class, bits`` where windows repeat."""

    def judged(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        at = [r[2] for r in rows]
        found = repeated_windows([r[3] for r in rows], [a >> 8 & 255 for a in at], [(a & 255) + 1 for a in at])
        kept = [i for i, x in enumerate(found) if x.any()]
        return pa.record_batch(
            [
                pa.array([rows[i][0] for i in kept], pa.int64()), pa.array([rows[i][1] for i in kept], pa.int64()),
                pa.array([np.packbits(found[i], bitorder="little").tobytes() for i in kept], pa.binary()),
            ],
            ["hash", "class", "bits"],
        )

    held: list[tuple[int, int, int, bytes]] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if size >= SORTED_AT_ONCE * SYMBOL and row[0] != held[-1][0]:
                yield judged(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield judged(held)


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, class, at, piece`` of the wanted anchors of each text."""
    for batch in slices(batches):
        out: list[tuple[int, int, int, bytes]] = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            text = text.encode()
            for w in wanted:
                first = w["at"] >> 16
                out.append((w["hash"], w["class"], w["at"], text[first : first + (w["at"] & 255) + WINDOW]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["hash", "class", "at", "piece"]
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, class, at, piece`` to ``hash, class, number, distance, digest`` of each window."""
    for batch in slices(batches):
        for start in range(0, batch.num_rows, WINDOW_PIECES):
            hashes, classes, numbers, distances, digests = [], [], [], [], []
            for value, kind, at, piece in zip(*(x.to_pylist() for x in batch.slice(start, WINDOW_PIECES).columns), strict=True):
                count = (at & 255) + 1
                hashes += [value] * count
                classes += [kind] * count
                numbers += range(count)
                distances += [(at >> 8 & 255) - i for i in range(count)]
                digests += [hashlib.blake2b(piece[i : i + WINDOW], digest_size=16).digest() for i in range(count)]
            yield pa.record_batch(
                [
                    pa.array(hashes, pa.int64()), pa.array(classes, pa.int64()), pa.array(numbers, pa.int32()),
                    pa.array(distances, pa.int32()), pa.array(digests, pa.binary()),
                ],
                ["hash", "class", "number", "distance", "digest"],
            )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, class, numbers`` to ``hash, class, bits``."""
    for batch in slices(batches):
        bits = []
        for numbers in batch.column(2).to_pylist():
            found = np.zeros(max(numbers) + 1, bool)
            found[numbers] = True
            bits.append(np.packbits(found, bitorder="little").tobytes())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["hash", "class", "bits"])


def _counted_windows(pieces: DataFrame) -> DataFrame:
    """``hash, class, bits`` of the repeated windows of hot anchors, by counts of window keys."""
    windows = pieces.mapInArrow(_windows, "hash bigint, class bigint, number int, distance int, digest binary")
    key = ["hash", "distance", "digest"]
    held = windows.groupBy(*key).count().filter("count > 1").select(*key)
    return (
        windows.join(held, key, "left_semi")
        .groupBy("hash", "class").agg(F.collect_set("number").alias("numbers"))  # at most 137 a class
        .mapInArrow(_packed, "hash bigint, class bigint, bits binary")
    )


def _covered(n: int, marks: list[dict] | None) -> np.ndarray:
    """First and last byte (excluded) of each run covered by repeated windows."""
    edges = np.zeros(n + 1, np.int32)
    for mark in marks or ():
        first, windows = mark["at"] >> 16, (mark["at"] & 255) + 1
        if mark["bits"] is None:
            edges[first] += 1
            edges[first + windows - 1 + WINDOW] -= 1
        else:
            hit = first + np.flatnonzero(np.unpackbits(np.frombuffer(mark["bits"], np.uint8), bitorder="little"))
            np.add.at(edges, hit, 1)
            np.add.at(edges, hit + WINDOW, -1)
    inside = np.concatenate(([0], (np.cumsum(edges)[:n] > 0).view(np.int8), [0]))
    turns = np.flatnonzero(np.diff(inside))
    return turns.reshape(-1, 2)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sizes, removed, shas, spans = [], [], [], []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True):
            text = text.encode()
            runs = _covered(len(text), marks)
            kept, end = hashlib.sha256(), 0
            for a, b in runs.tolist():
                kept.update(text[end:a])
                end = b
            kept.update(text[end:])
            sizes.append(len(text))
            removed.append(int((runs[:, 1] - runs[:, 0]).sum()))
            shas.append(kept.hexdigest())
            spans.append([{"first": a, "last": b} for a, b in runs.tolist()])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.record_batch(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array([len(x) for x in spans], pa.int64()), pa.array(shas), pa.array(spans, kind),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, mark, text, doc_id``; key and mark tell rows of different texts apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col).cast("bigint")
    return docs.select(
        F.coalesce(number, F.xxhash64(text)).alias("key"), F.xxhash64(number.isNull(), text).alias("mark"),
        text.alias("text"), number.alias("doc_id"),
    )


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    ``spans`` are the removed runs as byte offsets, the last one excluded.
    """
    rows = _marked(docs, id_col, text_col)
    found = rows.select("key", "mark", "text").mapInArrow(
        _anchor_rows, "hash bigint, class bigint, key bigint, mark bigint, at bigint"
    )
    shared = found.groupBy("hash").count().filter("count > 1").select("hash")
    kept = stored(found.join(shared, "hash"), "anchors")
    classes = stored(
        kept.groupBy("hash", "class").agg(
            (F.count(F.lit(1)) > 1).alias("whole"), F.min(F.struct("key", "mark", "at")).alias("one")
        ),
        "anchor-classes",
    )
    several = classes.groupBy("hash").count().filter("count > 1").select("hash")
    wanted = (
        classes.join(several, "hash", "left_semi")
        .select(F.col("one.key").alias("key"), F.col("one.mark").alias("mark"),
                F.struct("hash", "class", F.col("one.at").alias("at")).alias("own"))
        .groupBy("key", "mark").agg(F.collect_list("own").alias("wanted"))  # as many as a document has anchors
    )
    pieces = rows.join(wanted, ["key", "mark"]).select("text", "wanted").mapInArrow(
        _neighbourhoods, "hash bigint, class bigint, at bigint, piece binary"
    )
    hot = stored(classes.groupBy("hash").count().filter(F.col("count") > HOT).select("hash"), "hot-anchors")
    sorted_pieces, counted = pieces, None
    if not hot.isEmpty():
        pieces = stored(pieces, "pieces")
        sorted_pieces = pieces.join(hot, "hash", "left_anti")
        counted = _counted_windows(pieces.join(hot, "hash", "left_semi"))
    bits = sorted_pieces.repartition("hash").sortWithinPartitions("hash").mapInArrow(
        _sorted_groups, "hash bigint, class bigint, bits binary"
    )
    if counted is not None:
        bits = bits.unionByName(counted)
    bits = bits.groupBy("hash", "class").agg(F.first("bits").alias("bits"))
    verdicts = (
        classes.select("hash", "class", "whole").join(bits, ["hash", "class"], "left")
        .filter("whole or bits is not null")
        .select("hash", "class", F.when(~F.col("whole"), F.col("bits")).alias("bits"))
    )
    marks = (
        kept.join(verdicts, ["hash", "class"]).select("key", "mark", "at", "bits").distinct()
        .groupBy("key", "mark").agg(F.collect_list(F.struct("at", "bits")).alias("marks"))
    )
    return rows.join(marks, ["key", "mark"], "left").select("doc_id", "text", "marks").mapInArrow(
        _results,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string,"
        " spans array<struct<first: bigint, last: bigint>>",
    )
