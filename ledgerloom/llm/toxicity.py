"""Toxicity scores by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of the embeddings of its hashed forms: the word and its first
4 to 7 bytes. Forms that enough texts hold have one; a hash that is not
theirs has the zero vector, so words never seen add nothing. Filters of several
widths slide over the embeddings of a whole text, the maximum of each filter over the text
is kept, and a logistic unit weighs these maxima. Embeddings start from the forms' log-odds
and random values; all weights are then trained in numpy by gradient descent.

The classifier is fitted on the whole texts of all labelled rows that are not held out. A quarter of them, by a hash
of the text, is kept from the training and calibrates one threshold per language: the logit that
gives the best F1 at the classes' shares among the labels, in the middle of the gap around it.
Logits are counted by steps of 1 / ``STEPS``, so that the driver gets counts instead of rows.
Languages with fewer than ``CALIBRATED`` rows of either class use the threshold of all rows.
Training goes over all other texts several times. Each time, every task descends from the same weights along its
own texts (about ``TASK_ROWS``), and Spark adds up the tasks' moves: a weight moves by the mean of those that moved it,
by how often they did. The driver gets one sum per weight.
A text's language is itself predicted from the text (``language``). Scores are logits moved so that
the language's threshold has a score of 0.3.

Null text counts as empty; a text without words is scored by the empty maxima. Ids with several
labels are toxic if one says so, labels without id or mark are ignored, and so are labels of
no document; of rows that repeat a labelled id one text is used. Without labels of both classes every score is 0. Rows are
scored one by one, whole texts in parts with overlapping windows; rows without an id are scored too.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import language
from ledgerloom.llm.common import slices, stored

#: One of so many parts of the labelled texts calibrates.
PARTS = 4
CALIBRATED = 20
#: Steps of one that logits are counted by, up to a limit that no score tells from larger ones.
STEPS, FAR = 1024, 500
#: Texts that a task trains on, roughly, and weights that are added up together.
TASK_ROWS, BLOCK = 8192, 4096
#: Texts that must hold a form, and the number of forms with an embedding.
HELD, FORMS = 4, 60_000
SLOT_BITS = 20
DIMS, WIDTHS, FILTERS = 16, (1, 2, 3), 8
EPOCHS, BATCH, RATE, SHRINK = 6, 16, 0.05, 1e-4
#: Texts that the epochs go over in all, if ``LEAST_EPOCHS`` do not go over more.
TRAINED, LEAST_EPOCHS = 36_000, 3
SEED = 42
#: Characters of a text that are scored at once.
PART = 1 << 20
#: The score at a language's threshold.
LIMIT = 0.3

_PREFIXES = (4, 5, 6, 7)
_KINDS = 1 + len(_PREFIXES)
_PAD = max(WIDTHS)
#: ASCII letters, digits and the bytes of all other characters make words.
_FOLDED = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ value >> np.uint64(29)


def forms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word's forms, a row per word, and the number of words of each text."""
    raw = [x.lower().encode().translate(_FOLDED) + b" " for x in texts]
    sizes = np.array([len(x) for x in raw], np.int64)
    letters = np.frombuffer(b" " * 8 + b"".join(raw) + b" " * 16, np.uint8)
    inside = letters != 32
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begins, ends = turns[::2], turns[1::2]
    wide = np.lib.stride_tricks.sliding_window_view(letters, 8)
    eight = lambda at: np.ascontiguousarray(wide[at]).view("<u8").ravel()
    length = ends - begins
    cut = lambda value, n: value & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * (8 - np.clip(n, 1, 8))).astype(np.uint64))
    head = cut(eight(begins), length)
    middle = np.where(length > 8, cut(eight(begins + 8 * (length > 8)), length - 8), np.uint64(0))
    tail = eight(ends - 8) * (length > 16).astype(np.uint64)
    whole = head * _ODD[0] ^ _mixed(middle * _ODD[1]) ^ _mixed(tail * _ODD[2] + length.astype(np.uint64))
    keys = [whole] + [(cut(head, np.full(len(head), k)) + np.uint64(k)) * _ODD[3] for k in _PREFIXES]
    counts = np.diff(np.searchsorted(begins, 8 + np.concatenate(([0], np.cumsum(sizes)))))
    return np.stack([_mixed(x) for x in keys], axis=1), counts


@dataclass
class Classifier:
    """Embeddings of known forms and the weights; row 0 is the zero vector of all other forms."""

    hashes: np.ndarray
    slots: np.ndarray
    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[str | None, float]

    def rows(self, keys: np.ndarray) -> np.ndarray:
        row = self.slots[keys >> np.uint64(64 - SLOT_BITS)]
        return np.where(self.hashes[row] == keys, row, 0)

    def maxima(self, rows: np.ndarray, counts: np.ndarray, goes_on: np.ndarray | None = None) -> np.ndarray:
        """Largest response of each filter over each text, a window of no words included.

        Of a text that goes on in another part, only windows without an end count.
        """
        first = np.cumsum(counts + _PAD) - (counts + _PAD)
        at = np.arange(len(rows)) + _PAD * np.repeat(np.arange(len(counts)), counts)
        words = np.zeros((len(rows) + _PAD * len(counts) + _PAD, DIMS), np.float32)
        words[at] = self.embeddings[rows[:, 0]]
        for kind in range(1, _KINDS):
            words[at] += self.embeddings[rows[:, kind]]
        n = len(words) - _PAD
        across = (first + counts)[:, None] + np.arange(1, _PAD)  # windows that reach into the next text
        out = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            found = sum(words[j : j + n] @ weights[j * DIMS : (j + 1) * DIMS] for j in range(width))
            found[across.ravel()] = -np.inf
            if goes_on is not None:
                open_ends = (first + counts)[goes_on][:, None] - np.arange(width)
                found[np.maximum(open_ends, first[goes_on][:, None]).ravel()] = -np.inf
            out.append(np.maximum.reduceat(found, first, axis=0))
        return np.concatenate(out, axis=1)

    def peaks(self, own: np.ndarray, goes_on: bool = False) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Each filter's largest response to a text given by its forms' rows; per width the windows' rows and their embeddings."""
        words = np.zeros((len(own) + _PAD, DIMS), np.float32)
        words[: len(own)] = self.embeddings[own].sum(axis=1)
        padded = np.concatenate((own, np.zeros((_PAD, _KINDS), own.dtype)))
        n = len(own) + 1
        best, places, windows = [], [], []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            window = np.concatenate([words[j : j + n] for j in range(width)], axis=1)
            found = window @ weights
            if goes_on:
                found[max(0, n - width) :] = -np.inf
            at = found.argmax(axis=0)
            best.append(found[at, np.arange(FILTERS)])
            places.append(padded[at[:, None] + np.arange(width)])
            windows.append(window[at])
        return np.concatenate(best), places, windows

    def gist(self, text: str) -> np.ndarray:
        """The rows of a text's forms; of a text in several parts only the strongest window of each filter, with gaps between."""
        if len(text) <= PART:
            return self.rows(forms([text])[0])
        best, kept = np.full(len(self.biases), -np.inf), [np.zeros((0, _KINDS), np.int64)] * len(self.biases)
        pieces = parts(text)
        piece = next(pieces, None)
        while piece is not None:
            after = next(pieces, None)
            found, places, _ = self.peaks(self.rows(forms([piece])[0]), after is not None)
            windows = [x for own in places for x in own]
            for i in np.flatnonzero(found > best):
                best[i], kept[i] = found[i], windows[i]
            piece = after
        gap = np.zeros((_PAD, _KINDS), np.int64)
        return np.concatenate([x for own in kept for x in (own, gap)])

    def logits(self, texts: list[str]) -> np.ndarray:
        pieces, owners = [], []
        for i, text in enumerate(texts):
            for piece in parts(text):
                pieces.append(piece)
                owners.append(i)
        keys, counts = forms(pieces)
        best = self.maxima(self.rows(keys), counts, np.diff(owners, append=-1) == 0)
        first = np.flatnonzero(np.diff(owners, prepend=-1))
        best = np.maximum.reduceat(best, first, axis=0)
        return np.maximum(best + self.biases, 0) @ self.weights + self.offset

    def scores(self, texts: list[str], languages: list[str]) -> np.ndarray:
        limits = np.array([self.thresholds.get(x, self.thresholds[None]) for x in languages])
        moved = self.logits(texts) - limits + np.log(LIMIT / (1 - LIMIT))
        return 1 / (1 + np.exp(-np.clip(moved, -500, 500)))


def parts(text: str) -> Iterator[str]:
    """A text in parts that share the words of the widest window but one; words longer than a part are cut."""
    start = 0
    while len(text) - start > PART:
        end = text.rfind(" ", start + 1, start + PART)
        end = start + PART if end < 0 else end
        yield text[start:end]
        back = max(start, end - PART // 2)
        again = [m.start() for m in _WORD.finditer(text, back, end)][1 - _PAD :]
        start = again[0] if again and back < again[0] else end
    yield text[start:]


def begun(hashes: np.ndarray, bad: np.ndarray, good: np.ndarray, share: tuple[int, int]) -> Classifier:
    """An untrained classifier with the given forms, most telling first, and the toxic and clean texts that hold each.

    ``share`` is the number of clean and of toxic texts.
    """
    draw = np.random.default_rng(SEED)
    odds = np.log((bad + 0.5) / (share[1] + 1)) - np.log((good + 0.5) / (share[0] + 1))
    slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    own = np.sort(np.unique(slot, return_index=True)[1])  # one form a slot, the most telling one
    slots = np.zeros(1 << SLOT_BITS, np.int32)
    slots[slot[own]] = np.arange(1, len(own) + 1)
    embeddings = np.zeros((len(own) + 1, DIMS), np.float32)
    embeddings[1:] = draw.normal(0, 0.02, (len(own), DIMS))
    embeddings[1:, 0] += np.clip(odds[own] / 8, -1, 1)
    filters = [draw.normal(0, 0.3, (w * DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for weights in filters:  # one filter of each width begins with the log-odds
        weights[:, 0] *= 0.1
        weights[::DIMS, 0] += 1
    biases = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    weights = draw.normal(0, 0.1, len(biases)).astype(np.float32)
    weights[::FILTERS] += 1
    return Classifier(
        np.concatenate((np.zeros(1, np.uint64), hashes[own])), slots, embeddings, filters, biases, weights, 0.0, {None: 0.0}
    )


@dataclass
class Past:
    """Sums of the squared steps so far, which set the size of the next ones, and how often each embedding moved."""

    rows: np.ndarray
    dense: list[np.ndarray]
    offset: float
    moved: np.ndarray

    @classmethod
    def of(cls, net: Classifier) -> Past:
        n = len(net.embeddings)
        dense = [np.full(x.shape, 0.1, np.float32) for x in (*net.filters, net.biases, net.weights)]
        return cls(np.full(n, 0.01, np.float32), dense, 0.1, np.zeros(n, np.float32))


def train(
    net: Classifier, rows: list[np.ndarray], toxic: np.ndarray, *,
    epochs: int = EPOCHS, past: Past | None = None, balance: list[float] | None = None, seed: int = SEED,
) -> None:
    """Gradient descent with step sizes by past gradients over texts given by their forms' rows.

    Both classes weigh alike among these texts, or by ``balance``; ``past`` goes on from earlier texts.
    """
    draw = np.random.default_rng(seed)
    past = past or Past.of(net)
    dense = [*net.filters, net.biases, net.weights]
    balance = balance or [len(rows) / (2 * max(1, int((toxic == x).sum()))) for x in (0, 1)]
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            steps = [np.zeros(x.shape, np.float32) for x in dense]
            step_offset, touched, moves = 0.0, [], []
            for i in order[start : start + BATCH].tolist():
                z, places, windows = net.peaks(rows[i])
                z = z + net.biases
                h = np.maximum(z, 0)
                wrong = 1 / (1 + np.exp(-np.clip(h @ net.weights + net.offset, -50, 50))) - toxic[i]
                wrong *= balance[int(toxic[i])] / BATCH
                steps[-1] += wrong * h
                step_offset += wrong
                dz = wrong * net.weights * (z > 0)
                steps[-2] += dz
                for k, width in enumerate(WIDTHS):
                    d = dz[k * FILTERS : (k + 1) * FILTERS]
                    steps[k] += (windows[k] * d[:, None]).T
                    move = (d[:, None] * net.filters[k].T).reshape(FILTERS * width, DIMS)
                    touched.append(places[k].reshape(-1, _KINDS))
                    moves.append(np.repeat(move[:, None], _KINDS, axis=1))
            which, at = np.unique(np.concatenate([x.ravel() for x in touched]), return_inverse=True)
            move = np.zeros((len(which), DIMS), np.float32)
            np.add.at(move, at, np.concatenate([x.reshape(-1, DIMS) for x in moves]))
            move[which == 0] = 0  # unknown forms stay at zero
            past.rows[which] += (move**2).mean(axis=1)
            past.moved[which] += 1
            net.embeddings[which] -= RATE * move / np.sqrt(past.rows[which])[:, None] + RATE * SHRINK * net.embeddings[which]
            for x, step, old in zip(dense, steps, past.dense, strict=True):
                old += step**2
                x -= RATE * step / np.sqrt(old)
            past.offset += step_offset**2
            net.offset -= RATE * step_offset / np.sqrt(past.offset)


def _state(net: Classifier, past: Past) -> np.ndarray:
    """All weights and their past in rows of one width: those of the embeddings, then all others."""
    own = np.concatenate((net.embeddings, past.rows[:, None]), axis=1)
    others = [x.ravel() for x in (*net.filters, net.biases, net.weights, *past.dense)]
    flat = np.concatenate([*others, [net.offset, past.offset]]).astype(np.float32)
    return np.concatenate((own, np.pad(flat, (0, -len(flat) % own.shape[1])).reshape(-1, own.shape[1])))


def _restore(net: Classifier, past: Past, state: np.ndarray) -> None:
    n = len(net.embeddings)
    net.embeddings[:], past.rows[:] = state[:n, :DIMS], state[:n, DIMS]
    flat, at = state[n:].ravel(), 0
    for x in (*net.filters, net.biases, net.weights, *past.dense):
        x[...] = flat[at : at + x.size].reshape(x.shape)
        at += x.size
    net.offset, past.offset = float(flat[at]), float(flat[at + 1])


def _descended(net: Classifier, past: Past, balance: list[float], seed: int) -> Callable:
    """``text, toxic`` to the moves of the weights along a task's texts, each times how often it was moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, old = copy.deepcopy((net, past))
        begin, n = _state(own, old), 0
        for batch in slices(batches):
            rows = [own.gist(x) for x in batch.column("text").to_pylist()]
            train(own, rows, batch.column("toxic").to_numpy(), epochs=1, past=old, balance=balance, seed=seed + n)
            n += len(rows)
        if not n:
            return
        times = np.concatenate((old.moved, np.full(len(begin) - len(old.moved), n, np.float32)))
        moves = (_state(own, old) - begin) * times[:, None]
        task = TaskContext.get().partitionId()
        for block in range(-(-len(begin) // BLOCK)):
            at = block * BLOCK + np.flatnonzero(times[block * BLOCK : (block + 1) * BLOCK])
            yield pa.record_batch(
                [pa.array([block], pa.int32()), pa.array([task], pa.int32()),
                 *(pa.array([x.tobytes()]) for x in (at.astype(np.int32), times[at], moves[at]))],
                ["block", "task", "rows", "times", "moves"],
            )

    return run


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, rows, times, moves`` of all tasks to ``rows, moves``: the mean move of each row; holds no more than all weights."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, rows, times, moves in zip(*(batch.column(x).to_pylist() for x in ("block", "rows", "times", "moves")), strict=True):
            own = held.setdefault(block, np.zeros((BLOCK, DIMS + 2)))
            at = np.frombuffer(rows, np.int32) - block * BLOCK
            own[at, 0] += np.frombuffer(times, np.float32)
            own[at, 1:] += np.frombuffer(moves, np.float32).reshape(-1, DIMS + 1)
    for block, own in held.items():
        at = np.flatnonzero(own[:, 0])
        mean = (own[at, 1:] / own[at, :1]).astype(np.float32)
        yield pa.record_batch(
            [pa.array([x.tobytes()]) for x in ((at + block * BLOCK).astype(np.int32), mean)], ["rows", "moves"]
        )


def fit(net: Classifier, training: DataFrame, share: tuple[int, int]) -> None:
    """Train on all rows of ``training(text, toxic)``; ``share`` is the number of clean and of toxic texts."""
    n = sum(share)
    past, balance = Past.of(net), [n / (2 * max(1, x)) for x in share]
    training = training.select("text", "toxic").coalesce(-(-n // TASK_ROWS))
    for epoch in range(max(LEAST_EPOCHS, min(EPOCHS, -(-TRAINED // n)))):
        moves = training.mapInArrow(
            _descended(net, past, balance, SEED + epoch), "block int, task int, rows binary, times binary, moves binary"
        )
        means = moves.repartition("block").sortWithinPartitions("block", "task").mapInArrow(_means, "rows binary, moves binary")
        state = _state(net, past)
        for row in means.toArrow().to_pylist():
            state[np.frombuffer(row["rows"], np.int32)] += np.frombuffer(row["moves"], np.float32).reshape(-1, DIMS + 1)
        _restore(net, past, state)


def threshold(logits: np.ndarray, toxic: np.ndarray, weight: float, times: np.ndarray | int = 1) -> float:
    """The logit with the best F1 if each clean row stands for ``weight`` rows; in the widest of equally good gaps.

    Each logit counts ``times``.
    """
    order = np.argsort(-logits, kind="stable")
    z, bad = logits[order], toxic[order].astype(float)
    times = np.broadcast_to(times, len(z))[order]
    hit, false = np.cumsum(bad * times), np.cumsum((1 - bad) * times) * weight
    f1 = 2 * hit / np.maximum(1e-12, hit + false + hit[-1])
    gap = np.append(z[:-1] - z[1:], 2.0)
    f1[:-1][gap[:-1] <= 0] = -1  # equal logits are not parted
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = best[gap[best].argmax()]
    return float(z[at] - gap[at] / 2)


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """``key, text, toxic, calibrates`` of the labelled texts not held out, copies once, and the labelled rows of each class.

    Copies are found by their hashes, so that texts are shuffled once; rows come in the order of the hash.
    """
    marks = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    marks = marks.filter("id is not null and toxic is not null").groupBy("id").agg(F.max(F.col("toxic").cast("boolean")).cast("int").alias("toxic"))
    marks = marks.filter(~held_out("id"))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.filter(~held_out("id")).select("id", "text", F.xxhash64("text").alias("key"))
    one = texts.select("id", "key").join(marks, "id").groupBy("id", "toxic").agg(F.min("key").alias("key"))
    one = one.groupBy("key").agg(F.max("toxic").alias("toxic"), F.min("id").alias("id"))
    met = texts.join(one, ["id", "key"]).groupBy("id", "key", "toxic").agg(F.min("text").alias("text"))
    calibrates = F.pmod("key", F.lit(PARTS)) == 0
    return met.sortWithinPartitions("key").select("key", "text", "toxic", calibrates.alias("calibrates")), sizes


def _form_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text, toxic`` to ``form, bad, good``: the texts of a slice that hold each form."""
    for batch in slices(batches):
        keys, counts = forms(batch.column("text").to_pylist())
        toxic = batch.column("toxic").to_numpy().astype(bool)
        held = [np.unique(x) for x in np.split(keys, np.cumsum(counts)[:-1])]
        form, where = np.unique(np.concatenate(held), return_inverse=True)
        of = np.repeat(toxic, [len(x) for x in held])
        n = [np.bincount(where[x], minlength=len(form)).astype(np.int32) for x in (of, ~of)]
        yield pa.record_batch([pa.array(form.view(np.int64)), *map(pa.array, n)], ["form", "bad", "good"])


def _telling(training: DataFrame, share: tuple[int, int]) -> pa.Table:
    """The ``FORMS`` forms that tell most of those that enough texts hold: ``form, bad, good``."""
    counts = training.select("text", "toxic").mapInArrow(_form_counts, "form bigint, bad int, good int")
    counts = counts.groupBy("form").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (share[1] + 1)) - F.log((F.col("good") + 0.5) / (share[0] + 1))
    held = F.col("bad") + F.col("good")
    return counts.filter(held >= HELD).orderBy(F.desc(F.abs(odds) * F.sqrt(held)), "form").limit(FORMS).toArrow()


def _names(texts: list[str], languages: language.Filter) -> list[str]:
    return language.judge(texts, languages)[0] if languages.languages else [language.UNKNOWN] * len(texts)


def calibrate(net: Classifier, rows: DataFrame, languages: language.Filter, share: float) -> None:
    """Thresholds from all rows of ``rows(text, toxic)``; ``share`` is the number of clean rows for each toxic one."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            place = np.rint(np.clip(net.logits(texts), -FAR, FAR) * STEPS).astype(np.int32)
            yield pa.record_batch([pa.array(_names(texts, languages)), batch.column("toxic"), pa.array(place)], ["lang", "toxic", "place"])

    counts = rows.select("text", "toxic").mapInArrow(placed, "lang string, toxic int, place int").groupBy("lang", "toxic", "place").count()
    table = counts.toPandas().sort_values(["lang", "place", "toxic"])
    lang, toxic, place, times = (table[x].to_numpy() for x in ("lang", "toxic", "place", "count"))
    if set(toxic) != {0, 1}:
        return
    weight = share / (times[toxic == 0].sum() / times[toxic == 1].sum())
    for name in [None, *sorted(set(lang))]:
        own = np.ones(len(lang), bool) if name is None else lang == name
        if name is None or min(times[own & (toxic == x)].sum() for x in (0, 1)) >= CALIBRATED:
            net.thresholds[name] = threshold(place[own] / STEPS, toxic[own], weight, times[own])


def learn(
    docs: DataFrame, labels: DataFrame, languages: language.Filter,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Classifier | None:
    """The classifier of all labelled rows that are not held out; None without both classes."""
    rows, sizes = _labelled(docs, labels, id_col, text_col, label_col)
    rows = stored(rows, "labelled-texts")
    training = rows.filter("not calibrates")
    share = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    if set(share) != {0, 1}:
        return None
    share = share[0], share[1]
    found = _telling(training, share)
    net = begun(*(found[x].to_numpy() if x != "form" else found[x].to_numpy().view(np.uint64) for x in ("form", "bad", "good")), share)
    fit(net, training, share)
    calibrate(net, rows.filter("calibrates"), languages, sizes[0] / sizes[1])
    return net


def _scored(net: Classifier | None, languages: language.Filter) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            names = _names(texts, languages)
            score = np.zeros(len(texts)) if net is None else net.scores(texts, names).astype(np.float64)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= LIMIT).astype(np.int32)), pa.array(names)],
                ["doc_id", "held_out", "score", "predicted", "lang_pred"],
            )

    return run


def score(
    docs: DataFrame, net: Classifier | None, languages: language.Filter, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted, lang_pred`` of every row."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        _scored(net, languages), "doc_id bigint, held_out boolean, score double, predicted int, lang_pred string"
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the row's labels are kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
