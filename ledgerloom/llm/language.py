"""Language prediction by a Bloom filter whose slots hold language bit masks.

Learning counts byte 4-grams of the lower-cased letters per language over all
labelled rows. A language contains a 4-gram that it has at least ``MIN_COUNT``
times and at a frequency of at least ``SHARE`` of the highest of any language.
Each 4-gram sets its languages' bits in ``HASHES`` slots of a table of fixed size,
so one lookup (an AND of slots) gives all languages that contain a 4-gram.

A text's score for a language is the number of its 4-grams whose mask has the
language, less the false positives that the fill of its slice makes likely. The
largest score decides, ties by name. The filter is built by Spark slot by slot;
the driver gets at most one row per slot.

Null texts and texts without a letter are ``und`` with score 0, as is every text
if nothing was learned. Rows are judged one by one: repeated rows agree, and rows
without an id are predicted too. An empty table gives an empty result; other
columns are ignored. At most 63 languages can be learned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored

SLOT_BITS = 20
#: Odd multipliers of the slot hashes.
HASHES = (0x6B43A9B5, 0x52DCE729, 0x38495AB5)
MIN_COUNT = 3
SHARE = 0.5
UNKNOWN = "und"

_LETTERS = np.full(256, 32, np.uint8)  # bytes that are no letters become blanks
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_GAP = b"    "


@dataclass(frozen=True)
class Filter:
    """``slots[i]`` has bit l set if a 4-gram of language l falls into slot i."""

    languages: tuple[str, ...]
    slots: np.ndarray

    def false_positives(self) -> np.ndarray:
        """Per language, the chance that a 4-gram it does not contain is found all the same."""
        return np.array([np.mean(self.slots >> l & 1) for l in range(len(self.languages))]) ** len(HASHES)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-grams of all texts, whether each is one (no two blanks in a row), first of each text."""
    raw = [x.lower().encode() + _GAP for x in texts]
    letters = _LETTERS[np.frombuffer(_GAP[:1] + b"".join(raw), np.uint8)]
    wide = letters.astype(np.uint32)
    value = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    blank = letters == 32
    double = blank[:-1] & blank[1:]
    whole = ~(double[:-2] | double[1:-1] | double[2:])
    first = np.cumsum([0, *map(len, raw)])[:-1]
    return value, whole, first


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, gram, n`` of a partition."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, where = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
        return found, np.bincount(where, np.concatenate([x for _, x in parts])).astype(np.int64)

    for batch in slices(batches):
        texts: dict[str, list[str]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            value, whole, _ = grams(own)
            parts = held.setdefault(lang, [])
            parts.append(np.unique(value[whole], return_counts=True))
            if len(parts) == 8:
                held[lang] = [merged(parts)]
    for lang, parts in held.items():
        found, n = merged(parts)
        yield pa.record_batch(
            [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)],
            ["lang", "gram", "n"],
        )


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filter:
    """The filter of all rows with text and language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    counts = stored(
        rows.mapInArrow(_counted, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").take(64)}
    if len(totals) > 63:
        raise ValueError("more than 63 languages")
    slots = np.zeros(1 << SLOT_BITS, np.uint8 if len(totals) <= 8 else np.uint64)
    if not totals:
        return Filter((), slots)
    bit = F.create_map(*[F.lit(x) for i, l in enumerate(totals) for x in (l, 1 << i)])
    total = F.create_map(*[F.lit(x) for l, n in totals.items() for x in (l, float(n))])
    shares = counts.select(
        "gram", F.struct((F.col("n") / total[F.col("lang")]).alias("share"), "n", bit[F.col("lang")].alias("bit")).alias("own")
    )
    masks = shares.groupBy("gram").agg(F.max("own.share").alias("top"), F.collect_list("own").alias("all"))
    member = lambda x: (x["n"] >= MIN_COUNT) & (x["share"] >= SHARE * F.col("top"))
    mask = F.aggregate(
        "all", F.lit(0).cast("bigint"),
        lambda acc, x: acc.bitwiseOR(F.when(member(x), x["bit"]).otherwise(0).cast("bigint")),
    )
    slot = F.explode(F.array(*[
        F.shiftrightunsigned((F.col("gram") * a).bitwiseAND(0xFFFFFFFF), 32 - SLOT_BITS) for a in HASHES
    ]))
    filled = (
        masks.select("gram", mask.alias("mask")).filter("mask <> 0").select(slot.alias("slot"), "mask")
        .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    )
    slots[filled["slot"].to_numpy()] = filled["mask"].to_numpy().astype(slots.dtype)
    return Filter(tuple(totals), slots)


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def judge(texts: list[str | None], model: Filter) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and share of known 4-grams of each text."""
    value, whole, first = grams([x or "" for x in texts])
    mask = np.full(len(value), np.iinfo(model.slots.dtype).max, model.slots.dtype)
    for a in HASHES:
        mask &= model.slots[(value * np.uint32(a)) >> np.uint32(32 - SLOT_BITS)]
    n = np.add.reduceat(whole, first, dtype=np.int64)
    hits = np.stack([np.add.reduceat(whole & (mask >> l & 1).astype(bool), first, dtype=np.int64)
                     for l in range(len(model.languages))])
    chance = model.false_positives()[:, None]
    own = np.maximum(0, (hits - n * chance) / np.maximum(1e-12, 1 - chance))
    best = own.argmax(axis=0)
    top = own.max(axis=0)
    second = np.sort(own, axis=0)[-2] if len(own) > 1 else np.zeros_like(top)
    score = np.divide(top, top + second, out=np.zeros_like(top), where=top > 0)
    known = np.minimum(1, np.divide(top, n, out=np.zeros_like(top), where=n > 0))
    letters = np.array([x is not None and _has_letter(x) for x in texts])
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
    return names, np.where(letters, score, 0.0), np.where(letters, known, 0.0)


def _judged(model: Filter) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            if model.languages:
                names, score, known = judge(texts, model)
            else:
                names, score, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            kept = [x for x in batch.schema.names if x != "text"]
            yield pa.record_batch(
                [*(batch.column(x) for x in kept), pa.array(names), pa.array(score), pa.array(known)],
                [*kept, "lang_pred", "score", "known"],
            )

    return run


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, known`` of every row; ``known`` is the share of 4-grams found."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(
        _judged(model), "doc_id bigint, held_out boolean, lang_pred string, score double, known double"
    )


def least_known(docs: DataFrame, model: Filter, text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """Per language, half of the share of known 4-grams that all but a thousandth of its rows in ``docs`` exceed.

    Rows count whose label is predicted. A language without such rows has no entry.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    if not model.languages:
        return {}
    judged = rows.mapInArrow(_judged(model), "lang string, lang_pred string, score double, known double")
    low = judged.filter("lang = lang_pred").groupBy("lang").agg(F.percentile_approx("known", 0.001, 10_000).alias("low"))
    return {r["lang"]: r["low"] / 2 for r in low.collect()}  # no more rows than languages


def accepted(
    docs: DataFrame, model: Filter, text_col: str = "text", least: dict[str, float] | None = None
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language.

    With ``least`` (see ``least_known``) a text also needs a known 4-gram and at least that share of
    them for its predicted language. If nothing was learned, every text with a letter stays.
    """
    if not model.languages:
        return docs.filter(F.col(text_col).rlike(r"\p{L}"))
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    fields = rows.select("row").schema.add("lang_pred", "string").add("score", "double").add("known", "double")
    good = F.col("lang_pred") != UNKNOWN
    if least is not None:
        limit = F.lit(0.0)
        for name, share in least.items():
            limit = F.when(F.col("lang_pred") == name, F.lit(share)).otherwise(limit)
        good = good & (F.col("known") > 0) & (F.col("known") >= limit)
    return rows.mapInArrow(_judged(model), fields).filter(good).select("row.*")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the row is kept from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
