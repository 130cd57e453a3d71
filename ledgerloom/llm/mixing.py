"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent between
0 (all sources alike) and 1 (as they are), normalised. The exponent is found by
bisection: the largest whose weights have the target entropy (a fraction of the
highest possible one), raised if needed until no source is repeated more often
than ``max_epochs``. Tokens are runs of other than white space.

The weights are realised within a budget of tokens (by default as many as there
are). A source's quota holds some whole epochs; for the rest its documents stand
in a keyed order of blocks, blocks in groups, and are taken while they fit. Each
position is a sum of three prefix sums (groups, blocks, documents), so no task
holds all documents of a source.

Null text has no tokens. Null is a source of its own. A source without tokens has
weight 0 and is not taken. Rows that repeat id and text share one decision. Rows
without an id are mixed like others. An empty table gives an empty result; other
columns are carried through by ``mixed``. Sources, not documents, are counted on
the driver; more than ``MAX_SOURCES`` are an error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

MAX_SOURCES = 100_000
BLOCK_DOCS = 1024
GROUPS = 1024
SEED = 42


def weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raw = [(x / total) ** exponent if x else 0.0 for x in tokens]
    return [x / sum(raw) for x in raw]


def entropy(shares: list[float]) -> float:
    return -sum(x * math.log(x) for x in shares if x)


def _bisect(holds, steps: int = 60) -> tuple[float, float]:
    """Ends of the last interval in [0, 1] of a condition that holds at 0 and fails at 1."""
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        if holds(middle):
            low = middle
        else:
            high = middle
    return low, high


def exponent(tokens: list[int], budget: float, target_entropy: float, max_epochs: float) -> float:
    """The exponent for sources of so many tokens each; 1 if the limits cannot be met below it."""
    used = [x for x in tokens if x]
    if len(used) < 2:
        return 1.0
    goal = target_entropy * math.log(len(used))
    even = lambda e: entropy(weights(used, e)) >= goal
    wide = 1.0 if even(1.0) else _bisect(even)[0]
    repeated = lambda e: max(w * budget / t for w, t in zip(weights(used, e), used, strict=True)) > max_epochs
    calm = 0.0 if not repeated(0.0) else 1.0 if repeated(1.0) else _bisect(repeated)[1]
    return max(wide, calm)


def mix(
    docs: DataFrame,
    target_entropy: float = 0.95,
    max_epochs: float = 4.0,
    budget: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, source, n_tokens, exponent, weight, position, copies``.

    ``position`` counts the tokens that stand before the document in its source's order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.md5(text).alias("text_hash"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("key"),
            F.regexp_count(text, F.lit(r"\S+")).cast("bigint").alias("n_tokens"),
        ),
        "sizes",
    )
    found = rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    sources = found.orderBy("key").take(MAX_SOURCES + 1)
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    tokens = [r["tokens"] for r in sources]
    whole = sum(tokens) if budget is None else budget
    power = exponent(tokens, whole, target_entropy, max_epochs)
    plan = []
    for row, weight in zip(sources, weights(tokens, power) if any(tokens) else [0.0] * len(tokens), strict=True):
        epochs = math.floor(weight * whole / row["tokens"] + 1e-9) if row["tokens"] else 0
        rest = max(0, round(weight * whole) - epochs * row["tokens"])
        plan.append((row["key"], -(-row["docs"] // BLOCK_DOCS), power, weight, epochs, rest))
    spark = docs.sparkSession
    table = spark.createDataFrame(
        plan, "key string, blocks bigint, exponent double, weight double, epochs bigint, rest bigint"
    )
    placed = (
        rows.join(F.broadcast(table), "key")  # no more than MAX_SOURCES rows
        .withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text_hash"), F.col("blocks")))
        .withColumn("group", F.pmod(F.xxhash64(F.lit(SEED + 1), "key", "block"), F.lit(GROUPS)))
    )
    def before(part: list[str], order: list, size: str) -> Column:
        window = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(window), F.lit(0))

    blocks = placed.groupBy("key", "group", "block").agg(F.sum("n_tokens").alias("size"))
    groups = blocks.groupBy("key", "group").agg(F.sum("size").alias("size"))
    firsts = (
        blocks.withColumn("in_group", before(["key", "group"], [F.xxhash64(F.lit(SEED), "block"), "block"], "size"))
        .join(groups.withColumn("of_group", before(["key"], ["group"], "size")).drop("size"), ["key", "group"])
        .select("key", "block", (F.col("in_group") + F.col("of_group")).alias("first"))
    )
    order = [F.xxhash64(F.lit(SEED + 2), "doc_id", "text_hash"), "doc_id", "text_hash"]
    found = placed.withColumn("in_block", before(["key", "block"], order, "n_tokens")).join(firsts, ["key", "block"])
    position = F.col("first") + F.col("in_block")
    more = (position < F.col("rest")) & (position + F.col("n_tokens") <= F.col("rest"))
    return found.select(
        "doc_id", "text_hash", "source", "n_tokens", "exponent", "weight", position.alias("position"),
        (F.col("epochs") + F.when(more, 1).otherwise(0)).alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (``doc_id, text, source`` and others) with each row as often as its source's weight wants."""
    copies = (
        mix(docs, **options).groupBy("doc_id", "text_hash").agg(F.max("copies").alias("_mix_copies"))
        .filter("_mix_copies > 0")
        .select(F.col("doc_id").alias("_mix_id"), F.col("text_hash").alias("_mix_hash"), "_mix_copies")
    )
    same = docs["doc_id"].eqNullSafe(copies["_mix_id"]) & (
        F.md5(F.coalesce(docs["text"], F.lit(""))) == copies["_mix_hash"]
    )
    many = docs.join(copies, same)
    return many.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_mix_copies"))).select(
        *[F.col(f"`{x}`") for x in docs.columns]
    )
