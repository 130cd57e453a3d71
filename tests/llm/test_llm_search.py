import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerloom.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, top):
    """Every document scored for every item."""
    held = [(d, Counter(words(t))) for d, t in docs if words(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in set(items):
        scores = []
        for doc, count in held:
            m = 100 - 25 + 25 * sum(count.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 12 * m))
                for t in words(text) if count[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort()
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scores[:top], 1)]
    return sorted(rows, key=repr)


def corpus_of(draw, n):
    common, rare = ["the", "of", "And", "él", "a1"], [f"w{i}" for i in range(60)]
    text = lambda: draw.choice([" ", "-", "_", "\n"]).join(
        draw.choices(common, k=draw.randint(0, 12)) + draw.choices(rare, k=draw.randint(0, 8))
    )
    docs = [(i, text()) for i in range(n)]
    items = [(i, " ".join(draw.choices(common + rare, k=draw.randint(1, 14)))) for i in range(12)]
    return docs, items


def test_ranking_against_brute_force(spark, odd_docs, rows):
    draw = random.Random(3)
    docs, items = corpus_of(draw, 300)
    docs += [(d, t) for d, t in docs[:40]] + [(None, docs[7][1]), (None, None), (900, ""), (901, "!?"), (902, "the " * 5000)]
    items += [(3, "another text for item 3, the w1"), (None, "the w2"), (50, None), (51, ""), (52, "absent"), items[0]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'clash' as id", "1 as score")
    for top in (1, 5, 20):
        assert rows(search.search(frame, asked, top)) == brute_force(docs, [x for x in items if x[1]], top)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    queries = [(1, "A first text without an id. repeated"), (2, "word5x5 word6x6 text")]
    got = search.search(odd_docs, spark.createDataFrame(queries, "item_id long, text string"))
    assert rows(got) == brute_force(odd, queries, 20)


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{x} long, text string") for x in ("doc_id", "item_id"))
    one = spark.createDataFrame([(1, "a")], "id long, text string")
    assert search.search(docs, items).count() == 0
    assert search.search(docs, one.withColumnRenamed("id", "item_id")).count() == 0
    assert search.search(one.withColumnRenamed("id", "doc_id"), items).count() == 0


def test_blocks_of_items_and_segments(spark, monkeypatch, rows):
    """More items than a block takes; many segments in a task; pairs of all terms."""
    draw = random.Random(4)
    docs, items = corpus_of(draw, 400)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 5)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows(search.search(frame, asked, 4)) == brute_force(docs, items, 4)
    monkeypatch.setattr(search, "SEGMENT_DOCS", 23)
    monkeypatch.setattr(search, "SEGMENT_POSTINGS", 150)
    monkeypatch.setattr(search, "PAIR_SHARE", 0)
    numbers = {}
    counts = [Counter(numbers.setdefault(t, len(numbers)) for t in search.terms(x)) for _, x in items]
    batch = pa.record_batch([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["id", "text"])
    segments = list(search._indexed(numbers)(iter([batch])))
    assert len(segments) > 15
    held = Counter()
    for part in search._counted(iter(segments)):
        for term, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            held[term] += n
    weights = [math.floor(1000 * math.log((2 * held[-1] + 2) / (2 * held[i] + 1))) for i in range(len(numbers))]
    stats = search.Corpus(held[-1], held[-2], np.array(weights), np.array([held[i] for i in range(len(numbers))]))
    pairs = search.shared_pairs(counts, stats)
    assert len(pairs) > 20
    (found,) = search._ranked(counts, stats, pairs, 4)(iter(segments))
    got = sorted(zip(*(c.to_pylist() for c in found.columns), strict=True))
    want = sorted((i, d, s) for i, _, d, s in brute_force(docs, items, 4))
    assert got == want


def test_pairs_tighten_the_bound():
    """Two terms that never meet in a document are skipped together where their separate maxima would not allow it."""
    lists = {0: range(0, 50), 1: range(50, 100), 2: range(100)}
    docs = [(i, " ".join(f"t{t}" for t, at in lists.items() if i in at)) for i in range(100)]
    numbers = {b"t0": 0, b"t1": 1, b"t2": 2}
    batch = pa.record_batch([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["id", "text"])
    (row,) = search._indexed(numbers)(iter([batch]))
    stats = search.Corpus(100, 200, np.array([500, 500, 10]), np.array([50, 50, 100]))
    with_pairs, without = (search.Segment(row.to_pylist()[0], stats, pairs, 5) for pairs in ([(0, 1)], []))
    at, joint, high, _ = with_pairs.pairs[0, 1]
    assert len(at) == len(joint) == high == 0
    item = Counter({0: 1, 1: 1, 2: 1})
    best = with_pairs.highest[0] + with_pairs.highest[2]
    assert len(search.best_of(with_pairs, item, 5, best + 1)[0]) == 0
    assert sorted(search.best_of(with_pairs, item, 5, best)[1]) == sorted(search.best_of(without, item, 5, best)[1]) == list(range(100))
