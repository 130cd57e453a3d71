import hashlib
import random

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import components, exact, simhash, substrings


def test_exact_against_brute_force(spark, odd_docs):
    docs = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    for keep, choose in (("smallest", min), ("largest", max)):
        got = sorted(map(tuple, exact.exact_duplicates(odd_docs, keep=keep).collect()), key=repr)
        want = []
        for doc, text in docs:
            ids = [d for d, t in docs if t == text]
            known = [d for d in ids if d is not None]
            kept = choose(known) if known else None
            want.append((doc, kept, len(ids), doc == kept, hashlib.sha256(text.encode()).hexdigest()))
        assert got == sorted(want, key=repr)


def test_drop_exact_leaves_one_of_each_text(odd_docs):
    left = exact.drop_exact_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    texts = [r.text or "" for r in left.collect()]
    assert sorted(set(texts)) == sorted({r.text or "" for r in odd_docs.collect()})
    assert texts.count("Repeated row.") == 1


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    links += [(draw.randint(200, 260), draw.randint(200, 260)) for _ in range(40)] + [(5, 5)]
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in linked} and len(got) == len(linked)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("radius", "width"), [(4, 8), (47, 32)])
def test_bit_sliced_comparison_finds_all_pairs(radius, width):
    draw = np.random.default_rng(0)
    prints = draw.integers(0, 256, (20, width), dtype=np.uint8)[draw.integers(0, 20, 400)].copy()
    for row in prints:
        for bit in draw.integers(0, width * 8, draw.integers(0, radius)):
            row[bit // 8] ^= 1 << (bit % 8)
    block = np.sort(draw.integers(0, 5, 400))
    got = {p for a, b in simhash.near_pairs(prints, block, radius) for p in zip(a.tolist(), b.tolist(), strict=True)}
    bits = np.unpackbits(prints, axis=1).astype(int)
    want = {
        (i, j) for i in range(400) for j in range(i + 1, 400)
        if block[i] == block[j] and (bits[i] != bits[j]).sum() <= radius
    }
    assert got == want and want


def _print(text):
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _near_texts():
    draw = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    texts = []
    for _ in range(12):
        base = [draw.choice(words) for _ in range(80)]
        for _ in range(5):
            copy = list(base)
            for _ in range(draw.randint(0, 2)):
                copy[draw.randrange(80)] = draw.choice(words)
            texts.append(" ".join(copy))
    return texts


def _near_groups(texts):
    """Group number of each text by plain comparison of all fingerprints."""
    prints = [_print(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(len(texts)):
                if (prints[i] ^ prints[j]).bit_count() <= 4 and label[i] > label[j]:
                    label[i], changed = label[j], True
    return prints, label


@pytest.mark.parametrize(("tile", "pieces"), [(4096, None), (3, 5), (3, 6), (4096, 7)])
def test_simhash_groups_against_brute_force(spark, odd_docs, monkeypatch, tile, pieces):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = [(100 + i, t) for i, t in enumerate(_near_texts())]
    rows += [(103, rows[20][1]), (103, rows[40][1]), (None, rows[30][1] + " w1")]  # an id on three texts, one without
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows += [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    prints, label = _near_groups([t for _, t in rows])
    smallest = {
        g: min((d for (d, _), x in zip(rows, label, strict=True) if x == g and d is not None), default=None) for g in set(label)
    }
    want = sorted(((rows[i][0], f"{prints[i]:016x}", smallest[label[i]]) for i in range(len(rows))), key=repr)
    got = simhash.near_duplicates(docs, words=4, radius=4, pieces=pieces)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_every_choice_of_pieces_is_a_key():
    for radius, pieces, keys in ((4, 5, 5), (4, 6, 15), (4, 7, 35), (2, 3, 3)):
        chosen = simhash.keys_of(radius, pieces)
        assert len(chosen) == keys
        draw = random.Random(pieces)
        for _ in range(300):
            differ = set(draw.sample(range(64), radius))
            assert any(differ.isdisjoint(key.tolist()) for key in chosen)
    assert [simhash.pieces_for(4, n) for n in (0, 10**6, 10**8, 10**10)] == [5, 5, 6, 7]


def test_drop_near_leaves_the_smallest_id_of_each_group(spark, odd_docs):
    rows = [(100 + i, t) for i, t in enumerate(_near_texts())]
    rows += [(None, rows[30][1]), (103, rows[40][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows += [(r.doc_id, r.text) for r in odd_docs.collect()]
    _, label = _near_groups([t or "" for _, t in rows])
    groups = {}
    for (doc, text), g in zip(rows, label, strict=True):
        groups.setdefault(g, []).append((doc is None, doc, hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    want = sorted((x[1], x[3]) for x in (min(g, key=lambda x: (x[0], x[1] or 0, x[2])) for g in groups.values()) if x[1] is not None)
    got = simhash.drop_near_duplicates(docs).collect()
    assert len(got) == len(groups) and sorted((r.doc_id, r.text or "") for r in got if r.doc_id is not None) == want


def test_suffix_array_against_sorting():
    draw = random.Random(4)
    for _ in range(400):
        text = [draw.randint(1, draw.choice([1, 2, 3, 10])) for _ in range(draw.randint(0, 40))] + [0]
        order = sorted(range(len(text)), key=lambda i: text[i])
        assert substrings.suffix_array(text, order) == sorted(range(len(text)), key=lambda i: text[i:])


def _without_repeats(texts):
    seen = {}
    for text in texts:
        for i in range(len(text) - 199):
            seen[text[i : i + 200]] = seen.get(text[i : i + 200], 0) + 1
    out = []
    for text in texts:
        covered = bytearray(len(text))
        for i in range(len(text) - 199):
            if seen[text[i : i + 200]] > 1:
                covered[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, c in zip(text, covered, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((len(text), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("at_once", [1 << 17, 8])
def test_repeated_strings_against_brute_force(spark, odd_docs, monkeypatch, at_once):
    monkeypatch.setattr(substrings, "SORTED_AT_ONCE", at_once)
    draw = random.Random(5)
    noise = lambda n: "".join(draw.choice("abcdefghij é") for _ in range(n))
    shared = [noise(n) for n in (150, 199, 205, 333, 900)]
    texts = [noise(draw.randint(0, 300)) + draw.choice(shared)[draw.randint(0, 20):] + noise(draw.randint(0, 300))
             + draw.choice(shared) + noise(draw.randint(0, 9)) for _ in range(25)]
    texts += ["z" * 1000, "xy" * 150, "q" * 199, "q" * 200, noise(800)]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    small = odd_docs.filter("doc_id is null or doc_id not in (6, 7)").select("doc_id", "text")
    rows = [(r.doc_id, r.text or "") for r in docs.unionByName(small).collect()]
    want = [(d, *x) for (d, _), x in zip(rows, _without_repeats([t.encode() for _, t in rows]), strict=True)]
    got = substrings.repeated_strings(docs.unionByName(small)).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(n for _, _, n, _, _ in want)


def test_long_texts_are_cut_without_loss(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(substrings, "PART", 512)
    got = {r.doc_id: r for r in substrings.repeated_strings(odd_docs.filter("doc_id in (6, 7)")).collect()}
    assert got[6].n_removed == got[6].n_bytes == got[7].n_removed and got[6].n_spans == 1
    assert got[6].spans == [(0, got[6].n_bytes)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_duplicates(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert substrings.repeated_strings(empty).count() == 0


def test_drop_exact_with_repeated_and_null_ids(spark):
    def left(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(map(tuple, exact.drop_exact_duplicates(frame).collect()), key=repr)

    assert left([(3, "A"), (5, "A"), (5, "B")]) == [(3, "A"), (5, "B")]
    assert left([(5, "A"), (5, "A"), (5, "B")]) == [(5, "A"), (5, "B")]
    assert left([(5, "A"), (7, "A"), (5, "B"), (8, "B")]) == [(5, "A"), (5, "B")]
    assert left([(None, "A"), (3, "A"), (None, "A")]) == [(3, "A")]
    assert left([(None, "A"), (None, "A"), (None, None), (4, "")]) == [(4, ""), (None, "A")]


def test_drop_near_with_repeated_and_null_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(100)) for x in "ab")
    rows = [(3, a), (5, a.replace(" ", "  ")), (5, b), (None, a.upper()), (None, "alone"), (5, b)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, simhash.drop_near_duplicates(frame).collect()), key=repr)
    assert got == sorted([(3, a), (5, b), (None, "alone")], key=repr)


def test_hot_anchors_are_counted_exactly(spark, odd_docs, monkeypatch):
    largest = []
    plain = substrings._counted_windows
    monkeypatch.setattr(substrings, "_counted_windows", lambda pieces: largest.append(1) or plain(pieces))
    monkeypatch.setattr(substrings, "HOT", 3)
    draw = random.Random(9)
    noise = lambda n: "".join(draw.choice("abcdefghij é") for _ in range(n))
    footer, passage = noise(120), noise(400)
    texts = [noise(150) + footer + noise(150) for _ in range(20)]
    texts += [noise(150) + passage + noise(150) for _ in range(12)] + [texts[0][20:] + "x", "z" * 700, noise(500)]
    rows = list(enumerate(texts))
    got = substrings.repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).drop("spans").collect()
    want = [(d, *x) for (d, _), x in zip(rows, _without_repeats([t.encode() for t in texts]), strict=True)]
    assert sorted(map(tuple, got)) == want and largest


def test_few_windows_in_every_phase():
    """One to three windows of each neighbourhood, at every distance of the anchor modulo 8."""
    draw = random.Random(11)
    base = bytes(draw.randrange(97, 123) for _ in range(204))
    for count in (1, 2, 3):
        for distance in range(8, 24):
            pieces = [base[: 199 + count], bytes(reversed(base))[: 199 + count], base[1 : 200 + count]][: max(1, count)]
            distances = [distance, distance, distance - 1][: len(pieces)]
            got = substrings.repeated_windows(pieces, distances, [count] * len(pieces))
            for own, (piece, found) in enumerate(zip(pieces, got, strict=True)):
                others = [(d, x) for i, (d, x) in enumerate(zip(distances, pieces, strict=True)) if i != own]
                # a window of the same distance from the anchor with the same bytes elsewhere
                want = [
                    any(0 <= d - (distances[own] - w) < count and x[d - (distances[own] - w) :][:200] == piece[w : w + 200] for d, x in others)
                    for w in range(count)
                ]
                assert found.tolist() == want
    for _ in range(200):
        pieces = [bytes(draw.choices(b"ab", k=199 + draw.randint(1, 6))) for _ in range(draw.randint(2, 4))]
        substrings.repeated_windows(pieces, [draw.randrange(137) for _ in pieces], [len(x) - 199 for x in pieces])


def test_null_id_rows_do_not_share_marks(spark):
    """Hashes of 32 bits collide among so many texts; those that tell rows apart do not."""
    texts = spark.range(500_000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id) as text")
    assert texts.selectExpr("count(distinct hash(text, true)) as n").first().n < 500_000
    marked = substrings._marked(texts, "doc_id", "text")
    assert marked.select("key", "mark").distinct().count() == 500_000
    a, b = ("".join(random.Random(i).choices("abcdefghij", k=220)) for i in (1, 2))
    rows = [(None, a), (None, b), (4, "x" + b)]
    got = substrings.repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in got) == [(False, 221, 220), (True, 220, 0), (True, 220, 220)]
