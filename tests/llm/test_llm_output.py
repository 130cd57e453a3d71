import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import mixing, packing, token_files, tokens, vectors

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_remembered_words_change_no_id(path):
    draw = random.Random(1)
    parts = ["a", "B", "é", "é", " ", "  ", "   ", "\n", "\t", "\r\n", "\xa0", "\x1c", "\x85", "'s", "'ll", "12", ".", ",", "?!",
             "<|endoftext|>", "<|ENDoftext|>", "<|startoftext|>", "$$$", "x.!?", "—", "_-", "你好", "😀", "İ", "Σ", "ß", "\0", "_", "Word", "ﬁ", "٣", "́", "a.", "क़,"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(6000)]
    plain = Tokenizer.from_file(path)
    want = [np.array(x.ids, "<u4").tobytes() for x in plain.encode_batch(texts, add_special_tokens=False)]
    encoder = tokens.Encoder(path)
    assert encoder.encode(texts) == want and encoder.encode(texts[::-1]) == want[::-1]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_of_any_sign_have_the_librarys_ids(path, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 1000)
    signs = [chr(x) for x in (*range(33, 0x600), *range(0x1E00, 0x2000), *range(0x2126, 0x2130), 0x3042, 0xAC00, 0xFB01)]
    texts = [form.format(x) for x in signs for form in ("a {0}x{0} b", "a x{0}, b {0}", "{0}\nx{0}")]
    plain = Tokenizer.from_file(path)
    want = [np.array(x.ids, "<u4").tobytes() for x in plain.encode_batch(texts, add_special_tokens=False)]
    encoder = tokens.Encoder(path)
    assert encoder.known.unit is not None
    assert encoder.encode(texts) == want and encoder.encode(texts[::-1]) == want[::-1]
    assert len(encoder.known) + len(encoder.known.before) <= 1100


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_are_remembered_without_the_signs_that_close_them(path):
    texts = ["Word word, word. (word) word!\nWord word?!", "", "x\0y", "<|endoftext|> word", "été. ünter, word..."]
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path, 100)
    want = [np.array(plain.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert encoder.encode(texts) == want and encoder.encode(texts[2:4]) == want[2:4] and encoder.encode([]) == []
    held = [x.decode() for x in encoder.known]
    assert " word" in held and "été" in held
    assert not [x for x in held if x.strip("!?.,") != x and x.strip("!?.,").isalpha()]
    assert encoder.known._model_unit("word") == "word"
    many = [f"word{x} and{x}." for x in map(chr, range(0x250, 0x4F0))]
    assert encoder.encode(many) == [np.array(plain.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in many]
    assert len(encoder.known) + len(encoder.known.before) <= 104


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_names_of_added_tokens_are_those_tokens(path):
    plain = Tokenizer.from_file(path)
    for name in [x.content for x in plain.get_added_tokens_decoder().values()] + ["<|startoftext|>"]:
        texts = [name, f"a {name} b", f"{name} b", f"a {name}", name * 2, f"wo{name}rd", f"a {name.upper()} b", f"a <{name[2:]}"]
        want = [np.array(plain.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
        assert tokens.Encoder(path).encode(texts) == want


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, odd_docs, tmp_path):
    path = f"file://{tmp_path}/tokens"
    token_files.write(odd_docs, path, BYTES)
    back = {}
    for row in token_files.read(spark, path).collect():
        back.setdefault(row.doc_id, []).append(row.ids)
    for row in odd_docs.collect():
        assert ids_of(BYTES, row.text) in back[row.doc_id]
    assert [r.doc_id for r in token_files.read(spark, path, 4, 5).orderBy("doc_id").collect()] == [4, 5]
    total, order = 0, sorted(token_files.layout(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    for row in order:
        assert row.start == total and row.ids_crc32 in [crc(x) for x in back[row.doc_id]]
        total += row.n_tokens
    token_files.write(odd_docs.limit(0), f"{path}-empty", BYTES)
    assert token_files.layout(spark, f"{path}-empty").count() == 0


def test_bloom_filters_and_row_indexes_are_written(spark, odd_docs, tmp_path):
    token_files.write(odd_docs, f"file://{tmp_path}/t", BYTES)
    plan = token_files.read(spark, f"file://{tmp_path}/t", 4, 4)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,4)" in plan


def packed_rows(packed):
    rows = packed.collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return rows, len(by)


def test_packing_of_odd_documents(spark, odd_docs):
    rows, _ = packed_rows(packing.pack(odd_docs, WORDS))
    want = []
    for row in odd_docs.collect():
        ids = ids_of(WORDS, row.text)
        want += [(row.doc_id, n, a, len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for n, a in enumerate(range(0, len(ids), 2048))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert packing.pack(odd_docs.limit(0), WORDS).count() == 0


def anonymous_mb():
    with open("/proc/self/smaps_rollup") as f:
        return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) / 1024


def test_pieces_leave_no_unused_arrow_memory_to_the_worker():
    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(200_000)}" for _ in range(500)) for _ in range(1500)]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    assert len(list(packing._cut(WORDS, 2048, False)(iter([batch])))) > 1
    held = anonymous_mb()
    pa.default_memory_pool().release_unused()
    assert held - anonymous_mb() < 8


def test_sequences_hold_the_ids(spark, odd_docs):
    docs = odd_docs.filter("doc_id < 9")
    packed = packing.pack(docs, WORDS)
    ids = {r.sequence_id: r.ids for r in packing.sequences(docs, packed, WORDS).collect()}
    for r in packed.collect():
        assert crc(ids[r.sequence_id][r.offset : r.offset + r.length]) == r.ids_crc32


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_piece_once_and_packs_tightly(seed):
    draw = np.random.default_rng(seed)
    capacity = [64, 100, 2048][seed % 3]
    counts = np.zeros(capacity + 1, int)
    for length in np.minimum(capacity, draw.lognormal(np.log(capacity / 6), 1, 5000).astype(int) + 1):
        counts[length] += 1
    counts[capacity // 3] += [0, 4000][seed % 2]  # one length with nearly half of all pieces
    plan = packing.plan(counts, capacity)
    used = np.zeros(capacity + 1, int)
    for pattern, times in plan:
        assert sum(pattern) <= capacity and times > 0
        np.add.at(used, list(pattern), times)
    assert (used == counts).all()
    bound = -(-(counts * np.arange(capacity + 1)).sum() // capacity)
    assert sum(t for _, t in plan) <= 1.01 * bound + 1


def test_exponent_meets_its_limits():
    sizes = [1000, 100, 10, 1]
    for target in (0.3, 0.6, 0.9):
        e = mixing.exponent(sizes, sum(sizes), target, 1e9)
        assert mixing.entropy(mixing.weights(sizes, e)) == pytest.approx(target * np.log(4), abs=1e-6)
    e = mixing.exponent(sizes, sum(sizes), 0.9, 4.0)
    assert max(w * sum(sizes) / t for w, t in zip(mixing.weights(sizes, e), sizes, strict=True)) == pytest.approx(4.0, abs=1e-6)
    assert mixing.exponent([5, 0], 5, 0.9, 4.0) == 1.0 and mixing.weights([5, 0], 0.5) == [1.0, 0.0]


def test_mixing_meets_the_weights(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "big" if i < 3000 else f"small{i % 3}") for i in range(3600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    decided = mixing.mix(docs, target_entropy=0.9).collect()
    total = sum(r.n_tokens for r in decided)
    for source in {r.source for r in decided}:
        own = [r for r in decided if r.source == source]
        taken = sum(r.n_tokens * r.copies for r in own)
        assert 0 <= own[0].weight * total - taken < 8 and max(r.copies for r in own) - min(r.copies for r in own) <= 1
        places = sorted((r.position, r.n_tokens) for r in own)
        assert all(a + n == b for (a, n), (b, _) in zip(places[:-1], places[1:], strict=True))
    mixed = mixing.mixed(docs, target_entropy=0.9)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in decided)
    again = {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(7), target_entropy=0.9).collect()}
    assert again == {(r.doc_id, r.copies) for r in decided}


def test_mixing_of_odd_rows(odd_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r.source for r in got} == {"a", "b", "c", None}
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.mix(odd_docs.limit(0)).count() == 0 and mixing.mixed(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [1024, 5])
def test_vectors_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    draw = np.random.default_rng(7)
    centres = draw.standard_normal((12, 64))
    rows = []
    for i in range(240):
        v = centres[i % 12] + draw.standard_normal(64) * draw.choice([0.05, 0.15, 0.3])
        rows.append((i, v.astype(np.float32).tolist(), i % 12 // 6))
    rows += [(300 + i, rows[0][1], 0) for i in range(20)]  # copies
    rows += [(400, None, 0), (401, [0.0] * 64, 0), (402, [None] + [1.0] * 63, 0), (403, [float("nan")] * 64, 0),
             (404, [float("inf")] + [1.0] * 63, 0), (405, rows[0][1], None), (406, [], 1), (407, [-0.0, 1.0], 1), (408, [0.0, 2.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as id", "'y' as node")
    usable = [(i, np.array(v, float) / np.linalg.norm(v), label) for i, v, label in rows if i < 400 or i > 406]
    near = {i: {j for j, w, m in usable if j != i and m == label and len(w) == len(v) and v @ w >= 0.93} for i, v, label in usable}
    low = {i: i for i, _, _ in rows}
    for _ in rows:
        for i, js in near.items():
            low[i] = min([low[i], *(low[j] for j in js)])
    want = sorted((i, len(near.get(i, ())), low[i], low[i] == i) for i, _, _ in rows)
    got = sorted(map(tuple, vectors.near_duplicates(frame).collect()))
    assert got == want and sum(n for _, n, _, _ in want)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_filters_find_pairs_at_the_threshold():
    draw = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(draw.standard_normal((1000, 64)))
    other = draw.standard_normal((1000, 64))
    other = unit(other - (other * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * other
    sets = []
    for x in (a, b):
        row, number = vectors.Caps().decode(x)
        sets.append([set(number[row == i].tolist()) for i in range(1000)])
    assert np.mean([not x.isdisjoint(y) for x, y in zip(*sets, strict=True)]) >= 0.99


def test_vectors_with_repeated_and_null_ids(spark):
    draw = np.random.default_rng(9)
    axes = np.eye(64)
    near = lambda i: (axes[i] + 0.02 * draw.standard_normal(64) / 8)
    rows = [(5, axes[0]), (5, axes[1]), (9, near(0)), (3, near(1)), (None, near(2)), (7, axes[2]), (None, axes[3]),
            (None, near(3)), (None, axes[4]), (None, axes[4]), (8, axes[5]), (8, axes[5]), (6, axes[6]), (6, -axes[6])]
    frame = spark.createDataFrame([(i, v.astype(np.float32).tolist(), 1) for i, v in rows], "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, vectors.near_duplicates(frame).collect()), key=repr)
    assert got == sorted([
        (5, 1, 5, True), (9, 1, 5, False), (5, 1, 3, False), (3, 1, 3, True), (None, 1, 7, False), (7, 1, 7, True),
        (None, 1, None, True), (None, 1, None, True), (None, 1, None, True), (None, 1, None, True),
        (8, 1, 8, True), (8, 1, 8, True), (6, 0, 6, True), (6, 0, 6, True),
    ], key=repr)


def test_a_tile_counts_each_link_once():
    """Over all tiles of parts and filters, each link is counted in one and joined by the forests."""
    draw = np.random.default_rng(10)
    centres = draw.standard_normal((5, 64))
    unit = vectors._unit(centres[draw.integers(0, 5, 90)] + draw.standard_normal((90, 64)) * 0.2)
    row, number = vectors.Caps().decode(unit)
    lists = [np.sort(number[row == i]) for i in range(90)]
    copies, part = draw.integers(1, 4, 90), draw.integers(0, 3, 90)
    counted, low = np.zeros(90, int), np.arange(90)
    for wanted in np.unique(number):
        for one in range(3):
            for other in range(one, 3):
                rows = np.array([i for i in range(90) if wanted in lists[i] and part[i] in (one, other)], int)
                if len(rows) < 2 or one != other and len(set(part[rows])) == 1:
                    continue
                a, b = vectors._links(unit[rows], 0.93, part[rows])
                counted[rows] += vectors._counts(a, b, copies[rows], vectors._marks([lists[i] for i in rows], int(wanted)))
                root = rows[vectors._roots(len(rows), a, b)]
                for i, j in zip(rows, root, strict=True):
                    low[low == max(low[i], low[j])] = min(low[i], low[j])
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    met = np.array([[not set(x).isdisjoint(y) for y in lists] for x in lists])
    assert counted.tolist() == ((near & met) @ copies).tolist() and counted.any()
    whole = vectors._roots(90, *np.nonzero(near & met))
    assert low.tolist() == whole.tolist()
