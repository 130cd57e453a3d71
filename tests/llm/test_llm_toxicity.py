import os
import random
import re
import zlib

import numpy as np
import pytest

from ledgerloom.llm import language, queries, toxicity

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
STEMS = {"en": "grimble", "de": "scheuß"}


def made(n, seed):
    """Texts of two languages; toxic ones hold words of a stem with any ending."""
    draw = random.Random(seed)
    parts = {"en": ["the", "of", "ing", "and", "tion", "her"], "de": ["der", "ung", "sch", "ein", "keit", "ich"]}
    rows = []
    for i in range(n):
        lang = draw.choice(["en", "de"])
        words = ["".join(draw.choices(parts[lang], k=draw.randint(1, 4))) for _ in range(draw.randint(5, 60))]
        toxic = draw.random() < 0.3
        for _ in range(3 * toxic):
            words.insert(draw.randrange(len(words)), STEMS[lang] + "".join(draw.choices(parts[lang], k=2)))
        rows.append((i, " ".join(words), lang, int(toxic)))
    return rows


def net_of(rows):
    keys = [toxicity.forms([r[1]])[0] for r in rows]
    toxic = np.array([r[3] for r in rows])
    held = [set(x.ravel().tolist()) for x in keys]
    counts = {}
    for own, mark in zip(held, toxic.tolist(), strict=True):
        for form in own:
            counts.setdefault(form, [0, 0])[1 - mark] += 1
    counts = {x: n for x, n in counts.items() if sum(n) >= 3}
    found = np.array(list(counts), np.uint64), *np.array(list(counts.values())).T
    net = toxicity.begun(*found, ((toxic == 0).sum(), (toxic == 1).sum()))
    toxicity.train(net, [net.rows(x) for x in keys], toxic)
    return net


def test_forms_of_words():
    draw = random.Random(1)
    letters = ["a", "b", "Z", "é", "ß", "你", " ", "  ", "\n", "-", "7", "x" * 9, "y" * 17, "z" * 40]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(200)] + ["", " ", "a"]
    keys, counts = toxicity.forms(texts)
    words = [WORD.findall(t.lower().encode()) for t in texts]
    assert counts.tolist() == [len(x) for x in words]
    flat = [w for own in words for w in own]
    for kind, form in enumerate([lambda w: w, *(lambda w, n=n: w[:n] for n in toxicity._PREFIXES)]):
        same = {}
        for word, key in zip(flat, keys[:, kind].tolist(), strict=True):
            short = form(word) if kind or len(word) <= 24 else (word[:16], word[-8:], len(word))
            assert same.setdefault(short, key) == key
        assert len(set(same.values())) == len(same)


def test_maxima_of_whole_texts(monkeypatch):
    """Texts judged together or alone, whole or in parts, have the maxima of a plain convolution."""
    net = net_of(made(200, 2))
    texts = [r[1] for r in made(30, 3)] + ["", "grimbleof", "  ", "der"]
    logits = net.logits(texts)
    for text, logit in zip(texts, logits, strict=True):
        keys, _ = toxicity.forms([text])
        words = np.vstack([net.embeddings[net.rows(keys)].sum(axis=1), np.zeros((toxicity._PAD, toxicity.DIMS))])
        best = []
        for width, weights in zip(toxicity.WIDTHS, net.filters, strict=True):
            windows = [np.concatenate(words[i : i + width]) @ weights for i in range(len(keys) + 1)]
            best.append(np.max(windows, axis=0))
        plain = np.maximum(np.concatenate(best) + net.biases, 0) @ net.weights + net.offset
        assert abs(plain - logit) < 1e-4 and abs(net.logits([text])[0] - logit) < 1e-4
    monkeypatch.setattr(toxicity, "PART", 90)
    assert any(len(list(toxicity.parts(t))) > 2 for t in texts)
    assert np.allclose(net.logits(texts), logits, atol=1e-4)
    assert "".join(toxicity.parts("x" * 290)) == "x" * 290


def test_threshold_is_in_the_widest_best_gap():
    logits, toxic = np.array([5.0, 4.0, 1.0, 0.0, -3.0]), np.array([1, 1, 0, 0, 0])
    assert toxicity.threshold(logits, toxic, 1.0) == 2.5
    assert toxicity.threshold(np.array([2.0, 2.0, 1.0]), np.array([1, 0, 0]), 1.0) == 1.5


def test_learned_words_are_found_in_unseen_rows(spark, odd_docs):
    rows = made(1500, 4)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").selectExpr(
        "*", "'clash' as id", "1 as toxic", "2 as score")
    marks = [(r[0], 1 - r[3] if r[0] % 97 == 0 else r[3], 1) for r in rows]  # some labels are wrong
    marks += [(None, 1, 1), (5, None, 1), (99_999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    languages = language.learn(docs.filter(~toxicity.held_out()))
    net = toxicity.learn(docs, labels, languages)
    assert set(net.thresholds) == {None, "en", "de"}
    got = {r.doc_id: r for r in toxicity.score(docs, net, languages).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert 300 < len(held) < 450 and sum(got[r[0]].predicted == r[3] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    odd = toxicity.score(odd_docs, net, languages).collect()
    assert len(odd) == odd_docs.count() and not any(r.predicted for r in odd)
    assert len({r.score for r in odd if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.score(odd_docs.limit(0), net, languages).count() == 0


def test_held_out_labels_change_nothing(spark):
    rows = made(300, 5)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    other = labels.withColumn("toxic", toxicity.F.expr("case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - toxic else toxic end"))
    languages = language.learn(docs.filter(~toxicity.held_out()))
    scores = [[r.score for r in toxicity.score(docs, toxicity.learn(docs, x, languages), languages).orderBy("doc_id").collect()]
              for x in (labels, other)]
    assert scores[0] == scores[1]


def test_nothing_to_learn(spark, odd_docs):
    none = language.learn(odd_docs.limit(0))
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert toxicity.learn(odd_docs, labels.limit(0), none) is None
    net = toxicity.learn(odd_docs, labels, none)
    assert net is None and {r.score for r in toxicity.score(odd_docs, net, none).collect()} == {0.0}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("benchmark tables are not here")
    marks = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null")
    judged = queries.QUERIES["op11_convolutional_toxicity"](spark, folder).filter("held_out").join(marks, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.8 * (counts[1, 1] + counts[1, 0]) and counts[0, 1] <= 0.02 * counts[0, 0]


def test_long_labelled_texts_are_learned_from(spark):
    """Toxic texts of more than 16 KB alone: no labelled row is left out for its length."""
    rows = [(i, ("filler and more of it " * 900 + text) if toxic else text, lang, toxic) for i, text, lang, toxic in made(400, 6)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    none = language.learn(docs.limit(0))
    net = toxicity.learn(docs, labels, none)
    assert net is not None
    got = {r.doc_id: r for r in toxicity.score(docs, net, none).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].predicted == r[3] for r in held) >= 0.95 * len(held)


def test_all_labelled_rows_train_and_calibrate(spark, monkeypatch):
    """Every text is counted, trained on in some task and counted for the thresholds; copies once."""
    monkeypatch.setattr(toxicity, "TASK_ROWS", 300)
    rows = made(9000, 7)
    docs = spark.createDataFrame([r[:3] for r in rows + rows[:50]], "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    mine, sizes = toxicity._labelled(docs, labels, "doc_id", "text", "toxic")
    want = {r[1]: r[3] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    assert sum(sizes.values()) > 6500 and {r.text: r.toxic for r in mine.collect()} == want and mine.count() == len(want)
    seen = {}
    fit, calibrate = toxicity.fit, toxicity.calibrate
    monkeypatch.setattr(toxicity, "fit", lambda net, training, share: seen.update(fit=training.count(), share=sum(share)) or fit(net, training, share))
    monkeypatch.setattr(toxicity, "calibrate", lambda net, own, *rest: seen.update(calibrate=own.count()) or calibrate(net, own, *rest))
    none = language.learn(docs.limit(0))
    net = toxicity.learn(docs, labels, none)
    assert seen["fit"] == seen["share"] and seen["fit"] + seen["calibrate"] == len(want)
    got = {r.doc_id: r for r in toxicity.score(docs, net, none).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].predicted == r[3] for r in held) >= 0.98 * len(held)


def test_gist_of_a_text_in_parts(monkeypatch):
    net = net_of(made(200, 2))
    texts = [r[1] for r in made(30, 3)]
    whole = [net.peaks(net.gist(x))[0] for x in texts]
    monkeypatch.setattr(toxicity, "PART", 90)
    for text, best in zip(texts, whole, strict=True):
        assert (net.peaks(net.gist(text))[0] >= best - 1e-4).all()


def test_moves_of_tasks_are_averaged(spark, tmp_path):
    """Two tasks with equal texts move the weights as one of them does."""
    rows = made(200, 8)
    spark.createDataFrame([(r[1], r[3]) for r in rows], "text string, toxic int").coalesce(1).write.parquet(f"file://{tmp_path}/t")
    one = spark.read.parquet(f"file://{tmp_path}/t")
    net = net_of(rows)
    balance = [1.0, 1.0]
    run = toxicity._descended(net, toxicity.Past.of(net), balance, 1)
    schema = "block int, task int, rows binary, times binary, moves binary"
    moved = lambda x: {r.rows: np.frombuffer(r.moves, np.float32) for r in x.mapInArrow(run, schema).repartition("block")
                       .sortWithinPartitions("block", "task").mapInArrow(toxicity._means, "rows binary, moves binary").collect()}
    single, double = moved(one), moved(one.union(one))
    assert one.union(one).rdd.getNumPartitions() == 2
    assert single.keys() == double.keys() and all(np.allclose(single[x], double[x], atol=1e-6) for x in single)
    state = toxicity._state(net, past := toxicity.Past.of(net))
    toxicity._restore(net, past, state + 1)
    assert np.array_equal(toxicity._state(net, past)[: len(state) - 1], (state + 1)[:-1])
