import math

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import whitening


def brute_force(rows, wanted=16):
    """id, deviation and whitened values by dense algebra; components without a variance are left out."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n - 1_000_000 for s in sums])
    centred = np.array(fit) - 1_000_000 - mean
    matrix = centred.T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    real = values > 1e-12 * np.trace(matrix)
    values, vectors = values[real], vectors[:, real]
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out.append((i, n, deviation, (np.array(x) - 1_000_000 - mean) @ vectors / np.sqrt(values)))
    return out, values / np.trace(matrix)


def check(frame, rows, wanted=16):
    want, explained = brute_force(rows, wanted)
    got = {}
    for r in frame.collect():
        got.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append(r)
    assert sorted(got, key=repr) == sorted({x[:3] for x in want}, key=repr)
    signs = None
    for i, n, deviation, values in want:
        own = got[i, n, deviation]
        assert sorted(own) == list(range(1, len(explained) + 1))
        mine = np.array([own[c][0].whitened for c in sorted(own)])
        if signs is None and np.abs(values).min() > 1e-6:
            signs = np.sign(mine * values)
        if signs is not None:
            assert np.allclose(mine * signs, values, atol=1e-8)
        assert np.allclose([own[c][0].explained for c in sorted(own)], explained, rtol=1e-9)
        assert own[1][0].identity_error < 1e-9
    assert signs is not None


def table(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for name in ("id", "x", "dims", "vector", "n", "row", "part"):
        frame = frame.selectExpr("*", f"'clash' as `{name}`")
    return frame


def test_whitening_against_dense_algebra(spark):
    draw = np.random.default_rng(1)
    scale = np.linspace(3, 0.5, 20)
    rows = [(i, (draw.standard_normal(20) * scale).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a hot vector counts once
    rows += [(5, rows[9][1]), (None, rows[3][1]), (2000, [0.0] * 20), (2001, [-0.0] * 20)]
    rows += [(2002, [1e3] + [0.0] * 19), (2003, [None] * 20), (2004, [float("nan")] * 20), (2005, [float("inf")] * 20), (2006, None), (2007, [])]
    odd = [(2008, [1.0, 2.0])]  # another length
    check(whitening.whitened(table(spark, rows + odd)), rows)
    check(whitening.whitened(table(spark, rows), 3), rows, 3)


def test_equal_eigenvalues_and_small_rank(spark):
    unit = [(2 * i + s, [float(s * 2 - 1) * (j == i) for j in range(8)]) for i in range(8) for s in (0, 1)]
    got = whitening.whitened(table(spark, unit), 5).collect()
    assert len(got) == 16 * 5 and got[0].identity_error < 1e-9
    assert {round(r.explained, 9) for r in got} == {0.125}
    draw = np.random.default_rng(2)
    few = [(i, draw.standard_normal(12).tolist()) for i in range(5)]
    check(whitening.whitened(table(spark, few)), few)
    flat = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    assert {r.component for r in whitening.whitened(table(spark, flat)).collect()} == {1}


def test_nothing_to_whiten(spark):
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whitened(table(spark, [(1, None), (2, [None])])).count() == 0
    assert whitening.whitened(table(spark, []).limit(0)).count() == 0
    huge = [(1, [1e308, 1.0]), (2, [-1e308, 2.0]), (3, [0.0, 5.0])]
    assert {r.deviation for r in whitening.whitened(table(spark, huge)).collect()} == {None, 200704}
    ints = spark.createDataFrame([(i, [i, i * i]) for i in range(5)], "vec_id int, embedding array<int>")
    assert whitening.whitened(ints).count() == 10


def test_packed_vectors():
    draw = np.random.default_rng(3)
    values = np.concatenate([draw.integers(-m, m, (5, 4)) for m in (2, 128, 1 << 15, 1 << 31, 1 << 52)])
    values = np.concatenate((values, [[-128, 127, 0, 1], [128, 0, 0, 0], [-129, 0, 0, 0], [1 << 31, 0, 0, 0], [-(1 << 31), 0, 0, 0]]))
    strings = whitening.packed(values)
    assert (whitening.unpacked(strings, 4) == values).all()
    assert {len(x) for x in strings} == {5, 9, 17, 33}


@pytest.mark.parametrize("dims", [1, 2, 5, 40])
def test_inertia_and_contours(dims):
    draw = np.random.default_rng(dims)
    turn, _ = np.linalg.qr(draw.standard_normal((dims, dims)))
    values = np.sort(np.concatenate((draw.uniform(0, 9, dims - dims // 3), np.full(dims // 3, 4.0))))[::-1]
    matrix = (turn * values) @ turn.T
    form = whitening.tridiagonal(matrix)
    shifts = draw.uniform(-1, 10, 50)
    assert whitening.above(form, shifts).tolist() == [(values > s).sum() for s in shifts]
    cut = whitening.intervals(matrix, min(16, dims))
    assert sum(n for *_, n in cut) >= min(16, dims)
    found = []
    for low, high, count in cut:
        assert count == ((values > low) & (values <= high)).sum()
        own, vectors = whitening.contour_components(matrix, low, high, count)
        assert np.allclose(matrix @ vectors, vectors * own) and np.allclose(vectors.T @ vectors, np.eye(count))
        found += own.tolist()
    assert np.allclose(sorted(found, reverse=True), values[: len(found)])


def test_null_entries_in_arrow_lists():
    lists = pa.array([[1.0, None], None, [2.0, 3.0], [], [float("nan"), 1.0]], pa.list_(pa.float32()))
    (out,) = whitening._encoded(iter([pa.record_batch([pa.array([1, 2, 3, 4, 5]), lists], ["id", "vector"])]))
    assert out.column(0).to_pylist() == [3] and out.column(1).to_pylist() == [2]
