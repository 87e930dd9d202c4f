"""Whitened vectors against the covariance formed as a whole."""

import math

import numpy as np

from docloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, x string, i int, c string, `dim` int"


def table(spark, rows):
    """Extra columns have names that the operator uses inside."""
    return spark.createDataFrame([(i, v, 1, "x", 2, "c", 3) for i, v in rows], SCHEMA)


def expected(rows, k):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([np.float32(v) for _, v in good]).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    a = x - s / n
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviations = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, s, strict=True)) for r in x]
    return [i for i, _ in good], a @ u / np.sqrt(e), deviations, e / np.trace(a.T @ a / n)


def compare(spark, rows, k=8, **more):
    got = whitening.whiten_vectors(table(spark, rows), k=k, **more).toPandas().sort_values(["component", "vec_id", "deviation", "whitened"])
    ids, w, deviations, explained = expected(rows, k)
    assert len(got) == len(ids) * w.shape[1]
    for j in range(w.shape[1]):
        own = got[got.component == j + 1]
        order = sorted(range(len(ids)), key=lambda r: (ids[r], deviations[r]))
        want = w[order, j]
        sign = np.sign((own.whitened.to_numpy() * want).sum()) if len(set(ids)) == len(ids) else 1
        assert own.deviation.tolist() == [deviations[r] for r in order]
        assert len(set(ids)) < len(ids) or np.abs(own.whitened.to_numpy() * sign - want).max() < 1e-9
        assert np.allclose(own.explained, explained[j], rtol=1e-9)
    assert got.n.unique().tolist() == [len(ids)] and got.identity_error.max() < 1e-9


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, v) for i, v in enumerate((rng.standard_normal((n, d)) * np.linspace(2, 1, d)).astype(np.float32).tolist())]


def test_equals_the_whole_covariance(spark):
    compare(spark, vectors(300, 40))


def test_restarts_reach_the_same_components(spark):
    compare(spark, vectors(300, 40), k=3, columns=6, kept_blocks=3)


def test_unusable_vectors_are_dropped(spark):
    rows = vectors(120, 6)
    rows += [(200, None), (201, []), (202, [1.0] * 5 + [None]), (203, [math.nan] + [1.0] * 5), (204, [math.inf] + [1.0] * 5), (205, [-math.inf] * 6)]
    compare(spark, rows, k=8)
    got = whitening.whiten_vectors(table(spark, [*rows, (300, [1.0, 2.0]), (301, [3e38] * 6)]), k=2)
    assert {r.vec_id for r in got.collect()} == set(range(120)) and got.first().n == 120


def test_repeats_and_null_ids_are_rows(spark):
    rows = vectors(50, 5)
    compare(spark, rows + rows[:20] * 30, k=3)
    got = whitening.whiten_vectors(table(spark, [*rows, (None, [1.0] * 5)]), k=1).collect()
    assert len(got) == 51 and sum(r.vec_id is None for r in got) == 1


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        got = whitening.whiten_vectors(table(spark, rows))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0
    flat = [(i, [float(i % 7), 2.0, float(i % 7)]) for i in range(30)]
    assert {r.component for r in whitening.whiten_vectors(table(spark, flat)).collect()} == {1}


def test_deviations_are_whole_numbers_of_any_size():
    x = np.array([[5, -7], [1 << 40, 3]])
    assert whitening._exact(x, 1 << 20, np.array([3, 9])).to_pylist() == [(5 * (1 << 20) - 3) ** 2 + (7 * (1 << 20) + 9) ** 2, None]
