import numpy as np
import pytest

from tricycle.llm.whitening import polar_factor, spectral_components, whitened

SCHEMA = "vec_id long, embedding array<double>, whitened string, x string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "w", "x") for i, v in rows], SCHEMA)


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [[3.0, 1, -2, -5], [1.0, 1e-12, -1e-14], list(np.linspace(-1, 1, 40))])
def test_polar_factor_is_the_matrix_sign(values):
    a = symmetric(values)
    assert np.allclose(polar_factor(a), symmetric(np.sign(values)), atol=1e-3 if min(map(abs, values)) < 1e-10 else 1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [0.0, 0.0, 0.0],
        [2.0] * 7,
        [4.0, 4, 4, 1, 1, 0, 0],
        [1 + 1e-9, 1.0, 1 - 1e-9, 0.5],
        list(1.5 ** -np.arange(30.0)),
        list(np.random.default_rng(3).exponential(size=64)),
    ],
)
def test_components_are_the_eigenvectors(values):
    a = symmetric(np.array(values, float))
    for count in (1, 4, len(values)):
        found, vectors = spectral_components(a, count)
        assert found == pytest.approx(sorted(values, reverse=True)[:count], abs=1e-13 * max(1, max(values)))
        assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-13)
        assert np.allclose(a @ vectors, vectors * found, atol=1e-12)


def brute(rows, count=4):
    used = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(256 * np.array([v for _, v in used], float)).astype(np.int64)
    fits = np.array(sorted({tuple(r) for r in x.tolist()}))
    n, sums = len(fits), fits.sum(axis=0)
    centred = fits - sums / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:count], q[:, ::-1][:, :count]
    out = {}
    for (i, _), row in zip(used, x, strict=True):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))
        out[i] = (n, deviation, (row - sums / n) @ q / np.sqrt(e), e / np.trace(v))
    return out


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.normal(size=6) * [5, 3, 2, 1, 0.5, 200]).tolist()) for k in range(400)]
    rows += [(500 + k, rows[7][1]) for k in range(200)]  # copies count once for the components
    rows += [(900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [1.0] * 5 + [float("nan")]), (904, [float("inf")] * 6)]
    expected = brute(rows)
    found = whitened(table(spark, rows + [(905, [1.0])]), count=4).collect()
    assert len(found) == 4 * len(expected)
    for r in found:
        n, deviation, projected, explained = expected[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(abs(projected[r.component - 1]), rel=1e-9, abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    signs = {c: {np.sign(r.whitened * expected[r.vec_id][2][c - 1]) for r in found if r.component == c} for c in (1, 2, 3, 4)}
    assert all(len(s) == 1 for s in signs.values())


def test_edges(spark):
    assert whitened(table(spark, [])).collect() == []
    assert whitened(table(spark, [(1, None), (2, [None])])).collect() == []
    assert whitened(table(spark, [(1, [1.0, 2.0])] * 3)).collect() == []  # no variance
    found = whitened(table(spark, [(None, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert [(r.vec_id, r.component, r.n) for r in found] == [(None, 1, 2), (2, 1, 2), (2, 1, 2)]
    assert {r.explained for r in found} == {1.0} and {abs(r.whitened) for r in found} == {1.0}
    huge = whitened(table(spark, [(1, [1e300, 0.0]), (2, [0.0, 1.0])]), count=1).collect()
    assert [r.deviation for r in huge] == [None, None]
    wide = whitened(table(spark, [(1, [1e6, 0.5]), (2, [0.0, 1.0]), (3, [0.001, 0.0])]), count=2).collect()
    assert len(wide) == 6
