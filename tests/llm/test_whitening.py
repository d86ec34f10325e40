"""Whitening against plain numpy."""

import numpy as np
import pytest

from lodestrata.llm import whitening
from lodestrata.llm.common import ship
from lodestrata.session import scratch_folder

SCHEMA = "vec_id long, embedding array<float>, n long, key string, size int, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "clash", 3, "clash") for i, v in rows], SCHEMA).repartition(3)


def whitened(spark, rows, **options):
    ship(spark)
    found = whitening.whiten(frame(spark, rows), scratch_folder(spark), **options).collect()
    return sorted(found, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component))


def vectors(n, size, seed):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, size)) @ rng.standard_normal((size, size)) + rng.standard_normal(size)
    return [[float(c) for c in row] for row in mixed.astype(np.float32)]


def plain(rows, fit_once=False):
    x = np.floor(np.array([v for _, v in rows], np.float32).astype(np.float64) * 1024).astype(np.int64) + 100_000
    fit = np.unique(x, axis=0) if fit_once else x
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviations = [sum(int(d) ** 2 for d in n * r - sums) for r in x]
    return n, deviations, (x - sums / n) @ axes / np.sqrt(values), values / values.sum()


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_as_numpy(spark, weights):
    own = vectors(60, 11, 1)
    rows = [(i, v) for i, v in enumerate(own)] + [(100 + i, own[0]) for i in range(40)] + [(200 + i, own[1]) for i in range(3)]
    got = whitened(spark, rows, weights=weights)
    n, deviations, projected, shares = plain(rows, fit_once=weights == "one")
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    assert [int(r.deviation) for r in got if r.component == 1] == deviations
    white = np.array([r.whitened for r in got]).reshape(-1, 8)
    signs = np.sign((white * projected[:, :8]).sum(axis=0))
    assert np.abs(white * signs - projected[:, :8]).max() < 1e-9
    assert np.allclose([r.explained for r in got[:8]], shares[:8], rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    if weights == "counts":
        assert np.abs(np.cov(white.T, bias=True) - np.eye(8)).max() < 1e-9


def test_rows_that_take_no_part(spark):
    own = vectors(20, 3, 2)
    good = [(i, v) for i, v in enumerate(own)] + [(None, own[0]), (3, own[4]), (3, own[4])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 0.0, 1.0]), (54, [float("inf"), 0.0, 1.0])]
    got = whitened(spark, good + bad)
    assert len(got) == 3 * len(good) and {r.vec_id for r in got} == {*range(20), None} and {r.n for r in got} == {len(good)}
    assert {r.component for r in got} == {1, 2, 3}


def test_large_entries_are_exact(spark):
    rows = [(0, [3.0e38, 1.0]), (1, [-3.0e38, 2.0]), (2, [1.0e6, 3.0]), (3, [0.5, 4.0])]
    x = [[min(max(int(np.floor(float(np.float32(c)) * 1024)), -(1 << 52)), 1 << 52) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((len(x) * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    got = whitened(spark, rows)
    assert [int(r.deviation) for r in got if r.component == 1] == exact


def test_lengths_are_separate_lists(spark):
    short, long_ = vectors(15, 2, 3), vectors(25, 9, 4)
    got = whitened(spark, [*enumerate(short), *((100 + i, v) for i, v in enumerate(long_))])
    assert [(r.n, r.component) for r in got if r.vec_id == 0] == [(15, 1), (15, 2)]
    assert {r.n for r in got if r.vec_id >= 100} == {25} and sum(r.vec_id >= 100 for r in got) == 25 * 8


def test_vectors_that_do_not_vary(spark):
    same = whitened(spark, [(i, [0.25, 0.5]) for i in range(5)])
    assert [(r.component, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in same[:2]] == [(1, None, None, None, 0), (2, None, None, None, 0)]
    line = whitened(spark, [(i, [float(i), 1.0]) for i in range(5)])
    assert [r.whitened is None for r in line[:2]] == [False, True] and line[0].identity_error < 1e-9
    assert line[0].explained == 1.0 and line[1].explained == 0.0
    assert whitened(spark, []) == []
    with pytest.raises(ValueError):
        whitening.distinct_vectors(frame(spark, []), "none")
