"""Spectrum slicing and whitening against numpy."""

import numpy as np
import pytest

from llm import whitening
from llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, component int, n long"


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 20, 40):
        for _ in range(20):
            m = rng.standard_normal((n, n))
            m = m + m.T
            if rng.random() < 0.3:
                m[rng.integers(n)] = 0
                m = (m + m.T) / 2
            if rng.random() < 0.3:
                np.fill_diagonal(m, 0)
            values = np.linalg.eigvalsh(m)
            for shift in (*rng.uniform(values[0] - 1, values[-1] + 1, size=8), values.mean() + 0.01):
                if np.abs(values - shift).min() > 1e-9:
                    assert whitening.positive(m, shift) == (values > shift).sum()


def spectrum(values, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    m = (q * np.array(values)) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 65.0),
        [5.0] * 10 + [3.0] * 30 + [1.0] * 10,
        [1.0] * 40,
        [1 + 1e-13 * k for k in range(20)] + [2.0] * 3,
        [1 + 1e-7 * k for k in range(20)],
        [10.0**-k for k in range(9)],
        [1e6, 1e6, 1, 1, 0, 0, 0],
        [7.0],
    ],
)
def test_leading_components(values):
    m = spectrum(values, 3)
    found, vectors = whitening.leading(m, 32)
    want = np.linalg.eigvalsh(m)[::-1]
    want = want[want > 1e-12 * np.trace(m)][:32]
    assert len(found) == len(want)
    assert np.allclose(found, want, rtol=1e-9, atol=1e-13 * want[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-12
    assert np.abs(m @ vectors.T - vectors.T * found).max() < 1e-12 * want[0] * len(m)


def test_no_components():
    assert len(whitening.leading(np.zeros((4, 4)))[0]) == 0


def made_rows():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((400, 40)) * np.linspace(3, 0.2, 40)
    rows = [(k, [float(np.float32(c)) for c in v], 1, 1) for k, v in enumerate(x)]
    odd = [None, [], [1.0] * 39, [float("nan")] * 40, [float("inf")] + [0.0] * 39, [None] + [0.0] * 39, [1e30] * 40]
    return rows + [(1000 + k, v, None, None) for k, v in enumerate(odd)] + [rows[5], (None, rows[6][1], None, None), (7, rows[8][1], None, None)]


def test_whitening(spark):
    prepare(spark)
    rows = made_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    kept = [(k, v) for k, v, *_ in rows if v and len(v) == 40 and all(c is not None and abs(c) < 1e12 for c in v)]
    x = np.floor(64 * np.array([v for _, v in kept])).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    white = centred @ vectors / np.sqrt(values)
    got = whitening.whiten(df).collect()
    assert len(got) == 32 * n and {r.n for r in got} == {n}
    deviation = ((n * x - total) ** 2).sum(axis=1)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    want = {}
    for (k, _), d, w in zip(kept, deviation, white, strict=True):
        want.setdefault((k, d), []).append(w)
    assert by_row.keys() == want.keys()
    sign = None
    for key, rs in by_row.items():
        mine = np.zeros(32)
        for r in rs:
            mine[r.component - 1] = r.whitened
            assert abs(r.explained / (values[r.component - 1] / np.trace(covariance)) - 1) < 1e-9
        if sign is None:
            sign = np.sign(mine * want[key][0])
        assert np.allclose(mine * sign, want[key][0], atol=1e-8)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_few_or_no_vectors(spark):
    prepare(spark)
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert make([]) == [] and make([(1, None, 1, 1)]) == [] and make([(1, [1.0, 2.0], 1, 1)] * 3) == []
    line = make([(k, [float(k), 2.0 * k, 5.0], 1, 1) for k in range(10)])
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-9
    # n x - S squared leaves 64 bits
    wide = make([(1, [2.0**33, 0.0], 1, 1), (2, [-(2.0**33), 0.0], 1, 1), (3, [0.0, 0.0], 1, 1)])
    assert {r.vec_id: r.deviation for r in wide} == {1: None, 2: None, 3: 0}
