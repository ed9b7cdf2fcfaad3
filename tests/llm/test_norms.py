"""Recall of the search where norms differ, against brute force."""

import numpy as np
import pytest

from metrivane.llm import ann


def clustered(n, rng):
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, n)] + 0.4 * rng.normal(size=(n, 24))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def scaled(kind, x, rng):
    if kind == "log-normal":
        return x * np.exp(rng.normal(0, 2, len(x)))[:, None]
    x = x.copy()
    x[7] *= kind  # one vector that is longer than all others
    return x


@pytest.mark.parametrize("kind", [1e4, 1e8, 1e150, "log-normal"])
def test_recall_with_unequal_norms(spark, kind):
    rng = np.random.default_rng(11)
    x = scaled(kind, clustered(3000, rng), rng)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    by = {}
    for r in ann.neighbours(rows, every=50).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in by.items():
        s = x @ x[q]
        s[q] = -np.inf
        assert len(found) == 20
        hits += len(set(np.argsort(-s)[:20].tolist()) & found)
    assert len(by) == 60 and hits / (20 * 60) >= 0.9


def test_bands_scale_exactly():
    v = np.array([[3.0, 4.0], [1e-300, 0.0]])
    assert ann.band_scaled(v, (2 << 32) + 5).tolist() == [[0.75, 1.0], [2.5e-301, 0.0]]
    assert ann.band_scaled(v, (-1 << 32) + 5).tolist() == [[6.0, 8.0], [2e-300, 0.0]]
