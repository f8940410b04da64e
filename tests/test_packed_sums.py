"""Weighted sums of a packed group are those of its rows one by one, without unpacking what the horizons share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from gridloom.operators import gram
from gridloom.operators.packed import Layout


def test_weighted_sums_of_packed_rows(monkeypatch):
    rnd = np.random.default_rng(6)
    layout = Layout("y", ["horizon", "x", "y_lag", "y_roll_24h_mean"], ["y_lag", "y_roll_24h_mean"])
    sizes = [3, 1, 4, 2]
    h = pa.array([list(range(1, n + 1)) for n in sizes])
    m = pa.array([[None if rnd.random() < 0.3 else rnd.random() for _ in range(n)] for n in sizes], pa.list_(pa.float64()))
    columns = [pa.array(rnd.random(4)), pa.array([0.4, None, 0.1, None]), h, m]
    x, of = layout.whole(columns)
    y, b = rnd.random(4) * 3, rnd.normal(size=layout.size) / 3
    eta = x @ b
    mean = np.exp(eta)
    w, z = mean**0.5, eta + (y[of] - mean) / mean
    monkeypatch.delattr(Layout, "whole")
    upper = np.triu_indices(layout.size)
    fixed, many, begin = layout.parts(columns)
    n, zz, xx, xy = gram._packed_sums(fixed, many, np.diff(begin), y, b, 1.5, layout, upper)
    assert n == max(1, round(w.sum())) and zz == pytest.approx(w @ (z * z))
    assert np.allclose(xx, ((x.T * w) @ x)[upper]) and np.allclose(xy, x.T @ (w * z))
