"""Tricube sums from moments."""

import numpy as np
import pytest

from tallyloom.functions import kernels


@pytest.mark.parametrize("side", [-1.0, 1.0])
@pytest.mark.parametrize("scale", [1 / 16, 1 / 8])
def test_moved_tricube_sums_equal_sums_over_rows(side, scale):
    """Both sets of a row, weights and weighted values, within 1e-15 of sums in long doubles, per unit of weight."""
    rng = np.random.default_rng(5)
    shift, t = side * rng.uniform(scale, 1 - scale, 200), rng.uniform(-1, 1, (200, 2, 300))
    w = rng.random(t.shape) ** 8
    moments = np.stack([(w.astype(np.longdouble) * t.astype(np.longdouble) ** p).sum(axis=2) for p in range(kernels.DEGREE + 1)], axis=2).astype(float)
    x = shift.astype(np.longdouble)[:, None, None] + np.longdouble(scale) * t.astype(np.longdouble)
    direct = np.stack([(w * (1 - np.abs(x) ** 3) ** 3 * x**k).sum(axis=2) for k in range(3)], axis=2)
    found = kernels.moved_tricube_sums(moments, shift, np.full(200, scale), side)
    assert found.shape == (200, 2, 3)
    assert (np.abs(found - direct) / w.sum(axis=2)[:, :, None]).max() < 1e-15
