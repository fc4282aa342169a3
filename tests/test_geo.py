import numpy as np
import pytest

from conftest import rows
from tidewire.operators import geo


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 300), rng.normal(4, 0.5, 200)])
    return x, 0.6 * x + rng.normal(0, 1, 500)


def frame(spark, x, y):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")


def density(x, y, grid, cut=3):
    """Gaussian kernel density with numpy."""
    n = len(x)
    cov = np.cov(x, y) * n ** (-1 / 3)
    pad = cut * np.sqrt(np.diag(cov))
    gx = np.linspace(x.min() - pad[0], x.max() + pad[0], grid)
    gy = np.linspace(y.min() - pad[1], y.max() + pad[1], grid)
    d = np.stack(np.meshgrid(gx, gy, indexing="ij"), -1)[:, :, None, :] - np.stack([x, y], -1)[None, None]
    energy = np.einsum("ijkl,lm,ijkm->ijk", d, np.linalg.inv(cov), d)
    return np.exp(-energy / 2).sum(-1) / (n * 2 * np.pi * np.sqrt(np.linalg.det(cov)))


def as_matrix(grid_df, size):
    out = np.zeros((size, size))
    for r in grid_df.collect():
        out[r.ix, r.iy] = r.density
    return out


def test_exact_density_equals_numpy(spark, cloud):
    grid = geo.kde_grid(frame(spark, *cloud), "x", "y", gridsize=24, bins=None)
    assert np.allclose(as_matrix(grid, 24), density(*cloud, 24), rtol=1e-9)


def test_binned_density_is_close(spark, cloud):
    exact = density(*cloud, 24)
    grid = geo.kde_grid(frame(spark, *cloud), "x", "y", gridsize=24, bins=128)
    assert np.abs(as_matrix(grid, 24) - exact).max() < 0.002 * exact.max()


def test_bins_hold_every_point_once(spark, cloud):
    cells = geo.bin_points(frame(spark, *cloud), "x", "y", bins=16).collect()
    assert sum(c.weight for c in cells) == 500
    assert {c.cx for c in cells} <= set(range(16)) and {c.cy for c in cells} <= set(range(16))
    assert np.isclose(sum(c.weight * c.mean_x for c in cells), cloud[0].sum())


def test_levels_enclose_their_share(spark, cloud):
    grid = geo.kde_grid(frame(spark, *cloud), "x", "y", gridsize=24, bins=None)
    levels = geo.density_levels(grid, thresh=0.05, levels=10).orderBy("level").collect()
    values = np.sort(as_matrix(grid, 24).ravel())[::-1]
    mass = np.cumsum(values) / values.sum()
    for entry, share in zip(levels, np.linspace(0.05, 1, 10)):
        at = min(np.searchsorted(mass, 1 - share), len(values) - 1)
        assert np.isclose(entry.density, values[at], rtol=1e-9)


def test_degenerate_points_give_no_density(spark):
    for points in ([], [(1.0, 2.0)], [(1.0, 2.0), (1.0, 2.0)], [(None, 1.0), (1.0, None)]):
        df = spark.createDataFrame(points, "x double, y double")
        for bins in (None, 8):
            grid = geo.kde_grid(df, "x", "y", gridsize=4, bins=bins)
            assert grid.count() == 0
            assert geo.density_levels(grid).count() == 0


def test_one_place_is_one_bin(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 3, "x double, y double")
    assert rows(geo.bin_points(df, "x", "y", 8)) == [(0, 0, 3, 1.0, 2.0)]
