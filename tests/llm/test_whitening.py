"""Whitening against numpy."""

import numpy as np
import pytest

from tidewire.llm import whitening
from tidewire.llm.queries import QUERIES


def plain(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    spread = n * x - sums
    centred = spread / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-9 * values.max()]
    return (spread**2).sum(axis=1), centred @ axes[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


def check(found, ids, vectors, components=8):
    deviation, whitened, explained = plain(vectors, components)
    rows = sorted(tuple(r) for r in found.collect())
    width = whitened.shape[1]
    order = np.argsort(ids, kind="stable")
    assert [(r[0], r[1]) for r in rows] == [(ids[i], c + 1) for i in order for c in range(width)]
    assert {r[2] for r in rows} == {len(ids)}
    assert [r[3] for r in rows[::width]] == deviation[order].tolist()
    got = np.array([r[4] for r in rows]).reshape(-1, width)
    want = whitened[order] * np.sign((got * whitened[order]).sum(axis=0))
    assert np.allclose(got, want, atol=1e-7)
    assert np.allclose([r[5] for r in rows[:width]], explained, rtol=1e-8)
    assert len({r[6] for r in rows}) == 1 and rows[0][6] < 1e-8


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(3)
    return (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + rng.normal(size=12)).tolist()


def test_rows_that_take_no_part(spark, cloud):
    odd = [None, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [None] + [0.0] * 11, []]
    rows = [(i, v, 0, 0) for i, v in enumerate(cloud)] + [(1_000 + i, v, 0, 0) for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, uid long, index long").repartition(5)
    check(whitening.whitened_components(table), list(range(300)), cloud)


def test_blocks_do_not_matter(spark, cloud, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 12 * 17)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 5)
    table = spark.createDataFrame(list(enumerate(cloud)), "vec_id long, embedding array<float>").repartition(7)
    rounded = np.array(cloud, np.float32).astype(np.float64)
    check(whitening.whitened_components(table), list(range(300)), rounded)


def test_fewer_components(spark):
    rng = np.random.default_rng(4)
    short = rng.normal(size=(40, 3)).tolist()
    flat = [[*v[:2], 0.0, 1.0] for v in rng.normal(size=(40, 2)).tolist()]
    schema = "vec_id long, embedding array<double>"
    check(whitening.whitened_components(spark.createDataFrame(list(enumerate(short)), schema)), list(range(40)), short)
    check(whitening.whitened_components(spark.createDataFrame(list(enumerate(flat)), schema)), list(range(40)), flat)
    # Lengths are fitted by themselves.
    both = spark.createDataFrame(list(enumerate(short + flat)), schema)
    found = whitening.whitened_components(both)
    check(found.where("vec_id < 40"), list(range(40)), short)
    check(found.where("vec_id >= 40"), list(range(40, 80)), flat)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whitened_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.collect() == [] and found.columns == [c.split()[0] for c in whitening.RESULT.split(", ")]


def test_deviation_beyond_a_long(spark):
    rows = [(i, [(-1.0) ** i * 4e6, float(i)]) for i in range(4)]
    found = whitening.whitened_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r.deviation for r in found.collect()} == {None}


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(QUERIES["op13_whitening"](spark, sf), [r.vec_id for r in rows], [r.embedding for r in rows])
