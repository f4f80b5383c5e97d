import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import bins, boosting, bundles
from tillcast.operators.trees import TreeSettings


def rows(n=6000, seed=3):
    """Two features apart, and three that follow from a day of the week."""
    rng = np.random.default_rng(seed)
    day = rng.integers(0, 7, n)
    return np.stack([rng.integers(0, 40, n), day, day // 5, np.array([3, 1, 2, 0, 2, 1, 3])[day], rng.integers(0, 64, n), np.zeros(n, int)]).astype(np.uint8)


@pytest.mark.parametrize("least", [0, 10 ** 6])
def test_sums_of_codes_equal_sums_of_rows(monkeypatch, least):
    monkeypatch.setattr(bundles, "LEAST_ROWS", least)
    monkeypatch.setattr(bundles, "FEW_ROWS", 500)
    lines = rows()
    data = bundles.Bundled(lines)
    if not least:
        assert len(data.tables) < 5 and data.group[1] == data.group[2] == data.group[3]
    for f, line in enumerate(lines):
        np.testing.assert_array_equal(data.bins(f), line)
    rng = np.random.default_rng(0)
    cells, at = bundles.Cells(data, [0, 1, 2, 4, 5]), np.flatnonzero(rng.random(6000) < 0.7)
    slot, g = rng.integers(0, 3, len(at)), rng.normal(size=6000)
    for many, given in ((3, slot), (1, None)):
        found = bundles.sums(data, cells, at, [g, np.ones(6000)], given, many)
        for size, own, begin, end in cells.squares:
            for k, f in enumerate(cells.used[own]):
                brute = np.zeros((many, size, 2))
                np.add.at(brute, (0 if given is None else slot, lines[f, at]), np.stack([g[at], np.ones(len(at))], 1))
                first = begin + k * size
                for i in (0, 1):
                    np.testing.assert_allclose(found[i][:, first:first + size], brute[..., i], atol=1e-9)


@pytest.mark.parametrize("kind, leaves", [("boosted", 0), ("boosted", 20), ("forest", 0)])
def test_codes_and_single_features_grow_the_same_trees(monkeypatch, kind, leaves):
    lines, rng = rows(), np.random.default_rng(5)
    y = lines[0] / 9.0 + 2 * (lines[1] > 4) + np.sin(lines[4]) + rng.normal(size=6000)
    w, held, key = rng.choice([0.25, 0.5, 1.0], 6000), rng.random(6000) < 0.2, rng.permutation(6000)
    settings = TreeSettings(kind, trees=6, depth=0 if leaves else 5, leaves=leaves, min_rows=10, rows=0.8, step=0.2, patience=3)
    out = []
    for least in (0, 10 ** 6):
        monkeypatch.setattr(bundles, "LEAST_ROWS", least)
        trees, values, base, _ = boosting.fit_rows(key, held, y, w, np.ascontiguousarray(lines.T), settings)
        out.append(base + sum(v[boosting.descend(t.arrays(), lines)] for t, v in zip(trees.values(), values)))
    np.testing.assert_allclose(*out, atol=1e-9)
    assert np.corrcoef(out[0], y)[0, 1] > 0.7


def test_hessians_and_rows_are_one_number_only_where_that_is_exact():
    g, many = np.ones(1000), np.random.default_rng(2)
    for h, weights in ((np.ones(1000), 2), (many.choice([0.25, 0.5, 1.0], 1000), 2), (many.random(1000), 3), (np.full(1000, 2.0 ** 20), 3)):
        given = boosting._Sums(g, h)
        assert len(given.weights) == weights
        _, hessian, n = given.apart([np.array([w[:700].sum()]) for w in given.weights])
        assert n[0] == 700 and hessian[0] == pytest.approx(h[:700].sum(), rel=1e-12)


def test_small_lanes_are_dealt_to_several_tasks(spark, monkeypatch):
    """A few rows per lane are little data and much work; one task fitted all lanes before."""
    df = spark.range(600).select("id", (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 6).alias("city"), F.rand(1).alias("y"))
    data, dealt, own = bins.bin_rows(df, ["a"], ["id", "city", "y"]), [], boosting.materialize
    monkeypatch.setattr(boosting, "materialize", lambda frame, name: dealt.append((name, frame.rdd.getNumPartitions())) or own(frame, name))
    boosting.fit_lanes(boosting.lane_rows(data, "city", "y", ["id"]), data.edges, TreeSettings("boosted", trees=2, depth=2, min_rows=5))
    assert dict(dealt)["trees"] >= 8
