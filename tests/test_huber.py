"""Huber regression by reweighted sums (ML6, ML8)."""

import numpy as np
import pytest

from tidemark.operators.huber import BEND, RIDGE, cut_square, fit_huber


def _rows(spark, x, y):
    return spark.createDataFrame([([float(v) for v in a], None if b is None else float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(5)


def _data(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 50, 0.01, 1] + [0, 1000, 0, 0]
    y = 2 + x @ [1.5, -0.02, 30, 0] + rng.normal(size=n) * 0.1
    y[::10] += 40  # outliers on one side
    return x, y


def test_the_last_round_is_a_fixed_point_and_outliers_hardly_count(spark):
    x, y = _data()
    model = fit_huber(_rows(spark, x, y), "x", "y", rounds=40)
    assert model.rows == 600
    assert np.allclose(model.coefficients, [1.5, -0.02, 30, 0], atol=0.05 * np.array([1, 0.02, 100, 1]))
    z = (x - x.mean(0)) / x.std(0)
    b = np.array(model.coefficients) * x.std(0)
    r = y - (model.intercept + x @ model.coefficients)
    assert model.scale ** 2 == pytest.approx((np.minimum(np.abs(r), BEND * model.scale) ** 2).mean() / cut_square(BEND), rel=1e-5)
    pull = np.clip(r, -BEND * model.scale, BEND * model.scale)  # slope of the loss
    assert np.abs(z.T @ pull - RIDGE * 600 * b).max() < 1e-3 * np.abs(pull).sum()
    least = np.linalg.lstsq(np.c_[np.ones(600), x], y, rcond=None)[0]
    assert abs(model.intercept + 1000 * model.coefficients[1] + 18) < abs(least[0] + 1000 * least[2] + 18)


def test_cut_square_is_the_mean_over_a_normal_law():
    z = np.abs(np.random.default_rng(1).normal(size=1_000_000))
    assert cut_square(BEND) == pytest.approx((np.minimum(z, BEND) ** 2).mean(), rel=5e-3)


def test_rounds_equal_a_plain_loop(spark):
    x, y = _data(200, 5)
    z = np.c_[np.ones(200), (x - x.mean(0)) / x.std(0)]
    b, limit = np.zeros(5), np.inf
    for _ in range(4):
        r = np.abs(y - z @ b)
        w = np.where(r <= limit, 1, limit / r)
        b = np.linalg.solve((z * w[:, None]).T @ z + RIDGE * 200 * np.eye(5), (z * w[:, None]).T @ y)
        limit = BEND * np.sqrt((np.minimum(r, limit) ** 2).mean() / (cut_square(BEND) if np.isfinite(limit) else 1))
    model = fit_huber(_rows(spark, x, y), "x", "y", rounds=3)
    got = [r["p"] for r in _rows(spark, x, y).select(model.predict("x").alias("p")).collect()]
    assert np.allclose(np.sort(got), np.sort(z @ b), rtol=1e-9)


def test_constant_equal_and_missing(spark):
    x, y = _data(120, 7)
    x[:, 3] = 5
    x[:, 2] = x[:, 0]
    model = fit_huber(_rows(spark, [*x, *x[:3]], [*y, None, None, None]), "x", "y")
    assert model.rows == 120 and model.coefficients[3] == 0
    assert model.coefficients[0] == pytest.approx(model.coefficients[2], rel=1e-3)
    with pytest.raises(ValueError, match="no rows"):
        fit_huber(_rows(spark, x[:2], [None, None]), "x", "y")
    with pytest.raises(Exception, match="not finite"):
        fit_huber(_rows(spark, [[1, float("nan")], [2, 3]], [1, 2]), "x", "y")
