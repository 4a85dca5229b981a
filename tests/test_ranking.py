"""The ranking fit against an independent solve, its defined cases and its penalty."""

import math

import numpy as np
import pytest

from tokenmill.operators import ranking as K

SCHEMA = "chosen array<double>, rejected array<double>"


def objective(c, r, w, reward_l2, weight_l2):
    m = c @ w - r @ w
    return (np.logaddexp(0, -m) + reward_l2 * ((c @ w) ** 2 + (r @ w) ** 2)).mean() + weight_l2 / 2 * w @ w


@pytest.mark.parametrize("reward_l2,weight_l2", [(0.05, 0.0), (0.0, 0.1), (0.3, 0.01)])
def test_fit_reaches_the_optimum(spark, reward_l2, weight_l2):
    rng = np.random.default_rng(1)
    c, r = rng.normal(0.3, 1, (60, 4)), rng.normal(0, 1, (60, 4))
    rows = [(a.tolist(), b.tolist()) for a, b in zip(c, r)]
    w = np.array(K.fit_bradley_terry(spark.createDataFrame(rows, SCHEMA).repartition(5), reward_l2, weight_l2))
    x = np.zeros(4)
    for _ in range(20_000):  # plain gradient steps
        p = 1 / (1 + np.exp((c - r) @ x))
        g = (-(c - r) * p[:, None] + 2 * reward_l2 * (c * (c @ x)[:, None] + r * (r @ x)[:, None])).mean(0)
        x = x - 0.2 * (g + weight_l2 * x)
    assert np.allclose(w, x, atol=1e-6)
    here = objective(c, r, w, reward_l2, weight_l2)
    for d in np.eye(4):
        assert objective(c, r, w + 1e-3 * d, reward_l2, weight_l2) > here


def test_penalty_bounds_separable_pairs(spark):
    # one component orders all pairs: without a penalty the weights would grow for ever
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0])] * 3, SCHEMA)
    (a, b) = K.fit_bradley_terry(df, reward_l2=0.1)
    # 1 / (1 + e^a) = 0.2 a, and the component that no pair has stays at zero
    assert math.isclose(1 / (1 + math.exp(a)), 0.2 * a, rel_tol=1e-6) and b == 0.0


def test_unusable_pairs_are_left_out(spark):
    good = [([1.0, 2.0], [0.5, 0.0]), ([0.0, 1.0], [1.0, 0.5]), ([1.0, 2.0], [0.5, 0.0])]
    bad = [(None, [1.0, 1.0]), ([1.0, 1.0], None), ([1.0, None], [0.0, 0.0]), ([1.0], [0.0]),
           ([float("nan"), 1.0], [0.0, 0.0]), ([1.0, 1.0], [float("inf"), 0.0]), ([], [])]
    fit = lambda rows: K.fit_bradley_terry(spark.createDataFrame(rows, SCHEMA), 0.1)
    assert np.allclose(fit(good), fit(good + bad), atol=1e-9)
    assert fit([([None, 1.0], [0.0, 0.0])]) == []
    assert K.fit_bradley_terry(spark.createDataFrame([], SCHEMA), 0.1) == []


def test_too_many_components_are_refused(spark, monkeypatch):
    monkeypatch.setattr(K, "MAX_DIM", 1)
    with pytest.raises(ValueError):
        K.fit_bradley_terry(spark.createDataFrame([([1.0, 2.0], [0.0, 0.0])], SCHEMA), 0.1)
