"""Boosting against an exhaustive search of every split, calibration against the max-min formula."""
import numpy as np
import pytest

from tillroll.llm.toxicity import Trees, isotonic


def _exhaustive(x, y, weight, rounds, depth, rate, smooth, least):
    """Sums of greedily grown trees, each node split by trying every feature between every two values."""
    p = np.average(y, weights=weight)
    total = np.full(len(y), np.log(p / (1 - p)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        grad, hess = weight * (p - y), weight * p * (1 - p)

        def score(rows):
            return grad[rows].sum() ** 2 / (hess[rows].sum() + smooth)

        def grow(rows, level):
            if level == depth:
                total[rows] += -rate * grad[rows].sum() / (hess[rows].sum() + smooth)
                return
            best, parts = 1e-6, (rows, rows[:0])
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    left, right = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                    gain = score(left) + score(right) - score(rows)
                    if min(hess[left].sum(), hess[right].sum()) >= least and gain > best + 1e-12:
                        best, parts = gain, (left, right)
            for part in parts:
                if len(part):
                    grow(part, level + 1)

        grow(np.arange(len(y)), 0)
    return total


@pytest.mark.parametrize("seed", range(3))
def test_trees_equal_the_exhaustive_search(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, 4))[rng.integers(0, 12, (150, 4)), np.arange(4)]  # a dozen values a feature: every split is a candidate
    y = (x[:, 0] + 0.7 * x[:, 1] * x[:, 2] + rng.normal(scale=0.5, size=150) > 0).astype(float)
    weight = rng.uniform(0.5, 2, 150)
    trees = Trees(rounds=4).fit(x, y, weight)
    expected = _exhaustive(x, y, weight, 4, trees.depth, trees.rate, trees.smooth, trees.least)
    assert np.allclose(trees.sums(x), expected, atol=1e-9)


@pytest.mark.parametrize("seed", range(5))
def test_isotonic_equals_the_max_min_formula(seed):
    rng = np.random.default_rng(seed)
    n = 60
    score = rng.permutation(n).astype(float)
    y, weight = (rng.random(n) < score / n).astype(float), rng.uniform(0.2, 3, n)
    knots, values = isotonic(score, y, weight)
    order = np.argsort(score)
    s, v, w = score[order], y[order], weight[order]
    mean = lambda j, k: np.average(v[j:k + 1], weights=w[j:k + 1])
    fitted = np.array([max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)])
    assert np.allclose(np.unique(fitted.round(9)), values.round(9))
    assert (np.diff(knots) > 0).all() and (np.diff(values) > 0).all()
    for value, knot in zip(values, knots):  # a block stands at its mean score
        rows = np.isclose(fitted, value)
        assert np.isclose(np.average(s[rows], weights=w[rows]), knot)
