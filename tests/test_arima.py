"""Likelihood order search and augmented unit-root tests against plain regressions."""

from collections import Counter

import numpy as np
import pytest

from tests.conftest import make_ticks
from tickweave.operators import arima as A
from tickweave.operators import unitroot as U
from tickweave.operators.stats import adf
from tickweave.plans import sequence


def arma(phi, theta, n, seed):
    r = np.random.default_rng(seed)
    e, x = r.normal(size=n + 200), np.zeros(n + 200)
    for t in range(3, n + 200):
        x[t] = e[t] + sum(f * x[t - 1 - i] for i, f in enumerate(phi)) + sum(f * e[t - 1 - i] for i, f in enumerate(theta))
    return x[200:]


def autocovariances(x):
    z, n = x - x.mean(), len(x)
    return np.array([(z[:n - h] * z[h:]).sum() / n for h in range(min(n, A.MAX_LAG + 1))])


def ticks(spark, series, chunks=4):
    rows = [(name, i, 10_000 * j + i, float(x), 1.0, 1.0) for j, (name, v) in enumerate(series.items()) for i, x in enumerate(v)]
    return sequence(make_ticks(spark, rows), chunks=chunks)


def test_coefficients_keep_the_roots_outside():
    r = np.random.default_rng(0)
    for _ in range(50):
        a = A.coefficients(r.normal(size=3) * 3)
        assert np.abs(np.roots([1.0, *-a])).max() < 1


def test_variance_is_the_filtered_one():
    """The mean over frequencies equals the energy of the filter's output."""
    x = arma([0.5], [], 400, 1)
    g = autocovariances(x)
    w, u = A.Whittle(g), np.array([0.3, -0.2])
    a = A.coefficients(u)
    out = np.convolve(x - x.mean(), [1.0, *-a])
    assert abs(w.variance(u, 2) - (out**2).sum() / len(x)) < 1e-9
    step = 1e-5
    assert np.allclose(w.slope(u, 1), [(w.log_variance(u + d, 1) - w.log_variance(u - d, 1)) / (2 * step) for d in np.eye(2) * step])


@pytest.mark.parametrize("phi,theta", [([], [0.8]), ([0.6], [0.4]), ([0.5, -0.3], [])])
def test_aic_recovers_known_orders(phi, theta):
    truth, picks = (len(phi), len(theta)), Counter()
    for seed in range(20):
        p, q, f, t, s2, aic = A.search_orders(autocovariances(arma(phi, theta, 1_000, seed)), 1_000, 3, 3)
        picks[p, q] += 1
        assert abs(s2 - 1) < 0.2
        if (p, q) == truth:
            assert np.allclose([*f, *t], [*phi, *theta], atol=0.15)
    assert picks.most_common(1)[0][0] == truth and picks[truth] >= 10


def brute_adf(x, lags, trend):
    x = np.asarray(x, float)
    dx = np.diff(x)
    rows = [[dx[t], 1.0, *([float(t)] if trend else []), x[t], *[dx[t - j] for j in range(1, lags + 1)]] for t in range(lags, len(dx))]
    m = np.array(rows)
    b, *_ = np.linalg.lstsq(m[:, 1:], m[:, 0], rcond=None)
    e = m[:, 0] - m[:, 1:] @ b
    se = np.sqrt(np.diag(np.linalg.inv(m[:, 1:].T @ m[:, 1:])) * (e @ e) / (len(m) - m.shape[1] + 1))
    i = 1 + trend
    return b[i], b[i] / se[i], len(m)


@pytest.mark.parametrize("lags,trend", [(None, True), (None, False), (0, False), (1, True), (5, False)])
def test_adf_against_plain_least_squares(spark, lags, trend):
    r = np.random.default_rng(4)
    series = {"walk": np.cumsum(r.normal(size=300)), "ar": arma([0.5], [], 130, 2), "short": r.normal(size=40)}
    s = ticks(spark, series)
    for rows in (30, 65_536):
        for got in U.adf_test(s, "price", lags, trend, max_d=1, rows=rows).collect():
            x = np.diff(series[got.currency], got.d)
            want = brute_adf(x, got.lags, trend)
            assert got.lags == (int(round((len(x) - 1) ** (1 / 3), 9)) if lags is None else lags)
            assert np.allclose([got.gamma, got.t_stat], want[:2]) and got.nobs == want[2]


def test_adf_of_no_lags_is_the_plain_one(spark):
    s = ticks(spark, {"a": arma([0.9], [], 200, 3)})
    plain, full = adf(s).first(), U.adf_test(s, lags=0).first()
    assert np.allclose([plain.gamma, plain.t_stat], [full.gamma, full.t_stat]) and plain.nobs == full.nobs


def test_p_values():
    # the 1, 5 and 10 per cent points of the large-sample distributions
    for trend, points in ((False, (-3.43, -2.862, -2.567)), (True, (-3.959, -3.41, -3.127))):
        for t, p in zip(points, (0.01, 0.05, 0.1)):
            assert abs(U.p_value(t, trend) - p) < 0.003
        grid = [U.p_value(t, trend) for t in np.arange(-20, 4, 0.25)]
        assert grid == sorted(grid) and grid[0] == 0.0 and grid[-1] == 1.0


def test_d_of_walks_with_moving_average_errors(spark):
    series = {}
    for seed in range(6):
        e = np.random.default_rng(seed).normal(size=1_001)
        u = e[1:] + 0.5 * e[:-1]
        series |= {f"0 {seed}": u, f"1 {seed}": np.cumsum(u), f"2 {seed}": np.cumsum(np.cumsum(u))}
    found = {r.currency: r.d for r in U.select_d(ticks(spark, series)).collect()}
    right = [found[k] == int(k[0]) for k in series]
    assert sum(right) >= 16  # a test at 5 per cent errs now and then


def test_constant_and_tiny_series(spark):
    s = ticks(spark, {"constant": [3.0] * 60, "two": [1.0, 2.0], "one": [1.0]})
    got = {r.currency: r for r in U.select_d(s).collect()}
    assert got["constant"].d == got["two"].d == got["one"].d == 0 and got["constant"].t0 is None
    models = {r.currency: r for r in A.arima_fit(s).collect()}
    assert models["constant"].p == 0 and abs(models["constant"].coef[0] - 3) < 1e-9 and models["two"].p is None
    ahead = {r.currency: r.forecast for r in A.arima_forecast(A.arima_fit(s), s, steps=5).collect() if r.step == 5}
    assert abs(ahead["constant"] - 3) < 1e-9 and ahead["one"] is None
