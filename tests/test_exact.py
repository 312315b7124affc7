from __future__ import annotations

import numpy as np
import pytest

from gridspan.operators import exact
from gridspan.operators import forecast as fc


def simulated(n, phi, seed, gaps=0.0):
    """(hour, level) of an integrated AR series, some hours missing."""
    rng = np.random.default_rng(seed)
    d = np.zeros(n + 100)
    for t in range(len(phi), n + 100):
        d[t] = np.dot(phi, d[t - len(phi) : t][::-1]) + rng.normal()
    y = 50 + np.cumsum(d[100:])
    keep = rng.random(n) >= gaps
    return [(int(t) + 17, float(v)) for t, v in enumerate(y) if keep[t]]


def naive(rows, phi):
    """(-2 log-likelihood, shock variance, final state): a filter that goes hour by hour."""
    p = len(phi)
    a = np.zeros((p + 1, p + 1))
    a[0, 0], a[0, 1:], a[1, 1:] = 1, phi, phi
    for i in range(2, p + 1):
        a[i, i - 1] = 1
    q = np.zeros((p + 1, p + 1))
    q[:2, :2] = 1
    var = np.zeros((p + 1, p + 1))
    cov = np.eye(p)
    for _ in range(2000):  # the stationary variance by iteration
        cov = a[1:, 1:] @ cov @ a[1:, 1:].T + q[1:, 1:]
    var[1:, 1:] = cov
    mean = np.zeros(p + 1)
    at, mean[0] = rows[0]
    s = d = n = 0
    for t, y in rows[1:]:
        while at < t:
            mean, var, at = a @ mean, a @ var @ a.T + q, at + 1
        f, v = var[0, 0], y - mean[0]
        k = var[:, 0] / f
        mean, var = mean + k * v, var - np.outer(k, var[:, 0])
        s, d, n = s + v * v / f, d + np.log(f), n + 1
    return n * np.log(2 * np.pi * s / n) + d + n, s / n, mean


SERIES = {
    "whole": simulated(200, [0.5], 1), "gaps": simulated(200, [0.6], 2, 0.05), "many gaps": simulated(150, [0.4], 3, 0.3),
    "sparse": simulated(300, [0.5], 4, 0.7), "short": simulated(4, [0.5], 5),
    "long gap": [r for r in simulated(200, [0.5], 6) if not 60 <= r[0] < 120],
    "gap at the end": [r for r in simulated(100, [0.7], 7) if r[0] != 115],
}


def frame(spark, series):
    rows = [(name, t, y) for name, own in series.items() for t, y in own] + [("gaps", 0, None)]
    return spark.createDataFrame(rows, "series string, hour long, y double").repartition(5)


@pytest.mark.parametrize(("p", "names"), [(1, list(SERIES)), (2, ["gaps", "many gaps", "short"])])
def test_equals_a_naive_filter_s_maximum(spark, p, names):
    models = {r.series: r for r in exact.fit_exact(frame(spark, {n: SERIES[n] for n in names}), "y", "hour", p, ["series"]).collect()}
    assert set(models) == set(names)
    for name in names:
        rows, r = SERIES[name], models[name]
        assert r.n == len(rows) and r.level == rows[-1][1]
        if name == "short":
            assert r.status == "too_short" and r.ar == [0.0] * p
            continue
        value, sigma2, state = naive(rows, np.array(r.ar))
        assert abs(-2 * r.loglik - value) < 1e-6 * abs(value) and abs(r.sigma2 - sigma2) < 1e-6
        np.testing.assert_allclose(r.recent, state[1:], atol=1e-7)
        for k in range(p):  # no way up from there
            for h in (1e-4, -1e-4, 0.02, -0.02):
                beside = np.array(r.ar)
                beside[k] += h
                assert naive(rows, beside)[0] > value - 1e-7


@pytest.mark.parametrize("p", [1, 3])
def test_derivatives_equal_differences(p):
    rng = np.random.default_rng(p)
    n = 4
    phi = np.tile([0.4, -0.2, 0.1][:p], (n, 1))
    known = np.array([True, False, True, False])
    start = rng.normal(size=(n, p + 1))
    hours = rng.integers(1, 6, (n, 7))
    hours[2, 5:] = 0
    levels = rng.normal(size=(n, 7))
    own = rng.random((n, 7)) < 0.8

    def values(x):
        sums, _ = exact.filtered(x, known, start, hours, levels, own)
        return sums

    found = values(phi)
    for k in range(p):
        h = np.zeros(p)
        h[k] = 1e-6
        up, down = values(phi + h), values(phi - h)
        np.testing.assert_allclose(found["ds"][:, k], (up["s"] - down["s"]) / 2e-6, rtol=1e-4, atol=1e-6)
        np.testing.assert_allclose(found["dd"][:, k], (up["d"] - down["d"]) / 2e-6, rtol=1e-4, atol=1e-6)


def test_a_stretch_without_known_states_is_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(exact, "ROUNDS", 5)
    monkeypatch.setattr(exact, "PIECE", 40)
    monkeypatch.setattr(exact, "BURN_IN", 25)
    rows = simulated(800, [0.5], 9, 0.6)
    (r,) = exact.fit_exact(frame(spark, {"gaps": rows}), "y", "hour", 2, ["series"]).collect()
    value, _, _ = naive(rows, np.array(r.ar))
    assert abs(-2 * r.loglik - value) < 1e-4 * abs(value)


def test_regular_hours_are_sums_only(spark):
    """One long run has a window of its first hours only, whatever its length."""
    rows = exact._lagged(frame(spark, {"whole": simulated(5000, [0.5, 0.2], 1)}), "y", "hour", 2, ["series"])
    (window,) = exact._windows(rows, 2, ["series"]).collect()
    assert len(window.t) == 3 and window.start is None


def test_forecasts_from_the_filter_s_state(spark, monkeypatch):
    monkeypatch.setattr(exact, "ROUNDS", 3)
    model = exact.fit_exact(frame(spark, {"gap at the end": SERIES["gap at the end"]}), "y", "hour", 1, ["series"])
    (r,) = model.collect()
    got = [x.yhat for x in fc.forecast(model, 3, ["series"]).orderBy("step").collect()]
    level, d, want = r.level, r.recent[0], []
    for _ in range(3):
        d *= r.ar[0]
        level += d
        want.append(level)
    np.testing.assert_allclose(got, want)


def test_constant_series(spark, monkeypatch):
    monkeypatch.setattr(exact, "ROUNDS", 3)
    (r,) = exact.fit_exact(frame(spark, {"gaps": [(t, 5.0) for t in range(40) if t % 9]}), "y", "hour", 2, ["series"]).collect()
    assert r.status == "fitted" and all(np.isfinite(r.ar)) and r.recent == [0.0, 0.0]
