from __future__ import annotations

import numpy as np
import pytest

from gridspan.operators import forecast as fc
from gridspan.operators import ordering, recursion


def simulated(n, ar, ma, seed):
    rng = np.random.default_rng(seed)
    e, d = rng.normal(size=n + 50), np.zeros(n + 50)
    for t in range(max(len(ar), len(ma)), n + 50):
        d[t] = e[t] + sum(a * d[t - i] for i, a in enumerate(ar, 1)) + sum(m * e[t - j] for j, m in enumerate(ma, 1))
    return 20 + np.cumsum(d[50:])


def residuals(y, ar, ma):
    """One after the other, with zeros before the start."""
    d, e = np.diff(y), []
    for t in range(len(d)):
        x = d[t]
        x -= sum(a * d[t - i] for i, a in enumerate(ar, 1) if t >= i)
        x -= sum(m * e[t - j] for j, m in enumerate(ma, 1) if t >= j)
        e.append(x)
    return np.array(e)


def frame(spark, series):
    rows = [(name, t, float(y)) for name, own in series.items() for t, y in enumerate(own)]
    df = spark.createDataFrame(rows, "series string, t long, y double").repartition(4)
    return ordering.with_position(df, ["t"], ["series"])


SERIES = {"a": simulated(400, [0.5], [0.4], 1), "b": simulated(150, [-0.3], [0.6], 2), "d": [1.0, 2.0, 4.0]}


@pytest.mark.parametrize(("p", "q", "chunk"), [(1, 1, 16), (2, 2, 32)])
def test_equals_the_sequential_recursion_s_minimum(spark, monkeypatch, p, q, chunk):
    """Whatever the chunks: the same sum of squares and shocks, and no way down from there."""
    monkeypatch.setattr(recursion, "CHUNK", chunk)
    got = {r.series: r for r in recursion.fit_recursive(frame(spark, SERIES), "y", p, q, ["series"]).collect()}
    assert set(got) == set(SERIES) and got["d"].status == "too_short" and not any(got["d"].ma)
    for name in ("a", "b"):
        r, y = got[name], SERIES[name]
        both = np.array([*r.ar, *r.ma])
        e = residuals(y, r.ar, r.ma)
        assert r.sse == pytest.approx(e @ e, rel=1e-9)
        np.testing.assert_allclose(r.shocks, e[::-1][:q], rtol=1e-7, atol=1e-9)
        np.testing.assert_allclose(r.recent, np.diff(y)[::-1][:p])
        for k in range(p + q):
            for h in (1e-3, -1e-3):
                beside = both.copy()
                beside[k] += h
                x = residuals(y, beside[:p], beside[p:])
                assert x @ x > r.sse - 1e-9


def test_normal_equations_equal_derivatives():
    rng = np.random.default_rng(0)
    y, ar, ma = np.cumsum(rng.normal(size=60)), np.array([0.4, -0.1]), np.array([0.3])
    d = np.diff(y)
    e, w, v = recursion.series_of(np.concatenate([np.zeros(3), d])[1:], 2, ar, ma, np.zeros((3, 1)))
    np.testing.assert_allclose(e, residuals(y, ar, ma))
    z = []
    for k in range(3):
        up, down = (np.array([*ar, *ma]) for _ in range(2))
        up[k] += 1e-6
        down[k] -= 1e-6
        z.append((residuals(y, down[:2], down[2:]) - residuals(y, up[:2], up[2:])) / 2e-6)
    z = np.stack(z, axis=1)
    pad = [np.concatenate([np.zeros(3), x]) for x in (e, w, v)]
    named = dict(zip("ewv", pad))
    sums = {k: recursion._lagged(named[k[0]], named[k[1]], 3, 3) for k in ("ww", "vv", "wv", "vw", "ew", "ev")}
    last = np.stack([x[::-1][:4] for x in (w, v)])
    a, b = recursion.gram(sums, last, 2, 1)
    np.testing.assert_allclose(a, z.T @ z, rtol=1e-5, atol=1e-6)
    np.testing.assert_allclose(b, z.T @ e, rtol=1e-5, atol=1e-6)


def test_transition_is_the_recursion_without_input():
    ma, state = np.array([0.5, -0.2]), np.arange(6.0).reshape(3, 2)
    values = recursion.series_of(np.zeros(9), 2, np.zeros(2), ma, state)
    np.testing.assert_allclose(recursion.ends(values, state).ravel(), recursion.transition(ma, 7) @ state.ravel())


def test_a_long_series_is_worked_on_in_many_chunks(spark, monkeypatch):
    """Better than the start it is given, and forecasts go on from its state."""
    monkeypatch.setattr(recursion, "CHUNK", 256)
    y = simulated(5000, [0.6], [0.5], 7)
    rows = frame(spark, {"long": y})
    assert recursion._chunks(rows, "y", 5, ["series"]).count() == 20
    (r,) = recursion.fit_recursive(rows, "y", 1, 1, ["series"]).collect()
    first = fc.fit_arima(rows, "y", 1, 1, ["series"]).first()
    start = residuals(y, first.ar, first.ma)
    assert r.sse <= start @ start and abs(r.ar[0] - 0.6) < 0.06 and abs(r.ma[0] - 0.5) < 0.06
    model = spark.createDataFrame([r])
    got = [x.yhat for x in fc.forecast(model, 2, ["series"]).orderBy("step").collect()]
    d1 = r.ar[0] * r.recent[0] + r.ma[0] * r.shocks[0]
    np.testing.assert_allclose(got, [y[-1] + d1, y[-1] + d1 + r.ar[0] * d1])
