from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.operators import forecast as fc
from gridspan.operators import ordering
from gridspan.plans import forecasting

START = datetime(2025, 1, 1)


def series(spark, values, name="a", gaps=()):
    cells, hour = [], 0
    for v in values:
        while hour in gaps:
            hour += 1
        cells.append((name, START + timedelta(hours=hour), None if v is None else float(v)))
        hour += 1
    return spark.createDataFrame(cells, "series string, timestamp timestamp_ntz, y double")


def noisy(n, seed):
    rng = np.random.default_rng(seed)
    hours = np.arange(n)
    return 100 + 10 * np.sin(hours * 2 * np.pi / 24) + rng.normal(size=n).cumsum()


def positions(df):
    rows = ordering.with_position(df, ["timestamp"], by=["series"])
    return rows


@pytest.mark.parametrize("n, train", [(10, 8), (11, 8), (1, 0), (5, 4)])
def test_split_sizes(spark, n, train):
    rows = ordering.time_split(series(spark, range(n)).orderBy(F.rand(1)), ["timestamp"], ["series"])
    assert rows.filter("is_train").count() == train
    assert [r.y for r in rows.orderBy("pos").collect()] == list(range(n))


def test_positions_with_missing_keys_and_times(spark):
    df = spark.createDataFrame(
        [(None, None, 1), (None, START, 2), ("a", START, 3), (None, START + timedelta(days=3), 4)],
        "series string, timestamp timestamp_ntz, i int",
    )
    rows = ordering.with_position(df, ["timestamp"], by=["series"]).collect()
    assert {r.i: (r.pos, r.n) for r in rows} == {1: (3, 3), 2: (1, 3), 3: (1, 1), 4: (2, 3)}


def test_positions_without_a_series_column(spark):
    df = series(spark, noisy(200, 1))
    rows = ordering.with_position(df, ["timestamp"]).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 201))
    assert [r.timestamp for r in rows] == sorted(r.timestamp for r in rows)


@pytest.mark.parametrize("chunk", [7, 50, 4096])
def test_lags_do_not_depend_on_the_chunk(spark, chunk):
    values = noisy(120, 2)
    rows = ordering.lag_features(
        series(spark, values, gaps={5, 6, 40}), "y", ["timestamp"], 5, ["series"], chunk=chunk
    ).orderBy("pos").toPandas()
    diff = pd.Series(values).diff()
    assert len(rows) == 120
    np.testing.assert_allclose(rows["diff"], diff)
    for k in range(1, 6):
        np.testing.assert_allclose(rows[f"lag_{k}"], diff.shift(k))


def test_lag_windows_are_bounded(spark):
    rows = ordering.lag_features(series(spark, noisy(60, 3)), "y", ["timestamp"], 5, chunk=10)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [lag(" in line]
    assert windows and all("_chunk" in line for line in windows)


def design(d, p, start):
    """Rows t = start..n of lags 1..p, for 1-based differences."""
    t = np.arange(start, len(d) + 1)
    return np.column_stack([d[t - 1 - k] for k in range(1, p + 1)]), d[t - 1]


def by_least_squares(values, p, q):
    d = np.diff(values)
    if q == 0:
        x, y = design(d, p, p + 1)
        return np.linalg.lstsq(x, y, rcond=None)[0], np.zeros(0), d, np.zeros(0)
    depth, long = p + 2 * q, p + q
    x, y = design(d, long, depth + 1)
    a = np.linalg.lstsq(x, y, rcond=None)[0]
    e = np.full(len(d), np.nan)
    for t in range(long, len(d)):
        e[t] = d[t] - a @ d[t - long : t][::-1]
    t = np.arange(depth, len(d))
    x = np.column_stack([d[t - k] for k in range(1, p + 1)] + [e[t - k] for k in range(1, q + 1)])
    b = np.linalg.lstsq(x, d[t], rcond=None)[0]
    return b[:p], b[p:], d, e


def naive_forecast(values, p, q, steps):
    ar, ma, d, e = by_least_squares(values, p, q)
    d, e = list(d), list(e) if q else []
    level, out = values[-1], []
    for _ in range(steps):
        move = sum(ar[k] * d[-1 - k] for k in range(p)) + sum(ma[k] * e[-1 - k] for k in range(q))
        d.append(move)
        e.append(0.0)
        level += move
        out.append(level)
    return out


@pytest.mark.parametrize("p, q, n, chunk", [
    (1, 0, 60, 4096), (5, 0, 300, 32), (5, 0, 300, 4096), (2, 1, 300, 40), (3, 2, 300, 4096),
    (168, 1, 900, 256), (168, 1, 900, 4096),
])
def test_fit_and_forecast_equal_numpy(spark, p, q, n, chunk):
    values = noisy(n, p + q)
    rows = positions(series(spark, values, gaps={3, 50}))
    models = fc.fit_arima(rows, "y", p, q, ["series"], chunk=chunk)
    model = models.first()
    ar, ma, _, _ = by_least_squares(values, p, q)
    np.testing.assert_allclose(model.ar, ar, rtol=1e-5, atol=1e-6)
    np.testing.assert_allclose(model.ma, ma, rtol=1e-5, atol=1e-6)
    ahead = fc.forecast(models, 30, ["series"]).orderBy("step").collect()
    np.testing.assert_allclose(
        [r.yhat for r in ahead], naive_forecast(values, p, q, 30), rtol=1e-5
    )


def test_noiseless_ar1_is_recovered(spark):
    d, values = 1.0, [0.0]
    for _ in range(40):
        values.append(values[-1] + d)
        d *= -0.7
    model = fc.fit_arima(positions(series(spark, values)), "y", 1, 0, ["series"]).first()
    assert model.ar[0] == pytest.approx(-0.7, abs=1e-9)


@pytest.mark.parametrize("values", [[5.0] * 50, [1.0, 2.0], [3.0]])
def test_constant_and_short_series_keep_their_level(spark, values):
    models = fc.fit_arima(positions(series(spark, values)), "y", 5, 0, ["series"])
    assert [r.yhat for r in fc.forecast(models, 3, ["series"]).collect()] == [values[-1]] * 3


def test_many_series_with_their_own_horizon(spark):
    frames = [series(spark, noisy(n, n), name=f"s{n}") for n in (40, 80, 120)]
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2])
    placed = forecasting.placed(rows, "y", ["series"])
    held = forecasting.holdout_forecast(placed, "y", ["series"], (2, 1, 0))
    assert {r.series: r["count"] for r in held.groupBy("series").count().collect()} == {
        "s40": 8, "s80": 16, "s120": 24,
    }
    for n in (40, 80, 120):
        values, cut = noisy(n, n), int(n * 0.8)
        yhat = [r.yhat for r in held.filter(f"series = 's{n}'").orderBy("step").collect()]
        np.testing.assert_allclose(yhat, naive_forecast(values[:cut], 2, 0, n - cut), rtol=1e-6)


def test_missing_observations_take_no_position(spark):
    values = list(noisy(50, 9))
    holed = values[:20] + [None] + values[20:]
    whole = forecasting.placed(series(spark, values), "y", ["series"])
    gapped = forecasting.placed(series(spark, holed), "y", ["series"])
    a, b = (
        forecasting.train_models(rows, "y", ["series"], (2, 1, 0)).first().ar
        for rows in (whole, gapped)
    )
    np.testing.assert_allclose(a, b)


def test_only_first_differences(spark):
    placed = forecasting.placed(series(spark, range(20)), "y", ["series"])
    with pytest.raises(ValueError):
        forecasting.train_models(placed, "y", ["series"], (1, 2, 0))


def test_error_is_named_for_what_it_is(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "y double, yhat double")
    row = fc.forecast_error(df, "y", "yhat").first()
    assert (row.n, row.mse, row.rmse) == (2, 5.0, 5.0**0.5)


def test_future_hours_start_after_the_last_point(spark):
    rows = fc.future_hours(series(spark, range(5)), "timestamp", 720, ["series"]).orderBy("step")
    stamps = [r.timestamp for r in rows.collect()]
    assert len(stamps) == 720
    assert stamps[0] == START + timedelta(hours=5) and stamps[-1] == START + timedelta(hours=724)


def test_too_short_series_show_their_status(spark, instant):
    start = datetime(2025, 1, 1)
    rows = [("long", start + timedelta(hours=i), float(i * i % 17)) for i in range(60)]
    rows += [("short", start + timedelta(hours=i), float(i)) for i in range(6)]
    series = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, v double")
    placed = forecasting.placed(series, "v", ["series"])
    runs = {r.series: r for r in forecasting.score(placed, "v", ["series"], instant).collect()}
    assert (runs["long"].status, runs["short"].status) == ("fitted", "too_short")
    assert runs["long"].mse is not None and runs["short"].mse is None
    held_out = forecasting.holdout_forecast(placed, "v", ["series"])
    assert {r.series for r in held_out.collect()} == {"long"}


def test_models_and_runs_round_trip(spark, store, instant):
    placed = forecasting.placed(series(spark, noisy(60, 4)), "y", ["series"])
    models = forecasting.train_models(placed, "y", ["series"], schemas.SHORT_ORDER)
    forecasting.save_models(store, models)
    loaded = forecasting.load_models(store)
    a = forecasting.forecast_ahead(loaded, placed, ["series"], steps=5).orderBy("step").collect()
    b = forecasting.forecast_ahead(models, placed, ["series"], steps=5).orderBy("step").collect()
    assert a == b and a[0].timestamp == START + timedelta(hours=60)
    terms = fc.coefficients(loaded, ["series"]).orderBy("lag").collect()
    assert [(t.term, t.lag) for t in terms] == [("ar", k) for k in range(1, 6)]
    forecasting.log_runs(store, forecasting.score(placed, "y", ["series"], instant))
    run = store.read(schemas.FORECAST_RUNS, schemas.FORECAST_RUN_SCHEMA).first()
    assert (run.p, run.d, run.q, run.train_size, run.test_size) == (5, 1, 0, 48, 12)
    assert run.rmse == pytest.approx(run.mse**0.5)
    test = forecasting.test_part(placed)
    chart = fc.actual_vs_forecast(
        test, forecasting.forecast_ahead(loaded, placed, ["series"], steps=5),
        ["series"], "timestamp", "y",
    )
    assert {r.kind: r["count"] for r in chart.groupBy("kind").count().collect()} == {
        "actual": 12, "forecast": 5,
    }


def test_head_tail(spark):
    df = series(spark, range(20))
    rows = ordering.head_tail(df, ["timestamp"], 5)
    assert sorted(r.y for r in rows.filter("part = 'head'").collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.y for r in rows.filter("part = 'tail'").collect()) == [15, 16, 17, 18, 19]
    assert "TakeOrderedAndProject" in rows._jdf.queryExecution().executedPlan().toString()


def test_a_time_with_most_rows_is_spread_over_tasks(spark):
    """Nine tenths of the rows have one time and one series; no range holds much more than its share."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("series"),
        F.when(F.col("id") % 10 != 0, F.lit(START)).otherwise(F.lit(START) + F.make_dt_interval(F.col("id").cast("int"))).alias("timestamp"),
        F.col("id").cast("double").alias("y"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = ordering.in_ranges(df, ["timestamp"], ["series"])
        sizes = [r["count"] for r in ranges.groupBy(F.shiftright("_id", 33)).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    rows = ordering.with_position(df, ["timestamp"], ["series"])
    n = {r["series"]: r["count"] for r in df.groupBy("series").count().collect()}
    got = rows.groupBy("series").agg(F.count_distinct("pos").alias("d"), F.min("pos"), F.max("pos"), F.max("n")).collect()
    assert {r["series"]: tuple(r)[1:] for r in got} == {s: (c, 1, c, c) for s, c in n.items()}


@pytest.mark.parametrize("p", [1, 3, 8])
def test_few_terms_by_built_in_sums(spark, p):
    """Equal to least squares on each series' own lags; odd series among them."""
    cells, want = {}, {}
    for i, values in enumerate([noisy(90, 1), noisy(40, 2), np.full(30, 7.0), np.arange(30.0), noisy(p + 1, 4), noisy(p + 2, 5), [3.0]]):
        cells[f"s{i}"] = np.asarray(values, float)
        d = np.diff(cells[f"s{i}"])
        x = np.array([d[t - p : t][::-1] for t in range(p, len(d))]).reshape(-1, p)
        want[f"s{i}"] = np.linalg.lstsq(x, d[p:], rcond=None)[0] if len(x) else np.zeros(p)
    frame = None
    for name, values in cells.items():
        own = series(spark, values, name)
        frame = own if frame is None else frame.unionByName(own)
    models = fc.fit_arima(positions(frame), "y", p, 0, ["series"], chunk=16)
    plan = models._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInPandas" in plan and "SortAggregate" not in plan
    for r in models.collect():
        values = cells[r.series]
        assert r.n == len(values) and r.level == values[-1]
        assert r.status == ("fitted" if len(values) - 1 > p else "too_short")
        np.testing.assert_allclose(r.recent, (list(np.diff(values)[::-1]) + [0.0] * p)[:p])
        if r.status == "fitted" and len(values) - 1 >= 2 * p:
            np.testing.assert_allclose(r.ar, want[r.series], atol=1e-6)
        assert r.solver == ("none" if r.status == "too_short" else "least_norm" if r.series in ("s2", "s3") and (p > 1 or r.series == "s2") else r.solver)
