"""The forecast job: split, fit, score, keep the run and the model, forecast ahead."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.functions import wall_clock
from gridspan.operators import exact, recursion
from gridspan.operators import forecast as fc
from gridspan.operators.ordering import time_split
from gridspan.session import materialize
from gridspan.sinks.store import Store


def placed(
    series: DataFrame, value: str, by: Sequence[str], timestamp: str = "timestamp"
) -> DataFrame:
    """Observations with their position and train/test mark, stored for the steps that follow.

    A missing value is no observation and takes no position. The steps of a forecast
    read this table several times, so it is written once; raw data are not read again.
    """
    observed = series.select(*by, timestamp, F.col(value).cast("double").alias(value))
    observed = materialize(observed.dropna(subset=[value]), "observed")
    return materialize(time_split(observed, [timestamp], by), "placed")


def train_part(rows: DataFrame) -> DataFrame:
    return rows.filter("is_train").withColumn("n", F.col("train_size"))


def test_part(rows: DataFrame) -> DataFrame:
    return rows.filter("NOT is_train")


def part_sizes(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.max("train_size").alias("train_size"),
        F.max(F.col("n") - F.col("train_size")).alias("test_size"),
    )


def holdout_forecast(
    rows: DataFrame,
    value: str,
    by: Sequence[str],
    order: tuple[int, int, int] = schemas.SHORT_ORDER,
    timestamp: str = "timestamp",
) -> DataFrame:
    """Fit on the train part, predict the rest: rows (by, step, timestamp, value, yhat).

    `rows` are as `placed` returns them, here and below. A series too short to fit has none.
    """
    models = train_models(rows, value, by, order).filter("status = 'fitted'")
    return _held_out(models, rows, value, by, timestamp)


def _held_out(
    models: DataFrame, rows: DataFrame, value: str, by: Sequence[str], timestamp: str
) -> DataFrame:
    sizes = part_sizes(rows, by).select(*by, "test_size")
    predicted = fc.forecast(models.join(sizes, list(by)), "test_size", by)
    actual = test_part(rows).withColumn("step", F.col("pos") - F.col("train_size"))
    return actual.join(predicted, [*by, "step"]).select(*by, "step", timestamp, value, "yhat")


def recursive_forecast(
    rows: DataFrame,
    value: str,
    by: Sequence[str],
    order: tuple[int, int, int] = schemas.WEEKLY_ORDER,
    timestamp: str = "timestamp",
) -> DataFrame:
    """As `holdout_forecast`, with MA terms fitted on the residuals' own recursion."""
    p, _, q = order
    models = recursion.fit_recursive(train_part(rows), value, p, q, by).filter("status = 'fitted'")
    return _held_out(models, rows, value, by, timestamp)


def exact_forecast(
    rows: DataFrame, value: str, by: Sequence[str], p: int = schemas.SHORT_ORDER[0], timestamp: str = "timestamp"
) -> DataFrame:
    """As `holdout_forecast`, fitted by exact likelihood and with missing hours as gaps.

    A step is an hour here, whether it was observed or not.
    """
    hour = F.timestamp_diff("HOUR", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(timestamp))
    rows = rows.withColumn("_hour", hour)
    models = exact.fit_exact(train_part(rows), value, "_hour", p, by)
    models = materialize(models.filter("status = 'fitted'"), "exact-models")
    ends = rows.groupBy(*by).agg(
        F.max(F.when(F.col("is_train"), F.col("_hour"))).alias("_last"), F.max("_hour").alias("_end")
    )
    ends = ends.select(*by, "_last", (F.col("_end") - F.col("_last")).alias("_hours"))
    predicted = fc.forecast(models.join(ends.drop("_last"), list(by)), "_hours", by)
    actual = test_part(rows).join(ends.drop("_hours"), list(by))
    actual = actual.withColumn("step", F.col("_hour") - F.col("_last"))
    return actual.join(predicted, [*by, "step"]).select(*by, "step", timestamp, value, "yhat")


def score(
    rows: DataFrame,
    value: str,
    by: Sequence[str],
    instant: datetime,
    order: tuple[int, int, int] = schemas.SHORT_ORDER,
    timestamp: str = "timestamp",
) -> DataFrame:
    """One run record per series: order, sizes, status and, if it could be fitted, error."""
    p, d, q = order
    models = materialize(train_models(rows, value, by, order), "models")
    held_out = _held_out(models.filter("status = 'fitted'"), rows, value, by, timestamp)
    errors = fc.forecast_error(held_out, value, "yhat", by)
    status = models.select(*by, "status")
    runs = part_sizes(rows, by).join(status, list(by), "left").join(errors, list(by), "left")
    return runs.select(
        wall_clock(instant).alias("run_at"),
        F.concat_ws("/", *by).alias("series"),
        F.lit(p).alias("p"),
        F.lit(d).alias("d"),
        F.lit(q).alias("q"),
        "train_size",
        "test_size",
        F.coalesce("status", F.lit("too_short")).alias("status"),
        "mse",
        "rmse",
    )


def log_runs(store: Store, runs: DataFrame) -> None:
    runs.write.mode("append").parquet(store.path(schemas.FORECAST_RUNS))


def save_models(store: Store, models: DataFrame) -> None:
    models.write.mode("overwrite").parquet(store.path(schemas.FORECAST_MODELS))


def load_models(store: Store) -> DataFrame:
    return store.read(schemas.FORECAST_MODELS)


def train_models(
    rows: DataFrame,
    value: str,
    by: Sequence[str],
    order: tuple[int, int, int] = schemas.WEEKLY_ORDER,
) -> DataFrame:
    """Models fitted on the train part of each series."""
    p, d, q = order
    if d != 1:
        raise ValueError("only one order of differencing is supported")
    return fc.fit_arima(train_part(rows), value, p, q, by)


def forecast_ahead(
    models: DataFrame,
    series: DataFrame,
    by: Sequence[str],
    timestamp: str = "timestamp",
    steps: int = schemas.HORIZON,
) -> DataFrame:
    """Rows (by, step, timestamp, yhat), dated from one hour after the series' last point.

    A model fitted on the train part is dated past the test part too, as the source
    job dates it; fit on the whole series for a forecast that starts where it ends.
    """
    dates = fc.future_hours(series, timestamp, steps, by)
    return fc.forecast(models, steps, by).join(dates, [*by, "step"]).select(
        *by, "step", timestamp, "yhat"
    )
