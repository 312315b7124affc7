"""ARIMA(p, 1, q) by least squares, many series at once, one long series in parallel.

With d the first differences, AR terms are a regression of d[t] on d[t-1]..d[t-p].
MA terms follow Hannan and Rissanen: residuals of a long AR fit stand in for the
unknown shocks. Both fits need only inner products of lagged copies of d, and

    sum over t of d[t-i] * d[t-j]  =  C[|i-j|] - first few terms - last few terms,

where C[k] is the sum of d[s] * d[s-k] over the whole series. So the data are read
once: chunks of a series yield partial sums C[0..K] plus the K values at either end,
sums add up per series, and what is left per series is one small linear system.

With few AR terms and no MA terms the products of lags are summed as they are, by built-in
functions; blocks of series are then solved at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan.operators.ordering import positioned_lags, with_halo

STEPS_PER_FRAME = 1024
#: Most AR terms whose products are summed one by one.
FEW_TERMS = 8
SERIES_PER_BLOCK = 256
WORST_CONDITION = 1e13
#: How a well-posed and an ill-posed system are solved.
SOLVERS = ("normal_equations", "least_norm")

# The grouped maps below carry this module's helpers with them, so executors need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _depth(p: int, q: int) -> int:
    """How many lags the fit looks back: the long AR has order p + q."""
    return p if q == 0 else p + 2 * q


def lagged_sums(
    df: DataFrame,
    value: str,
    depth: int,
    by: Sequence[str],
    chunk: int = 4096,
) -> DataFrame:
    """Rows (by, kind, k, value) from a frame with `pos` and `n`, as `with_position` adds.

    kind 'C' is the sum of d[s] * d[s-k]; 'H' is d[k], k from 1; 'T' is the k-th last
    difference, k from 0; 'Y' the last value; 'N' the series length.
    """
    rows = df.select(*by, "pos", "n", F.col(value).cast("double").alias(value))
    rows = with_halo(rows, depth + 1, by, max(chunk, depth + 1))
    names = list(by)

    def partial(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        own = pdf["_own"].to_numpy()
        if not own.any():
            return pd.DataFrame(columns=[*names, "kind", "k", "value"])
        y = pdf[value].to_numpy(float)
        pos = pdf["pos"].to_numpy()
        n = int(pdf["n"].iloc[0])
        d = np.diff(y)
        index = pos[1:] - 1  # 1-based index of each difference
        owned = own[1:]
        out: list[tuple[str, int, float]] = []
        for k in range(min(depth + 1, len(d))):
            here = owned[k:]
            out.append(("C", k, float(d[k:][here] @ d[: len(d) - k][here])))
        for kind, edge in (("H", index), ("T", n - 1 - index)):
            low = 1 if kind == "H" else 0
            near = owned & (edge >= low) & (edge < low + depth)
            out += [(kind, int(k), float(v)) for k, v in zip(edge[near], d[near])]
        if own[-1] and pos[-1] == n:
            out += [("Y", 0, float(y[-1])), ("N", 0, float(n))]
        result = pd.DataFrame(out, columns=["kind", "k", "value"])
        for name, part in zip(names, key):
            result[name] = part
        return result[[*names, "kind", "k", "value"]]

    types = dict(df.dtypes)
    schema = ", ".join(f"`{b}` {types[b]}" for b in by) + ", kind STRING, k INT, value DOUBLE"
    chunks = rows.groupBy(*by, "_chunk")
    partials = chunks.applyInPandas(lambda key, pdf: partial(key[:-1], pdf), schema)
    return partials.groupBy(*by, "kind", "k").agg(F.sum("value").alias("value"))


def _gram(c: np.ndarray, head: np.ndarray, tail: np.ndarray, depth: int) -> np.ndarray:
    """G[i, j] = sum of d[t-i] * d[t-j] for t = depth+1..n and lags 0..depth.

    Row 0 is C less the products that start too early; going one lag further moves the
    window one step back, which adds one product at its start and drops one at its end.
    """
    g = np.empty((depth + 1, depth + 1))
    g[0] = [c[j] - head[j:] @ head[: depth - j] for j in range(depth + 1)]
    g[:, 0] = g[0]
    entering, leaving = head[::-1], tail
    for i in range(depth):
        g[i + 1, 1:] = g[i, :-1] + entering[i] * entering - leaving[i] * leaving
    return g


def _ill_posed(a: np.ndarray) -> bool:
    return not np.linalg.cond(a, 1) < WORST_CONDITION


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normal equations; an ill-posed system (a constant or short series) gets least norm."""
    if _ill_posed(a):
        return np.linalg.pinv(a, rcond=1 / WORST_CONDITION, hermitian=True) @ b
    return np.linalg.solve(a, b)


def fit_from_sums(
    c: np.ndarray, head: np.ndarray, tail: np.ndarray, n: int, p: int, q: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
    """AR coefficients, MA coefficients, the last q shocks of n differences, and the solver.

    `head` is d[1], d[2], ..; `tail` is d[n], d[n-1], ..
    """
    depth = _depth(p, q)
    if n <= depth:
        return np.zeros(p), np.zeros(q), np.zeros(q), "none"
    g = _gram(c, head, tail, depth)
    if q == 0:
        return _solve(g[1:, 1:], g[1:, 0]), np.zeros(0), np.zeros(0), SOLVERS[_ill_posed(g[1:, 1:])]
    long = p + q
    long_ar = _solve(g[1 : long + 1, 1 : long + 1], g[1 : long + 1, 0])
    whiten = np.concatenate([[1.0], -long_ar])
    # Regressors as combinations of lags 1..depth: p lags of d, then q lagged shocks.
    mix = np.zeros((depth + 1, p + q))
    mix[np.arange(1, p + 1), np.arange(p)] = 1.0
    for lag in range(1, q + 1):
        mix[lag : lag + long + 1, p + lag - 1] = whiten
    normal = mix.T @ g @ mix
    both = _solve(normal, mix.T @ g[:, 0])
    shocks = np.array([whiten @ tail[lag : lag + long + 1] for lag in range(q)])
    return both[:p], both[p:], shocks, SOLVERS[_ill_posed(normal)]


def fit_arima(
    df: DataFrame,
    value: str,
    p: int,
    q: int,
    by: Sequence[str],
    chunk: int = 4096,
) -> DataFrame:
    """One model row per series: coefficients and the state a forecast starts from.

    `df` holds one row per observation with its `pos` in the series and the length `n`.
    Columns: by, p, q, n (values seen), level (last value), ar, ma, recent (latest
    differences, newest first), shocks (latest residuals, newest first), status and solver:
    a series with no more differences than lags is 'too_short', its coefficients are 0, and
    an ill-posed one gets the solution of least norm.
    """
    if q == 0 and 0 < p <= FEW_TERMS:
        return _fit_few(df, value, p, by, chunk)
    depth = _depth(p, q)
    sums = lagged_sums(df, value, depth, by, chunk)
    names = list(by)

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = {kind: part.set_index("k")["value"] for kind, part in pdf.groupby("kind")}

        def dense(kind: str, first: int, size: int) -> np.ndarray:
            part = kinds.get(kind, pd.Series(dtype=float))
            return part.reindex(range(first, first + size), fill_value=0.0).to_numpy(float)

        n = int(kinds["N"][0])
        tail = dense("T", 0, depth)
        ar, ma, shocks, solver = fit_from_sums(
            dense("C", 0, depth + 1), dense("H", 1, depth), tail, n - 1, p, q
        )
        row = {**dict(zip(names, key)), "p": p, "q": q, "n": n, "level": kinds["Y"][0]}
        row |= {"ar": ar, "ma": ma, "recent": tail[:p], "shocks": shocks}
        row["status"] = "fitted" if n - 1 > depth else "too_short"
        row["solver"] = solver
        return pd.DataFrame([row])

    return sums.groupBy(*by).applyInPandas(solve, _model_schema(df, by))


def _model_schema(df: DataFrame, by: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"`{b}` {types[b]}" for b in by) + (
        ", p INT, q INT, n BIGINT, level DOUBLE, ar ARRAY<DOUBLE>, ma ARRAY<DOUBLE>, "
        "recent ARRAY<DOUBLE>, shocks ARRAY<DOUBLE>, status STRING, solver STRING"
    )


def _fit_few(df: DataFrame, value: str, p: int, by: Sequence[str], chunk: int) -> DataFrame:
    """AR models of few terms: one grouped sum per pair of lags, then a system per series."""
    rows = df.select(*by, "pos", "n", F.col(value).cast("double").alias("_y"))
    rows = positioned_lags(rows, "_y", p, by, chunk)
    lags = ["diff", *[f"lag_{k}" for k in range(1, p + 1)]]
    # A row without its last lag is not part of the regression.
    usable = F.col(lags[-1]).isNotNull()
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    products = [F.sum(F.when(usable, F.col(lags[i]) * F.col(lags[j]))) for i, j in pairs]
    last = F.col("pos") == F.col("n")
    sums = rows.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.max(F.when(last, F.col("_y"))).alias("level"),
        F.array(*[F.max(F.when(last, F.col(c))) for c in lags[:p]]).alias("recent"),
        F.array(*products).alias("g"),
    )
    names = list(by)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = np.zeros((len(pdf), p + 1, p + 1))
            values = np.array([np.asarray(x, float) for x in pdf["g"]]).reshape(len(pdf), len(pairs))
            for k, (i, j) in enumerate(pairs):
                g[:, i, j] = g[:, j, i] = values[:, k]
            fitted = pdf["n"].to_numpy() - 1 > p
            g[~fitted] = np.eye(p + 1)
            a, b = g[:, 1:, 1:], g[:, 1:, 0]
            # A zero matrix has no inverse that its condition could be taken from.
            singular = np.linalg.matrix_rank(a, hermitian=True) < p
            ill = singular.copy()
            ill[~singular] = ~(np.linalg.cond(a[~singular], 1) < WORST_CONDITION)
            ar = np.zeros((len(pdf), p))
            ar[~ill] = np.linalg.solve(a[~ill], b[~ill][..., None])[..., 0]
            inverse = np.linalg.pinv(a[ill], rcond=1 / WORST_CONDITION, hermitian=True)
            ar[ill] = (inverse @ b[ill][..., None])[..., 0]
            ar[~fitted] = 0.0
            recent = [np.nan_to_num(np.asarray(x, float)) for x in pdf["recent"]]
            out = pdf[names].copy()
            out["p"], out["q"], out["n"], out["level"] = p, 0, pdf["n"], pdf["level"]
            out["ar"], out["ma"] = list(ar), [[]] * len(pdf)
            out["recent"], out["shocks"] = recent, [[]] * len(pdf)
            out["status"] = np.where(fitted, "fitted", "too_short")
            out["solver"] = np.where(fitted, np.where(ill, SOLVERS[1], SOLVERS[0]), "none")
            yield out

    return sums.mapInPandas(solve, _model_schema(df, by))


def coefficients(models: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fitted models as rows (by, term, lag, value), the form they are stored in."""
    terms = [
        models.select(*by, F.lit(term).alias("term"), F.posexplode(term).alias("lag", "value"))
        for term in ("ar", "ma")
    ]
    return terms[0].unionByName(terms[1]).withColumn("lag", F.col("lag") + 1)


def forecast(models: DataFrame, steps: int | str, by: Sequence[str]) -> DataFrame:
    """Rows (by, step, yhat) for step 1..steps after each model's last value.

    `steps` is a number or a column of `models`. The recursion runs over a block of
    series at a time, so its cost per step is one vector operation.
    """
    names = list(by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, same in pdf.groupby(["p", "q"]):
                for first in range(0, len(same), SERIES_PER_BLOCK):
                    yield from _forecast_block(same.iloc[first : first + SERIES_PER_BLOCK], names)

    horizon = F.lit(steps) if isinstance(steps, int) else F.col(steps)
    types = dict(models.dtypes)
    schema = ", ".join(f"`{b}` {types[b]}" for b in by) + ", step BIGINT, yhat DOUBLE"
    models = models.withColumn("_steps", horizon.cast("bigint"))
    # Models are few and their forecasts many: they are dealt out before they fan out.
    tasks = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return models.repartition(tasks, *names).mapInPandas(run, schema)


def _push(history: np.ndarray, newest: np.ndarray) -> np.ndarray:
    """History with the newest value in front and the oldest dropped."""
    return np.column_stack([newest, history])[:, : history.shape[1]]


def _forecast_block(block: pd.DataFrame, names: list[str]) -> Iterator[pd.DataFrame]:
    """Forecasts of some series, in frames of STEPS_PER_FRAME steps each."""
    horizon = block["_steps"].to_numpy(int)
    longest = int(horizon.max())
    ar, ma, recent, shocks = (
        np.stack([np.asarray(v, float) for v in block[c]]) for c in ("ar", "ma", "recent", "shocks")
    )
    level = block["level"].to_numpy(float).copy()
    for first in range(0, longest, STEPS_PER_FRAME):
        steps = np.arange(first, min(first + STEPS_PER_FRAME, longest))
        path = np.empty((len(block), len(steps)))
        for i in range(len(steps)):
            move = (ar * recent).sum(axis=1) + (ma * shocks).sum(axis=1)
            level += move
            path[:, i] = level
            recent = _push(recent, move)
            shocks = _push(shocks, np.zeros(len(block)))  # future shocks are zero on average
        row, at = np.nonzero(steps[None, :] < horizon[:, None])
        out = block[names].iloc[row].reset_index(drop=True)
        out["step"] = steps[at] + 1
        out["yhat"] = path[row, at]
        yield out


def future_hours(df: DataFrame, timestamp: str, steps: int, by: Sequence[str] = ()) -> DataFrame:
    """The `steps` whole hours after each series' last timestamp, as (by, step, timestamp)."""
    last = df.groupBy(*by).agg(F.max(timestamp).alias("_last"))
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    span = F.make_dt_interval(F.lit(0), F.lit(steps))
    hours = F.sequence(F.col("_last") + hour, F.col("_last") + span, hour)
    return last.select(*by, F.posexplode(hours).alias("step", timestamp)).withColumn(
        "step", (F.col("step") + 1).cast("bigint")
    )


def forecast_error(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error and its root, under their own names."""
    squared = F.pow(F.col(actual) - F.col(predicted), 2)
    return df.groupBy(*by).agg(
        F.count(squared).alias("n"),
        F.avg(squared).alias("mse"),
        F.sqrt(F.avg(squared)).alias("rmse"),
    )


def actual_vs_forecast(
    actual: DataFrame, predicted: DataFrame, by: Sequence[str], timestamp: str, value: str
) -> DataFrame:
    """Both series under one another, tagged: the data behind a forecast chart."""
    tagged = [
        frame.select(
            *by, F.lit(tag).alias("kind"), timestamp, F.col(column).alias(value)
        )
        for frame, tag, column in ((actual, "actual", value), (predicted, "forecast", "yhat"))
    ]
    return tagged[0].unionByName(tagged[1])
