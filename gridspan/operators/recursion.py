"""ARIMA(p, 1, q) by least squares on the residuals' own recursion, however long a series is.

The residuals e[t] = d[t] - ar . d[t-1..] - ma . e[t-1..] of the differences d, and the two
series their derivatives are made of (w, the differences, and v, the residuals, each passed
through the MA recursion), are one linear recurrence. What a chunk of a series does to the
last values it is handed is an affine map, known without them; maps compose, so a prefix over
the chunks of a series gives the state each chunk starts from, and all chunks are worked on
at once. Sums of lagged products of the three series then are the normal equations of a
Gauss-Newton step; steps that don't help are halved.

Differences and residuals before a series' start count as 0. A series with no more
observations than 2 (p + q) + 2 is 'too_short' and keeps coefficients of 0.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan.operators.forecast import fit_arima
from gridspan.operators.ordering import with_halo
from gridspan.session import materialize

CHUNK = 4096
ROUNDS, CLOSE = 30, 1e-6

# The maps below carry this module's helpers with them, so executors need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def passed(u: np.ndarray, ma: np.ndarray, before: np.ndarray) -> np.ndarray:
    """y[t] = u[t] - ma . y[t-1..]; `before` has the values before the first, newest first."""
    weights, last, out = ma.tolist(), before.tolist(), []
    for x in u.tolist():
        for weight, y in zip(weights, last):
            x -= weight * y
        out.append(x)
        last = [x, *last[:-1]]
    return np.array(out)


def series_of(d: np.ndarray, p: int, ar: np.ndarray, ma: np.ndarray, state: np.ndarray) -> list[np.ndarray]:
    """e, w and v of differences that have `p` earlier ones in front; `state` is theirs before."""
    own = d[p:]
    u = own.copy()
    for i in range(1, p + 1):
        u -= ar[i - 1] * d[p - i : len(d) - i]
    e = passed(u, ma, state[0])
    return [e, passed(own, ma, state[1]), passed(e, ma, state[2])]


def ends(values: list[np.ndarray], state: np.ndarray) -> np.ndarray:
    """The last values of each series, newest first (3 x q)."""
    q = state.shape[1]
    return np.stack([np.concatenate([s[::-1], x])[-q:][::-1] for s, x in zip(state, values)])


def transition(ma: np.ndarray, steps: int) -> np.ndarray:
    """What so many steps without input make of a state, as a matrix."""
    q = len(ma)
    one = np.zeros((3 * q, 3 * q))
    for k in range(3):
        one[k * q, k * q : (k + 1) * q] = -ma
        for j in range(1, q):
            one[k * q + j, k * q + j - 1] = 1
    one[2 * q, :q] = -ma  # v takes in the residual of the same step
    return np.linalg.matrix_power(one, steps)


def _chunks(df: DataFrame, value: str, depth: int, by: Sequence[str]) -> DataFrame:
    """Stored chunks (by, chunk, first, y, n): levels, with `depth` earlier ones where there are.

    `first` is the position of the first level of the chunk's own.
    """
    rows = df.select(*by, "pos", "n", F.col(value).cast("double").alias("_y"))
    rows = with_halo(rows, depth, by, max(CHUNK, depth + 1))
    level = F.struct("pos", "_y")
    found = rows.groupBy(*by, "_chunk").agg(
        F.sort_array(F.collect_list(level)).alias("e"), F.min(F.when(F.col("_own"), F.col("pos"))).alias("first"),
        F.max("n").alias("n"),
    )
    found = found.filter("first IS NOT NULL").select(
        *by, F.col("_chunk").alias("chunk"), "first", F.col("e._y").alias("y"), "n"
    )
    return materialize(found, "recursion-chunks")


def _lagged(x: np.ndarray, y: np.ndarray, at: int, lags: int) -> np.ndarray:
    """Sums over own t of x[t] y[t-k], for k to `lags`."""
    return np.array([x[at:] @ y[at - k : len(y) - k] for k in range(lags + 1)])


def gram(sums: dict[str, np.ndarray], last: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations of a step out of lagged sums and the last values of w and v."""
    depth = p + q

    def shifted(first_row: np.ndarray, first_column: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        g = np.empty((depth + 1, depth + 1))
        g[0], g[:, 0] = first_row, first_column
        for i in range(depth):
            g[i + 1, 1:] = g[i, :-1] - a[i] * b[:-1]
        return g

    w, v = last
    ww = shifted(sums["ww"], sums["ww"], w, w)
    vv = shifted(sums["vv"], sums["vv"], v, v)
    wv = shifted(sums["wv"], sums["vw"], w, v)
    ar, ma = slice(1, p + 1), slice(1, q + 1)
    a = np.block([[ww[ar, ar], wv[ar, ma]], [wv[ar, ma].T, vv[ma, ma]]])
    return a, np.concatenate([sums["ew"][ar], sums["ev"][ma]])


def fit_recursive(df: DataFrame, value: str, p: int, q: int, by: Sequence[str]) -> DataFrame:
    """One model row per series, as `forecast.fit_arima` gives, with the sum of squares `sse`.

    `df` holds one row per observation with its `pos` in the series and the length `n`, for
    q of at least 1.
    """
    names, depth = list(by), p + q
    types = dict(df.dtypes)
    key = ", ".join(f"`{b}` {types[b]}" for b in by)
    # The recursion of a chunk runs from `depth` differences before its own on, which need p more.
    halo = depth + p + 1
    chunks = _chunks(df, value, halo, by)
    start = fit_arima(df, value, p, q, by)
    state = start.select(
        *by, "n", "level", "recent", F.concat("ar", "ma").alias("best"), F.concat("ar", "ma").alias("trial"),
        F.transform(F.concat("ar", "ma"), lambda x: x * 0).alias("step"), F.lit(float("inf")).alias("sse"),
        F.array(*[F.lit(0.0)] * q).alias("shocks"), (F.col("n") <= 2 * depth + 2).alias("done"),
    )
    state = materialize(state, "recursion-state")

    def cut(first: int, y: np.ndarray) -> tuple[np.ndarray, int]:
        """Differences from `halo` - 1 before the chunk's own on, zeros before the series, and the own ones' number."""
        d = np.diff(np.asarray(y, float))
        if first > 1:
            own = len(y) - min(halo, first - 1)
        else:
            own = len(y) - 1  # the first level has no difference
        return np.concatenate([np.zeros(depth + p + own - len(d)), d]), own

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What each chunk makes of a state `depth` steps before its own to one so before its end."""
        for pdf in batches:
            out = pdf[[*names, "chunk"]].copy()
            shifts, matrices = [], []
            for first, y, trial in zip(pdf["first"], pdf["y"], pdf["trial"]):
                d, own = cut(first, y)
                both = np.asarray(trial, float)
                zero = np.zeros((3, q))
                values = series_of(d[: len(d) - depth], p, both[:p], both[p:], zero)
                shifts.append(ends(values, zero).ravel())
                matrices.append(transition(both[p:], own).ravel())
            out["shift"], out["matrix"] = shifts, matrices
            yield out

    def prefix(pdf: pd.DataFrame) -> pd.DataFrame:
        """The state each chunk of a series starts from; a row a chunk, whatever its length."""
        pdf = pdf.sort_values("chunk")
        states, now = [], np.zeros(3 * q)
        for shift, matrix in zip(pdf["shift"], pdf["matrix"]):
            states.append(now)
            now = np.asarray(shift, float) + np.asarray(matrix, float).reshape(3 * q, 3 * q) @ now
        out = pdf[[*names, "chunk"]].copy()
        out["start"] = states
        return out

    kinds = ["ww", "vv", "wv", "vw", "ew", "ev"]
    width = len(kinds) * (depth + 1) + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[names].copy()
            flat, last, shocks = [], [], []
            for first, y, trial, begin, n in zip(pdf["first"], pdf["y"], pdf["trial"], pdf["start"], pdf["n"]):
                d, own = cut(first, y)
                both = np.asarray(trial, float)
                e, w, v = series_of(d, p, both[:p], both[p:], np.asarray(begin, float).reshape(3, q))
                by_name = {"e": e, "w": w, "v": v}
                # A trial that isn't invertible may leave the numbers' range; it is given up.
                with np.errstate(over="ignore", invalid="ignore"):
                    parts = [_lagged(by_name[k[0]], by_name[k[1]], depth, depth) for k in kinds]
                    flat.append(np.concatenate([*parts, [e[depth:] @ e[depth:]]]))
                ended = first + len(y) - min(halo, first - 1) - 1 == n
                tail = [x[::-1][: depth + 1] for x in (w, v)]
                last.append(np.concatenate(tail) if ended else None)
                shocks.append(e[::-1][:q] if ended else None)
            out["sums"], out["last"], out["shocks"] = flat, last, shocks
            yield out

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best, trial, steps, sse, shocks, done = [], [], [], [], [], []
            for r in pdf.itertuples(index=False):
                found = np.asarray(r.sums, float)
                tried = np.asarray(r.trial, float)
                if found[-1] < r.sse:
                    parts = dict(zip(kinds, found[:-1].reshape(len(kinds), depth + 1)))
                    a, b = gram(parts, np.asarray(r.last, float).reshape(2, depth + 1), p, q)
                    ridge = 1e-12 * np.trace(a) + 1e-300
                    step = np.linalg.solve(a + ridge * np.eye(depth), b)
                    best.append(tried)
                    sse.append(found[-1])
                    shocks.append(np.asarray(r.ended, float))
                else:
                    step = np.asarray(r.step, float) / 2
                    best.append(np.asarray(r.best, float))
                    sse.append(r.sse)
                    shocks.append(np.asarray(r.shocks, float))
                steps.append(step)
                trial.append(best[-1] + step)
                done.append(bool(np.abs(step).max() < CLOSE))
            out = pdf[[*names, "n", "level", "recent"]].copy()
            out["best"], out["trial"], out["step"], out["sse"] = best, trial, steps, sse
            out["shocks"], out["done"] = shocks, done
            yield out

    for _ in range(ROUNDS):
        open_ = state.filter("NOT done")
        if open_.isEmpty():
            break
        own = chunks.join(open_.select(*by, "trial"), names)
        affine = own.mapInPandas(maps, f"{key}, chunk long, shift array<double>, matrix array<double>")
        starts = affine.groupBy(*by).applyInPandas(prefix, f"{key}, chunk long, start array<double>")
        parts = own.join(starts, [*names, "chunk"]).mapInPandas(
            sums, f"{key}, sums array<double>, last array<double>, shocks array<double>"
        )
        total = parts.groupBy(*by).agg(
            F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"),
            F.max("last").alias("last"), F.max("shocks").alias("ended"),
        )
        moved = open_.join(total, names).mapInPandas(update, state.schema)
        state = materialize(state.filter("done").unionByName(moved), "recursion-state")

    short = F.col("n") <= 2 * depth + 2
    none = F.array().cast("array<double>")
    zeros = F.transform("best", lambda x: x * 0)
    coefficients = F.when(short, zeros).otherwise(F.col("best"))
    return state.select(
        *by, F.lit(p).alias("p"), F.lit(q).alias("q"), "n", "level",
        F.slice(coefficients, 1, p).alias("ar") if p else none.alias("ar"),
        F.slice(coefficients, p + 1, q).alias("ma"), "recent", "shocks",
        F.when(short, "too_short").otherwise("fitted").alias("status"), F.lit("gauss_newton").alias("solver"),
        F.when(~short, F.col("sse")).alias("sse"),
    )
