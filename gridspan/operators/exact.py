"""ARIMA(p, 1, 0) by exact Gaussian likelihood, gaps in the hours kept.

The state is the level and the last p differences. Where the p + 1 levels before an
observation are known, its prediction error is d[t] less the weighted last differences and
its variance that of a shock: such terms need only sums of products of lags, by built-in
functions over all rows. Other observations (the first of a series, those behind a gap until
p + 1 hours in a row are known again) lie in windows, each of which starts from a known
state or, at a series' start, from the stationary one. A Kalman filter runs over many windows
at once, a gap being one step of as many hours, and carries first derivatives with it. Of
these, sums per series give the gradient and the Fisher information of the likelihood, and
scoring steps, halved where they don't help, lead to its maximum. Every round is one
distributed pass over the windows; series may be as many and as long as there are.

A stretch in which no p + 1 hours in a row are known is one window. From PIECE runs of hours on
it is cut in pieces that see the BURN_IN runs before them, whose effect is below rounding
unless the model is next to a unit root. A missing value is no observation; a series with
no more than 2 p + 2 observations is 'too_short' and keeps coefficients of 0.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspan.operators.ordering import with_halo, with_position
from gridspan.session import materialize

PIECE, BURN_IN = 2000, 200
ROUNDS, CLOSE = 40, 1e-7
#: Shock variance that counts as none.
NOTHING = 1e-20
#: Windows that are filtered at once.
AT_ONCE = 2048

# The maps below carry this module's helpers with them, so executors need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Dual:
    """An array and its derivatives by each of the coefficients (axis 0: the array, then those)."""

    def __init__(self, parts: np.ndarray):
        self.parts = parts

    @staticmethod
    def constant(value: np.ndarray, k: int) -> Dual:
        return Dual(np.concatenate([value[None], np.zeros((k, *value.shape))]))

    def __add__(self, other: Dual) -> Dual:
        return Dual(self.parts + other.parts)

    def __sub__(self, other: Dual) -> Dual:
        return Dual(self.parts - other.parts)

    def product(self, other: Dual, rule: str) -> Dual:
        a, b = self.parts, other.parts
        out = [np.einsum(rule, a[0], b[0])]
        out += [np.einsum(rule, a[i], b[0]) + np.einsum(rule, a[0], b[i]) for i in range(1, len(a))]
        return Dual(np.stack(out))

    def over(self, other: Dual) -> Dual:
        """Divided by a scalar for each window."""
        x, y = self.parts, other.parts.reshape(*other.parts.shape, *[1] * (self.parts.ndim - 2))
        return Dual(np.concatenate([(x[0] / y[0])[None], (x[1:] - x[0] / y[0] * y[1:]) / y[0]]))

    def take(self, rows: np.ndarray) -> Dual:
        return Dual(self.parts[:, rows])


def transition(phi: np.ndarray) -> Dual:
    """One hour's step of (level, differences) for each row of coefficients."""
    n, p = phi.shape
    out = np.zeros((1 + p, n, p + 1, p + 1))
    out[0, :, 0, 0] = 1
    out[0, :, 0, 1:] = out[0, :, 1, 1:] = phi
    for i in range(2, p + 1):
        out[0, :, i, i - 1] = 1
    for k in range(p):
        out[1 + k, :, :2, 1 + k] = 1
    return Dual(out)


def steps(phi: np.ndarray, hours: np.ndarray) -> tuple[Dual, Dual]:
    """Transition and shock variance over so many hours, by doubling."""
    n, p = phi.shape
    a = transition(phi)
    shock = np.zeros((n, p + 1, p + 1))
    shock[:, :2, :2] = 1
    q = Dual.constant(shock, p)
    eye = Dual.constant(np.broadcast_to(np.eye(p + 1), shock.shape).copy(), p)
    total, var = eye, Dual.constant(np.zeros_like(shock), p)
    left = hours.copy()
    while left.any():
        odd = (left % 2 == 1)[:, None, None]
        more = a.product(var, "nij,njk->nik").product(a, "nij,nkj->nik") + q
        total = Dual(np.where(odd, a.product(total, "nij,njk->nik").parts, total.parts))
        var = Dual(np.where(odd, more.parts, var.parts))
        q = a.product(q, "nij,njk->nik").product(a, "nij,nkj->nik") + q
        a = a.product(a, "nij,njk->nik")
        left //= 2
    return total, var


def stationary(phi: np.ndarray) -> Dual:
    """Variance of the differences of a stationary model, in units of the shock's."""
    n, p = phi.shape
    step = transition(phi).parts[:, :, 1:, 1:]
    shock = np.zeros((p, p))
    shock[0, 0] = 1
    kron = np.einsum("nij,nkl->nikjl", step[0], step[0]).reshape(n, p * p, p * p)
    inverse = np.linalg.inv(np.eye(p * p) - kron)
    value = (inverse @ shock.reshape(-1)).reshape(n, p, p)
    parts = [value]
    for d in step[1:]:
        half = np.einsum("nij,njk,nlk->nil", d, value, step[0])
        side = (half + half.transpose(0, 2, 1)).reshape(n, -1, 1)
        parts.append((inverse @ side).reshape(n, p, p))
    out = np.zeros((1 + p, n, p + 1, p + 1))
    out[:, :, 1:, 1:] = np.stack(parts)
    return Dual(out)


def filtered(
    phi: np.ndarray, known: np.ndarray, start: np.ndarray, hours: np.ndarray, levels: np.ndarray, own: np.ndarray
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Sums over each window, and the states they end in.

    `start` (windows x p + 1) is known, or else only its level is and the differences are
    stationary. Event i comes `hours` after the one before and has a level; there is none
    where `hours` is 0, and it counts where `own` is true.
    """
    n, p = phi.shape
    mean = Dual.constant(start, p)
    var = Dual(np.where(known[None, :, None, None], 0.0, stationary(phi).parts))
    sums = {"n": np.zeros(n), "s": np.zeros(n), "d": np.zeros(n), "ds": np.zeros((n, p)),
            "dd": np.zeros((n, p)), "ii": np.zeros((n, p, p)), "jj": np.zeros((n, p, p))}
    for i in range(hours.shape[1]):
        there = hours[:, i] > 0
        if not there.any():
            break
        a, q = steps(phi, hours[:, i])
        new_mean = a.product(mean, "nij,nj->ni")
        new_var = a.product(var, "nij,njk->nik").product(a, "nij,nkj->nik") + q
        f = Dual(new_var.parts[..., 0, 0])
        f = Dual(np.where(there[None], f.parts, Dual.constant(np.ones(n), p).parts))
        v = Dual.constant(levels[:, i], p) - Dual(new_mean.parts[..., 0])
        gain = Dual(new_var.parts[..., 0]).over(f)
        new_mean = new_mean + gain.product(v, "ni,n->ni")
        new_var = new_var - gain.product(Dual(new_var.parts[..., 0]), "ni,nj->nij")
        pick = there[None, :, None]
        mean = Dual(np.where(pick, new_mean.parts, mean.parts))
        var = Dual(np.where(pick[..., None], new_var.parts, var.parts))
        w = (there & own[:, i]).astype(float)
        e, de, var_f, df = v.parts[0], v.parts[1:].T, f.parts[0], f.parts[1:].T
        sums["n"] += w
        sums["s"] += w * e * e / var_f
        sums["d"] += w * np.log(var_f)
        sums["ds"] += (w / var_f)[:, None] * (2 * e[:, None] * de - (e * e / var_f)[:, None] * df)
        sums["dd"] += (w / var_f)[:, None] * df
        sums["ii"] += (w / var_f)[:, None, None] * de[:, :, None] * de[:, None, :]
        sums["jj"] += (w / var_f**2)[:, None, None] * df[:, :, None] * df[:, None, :]
    return sums, mean.parts[0]


def _lagged(df: DataFrame, value: str, hour: str, p: int, by: Sequence[str]) -> DataFrame:
    """Stored observations with their last differences and `_k`, their place in their run.

    A run is a stretch of hours without a gap; places beyond p + 2 count as p + 2.
    """
    rows = df.select(*by, F.col(hour).cast("bigint").alias("_t"), F.col(value).cast("double").alias("_y"))
    rows = with_position(rows.dropna(), ["_t"], by)
    rows = with_halo(rows.withColumn("_run", F.col("_t") - F.col("pos")), p + 1, by)
    past = Window.partitionBy(*by, "_chunk").orderBy("pos")
    behind = [F.coalesce(F.lag("_run", j).over(past) == F.col("_run"), F.lit(False)) for j in range(1, p + 2)]
    changes = [F.lag("_y", j).over(past) - F.lag("_y", j + 1).over(past) for j in range(1, p + 1)]
    rows = rows.select(
        *by, "pos", "n", "_t", "_y", "_run", "_own",
        sum((b.cast("int") for b in behind), F.lit(1)).alias("_k"),
        F.array(F.col("_y") - F.lag("_y", 1).over(past), *changes).alias("_d"),
    )
    return materialize(rows.filter("_own").drop("_own"), "exact-rows")


def _windows(rows: DataFrame, p: int, by: Sequence[str]) -> DataFrame:
    """Stored windows (by, t, y, own, start, at, end).

    Hours and levels of the observations, which of them count, the state the window starts
    from with its hour, if known, and the position of the last observation.
    """
    runs = rows.groupBy(*by, "_run").agg(
        F.min("_t").alias("_from"), F.min("pos").alias("_begin"), F.max("pos").alias("_end")
    )
    size = F.col("_end") - F.col("_begin") + 1
    series = Window.partitionBy(*by).orderBy("_from")
    before = F.lag(size).over(series)
    # A window begins behind a run that is long enough to know the state, or at the start.
    runs = runs.withColumn("_first", before.isNull() | (before > p))
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("_window", F.max(F.when(F.col("_first"), F.col("_from"))).over(so_far))
    numbered = Window.partitionBy(*by, "_window").orderBy("_from")
    runs = runs.withColumn("pos", F.row_number().over(numbered))
    pieces = with_halo(runs, BURN_IN, [*by, "_window"], PIECE).drop("pos")
    pieces = materialize(pieces, "exact-runs")
    keys, window = [*by, "_run"], [*by, "_window", "_chunk"]
    heads = rows.filter(F.col("_k") <= p + 1).select(*keys, "pos", "_t", "_y")
    events = heads.join(pieces.select(*keys, "_window", "_chunk", "_own"), keys)
    event = F.struct("pos", "_t", "_y", "_own")
    found = events.groupBy(*window).agg(F.sort_array(F.collect_list(event)).alias("e"))
    # The last hour of the run before is the start, all of whose last differences are known.
    known = rows.filter(F.col("_k") > p).select(
        *by, F.col("pos").alias("_at"), F.col("_t").alias("at"),
        F.concat(F.array("_y"), F.slice("_d", 1, p)).alias("start"),
    )
    starts = pieces.filter(F.col("_first") & (F.col("_chunk") == 0))
    starts = starts.select(*window, (F.col("_begin") - 1).alias("_at")).join(known, [*by, "_at"])
    found = found.join(starts.drop("_at"), window, "left")
    parts = {"t": "_t", "y": "_y", "own": "_own"}
    columns = [F.col(f"e.{c}").alias(name) for name, c in parts.items()]
    end = F.try_element_at("e", F.lit(-1))["pos"].alias("end")
    return materialize(found.select(*by, *columns, "start", "at", end), "exact-windows")


def _arrays(pdf: pd.DataFrame, p: int) -> tuple[np.ndarray, ...]:
    """known, start, hours, levels and own of some windows, filled up to one length."""
    n, longest = len(pdf), max(map(len, pdf["t"]))
    hours, levels = np.zeros((n, longest), np.int64), np.zeros((n, longest))
    own, start, known = np.zeros((n, longest), bool), np.zeros((n, p + 1)), np.zeros(n, bool)
    for i, (t, y, mine, state, at) in enumerate(zip(pdf["t"], pdf["y"], pdf["own"], pdf["start"], pdf["at"])):
        t, y, mine = np.asarray(t, np.int64), np.asarray(y, float), np.asarray(mine, bool)
        if state is None:  # a series' or a piece's first level is given
            start[i, 0], at, t, y, mine = y[0], t[0], t[1:], y[1:], mine[1:]
        else:
            known[i], start[i] = True, state
        hours[i, : len(t)], levels[i, : len(t)] = np.diff(t, prepend=int(at)), y
        own[i, : len(t)] = mine
    return known, start, hours, levels, own


def _flat(sums: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.reshape(len(x), -1) for x in sums.values()], axis=1)


def _unflat(values: np.ndarray, p: int) -> dict[str, np.ndarray]:
    shapes = {"n": (), "s": (), "d": (), "ds": (p,), "dd": (p,), "ii": (p, p), "jj": (p, p)}
    out, at = {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        out[name] = values[:, at : at + size].reshape(len(values), *shape)
        at += size
    return out


def _regular(g: np.ndarray, phi: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over observations whose past is known, out of products of lags."""
    n, p = phi.shape
    w = np.concatenate([np.ones((n, 1)), -phi], axis=1)
    gw = np.einsum("nij,nj->ni", g, w)
    return {"s": np.einsum("ni,ni->n", gw, w), "ds": -2 * gw[:, 1:], "ii": g[:, 1:, 1:]}


def _is_stationary(phi: np.ndarray) -> np.ndarray:
    step = transition(phi).parts[0][:, 1:, 1:]
    return np.abs(np.linalg.eigvals(step)).max(axis=1) < 1 - 1e-6


def objective(sums: dict[str, np.ndarray], g: np.ndarray, regular: np.ndarray, phi: np.ndarray):
    """Minus twice the log-likelihood but for a constant, its gradient and information."""
    more = _regular(g, phi)
    n = np.maximum(sums["n"] + regular, 1)
    s = np.maximum(sums["s"] + more["s"], 1e-300)
    value = n * np.log(s / n) + sums["d"]
    slope = (n / s)[:, None] * (sums["ds"] + more["ds"]) + sums["dd"]
    information = (2 * n / s)[:, None, None] * (sums["ii"] + more["ii"]) + sums["jj"]
    return value, slope, information, s / n


def fit_exact(df: DataFrame, value: str, hour: str, p: int, by: Sequence[str]) -> DataFrame:
    """One model row per series, as `forecast.fit_arima` gives, with `sigma2` and `loglik`.

    `hour` numbers the hours (or days) of the grid; an hour without row or value is a gap. The
    level and differences a forecast starts from are the filter's for the last observation.
    """
    names = list(by)
    rows = _lagged(df, value, hour, p, by)
    windows = _windows(rows, p, by)
    regular, last = F.col("_k") == p + 2, F.col("pos") == F.col("n")
    products = [F.sum(F.when(regular, F.col("_d")[i] * F.col("_d")[j])) for i in range(p + 1) for j in range(p + 1)]
    nothing = F.array(*[F.lit(0.0)] * p)
    state = rows.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.count_if(regular).cast("double").alias("regular"),
        F.array(*[F.coalesce(x, F.lit(0.0)) for x in products]).alias("g"),
        F.max(F.when(last, F.col("_y"))).alias("level"),
        F.array(*[F.max(F.when(last, F.col("_d")[i])) for i in range(p)]).alias("recent"),
    )
    state = state.select(
        "*", nothing.alias("phi"), nothing.alias("best"), F.lit(float("inf")).alias("lowest"),
        nothing.alias("step"), F.lit(0.0).alias("sigma2"), (F.col("n") <= 2 * p + 2).alias("done"),
    )
    state = materialize(state, "exact-state")
    types = dict(df.dtypes)
    key = ", ".join(f"`{b}` {types[b]}" for b in by)
    width = 3 + 2 * p + 2 * p * p

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # Windows of like lengths together, so that few are filled up.
            pdf = pdf.iloc[np.argsort([len(t) for t in pdf["t"]], kind="stable")]
            for a in range(0, len(pdf), AT_ONCE):
                part = pdf.iloc[a : a + AT_ONCE]
                phi = np.stack([np.asarray(x, float) for x in part["phi"]])
                sums, _ = filtered(phi, *_arrays(part, p))
                out = part[names].copy()
                out["sums"] = list(_flat(sums))
                yield out

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            phi, best, step = (np.stack([np.asarray(x, float) for x in pdf[c]]) for c in ("phi", "best", "step"))
            g = np.stack([np.asarray(x, float) for x in pdf["g"]]).reshape(len(pdf), p + 1, p + 1)
            flat = np.stack([np.zeros(width) if x is None else np.asarray(x, float) for x in pdf["sums"]])
            found, slope, information, sigma2 = map(np.nan_to_num, objective(
                _unflat(flat, p), g, pdf["regular"].to_numpy(float), phi
            ))
            lowest, done = pdf["lowest"].to_numpy(float), pdf["done"].to_numpy(bool)
            better = (found < lowest) & ~done
            out = pdf.drop(columns="sums").copy()
            out["lowest"] = np.where(better, found, lowest)
            out["sigma2"] = np.where(better, sigma2, pdf["sigma2"])
            best = np.where(better[:, None], phi, best)
            ridge = 1e-10 * np.trace(information, axis1=1, axis2=2)[:, None, None] + 1e-300
            move = -np.linalg.solve(information + ridge * np.eye(p), slope[..., None])[..., 0]
            step = np.where(better[:, None], move, step / 2)
            for _ in range(60):
                outside = ~_is_stationary(best + step)
                if not outside.any():
                    break
                step[outside] /= 2
            gain = np.abs(step).max(axis=1)
            # A series that its lags explain to the last digit has no likelihood to climb.
            out["done"] = done | (gain < CLOSE) | (out["sigma2"] < NOTHING)
            out["best"], out["step"], out["phi"] = list(best), list(step), list(best + step)
            yield out

    schema = state.schema
    for _ in range(ROUNDS):
        open_ = state.filter("NOT done")
        if open_.isEmpty():
            break
        own = windows.join(open_.select(*by, "phi"), names)
        parts = own.mapInPandas(evaluate, f"{key}, sums array<double>")
        sums = parts.groupBy(*by).agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
        moved = open_.join(sums, names, "left").mapInPandas(update, schema)
        state = materialize(state.filter("done").unionByName(moved), "exact-state")
    return _models(state, windows, p, by, key)


def _models(state: DataFrame, windows: DataFrame, p: int, by: Sequence[str], key: str) -> DataFrame:
    """Model rows; where the last hours aren't all known, the filter's estimate of them."""
    names = list(by)

    def ended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                phi = np.stack([np.asarray(x, float) for x in pdf["best"]])
                _, states = filtered(phi, *_arrays(pdf, p))
                out = pdf[names].copy()
                out["estimate"] = list(states[:, 1:])
                yield out

    # A window whose last event is the series' last observation.
    lasting = windows.join(state.select(*by, "best", "n"), names).filter(F.col("end") == F.col("n"))
    estimates = lasting.mapInPandas(ended, f"{key}, estimate array<double>")
    short = F.col("n") <= 2 * p + 2
    n = F.col("n") - 1
    zeros = F.array(*[F.lit(0.0)] * p)
    loglik = -0.5 * (F.col("lowest") + n * (F.lit(float(np.log(2 * np.pi))) + 1))
    none: Column = F.array().cast("array<double>")
    return state.join(estimates, names, "left").select(
        *by, F.lit(p).alias("p"), F.lit(0).alias("q"), "n", "level",
        F.when(short, zeros).otherwise(F.col("best")).alias("ar"), none.alias("ma"),
        F.when(short, zeros).otherwise(F.coalesce("estimate", "recent")).alias("recent"), none.alias("shocks"),
        F.when(short, "too_short").otherwise("fitted").alias("status"), F.lit("exact").alias("solver"),
        F.when(~short, F.col("sigma2")).alias("sigma2"), F.when(~short, loglik).alias("loglik"),
    )
