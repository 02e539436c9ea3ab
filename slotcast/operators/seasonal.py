"""Seasonal forecast models with holiday windows and prior scales.

The model of Taylor & Letham (2018): y = m + k t + sum_j d_j (t - s_j)+ + X b + noise, with Fourier terms, one
term per holiday and window day, and regressors in X. Its maximum a posteriori fit is a penalised least
squares: every term has its own prior scale (normal), the slope changes d_j a Laplace prior.

Series are rows (keys, date, t, e, hist, terms, regressors, y), one per key and date, so a series is as long as
the calendar whatever the sales volume. Each (series, date bucket) is reduced to the Gram matrix of its
design rows in one grouped job; the system of any training window is a sum of buckets. So all folds,
rolling origins and parameter settings are fitted from one pass: settings and folds never replicate rows.

Scaling as in the paper: time and y are scaled to the training window, regressors are standardised. That is
a linear map of the columns, applied to the Gram matrix.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

YEAR_DAYS = 365.25
NONE = float("inf")             # prior scale of an unpenalised term
SWEEPS = 40
ROUNDS = 500


@dataclass(frozen=True)
class Spec:
    """Terms and prior scales. ``holidays`` are term names (holiday and window day), in column order."""

    yearly: int = 10
    weekly: int = 3
    daily: int = 0
    changepoints: int = 25
    changepoint_range: float = 0.8
    holidays: tuple[str, ...] = ()
    regressors: tuple[str, ...] = ()
    trend_scale: float = 5.0
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    holiday_scale: float = 10.0

    @property
    def n_season(self) -> int:
        return 2 * (self.yearly + self.weekly + self.daily)

    @property
    def names(self) -> list[str]:
        season = [f"{p}{f}_{k}" for p, n in (("y", self.yearly), ("w", self.weekly), ("d", self.daily))
                  for k in range(1, n + 1) for f in ("s", "c")]
        return (["m", "t"] + [f"cp_{j + 1}" for j in range(self.changepoints)] + season
                + [f"hol_{i}" for i in range(len(self.holidays))] + list(self.regressors))

    @property
    def size(self) -> int:
        return len(self.names)

    def scales(self) -> np.ndarray:
        """Prior scale of every column; Laplace for the change points, normal for the others. Regressors
        share the holidays' scale."""
        return np.array([self.trend_scale] * 2 + [self.changepoint_scale] * self.changepoints
                        + [self.season_scale] * self.n_season
                        + [self.holiday_scale] * (len(self.holidays) + len(self.regressors)))

    @property
    def jumps(self) -> slice:
        return slice(2, 2 + self.changepoints)

    def knots(self, hist: np.ndarray | int) -> np.ndarray:
        """Change points in days: evenly over the first part of a history of ``hist`` days."""
        last = np.maximum(np.floor(np.asarray(hist) * self.changepoint_range) - 1, 0)
        return np.rint(np.multiply.outer(last, np.arange(1, self.changepoints + 1)) / max(self.changepoints, 1))


def design(spec: Spec, f: pd.DataFrame) -> np.ndarray:
    """Design rows, unscaled: t in days since the series' start, Fourier terms in days since the epoch."""
    t, e = f["t"].to_numpy(dtype=float), f["e"].to_numpy(dtype=float)
    out = [np.ones((len(f), 1)), t[:, None], np.maximum(t[:, None] - spec.knots(f["hist"].to_numpy()), 0.0)]
    for order, period in ((spec.yearly, YEAR_DAYS), (spec.weekly, 7.0), (spec.daily, 1.0)):
        angle = np.multiply.outer(e, 2 * math.pi * np.arange(1, order + 1) / period)
        out.append(np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(f), 2 * order))
    marks = np.zeros((len(f), len(spec.holidays)))
    if spec.holidays:
        for i, days in enumerate(f["terms"]):
            if days is not None:
                marks[i, np.asarray(days, dtype=int)] = 1.0
    out.append(marks)
    out += [f[r].to_numpy(dtype=float)[:, None] for r in spec.regressors]
    return np.hstack(out)


# --- Gram matrices ------------------------------------------------------------------------------------------

def _observed(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.isfinite(z).all(axis=1) & np.isfinite(y)


def grams(rows: DataFrame, keys: list[str], bucket: str, spec: Spec) -> DataFrame:
    """One row per (keys, bucket): the Gram matrix of [design, y] of its observed rows (upper triangle), their
    number, largest |y| and largest t. Rows with a null or non-finite value are no observations."""
    upper = np.triu_indices(spec.size + 1)

    def reduce(f: pd.DataFrame) -> pd.DataFrame:
        z, y = design(spec, f), f["y"].to_numpy(dtype=float)
        seen = _observed(z, y)
        if not seen.any():
            return pd.DataFrame(columns=[*keys, bucket, "zz", "n", "y_max", "t_max"])
        both = np.column_stack([z[seen], y[seen]])
        head = {c: [f[c].iloc[0]] for c in [*keys, bucket]}
        return pd.DataFrame({**head, "zz": [(both.T @ both)[upper].tolist()], "n": [int(seen.sum())],
                             "y_max": [float(np.abs(y[seen]).max())], "t_max": [float(f["t"].to_numpy()[seen].max())]})

    schema = T.StructType([rows.schema[c] for c in [*keys, bucket]] + [
        T.StructField("zz", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType()),
        T.StructField("y_max", T.DoubleType()), T.StructField("t_max", T.DoubleType())])
    ship_package(rows.sparkSession)
    need = list(dict.fromkeys([*keys, bucket, "t", "e", "hist", "terms", *spec.regressors, "y"]))
    return rows.select(*need).groupBy(*keys, bucket).applyInPandas(reduce, schema)


@dataclass
class Systems:
    """Scaled normal equations of several training windows of series with the same columns."""

    gram: np.ndarray        # (windows, p, p)
    right: np.ndarray       # (windows, p)
    yy: np.ndarray
    n: np.ndarray
    allowed: np.ndarray     # (windows, p): columns that may be used
    back: np.ndarray        # (windows, p, p): scaled coefficients to raw ones, for y in units of y_max
    y_max: np.ndarray
    t_max: np.ndarray


def scale_systems(spec: Spec, full: np.ndarray, n: np.ndarray, y_max: np.ndarray, t_max: np.ndarray,
                  hist: int | None) -> Systems:
    """From raw Gram matrices of [design, y]. Change points after the window's own range are not allowed."""
    p = spec.size
    unit = np.where(y_max > 0, y_max, 1.0)
    span = np.maximum(t_max, 1.0)
    back = np.tile(np.eye(p), (len(n), 1, 1))
    timed = np.arange(1, 2 + spec.changepoints)
    back[:, timed, timed] = 1.0 / span[:, None]
    first = p - len(spec.regressors)
    for c in range(first, p):
        mean = full[:, 0, c] / n
        spread = np.sqrt(np.maximum(full[:, c, c] / n - mean ** 2, 0.0))
        spread = np.where(spread > 1e-12, spread, 1.0)
        back[:, c, c], back[:, 0, c] = 1.0 / spread, -mean / spread
    gram = np.swapaxes(back, 1, 2) @ full[:, :p, :p] @ back
    right = (np.swapaxes(back, 1, 2) @ full[:, :p, p:])[:, :, 0] / unit[:, None]
    allowed = np.ones((len(n), p), dtype=bool)
    if spec.changepoints and hist is not None:
        allowed[:, spec.jumps] = spec.knots(hist)[None, :] <= (spec.changepoint_range * (t_max[:, None] + 1)) - 1 + 1e-9
    return Systems(gram, right, full[:, p, p] / unit ** 2, n.astype(float), allowed, back, unit, span)


# --- penalised solves -----------------------------------------------------------------------------------------

def lasso(a: np.ndarray, c: np.ndarray, mu: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimisers of x'Ax/2 - c'x + mu |x|_1 for several systems at once: coordinate descent over all of them,
    then each is brought to its exact optimum by ``active_set`` (slope changes are strongly correlated, and
    descent alone is slow on them)."""
    x, k = start.copy(), a.shape[1]
    diag = np.einsum("ijj->ij", a)
    usable = diag > 1e-12 * np.maximum(diag.max(axis=1, keepdims=True), 1e-300)
    x[~usable] = 0.0
    for _ in range(SWEEPS):
        before = x.copy()
        for j in range(k):
            rest = c[:, j] - np.einsum("ij,ij->i", a[:, j], x) + diag[:, j] * x[:, j]
            x[:, j] = np.where(usable[:, j], np.sign(rest) * np.maximum(np.abs(rest) - mu, 0.0) / np.where(usable[:, j], diag[:, j], 1.0), 0.0)
        if np.abs(x - before).max() <= 1e-12 * max(np.abs(x).max(), 1e-12):
            break
    for i in range(len(a)):
        x[i] = active_set(a[i], c[i], float(mu[i]), x[i], usable[i])
    return x


def active_set(a: np.ndarray, c: np.ndarray, mu: float, x: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Feature-sign search (Lee et al. 2007): solve on the signs of the active coordinates, step to the best point up
    to the first sign changes, and let in the coordinate that violates its condition most."""
    slack = 1e-9 * max(mu, np.abs(c).max(initial=0.0), 1e-300)

    def cost(v: np.ndarray) -> float:
        return float(v @ (a @ v) / 2 - c @ v + mu * np.abs(v).sum())

    sign = np.sign(x)
    for _ in range(ROUNDS):
        slope = a @ x - c
        on = x != 0
        if (np.abs(slope[on] + mu * sign[on]) <= slack).all():
            beyond = np.where(usable & ~on, np.abs(slope) - mu, -np.inf)
            if beyond.max(initial=-np.inf) <= slack:
                break
            j = int(beyond.argmax())
            sign[j] = -np.sign(slope[j])
            on = on | (np.arange(len(x)) == j)
        at = np.flatnonzero(on)
        aim = np.linalg.lstsq(a[np.ix_(at, at)], c[at] - mu * sign[at], rcond=None)[0]
        old, best = x[at], x.copy()
        best[at] = aim
        least = cost(best)
        for f in np.flatnonzero((np.sign(aim) != sign[at]) & (old != 0)):
            point = x.copy()
            share = old[f] / (old[f] - aim[f])
            point[at] = old + share * (aim - old)
            point[at[f]] = 0.0
            if cost(point) < least:
                best, least = point, cost(point)
        if not least < cost(x):
            break
        x, sign = best, np.sign(best)
    return x


def solve(s: Systems, spec: Spec, sigma2: np.ndarray | None = None, iterations: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(scaled coefficients, sigma^2) of the maximum a posteriori fits; sigma has a half-normal(0.5) prior unless
    it is given. Without penalties this is least squares."""
    p, scales = spec.size, spec.scales()
    normal = np.ones(p, dtype=bool)
    normal[spec.jumps] = False
    laplace = ~normal
    gram = s.gram * s.allowed[:, :, None] * s.allowed[:, None, :]
    right = s.right * s.allowed
    weight = np.where(np.isfinite(scales[normal]), 1.0 / scales[normal] ** 2, 0.0)
    steep = 1.0 / spec.changepoint_scale if math.isfinite(spec.changepoint_scale) else 0.0
    grr, grl, gll = gram[:, normal][:, :, normal], gram[:, normal][:, :, laplace], gram[:, laplace][:, :, laplace]
    br, bl = right[:, normal], right[:, laplace]
    theta = np.zeros((len(gram), p))
    fixed = sigma2 is not None
    var = sigma2 if fixed else np.maximum(s.yy / s.n - (s.right[:, 0] / s.n) ** 2, 1e-8) * 0.1
    for _ in range(1 if fixed or not (weight.any() or steep) else iterations):
        base = grr + var[:, None, None] * np.diag(weight) + 1e-12 * np.einsum("ijj->i", grr)[:, None, None] * np.eye(normal.sum())
        if not weight.any():
            base = grr
        both = np.concatenate([grl, br[:, :, None]], axis=2)
        x = np.stack([np.linalg.lstsq(b, r, rcond=None)[0] for b, r in zip(base, both)]) if not weight.any() else np.linalg.solve(base, both)
        if spec.changepoints:
            lead = np.swapaxes(grl, 1, 2)
            jumps = lasso(gll - lead @ x[:, :, :-1], bl - (lead @ x[:, :, -1:])[:, :, 0], var * steep, theta[:, laplace])
        else:
            jumps = np.zeros((len(gram), 0))
        theta[:, laplace] = jumps
        theta[:, normal] = x[:, :, -1] - np.einsum("ijk,ik->ij", x[:, :, :-1], jumps)
        rss = np.maximum(s.yy - 2 * np.einsum("ij,ij->i", right, theta) + np.einsum("ij,ijk,ik->i", theta, gram, theta), 0.0)
        if fixed:
            break
        new = np.maximum((np.sqrt(s.n ** 2 + 16 * rss) - s.n) / 8, 1e-10)
        done = np.abs(new - var).max() <= 1e-9 * new.max()
        var = new
        if done:
            break
    return theta, var


def _unpack(zz: list, size: int) -> np.ndarray:
    full = np.zeros((len(zz), size, size))
    i, j = np.triu_indices(size)
    full[:, i, j] = np.vstack([np.asarray(z, dtype=float) for z in zz])
    full[:, j, i] = full[:, i, j]
    return full


UP_TO, FROM, OTHERS = "up to", "from", "others"      # which buckets train for a target bucket


def windows(spec: Spec, f: pd.DataFrame, bucket: str, targets: list[int], mode: str) -> tuple[list[int], Systems | None]:
    """Scaled systems of the training windows of one series' bucket rows: for each target the buckets up to it,
    from it on, or all others (total minus its own). Windows without observations are left out."""
    f = f.sort_values(bucket, ascending=mode != FROM)
    full, n, order = _unpack(list(f["zz"]), spec.size + 1), f["n"].to_numpy(), f[bucket].to_numpy()
    y_max, t_max = f["y_max"].to_numpy(), f["t_max"].to_numpy()
    hist = int(f["hist"].iloc[0])
    if mode == OTHERS:
        own = [np.flatnonzero(order == k) for k in targets]
        left = [int(n.sum() - n[i].sum()) for i in own]
        kept = [j for j, c in enumerate(left) if c > 0]
        if not kept:
            return [], None
        total = full.sum(axis=0)
        rest = [np.setdiff1d(np.arange(len(n)), own[j]) for j in kept]
        return [targets[j] for j in kept], scale_systems(
            spec, np.stack([total - full[own[j]].sum(axis=0) for j in kept]), np.array([left[j] for j in kept]),
            np.array([y_max[i].max() for i in rest]), np.array([t_max[i].max() for i in rest]), hist)
    full, n = np.cumsum(full, axis=0), np.cumsum(n)
    y_max, t_max = np.maximum.accumulate(y_max), np.maximum.accumulate(t_max)
    last = [int((order >= k).sum() if mode == FROM else (order <= k).sum()) - 1 for k in targets]
    at = [i for i in last if i >= 0]
    if not at:
        return [], None
    return [k for k, i in zip(targets, last) if i >= 0], scale_systems(spec, full[at], n[at], y_max[at], t_max[at], hist)


MODEL = [T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType()),
         T.StructField("jump_rate", T.DoubleType()), T.StructField("jump_size", T.DoubleType()),
         T.StructField("t_last", T.DoubleType()), T.StructField("n", T.LongType())]


def models_of(spec: Spec, s: Systems, theta: np.ndarray, var: np.ndarray) -> list[tuple]:
    """Rows of ``MODEL``: raw coefficients, noise, and the rate and mean size of trend changes per day."""
    raw = np.einsum("ijk,ik->ij", s.back, theta) * s.y_max[:, None]
    sizes = np.abs(raw[:, spec.jumps]).mean(axis=1) if spec.changepoints else np.zeros(len(raw))
    return [(raw[i].tolist(), float(np.sqrt(var[i]) * s.y_max[i]), float(spec.changepoints / s.t_max[i]), float(sizes[i]),
             float(s.t_max[i]), int(s.n[i])) for i in range(len(raw))]


def fit(stats: DataFrame, keys: list[str], bucket: str, spec: Spec, hist: DataFrame, targets: list[int] | None = None,
        mode: str = UP_TO) -> DataFrame:
    """One model per series and target bucket (``targets`` None: one on all rows, bucket 0) from ``grams``.
    ``hist`` is (keys, hist), the days of each series' history."""
    def one(f: pd.DataFrame) -> pd.DataFrame:
        kept, s = windows(spec, f if targets is not None else f.assign(**{bucket: 0}), bucket, [0] if targets is None else targets, mode)
        rows = models_of(spec, s, *solve(s, spec)) if kept else []
        head = [f[k].iloc[0] for k in keys]
        return pd.DataFrame([(*head, k, *r) for k, r in zip(kept, rows)], columns=[*keys, bucket, *[x.name for x in MODEL]])

    schema = T.StructType([stats.schema[k] for k in keys] + [T.StructField(bucket, T.IntegerType())] + MODEL)
    ship_package(stats.sparkSession)
    return stats.join(hist, keys).groupBy(*keys).applyInPandas(one, schema)


def predict(rows: DataFrame, models: DataFrame, on: list[str], spec: Spec, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with yhat, trend and sigma. Series and models meet by ``on``; a model is
    not copied to its rows."""
    fields = [rows.schema[c] for c in dict.fromkeys([*on, *keep])]
    names = [x.name for x in fields]

    def score(f: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if f.empty or m.empty:
            return pd.DataFrame(columns=[*names, "yhat", "trend", "sigma"])
        z, coef = design(spec, f), np.asarray(m["coef"].iloc[0], dtype=float)
        n = 2 + spec.changepoints
        return f[names].assign(yhat=z @ coef, trend=z[:, :n] @ coef[:n], sigma=float(m["sigma"].iloc[0]))

    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in ("yhat", "trend", "sigma")])
    need = list(dict.fromkeys([*names, "t", "e", "hist", "terms", *spec.regressors]))
    ship_package(rows.sparkSession)
    return rows.select(*need).groupBy(*on).cogroup(models.groupBy(*on)).applyInPandas(score, schema)


# --- M10: intervals from simulated trend changes ----------------------------------------------------------------

def simulate(future: DataFrame, models: DataFrame, keys: list[str], width: float = 0.8, paths: int = 1000,
             chunks: int = 4, seed: int = 42) -> DataFrame:
    """(keys, date, lower, upper) for rows (keys, date, t, yhat) after the history: paths in which trend changes
    go on at the rate and mean size of the history, plus noise. The paths of a series are dealt to chunks
    with seeds of their own, which return sorted draws per date; draws of all chunks are merged."""
    def draw(f: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if f.empty or m.empty:
            return pd.DataFrame(columns=[*keys, "date", "draws"])
        m = m.iloc[0]
        t, base = f["t"].to_numpy(dtype=float), f["yhat"].to_numpy(dtype=float)
        name = "|".join(str(f[k].iloc[0]) for k in keys)
        rng = np.random.default_rng([seed, zlib.crc32(name.encode()), int(f["chunk"].iloc[0])])
        n, ahead = paths // chunks, max(float(t.max() - m["t_last"]), 0.0)
        changes = rng.poisson(m["jump_rate"] * ahead, n)
        most = int(changes.max(initial=0))
        at = m["t_last"] + ahead * rng.random((n, most))
        size = np.where(np.arange(most) < changes[:, None], rng.laplace(0.0, m["jump_size"] + 1e-12, (n, most)), 0.0)
        drift = np.zeros((n, len(t)))
        for j in range(most):
            drift += size[:, j:j + 1] * np.maximum(t[None, :] - at[:, j:j + 1], 0.0)
        values = np.sort(base + drift + rng.normal(0.0, m["sigma"], (n, len(t))), axis=0)
        return f[[*keys, "date"]].assign(draws=list(values.T))

    spread = future.select(*keys, "date", "t", "yhat", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    each = models.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    schema = T.StructType([future.schema[k] for k in [*keys, "date"]] + [T.StructField("draws", T.ArrayType(T.DoubleType()))])
    ship_package(future.sparkSession)
    parts = spread.groupBy(*keys, "chunk").cogroup(each.groupBy(*keys, "chunk")).applyInPandas(draw, schema)
    merged = parts.groupBy(*keys, "date").agg(F.array_sort(F.flatten(F.collect_list("draws"))).alias("d"))

    def at(q: float):
        place = F.lit(q) * (F.size("d") - 1)
        low, share = F.floor(place).cast("int"), place - F.floor(place)
        high = F.least(low + 1, F.size("d") - 1)
        return F.get("d", low) * (1 - share) + F.get("d", high) * share

    return merged.select(*keys, "date", at((1 - width) / 2).alias("lower"), at((1 + width) / 2).alias("upper"))


# --- M9: multiplicative terms -------------------------------------------------------------------------------------

def fit_multiplicative(z: np.ndarray, y: np.ndarray, spec: Spec, hist: int, steps: int = 50) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """y = trend (1 + X b): alternating penalised least squares of the trend (rows weighted by 1 + X b) and of b
    (columns weighted by the trend), each from its Gram matrix. Returns (trend coefficients, b, sigma, the
    rows' fitted values), all raw; X holds standardised regressors, see ``standard``."""
    n_t = 2 + spec.changepoints
    trend, x = z[:, :n_t], z[:, n_t:]
    bare = replace(spec, yearly=0, weekly=0, daily=0, holidays=(), regressors=())
    weight = 1.0 / spec.scales()[n_t:] ** 2
    n, unit = np.array([len(y)]), max(float(np.abs(y).max()), 1e-12)
    t_max, b, var, last = np.array([trend[:, 1].max()]), np.zeros(x.shape[1]), None, np.inf
    for _ in range(steps):
        w = 1.0 + x @ b
        both = np.column_stack([trend * w[:, None], y])
        s = scale_systems(bare, (both.T @ both)[None], n, np.array([unit]), t_max, hist)
        theta, var = solve(s, bare, var, iterations=10)
        line = trend @ (s.back[0] @ theta[0]) * unit
        scaled = x * line[:, None] / unit
        b = np.linalg.solve(scaled.T @ scaled + var[0] * np.diag(weight), scaled.T @ ((y - line) / unit))
        rss = float((((y - line * (1.0 + x @ b)) / unit) ** 2).sum())
        var = np.maximum((np.sqrt(n ** 2.0 + 16 * rss) - n) / 8, 1e-10)
        if abs(last - rss) <= 1e-10 * max(rss, 1e-12):
            break
        last = rss
    return (s.back[0] @ theta[0]) * unit, b, float(np.sqrt(var[0]) * unit), line * (1.0 + x @ b)


def multiplicative(rows: DataFrame, keys: list[str], spec: Spec, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row, history and future, with yhat, trend, sigma and the trend's jump_rate,
    jump_size and t_last. A series (as long as the calendar) is fitted in one group."""
    fields = [rows.schema[c] for c in dict.fromkeys([*keys, *keep])]
    names = [f.name for f in fields]
    extra = ["yhat", "trend", "sigma", "jump_rate", "jump_size", "t_last"]

    def one(f: pd.DataFrame) -> pd.DataFrame:
        z, y = design(spec, f), f["y"].to_numpy(dtype=float)
        seen = _observed(z, y)
        if not seen.any():
            return f[names].assign(**{c: np.nan for c in extra})
        z = standard(z, seen, spec)
        coef, b, sigma, _ = fit_multiplicative(z[seen], y[seen], spec, int(f["hist"].iloc[0]))
        n_t = 2 + spec.changepoints
        line = z[:, :n_t] @ coef
        t_last = max(float(f["t"].to_numpy()[seen].max()), 1.0)
        return f[names].assign(yhat=line * (1.0 + z[:, n_t:] @ b), trend=line, sigma=sigma, jump_rate=spec.changepoints / t_last,
                               jump_size=float(np.abs(coef[spec.jumps]).mean()) if spec.changepoints else 0.0, t_last=t_last)

    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in extra])
    need = list(dict.fromkeys([*names, "t", "e", "hist", "terms", *spec.regressors, "y"]))
    ship_package(rows.sparkSession)
    return rows.select(*need).groupBy(*keys).applyInPandas(one, schema)


def standard(z: np.ndarray, seen: np.ndarray, spec: Spec) -> np.ndarray:
    """Regressor columns standardised over the observed rows."""
    first = spec.size - len(spec.regressors)
    mean, spread = z[seen, first:].mean(axis=0), z[seen, first:].std(axis=0)
    out = z.copy()
    out[:, first:] = (z[:, first:] - mean) / np.where(spread > 1e-12, spread, 1.0)
    return out


# --- M24: a grid of prior scales ----------------------------------------------------------------------------------

def grid_coefficients(s: Systems, spec: Spec, sigma2: np.ndarray, settings: list[tuple[float, float, float]]) -> np.ndarray:
    """Scaled coefficients (windows, settings, p) for (changepoint, season, holiday) scales, slope changes with
    the normal prior of the Laplace prior's variance. For every pair of season and holiday scales, the other
    terms are eliminated and what is left is decomposed once; every change-point scale is then a division."""
    p = spec.size
    normal = np.ones(p, dtype=bool)
    normal[spec.jumps] = False
    out = np.zeros((len(s.gram), len(settings), p))
    pairs: dict = {}
    for i, (_, season, holiday) in enumerate(settings):
        pairs.setdefault((season, holiday), []).append(i)
    for w in range(len(s.gram)):
        use = s.allowed[w]
        r, l = np.flatnonzero(normal & use), np.flatnonzero(~normal & use)
        g, b = s.gram[w], s.right[w]
        for (season, holiday), places in pairs.items():
            scales = replace(spec, season_scale=season, holiday_scale=holiday).scales()
            x = np.linalg.solve(g[np.ix_(r, r)] + sigma2[w] * np.diag(1.0 / scales[r] ** 2), np.column_stack([g[np.ix_(r, l)], b[r]]))
            value, vector = np.linalg.eigh(g[np.ix_(l, l)] - g[np.ix_(l, r)] @ x[:, :-1])
            lean = vector.T @ (b[l] - g[np.ix_(l, r)] @ x[:, -1])
            for i in places:
                jumps = vector @ (lean / (np.maximum(value, 0.0) + sigma2[w] / (2.0 * settings[i][0] ** 2)))
                out[w, i, l], out[w, i, r] = jumps, x[:, -1] - x[:, :-1] @ jumps
    return out


def search(stats: DataFrame, rows: DataFrame, keys: list[str], bucket: str, test: str, spec: Spec, hist: DataFrame,
           targets: list[int], settings: list[tuple[float, float, float]], mode: str = UP_TO) -> DataFrame:
    """(keys, test, setting, abs_error, sq_error, n) of every setting on every fold's test rows. A fold's
    coefficients of all settings meet its rows once, by series."""
    each = [rows.schema[k] for k in keys]

    def one(f: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, test, "setting", "abs_error", "sq_error", "n"]
        if f.empty or m.empty:
            return pd.DataFrame(columns=names)
        kept, s = windows(spec, m, bucket, targets, mode)
        if not kept:
            return pd.DataFrame(columns=names)
        coef = grid_coefficients(s, spec, solve(s, spec)[1], settings)
        out, head = [], [f[k].iloc[0] for k in keys]
        for w, fold in enumerate(kept):
            some = f[f[test] == fold]
            z, y = design(spec, some), some["y"].to_numpy(dtype=float)
            seen = _observed(z, y)
            if not seen.any():
                continue
            error = z[seen] @ (s.back[w] @ coef[w].T) * s.y_max[w] - y[seen][:, None]
            out += [(*head, fold, i, float(a), float(q), int(seen.sum()))
                    for i, (a, q) in enumerate(zip(np.abs(error).sum(axis=0), (error ** 2).sum(axis=0)))]
        return pd.DataFrame(out, columns=names)

    schema = T.StructType(each + [T.StructField(test, T.IntegerType()), T.StructField("setting", T.IntegerType()),
                                  T.StructField("abs_error", T.DoubleType()), T.StructField("sq_error", T.DoubleType()),
                                  T.StructField("n", T.LongType())])
    need = list(dict.fromkeys([*keys, test, "t", "e", "hist", "terms", *spec.regressors, "y"]))
    ship_package(rows.sparkSession)
    return rows.select(*need).groupBy(*keys).cogroup(stats.join(hist, keys).groupBy(*keys)).applyInPandas(one, schema)


def design_table(rows: DataFrame, keys: list[str], spec: Spec) -> DataFrame:
    """(keys, date, one column per term): the rows that the fits see."""
    fields = [rows.schema[c] for c in [*keys, "date"]]

    def run(frames):
        for f in frames:
            if len(f):
                z = pd.DataFrame(design(spec, f), columns=spec.names, index=f.index)
                yield pd.concat([f[[*keys, "date"]], z], axis=1)

    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in spec.names])
    ship_package(rows.sparkSession)
    need = list(dict.fromkeys([*keys, "date", "t", "e", "hist", "terms", *spec.regressors]))
    return rows.select(*need).mapInPandas(run, schema)
