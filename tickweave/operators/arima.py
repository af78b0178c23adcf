"""ARIMA order search (M11) and forecasts (M12), all series at once.

The search follows the reference's ``auto_arima(d=None, test='adf', max_p=3,
max_q=3, seasonal=False)`` in intent: d by augmented Dickey-Fuller tests
(``operators.unitroot``), p and q by a stepwise walk along falling AIC, here of
Whittle's likelihood instead of the exact Gaussian one.

Whittle's likelihood of a series needs its autocovariances only:

    s2(phi, theta) = mean over frequencies of  f * |phi(e^iw)|^2 / |theta(e^iw)|^2,
    f = gamma_0 + 2 sum_h gamma_h cos(h w),      AIC = n ln s2 + 2 (p + q + 1).

Autocovariances are sums of products over position blocks (``operators.acf``), so
no pass recurses along a series and none holds it. With the lags up to 1,024 f is
the whole periodogram of a shorter series; for a longer one the lags beyond weigh
as little as the inverse model's memory does (models with an inverse root beyond .99
are no candidates, as in the reference's search). Per series remain at most 16 fits of at most six parameters in numpy.
"""

from __future__ import annotations

import itertools
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.acf import autoproducts
from tickweave.operators.unitroot import select_d
from tickweave.plans.neighbors import lagged
from tickweave.plans.small import bounded_broadcast
from tickweave.schema import KEY
from tickweave.session import scratch_path

MAX_LAG = 1_024
LIMIT = 0.999  # of a partial autocorrelation: keeps roots off the unit circle
LARGEST_ROOT = 0.99  # of an inverse root: fits beyond follow single waves of the noise and are no candidates
LEAST_ROWS = 14  # a series needs more for the largest model
TAIL = 512  # rows from which a forecast rebuilds the last innovations


# ------------------------------------------------------ likelihood of one series
def coefficients(u: np.ndarray) -> np.ndarray:
    """a_1..a_k of a polynomial 1 - a_1 z - .. - a_k z^k without roots on or inside
    the unit circle, from any real numbers (partial autocorrelations by tanh)."""
    a = np.zeros(0)
    for r in LIMIT * np.tanh(u):
        a = np.append(a - r * a[::-1], r)
    return a


class Whittle:
    """The likelihood from autocovariances 0..M."""

    def __init__(self, gamma: np.ndarray):
        m = len(gamma) - 1
        size = 1 << max(6, (4 * m + 3).bit_length())
        whole = np.zeros(size)
        whole[:m + 1], whole[size - m:] = gamma, gamma[:0:-1]
        self.f = np.fft.rfft(whole).real
        weight = np.full(len(self.f), 2.0 / size)
        weight[0] = weight[-1] = 1.0 / size
        self.f = self.f * weight
        self.waves = np.exp(-2j * np.pi * np.outer(np.arange(1, 4), np.arange(len(self.f))) / size)

    def gain(self, a: np.ndarray) -> np.ndarray | float:
        if not len(a):
            return 1.0
        x = 1 - a @ self.waves[:len(a)]
        return x.real**2 + x.imag**2

    def variance(self, u: np.ndarray, p: int) -> float:
        return float(np.sum(self.f * self.gain(coefficients(u[:p])) / self.gain(coefficients(u[p:]))))

    def log_variance(self, u: np.ndarray, p: int) -> float:
        return np.log(max(self.variance(u, p), 1e-300))

    def slope(self, u: np.ndarray, p: int, step: float = 1e-5) -> np.ndarray:
        e = np.eye(len(u)) * step
        return np.array([(self.log_variance(u + x, p) - self.log_variance(u - x, p)) / (2 * step) for x in e])

    def fit(self, u: np.ndarray, p: int) -> tuple[float, np.ndarray]:
        """Least log variance from ``u`` on, by BFGS with halved steps."""
        value = self.log_variance(u, p)
        if not len(u):
            return value, u
        h, g = np.eye(len(u)), self.slope(u, p)
        for _ in range(60):
            step = -h @ g
            if step @ g >= 0:
                h, step = np.eye(len(u)), -g
            size = min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
            while size > 1e-6 and self.log_variance(u + size * step, p) > value + 1e-4 * size * (step @ g):
                size /= 2
            if size <= 1e-6:
                break
            new = u + size * step
            now, slope = self.log_variance(new, p), self.slope(new, p)
            s, y = new - u, slope - g
            if s @ y > 1e-12:
                r, i = 1 / (s @ y), np.eye(len(u))
                h = (i - r * np.outer(s, y)) @ h @ (i - r * np.outer(y, s)) + r * np.outer(s, s)
            done = value - now < 1e-10
            u, g, value = new, slope, now
            if done:
                break
        return value, u


def inside(u: np.ndarray) -> bool:
    """Whether all inverse roots of the polynomial stay below LARGEST_ROOT."""
    a = coefficients(u)
    return not len(a) or np.abs(np.roots([1.0, *-a])).max() < LARGEST_ROOT


def search_orders(gamma: np.ndarray, n: int, max_p: int, max_q: int) -> tuple[int, int, np.ndarray, np.ndarray, float, float]:
    """(p, q, phi, theta, s2, aic) by a stepwise walk: from the best of a few small
    models to the neighbour of the least AIC, while that falls. A larger model
    starts from the smaller ones, so it is never worse; theta is that of
    1 + theta_1 z + .."""
    w, fits = Whittle(gamma), {}

    def fit(p: int, q: int) -> tuple[float, np.ndarray]:
        if (p, q) not in fits:
            starts = [np.insert(fit(p - 1, q)[1], p - 1, x) for x in (0.0, 0.5)] if p else []
            starts += [np.append(fit(p, q - 1)[1], x) for x in (0.0, -0.5)] if q else []
            fits[p, q] = min((w.fit(u, p) for u in starts or [np.zeros(0)]), key=lambda x: x[0])
        return fits[p, q]

    def aic(model: tuple[int, int]) -> float:
        (value, u), p = fit(*model), model[0]
        return round(n * value + 2 * (sum(model) + 1), 6) if inside(u[:p]) and inside(u[p:]) else np.inf

    allowed = lambda models: [m for m in models if 0 <= m[0] <= max_p and 0 <= m[1] <= max_q]
    best = min(allowed([(0, 0), (1, 0), (0, 1), (2, 2)]), key=aic)
    while (near := min(allowed(itertools.product(*(range(x - 1, x + 2) for x in best))), key=aic)) != best and aic(near) < aic(best):
        best = near
    (value, u), p = fit(*best), best[0]
    return *best, coefficients(u[:p]), -coefficients(u[p:]), float(np.exp(value)), n * value + 2 * (sum(best) + 1)


# ---------------------------------------------------------------- all series
def _differenced(sdf: DataFrame, dsel: DataFrame, max_d: int, key: str) -> DataFrame:
    """key, pos, n, _w: the d-th differences of ``_y``, d by series; written once."""
    l = lagged(sdf, {f"_y{k}": ("_y", k) for k in range(1, max_d + 1)}, key).withColumn("_y0", F.col("_y"))
    l = l.join(bounded_broadcast(dsel.select(key, "d")), key)
    w = F.lit(None).cast("double")
    for d in range(max_d + 1):
        of_d = F.lit(0.0)
        for k in range(d + 1):
            of_d = of_d + F.lit(float((-1) ** k * comb(d, k))) * F.col(f"_y{k}")
        w = F.when(F.col("d") == d, of_d).otherwise(w)
    path = scratch_path(sdf.sparkSession, "differences")
    l.select(key, "pos", "n", w.alias("_w")).write.parquet(path)
    return sdf.sparkSession.read.parquet(path)


def arima_fit(sdf: DataFrame, col: str = "price", max_p: int = 3, max_q: int = 3, max_d: int = 2, key: str = KEY,
              adf_lags: int | None = None) -> DataFrame:
    """Key, d, p, q, aic, coef (constant, phi_1..p, theta_1..q), sigma2, nobs.

    The fit runs on standardised series, so that levels do not cost digits. The
    constant is that of the differenced series (a drift for d > 0). A series too
    short for the fit has a NULL order; no series has a say in another's."""
    unit = sdf.groupBy(key).agg(F.avg(col).alias("_mu"), F.nullif(F.stddev_pop(col), F.lit(0.0)).alias("_sd"))
    unit = bounded_broadcast(unit.withColumn("_sd", F.coalesce("_sd", F.lit(1.0))))
    z = sdf.select(key, "pos", "n", col).join(unit, key).withColumn("_y", (F.col(col) - F.col("_mu")) / F.col("_sd")).select(key, "pos", "n", "_y")
    dsel = bounded_broadcast(select_d(z, "_y", max_d, key, lags=adf_lags))
    w = _differenced(z, dsel, max_d, key)
    means = bounded_broadcast(w.groupBy(key).agg(F.avg("_w").alias("_mean"), F.count("_w").alias("nobs")))
    centred = w.join(means.select(key, "_mean"), key).withColumn("_c", F.col("_w") - F.col("_mean"))
    products = autoproducts(centred, "_c", MAX_LAG, key)
    gammas = products.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "product"))), lambda r: r["product"]).alias("products"))
    ready = dsel.select(key, "d").join(gammas, key, "left").join(means, key, "left").join(unit, key)
    schema = T.StructType([f for f in ready.schema.fields if f.name == key] + [
        T.StructField("d", T.IntegerType()), T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()),
        T.StructField("aic", T.DoubleType()), T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("sigma2", T.DoubleType()), T.StructField("nobs", T.LongType())])
    names = [f.name for f in schema.fields]

    def search(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                d, n = int(r["d"]), int(r["nobs"] or 0)
                if r["products"] is None or n <= LEAST_ROWS:
                    out.append((r[key], d, None, None, None, None, None, 0))
                    continue
                mu, sd = float(r["_mu"]), float(r["_sd"])
                p, q, phi, theta, s2, aic = search_orders(np.asarray(r["products"], float)[:n] / n, n, max_p, max_q)
                # back to the units of the series
                mean = float(r["_mean"]) * sd + (mu if d == 0 else 0.0)
                coef = [mean * (1 - phi.sum()), *phi, *theta]
                out.append((r[key], d, p, q, aic + 2 * n * np.log(sd), [float(c) for c in coef], s2 * sd * sd, n))
            yield pd.DataFrame(out, columns=names).astype({"p": "Int32", "q": "Int32", "nobs": "Int64"})

    # a fit takes a while: series are dealt one by one, not by their bytes
    parts = max(1, min(dsel.count(), sdf.sparkSession.sparkContext.defaultParallelism * 4))
    return ready.repartition(parts, key).mapInPandas(search, schema)


def arima_forecast(models: DataFrame, sdf: DataFrame, col: str = "price", steps: int = 100, key: str = KEY) -> DataFrame:
    """``steps``-ahead forecast per series from the fitted order, NULL where
    there is none. Only the last TAIL rows of a series travel: innovations before
    them are taken as 0, which the model has forgotten by its end."""
    last = sdf.filter(F.col("pos") >= F.col("n") - TAIL).select(key, "pos", F.col(col).alias("y"))
    j = last.join(bounded_broadcast(models.select(key, "d", "p", "q", "coef")), key)
    schema = T.StructType([f for f in j.schema.fields if f.name == key] + [T.StructField("step", T.IntegerType()), T.StructField("forecast", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        name, ahead = pdf[key].iloc[0], range(1, steps + 1)
        if pd.isna(pdf["p"].iloc[0]):
            return pd.DataFrame({key: [name] * steps, "step": ahead, "forecast": [None] * steps})
        d, p, q = (int(pdf[c].iloc[0]) for c in "dpq")
        coef = np.asarray(pdf["coef"].iloc[0], dtype=float)
        c, phi, theta = coef[0], coef[1:1 + p], coef[1 + p:1 + p + q]
        y = list(pdf["y"].astype(float))
        w = list(np.diff(y, d))
        e = [0.0] * len(w)
        one = lambda t: c + sum(f * w[t - 1 - i] for i, f in enumerate(phi)) + sum(f * e[t - 1 - i] for i, f in enumerate(theta))
        for t in range(max(p, q), len(w)):
            x = w[t] - one(t)
            e[t] = x if np.isfinite(x) else 0.0
        out = []
        for _ in ahead:
            w.append(one(len(w)))
            e.append(0.0)
            y.append(w[-1] - sum((-1) ** k * comb(d, k) * y[-k] for k in range(1, d + 1)))
            out.append(float(y[-1]))
        return pd.DataFrame({key: [name] * steps, "step": ahead, "forecast": out})

    return j.groupBy(key).applyInPandas(run, schema)
