"""Augmented Dickey-Fuller tests of all series at once.

The regression  dx_t = a [+ b t] + g x_{t-1} + c_1 dx_{t-1} + .. + c_k dx_{t-k} + e  needs
the products of its columns only. A block of consecutive positions, with the few
rows before it, travels as one array; its lag matrix and the products are one
matrix multiplication, and the products of all blocks of a series are summed by
Spark. No task holds more than a block, and every series has a lag length of its
own: k = floor((n - 1)^(1/3)), at most MAX_LAGS, unless given.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.operators.stats import solve_ols
from tickweave.plans.neighbors import with_neighbors
from tickweave.schema import KEY

MAX_LAGS = 24
GRAM_ROWS = 65_536

# MacKinnon's response surfaces for the t statistic, without and with a
# trend. p = normal cdf of a polynomial in the statistic; one polynomial up to the
# first bound, another from it on, 1 and 0 beyond the outer bounds.
SURFACES = {
    False: {"split": -1.61, "least": -18.83, "most": 2.74,
            "low": (2.1659, 1.4412, 0.038269), "high": (1.7339, 0.93202, -0.12745, -0.010368)},
    True: {"split": -2.89, "least": -16.18, "most": 0.70,
           "low": (3.2512, 1.6047, 0.049588), "high": (2.5261, 0.61654, -0.37956, -0.060285)},
}


def p_value(t: float, trend: bool = False) -> float:
    s = SURFACES[trend]
    if t >= s["most"]:
        return 1.0
    if t <= s["least"]:
        return 0.0
    z = sum(c * t**i for i, c in enumerate(s["low"] if t <= s["split"] else s["high"]))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def own_lags(n: int) -> int:
    return min(MAX_LAGS, int(round(max(n - 1, 0) ** (1 / 3), 9)))


def _regressors(x: np.ndarray, at: np.ndarray, lags: int, trend: bool, length: int) -> np.ndarray:
    """Rows (response, constant, [trend], level, lagged differences) of the
    positions whose lags all lie within ``x``."""
    dx = np.diff(x)
    if len(dx) <= lags:
        return np.empty((0, 3 + trend + lags))
    view = np.lib.stride_tricks.sliding_window_view(dx, lags + 1)[:, ::-1]
    level = x[lags:-1]
    cols = [view[:, :1], np.ones((len(view), 1))]
    if trend:
        cols.append((at[lags + 1:, None] / max(length, 1)) - 0.5)
    rows = np.hstack([*cols, level[:, None], view[:, 1:]])
    return rows[np.isfinite(rows).all(axis=1)]


def lag_products(sdf: DataFrame, col: str, max_d: int = 0, lags: int | None = None, trend: bool = False, key: str = KEY,
                 rows: int = GRAM_ROWS) -> DataFrame:
    """key, d, lags, nobs, products (row-major) of the regressions for the d-th
    differences, d = 0..max_d; NULL and NaN values take their rows out."""
    most = MAX_LAGS if lags is None else lags
    before = most + 1 + max_d
    nb = with_neighbors(sdf.select(key, "pos", "n", F.col(col).cast("double").alias("x")), key, before=before, rows=rows)
    schema = T.StructType([f for f in nb.schema.fields if f.name == key] + [
        T.StructField("d", T.IntegerType()), T.StructField("lags", T.IntegerType()), T.StructField("nobs", T.LongType()),
        T.StructField("products", T.ArrayType(T.DoubleType()))])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        name, n = pdf[key].iloc[0], int(pdf["n"].iloc[0])
        x, at, halo, out = pdf["x"].to_numpy(float), pdf["pos"].to_numpy(), int((~pdf["_own"]).sum()), []
        for d in range(max_d + 1):
            own = own_lags(n - d) if lags is None else lags
            # the halo serves the largest d and lag: a row belongs to the block of its position
            skip = max(0, halo - d - own - 1)
            m = _regressors(np.diff(x, d)[skip:], at[d:][skip:], own, trend, n)
            out.append((name, d, own, len(m), (m.T @ m).ravel().tolist()))
        return pd.DataFrame(out, columns=[f.name for f in schema.fields])

    parts = nb.groupBy(key, "_blk").applyInPandas(run, schema)
    sums = parts.select(key, "d", "lags", "nobs", F.posexplode("products").alias("i", "p")).groupBy(key, "d", "lags", "i").agg(F.sum("p").alias("p"), F.sum("nobs").alias("nobs"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda r: r["p"])
    return sums.groupBy(key, "d", "lags").agg(F.max("nobs").alias("nobs"), ordered.alias("products"))


def adf_test(sdf: DataFrame, col: str = "price", lags: int | None = None, trend: bool = False, max_d: int = 0, key: str = KEY,
             rows: int = GRAM_ROWS) -> DataFrame:
    """key, d, lags, gamma, t_stat, p_value, nobs: the test of each series' d-th
    differences. Statistic and p-value are NULL for series without variation left
    or too short for the regression."""
    found = lag_products(sdf, col, max_d, lags, trend, key, rows)
    schema = T.StructType([f for f in found.schema.fields if f.name in (key, "d", "lags")] + [
        T.StructField(c, T.DoubleType()) for c in ("gamma", "t_stat", "p_value")] + [T.StructField("nobs", T.LongType())])

    def solve(batches):
        for pdf in batches:
            out = []
            for k, d, own, nobs, products in zip(pdf[key], pdf["d"], pdf["lags"], pdf["nobs"], pdf["products"]):
                size = 3 + trend + int(own)
                m = np.asarray(products, float).reshape(size, size)
                gamma = t = p = None
                level = 1 + trend
                if nobs > size and m[0, 0] > 0:
                    b, _, se = solve_ols(m[1:, 1:], m[0, 1:], float(m[0, 0]), int(nobs))
                    if se[level] > 0 and np.isfinite(b[level] / se[level]):
                        gamma, t = float(b[level]), float(b[level] / se[level])
                        p = p_value(t, trend)
                out.append((k, int(d), int(own), gamma, t, p, int(nobs)))
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields]).astype({"gamma": float, "t_stat": float, "p_value": float})

    tests = found.mapInPandas(solve, schema)
    return tests.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("gamma", "t_stat", "p_value")})


def select_d(sdf: DataFrame, col: str = "price", max_d: int = 2, key: str = KEY, alpha: float = 0.05, lags: int | None = None,
             trend: bool = True) -> DataFrame:
    """Per series t0..t{max_d}, p0..p{max_d} and ``d``, the smallest order of
    differences whose unit root is rejected at ``alpha`` (a constant and a trend in
    the regression, as the reference's test has). A series without a statistic
    needs no more differences."""
    tests = adf_test(sdf, col, lags, trend, max_d, key)
    at = lambda c, d: F.max(F.when(F.col("d") == d, F.col(c)))
    wide = tests.groupBy(key).agg(*[at(c, d).alias(f"{n}{d}") for d in range(max_d + 1) for n, c in (("t", "t_stat"), ("p", "p_value"))])
    choose = F.lit(max_d)
    for d in reversed(range(max_d + 1)):
        choose = F.when((F.col(f"p{d}") < alpha) | F.col(f"p{d}").isNull(), F.lit(d)).otherwise(choose)
    return wide.withColumn("d", choose)
