"""Aggregations over series: counts, correlation, autocorrelation, unit root,
and grouped least squares. All are partial+final aggregations (map-side
combine), so a hot series costs no more than a cold one."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.plans.neighbors import lagged, own_rows
from tickweave.plans.small import bounded_broadcast
from tickweave.schema import KEY

# Normal quantiles used for the autocorrelation confidence bands (fixed
# values: two-sided 95% and 99%).
Z95 = 1.959963984540054
Z99 = 2.5758293035489004


def guarded_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over the pairs without a NULL; NULL when either side
    is constant there (C16: plain ``corr`` divides by zero under ANSI)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def pair_corr(df: DataFrame, a: str, b: str, by: str | Sequence[str] | None = KEY, out: str = "corr") -> DataFrame:
    """Correlation of two columns, per group (or overall with by=None)."""
    if by is None:
        return df.agg(guarded_corr(a, b).alias(out))
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(guarded_corr(a, b).alias(out))


def count_sum_avg(df: DataFrame, col: str, by: str | Sequence[str] | None = KEY) -> DataFrame:
    """A1/A2: row count, sum and mean of a column."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(col).alias("total"), F.avg(col).alias("average")]
    if by is None:
        return df.agg(*aggs)
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(*aggs)


def acf(sdf: DataFrame, col: str = "price", max_lag: int = 10, key: str = KEY) -> DataFrame:
    """Autocorrelation r(h) = sum_t z_t z_{t+h} / sum_t z_t^2 with
    z = x - mean, lags 1..max_lag, plus the 95%/99% bands z/sqrt(n)."""
    mean = own_rows(sdf).groupBy(key).agg(F.avg(col).alias("_mean"))
    z = sdf.join(bounded_broadcast(mean), key).withColumn("_z", F.col(col) - F.col("_mean"))
    z = lagged(z, {f"_z{h}": ("_z", -h) for h in range(1, max_lag + 1)}, key)
    agg = z.groupBy(key).agg(
        F.count("_z").alias("n"),
        F.sum(F.col("_z") * F.col("_z")).alias("_c0"),
        F.array(*[F.sum(F.col("_z") * F.col(f"_z{h}")) for h in range(1, max_lag + 1)]).alias("_s"),
    )
    return agg.select(key, "n", "_c0", F.posexplode("_s").alias("_i", "_sh")).select(
        key,
        (F.col("_i") + 1).alias("lag"),
        F.try_divide(F.coalesce("_sh", F.lit(0.0)), F.nullif("_c0", F.lit(0.0))).alias("acf"),
        (F.lit(Z95) / F.sqrt("n")).alias("band95"),
        (F.lit(Z99) / F.sqrt("n")).alias("band99"),
    )


def adf(sdf: DataFrame, col: str = "price", key: str = KEY, lags: int = 0) -> DataFrame:
    """Dickey-Fuller regression with a constant,
    dy_t = a + g*y_{t-1} + sum_j c_j*dy_{t-j} + e  (j = 1..lags, augmented if
    lags > 0); returns g (``gamma``), its t statistic and the sample size.
    lags = 0 is one ``regr_*`` aggregation; lags > 0 solves the per-series
    normal equations (``ols``)."""
    if lags == 0:
        l = lagged(sdf, {"_y1": (col, 1)}, key).withColumn("_dy", F.col(col) - F.col("_y1"))
        g = l.groupBy(key).agg(
            F.regr_slope("_dy", "_y1").alias("gamma"),
            F.regr_r2("_dy", "_y1").alias("_r2"),
            F.regr_sxx("_dy", "_y1").alias("_sxx"),
            F.regr_syy("_dy", "_y1").alias("_syy"),
            F.regr_count("_dy", "_y1").alias("nobs"),
        )
        se = F.sqrt(
            F.try_divide((F.lit(1.0) - F.col("_r2")) * F.col("_syy"), (F.col("nobs") - 2) * F.col("_sxx"))
        )
        return g.select(key, "gamma", F.try_divide(F.col("gamma"), F.nullif(se, F.lit(0.0))).alias("t_stat"), "nobs")
    l = lagged(sdf, {f"_y{i}": (col, i) for i in range(1, lags + 2)}, key)
    l = l.withColumn("_dy", F.col(col) - F.col("_y1"))
    for j in range(1, lags + 1):
        l = l.withColumn(f"_dy{j}", F.col(f"_y{j}") - F.col(f"_y{j + 1}"))
    fit = ols(l, "_dy", ["_y1"] + [f"_dy{j}" for j in range(1, lags + 1)], key)
    return fit.select(key, F.col("coef")[1].alias("gamma"), F.col("t")[1].alias("t_stat"), "nobs")


def normal_equations(df: DataFrame, y: str, xs: Sequence[str], by: str | Sequence[str] = KEY) -> DataFrame:
    """Per group: X'X (upper triangle, constant first), X'y, y'y and n over
    rows where y and every x are non-NULL. One aggregation, map-side combined."""
    keys = [by] if isinstance(by, str) else list(by)
    ok = F.col(y).isNotNull()
    for x in xs:
        ok = ok & F.col(x).isNotNull()
    cols = [F.lit(1.0)] + [F.col(x).cast("double") for x in xs]
    k = len(cols)
    xx = [F.sum(cols[i] * cols[j]) for i in range(k) for j in range(i, k)]
    xy = [F.sum(cols[i] * F.col(y)) for i in range(k)]
    return (
        df.filter(ok)
        .groupBy(*keys)
        .agg(
            F.array(*xx).alias("xtx"),
            F.array(*xy).alias("xty"),
            F.sum(F.col(y) * F.col(y)).alias("yty"),
            F.count(F.lit(1)).alias("nobs"),
        )
    )


def unpack_xtx(tri: np.ndarray, k: int) -> np.ndarray:
    m = np.zeros((k, k))
    idx = 0
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = tri[idx]
            idx += 1
    return m


def solve_ols(xtx: np.ndarray, xty: np.ndarray, yty: float, n: int):
    """Coefficients, residual sum of squares and standard errors."""
    k = xtx.shape[0]
    try:
        b = np.linalg.solve(xtx, xty)
        inv = np.linalg.inv(xtx)
    except np.linalg.LinAlgError:
        reg = xtx + np.eye(k) * 1e-12 * max(1.0, np.trace(xtx))
        b = np.linalg.lstsq(reg, xty, rcond=None)[0]
        inv = np.linalg.pinv(reg)
    ssr = float(max(yty - 2 * b @ xty + b @ xtx @ b, 0.0))
    s2 = ssr / max(n - k, 1)
    se = np.sqrt(np.clip(np.diag(inv) * s2, 0, None))
    return b, ssr, se


def ols(df: DataFrame, y: str, xs: Sequence[str], by: str | Sequence[str] = KEY) -> DataFrame:
    """Grouped least squares with a constant: per group coefficients (constant
    first), standard errors, t statistics, SSR and n. The solve runs on the
    one-row-per-group normal equations (applyInPandas on a small table)."""
    keys = [by] if isinstance(by, str) else list(by)
    ne = normal_equations(df, y, xs, keys)
    k = len(xs) + 1
    schema = T.StructType(
        [f for f in ne.schema.fields if f.name in keys]
        + [
            T.StructField("coef", T.ArrayType(T.DoubleType())),
            T.StructField("se", T.ArrayType(T.DoubleType())),
            T.StructField("t", T.ArrayType(T.DoubleType())),
            T.StructField("ssr", T.DoubleType()),
            T.StructField("nobs", T.LongType()),
        ]
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            xtx = unpack_xtx(np.asarray(r["xtx"], dtype=float), k)
            b, ssr, se = solve_ols(xtx, np.asarray(r["xty"], dtype=float), float(r["yty"]), int(r["nobs"]))
            t = np.divide(b, se, out=np.full_like(b, np.nan), where=se > 0)
            rows.append({**{c: r[c] for c in keys}, "coef": b.tolist(), "se": se.tolist(), "t": t.tolist(),
                         "ssr": ssr, "nobs": int(r["nobs"])})
        return pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return ne.groupBy(*keys).applyInPandas(fit, schema)
