"""A13 at all lags: autocorrelation by FFT over pairs of position blocks.

A series is cut into blocks of consecutive positions. The products z_t * z_{t+h}
of a pair of blocks (i, i + k), for all lags h at once, are one cross-correlation,
computed by FFT; their sums over i are the autocovariances. ``stats.acf`` keeps a
column a lag and stays the plainer way for a few of them.

A block travels as one array. A task group holds block i and at most TILE of the
blocks behind it, so neither a long series nor many lags fill a task; a block is
copied about max_lag / rows + 2 times.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.scalar import idiv
from tickweave.operators.stats import Z95, Z99
from tickweave.plans.small import bounded_broadcast
from tickweave.schema import KEY

FFT_ROWS = 65_536
TILE = 8


def cross_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """sum_t a[t] * b[t + m] for m = -(len(a) - 1) .. len(b) - 1."""
    size = 1 << (len(a) + len(b) - 2).bit_length()
    both = np.fft.irfft(np.conj(np.fft.rfft(a, size)) * np.fft.rfft(b, size), size)
    return np.concatenate([both[size - len(a) + 1:], both[:len(b)]])


def autoproducts(sdf: DataFrame, col: str, max_lag: int | None = None, key: str = KEY, rows: int = FFT_ROWS) -> DataFrame:
    """key, lag, product: sum_t x_t * x_{t+lag} of ``col`` (NULL counts 0) for the
    lags 0..max_lag (None: all) below the series' length."""
    most = F.col("n") - 1 if max_lag is None else F.least(F.lit(max_lag).cast("long"), F.col("n") - 1)
    x = sdf.select(key, "pos", F.coalesce(F.col(col).cast("double"), F.lit(0.0)).alias("x"), most.alias("most"), "n")
    block = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda r: r["x"])
    blocks = x.groupBy(key, idiv("pos", rows).alias("b")).agg(block.alias("x"), F.max("most").alias("most"), F.max("n").alias("n"))
    # block b is the first of pairs (b, b + k), and the second of pairs (b - k, b)
    furthest = F.least(idiv(F.col("most") + rows - 1, rows), F.lit(1 << 31).cast("long"))
    tile = lambda k: idiv(k, TILE)
    first = F.transform(F.sequence(F.lit(0).cast("long"), tile(F.least(furthest, idiv(F.col("n") - 1, rows) - F.col("b")))),
                        lambda t: F.struct(F.col("b").alias("i"), t.alias("tile"), F.lit(True).alias("first")))
    second = F.transform(F.sequence(F.lit(0).cast("long"), F.least(furthest, F.col("b"))),
                         lambda k: F.struct((F.col("b") - k).alias("i"), tile(k).alias("tile"), F.lit(False).alias("first")))
    pairs = blocks.select(key, "b", "x", "most", F.explode(F.concat(first, second)).alias("p")).select(key, "b", "x", "most", "p.*")
    schema = T.StructType([f for f in blocks.schema.fields if f.name == key] + [
        T.StructField("start", T.LongType()), T.StructField("products", T.ArrayType(T.DoubleType()))])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf["first"]].iloc[0]
        a, most, out = np.asarray(left["x"], float), int(left["most"]), []
        for _, right in pdf[~pdf["first"]].iterrows():
            start = (int(right["b"]) - int(left["b"])) * rows - (len(a) - 1)
            both = cross_products(a, np.asarray(right["x"], float))
            skip = max(0, -start)
            both = both[skip:max(skip, most - start + 1)]
            if len(both):
                out.append({key: left[key], "start": start + skip, "products": both.tolist()})
        return pd.DataFrame(out, columns=[f.name for f in schema.fields])

    found = pairs.groupBy(key, "i", "tile").applyInPandas(run, schema)
    found = found.select(key, "start", F.posexplode("products").alias("at", "x"))
    return found.groupBy(key, (F.col("start") + F.col("at")).alias("lag")).agg(F.sum("x").alias("product"))


def acf_all(sdf: DataFrame, col: str = "price", max_lag: int | None = None, key: str = KEY, rows: int = FFT_ROWS) -> DataFrame:
    """Autocorrelation r(h) = sum_t z_t z_{t+h} / sum_t z_t^2 with z = x - mean
    for every lag h from 1 to n - 1 (or ``max_lag``), with the 95%/99% bands
    z/sqrt(n): what an autocorrelation plot draws. NULL for a constant series."""
    stats = sdf.groupBy(key).agg(F.avg(col).alias("_mean"), F.count(col).alias("_cnt"), (F.var_pop(col) * F.count(col)).alias("_c0"))
    stats = bounded_broadcast(stats)
    z = sdf.select(key, "pos", "n", col).join(stats.select(key, "_mean"), key).withColumn("_z", F.col(col) - F.col("_mean"))
    found = autoproducts(z, "_z", max_lag, key, rows).filter("lag > 0")
    return found.join(stats, key).select(
        key, "lag", F.try_divide("product", F.nullif("_c0", F.lit(0.0))).alias("acf"),
        (F.lit(Z95) / F.sqrt("_cnt")).alias("band95"), (F.lit(Z99) / F.sqrt("_cnt")).alias("band99"))
