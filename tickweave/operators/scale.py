"""Fitted statistics and scalers (z-score, robust, min-max, chain, inverse).

Statistics are one row per group (``by``: the series key, optionally plus a
split column for per-split fits, C15). They are joined back with a
size-checked broadcast (``plans.small``), never turned into driver literals.

Quantiles are exact with linear interpolation (C6), in two scans. Mergeable sketches
give a narrow bracket around each; then the rows below every bracket are counted,
and the distinct values inside, which alone are ranked, by ranges of their value.
No aggregate buffers a whole group, nothing is sorted or written but the brackets'
values.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.plans.small import bounded_broadcast
from tickweave.schema import FEATURES, KEY
from tickweave.session import scratch_path


def _by(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def with_stats(df: DataFrame, stats: DataFrame, by: str | Sequence[str] = KEY) -> DataFrame:
    """Attach one-row-per-group statistics to every row."""
    return df.join(bounded_broadcast(stats), _by(by), "left")


def column_stats(df: DataFrame, cols: Sequence[str] = FEATURES, by: str | Sequence[str] = KEY, ddof: int = 1) -> DataFrame:
    """A3/A4: mean and standard deviation (sample if ddof=1, population if 0)
    of every column in one aggregation (partial + final, skew-safe)."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), sd(c).alias(f"{c}_sd")]
    return df.groupBy(*_by(by)).agg(*aggs)


def minmax_stats(df: DataFrame, cols: Sequence[str] = FEATURES, by: str | Sequence[str] = KEY) -> DataFrame:
    """Min and max per column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy(*_by(by)).agg(*aggs)


# A quantile sketch of this k errs by about 0.25% of the rows (99% of the time);
# brackets reach twice as far to either side. One that misses is noticed.
SKETCH_K = 2_048
BRACKET = 0.005
BUCKETS = 4_096  # of a bracket's values that are ranked together
MOST_PLACES = 62  # bits of a mask


def _located(x: DataFrame, brackets: DataFrame, places: Sequence[tuple[str, float]]) -> DataFrame:
    """_g, j, h, x0, x1: for every bracket (_g, _b: array of j, h, lo, hi in the order
    of ``places``) the values at the ranks floor(h) and ceil(h), NULL if outside.

    One scan: a row sends a mask that says below which brackets it lies, and its
    value for each bracket it lies in. Both are counted with map-side combine, so
    what moves is a few masks a task and the distinct values inside."""
    joined = x.join(brackets, "_g")
    at = [F.col("_b")[j] for j in range(len(places))]
    mask = F.lit(0).cast("long")
    for j, (c, _) in enumerate(places):
        mask = mask + F.when(F.col(c) < at[j]["lo"], F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long"))
    one = lambda j, v, m: F.struct(F.lit(j).alias("j"), v.cast("double").alias("v"), m.cast("long").alias("m"))
    inside = [F.when((F.col(c) >= at[j]["lo"]) & (F.col(c) <= at[j]["hi"]), one(j, F.col(c), F.lit(0))) for j, (c, _) in enumerate(places)]
    sent = F.concat(F.array(one(-1, F.lit(None), mask)), F.filter(F.array(*inside), lambda e: e.isNotNull()))
    path = scratch_path(x.sparkSession, "quantiles")
    joined.select("_g", F.inline(sent)).groupBy("_g", "j", "v", "m").agg(F.count("*").alias("c")).write.parquet(path)
    counted = x.sparkSession.read.parquet(path)

    bits = F.array(*[F.struct(F.lit(j).alias("j"), F.shiftright("m", j).bitwiseAND(F.lit(1).cast("long")).alias("bit")) for j in range(len(places))])
    below = counted.filter("j < 0").select("_g", "c", F.inline(bits)).groupBy("_g", "j").agg(F.sum(F.col("c") * F.col("bit")).alias("below"))
    places_of = brackets.select("_g", F.inline("_b"))
    share = F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo"))
    bucket = F.when((F.col("hi") > F.col("lo")) & (share >= 0) & (share <= 1), F.floor(share * (BUCKETS - 1))).otherwise(0)
    values = counted.filter("j >= 0").select("_g", "j", "v", "c").join(places_of, ["_g", "j"]).withColumn("k", bucket)
    sums = values.groupBy("_g", "j", "k").agg(F.sum("c").alias("s"))
    earlier = Window.partitionBy("_g", "j").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_g", "j", "k", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("start")).join(below, ["_g", "j"])
    upto = Window.partitionBy("_g", "j", "k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("last", F.sum("c").over(upto)).join(sums, ["_g", "j", "k"])
    first = F.col("below") + F.col("start") + F.col("last") - F.col("c")
    holds = lambda t: (first <= t) & (t < first + F.col("c"))
    hit = values.groupBy("_g", "j").agg(F.max(F.when(holds(F.floor("h")), F.col("v"))).alias("x0"), F.max(F.when(holds(F.ceil("h")), F.col("v"))).alias("x1"))
    return places_of.select("_g", "j", "h").join(hit, ["_g", "j"], "left")


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: str | Sequence[str] = KEY,
) -> DataFrame:
    """Exact linear-interpolated quantiles, long form: by..., feature, q0..qk.

    Same definition as SQL ``percentile`` / ``quantile_cont`` and numpy's
    default: position h = (n-1)*p, value = v[floor h] + (v[ceil h] - v[floor h])
    * (h - floor h), NULLs ignored. Two scans: sketches give the brackets, then the
    places are counted out (``_located``).
    """
    keys = _by(by)
    most = max(1, MOST_PLACES // len(probs))
    if len(cols) > most:
        parts = [exact_quantiles(df, cols[i:i + most], probs, by) for i in range(0, len(cols), most)]
        return functools.reduce(DataFrame.unionByName, parts)
    places = [(c, float(p)) for c in cols for p in probs]
    x = df.select(F.struct(*keys).alias("_g"), *[F.col(c).cast("double").alias(c) for c in cols])
    ends = F.array(*[F.lit(min(1.0, max(0.0, float(p) + e))) for p in probs for e in (-BRACKET, BRACKET)])
    near = x.groupBy("_g").agg(
        *[F.count(c).alias(f"_n{k}") for k, c in enumerate(cols)],
        *[F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(f"_s{k}") for k, c in enumerate(cols)])
    near = near.select("_g", *[f"_n{k}" for k in range(len(cols))], *[
        F.when(F.col(f"_n{k}") > 0, F.kll_sketch_get_quantile_double(f"_s{k}", ends)).alias(f"_q{k}") for k in range(len(cols))])

    def bracket(j: int, c: str, p: float) -> Column:
        k, i = cols.index(c), 2 * (j % len(probs))
        return F.struct(F.lit(j).alias("j"), ((F.col(f"_n{k}") - 1).cast("double") * F.lit(p)).alias("h"),
                        F.col(f"_q{k}")[i].alias("lo"), F.col(f"_q{k}")[i + 1].alias("hi"))

    brackets = bounded_broadcast(near.select("_g", F.array(*[bracket(j, c, p) for j, (c, p) in enumerate(places)]).alias("_b")))
    path = scratch_path(df.sparkSession, "quantiles-found")
    _located(x, brackets, places).write.parquet(path)
    found = df.sparkSession.read.parquet(path)
    missed = found.filter("h >= 0 and (x0 is null or x1 is null)")
    if missed.head(1):  # all rows of those groups, without bounds
        wide = F.transform("_b", lambda b: F.struct(b["j"].alias("j"), b["h"].alias("h"), F.lit(float("-inf")).alias("lo"), F.lit(float("nan")).alias("hi")))
        again = bounded_broadcast(brackets.join(missed.select("_g").distinct(), "_g", "left_semi").select("_g", wide.alias("_b")))
        rest = _located(x, again, places)
        found = found.join(missed.select("_g").distinct(), "_g", "left_anti").unionByName(rest)
    value = F.col("x0") + F.when(F.col("x0") == F.col("x1"), 0.0).otherwise((F.col("x1") - F.col("x0")) * (F.col("h") - F.floor("h")))
    feature = F.element_at(F.array(*[F.lit(c) for c in cols]), F.floor(F.col("j") / len(probs)).cast("int") + 1)
    found = found.select("_g", feature.alias("feature"), F.pmod("j", F.lit(len(probs))).alias("i"), value.alias("_v"))
    g = found.groupBy("_g", "feature").agg(*[F.max(F.when(F.col("i") == i, F.col("_v"))).alias(f"q{i}") for i in range(len(probs))])
    g = g.filter(F.col("q0").isNotNull())  # no row where there is no value
    return g.select(*[F.col("_g")[k].alias(k) for k in keys], "feature", *[f"q{i}" for i in range(len(probs))])


def robust_stats(df: DataFrame, cols: Sequence[str] = FEATURES, by: str | Sequence[str] = KEY) -> DataFrame:
    """A5: per column q25, median, q75 and iqr (exact, C6), one row per group."""
    keys = _by(by)
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75), keys)
    aggs = []
    for c in cols:
        sel = F.col("feature") == c
        aggs += [
            F.max(F.when(sel, F.col("q0"))).alias(f"{c}_q25"),
            F.max(F.when(sel, F.col("q1"))).alias(f"{c}_med"),
            F.max(F.when(sel, F.col("q2"))).alias(f"{c}_q75"),
        ]
    out = q.groupBy(*keys).agg(*aggs)
    return out.withColumns({f"{c}_iqr": F.col(f"{c}_q75") - F.col(f"{c}_q25") for c in cols})


def _fit_rows(df: DataFrame, fit_on: Column | None) -> DataFrame:
    """Fit scope (C15): all rows (None, the reference's default, which leaks
    test rows into the fit), or only rows matching ``fit_on`` (e.g. the train
    split). Per-split fits put the split column into ``by`` instead."""
    return df if fit_on is None else df.filter(fit_on)


def _nz(x: Column) -> Column:
    """Divisor guard (C7): zero range or iqr -> 1, like sklearn."""
    return F.coalesce(F.nullif(x, F.lit(0.0)), F.lit(1.0))


def zscore(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    by: str | Sequence[str] = KEY,
    ddof: int = 1,
    suffix: str = "",
    keep_stats: bool = False,
    fit_on: Column | None = None,
) -> DataFrame:
    """M1/M2: (x - mean) / sd; ``by`` may include a split column (per-split
    fit, C15). A zero or undefined (one-row) sd divides by 1."""
    st = column_stats(_fit_rows(df, fit_on), cols, by, ddof)
    j = with_stats(df, st, by)
    out = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"{c}_mean")) / _nz(F.col(f"{c}_sd")) for c in cols})
    return out if keep_stats else out.drop(*[f"{c}_{s}" for c in cols for s in ("mean", "sd")])


def robust_scale(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    by: str | Sequence[str] = KEY,
    suffix: str = "",
    keep_stats: bool = False,
    fit_on: Column | None = None,
) -> DataFrame:
    """M3: (x - median) / iqr (sklearn RobustScaler defaults)."""
    st = robust_stats(_fit_rows(df, fit_on), cols, by)
    j = with_stats(df, st, by)
    out = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"{c}_med")) / _nz(F.col(f"{c}_iqr")) for c in cols})
    if keep_stats:
        return out
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("q25", "med", "q75", "iqr")])


def minmax_scale(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    by: str | Sequence[str] = KEY,
    suffix: str = "",
    keep_stats: bool = False,
    fit_on: Column | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """M4: (x - min) / (max - min); zero range divides by 1 (C7). ``stats``: a
    fit made before (``minmax_stats``), so that scaling and its inverse share it."""
    st = minmax_stats(_fit_rows(df, fit_on), cols, by) if stats is None else stats
    j = with_stats(df, st, by)
    out = j.withColumns(
        {f"{c}{suffix}": (F.col(c) - F.col(f"{c}_min")) / _nz(F.col(f"{c}_max") - F.col(f"{c}_min")) for c in cols}
    )
    return out if keep_stats else out.drop(*[f"{c}_{s}" for c in cols for s in ("min", "max")])


def scale_chain(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    by: str | Sequence[str] = KEY,
    suffix: str = "",
    keep_stats: bool = False,
    fit_on: Column | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """M4 chain: robust scaling followed by min-max scaling.

    Robust scaling is x -> (x - med) / s with s > 0 (s = iqr, or 1), an
    increasing affine map, and min-max scaling removes any increasing affine
    map (C8). The chain therefore equals min-max of x and is computed in one
    min/max aggregation; no quantile pass is needed. ``inverse_scale`` undoes
    both steps with the same statistics.
    """
    return minmax_scale(df, cols, by, suffix, keep_stats, fit_on, stats)


def inverse_scale(
    df: DataFrame,
    stats: DataFrame,
    col: str | Sequence[str],
    feature: str = "price",
    by: str | Sequence[str] = KEY,
    log1p: bool = True,
    out: str | Sequence[str] | None = None,
) -> DataFrame:
    """M5: undo min-max (and so the chain, C8/C9), then exp(x) - 1 if the
    series was ln(x+1)-transformed; several columns of one feature may be given
    at once. ``stats`` holds ``{feature}_min/_max``."""
    st = stats.select(*_by(by), f"{feature}_min", f"{feature}_max")
    j = with_stats(df, st, by)
    lo, hi = F.col(f"{feature}_min"), F.col(f"{feature}_max")
    todo = {col: out or f"{col}_inv"} if isinstance(col, str) else dict(zip(col, out or [f"{c}_inv" for c in col]))
    for c, name in todo.items():
        x = F.col(c) * _nz(hi - lo) + lo
        j = j.withColumn(name, F.exp(x) - F.lit(1.0) if log1p else x)
    return j.drop(f"{feature}_min", f"{feature}_max")
