"""Daily tables, movement labels, correlation sweeps and sentinel-ended series.

The reference runs one correlation job per coin, each re-reading the file; here
one grouped query covers every coin against the base series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.scalar import safe_div
from tickweave.operators.stats import guarded_corr
from tickweave.plans.sequence import sequence
from tickweave.plans.small import bounded_broadcast
from tickweave.schema import DT, KEY, TIE

# End-of-series marker of the wide daily-change table (fixed value).
SENTINEL = 100000.0


def daily_last(df: DataFrame, col: str = "price", key: str = KEY, out: str = "close") -> DataFrame:
    """Last value per (series, day) by (dt, event_id): key, d_, close."""
    return df.groupBy(key, F.to_date(DT).alias("d_")).agg(
        F.max_by(F.col(col), F.struct(F.col(DT), F.col(TIE))).alias(out)
    )


def daily_mean(df: DataFrame, col: str = "price", key: str = KEY, out: str = "v") -> DataFrame:
    """Mean value per (series, day)."""
    return df.groupBy(key, F.to_date(DT).alias("d_")).agg(F.avg(col).alias(out))


def daily_change(df: DataFrame, col: str = "price", key: str = KEY) -> DataFrame:
    """Day-over-day change of the last daily value: key, d_, close, chg.

    The lag runs over the daily table (one row per series and day), whose
    per-series size is the number of days, not the number of ticks."""
    d = daily_last(df, col, key)
    w = Window.partitionBy(key).orderBy("d_")
    return d.withColumn("chg", safe_div("close", F.lag("close").over(w)) - F.lit(1.0))


def daily_change_wide(df: DataFrame, currencies: Sequence[str] | None = None, col: str = "price",
                      key: str = KEY) -> DataFrame:
    """One row per day, one change column per currency. Listing the
    currencies saves the job that discovers them (one row per series)."""
    ch = daily_change(df, col, key)
    g = ch.groupBy("d_")
    return (g.pivot(key, list(currencies)) if currencies else g.pivot(key)).agg(F.first("chg"))


def series_dictionary(df: DataFrame, key: str = KEY) -> DataFrame:
    """key, idx: the series that have a name, numbered from 0 in its order, whatever
    their number (``plans.sequence``)."""
    names = df.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("_one", F.lit(0))
    return sequence(names, key="_one", order=(key,)).select(key, F.col("pos").cast("int").alias("idx"))


def daily_change_sparse(df: DataFrame, dictionary: DataFrame, col: str = "price", key: str = KEY) -> DataFrame:
    """M16 beyond the number of columns that a pivot can have: one row per day,
    d_, idx (ascending places in the ``dictionary``) and chg (the changes there). A
    series without a change that day takes no place."""
    ch = daily_change(df, col, key).filter(F.col("chg").isNotNull()).join(bounded_broadcast(dictionary), key)
    row = F.array_sort(F.collect_list(F.struct("idx", "chg")))  # at most one a series
    return ch.groupBy("d_").agg(row.alias("r")).select("d_", F.transform("r", lambda x: x["idx"]).alias("idx"), F.transform("r", lambda x: x["chg"]).alias("chg"))


def sparse_columns(wide: DataFrame, dictionary: DataFrame, names: Sequence[str], key: str = KEY) -> DataFrame:
    """The columns of a few series out of the sparse daily table, NULL where a series
    has no change."""
    places = {r[0]: r[1] for r in dictionary.filter(F.col(key).isin(*names)).collect()}
    at = lambda n: F.get("chg", (F.nullif(F.array_position("idx", F.lit(places.get(n, -1))), F.lit(0)) - 1).cast("int"))
    return wide.select("d_", *[at(n).alias(n) for n in names])


def movement_label(df: DataFrame, col: str = "price", key: str = KEY) -> DataFrame:
    """move = 1.0 if the daily change is positive else 0.0 (our
    definition; the reference consumes but does not produce the label)."""
    ch = daily_change(df, col, key).filter(F.col("chg").isNotNull())
    return ch.select(key, "d_", F.when(F.col("chg") > 0, 1.0).otherwise(0.0).alias("move"))


def align_pair(daily: DataFrame, base: str, value: str = "v", key: str = KEY, on: str = "d_") -> DataFrame:
    """Every series' value next to the base series' value at the same
    index. The base side is one series of the daily table (size-checked)."""
    b = daily.filter(F.col(key) == base).select(F.col(on), F.col(value).alias("base_v"))
    return daily.join(bounded_broadcast(b), on).select(F.col(key).alias("coin"), on, "base_v", F.col(value).alias("alt_v"))


def corr_sweep(daily: DataFrame, base: str, value: str = "v", key: str = KEY, on: str = "d_") -> DataFrame:
    """Pearson correlation of the base series with every series (the
    base with itself is 1), aligned on ``on``; one grouped aggregation."""
    pairs = align_pair(daily, base, value, key, on)
    return pairs.groupBy("coin").agg(F.count(F.lit(1)).alias("n"), guarded_corr("base_v", "alt_v").alias("corr"))


def rank_by_corr(sweep: DataFrame, k: int | None = None) -> DataFrame:
    """T4: coins by correlation, descending, with their rank; top k if given.
    The sweep has one row per coin, so the global order is over a few rows."""
    w = Window.orderBy(F.col("corr").desc_nulls_last(), F.col("coin"))
    out = sweep.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return out.filter(F.col("rank") <= k) if k else out


def wide_to_long(wide: DataFrame, index: str = "Index", key: str = KEY, value: str = "chg") -> DataFrame:
    """The reference's wide change table (one column per coin plus an index
    column) -> long form (key, pos, value); values are try-cast to double so
    text cells never raise (C16)."""
    coins = [c for c in wide.columns if c != index]
    long = wide.unpivot([index], coins, key, "_v")
    return long.select(key, F.col(index).try_cast("bigint").alias("pos"), F.col("_v").try_cast("double").alias(value))


def series_end(sdf: DataFrame, col: str, key: str = KEY, sentinel: float = SENTINEL) -> DataFrame:
    """First position whose value is the sentinel (NULL if none)."""
    return sdf.groupBy(key).agg(F.min(F.when(F.col(col) == F.lit(sentinel), F.col("pos"))).alias("end_pos"))


def sentinel_corr(sdf: DataFrame, base: str, col: str, key: str = KEY, sentinel: float = SENTINEL) -> DataFrame:
    """P6 + J2 + A7: each coin against the base, aligned by position, both
    series cut before the earlier of their sentinels (C13); coin, n, corr."""
    ends = series_end(sdf, col, key, sentinel)
    ends = ends.withColumn("end_pos", F.coalesce("end_pos", F.lit(2**62)))
    e = bounded_broadcast(ends)
    v = sdf.select(key, "pos", F.col(col).alias("_v")).join(e, key)
    b = v.filter(F.col(key) == base).select("pos", F.col("_v").alias("base_v"), F.col("end_pos").alias("base_end"))
    pairs = v.join(b, "pos").filter(F.col("pos") < F.least("end_pos", "base_end"))
    return pairs.groupBy(F.col(key).alias("coin")).agg(
        F.count(F.lit(1)).alias("n"), guarded_corr("base_v", "_v").alias("corr")
    )


def missing_days(df: DataFrame, start: str, end: str, key: str = KEY) -> DataFrame:
    """(series, day) pairs of the calendar [start, end] with no tick. The
    calendar is generated per series (one row per series and day), then
    anti-joined with the distinct days present."""
    present = df.select(key, F.to_date(DT).alias("d_")).distinct()
    cal = (
        df.select(key)
        .distinct()
        .select(key, F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("d_"))
    )
    return cal.join(present, [key, "d_"], "left_anti")
