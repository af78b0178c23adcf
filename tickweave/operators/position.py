"""Position-based selection: row number, every-nth, slices, first/last rows.

All operate on a *sequenced* frame (``plans.sequence``): columns ``pos``
(0-based, contiguous per series) and ``n`` (series length). Every operator
keeps that contract, renumbering ``pos`` and ``n`` for the rows it keeps, so
operators chain without recomputing positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.scalar import idiv

from tickweave.plans.sequence import sequence
from tickweave.schema import KEY, ORDER


def with_position(df: DataFrame, key: str | Sequence[str] = KEY, order: Sequence[str] = ORDER) -> DataFrame:
    """Add ``pos`` (0-based) and ``n`` per series."""
    return sequence(df, key, order)


def every_nth(sdf: DataFrame, step: int = 12, drop_first: int = 0) -> DataFrame:
    """Keep positions 0, step, 2*step... (``s[::step]``), then drop the
    first ``drop_first`` kept rows (C3, ``price[1:]``). Narrow: no shuffle."""
    if step < 1:
        raise ValueError("step must be >= 1")
    kept = sdf.filter(F.col("pos") % step == 0) if step > 1 else sdf
    out = kept.withColumn("pos", idiv("pos", step) - F.lit(drop_first)).withColumn(
        "n", F.greatest(F.lit(0), idiv(F.col("n") + step - 1, step) - F.lit(drop_first))
    )
    return out.filter(F.col("pos") >= 0) if drop_first else out


def row_at(sdf: DataFrame, p: int) -> DataFrame:
    """P10: the row at position ``p`` (negative counts from the end)."""
    target = F.lit(p) if p >= 0 else F.col("n") + F.lit(p)
    return sdf.filter(F.col("pos") == target)


def slice_rows(sdf: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Python slice ``s[start:stop]`` per series, renumbered."""

    def bound(v: int | None, default):
        if v is None:
            return default
        return F.lit(v) if v >= 0 else F.greatest(F.lit(0), F.col("n") + F.lit(v))

    lo = F.least(bound(start, F.lit(0)), F.col("n"))
    hi = F.least(bound(stop, F.col("n")), F.col("n"))
    return (
        sdf.withColumn("_lo", lo)
        .withColumn("_hi", F.greatest(hi, F.col("_lo")))
        .filter((F.col("pos") >= F.col("_lo")) & (F.col("pos") < F.col("_hi")))
        .withColumn("pos", F.col("pos") - F.col("_lo"))
        .withColumn("n", F.col("_hi") - F.col("_lo"))
        .drop("_lo", "_hi")
    )


def first_n(sdf: DataFrame, k: int) -> DataFrame:
    """T2 per series: first k rows."""
    return slice_rows(sdf, 0, k)


def last_n(sdf: DataFrame, k: int) -> DataFrame:
    """T3 per series: last k rows, as a DataFrame (not a driver list)."""
    return slice_rows(sdf, -k if k else None, None) if k else sdf.limit(0)


def sort_ticks(df: DataFrame, key: str = KEY, order: Sequence[str] = ORDER) -> DataFrame:
    """Global sort by (key, order); a range-partitioned sort, not a collect."""
    return df.orderBy(key, *order)


def first_rows(df: DataFrame, k: int, order: Sequence[str] = ORDER) -> DataFrame:
    """T2 global: first k rows in time order (top-k: partial sort per task)."""
    return df.orderBy(*order).limit(k)


def last_rows(df: DataFrame, k: int, order: Sequence[str] = ORDER) -> DataFrame:
    """T3 global: the last k rows in time order (top-k on the reversed order;
    a DataFrame, not the driver list ``DataFrame.tail`` returns, C12)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(k)


def repartitioned(df: DataFrame, n: int) -> DataFrame:
    """T5: round-robin repartition; results must not depend on n."""
    return df.repartition(n)

