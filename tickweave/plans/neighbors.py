"""Blocks of consecutive positions with halo rows for lag/lead/sliding frames.

Position ``p`` of a series belongs to block ``p div B``. A block also needs the
``before`` rows preceding it and the ``after`` rows following it; those rows
are emitted a second time, tagged with the neighbouring block (``_own`` =
false). With ``B >= max(before, after)`` a row is copied at most once per
direction, so the exchange moves ``1 + (before + after) / B`` times the input
and every window task holds at most ``B + before + after`` rows, however long
or skewed the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.scalar import idiv
from tickweave.schema import KEY
from tickweave.session import BLOCK_ROWS_CONF, DEFAULT_BLOCK_ROWS, int_conf


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def block_rows(df: DataFrame, before: int, after: int, rows: int | None = None) -> int:
    B = rows or int_conf(df.sparkSession, BLOCK_ROWS_CONF, DEFAULT_BLOCK_ROWS)
    return max(B, before, after, 1)


def with_neighbors(
    sdf: DataFrame,
    key: str | Sequence[str] = KEY,
    before: int = 0,
    after: int = 0,
    rows: int | None = None,
) -> DataFrame:
    """Add ``_blk`` and ``_own``; own rows plus halo copies for each block. A frame
    that has them stored (``plans.stored``) is taken as it is."""
    if {"_blk", "_own"} <= set(sdf.columns):
        stored = sdf.schema["_blk"].metadata
        if stored.get("before", 0) < before or stored.get("after", 0) < after:
            raise ValueError(f"the stored halo {stored} is smaller than ({before}, {after})")
        return sdf
    B = block_rows(sdf, before, after, rows)
    blk = idiv("pos", B)
    if not before and not after:
        return sdf.withColumn("_blk", blk).withColumn("_own", F.lit(True))
    off = F.col("pos") % F.lit(B)

    def tag(b, own):
        return F.struct(b.alias("b"), F.lit(own).alias("own"))

    own = tag(blk, True)
    to_prev = (off < after) & (blk > 0) if after else F.lit(False)  # first rows -> previous block
    to_next = off >= B - before if before else F.lit(False)  # last rows -> next block
    prev, nxt = tag(blk - 1, False), tag(blk + 1, False)
    # plain CASE over fixed arrays (no lambda): most rows get array(own)
    tags = (
        F.when(to_prev & to_next, F.array(own, prev, nxt))
        .when(to_prev, F.array(own, prev))
        .when(to_next, F.array(own, nxt))
        .otherwise(F.array(own))
    )
    return (
        sdf.withColumn("_t", F.explode(tags))
        .withColumn("_blk", F.col("_t.b"))
        .withColumn("_own", F.col("_t.own"))
        .drop("_t")
    )


def own_rows(sdf: DataFrame) -> DataFrame:
    """The rows without halo copies, of a stored frame or any other."""
    return sdf.filter("_own").drop("_blk", "_own") if {"_blk", "_own"} <= set(sdf.columns) else sdf


def block_window(key: str | Sequence[str] = KEY) -> Window:
    return Window.partitionBy(*_keys(key), "_blk").orderBy("pos")


def lagged(
    sdf: DataFrame,
    cols: dict[str, tuple[str, int]],
    key: str | Sequence[str] = KEY,
    rows: int | None = None,
) -> DataFrame:
    """Add columns ``name -> (source column, offset)``; offset > 0 is a lag
    (earlier row), < 0 a lead. Values outside the series are NULL."""
    before = max([o for _, o in cols.values() if o > 0], default=0)
    after = max([-o for _, o in cols.values() if o < 0], default=0)
    nb = with_neighbors(sdf, key, before=before, after=after, rows=rows)
    w = block_window(key)
    for name, (src, o) in cols.items():
        nb = nb.withColumn(name, F.lag(src, o).over(w) if o > 0 else F.lead(src, -o).over(w))
    return nb.filter("_own").drop("_blk", "_own")
