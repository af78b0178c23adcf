"""Broadcast only what has a checked size; shuffle-join above the bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.session import (
    BROADCAST_BYTES_CONF,
    BROADCAST_ROWS_CONF,
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_BROADCAST_ROWS,
    checkpoint_root,
    int_conf,
)


def row_width(schema: T.StructType) -> int:
    """Rough bytes per row: fixed widths, 32 for strings, 8 per element x 16
    for arrays (used only to bound broadcasts)."""

    def w(t: T.DataType) -> int:
        if isinstance(t, T.StructType):
            return sum(w(f.dataType) for f in t.fields)
        if isinstance(t, (T.ArrayType, T.MapType)):
            return 16 * 8
        if isinstance(t, (T.StringType, T.BinaryType)):
            return 32
        return 8

    return 8 + w(schema)


def bounded_broadcast(df: DataFrame, limit: int | None = None, materialize: bool = True) -> DataFrame:
    """Materialise ``df``, count it, and mark it for broadcast only under the bound.

    Used for one-row-per-series statistics and per-chunk tables whose size is
    bounded by (#series + #chunks), not by the data. The bound is a row count
    and an estimated byte size; above either, the plain DataFrame is returned
    and Spark plans a shuffle join.
    """
    spark = df.sparkSession
    bound = limit if limit is not None else int_conf(
        spark, BROADCAST_ROWS_CONF, DEFAULT_BROADCAST_ROWS
    )
    max_bytes = int_conf(spark, BROADCAST_BYTES_CONF, DEFAULT_BROADCAST_BYTES)
    # A reliable checkpoint, not cache(): it cuts the lineage (a lost executor
    # cannot change the table), and AQE sizes its partitions (a cached plan
    # keeps every shuffle partition, hundreds of near-empty ones). Tables that
    # are cheap and deterministic to recompute (``materialize=False``, e.g. a
    # chunk table read from narrow columns of a written table) are only counted.
    if materialize:
        checkpoint_root(spark)
        df = df.checkpoint(eager=True)
    rows = df.count()
    small = rows <= bound and rows * row_width(df.schema) <= max_bytes
    return F.broadcast(df) if small else df
