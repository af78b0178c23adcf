"""Tick files: CSV/JSON scans with explicit schemas, raw point-map JSON, sinks.

Nothing is inferred: every scan names its schema, so a malformed value is a
NULL (and counted), not a silently widened column type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.schema import DT, KEY, POINT_DOC, TICK_CSV_HEADER, TIE, TIME_TEXT

# The reference tick CSV, column for column (S1); renamed on read.
_CSV_SCHEMA = T.StructType(
    [
        T.StructField(TICK_CSV_HEADER[0], T.LongType()),
        T.StructField(TICK_CSV_HEADER[1], T.StringType()),
        T.StructField(TICK_CSV_HEADER[2], T.TimestampType()),
    ]
    + [T.StructField(h, T.DoubleType()) for h in TICK_CSV_HEADER[3:]]
)
_RENAME = dict(
    zip(TICK_CSV_HEADER, (TIE, KEY, DT, "price", "volume", "market_cap", "price_btc", "extra"))
)


def _renamed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(_RENAME.get(c, c)) for c in df.columns])


def read_ticks_csv(spark: SparkSession, path: str, ts_format: str = TIME_TEXT) -> DataFrame:
    """Header CSV in the reference layout -> typed tick rows. The unnamed
    index column becomes ``event_id`` (the tie-break of the series order)."""
    df = (
        spark.read.schema(_CSV_SCHEMA)
        .option("header", True)
        .option("timestampFormat", ts_format)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return _renamed(df)


def read_ticks_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines in the reference layout -> typed tick rows."""
    schema = T.StructType([f for f in _CSV_SCHEMA.fields])
    return _renamed(spark.read.schema(schema).option("timestampFormat", TIME_TEXT).json(path))


def points_to_ticks(docs: DataFrame, path_col: str = "_path") -> DataFrame:
    """Flatten point-map documents: one row per point; currency is the parent
    folder of the file (``coindata/<coin>/<yyyymmdd>.json``, F10). A point with
    a non-numeric epoch or a missing price is dropped on its own (C19), not
    the rest of its file; ``v`` shorter than 5 gives NULLs."""
    pts = docs.select(
        # parent folder, Hive style "currency=<c>" accepted too
        F.regexp_replace(F.element_at(F.split(F.col(path_col), "/"), -2), r"^[^=]*=", "").alias(KEY),
        F.explode_outer("data.points").alias("_epoch", "_p"),
    )
    v = F.col("_p.v")
    out = pts.select(
        KEY,
        F.timestamp_seconds(F.col("_epoch").try_cast("bigint")).alias(DT),
        *[F.try_element_at(v, F.lit(i + 1)).alias(n) for i, n in
          enumerate(("price", "volume", "market_cap", "price_btc", "extra"))],
    )
    return out.filter(F.col(DT).isNotNull() & F.col("price").isNotNull())


def read_point_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``coindata/<coin>/<day>.json`` point maps -> tick rows with an
    ``event_id`` tie-break derived from (currency, epoch)."""
    docs = (
        spark.read.schema(POINT_DOC)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .json(path)
        .select("data", F.col("_metadata.file_path").alias("_path"))
    )
    t = points_to_ticks(docs)
    return t.withColumn(TIE, F.xxhash64(KEY, DT))


def point_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Per file: points that could not be used (bad epoch, no price) and
    whether the file itself did not parse."""
    docs = (
        spark.read.schema(POINT_DOC)
        .option("multiLine", True)
        .json(path)
        .select("data", F.col("_metadata.file_path").alias("_path"))
    )
    pts = docs.select("_path", "data", F.explode_outer("data.points").alias("_epoch", "_p"))
    bad = F.col("_epoch").try_cast("bigint").isNull() | F.try_element_at("_p.v", F.lit(1)).isNull()
    return pts.groupBy("_path").agg(
        F.sum(F.when(F.col("data").isNotNull() & F.col("_epoch").isNotNull() & bad, 1).otherwise(0)).alias("bad_points"),
        F.max(F.col("data").isNull()).alias("bad_file"),
    )


def write_ticks(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by_key: bool = False, layout: bool = False) -> None:
    """Time-sorted sink: a range partition on (dt, event_id) plus a sort
    inside each task gives globally ordered files without one sorting task.
    With ``partition_by_key`` the files go to ``currency=<c>/`` folders (range
    on (currency, dt, event_id), so each task writes one or two folders) and
    later currency filters prune whole folders. With ``layout`` the columns get the
    names and order that ``read_ticks_csv`` and ``read_ticks_json`` read."""
    if partition_by_key:
        out = df.repartitionByRange(KEY, DT, TIE).sortWithinPartitions(KEY, DT, TIE)
    else:
        out = df.repartitionByRange(DT, TIE).sortWithinPartitions(DT, TIE)
    if layout:
        names = {v: k for k, v in _RENAME.items() if not (partition_by_key and v == KEY)}
        first = [c for c in _RENAME.values() if c in out.columns]  # CSV is read by place
        out = out.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in [*first, *[c for c in out.columns if c not in first]]])
    w = out.write.mode(mode).option("timestampFormat", TIME_TEXT).option("timestampNTZFormat", TIME_TEXT)
    if partition_by_key:
        w = w.partitionBy(KEY)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_result(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append result lines (e.g. ``coin,corr``) as CSV."""
    df.write.mode(mode).option("header", False).csv(path)


def write_windows(windows: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """Window tensors per split, array columns kept as Parquet lists."""
    windows.write.mode(mode).partitionBy(split).parquet(path)
