"""Adapter from the driver's ``events`` table to tick rows.

``events`` stands in for the reference's tick table: one series per
``event_type``. The mapping (fixed values, shared with every oracle query):

    currency   = event_type
    dt         = ts
    event_id   = event_id            (tie-break of the series order)
    price      = value
    volume     = cast(get_json_object(props, '$.k') as double)
    market_cap = value * (user_id + 1)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ticks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("currency"),
        F.col("ts").alias("dt"),
        F.col("event_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
        (F.col("value") * (F.col("user_id") + 1)).alias("market_cap"),
    )
