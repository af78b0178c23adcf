"""Positions stored once: a bucketed table of position blocks with their halo rows.

``sequence`` and ``neighbors`` repeat a scan and an exchange for every action. A
job that uses positions many times writes them as a table that is bucketed by
(series, block) and sorted by position, with the rows that a block needs of its
neighbours stored in it (``_own`` false). Whatever looks at neighbouring rows then
reads its blocks as they lie: no exchange and no sort of the ticks.

The width of the halo is kept with the column ``_blk``; ``with_neighbors`` takes such a
frame as it is, and refuses one whose halo is too small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.plans.neighbors import own_rows, with_neighbors
from tickweave.schema import KEY

__all__ = ["own_rows", "store_positions"]


def store_positions(
    sdf: DataFrame,
    table: str,
    before: int = 64,
    after: int = 64,
    buckets: int | None = None,
    key: str | Sequence[str] = KEY,
    rows: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Write a sequenced frame as ``table`` of the session's catalog, with halos of
    ``before`` and ``after`` rows, and return it; its files lie in ``path`` or in the
    warehouse. ``own_rows`` gives the ticks back."""
    spark = sdf.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = with_neighbors(sdf, key, before, after, rows)
    blocks = blocks.withColumn("_blk", F.col("_blk").alias("_blk", metadata={"before": before, "after": after}))
    # one file a bucket, in order
    blocks = blocks.repartition(count, *keys, "_blk")
    writer = blocks.write.bucketBy(count, *keys, "_blk").sortBy(*keys, "_blk", "pos").mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return spark.table(table)
