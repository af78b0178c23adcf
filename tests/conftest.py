import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickweave.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tickweave-test-ckpt-")
    s = get_session(
        "local[4]",
        app="tickweave-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture
def small_blocks(spark):
    """Force tiny blocks so halo copies cross many block edges."""
    from tickweave.session import BLOCK_ROWS_CONF

    spark.conf.set(BLOCK_ROWS_CONF, "7")
    yield 7
    spark.conf.unset(BLOCK_ROWS_CONF)


def make_ticks(spark, rows):
    """rows: iterable of (currency, epoch_seconds, event_id, price, volume, market_cap)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        list(rows), "currency string, epoch long, event_id long, price double, volume double, market_cap double"
    )
    return df.select("currency", F.timestamp_seconds("epoch").alias("dt"), "event_id", "price", "volume",
                     "market_cap")
