"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Rows per block for windowed operators (see plans.neighbors). A block is the
# unit of work of one window task; halo rows are copied across block edges.
BLOCK_ROWS_CONF = "spark.tickweave.blockRows"
DEFAULT_BLOCK_ROWS = 262_144

# Rows per chunk when positions are computed (see plans.sequence).
CHUNK_ROWS_CONF = "spark.tickweave.chunkRows"
DEFAULT_CHUNK_ROWS = 1_000_000

# Largest small side (rows) that is broadcast; above it a shuffle join is used.
BROADCAST_ROWS_CONF = "spark.tickweave.broadcastRows"
DEFAULT_BROADCAST_ROWS = 1_000_000
# ... and largest estimated size (rows x fixed-width estimate of the schema).
BROADCAST_BYTES_CONF = "spark.tickweave.broadcastBytes"
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def get_session(
    master: str | None = None,
    app: str = "tickweave",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    ANSI mode stays on (Spark 4 default); operators guard divisors and casts
    explicitly. The UI is off: nothing here opens a port of its own.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only a local-mode
    session without the setting gets a folder of its own, as in tests.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
            )
        root = tempfile.mkdtemp(prefix="tickweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint root for one materialised table."""
    root = checkpoint_root(spark)
    return os.path.join(root.rstrip("/"), f"{label}-{uuid.uuid4().hex}")


def int_conf(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v else default


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the Python workers, once per application:
    functions that run there are found by import, whatever folder or path the
    driver was started with."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(top)):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="tickweave-ship-"), "tickweave.zip")
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
