"""Helpers shared by the operators: tables, written intermediates, fold ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.session import scratch_path, ship_package

ARROW_ROWS = "512"  # rows that Python gets at once: texts may be long

# The white space that separates words in the contracts.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """What every query and stage needs: small Arrow batches, and workers that
    can import the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the rows once, keeps
    them compressed and columnar, and survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0. A null id is held out too,
    so that no model learns from a row that cannot be told apart."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def hash_sample(df: DataFrame, key: Column, bound: int, rows: int, seed: int = 7) -> DataFrame:
    """About ``bound`` of ``rows`` rows, chosen by the hash of ``key``: the same
    rows whatever the partitioning, all of them if there are no more than that."""
    if rows <= bound:
        return df
    share = int(bound / rows * 1_000_000_007)
    return df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000_007)) < share)


def label_sample(spark: SparkSession, labels: DataFrame, column: str, bound: int) -> DataFrame:
    """(doc_id, y) of a bounded sample of usable labelled rows outside the held
    out fold. Repeated ids count once; an id with conflicting labels or a label
    other than 0 and 1 teaches nothing. At most about ``bound`` rows, so the
    result may be broadcast."""
    y = F.col(column)
    one = (
        labels.select(F.col("doc_id").alias("doc_id"), y.cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("y").isin(0, 1))
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y_max"))
        .filter(F.col("y") == F.col("y_max")).select("doc_id", "y")
    )
    return hash_sample(one, F.col("doc_id"), bound, one.count())


def labelled_texts(docs: DataFrame, sample: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, y) of the documents of a ``label_sample``. A repeated row
    counts once; at most about ``bound`` rows, however often an id occurs."""
    h = "__text_hash"
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias(h)).join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id", h])
    return hash_sample(rows, F.struct("doc_id", h), bound, rows.count()).drop(h)
