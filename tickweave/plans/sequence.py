"""0-based series positions without placing a series in one task.

``row_number() over (partition by currency order by dt)`` sends a whole series
to one task; with few series (or one hot series holding a third of all rows)
that task is unbounded. Instead:

1. Cut points. The rows are counted and a bounded sample of the sort keys is
   drawn; evenly spaced sampled keys become 2^d - 1 literal cut points, about
   ``spark.tickweave.chunkRows`` rows apart. No other job runs at build time and
   nothing is written.
2. The chunk of a row is a deterministic expression of its own key: d
   comparisons down a balanced tree of the cut points. Retried tasks, later jobs
   and the two branches below therefore always agree on it, and any cut points
   give right positions; a poor sample only makes chunks uneven.
3. One narrow pass counts rows per (series, chunk); running sums of that small
   table (at most #chunks + #series rows) are each chunk's offset.
4. One exchange on (series, chunk), ``row_number`` inside the chunk, plus the
   offset. The join with the offsets is on the same key, so it adds no exchange
   of the rows.

Result columns: the input columns plus ``_chunk`` (int), ``pos`` (bigint,
0-based, contiguous per series) and ``n`` (bigint, series length). Rows are
ordered by the order columns ascending with NULLs first. Rows equal in all order
columns are ordered by a hash of the whole row, and stay in one chunk: pass a
unique tie column such as ``event_id`` last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.schema import KEY, ORDER
from tickweave.session import CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS, int_conf

MAX_DEPTH = 16  # at most 65,536 chunks: a literal of a few MB
SAMPLE_PER_CHUNK = 8


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _depth(chunks: int) -> int:
    """Levels of the tree that has at least ``chunks`` leaves."""
    return min(MAX_DEPTH, max(0, chunks - 1).bit_length())


def _levels(df: DataFrame, cols: Sequence[str], rows: int, depth: int) -> list[Column]:
    """Literal cut points, one array a level; level j holds 2^j of them."""
    leaves = 2**depth
    share = min(1.0, leaves * SAMPLE_PER_CHUNK / rows)
    key = F.struct(*cols)
    # a bounded sample: about SAMPLE_PER_CHUNK keys a chunk, sorted in one task
    picked = df.select(key.alias("k")).sample(fraction=share, seed=7).agg(F.array_sort(F.collect_list("k")).alias("s"))
    at = F.sequence(F.lit(1), F.lit(leaves - 1))
    cut = F.transform(at, lambda i: F.get(F.col("s"), F.floor(i * F.size("s") / F.lit(leaves)).cast("int")))
    kind = picked.schema["s"].dataType.elementType
    # Text may shorten a value (timestamps to milliseconds), so the values are read
    # back from it before they are put in order: these are the cut points.
    back = F.transform(F.transform(cut, lambda c: F.to_json(c)), lambda c: F.from_json(c, kind))
    cuts = F.array_sort(F.filter(back, lambda c: c.isNotNull()))
    texts = picked.select(F.transform(cuts, lambda c: F.to_json(c))).first()[0]
    if not texts:
        return []
    texts += [texts[-1]] * (leaves - 1 - len(texts))
    tree = [texts[(leaves >> j + 1) - 1::leaves >> j] for j in range(depth)]
    return [F.from_json(F.lit("[" + ",".join(level) + "]"), T.ArrayType(kind)) for level in tree]


def sequence(
    df: DataFrame,
    key: str | Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
    chunks: int | None = None,
) -> DataFrame:
    """``df`` with ``_chunk``, ``pos`` and ``n``; ``chunks`` (rounded up to a power
    of two) overrides the number derived from the row count."""
    keys = _as_list(key)
    cols = [*keys, *order]
    rows = df.count()
    size = int_conf(df.sparkSession, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS)
    depth = _depth(chunks or -(-rows // size)) if rows else 0
    levels = _levels(df, cols, rows, depth) if depth else []

    # a struct key: it is never NULL, and equal where its fields are both NULL
    x = df.withColumn("_k", F.struct(*keys)).withColumn("_chunk", F.lit(0))
    x = x.withColumn("_o", F.struct(*cols)) if levels else x
    for level in levels:
        right = F.coalesce(F.get(level, F.col("_chunk")) <= F.col("_o"), F.lit(False))
        x = x.withColumn("_chunk", F.col("_chunk") * 2 + right.cast("int"))
    x = x.drop("_o")

    per_chunk = x.groupBy("_k", "_chunk").agg(F.count(F.lit(1)).alias("_cnt"))
    series = Window.partitionBy("_k")
    running = series.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_chunk.select(
        "_k", "_chunk",
        (F.sum("_cnt").over(running) - F.col("_cnt")).alias("_start"),
        F.sum("_cnt").over(series).alias("n"),
    )
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)]
    within = Window.partitionBy("_k", "_chunk").orderBy(*order, F.xxhash64(*hashed))
    out = x.withColumn("_rank", F.row_number().over(within)).join(offsets, ["_k", "_chunk"])
    pos = (F.col("_start") + F.col("_rank") - 1).cast("bigint").alias("pos")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "_chunk", pos, "n")


def _holds_map(t: T.DataType) -> bool:
    """Whether values of the type cannot be hashed."""
    if isinstance(t, T.StructType):
        return any(_holds_map(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType)) or isinstance(t, T.ArrayType) and _holds_map(t.elementType)


def chunk_table(sdf: DataFrame, key: str | Sequence[str] = KEY) -> DataFrame:
    """(key, _chunk, lo, hi, rows) of a sequenced frame; small by construction."""
    keys = _as_list(key)
    return sdf.groupBy(*keys, "_chunk").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.count(F.lit(1)).alias("rows")
    )
