"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are put in a fixed pseudo-random order and cut into blocks.
A source of weight w (among the sources that still have blocks) should have
had a fluid share of the blocks placed so far; block i of it is released when
that share passes i and is due when it passes i + 1. Earliest deadline first
over the released blocks then keeps every source less than one block from its
share at all times. When a source runs out, its weight goes to the others in
proportion; no row is dropped or repeated.

Only (source, number of rows) reaches the driver, where the blocks are
scheduled; their number is bounded (``MOST_BLOCKS``: blocks grow with the
table). Places within a source come from counted hash chunks, and chunks of many
rows with one key from counted parts, so that no task ever ranks a whole source.

Defined results: a null source is a source of its own (weight 1 unless given);
an empty table gives an empty result; repeated rows and null ids each keep
their own place (equal rows in any order); other columns are carried along, and
the added ones are named by the caller.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickweave.llm.common import written
from tickweave.plans.small import bounded_broadcast

BLOCK_ROWS = 64  # of a small table
MOST_BLOCKS = 100_000
CHUNK_ROWS = 4_096
K = "__mix_"


def fluid(blocks: list[int], weights: list[Fraction]) -> list[tuple[Fraction, list[Fraction], list[Fraction]]]:
    """Breakpoints of the fluid schedule: (time, blocks had by each source,
    rate of each source from then on)."""
    had, at, out = [Fraction(0)] * len(blocks), Fraction(0), []
    alive = [i for i, n in enumerate(blocks) if n]
    while alive:
        total = sum(weights[i] for i in alive)
        rate = [weights[i] / total if i in alive else Fraction(0) for i in range(len(blocks))]
        out.append((at, list(had), rate))
        step = min((blocks[i] - had[i]) / rate[i] for i in alive)
        at += step
        had = [h + r * step for h, r in zip(had, rate)]
        alive = [i for i in alive if had[i] < blocks[i]]
    return out


def schedule(blocks: list[int], weights: list[Fraction]) -> list[tuple[int, int]]:
    """(source, block) of each slot, by earliest deadline among the released."""
    parts = fluid(blocks, weights)

    def times(i: int):
        """When the fluid share of source i passes 0, 1, 2, ..."""
        k = 0
        for j, (at, had, rate) in enumerate(parts):
            if not rate[i]:
                continue
            end = parts[j + 1][1][i] if j + 1 < len(parts) else Fraction(blocks[i])
            while k <= end and k >= had[i]:
                yield at + (k - had[i]) / rate[i]
                k += 1

    steps = [times(i) for i in range(len(blocks))]
    begun = [next(s, Fraction(0)) for s in steps]
    due = [next(s, Fraction(0)) for s in steps]
    waiting = [(math.floor(begun[i]), i, 0) for i, n in enumerate(blocks) if n]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    out = []
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            _, i, b = heapq.heappop(waiting)
            heapq.heappush(ready, (math.ceil(due[i]), i, b))
        _, i, b = heapq.heappop(ready)
        out.append((i, b))
        if b + 1 < blocks[i]:
            release = math.floor(due[i])
            due[i] = next(steps[i])
            heapq.heappush(waiting, (release, i, b + 1))
    return out


def target_weights(sizes: dict[str | None, int], weights: dict[str | None, float] | None) -> dict[str | None, Fraction]:
    """The given weights (1 where none is given); without any, the square root
    of the size in whole numbers: large sources lead, small ones are raised."""
    if weights is None:
        return {s: Fraction(max(1, math.isqrt(n))) for s, n in sizes.items()}
    out = {s: Fraction(weights.get(s, 1)).limit_denominator(1_000) for s in sizes}
    if min(out.values(), default=1) <= 0:
        raise ValueError("target weights must be positive (to a thousandth)")
    return out


def mix(df: DataFrame, source: str = "source", key: Column | None = None, weights: dict[str | None, float] | None = None,
        seed: int = 42, block_rows: int = BLOCK_ROWS, most_blocks: int = MOST_BLOCKS, tie: str | None = None) -> DataFrame:
    """``df`` with ``__mix_block`` (of its source), ``__mix_slot`` (when the
    block is placed) and ``__mix_pos`` (place of the row in the mix, from 0).
    ``key`` orders the rows within a source (by its hash; default doc_id); ``tie``, a
    column that is another in every row, spreads rows of one key over tasks."""
    spark = df.sparkSession
    h = F.xxhash64(key if key is not None else F.col("doc_id"), F.lit(seed))
    rows = df.withColumns({f"{K}src": F.col(source).cast("string"), f"{K}h": h})
    sizes = {r[0]: r[1] for r in rows.groupBy(f"{K}src").count().collect()}  # one row a source
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    total = sum(sizes.values())
    size = max(block_rows, -(-total // most_blocks))
    share = target_weights(sizes, weights)
    blocks = [-(-sizes[s] // size) for s in names]
    slots = schedule(blocks, [share[s] for s in names])
    plan, at = [], 0
    for slot, (i, b) in enumerate(slots):
        plan.append((i, b, slot, at))
        at += min(size, sizes[names[i]] - b * size)
    # chunks of a source: ranges of its hash, small enough to be ranked in one task
    kind = T.StructType([T.StructField(f"{K}src", T.StringType()), T.StructField(f"{K}no", T.IntegerType()), T.StructField(f"{K}chunks", T.LongType())])
    table = spark.createDataFrame([(s, i, max(1, sizes[s] // CHUNK_ROWS)) for i, s in enumerate(names)], kind)
    table = table.withColumnRenamed(f"{K}src", f"{K}s")
    rows = rows.join(F.broadcast(table), F.col(f"{K}src").eqNullSafe(F.col(f"{K}s")))
    # the upper 31 bits of the hash, scaled to the number of chunks
    top = F.shiftrightunsigned(f"{K}h", 33)
    rows = rows.withColumn(f"{K}chunk", F.shiftright(top * F.col(f"{K}chunks"), 31)).drop(f"{K}s", f"{K}src", f"{K}chunks")
    counts = written(rows.groupBy(f"{K}no", f"{K}chunk").count(), "mix-chunks")
    at = [f"{K}no", f"{K}chunk"]
    hot = counts.filter(F.col("count") > 4 * CHUNK_ROWS)
    if tie and hot.head(1):  # many rows of one key: parts by the hash of their own tie
        parts = hot.select(*at, F.ceil(F.col("count") / CHUNK_ROWS).alias(f"{K}parts"))
        rows = rows.join(bounded_broadcast(parts), at, "left")
        rows = rows.withColumn(f"{K}part", F.pmod(F.xxhash64(tie, F.lit(seed)), F.coalesce(f"{K}parts", F.lit(1).cast("long")))).drop(f"{K}parts")
        at.append(f"{K}part")
        counts = written(rows.groupBy(*at).count(), "mix-parts")
    before = Window.partitionBy(f"{K}no").orderBy(*at[1:]).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*at, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(f"{K}first"))
    inside = Window.partitionBy(*at).orderBy(F.shiftrightunsigned(F.col(f"{K}h"), 1), F.col(f"{K}h"))
    rows = rows.join(first, at)
    rows = rows.withColumn(f"{K}in", F.col(f"{K}first") + F.row_number().over(inside) - 1)
    rows = rows.withColumn(f"{K}block", F.floor(F.col(f"{K}in") / size))
    slot_table = spark.createDataFrame(plan or [(-1, -1, -1, -1)], f"{K}no int, {K}block long, {K}slot long, {K}at long")
    rows = rows.join(F.broadcast(slot_table), [f"{K}no", f"{K}block"])  # at most MOST_BLOCKS rows and one a source
    rows = rows.withColumn(f"{K}pos", F.col(f"{K}at") + F.pmod(F.col(f"{K}in"), F.lit(size)))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], f"{K}block", f"{K}slot", f"{K}pos")


def positions(docs: DataFrame) -> DataFrame:
    """doc_id, source, block, slot, position of every row."""
    # written, so that a retried task finds every row under its own number again
    rows = written(docs.select("doc_id", "source", F.monotonically_increasing_id().alias(f"{K}row")), "mix-rows")
    rows = mix(rows, tie=f"{K}row")
    return rows.select("doc_id", "source", F.col(f"{K}block").alias("block"), F.col(f"{K}slot").alias("slot"), F.col(f"{K}pos").alias("position"))


def in_mixed_order(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in the order of the mix (files and rows of a write)."""
    rows = mix(docs, key=F.struct("doc_id", F.xxhash64("text")))
    return rows.repartitionByRange(f"{K}slot").sortWithinPartitions(f"{K}pos").drop(f"{K}block", f"{K}slot", f"{K}pos")


def stored_positions(docs: DataFrame, name: str = "position") -> DataFrame:
    """``docs`` with each row's place, from 0, in the order in which its files hold
    the rows: after a write of ``in_mixed_order`` its place in the mix, whatever
    partitions the files are read in. Rows that come from no file are written
    first, in the order they have."""
    file, row = f"{K}file", f"{K}row"
    place = (F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    try:
        rows = docs.select("*", *place)
    except AnalysisException:
        rows = written(docs, "mix-rows").select("*", *place)
    sizes = rows.groupBy(file).agg((F.max(row) + 1).alias(f"{K}n")).withColumn(f"{K}part", F.expr(f"try_cast(regexp_extract({file}, 'part-([0-9]+)[^/]*$', 1) as bigint)"))
    before = Window.orderBy(f"{K}part", file).rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    first = sizes.select(file, F.coalesce(F.sum(f"{K}n").over(before), F.lit(0)).alias(f"{K}first"))
    rows = rows.join(bounded_broadcast(first), file)
    return rows.withColumn(name, F.col(f"{K}first") + F.col(row)).select(*[F.col(f"`{c}`") for c in docs.columns if c != name], name)
