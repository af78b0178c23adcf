"""Hard-negative mining by best-first search of an STR-packed R-tree.

Packing (Sort-Tile-Recursive). The vectors of each label are put in order of
their most spread coordinate and cut into slabs, each slab in order of the next
and cut into tiles (``plans.sequence``: exact positions, no label in one task).
Inside a tile numpy goes on with the tile's own most spread coordinates down to
leaf pages of at most 64 vectors. A page is one row of a written table: its
vectors, and the minimum and maximum of every coordinate. Every row is packed;
only the choice of the first two coordinates looks at a sample (SAMPLE rows).

Search. Anchors go out in blocks of bounded size; no vector is shuffled for
them. A task reads pages batch by batch, packs the boxes of a batch into the
upper levels of a tree, and keeps for every anchor and score window the best
``k`` so far, which it hands on from batch to batch. A box gives an interval of
inner products, coordinate by coordinate. The best-first queue prunes boxes
whose interval lies outside all windows or strictly below the k-th best, and
boxes of labels that are not looked for. The lists of the tasks are then ranked.

The first search has one window without ends and looks for an anchor's
positives (same label), the second one window a positive and looks for its
negatives (other labels).

Components become floor(scale * x). Defined results: rows with a null id,
label or vector, or any null or non-finite component, take no part; an empty
vector scores 0 with all; vectors of different lengths score as if padded with
zeros; repeated rows count as often as they occur (an anchor's others are all
rows but itself), ties go to the smaller id; a negative positive score has an
empty window; scores are exact, and null if beyond the longs; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions.scalar import idiv
from tickweave.llm.common import hash_sample, written
from tickweave.plans.sequence import sequence
from tickweave.session import scratch_path

PAGE_ROWS = 64
PAGE_BYTES = 32 << 10
FANOUT = 16
TILE_ROWS = 4_096
BLOCK_ROWS = 4_096  # anchors that are sent out at a time, at most ...
BLOCK_BYTES = 8 << 20  # ... and the bytes of their vectors
SAMPLE = 65_536
LOCAL_COORDINATES = 3

PAGES = "label long, width int, ids binary, rows binary, vectors binary, low binary, high binary"
FOUND = "anchor_row long, anchor_id long, slot int, positive_id long, positive_score string, vec_id long, row long, score string"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v: the rows that take part, with whole-number components as
    doubles (exact: a float or double times a power of two)."""
    x = F.col(embedding).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(fine, F.lit(False)))
    # doubles from 2^53 on are whole already, and may be beyond the longs
    whole = lambda c: F.when(F.abs(c * scale) < 2.0**53, F.floor(c * scale).cast("double")).otherwise(c * scale)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.transform(x, whole).alias("v"))


def _matrix(parts: Sequence, width: int) -> np.ndarray:
    out = np.zeros((len(parts), width))
    for i, p in enumerate(parts):
        out[i, :len(p)] = p
    return out


def _numbers(m: np.ndarray, exact: bool) -> np.ndarray:
    """Doubles where they hold all scores exactly, Python's integers elsewhere."""
    return m if exact else np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)


# ------------------------------------------------------------------ packing
def tiled(m: np.ndarray, rows: np.ndarray, coordinates: Sequence[int], page: int) -> np.ndarray:
    """``rows`` of ``m`` in STR order: sorted by the first coordinate, cut into
    slabs of whole pages, each slab tiled by the coordinates that are left."""
    if len(rows) <= page or not len(coordinates):
        return rows
    rows = rows[np.argsort(m[rows, coordinates[0]], kind="stable")]
    pages = -(-len(rows) // page)
    slab = -(-pages // math.ceil(pages ** (1 / len(coordinates)))) * page
    return np.concatenate([tiled(m, rows[i:i + slab], coordinates[1:], page) for i in range(0, len(rows), slab)])


def _pack_tile(width: int, page: int):
    def pack(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        m = _matrix(f["v"], width)
        spread = np.argsort(-m.var(axis=0), kind="stable")[:LOCAL_COORDINATES]
        order = tiled(m, np.lexsort((f["row"], f["vec_id"])), spread, page)
        ids, rows, m = f["vec_id"].to_numpy(np.int64)[order], f["row"].to_numpy(np.int64)[order], m[order]
        out = []
        for i in range(0, len(m), page):
            part = m[i:i + page]
            blobs = (ids[i:i + page], rows[i:i + page], part, part.min(axis=0), part.max(axis=0))
            out.append((int(key[0]), width, *(b.tobytes() for b in blobs)))
        return pd.DataFrame(out, columns=["label", "width", "ids", "rows", "vectors", "low", "high"])

    return pack


def leaf_pages(rows: DataFrame, count: int, width: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The leaf pages over ``rows`` (row, vec_id, label, v), a row each."""
    picked = hash_sample(rows, F.col("row"), SAMPLE, count).select(F.posexplode("v").alias("at", "x"))
    spread = picked.groupBy("at").agg(F.var_pop("x").alias("var")).orderBy(F.desc("var"), "at").limit(2).collect()
    first, second = ([r["at"] for r in spread] + [0, 0])[:2]
    at = lambda j: F.coalesce(F.get("v", F.lit(j)), F.lit(0.0))
    keys = rows.select("row", "label", at(first).alias("a"), at(second).alias("b"))
    slabs = sequence(keys, key="label", order=("a", "row"))
    # a label of n rows has ceil(n / tile_rows) tiles in about the root of that many slabs
    tiles = F.ceil(F.col("n") / tile_rows)
    slab_rows = F.ceil(tiles / F.ceil(F.sqrt(tiles))) * tile_rows
    slabs = written(slabs.select("row", "label", "b", F.floor(F.col("pos") / slab_rows).alias("slab")), "mining-slabs")
    tile = sequence(slabs, key=("label", "slab"), order=("b", "row")).select("row", "slab", idiv("pos", tile_rows).alias("tile"))
    page = max(1, min(PAGE_ROWS, PAGE_BYTES // (8 * max(width, 1))))
    # as many files as tasks may run: a search task reads whole files
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // (16 * tile_rows)))
    placed = rows.join(tile, "row").repartition(parts, "label", "slab", "tile")
    return placed.groupBy("label", "slab", "tile").applyInPandas(_pack_tile(width, page), PAGES)


# ------------------------------------------------------------------- search
class Tree:
    """An R-tree over a batch of leaf pages; its upper levels are packed in the
    order of the pages, FANOUT boxes a node. A box also spans its labels."""

    def __init__(self, pages: pd.DataFrame, exact: bool):
        pages = pages.sort_values("label", kind="stable")
        width = int(pages["width"].iloc[0])
        read = lambda c, kind: [np.frombuffer(b, kind) for b in pages[c]]
        self.ids, self.rows = read("ids", np.int64), read("rows", np.int64)
        self.vectors = [_numbers(v.reshape(-1, width), exact) for v in read("vectors", np.float64)]
        low, high = (_numbers(np.array(read(c, np.float64)).reshape(-1, width), exact) for c in ("low", "high"))
        labels = pages["label"].to_numpy(np.int64)
        self.levels = [(low, high, labels, labels)]
        while len(low) > FANOUT:
            cuts = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            _, _, a, b = self.levels[-1]
            self.levels.append((low, high, np.minimum.reduceat(a, cuts), np.maximum.reduceat(b, cuts)))

    def search(self, q: np.ndarray, own: int, label: int, same: bool, least: list, most: list, k: int, best: list[list]) -> None:
        """Better the lists ``best`` (one a window, of (-score, id, row)) by the
        rows of ``label`` (``same``) or of the others, other than ``own``."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        most, windows = np.array(most, q.dtype), range(len(least))
        need = np.array([max(a, -b[-1][0]) if len(b) == k else a for a, b in zip(least, best)], q.dtype)
        queue: list[tuple] = []

        def push(level: int, a: int, b: int) -> None:
            low, high, first, last = (x[a:b] for x in self.levels[level])
            top, bottom = high @ plus + low @ minus, low @ plus + high @ minus
            fits = ((first <= label) & (label <= last)) if same else ((first != label) | (last != label))
            fits &= ((top[:, None] >= need) & (bottom[:, None] <= most)).any(axis=1)
            for i in np.flatnonzero(fits):
                heapq.heappush(queue, (-top[i], level, a + int(i)))

        push(len(self.levels) - 1, 0, len(self.levels[-1][0]))
        while queue:
            top, level, i = heapq.heappop(queue)
            if not (-top >= need).any():
                break  # no box that is left reaches any window or its k-th best
            if level:
                push(level - 1, i * FANOUT, (i + 1) * FANOUT)
                continue
            score = self.vectors[i] @ q
            hits = (score >= need[:, None]) & (score <= most[:, None]) & (self.rows[i] != own)
            for w in windows if hits.any() else ():
                at = np.flatnonzero(hits[w])
                if len(at):
                    found = zip((-score[at]).tolist(), self.ids[i][at].tolist(), self.rows[i][at].tolist())
                    best[w] = heapq.nsmallest(k, [*best[w], *found])
                    if len(best[w]) == k:
                        need[w] = -best[w][-1][0]


def _searcher(block, k: int, exact: bool, same: bool):
    """The search of one block of anchors, over an iterator of batches of pages.
    ``block``: broadcast list of (row, id, label, v, windows), each window a tuple
    (least, most, positive_id, positive_score)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = block.value
        best = [[[] for _ in windows] for *_, windows in anchors]
        vectors: dict[int, list] = {}
        for pages in batches:
            if not len(pages):
                continue
            tree, width = Tree(pages, exact), int(pages["width"].iloc[0])
            if width not in vectors:
                vectors[width] = list(_numbers(_matrix([a[3] for a in anchors], width), exact))
            for (row, _, label, _, windows), q, b in zip(anchors, vectors[width], best):
                tree.search(q, row, label, same, [w[0] for w in windows], [w[1] for w in windows], k, b)
        out = [(row, i, slot, w[2], str(w[3]), vec, other, str(-int(s)))
               for (row, i, _, _, windows), lists in zip(anchors, best)
               for slot, (w, found) in enumerate(zip(windows, lists)) for s, vec, other in found]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # scores travel as text: a sum of whole doubles may be beyond the longs
    found = found.withColumn("score", F.expr("try_cast(score as decimal(38,0))"))
    by = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
         scale: int = 256, tile_rows: int = TILE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every row where ``anchor`` (an expression of vec_id) holds and each of
    its ``positives`` best rows of the same label: the ``negatives`` best rows of
    other labels whose score is ``least`` to ``most`` per cent of the positive's."""
    spark: SparkSession = vectors.sparkSession
    rows = written(usable(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "mining-rows")
    top = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    count, width, top = rows.agg(F.count("*"), F.max(F.size("v")), F.max(top)).first()
    empty = spark.createDataFrame([], RESULT)
    if not count:
        return empty
    width = max(width, 1)
    exact = top * top * width * 100 < 2.0**53
    asked = rows.filter(anchor)
    blocks = -(-asked.count() // max(1, min(block_rows, BLOCK_BYTES // (8 * width))))
    if not blocks:
        return empty
    pages = written(leaf_pages(rows, count, width, tile_rows), "mining-pages")
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "mining-anchors")
    path = scratch_path(spark, "mining-found")

    def search(block: list, k: int, same: bool) -> DataFrame:
        return _ranked(pages.mapInPandas(_searcher(spark.sparkContext.broadcast(block), k, exact, same), FOUND), k)

    for b in range(blocks):
        got = asked.filter(F.col("block") == b).toPandas()  # one block: bounded rows and bytes
        anchors = [(int(r.row), int(r.vec_id), int(r.label), np.array(r.v, float)) for r in got.itertuples()]
        one = [(*a, [(-math.inf, math.inf, 0, 0)]) for a in anchors]
        near = search(one, positives, True).select("anchor_row", "rank", "vec_id", F.col("score").cast("string").alias("score")).toPandas()
        windows: dict[int, list] = {a[0]: [] for a in anchors}
        for r in near.sort_values(["anchor_row", "rank"]).itertuples():
            s = int(r.score)
            windows[int(r.anchor_row)].append((-(-least * s // 100), most * s // 100, int(r.vec_id), s))
        many = [(*a, w) for a in anchors if (w := [x for x in windows[a[0]] if x[0] <= x[1]])]
        found = search(many, negatives, False)
        longs = lambda c: F.expr(f"try_cast(try_cast({c} as decimal(38,0)) as bigint)")
        found.select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            longs("positive_score").alias("positive_score"), longs("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def every_hundredth(vectors: DataFrame) -> DataFrame:
    """The contract's digest: ids that divide by 7 pass for the next label, rows
    whose id divides by 100 are the anchors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = vectors.select("vec_id", "embedding", moved.alias("label"))
    return mine(rows, F.col("vec_id") % 100 == 0)
