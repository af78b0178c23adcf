"""Exact top-k search by the three-phase uniform threshold algorithm.

The dimensions are cut into groups; each group keeps its own score lists (the
part of every inner product that falls to it). Vectors are spread over shards
and queries over blocks, and each pair of shard and block is one task.

1. Every shard sends, per query and group, its ``k`` highest parts, resolved to
   whole scores, and the lowest part of the group. The k-th whole score seen is
   a safe cutoff.
2. The cutoff goes to all shards with the queries, as one uniform threshold a
   group: (cutoff - lowest parts) / groups above the group's lowest part. Every
   vector that can reach the cutoff has a part at or above it, so a shard takes
   those entries only, and drops those whose bound stays below the cutoff.
3. What remains is resolved to whole scores; those at or above the cutoff (the
   k best of a shard at most) are ranked.

Components become floor(1024 * x). Defined results: vectors that are null,
empty or hold a null or non-finite component, and rows without a vec_id, take
no part; a vector of another length than the query scores as if padded with
zeros; equal rows count once; rows with a query's own vec_id are its own, and
if those differ the smallest vector asks; ties go to the smaller vec_id; a
score beyond the longs is null but ranked; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.llm.common import written

GROUPS = 4
SHARD_ROWS = 16_384
QUERY_ROWS = 512
SCALE = 1_024


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Distinct (vec_id, v): whole-number components as doubles (exact: a float
    or double times a power of two)."""
    x = F.col(embedding).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False)))
    # doubles from 2^53 on are whole already, and may be beyond the longs
    whole = lambda c: F.when(F.abs(c * SCALE) < 2.0**53, F.floor(c * SCALE).cast("double")).otherwise(c * SCALE)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, whole).alias("v")).distinct()


def _matrix(parts: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(parts), width))
    for i, p in enumerate(parts):
        out[i, :len(p)] = p
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: doubles while they are exact, then longs, then Python's."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 2**53:
        return a @ b.T
    kind = np.int64 if top < 2**62 else object
    return (a.astype(object) if kind is object else a.astype(kind)) @ (b.astype(object) if kind is object else b.astype(kind)).T


class Shard:
    """The parts of the scores of one block of queries over one shard."""

    def __init__(self, frame: pd.DataFrame):
        own = frame["is_query"].to_numpy(bool)
        self.queries, rows = frame[own].sort_values("vec_id"), frame[~own].sort_values("vec_id")
        width = max((len(v) for v in frame["v"]), default=0)
        self.q_ids, self.ids = self.queries["vec_id"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
        q, v = _matrix(self.queries["v"], width), _matrix(rows["v"], width)
        cuts = np.linspace(0, width, GROUPS + 1).astype(int)
        self.parts = [_exact(q[:, a:b], v[:, a:b]) for a, b in zip(cuts, cuts[1:])]
        self.others = self.q_ids[:, None] != self.ids[None, :]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id (ids ascend)."""
    return np.argsort(-score, kind="stable")[:k]


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the ``k`` best
    of ``vectors`` (both as from ``usable``)."""
    vectors, queries = written(vectors, "topk-vectors"), written(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "topk-queries")
    shards, blocks = max(1, -(-vectors.count() // shard_rows)), max(1, -(-queries.count() // query_rows))
    spread = lambda c, n, seed: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("array<double>")
    data = vectors.withColumn("shard", spread("vec_id", shards, 3)).withColumn("block", every(blocks)).withColumn("is_query", F.lit(False))

    def asked(extra: DataFrame | None) -> DataFrame:
        """Every shard with every block of queries, with what was sent to it."""
        q = queries.withColumn("cut", none) if extra is None else queries.join(extra, "vec_id", "left")
        q = q.withColumn("block", spread("vec_id", blocks, 5)).withColumn("shard", every(shards)).withColumn("is_query", F.lit(True))
        return data.withColumn("cut", none).unionByName(q).groupBy("shard", "block")

    def first(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        s, out = Shard(f), []
        for i, q in enumerate(s.q_ids):
            may = np.flatnonzero(s.others[i])
            if not len(may):
                continue
            seen = np.unique(np.concatenate([may[_best(p[i, may], s.ids[may], k)] for p in s.parts]))
            whole = sum(p[i, seen] for p in s.parts)
            top = seen[_best(whole, s.ids[seen], k)]
            out.append((int(q), [float(p[i, may].min()) for p in s.parts], sorted((float(sum(p[i, j] for p in s.parts)) for j in top), reverse=True)))
        return pd.DataFrame(out, columns=["vec_id", "low", "tops"])

    local = written(asked(None).applyInPandas(first, "vec_id long, low array<double>, tops array<double>"), "topk-local")
    lows = local.groupBy("vec_id").agg(*[F.min(F.col("low")[g]).alias(f"low{g}") for g in range(GROUPS)])
    by_score = Window.partitionBy("vec_id").orderBy(F.desc("score"))
    tops = local.select("vec_id", F.explode("tops").alias("score")).withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == k)
    cut = lows.join(tops.select("vec_id", "score"), "vec_id", "left").select(
        "vec_id", F.array(F.col("score"), *[F.col(f"low{g}") for g in range(GROUPS)]).alias("cut"))

    def rest(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        s, out = Shard(f), []
        for i, (q, c) in enumerate(zip(s.q_ids, s.queries["cut"])):
            may = s.others[i]
            if c is not None and c[0] is not None and not np.isnan(float(c[0])):
                tau, low = float(c[0]), np.array(c[1:], float)
                slack = 1e-9 * (abs(tau) + np.abs(low).sum()) + 1e-6  # cutoffs are doubles; bounds stay safe
                uniform = (tau - low.sum()) / GROUPS
                # an entry counts at its part if it was sent, at the threshold if not
                sent = [p[i].astype(float) >= t - slack for p, t in zip(s.parts, low + uniform)]
                bound = sum(np.where(x, p[i].astype(float), t) for x, p, t in zip(sent, s.parts, low + uniform))
                may = may & np.logical_or.reduce(sent) & (bound >= tau - slack)
            may = np.flatnonzero(may)
            whole = sum(p[i, may] for p in s.parts)
            top = _best(whole, s.ids[may], k) if len(may) else []
            out += [(int(q), int(s.ids[may[j]]), str(int(whole[j]))) for j in top]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # scores travel as text: a sum of whole doubles may be beyond the longs
    found = asked(cut).applyInPandas(rest, "query_id long, vec_id long, score string")
    found = found.withColumn("score", F.col("score").cast("decimal(38,0)"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.expr("try_cast(score as bigint)").alias("score"))


def every_hundredth(vectors: DataFrame, k: int = 10) -> DataFrame:
    """The k best of all vectors for every row whose vec_id divides by 100."""
    rows = usable(vectors)
    return search(rows, rows.filter(F.pmod(F.col("vec_id"), F.lit(100)) == 0), k)
