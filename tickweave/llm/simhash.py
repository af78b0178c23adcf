"""SimHash near-duplicates, linked exactly through vantage-point trees.

Fingerprint. Each word shingle of the lower-cased text votes with its 64-bit
hash; a bit is set if it is set in over half of the hashes.

Links. The distinct fingerprints are split by a small vantage-point tree made
from a bounded sample: a node sends the fingerprints within its radius (the
median Hamming distance of its sample to the vantage point) to the inside, the
others to the outside. Each fingerprint is stored in the one leaf it falls in
and asks every leaf that the triangle inequality cannot rule out (distance to
the vantage point within ``max_bits`` of the radius: boundary-overlapping
shards). Within a shard a second tree of the same kind prunes further, down to
blocks that are compared bit by bit. A shard returns a spanning star forest of
its links, never its pairs, and connected components join the shards.

Equal fingerprints are grouped before any of that, so copies, however many,
count once. Defined results: a null or wordless text has fingerprint zero and
links like any other; null ids take part but never name a component (it is
null if all its ids are null); repeated rows stay repeated; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import written

SAMPLE = 4_096  # fingerprints that the upper tree is made from
LEAF_ROWS = 16_384  # fingerprints aimed at in a shard
ASKING_ROWS = 1 << 18  # fingerprints of which one part of a shard is asked, about
BLOCK_ROWS = 512  # the trees within shards end here


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint of one text (unsigned)."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and the six ASCII white spaces
    if not words:
        return 0
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    k = min(shingle, len(words))
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(line)][k - 1:]
    n, digest = len(ends), xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[x:y], 42) for x, y in zip(starts, ends)), np.uint64, n)
    bits = np.zeros(64, np.int64)
    for start in range(0, n, 65_536):  # bounded memory for very long texts
        part = h[start:start + 65_536].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * bits > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` with a column ``__fp``: the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint_of(t, shingle) for t in s], np.uint64).view(np.int64))

    return docs.withColumn("__fp", fp(F.col(text).cast("string")))


# ------------------------------------------------------------ vantage points
def hamming(a: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ v)


def _spread(sample: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """Of a few candidates, the vantage point whose distances spread the most,
    and its median distance."""
    best = None
    for v in sample[rng.integers(0, len(sample), 5)]:
        d = hamming(sample, v)
        if best is None or d.var() > best[0]:
            best = (d.var(), v, int(np.median(d)))
    return best[1], best[2]


def upper_tree(sample: np.ndarray, depth: int, seed: int = 11) -> list[tuple[np.uint64, int]]:
    """Nodes of a full binary tree in heap order: (vantage point, radius).
    Inside means a distance up to the radius."""
    rng, nodes, parts = np.random.default_rng(seed), [], [sample]
    for level in range(depth):
        after = []
        for part in parts:
            v, r = _spread(part if len(part) else sample, rng)
            nodes.append((v, r))
            near = hamming(part, v) <= r
            after += [part[near], part[~near]]
        parts = after
    return nodes


def shards(fp: np.ndarray, nodes: list[tuple[np.uint64, int]], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that a fingerprint has within ``reach`` of it;
    with reach 0 the one leaf it is stored in."""
    rows, at = np.arange(len(fp)), np.zeros(len(fp), np.int64)
    for _ in range((len(nodes) + 1).bit_length() - 1):
        v = np.array([n[0] for n in nodes], np.uint64)[at]
        d = np.bitwise_count(fp[rows] ^ v).astype(np.int64) - np.array([n[1] for n in nodes])[at]
        near, far = d <= reach, d > -reach if reach else d > 0
        rows, at = np.concatenate([rows[near], rows[far]]), np.concatenate([2 * at[near] + 1, 2 * at[far] + 2])
    return rows, at - len(nodes)


class Forest:
    """Union-find over row numbers, by arrays of pairs."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def flatten(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            root = self.flatten()
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            self.parent[np.maximum(x, y)] = np.minimum(x, y)


def link_shard(fp: np.ndarray, stored: np.ndarray, asking: np.ndarray, max_bits: int, forest: Forest,
               rng: np.random.Generator, depth: int = 0) -> None:
    """Join rows ``asking`` to rows ``stored`` at up to ``max_bits`` bits: split
    both by a vantage point while that separates the stored ones."""
    if not len(stored) or not len(asking):
        return
    if len(stored) > BLOCK_ROWS and depth < 24:
        v, r = _spread(fp[stored], rng)
        d, e = hamming(fp[stored], v), hamming(fp[asking], v).astype(np.int64)
        near = d <= r
        if near.any() and not near.all():
            link_shard(fp, stored[near], asking[e <= r + max_bits], max_bits, forest, rng, depth + 1)
            link_shard(fp, stored[~near], asking[e > r - max_bits], max_bits, forest, rng, depth + 1)
            return
    have = fp[stored]
    step = max(1, (1 << 21) // len(stored))
    for i in range(0, len(asking), step):
        rows = asking[i:i + step]
        q, s = np.nonzero(np.bitwise_count(fp[rows][:, None] ^ have[None, :]) <= max_bits)
        if len(q):
            forest.join(rows[q], stored[s])


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): edges between distinct fingerprints that join exactly those that
    chains of up to ``max_bits`` bits join. ``fps`` has distinct ``fp``."""
    n = fps.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / LEAF_ROWS))))
    share = min(1.0, SAMPLE / max(n, 1))
    picked = fps.filter(F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.sort(np.array([r[0] for r in picked.collect()], np.int64).view(np.uint64))
    nodes = upper_tree(sample, depth) if len(sample) else []

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy(np.int64)
            home = np.zeros(len(fp), np.int64)
            rows, leaf = shards(fp.view(np.uint64), nodes, 0)
            home[rows] = leaf
            for i in range(0, len(fp), 2_048):
                rows, leaf = shards(fp[i:i + 2_048].view(np.uint64), nodes, max_bits)
                rows = rows + i
                keep = leaf <= home[rows]  # a pair across leaves is found from its later leaf
                yield pd.DataFrame({"leaf": leaf[keep], "fp": fp[rows[keep]], "stored": (leaf == home[rows])[keep]})

    def join(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        fp, own = f["fp"].to_numpy(np.int64).view(np.uint64), f["stored"].to_numpy(bool)
        forest, rows = Forest(len(fp)), np.arange(len(fp))
        link_shard(fp, rows[own], rows, max_bits, forest, np.random.default_rng(5))
        root = forest.flatten()
        linked = root != rows
        return pd.DataFrame({"a": fp[linked].view(np.int64), "b": fp[root[linked]].view(np.int64)})

    # a shard's stored fingerprints meet those that ask it in parts of bounded size
    parts = -(-n // ASKING_ROWS)
    sent = fps.select("fp").mapInPandas(route, "leaf long, fp long, stored boolean")
    own = F.when(F.col("stored"), F.sequence(F.lit(0), F.lit(max(parts, 1) - 1)))
    one = F.array(F.pmod(F.hash("fp"), F.lit(max(parts, 1))))
    sent = sent.withColumn("part", F.explode(F.coalesce(own, one)))
    return sent.groupBy("leaf", "part").applyInPandas(join, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of every fingerprint with an edge: alternating big-star and
    small-star steps, each written, until no edge moves."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "simhash-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # big star: larger neighbours go to the smallest one around
        big = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        big = written(big, "simhash-big")
        # small star: a node and its smaller neighbours go to the smallest of these
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        moved = big.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "simhash-small")
        count = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if count(after) == count(edges):
            return after.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        edges = after


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, ``text_hash`` (XXH64 of the text), fp, root
    (a fingerprint that names the group) and component_id, the smallest doc_id
    that chains of links reach."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    own = written(fingerprints(rows, "text", shingle).select("doc_id", "text_hash", F.col("__fp").alias("fp")), "simhash-fp")
    fps = written(own.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = fps.join(components(links(fps, max_bits)), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = roots.join(lowest, "root").select("fp", "root", "component_id")
    return own.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex16(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each group: of its rows with
    the smallest doc_id (null only if all are), one of the lowest text hash."""
    found = near_duplicates(docs, shingle, max_bits)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("k"))
    lacks = lambda c: c.isNull()
    keys = best.select(F.coalesce("k.doc_id", F.lit(0)).alias("__id"), lacks(F.col("k.doc_id")).alias("__no"),
                       F.col("k.text_hash").alias("__own"))
    cols = docs.columns
    mine = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__no": lacks(F.col("doc_id")),
                             "__own": F.xxhash64(F.col("text").cast("string"))})
    # repeated rows share id and text: one of them stays
    kept = mine.join(keys, ["__id", "__no", "__own"], "left_semi").dropDuplicates(["__id", "__no", "__own"])
    return kept.select(*[F.col(f"`{c}`") for c in cols])
