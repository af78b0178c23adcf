"""Prefix trie over rebuilt conversations by composable fingerprints.

A rebuilt conversation is the head of a base conversation followed by the own
turns behind the head's length. Its text is never put together. A stretch of
turns has the fingerprint (sum of turn_i * B^i mod P, length), and stretches
compose as a monoid: (s, m) * (t, n) = (s + B^m * t, m + n). One running sum a
stored conversation therefore gives every prefix of every rebuilt one: the
base's sum up to the head, plus the difference of two own sums, moved by a power
of B if the base is shorter than the head. Four bases B give 124 bits.

Nothing rests on chance. A turn passes for its content key (two 64-bit hashes of
role and text); that no two contents share a key is checked on the stored turns.
A node is a group of prefixes with one depth and one fingerprint; that all its
members end in one turn (by its stored reference's content key) behind one
parent is checked for every node, so by induction over the depth its prefixes
are equal. If either check fails, all is done again with other seeds.

Sums over subtrees need no recursion. A node is owned by its smallest member,
and what a member owns is the end of its path. So a subtree's sum is the sum of
what its members own, less what its own owner holds above the node.

No step puts a conversation or a node into one task: positions and running sums
go by chunks, long paths are joined by pieces, parents of many children are
broadcast (there are few), groups are combined on the map side. Only the digest
of the conversations that end in a node must see them in order; they arrive as
sorted pieces of bounded size, and a task holds one piece.

Defined results: rows without a conv_id take no part; null role or text is
empty; turns of a conversation come by turn, null first, those with equal turns
by role and text as far as their first 64 characters tell, then by hash; a
repeated row is a turn of its own; very long texts only pass through hashes; an
empty table has no node, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.scalar import idiv
from tickweave.llm.common import written
from tickweave.plans.sequence import sequence
from tickweave.plans.small import bounded_broadcast

P = 2**31 - 1  # residues are below it, so that products stay within the longs
BASES = 4
POSITION_BITS = 36
CHUNK = 65_536
ENDS = 4_096  # ids of one piece of a digest
TIE_CHARS = 64
SEEDS = 8

NODE = ("depth", "f", "g")
S = [f"s{j}" for j in range(BASES)]
C = [f"c{j}" for j in range(BASES)]


class Collision(Exception):
    """Two contents or two prefixes share a key."""


def bases(seed: int, modulus: int = P) -> list[int]:
    r = random.Random(seed)
    return [r.randrange(2, modulus - 1) for _ in range(BASES)]


def _power(base: int, at: Column, modulus: int) -> Column:
    """base ** at mod modulus, by the bits of ``at``."""
    out = F.lit(1).cast("long")
    for bit in range(POSITION_BITS):
        factor = pow(base, 1 << bit, modulus)
        out = out * F.when(at.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(factor).cast("long")).otherwise(F.lit(1).cast("long")) % modulus
    return out


def running(df: DataFrame, key: str, at: str, cols: list[str], chunk: int = CHUNK) -> DataFrame:
    """``df`` with the sums of ``cols`` up to and with each row of a key, in order
    of the whole number ``at``, as ``run_<col>``; a task ranks one chunk of a key."""
    df = df.withColumn("_c", idiv(at, chunk))
    inside = Window.partitionBy(key, "_c").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(key, "_c").agg(*[F.sum(c).alias(c) for c in cols])
    totals = totals.select(key, "_c", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_{c}") for c in cols])
    df = df.withColumns({f"run_{c}": F.sum(c).over(inside) for c in cols}).join(totals, [key, "_c"])
    return df.withColumns({f"run_{c}": F.col(f"run_{c}") + F.col(f"_{c}") for c in cols}).drop("_c", *[f"_{c}" for c in cols])


# -------------------------------------------------------------- stored turns
def _keyed(conversations: DataFrame, seed: int) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role").alias("role"), empty("text").alias("text"))
    return rows.withColumns({f"k{j}": F.xxhash64(F.lit(2 * seed + j), "role", "text") for j in (1, 2)})


def check_contents(rows: DataFrame) -> None:
    """Raise ``Collision`` unless each content key has one role and text."""
    contents = rows.select("k1", "k2", "role", "text").distinct()
    if contents.groupBy("k1", "k2").count().filter("count > 1").head(1):
        raise Collision("contents")


def stored_turns(conversations: DataFrame, seed: int = 0, modulus: int = P) -> DataFrame:
    """conv_id, pos, n, k1, k2, bytes, c0.. (turn * B^pos) and s0.. (their sums
    up to the turn) of every turn."""
    rows = _keyed(conversations, seed)
    check_contents(rows)
    head = lambda c: F.left(F.col(c), F.lit(TIE_CHARS))
    narrow = written(rows.select("conv_id", "turn", head("role").alias("r"), head("text").alias("t"), "k1", "k2",
                                 F.octet_length("text").cast("long").alias("bytes")), "trie-turns")
    placed = sequence(narrow, key="conv_id", order=("turn", "r", "t", "k1", "k2")).select("conv_id", "pos", "n", "k1", "k2", "bytes")
    share = lambda j, b: F.pmod(F.xxhash64(F.lit(seed + j), "k1", "k2"), F.lit(modulus)) * _power(b, F.col("pos"), modulus) % modulus
    placed = written(placed.withColumns({c: share(j, b) for j, (c, b) in enumerate(zip(C, bases(seed, modulus)))}), "trie-places")
    summed = running(placed, "conv_id", "pos", C)
    return written(summed.select("conv_id", "pos", "n", "k1", "k2", "bytes", *C, *[(F.col(f"run_{c}") % modulus).alias(s) for c, s in zip(C, S)]), "trie-sums")


# ----------------------------------------------------------------- prefixes
def prefixes(turns: DataFrame, head: Column, base: Column, most: int, seed: int = 0, modulus: int = P) -> DataFrame:
    """A row for every prefix of every rebuilt conversation: conv_id, depth, its
    fingerprint f, g and its parent's pf, pg, the key and bytes of its last turn and
    the place where that is stored, and whether the conversation ends there.
    ``head`` (0 to ``most``) and ``base`` are expressions of conv_id."""
    back = [[pow(pow(b, -1, modulus), i, modulus) for i in range(most + 1)] for b in bases(seed, modulus)]
    kept = ["pos", "k1", "k2", "bytes", *C, *S]
    first = turns.filter(F.col("pos") < most).groupBy("conv_id").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct(*kept))).alias("first"))
    convs = first.withColumns({"h": head.cast("long"), "base": base})
    heads = first.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("first").alias("base_first"))
    convs = convs.join(heads, "base", "left")
    h2 = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    convs = convs.withColumn("h2", h2).withColumn("end", F.col("h2") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    at = lambda rows, count, c: F.coalesce(F.get(F.col(rows), (F.col(count) - 1).cast("int"))[c], F.lit(0).cast("long"))
    convs = convs.withColumns({f"head_{s}": at("base_first", "h2", s) for s in S} | {f"cut_{s}": at("first", "h", s) for s in S})
    convs = written(convs.drop("first"), "trie-conversations")

    def fingerprint(values: list[Column]) -> list[Column]:
        shift = F.lit(1 << 31).cast("long")
        return [values[0] * shift + values[1], values[2] * shift + values[3]]

    def row(depth: Column, values: list[Column], last: list[Column], conv: str, pos: Column, k1, k2, size) -> list[Column]:
        above = [(v - x + modulus) % modulus for v, x in zip(values, last)]
        (f, g), (pf, pg) = fingerprint(values), fingerprint(above)
        return ["conv_id", depth.cast("long").alias("depth"), f.alias("f"), g.alias("g"), pf.alias("pf"), pg.alias("pg"), k1.alias("k1"), k2.alias("k2"),
                size.alias("bytes"), F.col(conv).alias("stored_conv"), pos.alias("stored_pos"), (depth == F.col("end")).alias("ends")]

    none, zero = F.lit(None).cast("long"), [F.lit(0).cast("long")] * BASES
    root = convs.withColumn("nowhere", none).select(*row(F.lit(0), zero, zero, "nowhere", none, none, none, F.lit(0).cast("long")))
    taken = convs.filter("h2 > 0").select("conv_id", "base", "end", F.explode(F.slice("base_first", F.lit(1), F.col("h2").cast("int"))).alias("x"))
    x = lambda c: F.col("x")[c]
    taken = taken.select(*row(x("pos") + 1, [x(s) for s in S], [x(c) for c in C], "base", x("pos"), x("k1"), x("k2"), x("bytes")))
    # a long conversation meets its constants piece by piece
    own = convs.filter("n > h").select("conv_id", "h", "h2", "end", *[f"{p}_{s}" for p in ("head", "cut") for s in S],
                                       F.explode(F.sequence(idiv("h", CHUNK), idiv(F.col("n") - 1, CHUNK))).alias("piece"))
    own = turns.withColumn("piece", idiv("pos", CHUNK)).join(own, ["conv_id", "piece"]).filter("pos >= h")
    moved = [F.element_at(F.array(*[F.lit(v).cast("long") for v in b]), (F.col("h") - F.col("h2") + 1).cast("int")) for b in back]
    sums = [(F.col(f"head_{s}") + (F.col(s) - F.col(f"cut_{s}") + modulus) % modulus * m % modulus) % modulus for s, m in zip(S, moved)]
    last = [F.col(c) * m % modulus for c, m in zip(C, moved)]
    own = own.select(*row(F.col("pos") - F.col("h") + F.col("h2") + 1, sums, last, "conv_id", F.col("pos"), F.col("k1"), F.col("k2"), F.col("bytes")))
    return written(root.unionByName(taken).unionByName(own), "trie-prefixes")


def grouped(paths: DataFrame) -> DataFrame:
    """The nodes, checked: depth, f, g, pf, pg, bytes, conv_id (smallest member),
    n_convs. Raises ``Collision`` if a node's members differ in turn or parent."""
    same = ("k1", "k2", "pf", "pg")
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min_by(F.struct("stored_conv", "stored_pos"), "conv_id").alias("stored"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_") for c in same])
    nodes = written(nodes, "trie-nodes")
    differ = [(F.col(c) != F.col(f"{c}_")) for c in same]
    if nodes.filter(differ[0] | differ[1] | differ[2] | differ[3]).head(1):
        raise Collision("prefixes")
    return nodes.drop("k1", "k2", *[f"{c}_" for c in same])


# -------------------------------------------------------------------- nodes
def _ends(paths: DataFrame) -> DataFrame:
    """depth, f, g, ends_sha256 of the nodes where conversations end."""
    # a piece holds the ids of one range: at most ENDS of them, since a node has an id once
    piece = F.floor(F.col("conv_id") / F.lit(ENDS))
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    pieces = paths.filter("ends").groupBy(*NODE, piece.alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    schema = "depth long, f long, g long, ends_sha256 string"

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            out = []
            for d, f, g, ids in zip(batch["depth"], batch["f"], batch["g"], batch["ids"]):
                if (d, f, g) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (d, f, g), hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=["depth", "f", "g", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["depth", "f", "g", "ends_sha256"])

    count = F.count("*").over(Window.partitionBy(*NODE))
    pieces = pieces.withColumn("pieces", count)
    one = pieces.filter("pieces = 1").select(*NODE, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    many = pieces.filter("pieces > 1").repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids").mapInPandas(digest, schema)
    return one.unionByName(many)


def _parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` (with n_children) and parent_conv_id."""
    up = [F.col("depth").alias("_d"), F.col("f").alias("pf"), F.col("g").alias("pg")]
    many = bounded_broadcast(nodes.filter(F.col("n_children") > CHUNK).select(*up, F.col("conv_id").alias("_hot")))
    rows = nodes.withColumn("_d", F.col("depth") - 1).join(many, ["_d", "pf", "pg"], "left")
    # children that have their parent already match nothing below, each by a salt of its own
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("f", "g"), F.lit(CHUNK)) + 1).otherwise(0)
    few = nodes.filter(F.col("n_children").between(1, CHUNK)).select(*up, F.lit(0).cast("long").alias("_s"), F.col("conv_id").alias("_cold"))
    rows = rows.withColumn("_s", salt.cast("long")).join(few, ["_d", "pf", "pg", "_s"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("_hot", "_cold"))
    return rows.withColumn("parent_conv_id", parent).drop("_d", "_s", "_hot", "_cold")


def nodes(conversations: DataFrame, head: Column, base: Column, most: int, moduli: tuple[int, ...] = (P,) * SEEDS) -> DataFrame:
    """All nodes of the trie with depth, conv_id (smallest member), parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and ``stored``, where
    the node's last turn is stored (conversation and position).
    ``moduli``: one for every attempt."""
    for seed, modulus in enumerate(moduli):
        try:
            paths = prefixes(stored_turns(conversations, seed, modulus), head, base, most, seed, modulus)
            found = grouped(paths)
            break
        except Collision:
            continue
    else:
        raise RuntimeError(f"fingerprints collided under {len(moduli)} seeds")
    children = found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("pg").alias("g")).agg(F.count("*").alias("n_children"))
    found = found.join(children, list(NODE), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    found = found.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    found = written(running(found, "conv_id", "depth", ["saved"]), "trie-owned")
    # what a conversation owns: the saved bytes, and the leaf at its end
    owned = found.groupBy("conv_id").agg(F.sum("saved").alias("own_saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("own_leaves"))
    ends = paths.filter("ends").select("conv_id", F.col("depth").alias("end"))
    owned = owned.filter("own_saved > 0 or own_leaves > 0").join(ends, "conv_id")
    owned = owned.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), idiv("end", CHUNK)))).drop("end")
    sums = paths.select("conv_id", *NODE, idiv("depth", CHUNK).alias("piece")).join(owned, ["conv_id", "piece"]).groupBy(*NODE).agg(
        F.sum("own_saved").alias("own_saved"), F.sum("own_leaves").alias("n_leaves"))
    nothing = hashlib.sha256(b"").hexdigest()
    out = _parents(found).join(sums, list(NODE), "left").join(_ends(paths), list(NODE), "left")
    above = F.col("run_saved") - F.col("saved")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
        (F.coalesce("own_saved", F.lit(0).cast("long")) - above).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "stored")


def fives(conversations: DataFrame) -> DataFrame:
    """The contract's digest: every conversation takes its head from the one whose
    id is the next lower multiple of five; the head's length is crc32 of the
    decimal id mod 9."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    found = nodes(conversations, head, F.col("conv_id") - F.col("conv_id") % 5, most=8)
    return found.select("*", F.col("stored.stored_conv").alias("turn_conv_id"), F.col("stored.stored_pos").alias("turn_position")).drop("stored")
