"""Hard negatives, WARC bundles and the conversation trie against brute force."""

import base64
import hashlib
import math
import os
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.conftest import SF001
from tickweave.llm import convtrie, mining, warc
from tickweave.llm.common import prepare, read_table


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


# ------------------------------------------------------- op11: hard negatives
def brute_mining(rows, positives=5, negatives=10):
    """rows: (vec_id, embedding, label) as in the table."""
    fine = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (i, v, label) in enumerate(fine):
        if i % 100:
            continue
        near = sorted(((-dot(v, w), j) for b, (j, w, k) in enumerate(fine) if b != a and k == label))[:positives]
        for s, j in near:
            s = -s
            far = sorted((-dot(v, w), n) for n, w, k in fine if k != label)
            far = [(n, -t) for t, n in far if 30 * s <= -100 * t <= 90 * s][:negatives]
            out += [(i, j, r + 1, n, s, t) for r, (n, t) in enumerate(far)]
    return sorted(out)


EMBEDDINGS = "vec_id long, embedding array<double>, label int"


def mined(spark, rows, **sizes):
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit("x") for c in ("row", "v", "slab", "score", "rank", "block")})
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, mining.mine(df.withColumn("label", moved), F.col("vec_id") % 100 == 0, **sizes).collect()))


def test_op11_against_brute_force(spark):
    table = read_table(spark, SF001, "embeddings")
    assert sorted(map(tuple, mining.every_hundredth(table).collect())) == brute_mining([tuple(r)[:3] for r in table.select("vec_id", "embedding", "label").collect()])


def test_op11_many_pages_blocks_and_a_hot_vector(spark):
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + r.normal(size=12) * 0.4).tolist(), int(i % 6 < 3)) for i in range(900)]
    rows += [(900 + i, centres[0].tolist(), i % 2) for i in range(400)]  # a third of all rows: one vector, many ties
    want = brute_mining(rows)
    assert len(want) > 300
    assert mined(spark, rows, tile_rows=128, block_rows=4) == want
    assert mined(spark, rows) == want


def test_op11_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [1.0], 1), (1, [0.9, 0.4], 1), (1, [0.9, 0.4], 1), (2, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (3, [], 2),
            (4, None, 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 1), (8, [None, 1.0], 2), (None, [1.0, 1.0], 1), (9, [1.0, 1.0], None),
            (200, [-1.0, -1.0], 3), (201, [1.0, 1.0], 3), (300, [0.0, 0.0], 4), (301, [0.0], 4), (10, [0.6, 0.3], 5), (11, [0.45, 0.9], 2)]
    assert mined(spark, rows) == brute_mining(rows)
    big = [(0, [2.0**40, 1.0], 1), (1, [2.0**20, 3.0], 1), (2, [2.0**19, 1.0], 2), (3, [2.0**19, 5.0], 2)]
    assert mined(spark, big) == brute_mining(big)  # scores beyond 2^53 stay exact
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 2)]) == []


def test_op11_boxes_bound_the_scores():
    r = np.random.default_rng(1)
    m = np.floor(r.normal(size=(700, 9)) * 256)
    order = mining.tiled(m, np.arange(700), [0, 3, 5], 64)
    assert sorted(order) == list(range(700))
    f = __import__("pandas").DataFrame({"row": np.arange(700), "vec_id": np.arange(700), "v": list(m)})
    pages = mining._pack_tile(9, 64)((1,), f)
    tree = mining.Tree(pages, True)
    assert len(tree.levels) > 0 and sum(map(len, tree.ids)) == 700
    q = np.floor(r.normal(size=9) * 256)
    s = m @ q
    best = [[]]
    tree.search(q, -1, 1, True, [-math.inf], [math.inf], 10, best)
    assert [-b[0] for b in best[0]] == sorted(s, reverse=True)[:10]
    for low, high, *_ in tree.levels:
        top = high @ np.maximum(q, 0) + low @ np.minimum(q, 0)
        assert top.max() >= s.max()


# ------------------------------------------------------------- op12: archives
def brute_archive(rows, least=0):
    """rows: (page_id, url, html)."""
    first = {}
    for i, _, t in rows:
        t = t or ""
        if i is not None and len(t.encode()) >= least:
            first[t] = max(first.get(t, i), i)
    out = []
    for i, url, t in rows:
        data, top = (t or "").encode(), first.get(t or "")
        copy = top is not None and (i is None or i < top)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if copy else "response", top if copy else None, url))
    return sorted(out, key=repr)


PAGES = [(0, "http://a/0", "<p>one</p>"), (1, "http://a/1", "<p>one</p>"), (2, None, None), (3, "", ""), (4, "http://a/\r\nX: y \x01%41", "ü\r\n\r\nWARC/1.1\r\n"),
         (4, "http://a/other", "<p>other page of the same id</p>"), (5, "http://a/5", "z" * 900_000), (6, "http://日本/6 ", "<p>one</p>"),
         (6, "http://日本/6 ", "<p>one</p>"), (None, "http://a/none", "<p>one</p>"), (None, None, "without id"), (None, "u", "without id"), (7, "u" * 70_000, "a")]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("key", "payload", "refers_to", "first", "salt", "n")})


@pytest.mark.parametrize("sizes", [{}, {"frame_bytes": 50, "bundle_bytes": 300}, {"broadcast_rows": 0}, {"min_bytes": 5}])
def test_op12_round_trip(spark, sizes):
    rows = [tuple(r) for r in read_table(spark, SF001, "pages").select("page_id", "url", "html").collect()] + PAGES
    folder = warc.write(pages(spark, rows).repartition(3), **sizes)
    got = warc.records(spark, folder).collect()
    short = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url) for r in got]
    assert sorted(short, key=repr) == brute_archive(rows, sizes.get("min_bytes", 0))
    html = {}
    for i, _, t in rows:
        html.setdefault(i, set()).add((t or "").encode())
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) in html[r.page_id] for r in got)
    assert warc.index(spark, folder).count() == len(rows)


def test_op12_random_access_and_plain_readers(spark):
    folder = warc.write(pages(spark, PAGES * 2), frame_bytes=500)
    got = warc.fetch(spark, folder, spark.createDataFrame([(1,), (5,), (99,)], "page_id long")).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "revisit"), (1, "revisit"), (5, "response"), (5, "response")]
    assert {bytes(r.payload) for r in got if r.payload is not None} == {b"z" * 900_000}
    # any Zstandard reader takes the whole file and skips the table
    names = [r.bundle for r in warc.index(spark, folder).select("bundle").distinct().collect()]
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(open(f"{folder.removeprefix('file:')}/bundles/{n}", "rb"), read_across_frames=True).read() for n in names)
    assert len(list(warc.parse(whole))) == 2 * len(PAGES)


def test_op12_damage_and_strays(spark):
    folder = warc.write(pages(spark, PAGES), frame_bytes=500)
    bundles = f"{folder.removeprefix('file:')}/bundles"
    with open(f"{bundles}/stray.warc.zst", "wb") as f:  # of an attempt that did not commit
        f.write(b"half a bundle")
    assert warc.records(spark, folder).count() == len(PAGES)
    name = warc.index(spark, folder).filter("page_id = 4").first().bundle
    with open(os.path.join(bundles, name), "r+b") as f:
        f.seek(30)
        f.write(b"\xff\xff\xff\xff")
    with pytest.raises(Exception, match="damaged|Zstd|zstd|decompress"):
        warc.records(spark, folder).collect()


def test_op12_empty(spark):
    folder = warc.write(pages(spark, PAGES).limit(0))
    assert warc.records(spark, folder).count() == 0 and warc.frames(spark, folder).count() == 0


# ------------------------------------------------------ op13: the prefix trie
def brute_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    stored = {}
    for c, turn, role, text in rows:
        if c is not None:
            stored.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    stored = {c: [x[2:] for x in sorted(t)] for c, t in stored.items()}
    built = {}
    for c, own in stored.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(stored.get(c - c % 5, [])[:h] + own[h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, cs in members.items():
        under = [x for x in members if x[:len(node)] == node]
        leaf = lambda x: not any(len(y) == len(x) + 1 and y[:-1] == x for y in members)
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
                    sum(len(y) == len(node) + 1 for y in under), sum(map(leaf, under)),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = [(0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "ü bye"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, None, None, "x"),
         (2, 0, "user", None), (2, 0, "user", None), (3, 5, "a", "same"), (3, 5, "a", "other"), (3, None, "z", "first"), (None, 1, "user", "nobody"),
         (7, 0, "user", "base is absent"), (8, 1, "user", "hi"), (11, 0, "us", "er"), (12, 0, "use", "r"), (15, 0, "user", "y" * 100_000), (16, 0, "user", "y" * 100_000)]
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(1) for c in ("pos", "n", "k1", "depth", "f", "base", "h", "end")})


def trie(df):
    return sorted(map(tuple, convtrie.fives(df).select(*COLUMNS).collect()), key=repr)


def test_op13_edges(spark):
    assert trie(turns(spark, TURNS)) == brute_trie(TURNS)
    assert trie(turns(spark, TURNS).limit(0)) == []


def test_op13_against_brute_force(spark):
    table = read_table(spark, SF001, "conversations")
    assert trie(table) == brute_trie([tuple(r) for r in table.collect()])


def test_op13_hot_group_and_long_conversation_by_small_pieces(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]  # mostly copies
    rows += [(1_000, t, "a", f"long {t % 7}") for t in range(500)] + [(1_001, t, "a", f"long {t % 7}") for t in range(450)]
    rows += [(2_000 + c, 0, "user", f"own {c}") for c in range(60)]  # children of one parent
    want = brute_trie(rows)
    assert trie(turns(spark, rows)) == want
    monkeypatch.setattr(convtrie, "CHUNK", 16)
    monkeypatch.setattr(convtrie, "ENDS", 16)
    monkeypatch.setattr(convtrie.running, "__defaults__", (16,))
    assert trie(turns(spark, rows)) == want


def test_op13_collisions_are_noticed(spark):
    rows = [(c, t, "user", f"{c % 7} {t}") for c in range(40) for t in range(5)]
    head, base = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9, F.col("conv_id") - F.col("conv_id") % 5
    found = convtrie.nodes(turns(spark, rows), head, base, 8, moduli=(5, convtrie.P))
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=repr) == brute_trie(rows)
    with pytest.raises(RuntimeError, match="collided"):
        convtrie.nodes(turns(spark, rows), head, base, 8, moduli=(5,))
    with pytest.raises(convtrie.Collision):
        convtrie.check_contents(spark.createDataFrame([(1, 2, "a", "b"), (1, 2, "ab", "")], "k1 long, k2 long, role string, text string"))


def test_contracts_columns(spark):
    from tickweave.llm.queries import QUERIES

    want = {"op11_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
            "op12_warc_bundles": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
            "op13_conversation_trie": dict.fromkeys(COLUMNS, "bigint") | {"ends_sha256": "string"}}
    for name, columns in want.items():
        schema = QUERIES[name](spark, SF001).schema
        assert isinstance(schema, StructType) and columns.items() <= {f.name: f.dataType.simpleString() for f in schema}.items()
