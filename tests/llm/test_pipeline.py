"""The pipeline's stages against plain Python over the same rows."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_llm import brute_fp, brute_spans
from tickweave.llm import bpe, qda
from tickweave.llm.common import read_table


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF001, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dups", "secrets", "mix", "tokens"]

    good = stages["quality"](spark, docs, SF001)
    model = qda.fit(spark, docs, read_table(spark, SF001, "labels"))
    score = {r.doc_id: r.score for r in qda.classify(docs, model).collect()}
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and kept == {i for i, s in score.items() if s >= 0.3}

    single = stages["near_dups"](spark, good, SF001)
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    fps, group = [brute_fp(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group] if group[b] < group[a] else [group[a] if g == group[b] else g for g in group]
    first = {}
    for (i, _), g in zip(rows, group):
        first[g] = min(first.get(g, i), i)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    clean = stages["secrets"](spark, single, SF001)
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        assert brute_spans(r.text) == [] and (r.text == before[r.doc_id]) == (brute_spans(before[r.doc_id]) == [])

    mixed = stages["mix"](spark, clean, SF001)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, clean.collect()))

    b = bpe.public_bpe()
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    want = {}
    for r in mixed.collect():
        ids = enc.encode_ordinary(r.text)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
    out = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == want
    assert sorted(r.position for r in out) == list(range(len(want)))


def brute_mix(rows, size=64):
    """doc_ids in the order of the mix; rows: (source, hash, doc_id). Slot by
    slot, the released block with the earliest deadline."""
    groups = {}
    for source, h, i in rows:
        groups.setdefault(source, []).append((h % 2**64, i))
    names = sorted(groups, key=lambda s: (s is None, s or ""))
    queues = [[i for _, i in sorted(groups[s])] for s in names]
    blocks = [-(-len(q) // size) for q in queues]
    weight = [Fraction(math.isqrt(len(q))) for q in queues]
    passes = [[Fraction(0)] for _ in names]  # when the fluid share of a source passes 0, 1, 2, ...
    had, now = [Fraction(0)] * len(names), Fraction(0)
    while any(h < n for h, n in zip(had, blocks)):
        total = sum(w for w, h, n in zip(weight, had, blocks) if h < n)
        rate = [w / total if h < n else 0 for w, h, n in zip(weight, had, blocks)]
        step = min((len(p) - h) / r for p, h, r in zip(passes, had, rate) if r)  # to the next whole share of any source
        now, had = now + step, [h + r * step for h, r in zip(had, rate)]
        for p, h, r in zip(passes, had, rate):
            if r and h == len(p):
                p.append(now)
    out, at = [], [0] * len(names)
    for slot in range(sum(blocks)):
        free = [i for i in range(len(names)) if at[i] < blocks[i] and math.floor(passes[i][at[i]]) <= slot]
        i = min(free, key=lambda i: (math.ceil(passes[i][at[i] + 1]), i))
        out += queues[i][at[i] * size:(at[i] + 1) * size]
        at[i] += 1
    return out


def test_result_is_in_the_order_of_the_mix(spark, tmp_path, monkeypatch):
    sources = ["web"] * 900 + ["books"] * 300 + ["code"] * 130 + [None] * 70
    rows = [(i, s, f"text {i} " + "word " * (i % 7)) for i, s in enumerate(sources)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs.repartition(7, "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    hashes = docs.select("source", F.xxhash64(F.struct("doc_id", F.xxhash64("text")), F.lit(42)), "doc_id").collect()
    want = brute_mix([tuple(r) for r in hashes])
    assert sorted(want) == list(range(len(rows)))
    stages = dict(corpus_pipeline.STAGES)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(k, stages[k]) for k in ("mix", "tokens")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several part files between the stages
    try:
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert [r.doc_id for r in sorted(out.collect(), key=lambda r: r.position)] == want
        assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "position"}
        # small read splits deal files anew; the places stay, also in a written result
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        again = corpus_pipeline.run(spark, str(tmp_path))
        again.write.parquet(str(tmp_path / "result"))
        assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "result")).orderBy("position").collect()] == want
        # without the stage the places are others
        monkeypatch.setattr(corpus_pipeline, "STAGES", [("tokens", stages["tokens"])])
        plain = [r.doc_id for r in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r.position)]
        assert plain != want and sorted(plain) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_places_of_rows_from_no_file(spark):
    from tickweave.llm import mixing

    df = spark.range(50, numPartitions=3).withColumn("position", F.lit("theirs"))
    got = mixing.stored_positions(df).collect()
    assert sorted((r.id, r.position) for r in got) == [(i, i) for i in range(50)]
    assert mixing.stored_positions(df.limit(0)).count() == 0


def test_run_on_odd_rows(spark, tmp_path):
    base = [tuple(r) for r in read_table(spark, SF001, "documents").select("doc_id", "text", "lang", "source").limit(60).collect()]
    odd = [(None, None, None, None), (None, "", "en", None), (-1, None, None, "a"), (-2, "", None, "a"), (-3, "some words here " * 8_000, "en", "a"),
           base[0], base[0], (None, base[1][1], "en", "b"), (-4, base[2][1], "en", "b"), (-5, "password: hunter2secret " + base[3][1], "en", None)]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(base + odd, schema).withColumns({c: F.lit(7) for c in ("position", "score", "fp", "ids", "__text", "n_chars")})
    labels = read_table(spark, SF001, "labels")
    for rows, given, folder in ((docs, labels, "odd"), (docs.limit(0), labels, "empty"), (docs, labels.limit(0), "unlabelled")):
        rows.repartition(3).write.parquet(str(tmp_path / folder / "documents.parquet"))
        given.write.parquet(str(tmp_path / folder / "labels.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / folder)).collect()
        assert sorted(r.position for r in out) == list(range(len(out)))
        ids = [r.doc_id for r in out if r.doc_id is not None]
        assert len(ids) == len(set(ids)) and set(ids) <= {r[0] for r in base + odd}
        assert (len(out) == 0) == (folder == "empty")
