"""A training corpus from raw documents, in five stages.

Every stage is (name, function of (spark, docs, sf_dir)); its rows are written
as Parquet and read back as the next one's ``docs``. All but the last return
the columns of ``documents``:

1. quality      documents that the quadratic discriminant rejects go
2. near_dups    one document of each group of SimHash links stays
3. secrets      found secrets are replaced in the texts
4. mix          all rows, in the order of the Pfair mix of their sources
5. tokens       doc_id, n_tokens, ids_sha256, decoded_sha256 of each text, and
                position: its place in the mix, from 0

The mix is computed once, by its stage, which puts rows and part files into its
order. The last stage reads a row's place off the files, by part and row number, so
it holds however the files are dealt to tasks.

Defined results: null and empty texts are judged by the quality stage like any
others, and encode to no tokens if kept; a null source is a source of its own; null
doc_ids are documents like any others, of which near copies go by their text (of
copies that all have a null id one stays); repeated rows are copies; very long texts
pass whole; without usable labels all documents are kept; an empty table gives an
empty result; extra columns are carried up to the last stage.

No SQL says this (a fitted classifier, XXH64 fingerprints, merges), so
``ORACLE_SQL`` is None and the tests hold it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickweave.llm import bpe, mixing, qda, secretscan, simhash
from tickweave.llm.common import prepare, read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return qda.keep_good(docs, qda.fit(spark, docs, read_table(spark, sf_dir, "labels")))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secretscan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.in_mixed_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.digests(mixing.stored_positions(docs), bpe.public_bpe(), keep=("position",))


STAGES = [("quality", quality), ("near_dups", near_dups), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
