"""From raw documents to training tokens: five stages, each one of the
training-data operators. A stage takes all rows that its predecessor kept,
from Parquet, and its decisions take effect; all but the last return the
columns of ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, exact_dedup, mixing, simhash, toxicity
from quire.llm.common import read, shared_dir
from quire.llm.queries import tokenizer_file
from quire.session import ship_package


def _ready(spark: SparkSession) -> None:
    shared_dir(spark)
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go."""
    _ready(spark)
    return toxicity.clean(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts one document stays."""
    _ready(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of close SimHash fingerprints one document stays."""
    _ready(spark)
    return simhash.one_per_group(docs)


# Toxic documents are gone by the time of mixing, so their domain has no part.
TARGETS = {"clean": 0.94, "junk": 0.06}


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the expected domain token
    totals match the target weights."""
    _ready(spark)
    return mixing.repeated(docs, mixing.domains_of(read(spark, sf_dir, "labels"), domains=tuple(TARGETS)), TARGETS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, little-endian unsigned 32 bits) of every text, and
    the digests of the ids and of the text that they decode to."""
    _ready(spark)
    coded = bpe.encode(docs, tokenizer_file(), decoded=True)
    return coded.select(F.col("row")["doc_id"].alias("doc_id"), "ids", *bpe.digests(coded))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("SimHash near-dedup", drop_near_copies),
          ("mixing sources to target weights", mix_domains), ("BPE encoding and decoding", encode_tokens)]

# Fingerprints, learned scores and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet to
    the shared folder and read again."""
    _ready(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
