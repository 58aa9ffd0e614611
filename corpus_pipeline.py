"""Corpus pipeline: quality rules, near-copies, benchmark passages, personal
data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the session's shared folder and rereads it
as the next stage's documents.  All stages but the last return the columns
of ``documents``.

Rows without an id: quality rules and personal data treat them like any
other.  The two stages that decide by id (near-copies, benchmark passages)
cannot name them and keep them.  Null texts fail the quality rules; empty
tables give empty tables; of rows with one id, near-copies leaves one for each
of its components (see ``simhash.keep_one``); other columns pass through all
stages but the last, whatever their names.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.llm import byte_bpe, decontaminate, pseudonyms, quality_rules, queries, simhash
from losslens.llm.common import ensure_checkpoint_dir, read_table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the certified cutoffs."""
    return quality_rules.keep(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one with the least id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    ids = found.select("doc_id").where("doc_id IS NOT NULL").distinct()
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in place of personal data, n_chars (if there) to match."""
    out = pseudonyms.pseudonymize(docs, queries.pseudonym_key(spark), found_col=None)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of each document."""
    out = byte_bpe.encode_and_decode(docs.select("doc_id", "text"), VOCABULARY, public_tokenizers.PATTERN)
    return out.select("doc_id", "ids", *byte_bpe.digests(out))


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii_pseudonyms", hide_private),
    ("byte_level_bpe", to_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
