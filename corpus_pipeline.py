"""A pipeline over the documents table: drop toxic texts, keep one of each group of near-duplicates, redact secrets, mix the
sources to their weights, encode to byte-level BPE tokens and decode them again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, common, mixing, secrets, simhash, toxicity


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, where it has the column, made to fit the texts again."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored under the threshold, all columns; null and empty texts are scored like any other, repeated rows alike. An empty table gives no rows."""
    common.small_batches(spark)
    return toxicity.keep_civil(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each group of near-duplicates, as ``simhash.keep_one`` says; null and empty texts are one group. An empty table gives no rows."""
    common.small_batches(spark)
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts masked and n_chars counted again; a null text stays null, repeated rows stay. An empty table gives no rows."""
    return _counted(secrets.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; those without words are not taken, null is a source of its own. An empty table gives no rows."""
    return _counted(mixing.mixture(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and the digest of what they decode to, per row; a null text has none, repeated rows stay. An empty table gives no rows."""
    common.small_batches(spark)
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Learned scores and XXH64 are beyond SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage keeps is written as Parquet to the checkpoint folder before the next reads it."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
