"""From raw documents to packed sequences: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgemart.llm import exact_dedup, minhash, mixing, packing, toxicity
from forgemart.llm.common import staged, table
from forgemart.llm.queries import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not call toxic."""
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship(spark)
    return minhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents and their place in an order that serves every source at its target weight."""
    return mixing.placed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, in the mixed order."""
    ship(spark)
    return packing.pack(docs, order=mixing.ORDER)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Signatures, the lexicon and the tokenizer cannot be written in SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
