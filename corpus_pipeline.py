"""From a table of documents to packed training sequences, in five stages.

Each stage takes what the one before has kept, written as Parquet and read again,
so a lost executor repeats at most one stage. All but the last return the columns
they were given.

Nulls in any column, empty and very long texts and repeated rows go through all
stages as each operator's docstring states: a null text scores, links and is kept as
an empty one, rows are told apart by themselves and not by their ids, and a null
stays null. Extra columns, also ones named like an operator's own, are kept by all
stages but the last. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playtrail.llm.decontamination import drop_contaminated
from playtrail.llm.packing import pack_documents
from playtrail.llm.pii import redact_pii
from playtrail.llm.quality import keep_good
from playtrail.llm.queries import tokenizer_path
from playtrail.llm.simhash import drop_near_copies
from playtrail.llm.store import prepare, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression classifier rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group."""
    prepare(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    prepare(spark)
    return redact_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    prepare(spark)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("pii", personal_data),
    ("best-fit packing", packing),
]
# Trained models and tokenizers have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
