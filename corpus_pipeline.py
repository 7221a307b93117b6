"""Training-corpus pipeline: STAGES applied to ``documents`` one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.  What a stage makes of NULLs, empty
and very long texts, ties, repeated rows and empty tables is what its operator
in ``txguard.llm`` says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm import decontaminate, mixing, simhash, tokenfiles, toxicity
from txguard.llm.common import fold, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    train = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), train))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: its smallest doc_id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources meet their targets."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; a row per document, read from them."""
    return tokenfiles.read_documents(spark, tokenfiles.write(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
    ("token files", write_tokens),
]

# Classifying, fingerprinting and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
