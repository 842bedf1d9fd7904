"""A corpus pipeline: the documents go through five operators, each working on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.

Defined results are those of the operators: nulls in any column, empty and very long texts are carried through; rows that
share a ``doc_id`` stay or go together; rows alike in all columns are all kept, each stage after the first judging them
once; an empty table gives no rows, and further columns of documents are left out by the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lorgnette.llm import bpe, decontaminate, jaccard, line_dedup, quality
from lorgnette.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Outliers of their language and source go."""
    return quality.apply(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found on many sites stay in one document only; of documents that stand twice or more the next stage keeps one, whole."""
    return line_dedup.apply(docs, keep_copies=True)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.apply(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.apply(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of what is left."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", ngram_jaccard),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]
#: SQL expresses neither the robust covariances nor the latent space nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in ``sf_dir``; what stages return is kept in the shared folder."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
