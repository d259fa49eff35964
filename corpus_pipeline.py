"""The corpus pipeline: documents through five operators, each stage stored.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canton.llm.line_dedup import dedup_lines
from canton.llm.mixing import keep_sampled
from canton.llm.ngram_join import keep_one
from canton.llm.sentencepieces import encode_documents
from canton.llm.toxicity import fit, keep_clean, labelled_sample
from canton.session import stored_table as stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_clean(docs, fit(*labelled_sample(docs, labels)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later similar lines go; every document stays."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents towards the target weights."""
    return keep_sampled(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' SentencePiece ids."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", encoding),
]

#: Compression, MinHash and subword models have no SQL form; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
