"""Corpus pipeline: five stages, each written as Parquet and reread as the next one's input.

toxicity (documents it rejects go) -> exact dedup (one of each group stays) -> n-gram Jaccard join (one
document of each group of near copies stays) -> benchmark decontamination (documents that hold a
benchmark passage go) -> SentencePiece ids (and the decoded text).

Every stage takes the rows as they are: a null text counts as empty and is kept by all stages (one of them after exact
dedup), a null or repeated doc_id names its rows no less, columns beside doc_id and text pass through whatever their
names, an empty table gives an empty one, and without labels of both classes the toxicity stage follows the only class seen.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import decontaminate, exact, ngram_join, pieces, toxicity
from ledgerflow.llm.common import stored


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labelled documents of the table itself; rejects from the operator's threshold on."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train_on(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies share four fifths of their five-word shingles; one of each group stays."""
    return ngram_join.drop_near_copies(docs, n=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.tokenize(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxic_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard", near_stage),
    ("decontamination", benchmark_stage),
    ("sentencepiece", tokens_stage),
]

#: a trained classifier decides the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of the documents that pass all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
