"""From raw documents to packed training sequences: the stages in order, each on all
rows that the one before it kept.

Every stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before it wrote
and ``sf_dir`` has the labels. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexrarity.llm import packing, quality, shingle_join, toxicity
from hexrarity.llm.common import stored
from hexrarity.llm.queries import table, tokenizer_file

#: Chunks that a worker of the packing keeps: fewer than when it runs alone, as the stages
#: before it have left the executors' heaps large.
KEPT_CHUNKS = 250_000


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field does not find toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents likely to have at least the middle grade."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.filtered(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, the one with the smallest id."""
    return shingle_join.representatives(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's pieces with their places in the sequences."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"), kept=KEPT_CHUNKS)


STAGES = [
    ("toxicity", remove_toxic),
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: The trained and the tokenized stages are not SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
