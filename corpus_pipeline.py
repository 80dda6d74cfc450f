"""A corpus pipeline of five of the operators; each stage works on all that its predecessor kept.

Stages take and give the columns of documents, but for the last, which gives
the pieces of packed sequences.  Each stage's rows are written to the shared
folder and reread, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelake.llm import decontamination, jaccard_join, packing, sentence_dedup, toxicity
from servicelake.llm.common import read_table, ship, written

#: Near duplicates of the corpus: five-word shingles, a similarity of 0.8 or more.
NEAR = jaccard_join.Rule(shingle=5, num=80, den=100)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold of their language; the classifier learns from the labels of those not held out."""
    ship(spark)
    model = toxicity.train(toxicity.training_rows(docs, read_table(spark, sf_dir, "labels")))
    return toxicity.remove_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    ship(spark)
    return jaccard_join.keep_one(docs, NEAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences of passages that stand elsewhere before; ``n_chars`` follows the text."""
    ship(spark)
    left = sentence_dedup.remove_repeats(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    ship(spark)
    return decontamination.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with a checksum of each piece's ids."""
    ship(spark)
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("jaccard_join", near_duplicates),
    ("sentence_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: SQL does not express a trained classifier, greedy tiling or a tokenizer; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
