"""The training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.llm.common import read_table
from tripmill.llm.decontamination import decontaminate
from tripmill.llm.exact_dedup import drop_copies
from tripmill.llm.near_dedup import drop_near_copies
from tripmill.llm.queries import PIECES, tokenizer_file
from tripmill.llm.sentencepieces import digests, encode_and_decode
from tripmill.llm.toxicity import score, train
from tripmill.scratch import new_folder, stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model learns from the labels that are not held out."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).filter("predicted = 0").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the one with the smallest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the smallest id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, and the text they decode to, as digests."""
    return digests(encode_and_decode(docs, tokenizer_file(PIECES)))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepieces", sentencepieces),
]

# A model's scores, verified bands and token ids can't be written as SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), new_folder(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
