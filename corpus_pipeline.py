"""A corpus pipeline of five stages, each one of the corpus operators.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame that is written and read
again as the next stage's ``docs``. All but the last return the columns of documents.
Which rows of equal standing stay is fixed by their ids, so reruns agree.

Null texts count as empty: they are not toxic, equal to each other and to empty ones, similar to
nothing else, hold no benchmark item and add no word to the mix. A null id ranks behind others; rows
equal in text and id are thinned to one. Very long texts are taken whole. Columns other than id, text
and source may have any name. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from footfall.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents; rows that score 0.5 or more go."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.keep_owners(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts (five-word shingles, 0.8) one stays."""
    return simhash.drop_similar(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: the blocks of each output shard, by parts of documents."""
    return mixing.mix_blocks(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # learned scores and hashed draws cannot be written in SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
