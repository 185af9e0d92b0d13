"""The corpus pipeline: documents in, token ids of a clean mix out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; between stages the
rows are a written table. All stages but the last return the columns of `documents` as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import exact_dedup, mixing, near_dedup, pieces, toxicity
from vitrine.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on those present, does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates the one with the smallest id."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as their source's share of all words asks for."""
    return mixing.with_copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix."""
    return pieces.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

# Trained models and signatures have no SQL form; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
