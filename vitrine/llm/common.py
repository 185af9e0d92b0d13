"""What several operators share: table reading, stored intermediates, text forms."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder in the place that the driver and all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """`df` as a written table: computed once, and not lost with an executor."""
    folder = new_folder(df.sparkSession, what)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def merge_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join that sends neither side to the driver, for sides that both grow with the documents.

    Spark takes a written table to be as large as its file and an explode to add nothing. A side measured that way
    can pass for small enough to broadcast and hold many times the driver's memory.
    """
    return left.join(right.hint("merge"), on, how)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo `folds`; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))
