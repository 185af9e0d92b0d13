"""Crawl results: response documents, archive captures, store snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import schemas


def read_pages_json(spark: SparkSession, path: str) -> DataFrame:
    """Response documents, one JSON object per line; broken documents are misses."""
    return spark.read.schema(schemas.PAGES).json(path, mode="DROPMALFORMED")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_captures(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Archive capture lines. `limit` counts lines before malformed ones are dropped."""
    lines = spark.read.text(path)
    if limit is not None:
        lines = lines.limit(limit)
    # Fields without a schema stay as they are: the parsed line is kept next to the key columns.
    parsed = lines.select(F.try_parse_json("value").alias("capture")).where("capture IS NOT NULL")
    return parsed.select(
        *[
            F.try_variant_get("capture", f"$.{name}", "string").alias(column)
            for name, column in (("url", "url"), ("timestamp", "ts"), ("status", "status"), ("digest", "digest"))
        ]
    )
