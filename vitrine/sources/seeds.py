"""Seed files: text lists, CSV with a sniffed header, gzip master lists, audit worksheets."""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions.text import is_blank

HEADER_NAMES = ("domain_url", "domain", "url", "website")
BOM = "﻿"


def _placed(df: DataFrame) -> DataFrame:
    """Rows of a file source with the place they were read from: file, split, order in the split."""
    return df.selectExpr(
        "*", "_metadata.file_path AS _file", "_metadata.file_block_start AS _block", f"{_POSITION} AS _at"
    )


# Grows along a split; the upper bits number the task and say nothing of the input.
_POSITION = "monotonically_increasing_id() & 8589934591"


def _numbered(placed: DataFrame) -> DataFrame:
    """Adds `seq`, which grows with the position in the input: by file name, then along the file.

    Spark deals splits out by size, so a task's number says nothing of the order. The splits
    are numbered instead, one row each; a row's own number counts along its split.
    """
    splits = placed.select("_file", "_block").distinct()
    ranked = splits.withColumn("_split", F.row_number().over(W.orderBy("_file", "_block")) - 1)
    numbered = placed.join(ranked, ["_file", "_block"])
    return numbered.withColumn("seq", F.expr("shiftleft(cast(_split AS bigint), 36) + _at")).drop("_file", "_block", "_at", "_split")


def read_text_seeds(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    """One value per line; blank lines and `#` comments are dropped."""
    lines = _placed(spark.read.text(path)).withColumn("source_value", F.trim(F.ltrim(F.col("value"), F.lit(BOM))))
    kept = lines.where((F.col("source_value") != "") & ~F.col("source_value").startswith("#"))
    named = kept.select(F.lit(source_name or _file_source(path)).alias("source_name"), "source_value", "_file", "_block", "_at")
    return _numbered(named)


def _file_source(path: str) -> str:
    return f"file:{os.path.basename(path.rstrip('/'))}"


def _column_of(header: str) -> int | None:
    """Where a header line names the URL column."""
    cells = next(csv.reader([header.lstrip(BOM)]), [])
    names = [cell.strip().lower() for cell in cells]
    return next((names.index(name) for name in HEADER_NAMES if name in names), None)


def read_csv_seeds(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    """The URL column of CSV files: by header name when a file has a known one, else its first column.

    Only the first line of every file reaches the driver; a file's own header decides.
    """
    lines = _placed(spark.read.text(path)).where("trim(value) <> ''")
    firsts = lines.where("_block = 0").groupBy("_file").agg(F.min(F.struct("_at", "value")).alias("first"))
    headers = [(r._file, r.first._at, _column_of(r.first.value)) for r in firsts.collect()]
    known = spark.createDataFrame(headers, "_file string, _header bigint, _column int")
    width = 1 + max([c for _, _, c in headers if c is not None], default=0)
    cells = ", ".join(f"c{i} string" for i in range(width))
    rows = lines.join(known, "_file").where(~((F.col("_block") == 0) & (F.col("_at") == F.col("_header")) & F.col("_column").isNotNull()))
    parsed = F.from_csv(F.ltrim("value", F.lit(BOM)), cells, {"escape": '"', "mode": "PERMISSIVE"})
    picked = rows.withColumn("_cells", parsed).withColumn(
        "source_value", F.element_at(F.array(*[F.col(f"_cells.c{i}") for i in range(width)]), F.coalesce("_column", F.lit(0)) + 1)
    )
    kept = picked.where(f"NOT {is_blank('source_value')}")
    named = kept.select(F.lit(source_name or _file_source(path)).alias("source_name"), "source_value", "_file", "_block", "_at")
    return _numbered(named)


def read_seeds(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    reader = read_csv_seeds if path.lower().endswith(".csv") else read_text_seeds
    return reader(spark, path, source_name)


def read_master_list(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A header-row CSV, plain or gzip, with the columns the eligibility rule reads.

    One gzip file cannot be split, so its rows are spread right after the read.
    """
    rows = spark.read.csv(path, header=True, mode="PERMISSIVE", escape='"')
    for name in rows.columns:
        if name.startswith(BOM):
            rows = rows.withColumnRenamed(name, name.lstrip(BOM))
    wanted = ("domain", "platform", "technologies", "ecom_verdict")
    picked = _placed(rows).select(
        *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted], "_file", "_block", "_at"
    )
    return _numbered(picked).repartition(partitions or spark.sparkContext.defaultParallelism)


AUDIT_COLUMNS = (*fv.EXPORT_COLUMNS, "source_names", "shopify_score", "india_score", *fv.REVIEW_COLUMNS)


def read_worksheet(spark: SparkSession, path: str) -> DataFrame:
    """A reviewed audit worksheet; columns are taken by name, absent ones are empty."""
    rows = spark.read.csv(path, header=True, mode="PERMISSIVE", escape='"', multiLine=True)
    for name in rows.columns:
        if name.startswith(BOM):
            rows = rows.withColumnRenamed(name, name.lstrip(BOM))
    return rows.select(
        *[
            F.coalesce(F.col(c), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c)
            for c in AUDIT_COLUMNS
        ]
    )
