"""Seed rows → candidates, their sources and import counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions import urls


def candidate_id(key: Column) -> Column:
    """Deterministic id: the same key gets the same id in every run and on every executor."""
    return F.xxhash64(key)


def keyed_seeds(seeds: DataFrame) -> DataFrame:
    """Seeds with their candidate key; values without a usable host are dropped."""
    return (
        seeds.withColumn("_normal", urls.normalize_url("source_value"))
        .withColumn("candidate_key", F.expr(urls.https_origin("_normal")))
        .drop("_normal")
        .where("candidate_key <> ''")
        .withColumn("candidate_id", candidate_id(F.col("candidate_key")))
    )


def clean_candidates(seeds: DataFrame, existing: DataFrame | None = None, suffixes: DataFrame | None = None) -> DataFrame:
    """New candidates: one row per key, first occurrence wins, known keys left out."""
    first = (
        keyed_seeds(seeds)
        .groupBy("candidate_id", "candidate_key")
        .agg(F.min("seq").alias("discovered_seq"))
    )
    if existing is not None:
        first = first.join(existing.select("candidate_key"), "candidate_key", "left_anti")
    hosted = first.withColumn("_host", F.expr(urls.hostname("candidate_key")))
    return urls.with_registrable_domain(hosted, "_host", suffixes).select(
        "candidate_id",
        "candidate_key",
        "registrable_domain",
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempts"),
        "discovered_seq",
        F.lit(None).cast("string").alias("last_error"),
    )


def candidate_sources(seeds: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (candidate, source, value) triples, known ones included."""
    rows = keyed_seeds(seeds).select(
        "candidate_id", "source_name", "source_value"
    )
    if existing is not None:
        rows = rows.unionByName(existing.select("candidate_id", "source_name", "source_value"))
    return rows.distinct()


def import_counters(seeds: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Per source: rows with a usable host, and keys that this source was first to bring."""
    keyed = keyed_seeds(seeds)
    per_key = keyed.groupBy("candidate_key", "source_name").agg(
        F.count("*").alias("eligible"), F.min("seq").alias("seq")
    )
    firsts = per_key.groupBy("candidate_key").agg(F.min(F.struct("seq", "source_name"))["source_name"].alias("source_name"))
    if existing is not None:
        firsts = firsts.join(existing.select("candidate_key"), "candidate_key", "left_anti")
    eligible = per_key.select("source_name", "eligible", F.lit(0).alias("added"))
    added = firsts.select("source_name", F.lit(0).cast("bigint").alias("eligible"), F.lit(1).alias("added"))
    return (
        eligible.unionByName(added)
        .groupBy("source_name")
        .agg(F.sum("added").alias("added"), F.sum("eligible").alias("eligible"))
    )


def source_names(sources: DataFrame) -> DataFrame:
    """Distinct sorted source names per candidate (as many as there are lists)."""
    return (
        sources.select("candidate_id", "source_name")
        .distinct()
        .groupBy("candidate_id")
        .agg(F.array_sort(F.collect_list("source_name")).alias("source_names"))
    )


def pending_candidates(
    candidates: DataFrame, sources: DataFrame | None = None, source_name: str | None = None, limit: int | None = None
) -> DataFrame:
    """Open work in discovery order, optionally of one source."""
    open_work = candidates.where(F.col("status").isin("pending", "retry"))
    if source_name is not None:
        mine = sources.where(F.col("source_name") == source_name)
        open_work = open_work.join(mine, "candidate_id", "left_semi")
    if limit is None:
        return open_work
    return open_work.orderBy("discovered_seq", "candidate_id").limit(limit)


def work_batch(candidates: DataFrame, concurrency: int = fv.GLOBAL_CONCURRENCY) -> DataFrame:
    return pending_candidates(candidates, limit=min(50, max(1, concurrency * 2)))


def is_eligible_master_row() -> Column:
    """An Indian domain with the platform named in any technology column."""
    technology = F.lower(F.concat_ws(" ", "platform", "technologies", "ecom_verdict"))
    return F.lower(F.trim(F.coalesce("domain", F.lit("")))).endswith(".in") & technology.contains("shopify")


def master_seeds(rows: DataFrame, source_name: str = "master_list") -> DataFrame:
    """Eligible master-list rows as seeds."""
    return rows.where(is_eligible_master_row()).select(
        F.lit(source_name).alias("source_name"), F.col("domain").alias("source_value"), "seq"
    )
