"""Written results: CSV, evidence lines, report, worksheet, and versioned store snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.operators import reports
from vitrine.operators.store_state import not_older, one_per_candidate
from vitrine.sources.keyed_log import VERSION, KeyedLog


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", encoding="UTF-8")
    return path


def unique_stores(stores: DataFrame, directory: str) -> DataFrame:
    """The unique domains of `stores`: written once, to a fresh folder below the directory, then read as often as wanted."""
    path = f"{directory}/unique_domains/{uuid.uuid4().hex}"
    reports.unique_domains(stores).write.parquet(path)
    return stores.sparkSession.read.parquet(path)


def export_results(stores: DataFrame, directory: str, unique: DataFrame | None = None) -> tuple[str, str]:
    """The seven-column CSV and the evidence lines, over the same unique domains, best score first.

    Parts are sorted ranges: read in the order of their names they are one sorted file. A run that also draws
    a sample passes the `unique_stores` of `stores` to both.
    """
    best = (F.desc(F.col("shopify_score") + F.col("india_score")), F.asc("candidate_id"))
    unique = unique_stores(stores, directory) if unique is None else unique
    csv_path = _write_csv(reports.export_rows(unique.orderBy(*best)), f"{directory}/stores_csv")
    evidence_path = f"{directory}/audit_evidence"
    reports.evidence_rows(unique.orderBy(*best)).write.mode("overwrite").json(evidence_path, ignoreNullFields=False)
    return csv_path, evidence_path


def write_report(candidates: DataFrame, stores: DataFrame, directory: str, worksheet: DataFrame | None = None) -> str:
    path = f"{directory}/quality_report"
    reports.quality_report(candidates, stores, worksheet).write.mode("overwrite").json(path, ignoreNullFields=False)
    return path


def write_audit_sample(stores: DataFrame, directory: str, size: int, seed: int, unique: DataFrame | None = None) -> str:
    unique = unique_stores(stores, directory) if unique is None else unique
    sample = reports.audit_sample(unique, size, seed)
    return _write_csv(reports.worksheet_rows(sample), f"{directory}/manual_audit_csv")


# --- store state ---------------------------------------------------------------


def newest_records(rows: DataFrame) -> DataFrame:
    """Every candidate's record of the last commit. Commits drop what is older than the state, so the version alone
    decides: it is found on two numbers, and the records follow by their key."""
    last = rows.groupBy("candidate_id").agg(F.max(VERSION).alias("_last"))
    return rows.join(last, "candidate_id").where(F.col(VERSION) == F.col("_last")).drop("_last")


class StoreSnapshots(KeyedLog):
    """The state of all stores as a keyed log (see `keyed_log`)."""

    def __init__(self, spark: SparkSession, root: str, **options):
        super().__init__(spark, root, schemas.STORES, "candidate_id", newest_records, **options)

    def commit(self, new: DataFrame, batch_id: int, run: str = "") -> int:
        """Upserts records: of a candidate's records the last checked one stays, at equal times the new one."""
        if self.knows(batch_id, run):
            return self.version()
        fresh = one_per_candidate(new.select(*self.columns))
        return super().commit(not_older(fresh, self.read(fresh)), batch_id, run)
