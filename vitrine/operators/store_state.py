"""Store state as tables: reads, upserts, attempts, refresh selection and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions.text import is_blank


def domain_key(domain: Column) -> Column:
    return F.rtrim(F.lower(domain), F.lit("/"))


# --- reads -------------------------------------------------------------------


def accepted_records(stores: DataFrame) -> DataFrame:
    return stores.where("accepted")


def by_confidence(stores: DataFrame) -> DataFrame:
    """Accepted records, highest combined score first (a range-partitioned sort)."""
    return accepted_records(stores).orderBy(F.desc(F.col("shopify_score") + F.col("india_score")), "candidate_id")


def with_status(candidates: DataFrame, status: str) -> DataFrame:
    return candidates.where(F.col("status") == status)


def candidates_with_records(candidates: DataFrame, stores: DataFrame, accepted_only: bool = False) -> DataFrame:
    records = accepted_records(stores) if accepted_only else stores
    return candidates.join(records, "candidate_id")


def to_revalidate(candidates: DataFrame) -> DataFrame:
    """Every accepted store is recomputed."""
    return with_status(candidates, "accepted")


# --- writes ------------------------------------------------------------------


def one_per_candidate(records: DataFrame) -> DataFrame:
    """The last checked record of every candidate; a task sends on one per candidate."""
    last = F.row_number().over(W.partitionBy("candidate_id").orderBy(F.desc_nulls_last("checked_at")))
    return records.withColumn("_nth", last).where("_nth = 1").drop("_nth")


def not_older(new: DataFrame, old: DataFrame) -> DataFrame:
    """The new records that no old record of the candidate was checked after; of the old ones two columns are read."""
    held = old.groupBy("candidate_id").agg(F.max("checked_at").alias("_held"))
    work = new.join(held, "candidate_id", "left")
    return work.where("_held IS NULL OR checked_at >= _held").select(*new.columns)


def upsert_latest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Last write per candidate; at equal times the new row wins. `old` has one record per candidate: records
    without news stay where they are and only keys and times of `old` are looked up."""
    wins = not_older(one_per_candidate(new), old)
    return old.join(wins.select("candidate_id"), "candidate_id", "left_anti").unionByName(wins.select(*old.columns))


def candidate_status(candidates: DataFrame, stores: DataFrame, attempts: DataFrame | None = None) -> DataFrame:
    """Candidates with the status their records and attempts imply; errors are cleared by a record."""
    verdict = stores.select("candidate_id", F.when(F.col("accepted"), "accepted").otherwise("rejected").alias("_verdict"))
    work = candidates.join(verdict, "candidate_id", "left")
    if attempts is None:
        work = work.withColumns({"_outcome": F.lit(None).cast("string"), "_error": F.lit(None).cast("string"), "_n": F.lit(0)})
    else:
        work = work.join(
            attempts.select("candidate_id", F.col("outcome").alias("_outcome"), F.col("last_error").alias("_error"), F.col("attempts").alias("_n")),
            "candidate_id",
            "left",
        )
    return (
        # A last attempt without an error says nothing until its record is there.
        work.withColumn("status", F.coalesce("_verdict", F.when(F.col("_outcome") != "done", F.col("_outcome")), "status"))
        .withColumn("attempts", F.coalesce(F.col("_n").cast("int"), F.col("attempts")))
        .withColumn("last_error", F.when(F.col("_verdict").isNotNull(), None).otherwise(F.coalesce("_error", "last_error")))
        .drop("_verdict", "_outcome", "_error", "_n")
    )


def attempt_outcome(attempts: DataFrame) -> DataFrame:
    """Per candidate (candidate_id, attempt, error, transient): accepted for verdict, retry or failed.

    A transient error is retried while fewer than three attempts were made; any other
    error fails at once; a last attempt without error leaves the candidate done.
    """
    last = F.max(F.struct("attempt", "error", "transient"))
    rolled = attempts.groupBy("candidate_id").agg(F.count("*").alias("attempts"), last.alias("last"))
    outcome = (
        F.when(F.col("last.error").isNull(), "done")
        .when(F.col("last.transient") & (F.col("attempts") < fv.MAX_ATTEMPTS), "retry")
        .otherwise("failed")
    )
    return rolled.select(
        "candidate_id",
        "attempts",
        outcome.alias("outcome"),
        F.col("last.error").alias("last_error"),
    )


# --- refresh -------------------------------------------------------------------


def wanted_stores(stores: DataFrame, domains: DataFrame) -> DataFrame:
    """Stores whose domain is in a wanted set (column `domain_url`)."""
    wanted = domains.where(f"NOT {is_blank('domain_url')}").select(domain_key(F.trim("domain_url")).alias("_key")).distinct()
    return stores.withColumn("_key", domain_key(F.col("domain_url"))).join(wanted, "_key", "left_semi").drop("_key")


def outdated(stores: DataFrame, version: int = fv.EXTRACTION_VERSION) -> DataFrame:
    return stores.where(F.col("extraction_version") < version)


def only_strong_kind(stores: DataFrame, kind: str = "registered_india") -> DataFrame:
    """Accepted stores whose strong evidence about the country is of one kind only."""
    strong = F.filter("india_evidence", lambda e: e["strength"] == "strong")
    kinds = F.array_sort(F.array_distinct(F.transform(strong, lambda e: e["kind"])))
    return accepted_records(stores).where(kinds == F.array(F.lit(kind)))


def reviewed_rows(worksheet: DataFrame) -> DataFrame:
    """Worksheet rows in which a reviewer filled any column."""
    filled = F.lit(False)
    for column in fv.REVIEW_COLUMNS:
        filled = filled | ~F.expr(is_blank(column))
    return worksheet.where(filled)


def reextract_selection(
    stores: DataFrame,
    domains: DataFrame | None = None,
    worksheet: DataFrame | None = None,
    only_reviewed: bool = True,
    single_kind: bool = False,
    force: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Records to extract again: by list, by worksheet or by single strong kind, never by two."""
    if sum((domains is not None, worksheet is not None, single_kind)) > 1:
        raise ValueError("choose one of domains, worksheet and single_kind")
    if worksheet is not None:
        domains = (reviewed_rows(worksheet) if only_reviewed else worksheet).select("domain_url")
    if single_kind:
        chosen, force = wanted_stores(stores, only_strong_kind(stores).select("domain_url")), True
    elif domains is not None:
        chosen = wanted_stores(stores, domains)
    else:
        chosen = accepted_records(stores)
    if not force:
        chosen = outdated(chosen)
    return chosen if limit is None else chosen.orderBy("candidate_id").limit(limit)


def platform_holds(evidence: Column) -> Column:
    """The platform verdict recomputed from a record's own evidence list."""
    kinds = F.array_distinct(F.transform(evidence, lambda e: e["kind"]))
    return F.exists(evidence, lambda e: e["strength"] == "strong") & (F.size(kinds) >= 2)


RECOMPUTED = (
    "domain_url", "contacts", "socials", "category", "description", "logo_url", "state", "india_score",
    "india_evidence", "extraction_sources", "redirect_history",
)


def refresh_outcome(
    selected: DataFrame, recomputed: DataFrame, errors: DataFrame, checked_at: Column | None = None
) -> DataFrame:
    """Refreshed records with an `outcome` column; no old record is lost to a failed request.

    `recomputed` carries home_reason, india_ok and state_conflict beside the new fields;
    `errors` has candidate_id and error. Old platform evidence is kept.
    """
    now = F.current_timestamp() if checked_at is None else checked_at
    fresh = recomputed.select(
        "candidate_id", F.struct(*RECOMPUTED, "home_reason", "india_ok", "state_conflict").alias("fresh")
    )
    failed = errors.groupBy("candidate_id").agg(F.min("error").alias("error"))
    work = selected.join(fresh, "candidate_id", "left").join(failed, "candidate_id", "left")
    tls = F.coalesce(F.col("error").contains("CERTIFICATE_VERIFY_FAILED"), F.lit(False))
    outcome = (
        F.when(tls, "rejected_tls")
        .when(F.col("error").isNotNull() | F.col("fresh").isNull(), "kept_old")
        .when(F.col("fresh.home_reason").isNotNull(), "rejected_home")
        .otherwise("refreshed")
    )
    work = work.withColumn("outcome", outcome)
    done = F.col("outcome") != "kept_old"
    new = F.col("outcome") == "refreshed"
    accepted = (
        F.when(new, platform_holds(F.col("shopify_evidence")) & F.col("fresh.india_ok") & ~F.col("fresh.state_conflict"))
        .when(done, F.lit(False))
        .otherwise(F.col("accepted"))
    )
    reasons = (
        F.when(
            new,
            F.array_compact(
                F.array(
                    F.when(~F.col("fresh.india_ok"), "insufficient_india_evidence"),
                    F.when(F.col("fresh.state_conflict"), "conflicting_state_evidence"),
                )
            ),
        )
        .when(F.col("outcome") == "rejected_tls", F.array(F.lit("tls_certificate_invalid")))
        .when(F.col("outcome") == "rejected_home", F.array(F.col("fresh.home_reason")))
        .otherwise(F.col("rejection_reasons"))
    )
    changed = {name: F.when(new, F.col(f"fresh.{name}")).otherwise(F.col(name)) for name in RECOMPUTED}
    changed |= {
        "accepted": accepted,
        "rejection_reasons": reasons,
        "checked_at": F.when(done, now).otherwise(F.col("checked_at")),
        "extraction_version": F.when(done, F.lit(fv.EXTRACTION_VERSION)).otherwise(F.col("extraction_version")),
    }
    columns = [changed[c].alias(c) if c in changed else F.col(c) for c in selected.columns]
    message = F.when(F.col("outcome") == "kept_old", F.coalesce("error", F.lit("page missing")))
    return work.select(*columns, "outcome", message.alias("refresh_error"))


def refresh_counters(refreshed: DataFrame) -> DataFrame:
    kept = F.col("outcome") == "kept_old"
    return refreshed.agg(
        F.count("*").alias("refresh_selected"),
        F.count_if(~kept).alias("refresh_completed"),
        F.count_if(kept).alias("refresh_errors"),
        F.count_if(~kept & ~F.col("accepted")).alias("refresh_removed"),
    )


def refresh_errors(refreshed: DataFrame) -> DataFrame:
    return refreshed.where("outcome = 'kept_old'").select("domain_url", F.col("refresh_error").alias("error"))
