"""Reports over the store table: unique domains, distributions, quality, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions.text import is_blank, is_yes
from vitrine.operators.store_state import domain_key


def combined_score() -> Column:
    return F.col("shopify_score") + F.col("india_score")


def unique_domains(stores: DataFrame) -> DataFrame:
    """One accepted record per final domain: highest combined score, then lowest id.

    Domains with several records are found on three narrow columns, and those records' ids that are not the best
    are taken out. Records as such move only if such ids are very many.
    """
    accepted = stores.where("accepted")
    narrow = accepted.select(F.coalesce(domain_key(F.col("domain_url")), F.lit("")).alias("_key"), combined_score().alias("_score"), "candidate_id")
    several = narrow.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.max("_score").alias("_best")).where("_n > 1").drop("_n")
    among = narrow.join(several, "_key")
    first = among.where("_score = _best").groupBy("_key").agg(F.min("candidate_id").alias("_first"))
    others = among.join(first, "_key").where("candidate_id <> _first").select("candidate_id")
    return accepted.join(others, "candidate_id", "left_anti").select(*stores.columns)


def status_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("status").agg(F.count("*").alias("n"))


def unique_domain_count(stores: DataFrame) -> DataFrame:
    # Two plain counts instead of a distinct aggregate: the domains are reduced map-side.
    keys = stores.where("accepted").select(domain_key(F.col("domain_url")).alias("k")).distinct()
    return keys.agg(F.count("*").alias("unique_accepted_domains"))


def status_view(candidates: DataFrame, stores: DataFrame) -> DataFrame:
    return status_counts(candidates).unionByName(
        unique_domain_count(stores).select(
            F.lit("unique_accepted_domains").alias("status"), F.col("unique_accepted_domains").alias("n")
        )
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100 / whole, 2)).otherwise(0.0)


def is_missing(field: str) -> Column:
    if field == "contacts":
        return (F.size("contacts.emails") == 0) & (F.size("contacts.phones") == 0)
    if field == "socials":
        return F.size("socials") == 0
    return F.expr(is_blank(field))


def missing_fields(unique: DataFrame) -> DataFrame:
    """Missing count and percent per reported field, from one pass."""
    counted = unique.agg(
        F.count("*").alias("total"), *[F.count_if(is_missing(f)).alias(f) for f in fv.REPORT_FIELDS]
    )
    cells = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing")) for f in fv.REPORT_FIELDS])
    )
    return counted.select("total", cells.alias("cell")).select(
        "cell.field", "cell.missing", _percent(F.col("cell.missing"), F.col("total")).alias("percent")
    )


def rejection_histogram(stores: DataFrame) -> DataFrame:
    return (
        stores.where(~F.col("accepted"))
        .select(F.explode("rejection_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def source_yield(stores: DataFrame) -> DataFrame:
    """Seen and accepted per source; records without any source count as `unattributed`."""
    names = F.when(F.size("source_names") > 0, F.col("source_names")).otherwise(F.array(F.lit("unattributed")))
    return (
        stores.select("accepted", F.explode(names).alias("source"))
        .groupBy("source")
        .agg(F.count("*").alias("seen"), F.count_if("accepted").alias("accepted"))
    )


def distribution(unique: DataFrame, column: str) -> DataFrame:
    value = F.when(F.expr(is_blank(column)), "missing").otherwise(F.col(column))
    return unique.groupBy(value.alias(column)).agg(F.count("*").alias("n"))


def confidence_stats(unique: DataFrame) -> DataFrame:
    def zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0))

    return unique.agg(
        zero(F.round(F.avg("shopify_score"), 2)).alias("average_shopify_score"),
        zero(F.round(F.avg("india_score"), 2)).alias("average_india_score"),
        zero(F.min("shopify_score")).alias("minimum_shopify_score"),
        zero(F.min("india_score")).alias("minimum_india_score"),
    )


def report_counters(stores: DataFrame) -> DataFrame:
    per_domain = stores.groupBy(domain_key(F.col("domain_url")).alias("k")).agg(
        F.count("*").alias("records"), F.count_if("accepted").alias("accepted")
    )
    counted = per_domain.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("processed_records"),
        F.count_if(F.col("accepted") > 0).alias("accepted_records"),
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted_candidate_records"),
    )
    return counted.withColumn(
        "redirect_duplicates_removed", F.col("accepted_candidate_records") - F.col("accepted_records")
    )


# --- manual audit ------------------------------------------------------------------


def audit_precision(worksheet: DataFrame) -> DataFrame:
    """Precision of both verdicts over the rows in which both were judged."""
    both = ~F.expr(is_blank("shopify_correct")) & ~F.expr(is_blank("india_correct"))
    counted = worksheet.where(both).agg(
        F.count("*").alias("reviewed"),
        F.count_if(F.expr(is_yes("shopify_correct"))).alias("platform_yes"),
        F.count_if(F.expr(is_yes("india_correct"))).alias("india_yes"),
    )
    n = F.col("reviewed")
    share = lambda part: F.when(n > 0, F.col(part) / n)
    status = (
        F.when(n == 0, "not_reviewed")
        .when((share("platform_yes") >= fv.PRECISION_TARGET) & (share("india_yes") >= fv.PRECISION_TARGET), "pass")
        .otherwise("fail")
    )
    return counted.select(
        status.alias("status"),
        "reviewed",
        F.round(share("platform_yes") * 100, 2).alias("shopify_precision_percent"),
        F.round(share("india_yes") * 100, 2).alias("india_precision_percent"),
        F.lit(fv.PRECISION_TARGET * 100).alias("required_precision_percent"),
    )


def field_accuracy(worksheet: DataFrame) -> DataFrame:
    """Accuracy per field over the rows rated for that field."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_correct").alias("rating")) for f in fv.RATED_FIELDS])
    )
    return (
        worksheet.select(cells.alias("cell"))
        .where(~F.expr(is_blank("cell.rating")))
        .groupBy("cell.field")
        .agg(
            F.count("*").alias("reviewed"),
            F.round(F.count_if(F.expr(is_yes("cell.rating"))) * 100 / F.count("*"), 2).alias("accuracy_percent"),
        )
    )


def confidence_band() -> Column:
    return F.when(combined_score() >= fv.HIGH_CONFIDENCE_SCORE, "high").otherwise("threshold")


def audit_sample(unique: DataFrame, size: int, seed: int, salts: int = 32) -> DataFrame:
    """Round-robin over (state, confidence) strata, reproducible, without replacement.

    Order inside a stratum is a seeded hash. A stratum can hold a third of all stores, so
    each of its salted parts first keeps its own first `size`, which is exact.
    """
    state = F.when(F.expr(is_blank("state")), "missing").otherwise(F.col("state"))
    drawn = unique.withColumns(
        {
            "stratum_state": state,
            "stratum_confidence": confidence_band(),
            "_draw": F.md5(F.concat_ws(":", F.lit(str(seed)), "domain_url", "candidate_id")),
        }
    ).withColumn("_salt", F.pmod(F.xxhash64("_draw"), F.lit(salts)))
    stratum = ["stratum_state", "stratum_confidence"]
    part = W.partitionBy(*stratum, "_salt").orderBy("_draw", "candidate_id")
    whole = W.partitionBy(*stratum).orderBy("_draw", "candidate_id")
    kept = drawn.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= size)
    ranked = kept.withColumn("round", F.row_number().over(whole)).where(F.col("round") <= size)
    turn = F.md5(F.concat_ws(":", F.lit(str(seed)), *stratum))
    return ranked.orderBy("round", turn, "_draw").limit(size).drop("_draw", "_salt", "_rn")


# --- rows of the written files --------------------------------------------------------


def sorted_socials(socials: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(socials)))


def export_rows(unique: DataFrame) -> DataFrame:
    """The seven published columns; contacts and socials as JSON with sorted keys."""
    return unique.select(
        "domain_url",
        F.to_json("contacts").alias("contacts"),
        F.to_json(sorted_socials(F.col("socials"))).alias("socials"),
        "category",
        "description",
        "logo_url",
        "state",
    )


def evidence_rows(unique: DataFrame) -> DataFrame:
    """The full record with its columns in key order."""
    named = unique.withColumn("socials", sorted_socials(F.col("socials")))
    return named.select(*sorted(c for c in unique.columns if c != "candidate_id"))


def worksheet_rows(sample: DataFrame) -> DataFrame:
    """Sampled records with empty review columns."""
    published = export_rows(sample).columns
    return sample.select(
        "domain_url",
        F.to_json("contacts").alias("contacts"),
        F.to_json(sorted_socials(F.col("socials"))).alias("socials"),
        *[c for c in published if c not in ("domain_url", "contacts", "socials")],
        F.array_join(F.array_sort("source_names"), ";").alias("source_names"),
        "shopify_score",
        "india_score",
        *[F.lit("").alias(c) for c in fv.REVIEW_COLUMNS],
    )


# --- the report as one document ---------------------------------------------------------


def report_metrics(candidates: DataFrame, stores: DataFrame) -> DataFrame:
    """(section, key, n, low, rows): everything the report counts, from one pass per table.

    Only the columns the report needs are carried into the per-domain pick. The result has
    one row per status, reason, source, state and category, however many stores there are.
    """

    def cells(*rows: tuple[str, str, str]) -> Column:
        structs = ", ".join(
            f"struct('{section}' AS section, {key} AS key, cast({n} AS bigint) AS n)" for section, key, n in rows
        )
        return F.expr(f"explode(array({structs})) AS cell")

    narrow = stores.select(
        "candidate_id", "domain_url", "accepted", "shopify_score", "india_score", "state", "category",
        "rejection_reasons", "source_names",
        *[is_missing(f).cast("int").alias(f"no_{f}") for f in fv.REPORT_FIELDS],
    )
    unique = unique_domains(narrow.drop("rejection_reasons", "source_names"))
    missing = [("missing", f"'{f}'", f"no_{f}") for f in fv.REPORT_FIELDS]
    of_unique = unique.select(
        cells(
            ("unique", "''", "1"),
            ("state", "coalesce(nullif(trim(state), ''), 'missing')", "1"),
            ("category", "coalesce(nullif(trim(category), ''), 'missing')", "1"),
            ("score", "'shopify'", "shopify_score"),
            ("score", "'india'", "india_score"),
            *missing,
        )
    )
    of_all = narrow.select(cells(("record", "''", "cast(accepted AS int)")))
    of_rejected = (
        narrow.where(~F.col("accepted"))
        .select(F.explode("rejection_reasons").alias("reason"))
        .select(cells(("reason", "reason", "1")))
    )
    of_sources = narrow.selectExpr(
        "accepted", "explode(CASE WHEN size(source_names) > 0 THEN source_names ELSE array('unattributed') END) AS source"
    ).select(cells(("source", "source", "cast(accepted AS int)")))
    of_candidates = candidates.select(cells(("status", "status", "1")))
    rows = of_unique
    for part in (of_all, of_rejected, of_sources, of_candidates):
        rows = rows.unionByName(part)
    return rows.groupBy("cell.section", "cell.key").agg(
        F.sum("cell.n").alias("n"), F.min("cell.n").alias("low"), F.count("*").alias("rows")
    )


def quality_report(candidates: DataFrame, stores: DataFrame, worksheet: DataFrame | None = None) -> DataFrame:
    """The whole report as one row of structs and maps."""

    def one(section: str, value: str, key: str | None = None) -> str:
        extra = "" if key is None else f" AND key = '{key}'"
        return f"coalesce(max(CASE WHEN section = '{section}'{extra} THEN {value} END), 0)"

    def mapped(section: str, value: str) -> str:
        entry = f"CASE WHEN section = '{section}' THEN struct(key, {value} AS value) END"
        return f"map_from_entries(array_sort(collect_list({entry})))"

    total = one("unique", "rows")

    def missing(field: str) -> str:
        count = one("missing", "n", field)
        percent = f"CASE WHEN {total} > 0 THEN round({count} * 100 / {total}, 2) ELSE 0.0D END"
        return f"'{field}', named_struct('count', {count}, 'percent', {percent})"

    def average(key: str) -> str:
        return f"round({one('score', 'n / rows', key)}, 2)"

    document = {
        "candidate_status_counts": mapped("status", "n"),
        "processed_records": one("record", "rows"),
        "accepted_records": total,
        "accepted_candidate_records": one("record", "n"),
        "redirect_duplicates_removed": f"{one('record', 'n')} - {total}",
        "rejection_reasons": mapped("reason", "n"),
        "missing_fields": f"map({', '.join(missing(f) for f in fv.REPORT_FIELDS)})",
        "state_distribution": mapped("state", "n"),
        "category_distribution": mapped("category", "n"),
        "source_yield": mapped("source", "named_struct('seen', rows, 'accepted', n)"),
        "confidence": f"""named_struct('average_shopify_score', {average("shopify")}, 'average_india_score', {average("india")},
          'minimum_shopify_score', {one("score", "low", "shopify")}, 'minimum_india_score', {one("score", "low", "india")})""",
    }
    report = report_metrics(candidates, stores).agg(*[F.expr(f"{e} AS {name}") for name, e in document.items()])
    if worksheet is None:
        audit = F.struct(F.lit("not_generated").alias("status"), F.lit(0).alias("reviewed"))
        return report.select(F.current_timestamp().alias("generated_at"), "*", audit.alias("manual_audit"))
    # Both sides are one row: stack and fold them instead of joining.
    accuracy = field_accuracy(worksheet).agg(
        F.expr("map_from_entries(array_sort(collect_list(struct(field, struct(reviewed, accuracy_percent))))) AS field_accuracy")
    )
    precision = audit_precision(worksheet).select(F.struct("*").alias("precision"))
    stacked = report.unionByName(precision, allowMissingColumns=True).unionByName(accuracy, allowMissingColumns=True)
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
    return folded.select(
        F.current_timestamp().alias("generated_at"),
        *report.columns,
        F.struct("precision.*", "field_accuracy").alias("manual_audit"),
    )
