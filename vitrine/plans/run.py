"""Runs over candidates: stop at a target, discover, refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.operators import candidates as cand
from vitrine.operators.skew import SLICE_ROWS, running_total
from vitrine.operators.store_state import domain_key, refresh_outcome, to_revalidate, upsert_latest
from vitrine.plans.verify import recomputed_records, store_records


STEP_BATCHES, STEP_GROWTH = 8, 4  # of a run's first range, and of every further one to the one before


def run_to_target(
    outcomes: DataFrame,
    target: int,
    unique: bool = False,
    max_candidates: int | None = None,
    batch: int = fv.WORK_BATCH,
    order: str = "discovered_seq",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Candidates a run processes before its accepted count reaches `target`.

    Work goes in `order` (numbers from 0 on), in batches, and the target is looked at between batches only.
    With `unique`, a domain counts once, when its first accepted candidate is processed.

    Outcomes are read in ranges of `order` that grow until one holds the answer: the rows read follow the
    answer's size, as files and row groups beyond a range are left out by their statistics.
    """
    upper = batch * STEP_BATCHES
    while True:
        ranked, reached = _ranked(outcomes.where(F.col(order) < upper), unique, batch, order, slice_rows)
        # A batch counts as looked at when all of its rows are in the range.
        rows = ranked.agg(F.max("rank")).first()[0] or 0
        hits = reached.where(F.col("reached") >= target).agg(F.min("batch")).first()[0]
        whole = hits is not None and rows >= (hits + 1) * batch
        enough = max_candidates is not None and rows >= max_candidates
        if whole or enough or outcomes.where(F.col(order) >= upper).isEmpty():
            break
        upper *= STEP_GROWTH
    open_batches = reached.where(F.col("reached") - F.col("n") < target).select("batch")
    if max_candidates is not None:
        ranked = ranked.where(F.col("rank") <= max_candidates)
    return ranked.join(open_batches, "batch", "left_semi")


def _ranked(outcomes: DataFrame, unique: bool, batch: int, order: str, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """(outcomes with rank and batch; per batch its new hits `n` and all until then, `reached`).

    Ranks and running counts are two-level sums, so no task sees the whole range.
    """
    ranked = running_total(outcomes, [order], F.lit(1), F.col(order), "rank", slice_rows)
    ranked = ranked.withColumn("batch", F.floor((F.col("rank") - 1) / batch))
    hits = ranked.where("accepted")
    if unique:
        hits = hits.groupBy(domain_key(F.col("domain_url")).alias("_key")).agg(F.min("batch").alias("batch"))
    per_batch = (
        hits.select("batch", F.lit(1).alias("n"))
        .unionByName(ranked.select("batch", F.lit(0).alias("n")))
        .groupBy("batch")
        .agg(F.sum("n").alias("n"))
    )
    return ranked, running_total(per_batch, ["batch"], F.col("n"), F.col("batch"), "reached", slice_rows)


def discover(
    seeds: DataFrame, existing: DataFrame | None = None, existing_sources: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Seeds → (all candidates, all source triples, counters per source)."""
    new = cand.clean_candidates(seeds, existing)
    everything = new if existing is None else existing.unionByName(new)
    return everything, cand.candidate_sources(seeds, existing_sources), cand.import_counters(seeds, existing)


def refresh_stores(
    selected: DataFrame, pages: DataFrame, errors: DataFrame, images: DataFrame | None = None, checked_at=None
) -> DataFrame:
    """Extract selected stores again from fresh pages, keeping their platform evidence.

    `pages` may hold any stores' pages; those of other stores are left out before the parse.
    """
    return refresh_outcome(selected, recomputed_records(_pages_of(pages, selected), images=images), errors, checked_at)


def _pages_of(pages: DataFrame, chosen: DataFrame) -> DataFrame:
    """The pages of the chosen candidates. Only ids meet the pages; while they are few, no body moves."""
    ids = chosen.select(F.col("candidate_id").alias("store_id")).distinct()
    return pages.join(ids, "store_id", "left_semi")


def revalidate(
    candidates: DataFrame, stores: DataFrame, pages: DataFrame, carts: DataFrame, dns: DataFrame, **options
) -> DataFrame:
    """The store table after every accepted candidate was judged again from its pages.

    Records of other candidates, and of those without a page, stay as they are.
    """
    again = store_records(_pages_of(pages, to_revalidate(candidates)), carts, dns, **options)
    return upsert_latest(stores, again.select(*stores.columns))
