import datetime as dt

import pytest
from conftest import page_row
from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.operators import reports, store_state
from vitrine.plans import run as runs
from vitrine.sources import seeds, sinks

NOW = dt.datetime(2024, 5, 1)


def strong(kind):
    return {"kind": kind, "value": "v", "source_url": "u", "weight": 5, "strength": "strong"}


def store(candidate_id, **extra):
    row = {
        "candidate_id": candidate_id, "domain_url": f"https://s{candidate_id}.in",
        "contacts": {"emails": ["hello@lotus.in"], "phones": ["+919876543210"]},
        "socials": {"instagram": ["https://instagram.com/lotus"]}, "category": "skincare/beauty",
        "description": "Indian skincare", "logo_url": "https://lotus.in/logo.png", "state": "Maharashtra",
        "shopify_score": 7, "india_score": 8, "accepted": True, "rejection_reasons": [],
        "shopify_evidence": [strong("shopify_runtime"), strong("shopify_cart")], "india_evidence": [strong("gstin")],
        "extraction_sources": {}, "redirect_history": [], "checked_at": NOW, "source_names": ["test"], "extraction_version": 1,
    }
    row.update(extra)
    return tuple(row.values())


@pytest.fixture()
def stores(spark):
    return lambda *rows: spark.createDataFrame(list(rows), schemas.STORES)


def test_upsert_keeps_the_last_write(stores):
    later = NOW + dt.timedelta(days=1)
    old = stores(store(1), store(2, checked_at=later))
    new = stores(store(1, state="Goa"), store(2, state="Goa"), store(3))
    merged = {r.candidate_id: r.state for r in store_state.upsert_latest(old, new).collect()}
    assert merged == {1: "Goa", 2: "Maharashtra", 3: "Maharashtra"}


def test_attempt_outcomes(spark):
    rows = [(1, 1, "Timeout", True), (2, 1, "Timeout", True), (2, 2, "Timeout", True), (2, 3, "Timeout", True),
            (3, 1, "ValueError", False), (4, 1, "Timeout", True), (4, 2, None, False), (5, 1, "e" * 2000, True)]
    got = {r.candidate_id: r for r in store_state.attempt_outcome(
        spark.createDataFrame(rows, "candidate_id bigint, attempt int, error string, transient boolean")).collect()}
    assert {k: v.outcome for k, v in got.items()} == {1: "retry", 2: "failed", 3: "failed", 4: "done", 5: "retry"}
    assert len(got[5].last_error) == 2000


def test_selection_modes(spark, stores):
    table = stores(store(1), store(2, extraction_version=2), store(3, accepted=False),
                   store(4, india_evidence=[strong("registered_india")], extraction_version=2))
    ids = lambda df: sorted(r.candidate_id for r in df.collect())
    assert ids(store_state.reextract_selection(table)) == [1]
    assert ids(store_state.reextract_selection(table, force=True)) == [1, 2, 4]
    wanted = spark.createDataFrame([("HTTPS://S3.in/",), ("  ",)], "domain_url string")
    assert ids(store_state.reextract_selection(table, domains=wanted)) == [3]
    assert ids(store_state.reextract_selection(table, single_kind=True)) == [4]
    assert ids(store_state.reextract_selection(table, force=True, limit=2)) == [1, 2]
    with pytest.raises(ValueError):
        store_state.reextract_selection(table, domains=wanted, single_kind=True)


def test_refresh_never_loses_a_record(spark, stores, make_pages):
    good = "GSTIN 24ABCDE1234F1Z5 Rs. 5 only"
    pages = make_pages([
        page_row(1, 0, "https://s1.in/", good), page_row(2, 0, "https://s2.in/", "opening soon"),
        page_row(3, 0, "https://s3.in/", "nothing"), page_row(4, 0, "https://s4.in/", good),
    ])
    errors = spark.createDataFrame([(4, "CERTIFICATE_VERIFY_FAILED x"), (5, "Timeout")], "candidate_id bigint, error string")
    table = stores(*[store(n) for n in (1, 2, 3, 4, 5, 6)])
    refreshed = runs.refresh_stores(table, pages, errors)
    got = {r.candidate_id: r for r in refreshed.collect()}
    assert {k: r.outcome for k, r in got.items()} == {
        1: "refreshed", 2: "rejected_home", 3: "refreshed", 4: "rejected_tls", 5: "kept_old", 6: "kept_old"}
    assert got[1].accepted and got[1].state == "Gujarat" and got[1].shopify_score == 7 and got[1].extraction_version == 2
    assert not got[2].accepted and got[2].rejection_reasons == ["password_protected"] and got[2].state == "Maharashtra"
    assert not got[3].accepted and got[3].rejection_reasons == ["insufficient_india_evidence"]
    assert got[4].rejection_reasons == ["tls_certificate_invalid"] and got[4].description == "Indian skincare"
    assert got[5].accepted and got[5].extraction_version == 1 and got[5].checked_at == NOW
    counters = store_state.refresh_counters(refreshed).first()
    assert tuple(counters) == (6, 4, 2, 3)
    assert {r.error for r in store_state.refresh_errors(refreshed).collect()} == {"Timeout", "page missing"}


def test_run_stops_between_batches(spark):
    import random
    rng = random.Random(1)
    rows = [(n, rng.random() < 0.4, f"https://d{rng.randrange(60)}.in") for n in range(500)]
    df = spark.createDataFrame(rows, "discovered_seq bigint, accepted boolean, domain_url string")
    for unique in (False, True):
        for target in (1, 7, 20, 45, 1000):
            for most in (None, 90):
                done, seen = 0, set()
                for at in range(0, len(rows), 16):
                    if (len(seen) if unique else sum(a for _, a, _ in rows[:done])) >= target:
                        break
                    part = rows[at : at + 16] if most is None else rows[at : min(at + 16, most)]
                    if not part:
                        break
                    done = at + len(part)
                    seen |= {d for _, a, d in part if a}
                got = runs.run_to_target(df, target, unique=unique, max_candidates=most, batch=16, slice_rows=37)
                assert got.count() == done, (unique, target, most)


def test_a_run_reads_no_further_than_its_answer(spark, tmp_path):
    path = str(tmp_path / "outcomes")
    rows = spark.range(20_000).selectExpr("id AS candidate_id", "id AS discovered_seq", "id % 2 = 0 AS accepted", "concat('https://s', id, '.in') AS domain_url")
    rows.repartitionByRange(20, "discovered_seq").write.parquet(path)
    late = spark.read.parquet(path).where("discovered_seq >= 6000").count()
    bad = spark.read.parquet(path).withColumn("accepted", F.expr("CASE WHEN discovered_seq < 12000 THEN accepted ELSE cast(raise_error('read too far') AS boolean) END"))
    got = runs.run_to_target(bad, 500, batch=40)
    assert late == 14_000 and got.count() == 1000
    assert runs.run_to_target(spark.read.parquet(path), 10**9, batch=40).count() == 20_000


def test_a_small_batch_writes_its_own_records(spark, stores, tmp_path):
    state = sinks.StoreSnapshots(spark, str(tmp_path / "state"), slice_rows=400, most_deltas=3)
    state.commit(stores(*[store(n) for n in range(2000)]), 0)
    assert state.compact(force=True)
    base, _ = state.entries()
    assert len(base) == 5 and sum(r.n_rows for r in base) == 2000
    assert all(a.high < b.low for a, b in zip(sorted(base, key=lambda r: r.low), sorted(base, key=lambda r: r.low)[1:]))
    later = NOW + dt.timedelta(1)
    state.commit(stores(*[store(n, state="Goa", checked_at=later) for n in range(50)], store(60, state="Goa", checked_at=NOW - dt.timedelta(1))), 1)
    again, deltas = state.entries()
    assert [r.path for r in again] == [r.path for r in base] and [r.n_rows for r in deltas] == [50]  # a late record is not written
    found = {r.candidate_id: r.state for r in state.read().collect()}
    assert len(found) == 2000 and {n for n, s in found.items() if s == "Goa"} == set(range(50))
    few = spark.createDataFrame([(7,), (1999,), (5000,)], "candidate_id bigint")
    assert {r.candidate_id: r.state for r in state.read(few).collect()} == {7: "Goa", 1999: "Maharashtra"}
    # Only files whose keys can hold them are opened.
    assert len(state._holding(again, few)) == 2
    for n in range(2, 5):
        state.commit(stores(store(3000 + n), store(7, state=f"s{n}", checked_at=later)), n)
    again, deltas = state.entries()
    assert [r.path for r in again] == [r.path for r in base] and [r.n_rows for r in deltas] == [50 + 3]  # deltas merged, base untouched
    assert {r.candidate_id: r.state for r in state.read().where("candidate_id in (7, 8, 3004)").collect()} == {7: "s4", 8: "Goa", 3004: "Maharashtra"}
    state.commit(stores(*[store(n, state="Kerala", checked_at=later) for n in range(1000, 1700)]), 9)
    state.compact(force=True)
    base, deltas = state.entries()
    assert not deltas and sum(r.n_rows for r in base) == 2003 and state.knows(9) and state.knows(1)
    assert state.read().where("state = 'Kerala'").count() == 700


def candidates(spark, *rows):
    return spark.createDataFrame([(n, f"k{n}", "d", s, 0, n, None) for n, s in rows], schemas.CANDIDATES)


def test_outputs_share_one_set_of_domains(spark, stores, tmp_path):
    table = stores(
        store(1, domain_url="https://lotus.in", shopify_score=8), store(2, domain_url="https://Lotus.in/", shopify_score=9),
        store(3, accepted=False, rejection_reasons=["robots_disallowed"], source_names=[]))
    csv_path, evidence_path = sinks.export_results(table, str(tmp_path))
    exported = seeds.read_worksheet(spark, csv_path)
    header = spark.read.text(csv_path).first()[0]
    assert header == "domain_url,contacts,socials,category,description,logo_url,state"
    assert [r.domain_url for r in exported.collect()] == ["https://Lotus.in/"]
    assert exported.first().contacts == '{"emails":["hello@lotus.in"],"phones":["+919876543210"]}'
    evidence = spark.read.json(evidence_path)
    assert evidence.count() == 1 and evidence.columns == sorted(evidence.columns) and evidence.first().accepted is True
    sheet = sinks.write_audit_sample(table, str(tmp_path), 100, 1)
    rows = seeds.read_worksheet(spark, sheet).collect()
    assert len(rows) == 1 and rows[0].source_names == "test" and rows[0].shopify_correct == "" and len(rows[0]) == 20
    report_path = sinks.write_report(candidates(spark, (1, "accepted"), (2, "accepted"), (3, "rejected")), table, str(tmp_path))
    report = spark.read.json(report_path).first()
    assert (report.accepted_records, report.accepted_candidate_records, report.redirect_duplicates_removed) == (1, 2, 1)
    assert report.processed_records == 3 and report.rejection_reasons.robots_disallowed == 1
    assert report.source_yield.test.seen == 2 and report.source_yield.unattributed.seen == 1
    assert report.candidate_status_counts.accepted == 2 and report.manual_audit.status == "not_generated"


def test_every_export_writes_the_stores_it_is_given(spark, stores, tmp_path):
    (tmp_path / "unique_domains").mkdir()  # an interrupted write
    for names in (["https://lotus.in"], ["https://lotus.in", "https://rose.in"], ["https://tulip.in"]):
        table = stores(*[store(n, domain_url=name) for n, name in enumerate(names)])
        csv_path, evidence_path = sinks.export_results(table, str(tmp_path))
        sheet = sinks.write_audit_sample(table, str(tmp_path), 100, 1)
        for written in (seeds.read_worksheet(spark, csv_path), spark.read.json(evidence_path), seeds.read_worksheet(spark, sheet)):
            assert sorted(r.domain_url for r in written.select("domain_url").collect()) == names
    unique = sinks.unique_stores(table, str(tmp_path))
    assert sinks.export_results(table, str(tmp_path), unique) == (csv_path, evidence_path)
    assert sinks.write_audit_sample(table, str(tmp_path), 100, 1, unique) == sheet


def test_empty_report(spark, stores):
    row = reports.quality_report(candidates(spark), stores(), spark.createDataFrame([], sheet_schema())).first()
    assert row.accepted_records == 0 and row.confidence.average_shopify_score == 0 and row.missing_fields["state"].percent == 0
    assert row.manual_audit.status == "not_reviewed" and row.manual_audit.field_accuracy == {}


def sheet_schema():
    return ", ".join(f"{c} string" for c in seeds.AUDIT_COLUMNS)


def test_precision_states(spark):
    def precision(*judged):
        blank = {c: "" for c in seeds.AUDIT_COLUMNS}
        rows = [tuple({**blank, "shopify_correct": a, "india_correct": b}.values()) for a, b in judged]
        return reports.audit_precision(spark.createDataFrame(rows, sheet_schema())).first()

    assert precision(("yes", "")).status == "not_reviewed"
    mixed = precision(("yes", "Y"), (" 1 ", "no"), ("", "yes"))
    assert (mixed.status, mixed.reviewed, mixed.shopify_precision_percent, mixed.india_precision_percent) == ("fail", 2, 100.0, 50.0)
    assert precision(*[("true", "y")] * 20).status == "pass"
    assert precision(*[("true", "y")] * 19, ("no", "y")).status == "pass"


def test_sample_is_round_robin_and_reproducible(spark, stores):
    rows = [store(n, state=("Goa" if n % 10 == 0 else "Kerala" if n % 10 == 1 else "Gujarat"), shopify_score=5 + n % 2 * 6, domain_url=f"https://s{n}.in") for n in range(300)]
    table = stores(*rows)
    sample = reports.audit_sample(table, 40, 7)
    picked = [r.candidate_id for r in sample.collect()]
    assert len(picked) == len(set(picked)) == 40
    assert picked == [r.candidate_id for r in reports.audit_sample(table.repartition(7), 40, 7, salts=5).collect()]
    assert picked != [r.candidate_id for r in reports.audit_sample(table, 40, 8).collect()]
    counts = {tuple(r)[:2]: r["count"] for r in sample.groupBy("stratum_state", "stratum_confidence").count().collect()}
    assert len(counts) == 4 and max(counts.values()) - min(counts.values()) <= 1
    everything = reports.audit_sample(table, 1000, 7)
    assert everything.count() == 300


def test_snapshots(spark, stores, tmp_path):
    state = sinks.StoreSnapshots(spark, str(tmp_path / "state"))
    assert state.read().count() == 0
    assert state.commit(stores(store(1), store(2)), 0) == 1
    assert state.commit(stores(store(1, state="Goa", checked_at=NOW + dt.timedelta(1))), 1) == 2
    assert state.commit(stores(store(9)), 1) == 2  # the batch is known
    assert {r.candidate_id: r.state for r in state.read().collect()} == {1: "Goa", 2: "Maharashtra"}


def test_status_is_derived(spark, stores):
    table = candidates(spark, (1, "pending"), (2, "pending"), (3, "pending"), (4, "retry"))
    attempts = spark.createDataFrame([(3, 3, "failed", "boom")], "candidate_id bigint, attempts bigint, outcome string, last_error string")
    got = store_state.candidate_status(table, stores(store(1), store(2, accepted=False)), attempts)
    assert {r.candidate_id: (r.status, r.last_error) for r in got.collect()} == {
        1: ("accepted", None), 2: ("rejected", None), 3: ("failed", "boom"), 4: ("retry", None)}
    assert store_state.by_confidence(stores(store(1), store(2, india_score=99), store(3, accepted=False))).select(F.collect_list("candidate_id")).first()[0] == [2, 1]
