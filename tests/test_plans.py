"""What the physical plans must and must not hold."""

import datetime as dt
import re

import pytest
from conftest import page_row
from pyspark.sql import functions as F

from checks.queries import QUERIES, SQL
from vitrine.plans import verify

SF = "/root/testdata/sf0.001"
HEAVY = (
    "verify_stores", "store_records", "contacts_by_store", "category_points", "candidate_import", "registrable_domain",
    "unique_domains", "quality_report", "audit_sample", "refresh_outcome", "run_to_unique_target", "politeness_gaps",
    "in_flight", "robots_verdict", "capture_collapse", "ranked_links", "platform_evidence", "upsert_latest",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["verify_stores", "store_records", "contacts_by_store", "refresh_outcome"])
def test_bodies_are_parsed_once_and_never_shuffled(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("MapInArrow") == 1
    after_parse = text.split("MapInArrow")[0]
    assert "body#" not in after_parse
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", after_parse)
    assert keys and any(k.startswith("store_id") and "value" in k for k in keys)  # reduced by value first
    assert "partial_min" in text  # before the shuffle


def test_scores_are_reduced_by_hash(spark):
    """Signal rows of a verdict are not sorted; the few reduced rows of a store may be, for its home page's addresses."""
    for name in ("verify_stores", "state_resolution", "evidence_scores"):
        text = plan(QUERIES[name](spark, SF))
        assert re.search(r"HashAggregate\(keys?=\[store_id#\w+, family", text) and not re.search(r"SortAggregate\(keys?=\[store_id#\w+, family", text)


def test_links_are_ranked_without_a_shuffle(spark):
    text = plan(QUERIES["ranked_links"](spark, SF)).split("MapInArrow")[0]
    assert "Exchange" not in text and "Window" not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["url_normalize"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text
    text = plan(QUERIES["to_revalidate"](spark, SF))
    assert "c_mktsegment" not in text


@pytest.mark.parametrize("name", ["verify_stores", "platform_evidence", "candidate_import", "state_resolution", "ranked_links", "capture_collapse", "unique_domains", "phones_in"])
def test_answers_equal_sql(spark, name):
    from checks.compare import compare, connect

    assert name in SQL
    status, note = compare(spark, connect(SF), name, SF)
    assert status == "ok", note


def test_records_are_checked_at_one_moment(spark, make_pages, no_hosts):
    pages = make_pages([page_row(n, 0, f"https://s{n}.in/", "<title>t</title>") for n in range(20)])
    before = dt.datetime.now(dt.timezone.utc)
    now = verify.store_records(pages.repartition(4), *no_hosts).select(F.unix_micros("checked_at").alias("us")).collect()
    after = dt.datetime.now(dt.timezone.utc)
    assert len(now) == 20 and len({r.us for r in now}) == 1
    assert before.timestamp() - 1 <= now[0].us / 1e6 <= after.timestamp() + 1
    then = verify.store_records(pages, *no_hosts, checked_at=F.expr("timestamp '2024-02-01 00:00:00'")).select("checked_at").distinct().collect()
    assert [r.checked_at for r in then] == [dt.datetime(2024, 2, 1)]
