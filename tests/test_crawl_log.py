import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.operators import crawl_log
from vitrine.operators.skew import hot_key_join, previous_row, running_total, sliced

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_previous_row_with_one_hot_key(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(9)}", n, rng.randrange(10**6)) for n in rng.sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    for most in (7, 100, 100000):
        got = {(r.k, r.t): r.prev_v for r in previous_row(df, ["k"], ["t"], ["v"], F.col("t"), slice_rows=most).collect()}
        last, expected = {}, {}
        for k, t, v in sorted(rows, key=lambda r: r[1]):
            expected[(k, t)] = last.get(k)
            last[k] = v
        assert got == expected


def test_slices_follow_the_rows_however_they_lie(spark):
    """A third of all rows in one minute of one host."""
    rows = [("hot", 10**6 + n) for n in range(2000)] + [("hot", n * 10**7) for n in range(500)] + [(f"k{n % 900}", n) for n in range(3500)]
    df = spark.createDataFrame(rows, "k string, t long").repartition(7)
    got = sliced(df, ["k"], F.col("t"), slice_rows=100)
    sizes = got.groupBy("k", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 200 and len({r._slice for r in sizes if r.k == "hot"}) >= 20
    ends = got.groupBy("k", "_slice").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("k = 'hot'").orderBy("_slice").collect()
    assert all(a.high < b.low for a, b in zip(ends, ends[1:]))


def test_running_total(spark):
    rng = random.Random(4)
    rows = [(n, rng.randrange(-3, 9)) for n in rng.sample(range(3000), 700)]
    df = spark.createDataFrame(rows, "t int, v int").repartition(6)
    got = {r.t: r.total for r in running_total(df, ["t"], F.col("v"), F.col("t"), "total", slice_rows=50).collect()}
    total, expected = 0, {}
    for t, v in sorted(rows):
        total += v
        expected[t] = total
    assert got == expected


def test_hot_key_join_equals_a_plain_join(spark):
    many = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"))
    one = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    got = sorted(map(tuple, hot_key_join(many, one, "k", F.col("id")).select("id", "k", "v").collect()), key=lambda r: r[0])
    assert got == sorted(map(tuple, many.join(one, "k", "left").select("id", "k", "v").collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        ("a.in", "https://a.in/", 0, at(0), at(1), 503, "7", None), ("a.in", "https://a.in/", 1, at(9), at(10), 429, "soon", None),
        ("a.in", "https://a.in/", 2, at(11), at(12), 503, None, None), ("a.in", "https://a.in/x", 0, at(12.5), at(13), 200, None, None),
        ("b.in", "https://b.in/", 0, at(3600 * 5), at(3600 * 5 + 2), None, "9", "Timeout"), ("b.in", "https://b.in/", 1, at(3600 * 5 + 1), at(3600 * 5 + 3), 404, None, None),
        ("b.in", "https://b.in/y", 0, at(3600 * 9), at(3600 * 9 + 1), 500, "99", None), ("c.in", "https://c.in/", 2, at(3), at(4), None, None, "Reset"),
    ]
    return spark.createDataFrame(rows, schemas.FETCH_LOG)


def test_retry_rules(log):
    got = {(r.url, r.attempt): (r.outcome, r.expected_delay) for r in crawl_log.retry_log(log).collect()}
    assert got[("https://a.in/", 0)] == ("retry", 7.0)
    assert got[("https://a.in/", 1)] == ("retry", 2.0)  # a wait that is no number falls back to 2^attempt
    assert got[("https://a.in/", 2)] == ("page", None)  # the last 5xx is returned as a page
    assert got[("https://b.in/", 0)] == ("retry", 1.0)
    assert got[("https://b.in/y", 0)] == ("retry", 30.0)
    assert got[("https://c.in/", 2)] == ("error", None)
    delays = {(r.url, r.attempt): (r.expected_delay, r.observed_delay) for r in crawl_log.retry_delays(log).collect()}
    assert delays == {("https://a.in/", 1): (7.0, 8.0), ("https://a.in/", 2): (2.0, 1.0), ("https://b.in/", 1): (1.0, -1.0)}


def test_pacing(log):
    gaps = {(r.url, r.attempt): (r.gap, r.too_soon, r.overlaps) for r in crawl_log.politeness_gaps(log).collect()}
    assert gaps[("https://a.in/", 0)] == (None, False, False)
    assert gaps[("https://a.in/x", 0)] == (0.5, True, False)
    assert gaps[("https://b.in/", 1)] == (-1.0, True, True)
    assert gaps[("https://b.in/y", 0)] == (3600 * 4 - 3, False, False)
    busy = {r.ts: (r.open_requests, r.over_limit) for r in crawl_log.in_flight(log, limit=1).collect()}
    assert busy[at(3600 * 5 + 1)] == (2, True) and busy[at(3600 * 5 + 3)] == (0, False) and busy[at(1)] == (0, False)


def test_robots(spark):
    rules = [("a.in", "*", 1, "/private", False), ("a.in", "*", 2, "/private/open", True), ("a.in", "AuditBot", 1, "/", False),
             ("b.in", "*", 1, "", False), ("b.in", "*", 2, "/x", False), ("c.in", "*", 1, "*", False), ("d.in", "*", 1, "/", False), ("e.in", "Other", 1, "/", False)]
    rules = spark.createDataFrame(rules, schemas.ROBOTS_RULES)
    wanted = spark.createDataFrame([(u,) for u in (
        "https://a.in/private/open", "https://a.in/ok", "https://A.in/private?x=1", "https://b.in/x", "https://c.in", "https://d.in/", "https://e.in/", "https://none.in/")], "url string")
    status = spark.createDataFrame([("d.in", 404)], "host string, status_code int")
    got = {r.url: r.robots_allowed for r in crawl_log.robots_verdict(wanted, rules, "StoreBot/1", status).collect()}
    assert got == {"https://a.in/private/open": False, "https://a.in/ok": True, "https://A.in/private?x=1": False, "https://b.in/x": True,
                   "https://c.in": False, "https://d.in/": True, "https://e.in/": True, "https://none.in/": True}
    named = {r.url: r.robots_allowed for r in crawl_log.robots_verdict(wanted, rules, "x auditbot/2").collect()}
    assert named["https://a.in/ok"] is False and named["https://b.in/x"] is True


def test_a_host_with_very_many_rules(spark):
    rules = spark.range(100_000).selectExpr("'a.in' AS host", "'*' AS agent", "cast(id AS int) AS rule_order", "concat('/p', id) AS path", "id % 2 = 0 AS allow")
    wanted = spark.createDataFrame([(f"https://a.in{p}",) for p in ("/p7", "/p70000/x", "/p99999", "/p8", "/q", "")] * 2, "url string")
    got = [(r.url[12:], r.robots_allowed) for r in crawl_log.robots_verdict(wanted, rules, "bot").collect()]
    # The first rule in order counts: /p7 comes before /p70000, which allows.
    assert sorted(got) == sorted([("/p7", False), ("/p70000/x", False), ("/p99999", False), ("/p8", True), ("/q", True), ("", True)] * 2)


def test_captures_and_content(spark):
    rows = [("u", "20240101", "200", "A"), ("u", "20240102", "404", "B"), ("u", "20240103", "200", "A"), ("u", "20240201", "200", "A"),
            ("u", "20240202", "200", "B"), ("u", "20240301", "200", "A"), ("v", "20240101", "200", "A")]
    got = crawl_log.collapse_captures(spark.createDataFrame(rows, schemas.CAPTURES)).collect()
    assert sorted((r.url, r.ts) for r in got) == [("u", "20240101"), ("u", "20240202"), ("u", "20240301"), ("v", "20240101")]
    pages = spark.createDataFrame([(1, 0, "https://a.in/", "x" * 131073, 200), (2, 0, "https://b.in/", "ß", 200), (3, 0, "https://c.in/", "ß", 404), (4, 0, "https://d.in/", "é" * 3_000_000, 200)],
                                  "store_id bigint, page_seq int, requested_url string, body string, status_code int")
    content = {r.store_id: r for r in crawl_log.crawl_content(pages, body_bytes=5 << 20, entry_bytes=128 << 10).collect()}
    assert [content[n].is_cacheable for n in (1, 2, 3, 4)] == [False, True, False, False] and content[4].is_capped
    whole = {r.store_id: r for r in crawl_log.crawl_content(pages).collect()}
    assert [whole[n].is_cacheable for n in (1, 2, 3, 4)] == [True, True, False, True] and not whole[4].is_capped
    wanted = pages.select(F.col("requested_url").alias("url"))
    cache = crawl_log.crawl_content(pages, entry_bytes=128 << 10).where("is_cacheable")
    assert [r.url for r in crawl_log.reusable(wanted, cache).collect()] == ["https://b.in/"]
    assert crawl_log.still_to_fetch(wanted, cache).count() == 3
    twins = {r.copies for r in crawl_log.duplicate_content(crawl_log.crawl_content(pages)).collect()}
    assert twins == {1, 2}
