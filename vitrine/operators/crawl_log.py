"""Crawl rules checked on the crawl's own tables: retries, pacing, robots, reuse, captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions import urls
from vitrine.operators.skew import hot_key_join, previous_row, running_total


def _seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


# --- content ----------------------------------------------------------------------


def crawl_content(pages: DataFrame, body_bytes: int | None = None, entry_bytes: int | None = None) -> DataFrame:
    """Hashes and size rules per response: content hash, cache key, and whether it fits a cache.

    `body_bytes` and `entry_bytes` are the sizes a crawler allows a body and a cache entry; without them
    no body is too large. Nothing is cut either way.
    """
    size = F.octet_length("body")
    fits = F.col("body").isNotNull() if entry_bytes is None else size <= entry_bytes
    return pages.select(
        "store_id",
        "page_seq",
        F.sha2(F.col("requested_url"), 256).alias("cache_key"),
        F.sha2(F.col("body"), 256).alias("content_hash"),
        size.alias("n_bytes"),
        (F.lit(False) if body_bytes is None else size > body_bytes).alias("is_capped"),
        (fits & (F.col("status_code") < 400)).alias("is_cacheable"),
    )


def duplicate_content(content: DataFrame) -> DataFrame:
    """Groups of responses with equal content: their size and first page."""
    return (
        content.groupBy("content_hash")
        .agg(F.count("*").alias("copies"), F.min(F.struct("store_id", "page_seq")).alias("first"))
        .select("content_hash", "copies", F.col("first.store_id").alias("store_id"), F.col("first.page_seq").alias("page_seq"))
    )


def reusable(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Wanted URLs that have a cached response."""
    return wanted.join(cache.select("cache_key"), F.sha2(wanted["url"], 256) == cache["cache_key"], "left_semi")


def still_to_fetch(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    return wanted.join(cache.select("cache_key"), F.sha2(wanted["url"], 256) == cache["cache_key"], "left_anti")


# --- retries -------------------------------------------------------------------------


def is_transient() -> Column:
    return F.coalesce(F.col("status_code").isin(*fv.RETRY_STATUS_CODES), F.lit(False)) | F.col("error").isNotNull()


def expected_delay() -> Column:
    """Seconds to wait after an attempt: a numeric Retry-After, else 2^attempt, at most 30."""
    told = F.when(F.col("retry_after").rlike("^[0-9]+$"), F.col("retry_after").try_cast("double"))
    told = F.when(F.col("error").isNull(), told)
    return F.least(F.coalesce(told, F.pow(F.lit(2.0), "attempt")), F.lit(float(fv.MAX_BACKOFF_SECONDS)))


def retry_log(log: DataFrame) -> DataFrame:
    """Per attempt: whether a retry must follow, the wait it owes, and how the fetch ends."""
    retried = is_transient() & (F.col("attempt") < fv.MAX_RETRIES)
    outcome = F.when(retried, "retry").when(F.col("error").isNotNull(), "error").otherwise("page")
    return log.withColumns({"outcome": outcome, "expected_delay": F.when(retried, expected_delay())})


def retry_delays(log: DataFrame) -> DataFrame:
    """Per retry: the wait its predecessor asked for and the wait that was kept."""
    rated = retry_log(log)
    paired = previous_row(
        rated, ["host", "url"], ["start_ts", "attempt"], ["end_ts", "outcome", "expected_delay"], F.unix_micros("start_ts")
    )
    return paired.where("prev_outcome = 'retry'").select(
        "host",
        "url",
        "attempt",
        "start_ts",
        F.col("prev_expected_delay").alias("expected_delay"),
        _seconds(F.col("start_ts"), F.col("prev_end_ts")).alias("observed_delay"),
    )


# --- pacing --------------------------------------------------------------------------


def politeness_gaps(log: DataFrame) -> DataFrame:
    """Per request: time since the host's previous request ended, and rule breaches."""
    paired = previous_row(log, ["host"], ["start_ts", "url", "attempt"], ["end_ts"], F.unix_micros("start_ts"))
    gap = _seconds(F.col("start_ts"), F.col("prev_end_ts"))
    return paired.withColumn("gap", gap).select(
        "host",
        "url",
        "attempt",
        "start_ts",
        "gap",
        F.coalesce(gap < fv.POLITENESS_SECONDS, F.lit(False)).alias("too_soon"),
        F.coalesce(gap < 0, F.lit(False)).alias("overlaps"),
    )


def in_flight(log: DataFrame, limit: int = fv.GLOBAL_CONCURRENCY) -> DataFrame:
    """Requests open at every moment one starts or ends, and whether they exceed the limit."""
    steps = log.select(
        F.explode(
            F.array(
                F.struct(F.col("start_ts").alias("ts"), F.lit(1).alias("step")),
                F.struct(F.col("end_ts").alias("ts"), F.lit(-1).alias("step")),
            )
        ).alias("s")
    ).select("s.*")
    # Equal moments are one row, so the running sum has no ties.
    moments = steps.groupBy("ts").agg(F.sum("step").alias("step"))
    running = running_total(moments, ["ts"], F.col("step"), F.unix_micros("ts"), "open_requests")
    return running.select("ts", "open_requests", (F.col("open_requests") > limit).alias("over_limit"))


# --- robots --------------------------------------------------------------------------


def host_rules(rules: DataFrame, agent: str) -> DataFrame:
    """(host, path, rule_order, allow) of the agent's own group, else of `*`; a path once, with its first rule."""
    mine = (F.col("agent") != "*") & F.lit(agent.lower()).contains(F.lower("agent"))
    asked = rules.withColumn("_mine", mine).where(F.col("_mine") | (F.col("agent") == "*"))
    named = asked.groupBy("host").agg(F.max("_mine").alias("_named"))
    own = asked.join(named, "host").where(F.col("_mine") == F.col("_named"))
    # Order and answer as one number: the first rule's is the smallest.
    first = own.groupBy("host", "path").agg(F.min(F.col("rule_order").cast("bigint") * 2 + F.col("allow").cast("bigint")).alias("rule"))
    return first


def robots_verdict(wanted: DataFrame, rules: DataFrame, agent: str, robots_status: DataFrame | None = None) -> DataFrame:
    """Verdict per URL: the first rule whose path starts the URL's path; none means allowed.

    A URL's path is looked up by its beginnings, of the lengths that its host's rules have, so a host's rules are
    never held together and never tried one by one, however many they are; a host with very many URLs is
    split over several tasks. A robots file that failed allows everything.
    """
    first = host_rules(rules, agent)
    if robots_status is not None:
        broken = robots_status.where(F.coalesce(F.col("status_code"), F.lit(599)) >= 400)
        first = first.join(broken.select("host"), "host", "left_anti")
    lengths = first.groupBy("host").agg(F.collect_set(F.length("path")).alias("_lengths"))
    host = F.expr(urls.hostname("lower(url)"))
    asked = wanted.select("url").distinct().withColumns(
        {"host": host, "_path": F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]*([^#]*)", 1)}
    ).withColumn("_path", F.when(F.col("_path") == "", "/").otherwise(F.col("_path")))
    sized = hot_key_join(asked, lengths, "host", F.col("url"), "inner")
    starts = F.transform(F.filter("_lengths", lambda n: n <= F.length("_path")), lambda n: F.left(F.col("_path"), n))
    tried = sized.select("url", "host", F.explode(F.array_union(starts, F.array(F.lit("*")))).alias("path"))
    hits = hot_key_join(tried, first, ["host", "path"], F.col("url"), "inner")
    # An empty Disallow forbids nothing.
    rule = F.when(F.col("path") == "", F.col("rule") - F.col("rule") % 2 + 1).otherwise(F.col("rule"))
    verdict = hits.groupBy("url").agg((F.min(rule) % 2 == 1).alias("_allowed"))
    told = wanted.join(verdict, "url", "left")
    return told.select(*wanted.columns, host.alias("host"), F.coalesce("_allowed", F.lit(True)).alias("robots_allowed"))


# --- archive captures --------------------------------------------------------------------


def collapse_captures(captures: DataFrame) -> DataFrame:
    """Successful captures, consecutive equal digests of a URL reduced to the first."""
    good = captures.where(F.col("status") == "200")
    # Times are strings of digits, of any length; other strings come first.
    moment = F.coalesce(F.when(F.col("ts").rlike("^[0-9]+$"), F.rpad(F.left("ts", F.lit(14)), 14, "0").try_cast("bigint")), F.lit(0))
    paired = previous_row(good.withColumn("_moment", moment), ["url"], ["_moment", "ts", "digest"], ["digest"], F.col("_moment"))
    return paired.where(~F.coalesce(F.col("prev_digest") == F.col("digest"), F.lit(False))).drop("prev_digest", "_moment")
