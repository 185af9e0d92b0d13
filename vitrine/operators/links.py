"""Which secondary pages of a store to look at, ranked on the home page's own row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions import urls
from vitrine.functions.text import keep, let, literal
from vitrine.operators import elements as el


def link_score(label: str) -> str:
    """Sum of the scores of all link words the label contains."""
    return " + ".join(
        f"CASE WHEN contains({label}, {literal(word)}) THEN {points} ELSE 0 END"
        for word, points in fv.LINK_WORD_SCORES.items()
    )


def ranked_links(facts: DataFrame, limit: int = fv.LINK_LIMIT_VERIFY, key: str = "store_id") -> DataFrame:
    """The links worth fetching per home page, in rank order, then default paths for missing roles.

    A page's links fit its row, so scoring, first-occurrence dedupe, role caps and the
    overall cap are array expressions: the job is narrow, whatever the number of pages.
    """
    return el.rows_of(selected_links(facts, limit, key), (key,), "selected", "link", "pos").selectExpr(
        key, "pos + 1 AS rank", "link.url", "link.role", "link.score", "link.score = 0 AS is_default"
    )


def selected_links(facts: DataFrame, limit: int, key: str = "store_id") -> DataFrame:
    label = f"lower(concat({el.text_of('e')}, ' ', {el.attr('e', 'href')}))"
    scored = (
        f"filter(transform({el.ANCHORS}, (e, i) -> named_struct('score', {let(label, link_score)}, "
        f"'href', {el.attr('e', 'href')}, 'pos', i)), a -> a.score > 0)"
    )
    work = facts.selectExpr(key, "url", f"{scored} AS scored").withColumns(
        {"home": urls.normalize_url("url"), "targets": urls.normalize_urls("transform(scored, a -> a.href)", "url")}
    )
    # Sorted by URL and position, the first of equal URLs is its first occurrence.
    same_host = f"u.url <> '' AND {urls.hostname('u.url')} = {urls.hostname('home')}"
    work = work.selectExpr(
        key,
        "home",
        "array_sort(filter(zip_with(targets, scored, (t, a) -> "
        f"named_struct('url', t, 'pos', a.pos, 'score', a.score)), u -> {same_host})) AS by_url",
    )
    ranked = (
        "array_sort(transform(filter(by_url, (a, i) -> i = 0 OR by_url[i - 1].url <> a.url), a -> named_struct("
        f"'neg_score', -a.score, 'chars', length(a.url), 'pos', a.pos, 'url', a.url, 'role', {urls.page_role('a.url')})))"
    )
    capped = ", ".join(
        f"slice(filter(ranked, a -> a.role = '{role}'), 1, {cap})" for role, cap in fv.LINK_ROLE_CAPS.items() if cap
    )
    defaults = ", ".join(
        f"named_struct('url', concat({urls.origin('home')}, '{path}'), 'role', '{role}', 'score', 0)"
        for role, path in fv.DEFAULT_ROLE_PATHS
    )
    missing = keep(
        f"array({defaults})",
        lambda d: f"home <> '' AND NOT exists(chosen, c -> c.role = {d}.role) "
        f"AND NOT exists(ranked, r -> r.url = {d}.url)",
    )
    return (
        work.selectExpr(key, "home", f"{ranked} AS ranked")
        .withColumn("chosen", F.expr(f"slice(array_sort(concat({capped})), 1, {limit})"))
        .selectExpr(
            key,
            "concat(transform(chosen, c -> named_struct('url', c.url, 'role', c.role, 'score', -c.neg_score)), "
            f"slice({missing}, 1, {limit} - size(chosen))) AS selected",
        )
    )
