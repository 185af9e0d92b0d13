"""Store-level roll-up: scores, state, verdict and the seven fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions import text, urls
from vitrine.functions.text import each, keep, let, literal, lookup_number
from vitrine.operators import signals
from vitrine.operators.elements import rows_of


def _all(named: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(expression) for name, expression in named.items()}


def store_heads(rolled: DataFrame) -> DataFrame:
    """Opens the home page's struct and adds the store's final origin."""
    opened = rolled.select("*", "head.*").drop("head").where("home_url IS NOT NULL")
    arrived = "home_url <> '' AND coalesce(home_reason, '') <> 'robots_disallowed'"
    normal = urls.normalize_url(f"CASE WHEN {arrived} THEN home_url ELSE requested_url END")
    return opened.withColumn("_normal", normal).selectExpr(
        *opened.columns, f"{urls.origin('_normal')} AS domain_url"
    )


# --- facts that arrive per host ------------------------------------------------

CART_OK = """coalesce(status_code < 400 AND contains(lower(content_type), 'json')
  AND array_contains(json_object_keys(body), 'items') AND array_contains(json_object_keys(body), 'item_count'), false)"""


def host_facts(carts: DataFrame, dns: DataFrame) -> DataFrame:
    """One row per host: does its cart have the platform's shape, does its name point there?"""
    points = f"endswith(rtrim('.', lower(cname)), '{fv.PLATFORM_DNS_SUFFIX}')"
    return (
        carts.selectExpr("host", f"{CART_OK} AS cart_ok", "cast(NULL AS string) AS cname")
        .unionByName(dns.selectExpr("host", "false AS cart_ok", "cname"))
        .groupBy("host")
        .agg(F.expr("max(cart_ok) AS cart_ok"), F.expr(f"min(CASE WHEN {points} THEN cname END) AS platform_cname"))
    )


def with_host_signals(heads: DataFrame, hosts: DataFrame) -> DataFrame:
    """Adds cart and DNS answers to store heads; a missing answer is no evidence."""
    keyed = heads.withColumn("host", F.expr(f"lower({urls.hostname('home_url')})"))
    # Hosts are about as many as stores: the optimiser splits the few that many stores share.
    return keyed.join(hosts, "host", "left")


def without_host_signals(heads: DataFrame) -> DataFrame:
    """The same columns where no host is asked: nothing is joined."""
    return heads.withColumns(
        {
            "host": F.expr(f"lower({urls.hostname('home_url')})"),
            "cart_ok": F.lit(None).cast("boolean"),
            "platform_cname": F.lit(None).cast("string"),
        }
    )


def host_evidence(cart_url: str) -> str:
    """Evidence the host answers give, as (rank, kind, value, source_url, weight, strength)."""

    def item(rank: int, kind: str, value: str, url: str) -> str:
        return (
            f"named_struct('rank', {rank}, 'kind', '{kind}', 'value', {value}, 'source_url', {url}, "
            "'weight', 5, 'strength', 'strong')"
        )

    dns = item(1, "shopify_dns", "platform_cname", "home_url")
    cart = item(6, "shopify_cart", "'Shopify cart schema'", cart_url)
    return (
        f"array_compact(array(CASE WHEN platform_cname IS NOT NULL THEN {dns} END, CASE WHEN cart_ok THEN {cart} END))"
    )


def platform_evidence(raw: DataFrame, carts: DataFrame, dns: DataFrame) -> DataFrame:
    """Long platform evidence of usable homes, from raw facts: nothing needs parsing here."""
    homes = raw.where("page_seq = 0 AND head.home_reason IS NULL").drop("body").withColumn("home_url", F.col("url"))
    joined = with_host_signals(homes, host_facts(carts, dns))
    from_page = each(
        signals.platform_signals(),
        lambda s: f"named_struct('rank', {s}.ord.b, 'kind', {s}.key, 'value', {s}.value, 'source_url', home_url, "
        f"'weight', {s}.weight, 'strength', {s}.strength)",
    )
    from_host = host_evidence("concat(regexp_extract(replace(home_url, '://www.', '://'), '^[a-z]+://[^/?#]+', 0), '/cart.js')")
    return rows_of(joined, ("store_id",), f"concat({from_page}, {from_host})", "e").select(
        "store_id", "e.kind", "e.value", "e.source_url", "e.weight", "e.strength"
    )


def india_evidence(facts: DataFrame) -> DataFrame:
    """Long country evidence, one row per (store, kind, value) with its first page."""
    reduced = signals.reduce_entities(signals.page_entities(facts, ("india",)))
    return reduced.selectExpr(
        "store_id", "key AS kind", "value", "first.url AS source_url", "first.weight", "first.strength"
    )


def state_resolution(facts: DataFrame) -> DataFrame:
    """Best-scored state per store; a tie is a conflict and yields no state."""
    reduced = signals.reduce_numbers(signals.page_entities(facts, ("state",)))
    ends = reduced.groupBy("store_id").agg(*[c.alias(n) for n, c in resolve_state().items()])
    return ends.selectExpr(
        "store_id",
        "CASE WHEN first_state <> last_state THEN '' ELSE first_state END AS state",
        "state_score",
        "first_state <> last_state AS state_conflict",
    )


# --- verdict rules -----------------------------------------------------------------


STATES = sorted({*fv.GST_STATES.values(), *fv.EXTRA_STATE_ALIASES.values(), *fv.PIN3_STATES.values(), *fv.PIN2_STATES.values()})
_STATE_STEP = 1_000  # more than there are states


def resolve_state() -> dict[str, Column]:
    """Aggregates for the best-scored state: its two ends differ when several states tie.

    Points and the state's place in the alphabet are one number, so the ends are found by hash.
    """
    names = f"map({', '.join(f'{n + 1}L, {literal(name)}' for n, name in enumerate(STATES))})"
    place = lookup_number({name: n + 1 for n, name in enumerate(STATES)}, "key")
    low = f"min(CASE WHEN family = 'state' THEN -top * {_STATE_STEP} + {place} END)"
    high = f"max(CASE WHEN family = 'state' THEN top * {_STATE_STEP} + {place} END)"

    def name(code: str) -> str:
        return f"try_element_at({names}, pmod({code}, {_STATE_STEP}))"

    return _all({"first_state": name(low), "last_state": name(high), "state_score": f"{high} div {_STATE_STEP}"})


def evidence_totals() -> dict[str, Column]:
    """Score and kind counts per evidence family, from reduced signal rows."""

    def score(family: str) -> str:
        return f"coalesce(sum(CASE WHEN family = '{family}' THEN kind_weight END), 0)"

    def rows(family: str, strength: str | None = None) -> str:
        extra = {None: "", "strong": " AND kind_strong", "supporting": " AND NOT kind_strong"}[strength]
        return f"count(CASE WHEN family = '{family}'{extra} THEN 1 END)"

    return _all(
        {
            "page_platform_score": score("platform"),
            "page_platform_strong": rows("platform", "strong"),
            "page_platform_kinds": rows("platform"),
            "india_total": score("india"),
            "india_strong": rows("india", "strong"),
            "india_supporting": rows("india", "supporting"),
        }
    )


def with_verdict(rolled: DataFrame) -> DataFrame:
    """Scores, flags, state and reasons from the roll-up and the per-host answers.

    Platform: a strong kind and at least two kinds. Country: strong and supporting
    evidence. State: no tie. An unusable home page leaves nothing but its reason.
    """
    answers = "(cast(platform_cname IS NOT NULL AS int) + cast(coalesce(cart_ok, false) AS int))"
    flags = {
        "platform_ok": f"home_reason IS NULL AND page_platform_strong + {answers} >= 1 AND page_platform_kinds + {answers} >= 2",
        "india_ok": "home_reason IS NULL AND india_strong > 0 AND india_supporting > 0",
        "state_conflict": "home_reason IS NULL AND coalesce(first_state <> last_state, false)",
    }
    results = {
        "accepted": "platform_ok AND india_ok AND NOT state_conflict",
        "shopify_score": f"cast(CASE WHEN home_reason IS NULL THEN page_platform_score + 5 * {answers} ELSE 0 END AS int)",
        "india_score": "cast(CASE WHEN home_reason IS NULL THEN india_total ELSE 0 END AS int)",
        "state": "CASE WHEN home_reason IS NULL AND NOT state_conflict THEN coalesce(first_state, '') ELSE '' END",
        "rejection_reasons": """CASE WHEN home_reason IS NOT NULL THEN array(home_reason) ELSE array_compact(array(
          CASE WHEN NOT platform_ok THEN 'insufficient_shopify_evidence' END,
          CASE WHEN NOT india_ok THEN 'insufficient_india_evidence' END,
          CASE WHEN state_conflict THEN 'conflicting_state_evidence' END)) END""",
    }
    return rolled.withColumns(_all(flags)).withColumns(_all(results))


# --- fields --------------------------------------------------------------------------


def field_picks() -> dict[str, Column]:
    """Description, logo and the (at most 17) category totals of a store."""
    total = "struct(key AS category, total AS points, first.ord AS ord, best.neg_points AS neg_best, best.url AS url)"
    return _all(
        {
            "description_pick": "min(CASE WHEN family = 'description' THEN first END)",
            "logo_pick": "min(CASE WHEN family = 'logo' THEN best END)",
            "category_totals": f"collect_list(CASE WHEN family = 'category' THEN {total} END)",
        }
    )


FIELD_COLUMNS = ("description", "description_source", "logo_url", "logo_source", "category", "category_source")


def with_fields(rolled: DataFrame) -> DataFrame:
    """Plain field columns; the store's own description weighs most in its category."""
    described = rolled.withColumn("_description", F.expr("coalesce(description_pick.payload, '')"))
    hinted = described.withColumn("_hints", F.expr(signals.category_hits("_description")))
    best = hinted.withColumn("_best", F.expr(f"try_element_at(array_sort({category_ranking()}), 1)"))
    fields = {
        "description": "_description",
        "description_source": "coalesce(description_pick.url, '')",
        "logo_url": "coalesce(logo_pick.payload, '')",
        "logo_source": "coalesce(logo_pick.url, '')",
        "category": f"coalesce(_best.category, '{fv.DEFAULT_CATEGORY}')",
        "category_source": "coalesce(_best.url, home_url, '')",
    }
    blanked = {name: f"CASE WHEN home_reason IS NULL THEN {value} ELSE '' END" for name, value in fields.items()}
    return best.withColumns(_all(blanked)).drop(
        "description_pick", "logo_pick", "category_totals", "_description", "_hints", "_best"
    )


def category_ranking(totals: str = "category_totals", hints: str = "_hints", home_url: str = "home_url") -> str:
    """Structs that sort best category first: points, then who scored first."""
    weight = fv.CATEGORY_HINT_WEIGHT

    def index(category: str) -> str:
        return f"cast({text.lookup(signals.CATEGORY_INDEX, category)} AS int)"

    def row(points: str, a: str, b: str, c: str, category: str, url: str) -> str:
        return f"named_struct('neg_points', -({points}), 'a', {a}, 'b', {b}, 'c', {c}, 'category', {category}, 'url', {url})"

    def seen(t: str) -> str:
        hit = keep(hints, lambda h: f"{h}.category = {t}.category")

        def with_hint(points: str) -> str:
            return row(
                f"{t}.points + {points}",
                f"CASE WHEN {points} > 0 THEN -1 ELSE {t}.ord.a END",
                f"CASE WHEN {points} > 0 THEN 0 ELSE {t}.ord.b END",
                f"CASE WHEN {points} > 0 THEN {index(f'{t}.category')} ELSE {t}.ord.c END",
                f"{t}.category",
                # The first chunk with the most points is the source; the hint comes first.
                f"CASE WHEN {points} > 0 AND {points} >= -{t}.neg_best THEN {home_url} ELSE {t}.url END",
            )

        return let(f"cast(coalesce(try_element_at({hit}, 1).hits, 0) * {weight} AS bigint)", with_hint)

    only_hinted = keep(hints, lambda h: f"NOT exists({totals}, t -> t.category = {h}.category)")
    unseen = each(
        only_hinted,
        lambda h: row(
            f"cast({h}.hits * {weight} AS bigint)", "-1", "0", index(f"{h}.category"), f"{h}.category", home_url
        ),
    )
    return f"concat({each(totals, seen)}, {unseen})"


def apply_image_facts(stores: DataFrame, images: DataFrame) -> DataFrame:
    """Blanks a logo, and its source, that is not shown to be a real image."""
    usable = images.where(valid_image()).selectExpr("url AS logo_url", "true AS _valid").distinct()
    joined = stores.join(usable, "logo_url", "left")
    return joined.withColumns(
        _all({c: f"CASE WHEN _valid THEN {c} ELSE '' END" for c in ("logo_url", "logo_source")})
    ).drop("_valid")


def valid_image() -> str:
    blocked = text.contains_any("lower(url)", fv.IMAGE_BLOCKED_TOKENS)
    return (
        f"NOT {blocked} AND robots_allowed AND status_code < 400 "
        f"AND startswith(lower(content_type), 'image/') AND n_bytes > {fv.IMAGE_MIN_BYTES}"
    )


# --- long entity tables ------------------------------------------------------------------


def store_contacts(facts: DataFrame) -> DataFrame:
    """(store, email|phone, value, first page): one row each, however many a store has."""
    return _values(facts, "contact")


def store_socials(facts: DataFrame) -> DataFrame:
    return _values(facts, "social")


def _values(facts: DataFrame, family: str) -> DataFrame:
    reduced = signals.reduce_entities(signals.page_entities(facts, (family,)))
    return reduced.selectExpr("store_id", "key", "value", "first.url AS source_url")


def first_provenance(facts: DataFrame) -> DataFrame:
    """`email:…`, `phone:…` and `social:platform:…` entries with the first page that shows them."""
    reduced = signals.reduce_entities(signals.page_entities(facts, ("contact", "social")))
    return reduced.selectExpr(
        "store_id",
        "CASE WHEN family = 'social' THEN concat_ws(':', 'social', key, value) ELSE concat_ws(':', key, value) END AS entry",
        "first.url AS source_url",
    )


def category_points(facts: DataFrame) -> DataFrame:
    """Points per (store, category) with the page of the strongest chunk."""
    reduced = signals.reduce_entities(signals.page_entities(facts, ("category",)))
    return reduced.selectExpr("store_id", "key AS category", "total AS points", "best.url AS source_url")


FIELD_FAMILIES = {"category": ("category", "description"), "description": ("description",), "logo": ("logo",)}


def store_fields(facts: DataFrame, *fields: str) -> DataFrame:
    """Category, description and logo with their sources, or those of them that are named.

    Only the signals of the named fields are extracted; a category also asks the description.
    """
    named = fields or tuple(FIELD_FAMILIES)
    families = dict.fromkeys(("head", *(family for field in named for family in FIELD_FAMILIES[field])))
    reduced = signals.reduce_entities(signals.page_entities(facts, tuple(families)))
    rolled = reduced.groupBy("store_id").agg(
        *[c.alias(n) for n, c in field_picks().items()], F.expr("max(head) AS head")
    )
    columns = [c for c in FIELD_COLUMNS if c.removesuffix("_source").removesuffix("_url") in named]
    return with_fields(store_heads(rolled)).select("store_id", *columns)
