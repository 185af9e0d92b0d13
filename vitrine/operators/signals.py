"""Page facts → long signal rows, and their reduction per store and value.

Every extractor turns one page into an array of the same small struct. A job explodes
the arrays it needs; the full verification explodes all of them at once, so a page is
parsed and scanned once. Rows are first reduced per (store, family, key, value) with
map-side partial aggregation, which also spreads a very large store over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions import contacts, states, urls
from vitrine.functions import text as tx
from vitrine.functions.text import each, keep, let, literal
from vitrine.operators import elements as el

HEAD = "struct<home_url:string,requested_url:string,home_reason:string,redirect_history:array<string>>"
SIGNAL = (
    "struct<family:string,key:string,value:string,payload:string,points:bigint,weight:int,strength:string,"
    f"ord:struct<a:int,b:int,c:int,d:int>,head:{HEAD}>"
)
NOTHING = f"cast(array() AS array<{SIGNAL}>)"
LAST = 2**31 - 1


def _signal(
    family: str,
    key: str = "''",
    value: str = "''",
    payload: str = "''",
    points: str = "0",
    weight: int = 0,
    strength: str = "",
    order: tuple = (0, 0, 0),
    head: str = "NULL",
) -> str:
    a, b, c, d = (*order, 0)[:4]
    return (
        f"cast(struct('{family}', {key}, {value}, {payload}, {points}, {weight}, '{strength}', "
        f"struct({a}, {b}, {c}, {d}), {head}) AS {SIGNAL})"
    )


def _if(condition: str, signal: str) -> str:
    return f"CASE WHEN {condition} THEN array({signal}) ELSE {NOTHING} END"


def _numbered(array: str, build) -> str:
    """`transform` with the position as a second variable."""
    return f"transform({array}, (v, i) -> {build('v', 'i')})"


def head_signals() -> str:
    """One row per page; the home page's carries its addresses, redirects and usability."""
    return f"array({_signal('head', head='head')})"


# --- evidence ----------------------------------------------------------------


def platform_signals() -> str:
    """Signals the home page itself gives; DNS and cart answers join per store."""

    def one(condition: str, rank: int, kind: str, value: str, weight: int, strength: str) -> str:
        signal = _signal("platform", literal(kind), value, weight=weight, strength=strength, order=(0, rank, 0))
        return _if(f"page_seq = 0 AND {condition}", signal)

    rules = (
        one("platform_headers <> ''", 2, "shopify_headers", "platform_headers", 5, "strong"),
        one("has_runtime", 3, "shopify_runtime", "'Shopify runtime object'", 5, "strong"),
        one("has_cdn", 4, "shopify_cdn", "'Shopify CDN asset'", 2, "supporting"),
        one("has_markup", 5, "shopify_markup", "'Shopify theme markup'", 2, "supporting"),
    )
    return f"concat({', '.join(rules)})"


def text_regions() -> str:
    """Address-sized windows of the text with the score a state found in them deserves."""

    def scored(regions: str, score: str) -> str:
        return each(regions, lambda r: f"named_struct('region', {r}, 'score', {score})")

    none = "cast(array() AS array<struct<region:string,score:int>>)"
    label = r"\b(?:{})\s+address\b"
    around_pins = scored(
        tx.windows("text", fv.PIN, *fv.PIN_WINDOW, guard=fv.PIN_GUARD), "CASE role WHEN 'contact' THEN 80 ELSE 70 END"
    )
    parts = (
        f"CASE WHEN role <> 'legal' THEN {around_pins} ELSE {none} END",
        scored(tx.windows("text", label.format(fv.REGISTERED_LABEL), 0, fv.LABEL_WINDOW), "95"),
        scored(tx.windows("text", label.format(fv.OTHER_LABELS), 0, fv.LABEL_WINDOW), "90"),
        f"CASE WHEN role = 'legal' THEN {scored(tx.windows('text', fv.MAILING_PHRASES, 0, fv.MAILING_WINDOW), '85')} ELSE {none} END",
    )
    return f"concat({', '.join(parts)})"


def region_states() -> str:
    """State and score of every address region that stands for exactly one state."""
    elements = each(
        el.address_spans(),
        lambda s: f"named_struct('state', {let(el.text_of(s), states.region_state)}, "
        "'score', CASE role WHEN 'contact' THEN 82 ELSE 72 END)",
    )
    found = each(
        text_regions(),
        lambda r: f"named_struct('state', {states.region_state(f'{r}.region')}, 'score', {r}.score)",
    )
    return keep(f"concat({elements}, {found})", lambda r: f"{r}.state IS NOT NULL")


def _structured_addresses() -> str:
    return keep("ld", lambda i: f"lower(trim({i}.country)) IN ('in', 'india')")


def india_signals() -> str:
    def sig(rank: int, kind: str, value: str, weight: int, strength: str, pos: str = "0") -> str:
        return _signal("india", literal(kind), value, weight=weight, strength=strength, order=("page_seq", rank, pos))

    host = f"lower({urls.hostname('url')})"
    domain = _signal("india", "'india_domain'", host, weight=1, strength="supporting", order=(LAST, 8, 0))
    rules = (
        _numbered("gstins", lambda v, i: sig(1, "gstin", v, 5, "strong", i)),
        _numbered("regions", lambda v, i: sig(2, "state_pin", f"{v}.state", 4, "strong", i)),
        _if(
            tx.names_registered_office("text"),
            sig(3, "registered_india", "'registered/business address names India'", 4, "strong"),
        ),
        _numbered(
            _structured_addresses(), lambda v, i: sig(4, "structured_india_address", f"{v}.address", 5, "strong", i)
        ),
        _if(f"size({contacts.indian_phones('text')}) > 0", sig(5, "india_phone", "'public Indian phone'", 2, "supporting")),
        _if(tx.shows_rupees("text"), sig(6, "inr", "'INR storefront'", 1, "supporting")),
        _if(tx.ships_to_india("text"), sig(7, "india_shipping", "'India shipping/returns language'", 1, "supporting")),
        _if(f"page_seq = 0 AND {urls.india_tld(host)}", domain),
    )
    return f"concat({', '.join(rules)})"


def state_signals() -> str:
    by_tax = keep(each("gstins", states.state_from_gstin), lambda s: f"{s} <> ''")
    named = each(_structured_addresses(), lambda a: states.find_states(f"coalesce({a}.region, '')"))
    structured = keep(named, lambda s: f"size({s}) = 1")
    rows = (
        each(by_tax, lambda s: _signal("state", s, points="100")),
        each("regions", lambda r: _signal("state", f"{r}.state", points=f"{r}.score")),
        each(structured, lambda s: _signal("state", f"{s}[0]", points="90")),
    )
    return f"concat({', '.join(rows)})"


# --- contacts and social profiles -----------------------------------------------


def page_emails() -> str:
    """Addresses of mailto links, and those in contact regions away from a maker's credit."""
    mailto = keep("hrefs", lambda h: f"substring({h}, 7, 1) = ':' AND lower(left({h}, 6)) = 'mailto'")
    linked = each(mailto, lambda h: contacts.extract_emails(f"split(substring({h}, 8), '[?]')[0]"))

    def uncredited(region: str) -> str:
        found = contacts.extract_emails(region)

        def kept(low: str) -> str:
            near = keep(found, lambda e: f"NOT {tx.near_third_party_marker(low, e)}")
            # Few regions hold a credit phrase; in the others no address needs a look around.
            return f"CASE WHEN {tx.contains_any(low, fv.THIRD_PARTY_MARKERS)} THEN {near} ELSE {found} END"

        return let(f"lower({region})", kept)

    return f"array_distinct(concat(flatten({linked}), {_over_regions(uncredited)}))"


def _over_regions(extract) -> str:
    """Values of all contact places and legal windows, one text at a time."""
    placed = each("contact_spans", lambda s: let(el.text_of(s), extract))
    return f"concat(flatten({placed}), flatten({each('legal_windows', extract)}))"


def page_phones() -> str:
    tel = keep("hrefs", lambda h: f"substring({h}, 4, 1) = ':' AND lower(left({h}, 3)) = 'tel'")
    linked = each(tel, lambda h: contacts.extract_phones(f"substring({h}, 5)"))
    chats = each(keep("hrefs", lambda h: f"contains({h}, '//')"), contacts.whatsapp_phone)
    known_chats = keep(chats, lambda p: f"{p} IS NOT NULL")
    return f"array_distinct(concat(flatten({linked}), {known_chats}, {_over_regions(contacts.extract_phones)}))"


def contact_signals() -> str:
    def rows(key: str, values: str) -> str:
        return each(values, lambda v: _signal("contact", literal(key), v, order=("page_seq", 0, 0)))

    return f"concat({rows('email', page_emails())}, {rows('phone', page_phones())})"


def social_links() -> str:
    """Targets that may be social profiles, to be normalised."""
    return keep("hrefs", urls.social_host_hint)


def social_signals() -> str:
    canonical = f"array_distinct({each('social_urls', urls.canonical_social_url)})"
    placed = each(canonical, lambda u: f"named_struct('platform', {urls.social_platform(u)}, 'profile', {u})")
    return each(
        keep(placed, lambda f: f"{f}.platform IS NOT NULL"),
        lambda f: _signal("social", f"{f}.platform", f"{f}.profile", order=("page_seq", 0, 0)),
    )


# --- category --------------------------------------------------------------------

WORD_CATEGORY = {word: category for category, words in fv.CATEGORY_WORDS.items() for word in words}
CATEGORY_INDEX = {category: str(i) for i, category in enumerate(fv.CATEGORY_WORDS)}


def category_hits(chunk: str) -> str:
    """(category, hits) of one text: every word counts at most three times."""

    def per_word(found: str) -> str:
        return each(
            f"array_distinct({found})",
            lambda w: f"named_struct('category', {tx.lookup(WORD_CATEGORY, w)}, 'hits', "
            f"least({fv.CATEGORY_HIT_CAP}, size({keep(found, lambda f: f'{f} = {w}')})))",
        )

    def per_category(counted: str) -> str:
        def total(category: str) -> str:
            same = keep(counted, lambda c: f"{c}.category = {category}")
            return f"named_struct('category', {category}, 'hits', aggregate({same}, 0, (sum, c) -> sum + c.hits))"

        return each(f"array_distinct({each(counted, lambda c: f'{c}.category')})", total)

    words = tx.bounded_words(f"lower({tx.clean_text(chunk)})", WORD_CATEGORY, "a-z0-9")
    return let(words, lambda found: let(per_word(found), per_category))


def category_chunks() -> str:
    """The texts of a page that speak about its goods, weighted."""

    def chunk(body: str, weight: str) -> str:
        return f"named_struct('body', coalesce({body}, ''), 'weight', {weight})"

    def of_object(i: str) -> str:
        goods = f"CASE WHEN {i}.type IN ('product', 'itemlist', 'offer') THEN 16 ELSE 5 END"
        return (
            f"array({chunk(f'{i}.category', '16')}, {chunk(f'{i}.product_type', '16')}, "
            f"{chunk(f'{i}.name', goods)}, {chunk(f'{i}.description', goods)})"
        )

    links = f"CASE WHEN role = 'home' THEN {el.commerce_links_text()} END"
    headings = f"concat({el.title_text()}, ' ', {el.headings_text()})"
    meta_weight = "CASE WHEN role = 'home' THEN 50 ELSE 8 END"
    return f"""concat(
      array({chunk('meta', meta_weight)}, {chunk(headings, '6')}),
      flatten({each('ld', of_object)}),
      array({chunk(links, '7')}, {chunk(el.content_text(), '1')}))"""


def category_signals() -> str:
    def of_chunk(chunk: str, i: str) -> str:
        def of_hit(h: str) -> str:
            position = f"{i} * 100 + cast({tx.lookup(CATEGORY_INDEX, f'{h}.category')} AS int)"
            return _signal(
                "category", f"{h}.category", points=f"{h}.hits * {chunk}.weight", order=("role_rank", "page_seq", position)
            )

        return each(category_hits(f"{chunk}.body"), of_hit)

    return f"CASE WHEN role = 'legal' THEN {NOTHING} ELSE flatten({_numbered(category_chunks(), of_chunk)}) END"


# --- description and logo ----------------------------------------------------------


def _describes(value: str) -> str:
    return f"coalesce(length(trim({value})) >= 20 AND NOT {tx.is_boilerplate_description(value)}, false)"


def description_signals() -> str:
    """At most one candidate per page: its best by pass, then kind, then position."""
    meta = let(tx.clean_text("meta"), lambda m: f"CASE WHEN {_describes(m)} THEN {m} END")
    speaking = keep(
        "ld",
        lambda i: f"{i}.type IN ('organization', 'store', 'brand', 'website') AND {_describes(f'{i}.description')}",
    )
    own = tx.clean_text(f"try_element_at({speaking}, 1).description")
    nodes = keep(el.description_texts(), _describes)

    def candidate(value: str, kind: int) -> str:
        rank = "role_rank" if kind < 2 else "role_rank + 10"
        return f"array({_signal('description', payload=value, order=(rank, 'page_seq', kind))})"

    def first_of(found: str) -> str:
        return f"""CASE WHEN {found}.meta IS NOT NULL THEN {candidate(f'{found}.meta', 0)}
          WHEN {found}.own IS NOT NULL THEN {candidate(f'{found}.own', 1)}
          WHEN {found}.node IS NOT NULL THEN {candidate(f'{found}.node', 2)} ELSE {NOTHING} END"""

    found = f"named_struct('meta', {meta}, 'own', {own}, 'node', try_element_at({nodes}, 1))"
    return f"CASE WHEN role IN ('contact', 'legal') THEN {NOTHING} ELSE {let(found, first_of)} END"


def _usable_logo(url: str) -> str:
    return f"({url} <> '' AND NOT {tx.contains_any(f'lower({url})', fv.LOGO_BLOCKED_TOKENS)})"


def ld_logos() -> str:
    named = keep("ld", lambda i: f"{i}.type IN ('organization', 'store', 'brand') AND {i}.logo IS NOT NULL")
    return each(named, lambda i: f"{i}.logo")


def logo_images() -> str:
    """Images a logo selector takes, without the ones that are icons by size."""
    return keep(
        el.image_candidates(),
        lambda i: f"{i}.base IS NOT NULL AND NOT coalesce({i}.width <= 64 AND {i}.height <= 64, false)",
    )


def logo_signals() -> str:
    from_ld = _numbered(
        keep("ld_logo_urls", _usable_logo),
        lambda v, i: _signal("logo", payload=v, points="100", order=(0, "page_seq", i)),
    )
    seen = "zip_with(logo_images, image_urls, (i, u) -> named_struct('url', u, 'base', i.base))"

    def from_image(v: str, i: str) -> str:
        points = (
            f"{v}.base.score + CASE WHEN contains(lower({v}.url), 'logo') THEN 10 ELSE 0 END "
            "+ CASE WHEN role = 'home' THEN 5 ELSE 0 END"
        )
        phase = "CASE WHEN role = 'home' THEN 1 ELSE 2 END"
        return _signal("logo", payload=f"{v}.url", points=points, order=(phase, "page_seq", f"{v}.base.rank", i))

    from_images = _numbered(keep(seen, lambda s: _usable_logo(f"{s}.url")), from_image)
    return f"concat({from_ld}, {from_images})"


# --- the table-level job --------------------------------------------------------------

EXTRACTORS = {
    "head": head_signals,
    "platform": platform_signals,
    "india": india_signals,
    "state": state_signals,
    "contact": contact_signals,
    "social": social_signals,
    "category": category_signals,
    "description": description_signals,
    "logo": logo_signals,
}
ALL_FAMILIES = tuple(EXTRACTORS)


def _shared_columns(families: tuple[str, ...]) -> list[dict]:
    """Columns several extractors read, in the order they build on each other."""
    asked = set(families)

    def when(users: set[str], **columns) -> dict:
        return {name: F.expr(c) if isinstance(c, str) else c for name, c in columns.items()} if users & asked else {}

    first = {
        **when({"india", "state", "category", "description", "logo"}, ld=el.ld_facts()),
        **when({"india", "state"}, regions=region_states(), gstins=states.find_gstins("text")),
        **when({"contact", "social"}, hrefs=el.HREFS),
        **when({"contact"}, contact_spans=el.contact_spans(), legal_windows=el.legal_windows()),
        **when({"category", "description"}, meta=el.meta_description(), role_rank=urls.role_rank("role")),
        **when({"logo"}, logo_images=logo_images()),
    }
    second = {}
    if "social" in asked:
        second["social_urls"] = urls.normalize_urls(social_links())
    if "logo" in asked:
        second["ld_logo_urls"] = urls.normalize_urls(ld_logos(), "url")
        second["image_urls"] = urls.normalize_urls("transform(logo_images, i -> i.src)", "url")
    return [step for step in (first, second) if step]


def page_entities(facts: DataFrame, families: tuple[str, ...] = ALL_FAMILIES) -> DataFrame:
    """Long signal rows of the asked families: one pass over the page facts."""
    work = facts
    for step in _shared_columns(families):
        work = work.withColumns(step)
    signals = ", ".join(EXTRACTORS[family]() for family in families)
    fetched = ("fetched_at",) if "fetched_at" in facts.columns else ()
    keys = ("store_id", "page_seq", *fetched, "url", "role")
    return el.rows_of(work, keys, f"concat({signals})", "signal").select(*keys, "signal.*")


def of_newest_fetch(entities: DataFrame, pages: DataFrame) -> DataFrame:
    """Signal rows of every page's newest fetch; all fetches of `pages` count, usable or not.

    Only pages fetched more than once are looked up, on three short columns. A fetch without a time is
    older than any with one; fetches of the same time are one.
    """
    times = pages.groupBy("store_id", "page_seq").agg(
        F.max("fetched_at").alias("newest"), F.min("fetched_at").alias("oldest"), F.count_if(F.col("fetched_at").isNull()).alias("untimed")
    )
    again = times.where("newest <> oldest OR (newest IS NOT NULL AND untimed > 0)").drop("oldest", "untimed")
    seen = entities.join(again, ["store_id", "page_seq"], "left")
    return seen.where("newest IS NULL OR fetched_at = newest").drop("newest", "fetched_at")


# What a row's kind alone decides.
KIND_NUMBERS = ("max(weight) AS kind_weight", "max(strength = 'strong') AS kind_strong")


def reduce_entities(entities: DataFrame) -> DataFrame:
    """One row per (store, family, key, value): first provenance, sums, maxima, best row."""
    return entities.groupBy("store_id", "family", "key", "value").agg(
        F.expr("min(struct(ord, url, payload, weight, strength)) AS first"),
        F.expr("sum(points) AS total"),
        F.expr("max(points) AS top"),
        F.expr("min(struct(-points AS neg_points, ord, url, payload)) AS best"),
        F.expr("max(head) AS head"),
        *map(F.expr, KIND_NUMBERS),
    )


def reduce_numbers(entities: DataFrame) -> DataFrame:
    """One row per (store, family, key, value, head) with numbers alone: scores need no provenance, and without a
    text to put in order the signal rows are reduced by hash, before and after the shuffle."""
    return entities.groupBy("store_id", "family", "key", "value", "head").agg(F.expr("max(points) AS top"), *map(F.expr, KIND_NUMBERS))
