"""Expressions (SQL text) that pick parts of a page out of its element facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions.text import each, keep, let, matches, windows

# The page's text as elements own it: what offsets point into.
OWN_TEXT = "coalesce(full_text, text)"


def attr(element: str, name: str) -> str:
    return f"coalesce(try_element_at({element}.attrs, '{name}'), '')"


def text_of(element: str) -> str:
    return f"substring({OWN_TEXT}, {element}.start, {element}.len)"


def pick(condition: Callable[[str], str]) -> str:
    return keep("elements", condition)


def tagged(*tags: str) -> str:
    names = ", ".join(f"'{t}'" for t in tags)
    return pick(lambda e: f"{e}.tag IN ({names})")


def has_class(element: str, name: str) -> str:
    return f"array_contains(split({attr(element, 'class')}, '[ \\\\t\\\\r\\\\n]+'), '{name}')"


def mentions(element: str, attribute: str, word: str) -> str:
    # Most elements have no such attribute: nothing is lowered then.
    return f"coalesce(contains(lower(try_element_at({element}.attrs, '{attribute}')), '{word}'), false)"


def inside(element: str, *markers: str) -> str:
    names = ", ".join(f"'{m}'" for m in markers)
    return f"arrays_overlap({element}.within, array({names}))"


ANCHORS = "filter(elements, e -> e.tag = 'a')"
HREFS = each(ANCHORS, lambda e: attr(e, "href"))


def title_text() -> str:
    return f"coalesce({text_of(f'try_element_at({tagged("title")}, 1)')}, '')"


def headings_text() -> str:
    """All h1 and h2 texts."""
    return f"array_join({each(tagged('h1', 'h2'), text_of)}, ' ')"


def meta_description() -> str:
    """Content of the first description meta in document order; NULL without one."""
    described = pick(
        lambda e: f"{e}.tag = 'meta' AND ({attr(e, 'name')} = 'description' OR {attr(e, 'property')} = 'og:description')"
    )
    return f"try_element_at({each(described, lambda e: attr(e, 'content'))}, 1)"


def content_text() -> str:
    """Visible text of main, else body, else the page."""
    return "substring(text, content_start, content_len)"


def body_text() -> str:
    return f"coalesce({text_of(f'try_element_at({tagged("body")}, 1)')}, {OWN_TEXT})"


def commerce_links_text() -> str:
    """Text and target of all header, navigation and collection links."""
    links = keep(
        ANCHORS, lambda e: f"{inside(e, 'header', 'nav')} OR contains({attr(e, 'href')}, '/collections/')"
    )
    labels = each(links, lambda e: f"concat({text_of(e)}, ' ', {attr(e, 'href')})")
    return f"array_join({labels}, ' ')"


def description_texts() -> str:
    """Texts of all banner, hero, article and main paragraphs."""
    nodes = pick(
        lambda e: f"{has_class(e, 'banner__text')} OR {has_class(e, 'hero__text')} "
        f"OR ({e}.tag = 'p' AND {inside(e, 'hero', 'article', 'main')})"
    )
    return each(nodes, text_of)


ADDRESS_SELECTORS = (
    lambda e: f"{e}.tag = 'address'",
    lambda e: f"contains({attr(e, 'itemtype')}, 'PostalAddress')",
    lambda e: mentions(e, "class", "address"),
    lambda e: mentions(e, "id", "address"),
)


def spans(elements: str) -> str:
    """Distinct places of elements. Nested elements share text: jobs go over places and cut
    the text out one at a time, so a page never holds many copies of itself."""
    places = each(keep(elements, lambda e: f"{e}.len > 0"), lambda e: f"struct({e}.start AS start, {e}.len AS len)")
    return f"array_distinct({places})"


def address_spans() -> str:
    return f"array_distinct(concat({', '.join(spans(pick(selector)) for selector in ADDRESS_SELECTORS)}))"


def contact_spans() -> str:
    """Places a business publishes its contacts in; contact pages add their content."""
    always = pick(
        lambda e: " OR ".join(
            [f"{e}.tag = 'footer'", mentions(e, "class", "contact"), mentions(e, "id", "contact")]
            + [selector(e) for selector in ADDRESS_SELECTORS]
        )
    )
    body = f"try_element_at({tagged('body')}, 1)"
    whole = f"struct(coalesce({body}.start, 1) AS start, coalesce({body}.len, length({OWN_TEXT})) AS len)"
    content = f"concat({spans(tagged('main', 'article'))}, filter(array({whole}), s -> s.len > 0))"
    return f"""array_distinct(concat({spans(always)},
      CASE WHEN role = 'contact' THEN {content} ELSE cast(array() AS array<struct<start:int,len:int>>) END))"""


def legal_windows() -> str:
    """Text around the contact phrases of a legal page."""
    around = let(body_text(), lambda t: windows(t, fv.LEGAL_CONTACT_PHRASES, *fv.LEGAL_CONTACT_WINDOW))
    return f"CASE WHEN role = 'legal' THEN {around} ELSE cast(array() AS array<string>) END"


def contact_regions() -> str:
    """The texts of all contact places and legal windows."""
    return f"concat({each(contact_spans(), text_of)}, {legal_windows()})"


def image_candidates() -> str:
    """Images with the address a visitor would load, in document order."""

    def image(e: str) -> str:
        sources = [f"nullif({attr(e, name)}, '')" for name in ("data-src", "data-lazy-src", "data-original")]
        sources += [f"nullif({_last_of_srcset(e)}, '')", attr(e, "src")]
        return (
            f"named_struct('src', coalesce({', '.join(sources)}), 'base', {_logo_base(e)}, "
            f"'width', {_pixels(attr(e, 'width'))}, 'height', {_pixels(attr(e, 'height'))})"
        )

    return each(tagged("img"), image)


def _pixels(value: str) -> str:
    return f"CASE WHEN {matches(value, '^[0-9]{1,9}$')} THEN try_cast({value} AS int) END"


def _last_of_srcset(element: str) -> str:
    srcset = f"coalesce(nullif({attr(element, 'srcset')}, ''), {attr(element, 'data-srcset')})"
    items = keep(each(f"split({srcset}, ',')", lambda i: f"trim({i})"), lambda i: f"{i} <> ''")
    return f"coalesce(split(try_element_at({items}, -1), ' ')[0], '')"


def _logo_base(element: str) -> str:
    """Score and selector rank of an image as a logo; NULL when no selector takes it."""
    by_class, by_alt = mentions(element, "class", "logo"), mentions(element, "alt", "logo")
    header = inside(element, "header")
    rules = (
        (inside(element, "home_link"), 90),
        (inside(element, "home_dot_link"), 90),
        (f"{header} AND {by_class}", 85),
        (f"{header} AND {by_alt}", 85),
        (by_class, 65),
        (by_alt, 60),
    )
    cases = " ".join(
        f"WHEN {rule} THEN named_struct('score', {score}, 'rank', {rank})" for rank, (rule, score) in enumerate(rules)
    )
    return f"CASE {cases} END"


# --- JSON-LD -------------------------------------------------------------------


def _is_object(value: str) -> str:
    return f"try_variant_get({value}, '$', 'map<string,variant>') IS NOT NULL"


def _string_at(value: str, path: str) -> str:
    """A member that is a JSON string; NULL for any other type."""
    return let(
        f"try_variant_get({value}, '{path}', 'variant')",
        lambda member: f"CASE WHEN schema_of_variant({member}) = 'STRING' THEN try_variant_get({member}, '$', 'string') END",
    )


def ld_objects(scripts: str) -> str:
    """All JSON-LD objects: lists flattened, graph children before their parent, bad JSON skipped."""
    parsed = keep(each(scripts, lambda s: f"try_parse_json({s})"), lambda v: f"{v} IS NOT NULL")
    top = f"flatten({each(parsed, lambda v: f"coalesce(try_variant_get({v}, '$', 'array<variant>'), array({v}))")})"
    none = "cast(array() AS array<variant>)"

    def with_graph(v: str) -> str:
        graph = f"coalesce(try_variant_get({v}, '$[\"@graph\"]', 'array<variant>'), {none})"
        return f"concat({keep(graph, _is_object)}, array({v}))"

    return f"flatten({each(keep(top, _is_object), with_graph)})"


def ld_facts(scripts: str = "ld_json") -> str:
    """The members the jobs use, as typed structs."""

    def fact(v: str) -> str:
        logo = (
            f"coalesce({_string_at(v, '$.logo')}, nullif({_string_at(v, '$.logo.url')}, ''), "
            f"{_string_at(v, '$.logo.contentUrl')})"
        )

        def members(address: str) -> str:
            ok = f"coalesce({_is_object(address)}, false)"
            return f"""named_struct(
              'type', lower(coalesce(try_variant_get({v}, '$["@type"]', 'string'), '')),
              'logo', {logo},
              'description', {_string_at(v, '$.description')},
              'category', {_string_at(v, '$.category')},
              'product_type', {_string_at(v, '$.productType')},
              'name', {_string_at(v, '$.name')},
              'address', CASE WHEN {ok} THEN to_json({address}) END,
              'country', CASE WHEN {ok} THEN try_variant_get({address}, '$.addressCountry', 'string') END,
              'region', CASE WHEN {ok} THEN try_variant_get({address}, '$.addressRegion', 'string') END)"""

        return let(f"try_variant_get({v}, '$.address', 'variant')", members)

    return each(ld_objects(scripts), fact)


# --- table-level views of the same parts -----------------------------------------


def rows_of(df: DataFrame, keys: tuple[str, ...], array: str, name: str, pos: str | None = None) -> DataFrame:
    """One row per element of an array expression.

    An inner explode makes the optimiser infer a filter on the array's size, which would
    compute a costly array twice. The outer form does not; its empty rows are dropped.
    """
    if pos is None:
        opened = df.selectExpr(*keys, f"explode_outer({array}) AS {name}")
    else:
        opened = df.selectExpr(*keys, f"posexplode_outer({array}) AS ({pos}, {name})")
    return opened.where(f"{name} IS NOT NULL")


def page_links(facts: DataFrame, *keys: str) -> DataFrame:
    """One row per link with a target, in document order."""
    rows = each(
        ANCHORS,
        lambda e: f"named_struct('href', {attr(e, 'href')}, 'label', {text_of(e)}, 'in_nav', {inside(e, 'header', 'nav')})",
    )
    return rows_of(facts, keys, rows, "link", "pos").select(
        *keys, "pos", "link.href", "link.label", "link.in_nav", F.expr("contains(link.href, '/collections/') AS is_collection")
    )


def page_headings(facts: DataFrame, *keys: str) -> DataFrame:
    return facts.select(*keys, F.expr(title_text()).alias("title"), F.expr(headings_text()).alias("headings"))


def json_ld_rows(facts: DataFrame, *keys: str) -> DataFrame:
    return rows_of(facts, keys, ld_facts(), "item", "pos").select(*keys, "pos", "item.*")


def region_rows(facts: DataFrame, *keys: str) -> DataFrame:
    return rows_of(facts, keys, contact_regions(), "region", "pos")


def image_rows(facts: DataFrame, *keys: str) -> DataFrame:
    return rows_of(facts, keys, image_candidates(), "image", "pos").select(*keys, "pos", "image.*")
