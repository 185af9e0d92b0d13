"""Building blocks of the checking SQL, written against the derived inputs' raw markup."""

from __future__ import annotations

from checks import inputs as i
from vitrine import fixed_values as fv
from vitrine.functions.states import STATE_ALIASES
from vitrine.operators.signals import CATEGORY_INDEX


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(markup: str) -> str:
    """Text of a piece of markup: scripts and tags out, white space collapsed."""
    no_script = f"regexp_replace({markup}, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g')"
    no_comment = f"regexp_replace({no_script}, '(?s)<!--.*?-->', ' ', 'g')"
    no_tags = f"regexp_replace({no_comment}, '<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({no_tags}, '\\s+', ' ', 'g'))"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {quote(w)})" for w in words) + ")"


def role(url: str) -> str:
    path = f"lower(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1))"
    return (
        f"CASE WHEN {path} IN ('', '/') THEN 'home' WHEN {any_of(path, fv.LEGAL_PATH_WORDS)} THEN 'legal' "
        f"WHEN {any_of(path, fv.ABOUT_PATH_WORDS)} THEN 'about' WHEN {any_of(path, fv.CONTACT_PATH_WORDS)} THEN 'contact' "
        "ELSE 'other' END"
    )


def values(rows) -> str:
    return ", ".join("(" + ", ".join(quote(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


def sql_map(mapping: dict) -> str:
    return "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in mapping.items()) + "}"


ROLE_RANK = "CASE role WHEN 'home' THEN 0 WHEN 'about' THEN 1 WHEN 'other' THEN 2 WHEN 'contact' THEN 3 ELSE 4 END"
PLAIN_URL = "regexp_replace(final_url, '://www[.]', '://')"

HOME_REASON = f"""
CASE WHEN NOT robots_allowed THEN 'robots_disallowed'
  WHEN status_code >= 400 OR body = '' THEN 'homepage_status_' || CAST(status_code AS VARCHAR)
  WHEN {any_of('lower(body)', fv.PASSWORD_MARKERS)} THEN 'password_protected'
  WHEN {any_of('lower(body)', fv.PARKED_MARKERS)} THEN 'parked_domain'
  WHEN contains(lower(body), 'captcha') AND length(body) < 10000 THEN 'captcha_only' END
"""

PAGES = f"""
crawl AS ({i.CRAWL}),
used AS (
  SELECT *, {role('final_url')} AS role FROM crawl
  WHERE page_seq = 0 OR (robots_allowed AND status_code < 400 AND contains(content_type, 'html'))
),
txt AS (SELECT *, {strip('body')} AS t FROM used),
heads AS (
  SELECT store_id, final_url AS home_url, {HOME_REASON} AS home_reason,
    CASE WHEN robots_allowed THEN rtrim({PLAIN_URL}, '/') ELSE rtrim(requested_url, '/') END AS domain_url
  FROM crawl WHERE page_seq = 0
)"""

GST = """
gst AS (
  SELECT DISTINCT store_id, page_seq, final_url,
    upper(unnest(regexp_extract_all(t, '(?i)\\b(0[1-9]|[12][0-9]|3[0-8]|97)[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]\\b'))) AS gstin
  FROM txt
)"""

GST_MAP = sql_map(fv.GST_STATES)


def named_states(text: str) -> str:
    plain = f"lower({text})"
    cases = ", ".join(
        f"CASE WHEN regexp_matches({plain}, {quote('(^|[^a-z])' + alias + '([^a-z]|$)')}) THEN {quote(state)} END"
        for alias, state in STATE_ALIASES.items()
    )
    return f"list_sort(list_distinct(list_filter([{cases}], lambda s: s IS NOT NULL)))"


def pins(text: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split_regex({text}, '[^0-9]+'), lambda d: regexp_full_match(d, '[1-9][0-9]{{5}}'))))"


def pin_state(pin: str) -> str:
    return f"coalesce({sql_map(fv.PIN3_STATES)}[left({pin}, 3)], {sql_map(fv.PIN2_STATES)}[left({pin}, 2)], '')"


def before_not(chars: str) -> str:
    return f"(p = 1 OR NOT regexp_matches(substr(t, p - 1, 1), '[{chars}]'))"


LABEL = "^(registered|corporate|business|office|store|postal)\\s+address\\b"
MAILING = "^(mailing us at|by mail using the details|contact information below)"
REGIONS = f"""
places AS (
  SELECT store_id, page_seq, final_url, role, t, unnest(range(1, length(t) + 1)) AS p FROM txt
),
regions AS (
  SELECT store_id, page_seq, final_url, {strip("unnest(regexp_extract_all(body, '(?s)<address>(.*?)</address>', 1))")} AS region,
    CASE role WHEN 'contact' THEN 82 ELSE 72 END AS score
  FROM used
  UNION ALL
  SELECT store_id, page_seq, final_url, substr(t, greatest(1, p - 220), p + 126 - greatest(1, p - 220)),
    CASE role WHEN 'contact' THEN 80 ELSE 70 END
  FROM places WHERE role <> 'legal' AND regexp_matches(substr(t, p, 7), '^[1-9][0-9]{{5}}([^0-9]|$)') AND {before_not('0-9')}
  UNION ALL
  SELECT store_id, page_seq, final_url,
    substr(t, p, length(regexp_extract(lower(substr(t, p, 40)), '{LABEL}')) + 400),
    CASE WHEN lower(substr(t, p, 10)) = 'registered' THEN 95 ELSE 90 END
  FROM places WHERE regexp_matches(lower(substr(t, p, 40)), '{LABEL}') AND {before_not('A-Za-z0-9_')}
  UNION ALL
  SELECT store_id, page_seq, final_url,
    substr(t, p, length(regexp_extract(lower(substr(t, p, 40)), '{MAILING}')) + 500), 85
  FROM places WHERE role = 'legal' AND regexp_matches(lower(substr(t, p, 40)), '{MAILING}')
),
region_lists AS (
  SELECT *, {named_states('region')} AS named, {pins('region')} AS pins FROM regions
),
region_states AS (
  SELECT store_id, page_seq, final_url, score, CASE WHEN len(named) = 1 THEN named[1] WHEN len(by_pin) = 1 AND len(named) = 0 THEN by_pin[1] END AS state
  FROM (SELECT *, list_distinct(list_filter(list_transform(pins, lambda d: {pin_state('d')}), lambda s: s <> '')) AS by_pin FROM region_lists)
  WHERE len(pins) > 0
)"""

LD = """
scripts AS (
  SELECT store_id, page_seq, final_url, role, unnest(regexp_extract_all(body, '(?s)<script type="application/ld.json">(.*?)</script>', 1)) AS s
  FROM used
),
docs AS (SELECT store_id, page_seq, final_url, role, CAST(s AS JSON) AS j FROM scripts WHERE json_valid(s)),
tops AS (
  SELECT store_id, page_seq, final_url, role, j, 1 AS o FROM docs WHERE json_type(j) = 'OBJECT'
  UNION ALL
  SELECT store_id, page_seq, final_url, role, unnest(json_extract(j, '$[*]')), unnest(range(1, CAST(json_array_length(j) AS BIGINT) + 1)) FROM docs WHERE json_type(j) = 'ARRAY'
),
ld AS (
  SELECT store_id, page_seq, final_url, role, unnest(json_extract(j, '$."@graph"[*]')) AS j, o, 0 AS g,
    unnest(range(1, CAST(json_array_length(j, '$."@graph"') AS BIGINT) + 1)) AS n FROM tops WHERE json_type(j, '$."@graph"') = 'ARRAY'
  UNION ALL SELECT store_id, page_seq, final_url, role, j, o, 1, 1 FROM tops
),
ld_facts AS (
  SELECT store_id, page_seq, final_url, role,
    CAST(row_number() OVER (PARTITION BY store_id, page_seq ORDER BY o, g, n) - 1 AS INTEGER) AS pos,
    lower(coalesce(json_extract_string(j, '$."@type"'), '')) AS type,
    CASE json_type(j, '$.logo') WHEN 'VARCHAR' THEN json_extract_string(j, '$.logo') ELSE json_extract_string(j, '$.logo.url') END AS logo,
    json_extract_string(j, '$.description') AS description,
    json_extract_string(j, '$.category') AS category,
    json_extract_string(j, '$.name') AS name,
    CASE json_type(j, '$.address') WHEN 'OBJECT' THEN CAST(json_extract(j, '$.address') AS VARCHAR) END AS address,
    json_extract_string(j, '$.address.addressCountry') AS country,
    json_extract_string(j, '$.address.addressRegion') AS region
  FROM ld
)"""

ADDRESS_PHRASE = "(registered\\s+(office|address)|corporate\\s+(office|address)|business\\s+address|office\\s+address).{0,200}\\bindia\\b"
INDIA = f"""
india AS (
  SELECT store_id, kind, value, weight, strength, arg_min(url, ord) AS source_url FROM (
    SELECT store_id, 'gstin' AS kind, gstin AS value, 5 AS weight, 'strong' AS strength, final_url AS url, page_seq AS ord FROM gst
    UNION ALL SELECT store_id, 'state_pin', state, 4, 'strong', final_url, page_seq FROM region_states WHERE state IS NOT NULL
    UNION ALL SELECT store_id, 'registered_india', 'registered/business address names India', 4, 'strong', final_url, page_seq FROM txt WHERE regexp_matches(lower(t), '{ADDRESS_PHRASE}')
    UNION ALL SELECT store_id, 'structured_india_address', address, 5, 'strong', final_url, page_seq FROM ld_facts WHERE lower(trim(country)) IN ('in', 'india')
    UNION ALL SELECT store_id, 'india_phone', 'public Indian phone', 2, 'supporting', final_url, page_seq FROM txt WHERE regexp_matches(t, '[+]91 [6-9][0-9]{{4}} [0-9]{{5}}')
    UNION ALL SELECT store_id, 'inr', 'INR storefront', 1, 'supporting', final_url, page_seq FROM txt WHERE contains(t, '₹') OR regexp_matches(t, '(?i)\\b(inr|rs\\.)\\s*\\d')
    UNION ALL SELECT store_id, 'india_shipping', 'India shipping/returns language', 1, 'supporting', final_url, page_seq FROM txt WHERE regexp_matches(lower(t), '\\b(ship|deliver|shipping|returns?)\\b.{{0,100}}\\bindia\\b')
    UNION ALL SELECT store_id, 'india_domain', regexp_extract(final_url, '://([^/]+)', 1), 1, 'supporting', final_url, 99 FROM txt WHERE page_seq = 0 AND regexp_matches(final_url, '[.]in/')
  ) GROUP BY ALL
),
state_scores AS (
  SELECT store_id, state, max(score) AS score FROM (
    SELECT store_id, {GST_MAP}[left(gstin, 2)] AS state, 100 AS score FROM gst
    UNION ALL SELECT store_id, state, score FROM region_states
    UNION ALL SELECT store_id, {named_states('region')}[1], 90 FROM ld_facts WHERE lower(trim(country)) IN ('in', 'india') AND len({named_states('region')}) = 1
  ) WHERE state IS NOT NULL GROUP BY store_id, state
),
resolved AS (
  SELECT store_id, CASE WHEN count(*) = 1 THEN min(state) ELSE '' END AS state, max(score) AS state_score, count(*) > 1 AS state_conflict
  FROM (SELECT *, max(score) OVER (PARTITION BY store_id) AS best FROM state_scores) WHERE score = best GROUP BY store_id
)"""
# GROUP BY ALL groups by every column outside an aggregate.

CART_OK = (
    "status_code < 400 AND contains(lower(content_type), 'json') AND json_valid(body) "
    "AND list_contains(json_keys(CASE WHEN json_valid(body) THEN body ELSE '{}' END), 'items') "
    "AND list_contains(json_keys(CASE WHEN json_valid(body) THEN body ELSE '{}' END), 'item_count')"
)
PLATFORM = f"""
carts AS ({i.CARTS}),
dns AS ({i.DNS}),
platform AS (
  SELECT h.store_id, kind, value, source_url, weight, strength FROM (
    SELECT store_id, 'shopify_headers' AS kind, 'x-shopid,x-shopify-stage' AS value, final_url AS source_url, 5 AS weight, 'strong' AS strength FROM crawl WHERE page_seq = 0 AND contains(header_names, 'x-shopid')
    UNION ALL SELECT store_id, 'shopify_runtime', 'Shopify runtime object', final_url, 5, 'strong' FROM crawl WHERE page_seq = 0 AND regexp_matches(body, '\\bShopify\\.(shop|theme|routes)\\b')
    UNION ALL SELECT store_id, 'shopify_cdn', 'Shopify CDN asset', final_url, 2, 'supporting' FROM crawl WHERE page_seq = 0 AND contains(body, '/cdn/shop/')
    UNION ALL SELECT store_id, 'shopify_markup', 'Shopify theme markup', final_url, 2, 'supporting' FROM crawl WHERE page_seq = 0 AND contains(body, 'shopify-section')
    UNION ALL SELECT store_id, 'shopify_dns', cname, final_url, 5, 'strong' FROM crawl JOIN dns ON regexp_extract(final_url, '://([^/]+)', 1) = host
      WHERE page_seq = 0 AND rtrim(lower(cname), '.') LIKE '%shops.myshopify.com'
    UNION ALL SELECT store_id, 'shopify_cart', 'Shopify cart schema', {PLAIN_URL} || 'cart.js', 5, 'strong'
      FROM (SELECT store_id, final_url, regexp_extract(final_url, '://([^/]+)', 1) AS host FROM crawl WHERE page_seq = 0) c JOIN (SELECT host FROM carts WHERE {CART_OK}) k USING (host)
  ) e JOIN heads h ON h.store_id = e.store_id WHERE home_reason IS NULL
)"""

VERDICT = """
judged AS (
  SELECT h.store_id, domain_url, home_reason,
    coalesce(p.score, 0) AS p_score, coalesce(n.score, 0) AS i_score,
    coalesce(p.strong >= 1 AND p.kinds >= 2, false) AS p_ok, coalesce(n.strong AND n.supporting, false) AS i_ok,
    coalesce(r.state_conflict, false) AS conflict, coalesce(r.state, '') AS r_state
  FROM heads h
  LEFT JOIN (SELECT store_id, sum(weight) AS score, count(DISTINCT kind) AS kinds, count(DISTINCT CASE WHEN strength = 'strong' THEN kind END) AS strong FROM platform GROUP BY store_id) p ON p.store_id = h.store_id
  LEFT JOIN (SELECT store_id, sum(weight) AS score, bool_or(strength = 'strong') AS strong, bool_or(strength = 'supporting') AS supporting FROM india GROUP BY store_id) n ON n.store_id = h.store_id
  LEFT JOIN resolved r ON r.store_id = h.store_id
),
verdicts AS (
  SELECT store_id, domain_url,
    CAST(CASE WHEN home_reason IS NULL THEN p_score ELSE 0 END AS INTEGER) AS shopify_score,
    CAST(CASE WHEN home_reason IS NULL THEN i_score ELSE 0 END AS INTEGER) AS india_score,
    CASE WHEN home_reason IS NULL THEN r_state ELSE '' END AS state,
    home_reason IS NULL AND p_ok AND i_ok AND NOT conflict AS accepted,
    coalesce(home_reason, concat_ws(';', CASE WHEN NOT p_ok THEN 'insufficient_shopify_evidence' END,
      CASE WHEN NOT i_ok THEN 'insufficient_india_evidence' END, CASE WHEN conflict THEN 'conflicting_state_evidence' END)) AS reasons
  FROM judged
)"""

EVIDENCE = ",".join((PAGES, GST, REGIONS, LD, INDIA, PLATFORM, VERDICT))


# --- contacts ------------------------------------------------------------------

FOOTER = strip("regexp_extract(body, '(?s)<footer>(.*?)</footer>', 1)")
CONTACTS = f"""
contacts AS (
  SELECT store_id, key, value, arg_min(final_url, page_seq) AS source_url FROM (
    SELECT store_id, page_seq, final_url, 'email' AS key, lower(unnest(regexp_extract_all(body, 'href="mailto:([^"?]+)', 1))) AS value FROM used
    UNION ALL SELECT store_id, page_seq, final_url, 'email', 'sales@store' || unnest(regexp_extract_all(body, 'sales .at. store([0-9]+) .dot. in', 1)) || '.in' FROM used WHERE role = 'home'
    UNION ALL SELECT store_id, page_seq, final_url, 'email', unnest(regexp_extract_all(t, '(care@[a-z0-9]+[.]in)', 1)) FROM txt WHERE role = 'contact'
    UNION ALL SELECT store_id, page_seq, final_url, 'email', unnest(regexp_extract_all(t, '(rights@[a-z0-9]+[.]in)', 1)) FROM txt WHERE role = 'legal'
    UNION ALL SELECT store_id, page_seq, final_url, 'phone', '+' || regexp_replace(unnest(regexp_extract_all(body, 'href="tel:([^"]+)', 1)), '[^0-9]', '', 'g') FROM used
    UNION ALL SELECT store_id, page_seq, final_url, 'phone', '+' || unnest(regexp_extract_all(body, 'href="https://wa.me/(91[0-9]+)"', 1)) FROM used
    UNION ALL SELECT store_id, page_seq, final_url, 'phone', regexp_replace(unnest(regexp_extract_all(t, '[+]91 [6-9][0-9]{{4}} [0-9]{{5}}')), ' ', '', 'g') FROM txt WHERE role IN ('contact', 'legal')
  ) GROUP BY store_id, key, value
),
social_links AS (
  SELECT store_id, page_seq, final_url, unnest(regexp_extract_all(body, 'href="(https://[^"]*)"', 1)) AS href FROM used
),
socials AS (
  SELECT store_id, key, value, arg_min(final_url, page_seq) AS source_url FROM (
    SELECT store_id, page_seq, final_url, 'instagram' AS key, 'https://instagram.com/' || regexp_extract(href, 'instagram.com/(store[0-9]+)', 1) AS value FROM social_links WHERE regexp_matches(href, 'instagram.com/store')
    UNION ALL SELECT store_id, page_seq, final_url, 'facebook', href FROM social_links WHERE regexp_matches(href, 'facebook.com/profile.php.id=[0-9]+')
    UNION ALL SELECT store_id, page_seq, final_url, 'x', href FROM social_links WHERE regexp_matches(href, '//x.com/store')
    UNION ALL SELECT store_id, page_seq, final_url, 'youtube', replace(href, 'www.', '') FROM social_links WHERE regexp_matches(href, 'youtube.com/@')
    UNION ALL SELECT store_id, page_seq, final_url, 'linkedin', regexp_extract(href, '(https://linkedin.com/company/[^/]+)', 1) FROM social_links WHERE regexp_matches(href, 'linkedin.com/company')
  ) GROUP BY store_id, key, value
)"""


# --- category, description, logo ----------------------------------------------------


def word_hits(text: str) -> str:
    """List of (category, hits) over lower-case text whose separators are doubled, so that
    neighbouring words do not share one."""
    terms = []
    for category, words in fv.CATEGORY_WORDS.items():
        parts = []
        for word in words:
            doubled = "".join(c if c.isascii() and c.isalnum() else f"{c}{c}" for c in word)
            pattern = "[^a-z0-9]" + doubled.replace(".", "[.]") + "[^a-z0-9]"
            parts.append(f"least(3, len(regexp_extract_all({text}, {quote(pattern)})))")
        terms.append(f"{{'category': {quote(category)}, 'hits': {' + '.join(parts)}}}")
    return f"unnest([{', '.join(terms)}])"


def doubled(text: str) -> str:
    return f"regexp_replace(' ' || lower({text}) || ' ', '([^a-z0-9])', '\\1\\1', 'g')"


META = "regexp_extract(body, '<meta name=\"description\" content=\"([^\"]*)\"', 1)"
COMMERCE = (
    "CASE WHEN role = 'home' THEN list_aggregate(list_transform(regexp_extract_all("
    "regexp_extract(body, '(?s)<header>(.*?)</header>', 1), '<a href=\"[^\"]*\">.*?</a>'), "
    "lambda a: " + strip("a") + " || ' ' || regexp_extract(a, 'href=\"([^\"]*)\"', 1)), 'string_agg', ' ') ELSE '' END"
)
MAIN = strip(
    "CASE WHEN contains(body, '<main>') THEN regexp_extract(body, '(?s)<main>(.*?)</main>', 1) "
    "ELSE regexp_extract(body, '(?s)<body[^>]*>(.*)</body>', 1) END"
)
HEADINGS = (
    strip("regexp_extract(body, '<title>(.*?)</title>', 1)") + " || ' ' || coalesce(list_aggregate(list_transform("
    "regexp_extract_all(body, '<h[12]>.*?</h[12]>'), lambda h: " + strip("h") + "), 'string_agg', ' '), '')"
)
RANKED_CATEGORY = sql_map(CATEGORY_INDEX)
CATEGORY = f"""
chunks AS (
  SELECT store_id, page_seq, final_url, role, 0 AS c, {META} AS body, CASE role WHEN 'home' THEN 50 ELSE 8 END AS weight FROM used
  UNION ALL SELECT store_id, page_seq, final_url, role, 1, {HEADINGS}, 6 FROM used
  UNION ALL SELECT store_id, page_seq, final_url, role, 2 + 4 * pos, category, 16 FROM ld_facts
  UNION ALL SELECT store_id, page_seq, final_url, role, 4 + 4 * pos, name, CASE type WHEN 'product' THEN 16 ELSE 5 END FROM ld_facts
  UNION ALL SELECT store_id, page_seq, final_url, role, 5 + 4 * pos, description, CASE type WHEN 'product' THEN 16 ELSE 5 END FROM ld_facts
  UNION ALL SELECT store_id, page_seq, final_url, role, 100, {COMMERCE}, 7 FROM used
  UNION ALL SELECT store_id, page_seq, final_url, role, 101, {MAIN}, 1 FROM used
),
chunk_hits AS (
  SELECT store_id, page_seq, final_url, {ROLE_RANK} AS rank, c, weight, {word_hits('d')} AS h
  FROM (SELECT *, {doubled('body')} AS d FROM chunks WHERE role <> 'legal' AND body IS NOT NULL)
),
chunk_points AS (
  SELECT store_id, h.category AS category, h.hits * weight AS points, final_url, rank * 1000000 + page_seq * 10000 + c AS ord
  FROM chunk_hits WHERE h.hits > 0
),
category_points AS (
  SELECT store_id, category, CAST(sum(points) AS BIGINT) AS points, arg_min(final_url, ord - points * 100000000) AS source_url,
    max(points) AS best, min(ord) AS first_ord
  FROM chunk_points GROUP BY store_id, category
)"""

DESCRIBES = f"length(d) >= 20 AND NOT {any_of('lower(d)', fv.DESCRIPTION_BOILERPLATE)}"
PARAGRAPH = strip("regexp_extract(body, '(?s)<main>.*?<p>(.*?)</p>', 1)")
FIELDS = f"""
described AS (
  SELECT store_id, arg_min(d, ord) AS description, arg_min(final_url, ord) AS description_source FROM (
    SELECT store_id, final_url, {META} AS d, ({ROLE_RANK}) * 100 + page_seq * 10 AS ord FROM used WHERE role NOT IN ('contact', 'legal')
    UNION ALL SELECT store_id, final_url, description, ({ROLE_RANK}) * 100 + page_seq * 10 + 1 FROM ld_facts WHERE role NOT IN ('contact', 'legal') AND type IN ('organization', 'store', 'brand', 'website')
    UNION ALL SELECT store_id, final_url, {PARAGRAPH}, 10000 + ({ROLE_RANK}) * 100 + page_seq * 10 FROM used WHERE role NOT IN ('contact', 'legal')
  ) WHERE {DESCRIBES} GROUP BY store_id
),
hints AS (
  SELECT store_id, h.category AS category, h.hits * 1000 AS points
  FROM (SELECT store_id, {word_hits(doubled('description'))} AS h FROM described) WHERE h.hits > 0
),
category_pick AS (
  SELECT store_id, category, source_url FROM (
    SELECT coalesce(p.store_id, n.store_id) AS store_id, coalesce(p.category, n.category) AS category,
      CASE WHEN n.points >= coalesce(p.best, 0) THEN home_url ELSE p.source_url END AS source_url,
      row_number() OVER (PARTITION BY coalesce(p.store_id, n.store_id) ORDER BY coalesce(p.points, 0) + coalesce(n.points, 0) DESC,
        CASE WHEN n.points IS NULL THEN p.first_ord ELSE -1 END, CAST({RANKED_CATEGORY}[coalesce(p.category, n.category)] AS INTEGER)) AS rn
    FROM category_points p FULL JOIN hints n ON n.store_id = p.store_id AND n.category = p.category
    LEFT JOIN heads h ON h.store_id = coalesce(p.store_id, n.store_id)
  ) WHERE rn = 1
),
logos AS (
  SELECT store_id, url, source FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY score DESC, ord) AS rn FROM (
      SELECT store_id, CASE WHEN left(logo, 1) = '/' THEN rtrim({PLAIN_URL}, '/') || logo ELSE logo END AS url, final_url AS source, 100 AS score, 0 AS ord
      FROM ld_facts WHERE logo IS NOT NULL AND type IN ('organization', 'store', 'brand')
      UNION ALL
      SELECT store_id, rtrim({PLAIN_URL}, '/') || src, final_url, 95 + CASE WHEN contains(src, 'logo') THEN 10 ELSE 0 END, 1
      FROM (SELECT *, regexp_extract(body, '<a href="/"><img (data-)?src="([^"]*)"', 2) AS src FROM used WHERE role = 'home') WHERE src <> '' AND NOT contains(src, 'product')
    )
  ) WHERE rn = 1
),
fields AS (
  SELECT h.store_id,
    CASE WHEN home_reason IS NULL THEN coalesce(description, '') ELSE '' END AS description,
    CASE WHEN home_reason IS NULL THEN coalesce(description_source, '') ELSE '' END AS description_source,
    CASE WHEN home_reason IS NULL THEN coalesce(url, '') ELSE '' END AS logo_url,
    CASE WHEN home_reason IS NULL THEN coalesce(source, '') ELSE '' END AS logo_source,
    CASE WHEN home_reason IS NULL THEN coalesce(category, 'general merchandise') ELSE '' END AS category,
    CASE WHEN home_reason IS NULL THEN coalesce(c.source_url, home_url) ELSE '' END AS category_source
  FROM heads h LEFT JOIN described d ON d.store_id = h.store_id LEFT JOIN category_pick c ON c.store_id = h.store_id
  LEFT JOIN logos l ON l.store_id = h.store_id
)"""
