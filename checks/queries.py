"""Every registered query: the Spark job over the given tables, and SQL for the same answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as i
from checks import sql as s
from vitrine import fixed_values as fv
from vitrine import schemas
from vitrine.functions import contacts, states, text, urls
from vitrine.operators import candidates as cand
from vitrine.operators import crawl_log, elements, links, reports, store_state, verdict
from vitrine.operators.parse import page_facts, parse_documents, raw_facts, usable_pages
from vitrine.operators.signals import region_states
from vitrine.operators.skew import running_total
from vitrine.plans import run as runs
from vitrine.plans import verify
from vitrine.session import shared_dir
from vitrine.sources import crawl as crawl_source
from vitrine.sources import seeds as seed_source
from vitrine.sources import sinks
from vitrine.streaming.incremental import verify_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(job: Query) -> Query:
        QUERIES[name] = job
        if sql is not None:
            SQL[name] = sql
        return job

    return register


def crawl_facts(spark: SparkSession, sf: str) -> DataFrame:
    return page_facts(usable_pages(i.crawl(spark, sf)))


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    return i.spread(i.table(spark, sf, "pages"), "page_id")


def parsed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return parse_documents(raw_pages(spark, sf), "html")


def joined(column: str) -> F.Column:
    return F.array_join(column, ";")


# --- verdicts and records --------------------------------------------------------

VERDICT_SQL = f"""WITH {s.EVIDENCE}
SELECT store_id, domain_url, shopify_score, india_score, state, accepted, reasons FROM verdicts"""


def _flat_verdicts(df: DataFrame, key: str = "store_id") -> DataFrame:
    return df.select(
        F.col(key).alias("store_id"), "domain_url", "shopify_score", "india_score", "state", "accepted",
        joined("rejection_reasons").alias("reasons"),
    )


@query("verify_stores", VERDICT_SQL)
def verify_stores(spark, sf):
    return _flat_verdicts(verify.verdicts(i.crawl(spark, sf), i.carts(spark, sf), i.dns(spark, sf)))


@query("latest_pages", VERDICT_SQL)
def latest_pages(spark, sf):
    """Older fetches of many pages, with other content, change no verdict."""
    now = i.crawl(spark, sf).withColumn("fetched_at", F.expr("timestamp '2024-02-01'"))
    older = now.where("store_id % 3 < 2").withColumns(
        {
            "fetched_at": F.expr("CASE WHEN store_id % 3 = 0 THEN timestamp '2024-01-01' END"),
            "body": F.lit("<body>GSTIN 24ABCDE1234F1Z5 <p>Enter using password</p></body>"),
            "status_code": F.lit(200),
            "robots_allowed": F.lit(True),
        }
    )
    return _flat_verdicts(verify.verdicts(now.unionByName(older), i.carts(spark, sf), i.dns(spark, sf)))


def _records(spark, sf):
    return verify.store_records(
        i.crawl(spark, sf),
        i.carts(spark, sf),
        i.dns(spark, sf),
        sources=cand.source_names(i.run(spark, sf, i.CANDIDATE_SOURCES, "customer")),
        images=i.images(spark, sf),
    )


RECORD_SQL = f"""WITH {s.EVIDENCE}, {s.CONTACTS}, {s.CATEGORY}, {s.FIELDS},
images AS ({i.IMAGES}),
usable_images AS (SELECT url FROM images WHERE robots_allowed AND status_code < 400 AND content_type LIKE 'image/%' AND n_bytes > 64),
sources AS (SELECT candidate_id, string_agg(DISTINCT source_name, ';' ORDER BY source_name) AS source_names FROM ({i.CANDIDATE_SOURCES}) GROUP BY 1),
provenance AS (SELECT store_id, string_agg(entry || '=' || source_url, ';' ORDER BY entry) AS provenance FROM (
  SELECT store_id, key || ':' || value AS entry, source_url FROM contacts
  UNION ALL SELECT store_id, 'social:' || key || ':' || value, source_url FROM socials
  UNION ALL SELECT store_id, 'description', description_source FROM fields WHERE description_source <> ''
  UNION ALL SELECT store_id, 'category', category_source FROM fields WHERE category_source <> ''
  UNION ALL SELECT store_id, 'logo', logo_source FROM fields WHERE logo_source <> '' AND logo_url IN (SELECT url FROM usable_images)) GROUP BY 1)
SELECT v.store_id, v.domain_url, v.shopify_score, v.india_score, v.state, v.accepted, v.reasons, f.category, f.description,
  CASE WHEN u.url IS NULL THEN '' ELSE f.logo_url END AS logo_url, coalesce(source_names, '') AS source_names,
  CASE WHEN home_reason IS NULL THEN coalesce(provenance, '') ELSE '' END AS provenance,
  CASE WHEN home_reason IS NULL THEN (SELECT redirected_from FROM crawl c WHERE c.store_id = v.store_id AND page_seq = 0) ELSE '' END AS redirects,
  {fv.EXTRACTION_VERSION} AS extraction_version,
  CASE WHEN home_reason IS NULL THEN coalesce((SELECT string_agg(value, ';' ORDER BY value) FROM contacts c WHERE c.store_id = v.store_id AND key = 'email'), '') ELSE '' END AS emails,
  CASE WHEN home_reason IS NULL THEN coalesce((SELECT string_agg(value, ';' ORDER BY value) FROM contacts c WHERE c.store_id = v.store_id AND key = 'phone'), '') ELSE '' END AS phones,
  CASE WHEN home_reason IS NULL THEN coalesce((SELECT string_agg(key || '=' || value, ';' ORDER BY key, value) FROM socials c WHERE c.store_id = v.store_id), '') ELSE '' END AS socials,
  CASE WHEN home_reason IS NULL THEN coalesce((SELECT string_agg(kind, ';' ORDER BY kind) FROM platform c WHERE c.store_id = v.store_id), '') ELSE '' END AS platform_kinds,
  CASE WHEN home_reason IS NULL THEN coalesce((SELECT string_agg(kind || '=' || value, ';' ORDER BY kind, value) FROM india c WHERE c.store_id = v.store_id), '') ELSE '' END AS india_items
FROM verdicts v JOIN heads h USING (store_id) JOIN fields f USING (store_id)
LEFT JOIN (SELECT DISTINCT url FROM usable_images) u ON u.url = f.logo_url
LEFT JOIN sources ON candidate_id = v.store_id LEFT JOIN provenance p ON p.store_id = v.store_id"""


@query("store_records", RECORD_SQL)
def store_records(spark, sf):
    pair = lambda k, v: F.concat_ws("=", k, v)
    profiles = F.flatten(
        F.transform(
            F.array_sort(F.map_entries("socials")),
            lambda e: F.transform(e["value"], lambda u: pair(e["key"], u)),
        )
    )
    return _records(spark, sf).select(
        F.col("candidate_id").alias("store_id"), "domain_url", "shopify_score", "india_score", "state", "accepted",
        joined("rejection_reasons").alias("reasons"), "category", "description", "logo_url",
        joined("source_names").alias("source_names"),
        F.array_join(F.transform(F.array_sort(F.map_entries("extraction_sources")), lambda e: pair(e["key"], e["value"])), ";").alias("provenance"),
        joined("redirect_history").alias("redirects"),
        "extraction_version",
        joined("contacts.emails").alias("emails"),
        joined("contacts.phones").alias("phones"),
        F.array_join(profiles, ";").alias("socials"),
        F.array_join(F.array_sort(F.transform("shopify_evidence", lambda e: e["kind"])), ";").alias("platform_kinds"),
        F.array_join(F.array_sort(F.transform("india_evidence", lambda e: pair(e["kind"], e["value"]))), ";").alias("india_items"),
    )


# --- candidates ----------------------------------------------------------------------

KEYED = f"""
seeds AS ({i.SEEDS}),
keyed AS (
  SELECT *, 'https://' || regexp_replace(lower(regexp_extract(source_value, '^[a-z]+://([^/:?#]+)', 1)), '^www[.]', '') AS candidate_key FROM seeds
)"""


@query(
    "candidate_import",
    f"""WITH {KEYED} SELECT candidate_key, regexp_extract(candidate_key, '([^./]+[.][^./]+)$', 1) AS registrable_domain,
    min(seq) AS discovered_seq, 'pending' AS status FROM keyed GROUP BY 1, 2""",
)
def candidate_import(spark, sf):
    seeds = i.run(spark, sf, i.SEEDS, "pages")
    return cand.clean_candidates(seeds).select("candidate_key", "registrable_domain", "discovered_seq", "status")


@query("candidate_sources", f"WITH {KEYED} SELECT DISTINCT candidate_key, source_name, source_value FROM keyed")
def candidate_sources(spark, sf):
    seeds = i.run(spark, sf, i.SEEDS, "pages")
    keys = cand.clean_candidates(seeds).select("candidate_id", "candidate_key")
    return cand.candidate_sources(seeds).join(keys, "candidate_id").select("candidate_key", "source_name", "source_value")


@query(
    "candidate_source_names",
    f"""WITH {KEYED} SELECT candidate_key, string_agg(DISTINCT source_name, ';' ORDER BY source_name) AS source_names
    FROM keyed GROUP BY 1""",
)
def candidate_source_names(spark, sf):
    seeds = i.run(spark, sf, i.SEEDS, "pages")
    keys = cand.clean_candidates(seeds).select("candidate_id", "candidate_key")
    named = cand.source_names(cand.candidate_sources(seeds))
    return named.join(keys, "candidate_id").select("candidate_key", joined("source_names").alias("source_names"))


@query(
    "import_counters",
    f"""WITH {KEYED}, firsts AS (SELECT candidate_key, arg_min(source_name, seq) AS source_name FROM keyed GROUP BY 1)
    SELECT e.source_name, coalesce(a.added, 0) AS added, e.eligible FROM (SELECT source_name, count(*) AS eligible FROM keyed GROUP BY 1) e
    LEFT JOIN (SELECT source_name, count(*) AS added FROM firsts GROUP BY 1) a USING (source_name)""",
)
def import_counters(spark, sf):
    return cand.import_counters(i.run(spark, sf, i.SEEDS, "pages"))


@query(
    "master_import",
    f"""SELECT 'https://' || regexp_replace(lower(domain), '^www[.]', '') AS candidate_key,
      regexp_replace(lower(domain), '^www[.]', '') AS registrable_domain, seq AS discovered_seq
    FROM ({i.MASTER}) m WHERE lower(trim(domain)) LIKE '%.in'
      AND contains(lower(concat_ws(' ', platform, technologies, ecom_verdict)), 'shopify')""",
)
def master_import(spark, sf):
    seeds = cand.master_seeds(i.run(spark, sf, i.MASTER, "customer"))
    return cand.clean_candidates(seeds).select("candidate_key", "registrable_domain", "discovered_seq")


@query(
    "incremental_import",
    f"""WITH {KEYED}, firsts AS (SELECT candidate_key, min(seq) AS discovered_seq FROM keyed GROUP BY 1)
    SELECT candidate_key, discovered_seq FROM firsts
    WHERE candidate_key NOT IN (SELECT candidate_key FROM keyed WHERE source_value LIKE '%/de/%')""",
)
def incremental_import(spark, sf):
    seeds = i.run(spark, sf, i.SEEDS, "pages")
    existing = cand.clean_candidates(seeds.where("source_value LIKE '%/de/%'"))
    return cand.clean_candidates(seeds, existing).select("candidate_key", "discovered_seq")


# --- URLs ----------------------------------------------------------------------------

CLEAN_QUERY = "regexp_replace(regexp_replace(url, '#.*$', ''), '[?&](utm_[a-z]+|ref|source|fbclid|gclid|mc_cid|mc_eid)=[^&#]*', '', 'g')"
NORMAL = (
    f"regexp_replace(regexp_replace(regexp_replace({CLEAN_QUERY}, '://www[.]', '://'), '/+([?]|$)', '\\1'), '(://[^/?]+)([?]|$)', '\\1/\\2')"
)


@query(
    "url_normalize",
    f"""SELECT page_id, n AS normalized, regexp_extract(n, '^[a-z]+://[^/?#]+') AS site_origin,
      regexp_extract(n, '://([^/:?#]+)', 1) AS host FROM (SELECT page_id, {NORMAL} AS n FROM pages) x""",
)
def url_normalize(spark, sf):
    return (
        i.table(spark, sf, "pages")
        .select("page_id", urls.normalize_url("url").alias("normalized"))
        .selectExpr("page_id", "normalized", f"{urls.origin('normalized')} AS site_origin", f"{urls.hostname('normalized')} AS host")
    )


@query(
    "registrable_domain",
    """SELECT host, count(*) AS n_pages, CASE WHEN regexp_matches(host, '[.]co[.]in$') THEN regexp_extract(host, '([^.]+[.]co[.]in)$', 1)
      ELSE regexp_extract(host, '([^.]+[.][^.]+)$', 1) END AS registrable_domain
    FROM (SELECT regexp_replace(lower(regexp_extract(url, '://([^/:?#]+)', 1)), '^www[.]', '') AS host FROM pages
      UNION ALL SELECT 'm.shop' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN '.co.in' ELSE '.in' END FROM customer) h GROUP BY 1""",
)
def registrable_domain(spark, sf):
    pages = i.table(spark, sf, "pages").select(urls.normalize_url("url").alias("u")).selectExpr(f"{urls.hostname('u')} AS host")
    shops = i.table(spark, sf, "customer").select(
        F.concat(F.lit("m.shop"), "c_custkey", F.when(F.col("c_custkey") % 2 == 0, ".co.in").otherwise(".in")).alias("host")
    )
    hosts = pages.unionByName(shops).groupBy("host").agg(F.count("*").alias("n_pages"))
    return urls.with_registrable_domain(hosts, "host", urls.default_suffixes(spark))


@query("page_roles", f"SELECT role, count(*) AS n FROM (SELECT {s.role('url')} AS role FROM pages UNION ALL SELECT {s.role('final_url')} FROM ({i.CRAWL}) c) r GROUP BY 1")
def page_roles(spark, sf):
    listed = i.table(spark, sf, "pages").select("url")
    crawled = i.run(spark, sf, i.CRAWL, "customer").select(F.col("final_url").alias("url"))
    return listed.unionByName(crawled).groupBy(F.expr(urls.page_role("url")).alias("role")).agg(F.count("*").alias("n"))


# --- parsed pages ------------------------------------------------------------------------

UNESCAPED = "{0}"
for _entity, _char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''")):
    UNESCAPED = f"replace({UNESCAPED}, '{_entity}', '{_char}')"
UNESCAPED = f"regexp_replace({UNESCAPED}, '&amp;?', '&', 'g')"  # titles are cut anywhere, also before the semicolon


@query("page_text", f"SELECT page_id, {UNESCAPED.format(s.strip('html'))} AS text FROM pages")
def page_text(spark, sf):
    return parsed_pages(spark, sf).select("page_id", "text")


@query(
    "page_headings",
    f"""SELECT page_id, {UNESCAPED.format(s.strip("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS title,
      {UNESCAPED.format("coalesce(list_aggregate(list_transform(regexp_extract_all(html, '(?s)<h[12]>.*?</h[12]>'), lambda h: " + s.strip("h") + "), 'string_agg', ' '), '')")} AS headings
    FROM pages""",
)
def page_headings(spark, sf):
    return elements.page_headings(parsed_pages(spark, sf), "page_id")


@query(
    "page_links",
    f"""SELECT page_id, href, label, regexp_extract(url, '^[a-z]+://[^/?#]+') AS base, pos FROM (
      SELECT page_id, url, unnest(range(0, len(a))) AS pos, unnest(list_transform(a, lambda x: regexp_extract(x, 'href="([^"]*)"', 1))) AS href,
        unnest(list_transform(a, lambda x: {UNESCAPED.format(s.strip('x'))})) AS label
      FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<a href="[^"]*">.*?</a>') AS a FROM pages))""",
)
def page_links(spark, sf):
    facts = parsed_pages(spark, sf)
    return elements.page_links(facts, "page_id", "url").select(
        "page_id", "href", "label", F.regexp_extract("url", "^[a-z]+://[^/?#]+", 0).alias("base"), F.col("pos").cast("bigint").alias("pos")
    )


@query(
    "resolved_links",
    f"""SELECT DISTINCT page_id, rtrim(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+'), '://www[.]', '://') || regexp_replace(href, '#.*$', ''), '/') AS target
    FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)"', 1)) AS href FROM pages) l""",
)
def resolved_links(spark, sf):
    found = elements.page_links(parsed_pages(spark, sf), "page_id", "url").where(F.col("href").startswith("/"))
    return found.select("page_id", urls.normalize_url("href", "url").alias("target")).distinct()


@query(
    "json_ld_facts",
    f"WITH {s.PAGES}, {s.LD} SELECT store_id, page_seq, pos, type, logo, description, category, name, address, country, region FROM ld_facts",
)
def json_ld_facts(spark, sf):
    return elements.json_ld_rows(crawl_facts(spark, sf), "store_id", "page_seq").drop("product_type")


@query(
    "meta_description",
    f"""WITH {s.PAGES} SELECT store_id, page_seq, d AS description, {s.any_of('lower(d)', fv.DESCRIPTION_BOILERPLATE)} AS is_boilerplate
    FROM (SELECT store_id, page_seq, {s.META} AS d FROM used) WHERE d <> ''""",
)
def meta_description(spark, sf):
    found = crawl_facts(spark, sf).select("store_id", "page_seq", F.expr(elements.meta_description()).alias("description"))
    return found.where("description IS NOT NULL").withColumn("is_boilerplate", F.expr(text.is_boilerplate_description("description")))


@query(
    "image_facts",
    f"""WITH {s.PAGES} SELECT store_id, page_seq, count(*) AS n_images, count(*) FILTER (WHERE contains(i, 'alt="Store mark"') OR contains(i, 'site-logo')) AS n_marks
    FROM (SELECT store_id, page_seq, unnest(regexp_extract_all(body, '<img [^>]*>')) AS i FROM used) GROUP BY 1, 2""",
)
def image_facts(spark, sf):
    images = elements.rows_of(crawl_facts(spark, sf), ("store_id", "page_seq"), f"{elements.tagged('img')}", "e")
    marked = F.expr(f"{elements.attr('e', 'alt')} = 'Store mark' OR {elements.attr('e', 'class')} = 'site-logo'")
    return images.groupBy("store_id", "page_seq").agg(F.count("*").alias("n_images"), F.count_if(marked).alias("n_marks"))


@query(
    "contact_regions",
    f"""WITH {s.PAGES} SELECT DISTINCT store_id, page_seq, region FROM (
      SELECT store_id, page_seq, {s.strip("unnest(regexp_extract_all(body, '(?s)<footer>(.*?)</footer>', 1))")} AS region FROM used
      UNION ALL SELECT store_id, page_seq, {s.strip("unnest(regexp_extract_all(body, '(?s)<address>(.*?)</address>', 1))")} FROM used
      UNION ALL SELECT store_id, page_seq, t FROM txt WHERE role = 'contact'
      UNION ALL SELECT store_id, page_seq, substr(t, greatest(1, p - 120), p + n + 600 - greatest(1, p - 120)) FROM (
        SELECT store_id, page_seq, t, p, length(regexp_extract(lower(substr(t, p, 12)), '^(contact us|e-?mail us|grievance|complaint|by mail|mailing us)')) AS n
        FROM (SELECT store_id, page_seq, t, unnest(range(1, length(t) + 1)) AS p FROM txt WHERE role = 'legal')) WHERE n > 0
    ) WHERE region <> ''""",
)
def contact_regions(spark, sf):
    return elements.region_rows(crawl_facts(spark, sf), "store_id", "page_seq").select("store_id", "page_seq", "region").distinct()


# --- links ------------------------------------------------------------------------------

LINK_SCORE = " + ".join(f"CASE WHEN contains(label, {s.quote(w)}) THEN {n} ELSE 0 END" for w, n in fv.LINK_WORD_SCORES.items())
LINKS = f"""{s.PAGES},
anchors AS (
  SELECT store_id, final_url, rtrim({s.PLAIN_URL}, '/') AS site, unnest(range(0, len(a))) AS pos, unnest(a) AS x
  FROM (SELECT *, regexp_extract_all(body, '(?s)<a href="[^"]*">.*?</a>') AS a FROM used WHERE page_seq = 0)
),
scored AS (
  SELECT *, {LINK_SCORE} AS score FROM (SELECT *, regexp_extract(x, 'href="([^"]*)"', 1) AS href,
    lower({s.strip('x')} || ' ' || regexp_extract(x, 'href="([^"]*)"', 1)) AS label FROM anchors)
),
linked AS (
  SELECT store_id, url, arg_min(score, pos) AS score, min(pos) AS pos, {s.role('url')} AS role
  FROM (SELECT store_id, pos, score, site || regexp_replace(href, '[?].*$', '') AS url FROM scored WHERE score > 0 AND left(href, 1) = '/') GROUP BY store_id, url
),
per_role AS (SELECT *, row_number() OVER (PARTITION BY store_id, role ORDER BY score DESC, length(url), pos) AS rn FROM linked),
chosen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY score DESC, length(url), pos) AS rank
    FROM per_role WHERE rn <= CASE role WHEN 'about' THEN 1 WHEN 'home' THEN 0 ELSE 2 END) WHERE rank <= 6
),
defaults AS (SELECT * FROM (VALUES (0, 'contact', '/pages/contact'), (1, 'contact', '/pages/contact-us'), (2, 'about', '/pages/about-us'), (3, 'legal', '/policies/privacy-policy')) d(o, role, path)),
missing AS (
  SELECT h.store_id, h.site || d.path AS url, d.role, d.o FROM (SELECT store_id, rtrim({s.PLAIN_URL}, '/') AS site FROM used WHERE page_seq = 0) h, defaults d
  WHERE NOT EXISTS (SELECT 1 FROM chosen c WHERE c.store_id = h.store_id AND c.role = d.role)
    AND NOT EXISTS (SELECT 1 FROM linked l WHERE l.store_id = h.store_id AND l.url = h.site || d.path)
),
all_links AS (
  SELECT store_id, url, role, score, rank, false AS is_default FROM chosen
  UNION ALL
  SELECT m.store_id, m.url, m.role, 0, coalesce(n, 0) + row_number() OVER (PARTITION BY m.store_id ORDER BY o), true
  FROM missing m LEFT JOIN (SELECT store_id, count(*) AS n FROM chosen GROUP BY 1) c ON c.store_id = m.store_id
)"""


@query("ranked_links", f"WITH {LINKS} SELECT store_id, CAST(rank AS INTEGER) AS rank, url, role, CAST(score AS INTEGER) AS score FROM all_links WHERE NOT is_default")
def ranked_links(spark, sf):
    found = links.ranked_links(crawl_facts(spark, sf).where("page_seq = 0"))
    return found.where("NOT is_default").drop("is_default")


@query("missing_role_links", f"WITH {LINKS} SELECT store_id, CAST(rank AS INTEGER) AS rank, url, role FROM all_links WHERE is_default AND rank <= 6")
def missing_role_links(spark, sf):
    found = links.ranked_links(crawl_facts(spark, sf).where("page_seq = 0"))
    return found.where("is_default").drop("is_default", "score")


# --- e-mails and phones ---------------------------------------------------------------------

TEXTS = f"texts AS (SELECT 'document' AS origin, doc_id AS id, text FROM documents UNION ALL SELECT 'page', store_id * 4 + page_seq, t FROM txt)"
MAIL_TOKEN = "^[^A-Za-z0-9]*([A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+[.][A-Za-z]{2,})[.]*$"
PLACEHOLDER = (
    "(" + " OR ".join(f"starts_with(email, {s.quote(p)})" for p in fv.EMAIL_BLOCKED_PREFIXES)
    + " OR " + " OR ".join(f"ends_with(email, {s.quote(p)})" for p in fv.EMAIL_BLOCKED_SUFFIXES) + ")"
)


def texts(spark, sf) -> DataFrame:
    documents = i.spread(i.table(spark, sf, "documents"), "doc_id").select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text")
    pages = crawl_facts(spark, sf).select(F.lit("page").alias("origin"), (F.col("store_id") * 4 + F.col("page_seq")).alias("id"), "text")
    return documents.unionByName(pages)


@query(
    "emails",
    f"""WITH {s.PAGES}, {TEXTS}, tokens AS (SELECT origin, id, unnest(string_split_regex(text, '[^A-Za-z0-9_.%+@-]+')) AS w FROM texts),
    found AS (SELECT DISTINCT origin, id, rtrim(lower(regexp_extract(w, '{MAIL_TOKEN}', 1)), '.') AS email FROM tokens WHERE regexp_matches(w, '{MAIL_TOKEN}'))
    SELECT origin, id, email, {PLACEHOLDER} AS is_placeholder FROM found""",
)
def emails(spark, sf):
    found = elements.rows_of(texts(spark, sf), ("origin", "id"), f"array_distinct({contacts.plain_emails('text')})", "email")
    return found.withColumn("is_placeholder", F.expr(contacts.is_placeholder_email("email")))


@query(
    "obfuscated_emails",
    f"""WITH {s.PAGES} SELECT store_id, page_seq, 'sales@store' || unnest(regexp_extract_all(t, 'sales .at. store([0-9]+) .dot. in', 1)) || '.in' AS email FROM txt""",
)
def obfuscated_emails(spark, sf):
    return elements.rows_of(crawl_facts(spark, sf), ("store_id", "page_seq"), f"{contacts.spelled_emails('text')}", "email")


PHONE_RUN = contacts.PHONE_RUN
E164 = f"""CASE WHEN regexp_matches(run, '{contacts.TOUCHED_RUN}') THEN NULL
  WHEN left(run, 1) = '+' AND left(d, 1) = '0' THEN NULL
  WHEN left(run, 1) = '+' OR left(d, 2) = '00' THEN CASE
    WHEN regexp_full_match(ltrim(d, '0'), '{contacts.INDIAN_NUMBER}') THEN '+' || ltrim(d, '0')
    WHEN regexp_matches(ltrim(d, '0'), '{contacts.KNOWN_CODE}') AND NOT regexp_matches(ltrim(d, '0'), '{contacts.KNOWN_NUMBER}') THEN NULL
    WHEN regexp_full_match(ltrim(d, '0'), '{contacts._FOREIGN}') THEN '+' || ltrim(d, '0') END
  WHEN regexp_full_match(d, '0?[6-9][0-9]{{9}}') THEN '+91' || ltrim(d, '0')
  WHEN regexp_full_match(d, '91[6-9][0-9]{{9}}') THEN '+' || d
  WHEN regexp_full_match(d, '{contacts.SERVICE_NUMBER}') THEN '+91' || d
  WHEN regexp_full_match(d, '0[1-5][0-9]{{9}}') THEN '+91' || ltrim(d, '0') END"""


@query(
    "phones_in",
    f"""WITH {s.PAGES}, {TEXTS},
    runs AS (SELECT origin, id, unnest(regexp_extract_all(text, '{PHONE_RUN}')) AS run FROM texts),
    whole AS (SELECT origin, id, run, {E164} AS phone FROM (SELECT *, regexp_replace(run, '[^0-9]', '', 'g') AS d FROM runs)),
    words AS (SELECT origin, id, run, regexp_replace(run, '[^0-9]', '', 'g') AS d
      FROM (SELECT origin, id, unnest(regexp_extract_all(run, '{contacts.NUMBER_IN_RUN}')) AS run FROM whole WHERE phone IS NULL))
    SELECT DISTINCT origin, id, phone FROM (SELECT origin, id, phone FROM whole UNION ALL SELECT origin, id, {E164} FROM words) WHERE phone IS NOT NULL""",
)
def phones_in(spark, sf):
    return elements.rows_of(texts(spark, sf), ("origin", "id"), f"{contacts.extract_phones('text')}", "phone")


@query("contacts_by_store", f"WITH {s.PAGES}, {s.CONTACTS} SELECT store_id, key, value, source_url FROM contacts")
def contacts_by_store(spark, sf):
    return verdict.store_contacts(crawl_facts(spark, sf))


@query("socials_by_store", f"WITH {s.PAGES}, {s.CONTACTS} SELECT store_id, key, value, source_url FROM socials")
def socials_by_store(spark, sf):
    return verdict.store_socials(crawl_facts(spark, sf))


@query(
    "first_provenance",
    f"""WITH {s.PAGES}, {s.CONTACTS} SELECT store_id, key || ':' || value AS entry, source_url FROM contacts
    UNION ALL SELECT store_id, 'social:' || key || ':' || value, source_url FROM socials""",
)
def first_provenance(spark, sf):
    return verdict.first_provenance(crawl_facts(spark, sf))


# --- states ----------------------------------------------------------------------------------


@query("gstin_states", f"WITH {s.PAGES}, {s.GST} SELECT store_id, page_seq, gstin, coalesce({s.GST_MAP}[left(gstin, 2)], '') AS state FROM gst")
def gstin_states(spark, sf):
    found = elements.rows_of(crawl_facts(spark, sf), ("store_id", "page_seq"), f"{states.find_gstins('text')}", "gstin")
    return found.withColumn("state", F.expr(states.state_from_gstin("gstin")))


@query("pin_states", f"WITH {s.PAGES}, found AS (SELECT store_id, page_seq, unnest({s.pins('t')}) AS pin FROM txt) SELECT store_id, page_seq, pin, {s.pin_state('pin')} AS state FROM found")
def pin_states(spark, sf):
    found = elements.rows_of(crawl_facts(spark, sf), ("store_id", "page_seq"), f"{states.find_pins('text')}", "pin")
    return found.withColumn("state", F.expr(states.state_from_pin("pin")))


@query("state_names", f"WITH {s.PAGES} SELECT store_id, page_seq, unnest({s.named_states('t')}) AS state FROM txt")
def state_names(spark, sf):
    return elements.rows_of(crawl_facts(spark, sf), ("store_id", "page_seq"), f"{states.find_states('text')}", "state")


@query(
    "region_states",
    f"WITH {s.PAGES}, {s.REGIONS} SELECT store_id, page_seq, state, max(score) AS score FROM region_states WHERE state IS NOT NULL GROUP BY 1, 2, 3",
)
def region_state_rows(spark, sf):
    rows = elements.rows_of(crawl_facts(spark, sf), ("store_id", "page_seq"), f"{region_states()}", "r").select("store_id", "page_seq", "r.*")
    return rows.groupBy("store_id", "page_seq", "state").agg(F.max("score").alias("score"))


@query("state_resolution", f"WITH {s.PAGES}, {s.GST}, {s.REGIONS}, {s.LD}, {s.INDIA} SELECT store_id, state, CAST(state_score AS BIGINT) AS state_score, state_conflict FROM resolved")
def state_resolution(spark, sf):
    return verdict.state_resolution(crawl_facts(spark, sf))


# --- evidence ---------------------------------------------------------------------------------


@query("platform_evidence", f"WITH {s.PAGES}, {s.PLATFORM} SELECT store_id, kind, value, source_url, weight, strength FROM platform")
def platform_evidence(spark, sf):
    return verdict.platform_evidence(raw_facts(i.crawl(spark, sf)), i.carts(spark, sf), i.dns(spark, sf))


@query("india_evidence", f"WITH {s.PAGES}, {s.GST}, {s.REGIONS}, {s.LD}, {s.INDIA} SELECT store_id, kind, value, source_url, weight, strength FROM india")
def india_evidence(spark, sf):
    return verdict.india_evidence(crawl_facts(spark, sf))


@query(
    "evidence_scores",
    f"""WITH {s.EVIDENCE} SELECT shopify_score, india_score, accepted, count(*) AS n FROM verdicts GROUP BY 1, 2, 3""",
)
def evidence_scores(spark, sf):
    return verify_stores(spark, sf).groupBy("shopify_score", "india_score", "accepted").agg(F.count("*").alias("n"))


@query(
    "host_facts",
    f"""WITH carts AS ({i.CARTS}), dns AS ({i.DNS}) SELECT host, {s.CART_OK} AS cart_ok,
      CASE WHEN rtrim(lower(cname), '.') LIKE '%shops.myshopify.com' THEN cname END AS platform_cname FROM carts JOIN dns USING (host)""",
)
def host_facts(spark, sf):
    return verdict.host_facts(i.carts(spark, sf), i.dns(spark, sf))


# --- fields ------------------------------------------------------------------------------------


@query("category_points", f"WITH {s.PAGES}, {s.LD}, {s.CATEGORY} SELECT store_id, category, points, source_url FROM category_points")
def category_points(spark, sf):
    return verdict.category_points(crawl_facts(spark, sf))


FIELD_CTES = f"{s.PAGES}, {s.LD}, {s.CATEGORY}, {s.FIELDS}"


@query("category_top1", f"WITH {FIELD_CTES} SELECT store_id, category, category_source FROM fields")
def category_top1(spark, sf):
    return verdict.store_fields(crawl_facts(spark, sf), "category")


@query("description_pick", f"WITH {FIELD_CTES} SELECT store_id, description, description_source FROM fields")
def description_pick(spark, sf):
    return verdict.store_fields(crawl_facts(spark, sf), "description")


@query("logo_pick", f"WITH {FIELD_CTES} SELECT store_id, logo_url, logo_source FROM fields")
def logo_pick(spark, sf):
    return verdict.store_fields(crawl_facts(spark, sf), "logo")


@query(
    "valid_images",
    f"SELECT url FROM ({i.IMAGES}) x WHERE robots_allowed AND status_code < 400 AND content_type LIKE 'image/%' AND n_bytes > 64",
)
def valid_images(spark, sf):
    return i.images(spark, sf).where(verdict.valid_image()).select("url")


@query(
    "unusable_homes",
    f"WITH {s.PAGES} SELECT store_id, home_reason FROM heads WHERE home_reason IS NOT NULL",
)
def unusable_homes(spark, sf):
    raw = raw_facts(i.crawl(spark, sf).where("page_seq = 0"))
    return raw.select("store_id", "head.home_reason").where("home_reason IS NOT NULL")


@query(
    "rejection_reasons",
    f"WITH {s.EVIDENCE} SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM verdicts WHERE NOT accepted) GROUP BY 1",
)
def rejection_reasons(spark, sf):
    return reports.rejection_histogram(verify.verdicts(i.crawl(spark, sf), i.carts(spark, sf), i.dns(spark, sf)))


# --- reports over the store table -----------------------------------------------------------------

STORES = f"""
stores AS (SELECT *, rtrim(lower(domain_url), '/') AS dkey FROM ({i.STORES})),
uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dkey ORDER BY shopify_score + india_score DESC, candidate_id) AS rn FROM stores WHERE accepted) WHERE rn = 1)"""


def unique(spark, sf) -> DataFrame:
    return reports.unique_domains(i.stores(spark, sf))


@query("unique_domains", f"WITH {STORES} SELECT candidate_id, domain_url, shopify_score, india_score, state, category FROM uniq")
def unique_domains(spark, sf):
    return unique(spark, sf).select("candidate_id", "domain_url", "shopify_score", "india_score", "state", "category")


@query("status_counts", f"SELECT status, count(*) AS n FROM ({i.CANDIDATES}) GROUP BY 1")
def status_counts(spark, sf):
    return reports.status_counts(i.run(spark, sf, i.CANDIDATES, "customer"))


@query("unique_domain_count", f"WITH {STORES} SELECT count(*) AS unique_accepted_domains FROM uniq")
def unique_domain_count(spark, sf):
    return reports.unique_domain_count(i.stores(spark, sf))


@query(
    "status_view",
    f"WITH {STORES} SELECT status, count(*) AS n FROM ({i.CANDIDATES}) GROUP BY 1 UNION ALL SELECT 'unique_accepted_domains', count(*) FROM uniq",
)
def status_view(spark, sf):
    return reports.status_view(i.run(spark, sf, i.CANDIDATES, "customer"), i.stores(spark, sf))


@query(
    "quality_missing",
    f"""WITH {STORES}, cells AS (
      SELECT unnest(['contacts', 'socials', 'category', 'description', 'logo_url', 'state']) AS field,
        unnest([email = '' AND phone = '', profile = '', category = '', description = '', logo_url = '', state = '']) AS gone FROM uniq)
    SELECT field, count(*) FILTER (WHERE gone) AS missing, round(count(*) FILTER (WHERE gone) * 100 / CAST(count(*) AS DOUBLE), 2) AS percent FROM cells GROUP BY 1""",
)
def quality_missing(spark, sf):
    return reports.missing_fields(unique(spark, sf))


@query(
    "source_yield",
    f"""WITH {STORES} SELECT source, count(*) AS seen, count(*) FILTER (WHERE accepted) AS accepted
    FROM (SELECT accepted, unnest(CASE WHEN sources = '' THEN ['unattributed'] ELSE string_split(sources, ';') END) AS source FROM stores) GROUP BY 1""",
)
def source_yield(spark, sf):
    return reports.source_yield(i.stores(spark, sf))


@query("state_distribution", f"WITH {STORES} SELECT CASE state WHEN '' THEN 'missing' ELSE state END AS state, count(*) AS n FROM uniq GROUP BY 1")
def state_distribution(spark, sf):
    return reports.distribution(unique(spark, sf), "state")


@query("category_distribution", f"WITH {STORES} SELECT CASE category WHEN '' THEN 'missing' ELSE category END AS category, count(*) AS n FROM uniq GROUP BY 1")
def category_distribution(spark, sf):
    return reports.distribution(unique(spark, sf), "category")


@query(
    "confidence_stats",
    f"""WITH {STORES} SELECT round(avg(shopify_score), 2) AS average_shopify_score, round(avg(india_score), 2) AS average_india_score,
      min(shopify_score) AS minimum_shopify_score, min(india_score) AS minimum_india_score FROM uniq""",
)
def confidence_stats(spark, sf):
    return reports.confidence_stats(unique(spark, sf))


@query(
    "report_counters",
    f"""WITH {STORES} SELECT (SELECT count(*) FROM stores) AS processed_records, (SELECT count(*) FROM uniq) AS accepted_records,
      (SELECT count(*) FROM stores WHERE accepted) AS accepted_candidate_records,
      (SELECT count(*) FROM stores WHERE accepted) - (SELECT count(*) FROM uniq) AS redirect_duplicates_removed""",
)
def report_counters(spark, sf):
    return reports.report_counters(i.stores(spark, sf))


@query(
    "store_rejections",
    f"""WITH {STORES} SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM stores WHERE NOT accepted) GROUP BY 1""",
)
def store_rejections(spark, sf):
    return reports.rejection_histogram(i.stores(spark, sf))


JSON_LIST = "'[' || CASE {0} WHEN '' THEN '' ELSE '\"' || {0} || '\"' END || ']'"


@query(
    "export_rows",
    f"""WITH {STORES} SELECT domain_url, '{{"emails":' || {JSON_LIST.format('email')} || ',"phones":' || {JSON_LIST.format('phone')} || '}}' AS contacts,
      CASE profile WHEN '' THEN '{{}}' ELSE '{{"instagram":["' || profile || '"]}}' END AS socials, category, description, logo_url, state FROM uniq""",
)
def export_rows(spark, sf):
    return reports.export_rows(unique(spark, sf))


@query(
    "quality_report",
    f"""WITH {STORES}, reasons AS (SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM stores WHERE NOT accepted) GROUP BY 1)
    SELECT (SELECT count(*) FROM stores) AS processed_records, (SELECT count(*) FROM uniq) AS accepted_records,
      (SELECT string_agg(status || '=' || n, ';' ORDER BY status) FROM (SELECT status, count(*) AS n FROM ({i.CANDIDATES}) GROUP BY 1)) AS statuses,
      (SELECT string_agg(reason || '=' || n, ';' ORDER BY reason) FROM reasons) AS reasons,
      (SELECT string_agg(state || '=' || n, ';' ORDER BY state) FROM (SELECT CASE state WHEN '' THEN 'missing' ELSE state END AS state, count(*) AS n FROM uniq GROUP BY 1)) AS states,
      (SELECT round(count(*) FILTER (WHERE profile = '') * 100 / CAST(count(*) AS DOUBLE), 2) FROM uniq) AS socials_missing_percent,
      (SELECT count(*) FROM stores WHERE contains(sources, 'list_a') AND accepted) AS list_a_accepted,
      (SELECT round(avg(india_score), 2) FROM uniq) AS average_india_score, (SELECT min(shopify_score) FROM uniq) AS minimum_shopify_score,
      (SELECT count(*) FROM ({i.WORKSHEET}) w WHERE trim(shopify_correct) <> '' AND trim(india_correct) <> '') AS reviewed""",
)
def quality_report(spark, sf):
    report = reports.quality_report(
        i.run(spark, sf, i.CANDIDATES, "customer"), i.stores(spark, sf), i.run(spark, sf, i.WORKSHEET, "customer")
    )
    shown = lambda m: f"array_join(transform(map_entries({m}), e -> concat(e.key, '=', e.value)), ';')"
    return report.selectExpr(
        "processed_records", "accepted_records", f"{shown('candidate_status_counts')} AS statuses",
        f"{shown('rejection_reasons')} AS reasons", f"{shown('state_distribution')} AS states",
        "missing_fields['socials'].percent AS socials_missing_percent", "source_yield['list_a'].accepted AS list_a_accepted",
        "confidence.average_india_score", "cast(confidence.minimum_shopify_score AS int) AS minimum_shopify_score", "manual_audit.reviewed",
    )


@query(
    "audit_sample",
    f"""WITH {STORES}, drawn AS (SELECT *, CASE state WHEN '' THEN 'missing' ELSE state END AS stratum,
      CASE WHEN shopify_score + india_score >= 15 THEN 'high' ELSE 'threshold' END AS band, md5('20261002:' || domain_url || ':' || CAST(candidate_id AS VARCHAR)) AS draw FROM uniq),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum, band ORDER BY draw) AS round FROM drawn)
    SELECT domain_url, category, state, sources AS source_names, shopify_score, india_score, '' AS reviewer_notes
    FROM ranked ORDER BY round, md5('20261002:' || stratum || ':' || band), draw LIMIT 100""",
)
def audit_sample(spark, sf):
    sheet = reports.worksheet_rows(reports.audit_sample(unique(spark, sf), 100, 20261002))
    return sheet.select("domain_url", "category", "state", "source_names", "shopify_score", "india_score", "reviewer_notes")


@query(
    "audit_strata",
    f"""WITH {STORES} SELECT CASE state WHEN '' THEN 'missing' ELSE state END AS state,
      CASE WHEN shopify_score + india_score >= 15 THEN 'high' ELSE 'threshold' END AS confidence, count(*) AS n FROM uniq GROUP BY 1, 2""",
)
def audit_strata(spark, sf):
    state = F.when(F.col("state") == "", "missing").otherwise(F.col("state"))
    return unique(spark, sf).groupBy(state.alias("state"), reports.confidence_band().alias("confidence")).agg(F.count("*").alias("n"))


YES = "lower(trim({0})) IN ('yes', 'y', 'true', '1')"


@query(
    "audit_precision",
    f"""SELECT CASE WHEN n = 0 THEN 'not_reviewed' WHEN p / n >= 0.95 AND c / n >= 0.95 THEN 'pass' ELSE 'fail' END AS status, n AS reviewed,
      round(CAST(p AS DOUBLE) / n * 100, 2) AS shopify_precision_percent, round(CAST(c AS DOUBLE) / n * 100, 2) AS india_precision_percent,
      CAST(95 AS DOUBLE) AS required_precision_percent
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {YES.format('shopify_correct')}) AS p, count(*) FILTER (WHERE {YES.format('india_correct')}) AS c
      FROM ({i.WORKSHEET}) w WHERE trim(shopify_correct) <> '' AND trim(india_correct) <> '') x""",
)
def audit_precision(spark, sf):
    return reports.audit_precision(i.run(spark, sf, i.WORKSHEET, "customer"))


@query(
    "field_accuracy",
    f"""SELECT field, count(*) AS reviewed, round(count(*) FILTER (WHERE {YES.format('rating')}) * 100 / CAST(count(*) AS DOUBLE), 2) AS accuracy_percent
    FROM (SELECT unnest(['contacts', 'socials', 'category', 'description', 'logo', 'state']) AS field,
      unnest([contacts_correct, socials_correct, category_correct, description_correct, logo_correct, state_correct]) AS rating FROM ({i.WORKSHEET}) w) c
    WHERE trim(rating) <> '' GROUP BY 1""",
)
def field_accuracy(spark, sf):
    return reports.field_accuracy(i.run(spark, sf, i.WORKSHEET, "customer"))


# --- store state -------------------------------------------------------------------------------------


@query(
    "pending_by_source",
    f"""SELECT candidate_id, candidate_key, status FROM ({i.CANDIDATES}) c WHERE status IN ('pending', 'retry')
    AND candidate_id IN (SELECT candidate_id FROM ({i.CANDIDATE_SOURCES}) WHERE source_name = 'list_b')""",
)
def pending_by_source(spark, sf):
    found = cand.pending_candidates(i.run(spark, sf, i.CANDIDATES, "customer"), i.run(spark, sf, i.CANDIDATE_SOURCES, "customer"), "list_b")
    return found.select("candidate_id", "candidate_key", "status")


@query("work_batch", f"SELECT candidate_id, status FROM ({i.CANDIDATES}) WHERE status IN ('pending', 'retry') ORDER BY discovered_seq LIMIT 40")
def work_batch(spark, sf):
    return cand.work_batch(i.run(spark, sf, i.CANDIDATES, "customer")).select("candidate_id", "status")


@query(
    "accepted_candidates",
    f"""WITH {STORES} SELECT candidate_id, candidate_key, status, domain_url FROM ({i.CANDIDATES}) c JOIN stores USING (candidate_id) WHERE accepted""",
)
def accepted_candidates(spark, sf):
    found = store_state.candidates_with_records(i.run(spark, sf, i.CANDIDATES, "customer"), i.stores(spark, sf), accepted_only=True)
    return found.select("candidate_id", "candidate_key", "status", "domain_url")


@query(
    "confidence_order",
    f"WITH {STORES} SELECT candidate_id, shopify_score + india_score AS score FROM stores WHERE accepted ORDER BY 2 DESC, 1",
)
def confidence_order(spark, sf):
    ordered = store_state.by_confidence(i.stores(spark, sf))
    return ordered.select("candidate_id", (F.col("shopify_score") + F.col("india_score")).alias("score"))


def _newer(stores: DataFrame) -> DataFrame:
    """A second write of some stores: older for some, later for others, plus unknown ids."""
    shift = F.when(F.col("candidate_id") % 3 == 0, -500).otherwise(500)
    return stores.where("candidate_id % 4 = 1").select(
        *[
            F.timestamp_micros(F.unix_micros("checked_at") + shift).alias("checked_at") if c == "checked_at"
            else F.lit("Goa").alias("state") if c == "state"
            else (F.when(F.col("candidate_id") % 8 == 1, F.col("candidate_id")).otherwise(-F.col("candidate_id"))).alias("candidate_id") if c == "candidate_id"
            else F.col(c)
            for c in stores.columns
        ]
    )


@query(
    "upsert_latest",
    f"""WITH {STORES}, written AS (
      SELECT candidate_id, state, accepted, checked_us, 0 AS newer FROM stores
      UNION ALL SELECT CASE WHEN candidate_id % 8 = 1 THEN candidate_id ELSE -candidate_id END, 'Goa', accepted,
        checked_us + CASE WHEN candidate_id % 3 = 0 THEN -500 ELSE 500 END, 1 FROM stores WHERE candidate_id % 4 = 1)
    SELECT candidate_id, state, accepted, checked_us FROM (
      SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY checked_us DESC, newer DESC) AS rn FROM written) WHERE rn = 1""",
)
def upsert_latest(spark, sf):
    old = i.stores(spark, sf)
    merged = store_state.upsert_latest(old, _newer(old))
    return merged.select("candidate_id", "state", "accepted", F.unix_micros("checked_at").alias("checked_us"))


@query(
    "attempt_outcome",
    f"""SELECT candidate_id, n AS attempts, CASE WHEN error IS NULL THEN 'done' WHEN transient AND n < 3 THEN 'retry' ELSE 'failed' END AS outcome, error AS last_error
    FROM (SELECT candidate_id, count(*) AS n, last(error ORDER BY attempt) AS error, last(transient ORDER BY attempt) AS transient FROM ({i.ATTEMPTS}) a GROUP BY 1) x""",
)
def attempt_outcome(spark, sf):
    return store_state.attempt_outcome(i.run(spark, sf, i.ATTEMPTS, "events"))


@query(
    "candidate_status",
    f"""WITH {STORES}, tried AS ({SQL["attempt_outcome"]})
    SELECT candidate_id, CASE WHEN s.accepted THEN 'accepted' WHEN s.accepted IS NOT NULL THEN 'rejected' WHEN t.outcome <> 'done' THEN t.outcome ELSE c.status END AS status,
      CASE WHEN s.accepted IS NULL THEN coalesce(t.last_error, c.last_error) END AS last_error
    FROM ({i.CANDIDATES}) c LEFT JOIN (SELECT candidate_id, accepted FROM stores WHERE extraction_version = 2) s USING (candidate_id)
    LEFT JOIN tried t USING (candidate_id)""",
)
def candidate_status(spark, sf):
    stores = i.stores(spark, sf).where("extraction_version = 2")
    tried = store_state.attempt_outcome(i.run(spark, sf, i.ATTEMPTS, "events"))
    found = store_state.candidate_status(i.run(spark, sf, i.CANDIDATES, "customer"), stores, tried)
    return found.select("candidate_id", "status", "last_error")


@query("to_revalidate", f"SELECT candidate_id FROM ({i.CANDIDATES}) WHERE status = 'accepted'")
def to_revalidate(spark, sf):
    return store_state.to_revalidate(i.run(spark, sf, i.CANDIDATES, "customer")).select("candidate_id")


SHEET_FILLED = "trim(shopify_correct) <> '' OR trim(reviewer_notes) <> ''"


@query(
    "reextract_select",
    f"""WITH {STORES} SELECT candidate_id, domain_url FROM stores WHERE extraction_version < 2
    AND dkey IN (SELECT rtrim(lower(trim(domain_url)), '/') FROM ({i.SPARSE_WORKSHEET}) w WHERE {SHEET_FILLED})""",
)
def reextract_select(spark, sf):
    chosen = store_state.reextract_selection(i.stores(spark, sf), worksheet=i.run(spark, sf, i.SPARSE_WORKSHEET, "customer"))
    return chosen.select("candidate_id", "domain_url")


@query("reviewed_rows", f"SELECT trim(domain_url) AS domain_url FROM ({i.SPARSE_WORKSHEET}) w WHERE {SHEET_FILLED}")
def reviewed_rows(spark, sf):
    return store_state.reviewed_rows(i.run(spark, sf, i.SPARSE_WORKSHEET, "customer")).select(F.trim("domain_url").alias("domain_url"))


@query("only_registered", f"WITH {STORES} SELECT candidate_id FROM stores WHERE accepted AND strong_kinds = 'registered_india'")
def only_registered(spark, sf):
    return store_state.only_strong_kind(i.stores(spark, sf)).select("candidate_id")


@query("outdated_stores", f"WITH {STORES} SELECT candidate_id FROM stores WHERE accepted AND extraction_version < 2")
def outdated_stores(spark, sf):
    return store_state.reextract_selection(i.stores(spark, sf)).select("candidate_id")


def _fetch_errors(spark, sf) -> DataFrame:
    return i.table(spark, sf, "customer").where("c_custkey % 6 = 1").select(
        F.col("c_custkey").alias("candidate_id"),
        F.when(F.col("c_custkey") % 12 == 1, "ConnectError: CERTIFICATE_VERIFY_FAILED").otherwise("ReadTimeout: slow").alias("error"),
    )


REFRESH = f"""{STORES}, {s.EVIDENCE},
refreshed AS (
  SELECT o.candidate_id, CASE WHEN o.candidate_id % 12 = 1 THEN 'rejected_tls' WHEN o.candidate_id % 6 = 1 THEN 'kept_old'
    WHEN home_reason IS NOT NULL THEN 'rejected_home' ELSE 'refreshed' END AS outcome,
    o.accepted AS old_accepted, o.state AS old_state, o.india_score AS old_score, o.reasons AS old_reasons, j.*
  FROM stores o JOIN judged j ON j.store_id = o.candidate_id WHERE o.accepted AND extraction_version < 2
),
outcomes AS (
  SELECT candidate_id, outcome,
    CASE outcome WHEN 'refreshed' THEN i_ok AND NOT conflict WHEN 'kept_old' THEN old_accepted ELSE false END AS accepted,
    CASE outcome WHEN 'refreshed' THEN r_state ELSE old_state END AS state,
    CAST(CASE outcome WHEN 'refreshed' THEN i_score ELSE old_score END AS INTEGER) AS india_score,
    CASE outcome WHEN 'refreshed' THEN concat_ws(';', CASE WHEN NOT i_ok THEN 'insufficient_india_evidence' END, CASE WHEN conflict THEN 'conflicting_state_evidence' END)
      WHEN 'rejected_tls' THEN 'tls_certificate_invalid' WHEN 'rejected_home' THEN home_reason ELSE old_reasons END AS reasons
  FROM refreshed
)"""


def _refreshed(spark, sf) -> DataFrame:
    selected = store_state.reextract_selection(i.stores(spark, sf))
    return runs.refresh_stores(selected, i.crawl(spark, sf), _fetch_errors(spark, sf))


@query(
    "revalidated",
    f"""WITH {STORES}, {s.EVIDENCE}, chosen AS (SELECT candidate_id FROM ({i.CANDIDATES}) c WHERE status = 'accepted')
    SELECT store_id AS candidate_id, state, CAST(india_score AS INTEGER) AS india_score, accepted FROM verdicts WHERE store_id IN (FROM chosen)
    UNION ALL SELECT candidate_id, state, india_score, accepted FROM stores WHERE candidate_id NOT IN (FROM chosen)""",
)
def revalidated(spark, sf):
    candidates = i.run(spark, sf, i.CANDIDATES, "customer")
    table = runs.revalidate(candidates, i.stores(spark, sf), i.crawl(spark, sf), i.carts(spark, sf), i.dns(spark, sf))
    return table.select("candidate_id", "state", "india_score", "accepted")


@query("refresh_outcome", f"WITH {REFRESH} SELECT candidate_id, outcome, accepted, state, india_score, reasons FROM outcomes")
def refresh_outcome(spark, sf):
    return _refreshed(spark, sf).select(
        "candidate_id", "outcome", "accepted", "state", "india_score", joined("rejection_reasons").alias("reasons")
    )


@query(
    "refresh_counters",
    f"""WITH {REFRESH} SELECT count(*) AS refresh_selected, count(*) FILTER (WHERE outcome <> 'kept_old') AS refresh_completed,
      count(*) FILTER (WHERE outcome = 'kept_old') AS refresh_errors, count(*) FILTER (WHERE outcome <> 'kept_old' AND NOT accepted) AS refresh_removed FROM outcomes""",
)
def refresh_counters(spark, sf):
    return store_state.refresh_counters(_refreshed(spark, sf))


TARGET = 300
RUN = f"""{STORES}, ranked AS (SELECT candidate_id, accepted, dkey, (row_number() OVER (ORDER BY candidate_id) - 1) // 40 AS batch FROM stores)"""


def _outcomes(spark, sf) -> DataFrame:
    return i.stores(spark, sf).select("candidate_id", F.col("candidate_id").alias("discovered_seq"), "accepted", "domain_url")


@query(
    "run_to_target",
    f"""WITH {RUN}, per_batch AS (SELECT batch, count(*) FILTER (WHERE accepted) AS n FROM ranked GROUP BY 1),
    reached AS (SELECT batch, sum(n) OVER (ORDER BY batch) - n AS before_it FROM per_batch)
    SELECT candidate_id, batch FROM ranked WHERE batch IN (SELECT batch FROM reached WHERE before_it < {TARGET})""",
)
def run_to_target(spark, sf):
    return runs.run_to_target(_outcomes(spark, sf), TARGET, slice_rows=200).select("candidate_id", "batch")


@query(
    "run_to_unique_target",
    f"""WITH {RUN}, firsts AS (SELECT min(batch) AS batch FROM ranked WHERE accepted GROUP BY dkey),
    per_batch AS (SELECT batch, (SELECT count(*) FROM firsts f WHERE f.batch = r.batch) AS n FROM (SELECT DISTINCT batch FROM ranked) r),
    reached AS (SELECT batch, sum(n) OVER (ORDER BY batch) - n AS before_it FROM per_batch)
    SELECT candidate_id, batch FROM ranked WHERE batch IN (SELECT batch FROM reached WHERE before_it < {TARGET})""",
)
def run_to_unique_target(spark, sf):
    return runs.run_to_target(_outcomes(spark, sf), TARGET, unique=True, slice_rows=200).select("candidate_id", "batch")


# --- crawl log -----------------------------------------------------------------------------------------

LOG = f"""log AS (SELECT *, coalesce(status_code IN (429, 500, 502, 503, 504), false) OR error IS NOT NULL AS transient,
  least(coalesce(CASE WHEN error IS NULL THEN CAST(retry_after AS DOUBLE) END, pow(2.0, attempt)), 30.0) AS told FROM ({i.FETCH_LOG}))"""


@query(
    "retry_log",
    f"""WITH {LOG} SELECT host, url, attempt, CASE WHEN transient AND attempt < 2 THEN 'retry' WHEN error IS NOT NULL THEN 'error' ELSE 'page' END AS outcome,
      CASE WHEN transient AND attempt < 2 THEN told END AS expected_delay, count(*) AS n FROM log GROUP BY ALL""",
)
def retry_log(spark, sf):
    return crawl_log.retry_log(i.fetch_log(spark, sf)).groupBy("host", "url", "attempt", "outcome", "expected_delay").agg(F.count("*").alias("n"))


@query(
    "retry_delays",
    f"""WITH {LOG}, paired AS (SELECT *, lag(end_us) OVER w AS prev_end, lag(transient AND attempt < 2) OVER w AS prev_retry, lag(told) OVER w AS prev_told
      FROM log WINDOW w AS (PARTITION BY host, url ORDER BY start_us, attempt))
    SELECT host, url, attempt, prev_told AS expected_delay, (start_us - prev_end) / CAST(1000000 AS DOUBLE) AS observed_delay FROM paired WHERE prev_retry""",
)
def retry_delays(spark, sf):
    return crawl_log.retry_delays(i.fetch_log(spark, sf)).drop("start_ts")


@query(
    "politeness_gaps",
    f"""WITH log AS ({i.FETCH_LOG}), paired AS (SELECT *, lag(end_us) OVER (PARTITION BY host ORDER BY start_us, url, attempt) AS prev_end FROM log)
    SELECT host, url, attempt, (start_us - prev_end) / CAST(1000000 AS DOUBLE) AS gap, coalesce(start_us - prev_end < 1000000, false) AS too_soon,
      coalesce(start_us < prev_end, false) AS overlaps FROM paired""",
)
def politeness_gaps(spark, sf):
    return crawl_log.politeness_gaps(i.fetch_log(spark, sf)).drop("start_ts")


@query(
    "in_flight",
    f"""WITH log AS ({i.FETCH_LOG}), steps AS (SELECT ts, sum(step) AS step FROM (SELECT start_us AS ts, 1 AS step FROM log UNION ALL SELECT end_us, -1 FROM log) GROUP BY ts)
    SELECT open_requests, open_requests > 20 AS over_limit, count(*) AS n FROM (SELECT CAST(sum(step) OVER (ORDER BY ts) AS BIGINT) AS open_requests FROM steps) GROUP BY 1, 2""",
)
def in_flight(spark, sf):
    return crawl_log.in_flight(i.fetch_log(spark, sf)).groupBy("open_requests", "over_limit").agg(F.count("*").alias("n"))


def _robots_sql(agent_is_named: bool) -> str:
    own = "agent = 'AuditBot'" if agent_is_named else "false"
    return f"""WITH rules AS ({i.ROBOTS.format(host=i.RAW_HOST)}),
    grouped AS (SELECT *, bool_or({own}) OVER (PARTITION BY host) AS has_own FROM rules),
    mine AS (SELECT * FROM grouped WHERE CASE WHEN has_own THEN {own} ELSE agent = '*' END),
    hits AS (SELECT p.page_id, arg_min(m.allow OR m.path = '', m.rule_order) AS allow FROM pages p JOIN mine m ON m.host = regexp_extract(lower(p.url), '://([^/:?#]+)', 1)
      AND starts_with(regexp_extract(p.url, '^[A-Za-z]+://[^/?#]*([^#]*)', 1), m.path) GROUP BY 1)
    SELECT page_id, coalesce(allow, true) AS robots_allowed FROM pages LEFT JOIN hits USING (page_id)"""


def _robots(spark, sf, agent):
    rules = i.run(spark, sf, i.ROBOTS.format(host=i.RAW_HOST), "pages")
    wanted = i.table(spark, sf, "pages").select("page_id", "url")
    return crawl_log.robots_verdict(wanted, rules, agent).select("page_id", "robots_allowed")


@query("robots_verdict", _robots_sql(False))
def robots_verdict(spark, sf):
    return _robots(spark, sf, "StoreResearch/1.0")


@query("robots_verdict_named_agent", _robots_sql(True))
def robots_verdict_named_agent(spark, sf):
    return _robots(spark, sf, "Mozilla/5.0 (compatible; AuditBot/2.1)")


@query(
    "capture_collapse",
    f"""WITH captures AS ({i.DUCK_CAPTURES}), paired AS (SELECT *, lag(digest) OVER (PARTITION BY url ORDER BY ts, digest) AS prev FROM captures WHERE status = '200')
    SELECT url, ts, status, digest FROM paired WHERE prev IS DISTINCT FROM digest""",
)
def capture_collapse(spark, sf):
    return crawl_log.collapse_captures(i.run(spark, sf, i.SPARK_CAPTURES, "events"))


CACHE = f"WITH {s.PAGES}, cache AS (SELECT DISTINCT sha256(requested_url) AS cache_key FROM crawl WHERE page_seq > 0 AND status_code < 400), wanted AS (SELECT store_id, page_seq, final_url AS url FROM crawl)"


def _cache(spark, sf) -> tuple[DataFrame, DataFrame]:
    pages = i.crawl(spark, sf)
    content = crawl_log.crawl_content(pages.where("page_seq > 0"))
    return pages.select("store_id", "page_seq", F.col("final_url").alias("url")), content.where("is_cacheable")


@query("cache_reuse", f"{CACHE} SELECT store_id, page_seq FROM wanted WHERE sha256(url) IN (SELECT cache_key FROM cache)")
def cache_reuse(spark, sf):
    return crawl_log.reusable(*_cache(spark, sf)).select("store_id", "page_seq")


@query("cache_misses", f"{CACHE} SELECT store_id, page_seq FROM wanted WHERE sha256(url) NOT IN (SELECT cache_key FROM cache)")
def cache_misses(spark, sf):
    return crawl_log.still_to_fetch(*_cache(spark, sf)).select("store_id", "page_seq")


@query(
    "crawl_content",
    """SELECT page_id, sha256(url) AS cache_key, sha256(html) AS content_hash, CAST(octet_length(encode(html)) AS INTEGER) AS n_bytes,
      false AS is_capped, true AS is_cacheable FROM pages""",
)
def crawl_content(spark, sf):
    pages = i.table(spark, sf, "pages").select(
        F.col("page_id").alias("store_id"), F.lit(0).alias("page_seq"), F.col("url").alias("requested_url"), F.col("html").alias("body"), F.lit(200).alias("status_code")
    )
    return crawl_log.crawl_content(pages).drop("page_seq").withColumnRenamed("store_id", "page_id")


@query(
    "duplicate_content",
    f"""WITH {s.PAGES} SELECT sha256(body) AS content_hash, count(*) AS copies, arg_min(store_id, store_id * 10 + page_seq) AS store_id,
      arg_min(page_seq, store_id * 10 + page_seq) AS page_seq FROM crawl GROUP BY 1""",
)
def duplicate_content(spark, sf):
    return crawl_log.duplicate_content(crawl_log.crawl_content(i.crawl(spark, sf)))


@query(
    "content_text",
    f"""SELECT page_id, {UNESCAPED.format(s.strip("regexp_extract(html, '(?s)<body[^>]*>(.*)', 1)"))} AS content FROM pages""",
)
def content_text(spark, sf):
    return parsed_pages(spark, sf).selectExpr("page_id", f"{elements.content_text()} AS content")


@query(
    "redirect_aliases",
    f"""WITH {s.PAGES} SELECT store_id, domain_url, redirected_from FROM heads JOIN (SELECT store_id, redirected_from FROM crawl WHERE page_seq = 0) USING (store_id)
    WHERE redirected_from <> '' AND home_reason IS NULL""",
)
def redirect_aliases(spark, sf):
    heads = verdict.store_heads(raw_facts(i.crawl(spark, sf).where("page_seq = 0")).select("store_id", "head"))
    return heads.where("size(redirect_history) > 0 AND home_reason IS NULL").selectExpr(
        "store_id", "domain_url", "redirect_history[0] AS redirected_from"
    )


# --- files: written by one job, read by the source under test -----------------------------


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/vitrine-{name}-{uuid.uuid4().hex}"


def _in_files(df: DataFrame, key: str) -> DataFrame:
    """Rows in the order of the key over several files, as a writer names them."""
    return df.repartitionByRange(4, key).sortWithinPartitions(key)


def _ranked(df: DataFrame, seq: str) -> DataFrame:
    """The rank a source's own numbers give, by sums over slices of the numbers."""
    return running_total(df, [seq], F.lit(1), F.col(seq), "place").drop(seq)


@query("text_seed_source", "SELECT url AS source_value, row_number() OVER (ORDER BY page_id) AS place FROM pages")
def text_seed_source(spark, sf):
    path = new_folder(spark, "text")
    lines = "explode(array(concat('  ', url, ' '), '', '   ', concat('# ', url)))"
    _in_files(i.table(spark, sf, "pages").select("page_id", "url"), "page_id").selectExpr(f"{lines} AS value").write.text(path)
    return _ranked(seed_source.read_text_seeds(spark, path).select("source_value", "seq"), "seq")


@query("csv_seed_source", "SELECT url AS source_value, row_number() OVER (ORDER BY page_id) AS place FROM pages")
def csv_seed_source(spark, sf):
    path = new_folder(spark, "seeds") + ".csv"
    rows = _in_files(i.table(spark, sf, "pages").select("page_id", "url"), "page_id")
    rows.selectExpr("concat('a, b ', page_id) AS `name, or id`", "url AS Website").write.csv(path, header=True)
    return _ranked(seed_source.read_seeds(spark, path).select("source_value", "seq"), "seq")


@query(
    "master_list_source",
    f"""SELECT candidate_key, registrable_domain, row_number() OVER (ORDER BY discovered_seq) AS place FROM ({SQL["master_import"]}) m""",
)
def master_list_source(spark, sf):
    path = new_folder(spark, "master")
    _in_files(i.run(spark, sf, i.MASTER, "customer"), "seq").write.csv(path, header=True, compression="gzip", escape='"')
    found = cand.clean_candidates(cand.master_seeds(seed_source.read_master_list(spark, path)))
    return _ranked(found.select("candidate_key", "registrable_domain", "discovered_seq"), "discovered_seq")


@query(
    "page_json_source",
    f"WITH crawl AS ({i.CRAWL}) SELECT store_id, page_seq, final_url, status_code, sha256(body) AS body_hash, robots_allowed FROM crawl",
)
def page_json_source(spark, sf):
    path = new_folder(spark, "pages")
    whole = i.crawl(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    broken = i.table(spark, sf, "customer").selectExpr("concat('{\"store_id\": ', c_custkey, ', \"body\": ') AS value")
    whole.unionByName(broken).write.text(path)
    return crawl_source.read_pages_json(spark, path).selectExpr(
        "store_id", "page_seq", "final_url", "status_code", "sha2(body, 256) AS body_hash", "robots_allowed"
    )


@query("capture_source", SQL["capture_collapse"])
def capture_source(spark, sf):
    path = new_folder(spark, "captures")
    lines = i.run(spark, sf, i.SPARK_CAPTURES, "events").selectExpr(
        "explode(array(to_json(struct(url, ts AS timestamp, status, digest)), substring(url, 1, 9))) AS value"
    )
    lines.write.text(path)
    return crawl_log.collapse_captures(crawl_source.read_captures(spark, path))


@query("export_csv", SQL["export_rows"])
def export_csv(spark, sf):
    csv_path, _ = sinks.export_results(i.stores(spark, sf), new_folder(spark, "export"))
    return seed_source.read_worksheet(spark, csv_path).select(*fv.EXPORT_COLUMNS)


@query(
    "evidence_jsonl",
    f"WITH {STORES} SELECT domain_url, state, shopify_score, india_score, len(string_split(strong_kinds, ';')) + 1 AS n_india_items, sources AS source_names FROM uniq",
)
def evidence_jsonl(spark, sf):
    _, path = sinks.export_results(i.stores(spark, sf), new_folder(spark, "evidence"))
    return spark.read.schema(schemas.STORES).json(path).selectExpr(
        "domain_url", "state", "shopify_score", "india_score", "cast(size(india_evidence) AS bigint) AS n_india_items",
        "array_join(source_names, ';') AS source_names",
    )


def _listed(sql: str, key: str, *values: str) -> str:
    shown = " || '/' || ".join(f"CAST({v} AS VARCHAR)" for v in values)
    return f"(SELECT string_agg({key} || '=' || {shown}, ';' ORDER BY {key}) FROM ({sql}) listed)"


@query(
    "report_document",
    f"""SELECT r.*, {_listed(f"SELECT status, count(*) AS n FROM ({i.CANDIDATES}) GROUP BY 1", "status", "n")} AS statuses,
      {_listed(SQL["store_rejections"], "reason", "n")} AS reasons, {_listed(SQL["state_distribution"], "state", "n")} AS states,
      {_listed(SQL["category_distribution"], "category", "n")} AS categories, {_listed(SQL["source_yield"], "source", "seen", "accepted")} AS yields,
      {_listed(SQL["quality_missing"], "field", "missing", "CAST(percent AS DOUBLE)")} AS missing, c.*,
      p.status AS audit_status, p.reviewed AS audit_reviewed, p.shopify_precision_percent, p.india_precision_percent, p.required_precision_percent,
      {_listed(SQL["field_accuracy"], "field", "reviewed", "CAST(accuracy_percent AS DOUBLE)")} AS accuracy
    FROM ({SQL["report_counters"]}) r, ({SQL["confidence_stats"]}) c, ({SQL["audit_precision"]}) p""",
)
def report_document(spark, sf):
    """The whole report as it is read back from its file."""
    inputs = (i.run(spark, sf, i.CANDIDATES, "customer"), i.stores(spark, sf))
    sheet = i.run(spark, sf, i.WORKSHEET, "customer")
    path = sinks.write_report(*inputs, new_folder(spark, "report"), sheet)
    report = spark.read.schema(reports.quality_report(*inputs, sheet).schema).json(path)

    def listed(entries: str, *values: str) -> str:
        value = ", '/', ".join(values)
        return f"array_join(transform(array_sort(map_entries({entries})), e -> concat(e.key, '=', {value})), ';')"

    return report.selectExpr(
        "processed_records", "accepted_records", "accepted_candidate_records", "redirect_duplicates_removed",
        f"{listed('candidate_status_counts', 'e.value')} AS statuses", f"{listed('rejection_reasons', 'e.value')} AS reasons",
        f"{listed('state_distribution', 'e.value')} AS states", f"{listed('category_distribution', 'e.value')} AS categories",
        f"{listed('source_yield', 'e.value.seen', 'e.value.accepted')} AS yields", f"{listed('missing_fields', 'e.value.count', 'e.value.percent')} AS missing",
        "confidence.average_shopify_score", "confidence.average_india_score",
        "cast(confidence.minimum_shopify_score AS int) AS minimum_shopify_score", "cast(confidence.minimum_india_score AS int) AS minimum_india_score",
        "manual_audit.status AS audit_status", "manual_audit.reviewed AS audit_reviewed", "manual_audit.shopify_precision_percent",
        "manual_audit.india_precision_percent", "cast(manual_audit.required_precision_percent AS double) AS required_precision_percent",
        f"{listed('manual_audit.field_accuracy', 'e.value.reviewed', 'e.value.accuracy_percent')} AS accuracy",
    )


@query(
    "worksheet_file",
    f"""SELECT domain_url, category, state, shopify_score, india_score, source_names, '' AS shopify_correct FROM ({SQL["audit_sample"]}) a""",
)
def worksheet_file(spark, sf):
    path = sinks.write_audit_sample(i.stores(spark, sf), new_folder(spark, "sheet"), 100, 20261002)
    return seed_source.read_worksheet(spark, path).selectExpr(
        "domain_url", "category", "state", "cast(shopify_score AS int) AS shopify_score",
        "cast(india_score AS int) AS india_score", "source_names", "shopify_correct",
    )


# --- incremental ---------------------------------------------------------------------------


@query("incremental_verify", VERDICT_SQL)
def incremental_verify(spark, sf):
    """Page drops arrive in five lots, each a micro-batch; every store's pages come in several of them, and the
    stream ends with the batch job's answer. The state is compacted on the way."""
    root = new_folder(spark, "stream")
    # One file per lot, all written by one job.
    lots = i.crawl(spark, sf).withColumn("lot", F.expr("(store_id + page_seq) % 5")).where("lot BETWEEN 0 AND 4")
    lots.repartition(5, "lot").write.partitionBy("lot").parquet(f"{root}/drops")
    query = verify_arrivals(spark, f"{root}/drops/*", root, i.carts(spark, sf), i.dns(spark, sf), max_files=1, most_deltas=2)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return _flat_verdicts(sinks.StoreSnapshots(spark, f"{root}/state").read(), "candidate_id")


BATCHES = 5


@query(
    "compacted_state",
    f"""WITH {STORES}, written AS (
      SELECT candidate_id, state, accepted, checked_us, 0 AS batch FROM stores
      UNION ALL SELECT candidate_id, 'batch ' || b, accepted, checked_us + CASE WHEN candidate_id % 3 = 0 THEN -500 ELSE 100 * b END, b
      FROM stores, range(1, {BATCHES + 1}) t(b) WHERE candidate_id % (b + 1) = 0)
    SELECT candidate_id, state, accepted, checked_us FROM (
      SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY checked_us DESC, batch DESC) AS rn FROM written) WHERE rn = 1""",
)
def compacted_state(spark, sf):
    """The whole state after commits that overlap, some of them late, with compactions in between."""
    snapshots = sinks.StoreSnapshots(spark, new_folder(spark, "state"), slice_rows=500, most_deltas=2)
    stores = i.stores(spark, sf)
    snapshots.commit(stores, 0)
    for batch in range(1, BATCHES + 1):
        late = F.when(F.col("candidate_id") % 3 == 0, -500).otherwise(100 * batch)
        changed = {"state": F.lit(f"batch {batch}"), "checked_at": F.timestamp_micros(F.unix_micros("checked_at") + late)}
        snapshots.commit(stores.where(F.col("candidate_id") % (batch + 1) == 0).withColumns(changed), batch)
    return snapshots.read().select("candidate_id", "state", "accepted", F.unix_micros("checked_at").alias("checked_us"))
