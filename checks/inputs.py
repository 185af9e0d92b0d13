"""Inputs the checks derive from the given tables.

Each text below is plain SQL that Spark and the checking engine read alike, so both sides
start from the same rows. Residues of the key only vary what a row contains: every key
takes part, and the inputs grow with the tables.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The sample tables are one file, one split: spread the rows so that all cores parse.
    A real crawl table has many files and needs no such step."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if len(df.inputFiles()) < cores else df


def run(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    for name in tables:
        df = table(spark, sf_dir, name)
        if name == "customer":
            df = spread(df.select("c_custkey", "c_mktsegment"), "c_custkey")
        elif name == "pages":
            df = spread(df, "page_id")
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


# --- a crawl of one store per customer -------------------------------------------

KEYS = """
SELECT k, seg, hk,
  (CASE WHEN hk % 7 = 0 THEN 'www.' ELSE '' END) || 'store' || CAST(hk AS STRING)
    || (CASE hk % 4 WHEN 1 THEN '.co.in' WHEN 2 THEN '.com' ELSE '.in' END) AS host,
  'store' || CAST(k AS STRING)
    || (CASE k % 4 WHEN 1 THEN '.co.in' WHEN 2 THEN '.com' ELSE '.in' END) AS asked_host,
  CASE k % 7 WHEN 0 THEN 'Pune, Maharashtra 411001' WHEN 1 THEN 'Ahmedabad, Gujarat 380015'
    WHEN 2 THEN 'Panaji, Goa 403001' WHEN 3 THEN 'Mylapore 600017'
    WHEN 4 THEN 'Delhi and Haryana 110001' WHEN 5 THEN 'Kochi, Kerala 682001'
    ELSE 'Bengaluru, Karnataka 560001' END AS place,
  CASE k % 6 WHEN 0 THEN '27' WHEN 1 THEN '24' WHEN 2 THEN '30' WHEN 3 THEN '25' WHEN 4 THEN '97'
    ELSE '29' END AS gst_code,
  CASE WHEN k % 6 = 0 THEN 'Sarees and kurtis for women’s wear lovers of store ' || CAST(k AS STRING)
    WHEN seg = 'HOUSEHOLD' THEN 'Kitchenware, bedsheet and pillow sets for every home'
    WHEN seg = 'MACHINERY' THEN 'Gadgets, chargers and headphones for daily work'
    WHEN seg = 'FURNITURE' THEN 'Handmade furniture, lamp and home decor pieces'
    WHEN seg = 'BUILDING' THEN 'Natural skincare, hair oil and beauty serum'
    ELSE 'Helmet, car care and motorcycle accessories' END AS blurb
FROM (
  SELECT c_custkey AS k, c_mktsegment AS seg,
    CASE WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END AS hk
  FROM customer
) keyed
"""

HOME_BODY = """
'<!DOCTYPE html><html><head><title>Store ' || CAST(k AS STRING) || ' online shop</title>'
|| (CASE WHEN k % 8 = 0 THEN ''
     WHEN k % 9 = 1 THEN '<meta name="description" content="Our refund policy and return policy apply to all orders.">'
     ELSE '<meta name="description" content="' || blurb || '">' END)
|| (CASE WHEN k % 5 < 3 THEN '<script>Shopify.theme = {"id": ' || CAST(k AS STRING) || '};</script>' ELSE '' END)
|| (CASE k % 6
     WHEN 1 THEN '<script type="application/ld+json">{"@type":"Organization","name":"Store ' || CAST(k AS STRING)
       || '","logo":"/assets/mark-' || CAST(k AS STRING)
       || '.png","address":{"@type":"PostalAddress","addressCountry":"IN","addressRegion":"Gujarat"}}</script>'
     WHEN 2 THEN '<script type="application/ld+json">{"@graph":[{"@type":"Store","logo":{"url":"https://static.store'
       || CAST(k AS STRING) || '.in/brand.png"}},{"@type":"Product","category":"Yoga mats"}],"@type":"WebPage"}</script>'
     WHEN 3 THEN '<script type="application/ld+json">{"@type": "Organization", </script>'
     WHEN 4 THEN '<script type="application/ld+json">[{"@type":"Brand","description":"A family workshop making cycling gear, number '
       || CAST(k AS STRING) || '"},{"@type":"WebSite","name":"Fitness and gym"}]</script>'
     ELSE '' END)
|| '</head><body' || (CASE WHEN k % 3 = 0 THEN ' class="shopify-section"' ELSE '' END) || '><header>'
|| (CASE WHEN k % 10 = 3 THEN '<a href="/"><img src="/files/product-' || CAST(k AS STRING) || '.png" alt="Top"></a>'
     WHEN k % 3 <> 1 THEN '<a href="/"><img data-src="/assets/head-' || CAST(k AS STRING)
       || (CASE WHEN k % 4 = 0 THEN '-logo' ELSE '' END) || '.svg" alt="Store mark" width="120" height="40"></a>'
     ELSE '<img class="site-logo" src="/assets/icon-' || CAST(k AS STRING) || '.png" width="48" height="48">' END)
|| '<nav><a href="/collections/gifts">Gift hamper</a> <a href="/pages/contact?utm_source=nav">Contact us</a>'
|| (CASE WHEN k % 3 = 0 THEN ' <a href="/pages/our-story">About us</a>' ELSE '' END)
|| ' <a href="/policies/refund-policy">Refund policy</a> <a href="https://other.example.org/contact">Partner contact</a>'
|| (CASE WHEN k % 2 = 0 THEN ' <a href="/policies/privacy-policy">Privacy policy</a> <a href="/policies/terms-of-service">Terms</a>' ELSE '' END)
|| ' <a href="/pages/contact">Contact again</a> <a href="/cart">Cart</a></nav></header>'
|| '<main><h1>Welcome to store ' || CAST(k AS STRING) || '</h1><h2>' || blurb || '</h2><p>'
|| (CASE WHEN k % 4 < 2 THEN 'Prices from Rs. 499 only. ' ELSE '' END)
|| (CASE WHEN k % 7 = 2 THEN 'We ship to every city of India. ' ELSE '' END)
|| 'Shop the new book and coffee range of the season.</p>'
|| (CASE WHEN k % 2 = 0 THEN '<img src="/cdn/shop/files/item.jpg" alt="Item">' ELSE '' END) || '</main><footer>'
|| (CASE WHEN k % 4 <> 3 THEN '<a href="mailto:Hello@store' || CAST(hk AS STRING) || '.in?subject=hi">Write</a> ' ELSE '' END)
|| (CASE k % 5 WHEN 1 THEN '<a href="tel:+91 98765 ' || lpad(CAST(k % 100000 AS STRING), 5, '0') || '">Call</a> '
     WHEN 2 THEN '<a href="https://wa.me/9198' || lpad(CAST(k AS STRING), 8, '0') || '">Chat</a> ' ELSE '' END)
|| (CASE WHEN k % 6 = 4 THEN '<p>sales [at] store' || CAST(hk AS STRING) || ' [dot] in</p> ' ELSE '' END)
|| (CASE WHEN k % 3 = 0 THEN '<p>Website developed by Niche studio dev' || CAST(k AS STRING) || '@agency.net</p> ' ELSE '' END)
|| (CASE WHEN k % 2 = 0 THEN '<a href="https://www.instagram.com/store' || CAST(hk AS STRING) || '/?utm_source=site">IG</a> ' ELSE '' END)
|| (CASE WHEN k % 3 = 0 THEN '<a href="https://instagram.com/p/ABC' || CAST(k AS STRING) || '">Post</a> ' ELSE '' END)
|| (CASE WHEN k % 4 = 1 THEN '<a href="https://facebook.com/profile.php?id=' || CAST(hk AS STRING) || '">FB</a> ' ELSE '' END)
|| (CASE WHEN k % 5 = 0 THEN '<a href="https://twitter.com/intent/tweet">Tweet</a> <a href="https://x.com/store' || CAST(hk AS STRING) || '">X</a> ' ELSE '' END)
|| (CASE WHEN k % 6 = 1 THEN '<a href="https://www.youtube.com/@store' || CAST(hk AS STRING) || '">YT</a> <a href="https://youtu.be/abc">Clip</a> ' ELSE '' END)
|| (CASE WHEN k % 9 = 2 THEN '<a href="https://linkedin.com/company/store' || CAST(hk AS STRING) || '/about">IN</a> ' ELSE '' END)
|| (CASE WHEN k % 7 = 3 OR k % 11 = 4 THEN '<address>' || place || ', India</address>' ELSE '' END)
|| '</footer></body></html>'
"""

CONTACT_BODY = """
'<html><body><main><h1>Contact</h1><p>'
|| (CASE WHEN k % 5 < 2 THEN 'Registered office: Plot ' || CAST(k % 90 AS STRING) || ', ' || place || ', India. ' ELSE '' END)
|| (CASE WHEN k % 3 = 0 THEN 'GSTIN ' || gst_code || 'ABCDE' || lpad(CAST(k % 10000 AS STRING), 4, '0') || 'F1Z5. ' ELSE '' END)
|| (CASE WHEN k % 13 = 0 THEN 'GSTIN 07ABCDE' || lpad(CAST(k % 10000 AS STRING), 4, '0') || 'K1Z7. ' ELSE '' END)
|| (CASE WHEN k % 4 = 1 THEN 'Postal address: ' || place || '. ' ELSE '' END)
|| 'Call +91 91234 ' || lpad(CAST(k % 100000 AS STRING), 5, '0') || '. Email care@store' || CAST(hk AS STRING)
|| '.in today or noreply@store' || CAST(hk AS STRING) || '.in never.</p></main></body></html>'
"""

LEGAL_BODY = """
'<html><body><h1>Privacy</h1><p>Any grievance reaches the desk at rights@store' || CAST(hk AS STRING)
|| '.in, or ring +91 90000 ' || lpad(CAST(k % 100000 AS STRING), 5, '0') || '. </p><p>'
|| (CASE WHEN k % 8 < 4 THEN 'Registered office address: ' || place || ', India.'
     WHEN k % 16 = 6 THEN 'You may also write by mailing us at Surat, Gujarat 395003.'
     ELSE 'Returns are accepted in Delhi 110001 only.' END)
|| '</p></body></html>'
"""

ABOUT_BODY = """
'<html><body><main><p>Seven potters fire stoneware in a wood kiln near the river, kiln number ' || CAST(k AS STRING)
|| '.</p></main></body></html>'
"""

CRAWL = f"""
SELECT k AS store_id, 0 AS page_seq, 'https://' || asked_host || '/' AS requested_url, 'https://' || host || '/' AS final_url,
  CASE WHEN k % 41 = 5 THEN 403 WHEN k % 43 = 7 THEN 404 WHEN k % 47 = 11 THEN 503 ELSE 200 END AS status_code,
  'text/html; charset=utf-8' AS content_type,
  CASE WHEN k % 53 = 3 THEN '' WHEN k % 59 = 4 THEN '<html><body>Opening soon. Enter using password</body></html>'
    WHEN k % 61 = 6 THEN '<html><body>This domain is for sale</body></html>'
    WHEN k % 67 = 8 THEN '<html><body>Solve the captcha first</body></html>' ELSE {HOME_BODY} END AS body,
  CASE WHEN k % 11 = 0 THEN 'x-shopid,server,x-shopify-stage' ELSE 'server' END AS header_names,
  CASE WHEN hk <> k THEN 'https://' || asked_host || '/' ELSE '' END AS redirected_from,
  k % 71 <> 9 AS robots_allowed
FROM ({KEYS}) base
UNION ALL
SELECT k, 1, 'https://' || asked_host || '/pages/contact', 'https://' || host || '/pages/contact',
  CASE WHEN k % 37 = 6 THEN 404 ELSE 200 END, 'text/html', {CONTACT_BODY}, 'server', '', true
FROM ({KEYS}) base WHERE k % 3 < 2
UNION ALL
SELECT k, 2, 'https://' || asked_host || '/policies/privacy-policy', 'https://' || host || '/policies/privacy-policy',
  200, CASE WHEN k % 31 = 2 THEN 'application/pdf' ELSE 'text/html' END, {LEGAL_BODY}, 'server', '', k % 29 <> 4
FROM ({KEYS}) base WHERE k % 2 = 0
UNION ALL
SELECT k, 3, 'https://' || asked_host || '/pages/about', 'https://' || host || '/pages/about',
  200, 'text/html', {ABOUT_BODY}, 'server', '', true
FROM ({KEYS}) base WHERE k % 7 = 0
"""

# Cart and DNS answers per host of the crawl.
CARTS = f"""
SELECT host, CASE WHEN k % 9 = 0 THEN 404 ELSE 200 END AS status_code,
  CASE WHEN k % 5 = 3 THEN 'text/html' ELSE 'application/json' END AS content_type,
  CASE k % 4 WHEN 0 THEN '{{"items":[],"item_count":0}}' WHEN 1 THEN '[1,2]' WHEN 2 THEN '{{"items":[]'
    ELSE '{{"token":"a","items":[],"item_count":2}}' END AS body
FROM ({KEYS}) base WHERE hk = k
"""
DNS = f"""
SELECT host, CASE WHEN k % 6 = 5 THEN 'SHOPS.myshopify.com.' ELSE 'lb.hosting.net.' END AS cname
FROM ({KEYS}) base WHERE hk = k
"""
IMAGES = f"""
SELECT 'https://' || replace(host, 'www.', '') || '/assets/head-' || CAST(k AS STRING) || (CASE WHEN k % 4 = 0 THEN '-logo' ELSE '' END)
  || '.svg' AS url, CASE WHEN k % 5 = 0 THEN 404 ELSE 200 END AS status_code,
  CASE WHEN k % 6 = 0 THEN 'text/html' ELSE 'image/svg+xml' END AS content_type,
  CAST(CASE WHEN k % 7 = 0 THEN 40 ELSE 4000 END AS BIGINT) AS n_bytes, k % 8 <> 0 AS robots_allowed
FROM ({KEYS}) base
"""


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived crawl in the shape of `schemas.PAGES`."""
    flat = run(spark, sf_dir, CRAWL, "customer")
    names = F.split("header_names", ",")
    return flat.select(
        "store_id",
        "page_seq",
        "requested_url",
        "final_url",
        "status_code",
        F.lit(None).cast("timestamp").alias("fetched_at"),
        "content_type",
        "body",
        F.map_from_arrays(names, F.transform(names, lambda n: F.lit("1"))).alias("headers"),
        F.filter(F.array("redirected_from"), lambda u: u != "").alias("redirect_history"),
        "robots_allowed",
        F.lit(None).cast("string").alias("error"),
    )


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, CARTS, "customer")


def dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, DNS, "customer")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, IMAGES, "customer")


# --- seeds: the URLs of the pages table, from two lists ---------------------------

SEEDS = """
SELECT 'list_a' AS source_name, url AS source_value, page_id * 2 AS seq FROM pages
UNION ALL
SELECT 'list_b', replace(replace(url, 'https://', 'http://'), '/en/', '/other/'), page_id * 2 + 1
FROM pages WHERE url LIKE '%/en/%'
"""
MASTER = """
SELECT CASE WHEN c_custkey % 3 = 0 THEN 'Shop' || CAST(c_custkey AS STRING) || '.in' WHEN c_custkey % 3 = 1 THEN
    'www.shop' || CAST(c_custkey AS STRING) || '.co.in' ELSE 'shop' || CAST(c_custkey AS STRING) || '.com' END AS domain,
  CASE WHEN c_custkey % 4 = 0 THEN 'Shopify' WHEN c_custkey % 4 = 1 THEN NULL ELSE 'Magento' END AS platform,
  CASE WHEN c_custkey % 5 = 0 THEN 'php, SHOPIFY plus' ELSE 'php' END AS technologies,
  CASE WHEN c_custkey % 7 = 0 THEN 'likely shopify' ELSE NULL END AS ecom_verdict,
  c_custkey AS seq
FROM customer
"""

# --- a store table ------------------------------------------------------------------

STORES = """
SELECT c_custkey AS candidate_id,
  'https://' || (CASE WHEN c_custkey % 17 = 4 THEN 'Shop' ELSE 'shop' END)
    || CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS STRING) || '.in'
    || (CASE WHEN c_custkey % 19 = 8 THEN '/' ELSE '' END) AS domain_url,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'hi@shop' || CAST(c_custkey AS STRING) || '.in' END AS email,
  CASE WHEN c_custkey % 6 < 3 THEN '' ELSE '+9198' || lpad(CAST(c_custkey AS STRING), 8, '0') END AS phone,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'https://instagram.com/shop' || CAST(c_custkey AS STRING) END AS profile,
  CASE WHEN c_custkey % 9 = 0 THEN '' ELSE lower(c_mktsegment) END AS category,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Goods of shop ' || CAST(c_custkey AS STRING) END AS description,
  CASE WHEN c_custkey % 8 = 0 THEN '' ELSE 'https://shop' || CAST(c_custkey AS STRING) || '.in/logo.png' END AS logo_url,
  CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'Gujarat' WHEN 2 THEN 'Kerala' ELSE 'Maharashtra' END AS state,
  CAST(5 + c_custkey % 11 AS INT) AS shopify_score,
  CAST(4 + c_custkey % 13 AS INT) AS india_score,
  c_custkey % 5 < 3 AS accepted,
  CASE WHEN c_custkey % 5 < 3 THEN '' WHEN c_custkey % 10 = 3 THEN 'insufficient_india_evidence;conflicting_state_evidence'
    WHEN c_custkey % 10 = 4 THEN 'homepage_status_403' ELSE 'insufficient_shopify_evidence' END AS reasons,
  CASE c_custkey % 4 WHEN 0 THEN 'list_a' WHEN 1 THEN 'list_a;list_b' WHEN 2 THEN 'list_b' ELSE '' END AS sources,
  CASE WHEN c_custkey % 3 = 0 THEN 'registered_india' WHEN c_custkey % 3 = 1 THEN 'gstin' ELSE 'gstin;registered_india' END AS strong_kinds,
  CAST(1 + c_custkey % 2 AS INT) AS extraction_version,
  c_custkey * 1000 AS checked_us
FROM customer
"""


def _items(column: str) -> F.Column:
    return F.filter(F.split(column, ";"), lambda v: v != "")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived store table in the shape of `schemas.STORES`."""
    flat = run(spark, sf_dir, STORES, "customer")

    def evidence(kinds, strong: str):
        return F.transform(
            kinds,
            lambda k: F.struct(
                k.alias("kind"), F.lit("v").alias("value"), F.col("domain_url").alias("source_url"),
                F.lit(5).alias("weight"), F.lit(strong).alias("strength"),
            ),
        )

    supporting = evidence(F.array(F.lit("inr")), "supporting")
    return flat.select(
        "candidate_id",
        "domain_url",
        F.struct(_items("email").alias("emails"), _items("phone").alias("phones")).alias("contacts"),
        F.when(F.col("profile") != "", F.create_map(F.lit("instagram"), F.array("profile")))
        .otherwise(F.create_map().cast("map<string,array<string>>"))
        .alias("socials"),
        "category",
        "description",
        "logo_url",
        "state",
        "shopify_score",
        "india_score",
        "accepted",
        _items("reasons").alias("rejection_reasons"),
        F.concat(evidence(F.array(F.lit("shopify_runtime")), "strong"), evidence(F.array(F.lit("shopify_cdn")), "supporting")).alias("shopify_evidence"),
        F.concat(evidence(_items("strong_kinds"), "strong"), supporting).alias("india_evidence"),
        F.create_map(F.lit("description"), F.col("domain_url")).alias("extraction_sources"),
        F.array().cast("array<string>").alias("redirect_history"),
        F.timestamp_micros("checked_us").alias("checked_at"),
        _items("sources").alias("source_names"),
        "extraction_version",
    )


CANDIDATES = """
SELECT c_custkey AS candidate_id, 'https://shop' || CAST(c_custkey AS STRING) || '.in' AS candidate_key,
  'shop' || CAST(c_custkey AS STRING) || '.in' AS registrable_domain,
  CASE WHEN c_custkey % 9 = 0 THEN 'pending' WHEN c_custkey % 9 = 1 THEN 'retry' WHEN c_custkey % 9 = 2 THEN 'failed'
    WHEN c_custkey % 5 < 3 THEN 'accepted' ELSE 'rejected' END AS status,
  CAST(c_custkey % 3 AS INT) AS attempts, c_custkey AS discovered_seq,
  CASE WHEN c_custkey % 9 = 1 THEN 'ConnectTimeout: ' ELSE NULL END AS last_error
FROM customer
"""
CANDIDATE_SOURCES = """
SELECT c_custkey AS candidate_id, 'list_a' AS source_name, 'shop' || CAST(c_custkey AS STRING) || '.in' AS source_value
FROM customer WHERE c_custkey % 4 < 2
UNION ALL
SELECT c_custkey, 'list_b', 'https://shop' || CAST(c_custkey AS STRING) || '.in/' FROM customer WHERE c_custkey % 4 > 0
"""
WORKSHEET = """
SELECT 'https://shop' || CAST(c_custkey AS STRING) || '.in' AS domain_url,
  CASE c_custkey % 4 WHEN 0 THEN '' WHEN 3 THEN 'Y' ELSE ' yes ' END AS shopify_correct,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 4 THEN 'no' ELSE '1' END AS india_correct,
  CASE c_custkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'n' ELSE ' ' END AS contacts_correct,
  CASE c_custkey % 7 WHEN 0 THEN 'TRUE' ELSE '' END AS socials_correct,
  CASE c_custkey % 2 WHEN 0 THEN 'yes' ELSE 'no' END AS category_correct,
  '' AS description_correct,
  CASE c_custkey % 6 WHEN 0 THEN 'maybe' WHEN 1 THEN '1' ELSE '' END AS logo_correct,
  CASE c_custkey % 8 WHEN 0 THEN 'y' WHEN 1 THEN '0' ELSE '' END AS state_correct,
  '' AS fields_correct,
  CASE c_custkey % 10 WHEN 0 THEN 'checked' ELSE '' END AS reviewer_notes
FROM customer
"""
# The CLI-style review filter needs rows nobody touched: a sheet with only some columns filled.
SPARSE_WORKSHEET = """
SELECT '  https://Shop' || CAST(c_custkey AS STRING) || '.in/ ' AS domain_url,
  CASE WHEN c_custkey % 4 = 1 THEN 'yes' ELSE '' END AS shopify_correct, '' AS india_correct, '' AS contacts_correct,
  '' AS socials_correct, '' AS category_correct, '' AS description_correct, '' AS logo_correct, '  ' AS state_correct,
  '' AS fields_correct, CASE WHEN c_custkey % 6 = 2 THEN 'look again' ELSE '' END AS reviewer_notes
FROM customer
"""

# --- a fetch log ----------------------------------------------------------------------

ATTEMPTS = """
SELECT user_id AS candidate_id, event_id AS attempt,
  CASE event_type WHEN 'error' THEN 'ReadTimeout: slow' WHEN 'signup' THEN 'ValueError: bad port' ELSE NULL END AS error,
  event_type = 'error' AS transient
FROM events
"""


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as fetches: a host per user, a URL per payload, times from the stream."""
    start = F.col("ts").cast("timestamp")
    took = F.round(F.col("value") * 1000).cast("bigint") * 1000
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("host"), F.col("user_id"), F.lit(".in")).alias("host"),
        F.concat(F.lit("https://host"), F.col("user_id"), F.lit(".in/"), F.get_json_object("props", "$.k")).alias("url"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("attempt"),
        start.alias("start_ts"),
        F.timestamp_micros(F.unix_micros(start) + took).alias("end_ts"),
        F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "signup", 429).when(F.col("event_type") == "click", None).otherwise(200).alias("status_code"),
        F.when(F.col("event_type") == "signup", F.pmod("event_id", F.lit(50)).cast("string")).alias("retry_after"),
        F.when(F.col("event_type") == "click", "ReadTimeout").alias("error"),
    )


FETCH_LOG = """
SELECT 'host' || CAST(user_id AS STRING) || '.in' AS host,
  'https://host' || CAST(user_id AS STRING) || '.in/' || json_extract_string(props, '$.k') AS url,
  CAST(event_id % 3 AS INT) AS attempt, epoch_us(ts) AS start_us,
  epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) * 1000 AS end_us,
  CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'click' THEN NULL ELSE 200 END AS status_code,
  CASE event_type WHEN 'signup' THEN CAST(event_id % 50 AS STRING) END AS retry_after,
  CASE event_type WHEN 'click' THEN 'ReadTimeout' END AS error
FROM events
"""
CAPTURES = """
SELECT 'https://host' || CAST(user_id AS STRING) || '.in/' AS url, {stamp} AS ts,
  CASE event_type WHEN 'error' THEN '404' ELSE '200' END AS status, 'D' || CAST(event_id % 4 AS STRING) AS digest
FROM events
"""
SPARK_CAPTURES = CAPTURES.format(stamp="date_format(ts, 'yyyyMMddHHmmss')")
DUCK_CAPTURES = CAPTURES.format(stamp="strftime(ts, '%Y%m%d%H%M%S')")

# Every host gets rules; the second group is for one named agent on some hosts.
ROBOTS = """
SELECT host, '*' AS agent, 1 AS rule_order, CASE WHEN length(host) % 3 = 0 THEN '/en/1' WHEN length(host) % 3 = 1 THEN '/fr' ELSE '' END AS path,
  false AS allow FROM (SELECT DISTINCT {host} AS host FROM pages) h
UNION ALL
SELECT host, '*', 2, '/en/2', true FROM (SELECT DISTINCT {host} AS host FROM pages) h
UNION ALL
SELECT host, '*', 3, '/en/', false FROM (SELECT DISTINCT {host} AS host FROM pages) h WHERE length(host) % 2 = 0
UNION ALL
SELECT host, 'AuditBot', 1, '/', false FROM (SELECT DISTINCT {host} AS host FROM pages) h WHERE length(host) % 5 = 0
"""
PAGE_HOST = "regexp_extract(lower(url), '://(www[.])?([^/:?#]+)', 2)"
RAW_HOST = "regexp_extract(lower(url), '://([^/:?#]+)', 1)"
