"""Queries over captured pages: URLs, links, text, contacts, structured data, robots, crawl order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions import text, urls
from tallygraph.operators.crawl import bfs_order
from tallygraph.plans.registry import derived, query, table, texts_of
from tallygraph.sources import web

AGENT = "tallygraphbot"


def _sql_list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _sql_strip(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{fx.WS}+', ' ', 'g'))"


def _sql_clean(html: str) -> str:
    for tag in ("script", "style", "noscript", "svg"):
        html = f"regexp_replace({html}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    return _sql_strip(f"regexp_replace({html}, '<[^>]+>', ' ', 'g')")


SQL_TITLE = f"left({_sql_strip(f'regexp_extract(html, {chr(39)}(?is){fx.TITLE}{chr(39)}, 1)')}, 300)"
SQL_SHOUT = "upper(substr(url, 1, 12)) || substr(url, 13)"
SQL_NORM = r"""lower(regexp_extract(u, '^([A-Za-z]+://[^/?#]+)', 1)) ||
  CASE WHEN regexp_extract(u, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) IN ('', '/') THEN '/'
    ELSE regexp_replace(regexp_extract(u, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), '/$', '') END ||
  regexp_extract(u, '^[^?#]*(\?[^#]+)', 1)"""
SQL_DOMAIN = r"regexp_extract(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)), '([^.]+\.[^.]+)$', 1)"


# --------------------------------------------------------------- urls and links
@query("url_normal", rf"""WITH p AS (SELECT page_id, {SQL_SHOUT} AS u FROM pages)
  SELECT page_id, {SQL_NORM} AS normal, regexp_replace(CASE WHEN contains(u, '#')
    THEN lower(regexp_extract(u, '^([A-Za-z]+)', 1)) || regexp_replace(regexp_extract(u, '^[A-Za-z]+(.*)$', 1), '#.*$', '')
    ELSE u END, '/+$', '') AS strict, regexp_extract(u, '(?i)^(https?://[^/]+)', 1) AS origin FROM p""")
def url_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("u")
    return derived(spark, sf_dir, "pages", "page_id", "concat(upper(substr(url, 1, 12)), substr(url, 13)) as u").select(
        "page_id", urls.normalize_url(u).alias("normal"), urls.normalize_url_strict(u).alias("strict"),
        urls.origin(u).alias("origin"))


@query("url_domain", rf"""SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host, {SQL_DOMAIN} AS domain,
  CASE WHEN lower(regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1)) IN ({_sql_list(fx.LANGUAGES)})
    THEN lower(regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1)) END AS lang,
  coalesce(nullif(lower(regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1)), ''), 'home') AS section FROM pages""")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.host(u).alias("host"), urls.reg_domain(urls.netloc(u)).alias("domain"),
        urls.path_lang(urls.path(u)).alias("lang"), urls.section_key(u).alias("section"))


SQL_LINKS = rf"""h AS (SELECT url, lower(regexp_extract(html, '{fx.PAGE_LANG.replace("'", "''")}', 1)) AS lang,
    unnest(regexp_extract_all(html, '{fx.HREF.replace("'", "''")}', 1)) AS href FROM pages),
  a AS (SELECT url, lang, lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1)) || href AS u FROM h WHERE href LIKE '/%'),
  links AS (SELECT DISTINCT url, regexp_replace(regexp_replace({SQL_NORM}, ';[^/?]*', ''), '(.)/$', '\1') AS link, lang FROM a),
  kept AS (SELECT url, link FROM links WHERE lang = '' OR lower(regexp_extract(link, '^[a-z]+://[^/]+/([^/?#]+)', 1))
    NOT IN ({_sql_list(fx.LANGUAGES)}) OR lower(regexp_extract(link, '^[a-z]+://[^/]+/([^/?#]+)', 1)) = lang)"""


@query("page_links", f"WITH {SQL_LINKS} SELECT DISTINCT url, link FROM kept")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.page_links(table(spark, sf_dir, "pages"))


@query("home_pages_count", r"""WITH h AS (SELECT url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
  SELECT url, count(DISTINCT coalesce(nullif(regexp_replace(regexp_replace(href, '[;?#].*$', ''), '/+$', ''), ''), '/')) AS pages
  FROM h WHERE href LIKE '/%' GROUP BY url""")
def home_pages_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("url", web.home_path_count(F.col("url"), F.col("html")).alias("pages"))


SHOP = ("concat('https://www.shop', cast(p_partkey % 50 as string), '.example.com/', case p_partkey % 10 "
        "when 0 then 'login/' when 1 then 'about/' when 2 then 'files/price.pdf' when 3 then 'Order-history/' "
        "when 4 then 'facebook/' when 5 then 'news/' when 6 then 'catalog/Terms/' when 7 then 'Search/' "
        "when 8 then 'team-and_board/' else '' end, lower(p_type), '/', cast(p_size as string), '/', cast(p_partkey as string))")
SQL_IGNORE = "CASE " + " ".join(
    f"WHEN contains(lower(regexp_extract(link, '^[a-z]+://[^/]+([^?#]*)', 1)), '{p}') THEN '{p.strip('/')}'"
    for p in fx.IGNORED_PATHS) + rf""" WHEN regexp_matches(link, '(?i){fx.IGNORED_SOCIAL}') THEN 'social'
  WHEN regexp_matches(lower(regexp_extract(link, '^[a-z]+://[^/]+([^?#]*)', 1)), '{fx.IGNORED_FILES}') THEN 'file' END"""


@query("link_reasons", f"""WITH l AS (SELECT p_partkey, {SHOP.replace("'files/price.pdf'", "'files/price.pdf?'")} AS link FROM part)
  SELECT p_partkey, {SQL_IGNORE} AS reason FROM l""")
def link_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "part", "p_partkey", f"{SHOP.replace(chr(39) + 'files/price.pdf' + chr(39), chr(39) + 'files/price.pdf?' + chr(39))} as link") \
        .select("p_partkey", urls.ignore_reason(F.col("link")).alias("reason"))


@query("sections", f"""WITH l AS (SELECT 'https://www.shop' || (p_partkey % 50) || '.example.com/' AS seed, {SHOP} AS link FROM part),
  k AS (SELECT seed, link, lower(regexp_extract(link, '^[a-z]+://[^/]+/([^/]+)', 1)) AS section,
    length(regexp_extract(link, '^[a-z]+://[^/]+([^?#]*)', 1)) AS depth FROM l WHERE ({SQL_IGNORE}) IS NULL),
  g AS (SELECT seed, section, arg_min(link, (depth, link)) AS url, min(link) AS first_link FROM k GROUP BY ALL),
  r AS (SELECT seed, section, url, row_number() OVER (PARTITION BY seed ORDER BY first_link) AS ord FROM g UNION ALL
    SELECT DISTINCT seed, 'home', seed, 0 FROM l)
  SELECT seed, ord, section, CASE section WHEN 'home' THEN 'головна' ELSE translate(section, '-_', '  ') END AS label, url
  FROM r""")
def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = derived(spark, sf_dir, "part", "concat('https://www.shop', cast(p_partkey % 50 as string), '.example.com/') as seed",
                    f"{SHOP} as link")
    return web.sections(links)


@query("discover", f"""WITH p AS (SELECT 'https://www.shop' || (p_partkey % 50) || '.example.com/' AS seed, {SHOP} AS link FROM part),
  s AS (SELECT seed, CASE WHEN hash_key % 2 = 0 THEN link ELSE seed || 'rss/' || hash_key END AS link FROM (SELECT *, length(link) AS hash_key FROM p)),
  u AS (SELECT seed, link FROM p UNION SELECT seed, link FROM s)
  SELECT seed, count(*) AS links, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'rss') AS feeds
  FROM (SELECT seed, {SQL_IGNORE} AS reason FROM u) GROUP BY seed""")
def discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = derived(spark, sf_dir, "part", "concat('https://www.shop', cast(p_partkey % 50 as string), '.example.com/') as seed",
                    f"{SHOP} as link")
    sitemap = links.selectExpr("seed", "case when length(link) % 2 = 0 then link else concat(seed, 'rss/', cast(length(link) as string)) end as link")
    return web.discover(links, sitemap).groupBy("seed").agg(
        F.count(F.lit(1)).alias("links"), F.count_if(F.col("reason").isNull()).alias("kept"),
        F.count_if(F.col("reason") == "rss").alias("feeds"))


# --------------------------------------------------------------- page text
@query("page_report", rf"""SELECT url, {SQL_TITLE} AS title, lower(regexp_extract(html, '{fx.PAGE_LANG.replace("'", "''")}', 1)) AS lang,
  md5({_sql_clean('html')}) AS text_md5, length({_sql_clean('html')}) AS chars FROM pages""")
def page_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.page_table(table(spark, sf_dir, "pages")).select(
        "url", "title", "lang", F.md5("text").alias("text_md5"), F.char_length("text").cast("bigint").alias("chars"))


FIRM = "concat('Firm ', chr(cast(97 + s_suppkey % 26 as int)), chr(cast(97 + s_suppkey % 25 as int)))"
CONTENTS_PAGE = ("concat('https://www.firm', cast(s_suppkey % 40 as string), '.com/s', cast(s_suppkey as string)) as url",
                 f"concat('<html lang=\"en\"><head><title>', {FIRM}, '</title><script type=\"application/ld+json\">{{\"@type\":\"Bank\",\"name\":\"B', cast(s_suppkey % 40 as string), '\"}}</script>', "
                 f"'<meta property=\"og:title\" content=\"', {FIRM}, '\"></head><body>', repeat(concat({FIRM}, ' '), 3000), '<a href=\"/about\">info@firm', cast(s_suppkey % 40 as string), '.com</a> ', "
                 "'<a href=\"https://t.me/all\">x</a> <a href=\"https://shop.firm', cast(s_suppkey % 40 as string), '.com/b#x\">+994 12 555 ', lpad(cast(s_suppkey % 10000 as string), 4, '0'), '</a></body></html>') as html")
SQL_CONTENTS = """c AS (SELECT *, s_suppkey % 40 AS k, 'https://www.firm' || (s_suppkey % 40) || '.com' AS site, 'Firm ' || chr((97 + s_suppkey % 26)::INT) || chr((97 + s_suppkey % 25)::INT) AS nm FROM supplier),
  d AS (SELECT *, nm || ' ' || repeat(nm || ' ', 3000) || 'info@firm' || k || '.com x +994 12 555 ' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS body FROM c)"""


@query("page_contents", f"""WITH {SQL_CONTENTS} SELECT site || '/s' || s_suppkey AS url, nm AS title, 'en' AS lang, md5(body) AS text_md5, length(body) AS chars,
  'info@firm' || k || '.com' AS emails, 'https://t.me/all' AS socials, '+99412555' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS phones,
  'https://shop.firm' || k || '.com/b ' || site || '/about' AS links, 'organization:B' || k || ' organization:' || nm AS entities FROM d""")
def page_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = [F.array_join(c, " ").alias(c) for c in ("emails", "socials", "phones", "links")]
    entities = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["entity"], e["title"])), " ").alias("entities")
    return web.page_report(texts_of(spark, sf_dir, "supplier", *CONTENTS_PAGE)).select(
        "url", "title", "lang", F.md5("text").alias("text_md5"), "chars", *lists, entities)


@query("crawl_contents", f"""WITH {SQL_CONTENTS} SELECT 'email' AS kind, 'info@firm' || k || '.com' AS value, NULL AS title, count(*) AS pages FROM d GROUP BY k UNION ALL
  SELECT 'social', 'https://t.me/all', NULL, count(*) FROM d HAVING count(*) > 0 UNION ALL
  SELECT 'phone', '+99412555' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0'), NULL, count(*) FROM d GROUP BY s_suppkey % 10000 UNION ALL
  SELECT 'link', 'https://shop.firm' || k || '.com/b', NULL, count(*) FROM d GROUP BY k UNION ALL SELECT 'link', site || '/about', NULL, count(*) FROM d GROUP BY site UNION ALL
  SELECT 'entity', 'organization', 'B' || k, count(*) FROM d GROUP BY k UNION ALL SELECT 'entity', 'organization', nm, count(*) FROM d GROUP BY nm UNION ALL
  SELECT 'error', site || '/s' || s_suppkey, (404 + s_suppkey % 2)::VARCHAR, 1 FROM d WHERE s_suppkey % 3 > 0 UNION ALL
  SELECT 'text', site || '/s' || s_suppkey, body, 1 FROM d WHERE s_suppkey % 3 >= 0""")
def crawl_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = texts_of(spark, sf_dir, "supplier", *CONTENTS_PAGE, "case when s_suppkey % 3 = 0 then 200 else 404 + s_suppkey % 2 end as status")
    return web.crawl_contents(captured, web.page_report(captured))


FETCHED = ("concat('  http', case when p_partkey % 2 = 0 then 's' else '' end, '://Shop', cast(p_partkey % 50 as string), "
           "'.example.com/p', cast(p_partkey as string), '/#top') as url",
           "case p_partkey % 5 when 0 then '' when 1 then concat('<title>Just a moment...</title>', p_name) "
           "when 2 then '<html><script>x</script></html>' else concat('<html><title> ', p_name, '\n page</title><body>"
           "<a href=\"/about\">a</a><a href=\"/about/\">b</a><a href=\"#x\">c</a><a href=\"team?x=1\">t</a>"
           "<a href=\"https://other.example.com/contact\">o</a><a href=\"/p', cast(p_partkey as string), '\">p</a>"
           "<a href=\"mailto:a@b.co\">m</a></body></html>') end as html")


@query("fetch_report", """WITH p AS (SELECT *, 'http' || CASE WHEN p_partkey % 2 = 0 THEN 's' ELSE '' END || '://Shop' || (p_partkey % 50)
    || '.example.com' AS origin FROM part)
  SELECT origin || '/p' || p_partkey AS url, p_partkey % 5 > 2 AS ok, CASE WHEN p_partkey % 5 > 2 THEN p_name || ' page a b c t o p m' ELSE '' END AS text,
  CASE WHEN p_partkey % 5 > 2 THEN p_name || ' page' ELSE '' END AS title,
  CASE WHEN p_partkey % 5 > 2 THEN origin || '/about ' || origin || '/team?x=1' ELSE '' END AS links,
  CASE p_partkey % 5 WHEN 0 THEN 'empty content' WHEN 1 THEN 'bot-challenge/interstitial (cloudflare)' WHEN 2 THEN 'empty content' ELSE '' END AS err FROM p""")
def fetch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.fetch_report(texts_of(spark, sf_dir, "part", *FETCHED)).select(
        "url", "ok", "text", "title", F.array_join("links", " ").alias("links"), "err")


META_PAGE = ("concat('<!doctype html><html ', case when s_suppkey % 3 = 0 then 'lang=\"uk-UA\"' when s_suppkey % 3 = 1 then 'data-x lang=EN' else '' end, "
             "'><head><TITLE>', s_name, '\n  shop </TITLE><meta name=\"description\" content=\" About   ', s_name, ' \">"
             "<link rel=\"shortcut icon\" href=\"', case when s_suppkey % 2 = 0 then '/static/../f.ico' else 'https://cdn.example.com/f.ico' end, '\">"
             "</head><body><a href=\"/a/\">a</a><a href=\"/a\">a</a><a href=\"/b?x=1\">b</a></body></html>')")
SQL_META = """SELECT s_suppkey, 'https://www.firm' || s_suppkey || '.example.com' AS url, 'example.com' AS domain, s_name || ' shop' AS title,
  'About ' || s_name AS meta_description, CASE s_suppkey % 3 WHEN 0 THEN 'uk' WHEN 1 THEN 'en' END AS lang,
  CASE WHEN s_suppkey % 2 = 0 THEN 'https://www.firm' || s_suppkey || '.example.com/f.ico' ELSE 'https://cdn.example.com/f.ico' END AS favicon_url
  FROM supplier"""


@query("site_profile", f"""WITH m AS ({SQL_META}) SELECT url, 'firm' || s_suppkey || '.com' AS domain, title, meta_description, lang,
  replace(favicon_url, 'www.firm' || s_suppkey || '.example.com', 'www.firm' || s_suppkey || '.com') AS favicon_url,
  s_suppkey % 10 <> 9 AS reachable, CASE WHEN s_suppkey % 4 = 0 THEN 12 WHEN s_suppkey % 2 = 0 THEN 3 ELSE 2 END AS pages_count, s_suppkey % 5 = 0 AS robots_present,
  s_suppkey % 4 = 0 AS sitemap_present, CASE s_suppkey % 3 WHEN 0 THEN 'Cloudflare' WHEN 1 THEN 'HIT' END AS cdn,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE '2030-01-0' || (s_suppkey % 7) END AS expires,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 7 - 1 END AS days_left
  FROM (SELECT * REPLACE ('https://www.firm' || s_suppkey || '.com' AS url) FROM m)""")
def site_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    domain = "concat('firm', cast(s_suppkey as string), '.com') as domain"
    homes = suppliers.selectExpr(
        "concat('www.firm', cast(s_suppkey as string), '.com') as url",
        "case when s_suppkey % 10 = 9 then 503 else 200 end as status", "cast(s_suppkey + 100 as int) as elapsed_ms",
        "case s_suppkey % 3 when 0 then map('server', 'nginx', 'cf-ray', 'x') when 1 then map('x-cache', 'HIT') "
        "else map('via', '1.1 proxy') end as headers", f"{META_PAGE} as html")
    robots = suppliers.filter("s_suppkey % 5 = 0").selectExpr(domain, "'User-agent: *' as body")
    sitemaps = suppliers.filter("s_suppkey % 4 = 0").selectExpr(
        domain, "concat('https://firm', cast(s_suppkey as string), '.com/sitemap.xml') as sitemap_url", "12L as urls")
    facts = suppliers.filter("s_suppkey % 7 <> 0").selectExpr(
        domain, "'registrar' as registrar", "timestamp'2020-01-01' as created",
        "to_timestamp(concat('2030-01-0', cast(s_suppkey % 7 as string))) as expires",
        "'CA' as tls_issuer", "timestamp'2031-01-01' as tls_expires", "true as tls_valid")
    return web.site_profile(homes, robots, sitemaps, facts, F.lit("2030-01-01").cast("timestamp")).select(
        "url", "domain", "title", "meta_description", "lang", "favicon_url", "reachable", "pages_count",
        "robots_present", "sitemap_present", "cdn", "expires", "days_left")


# --------------------------------------------------------------- contacts
CONTACT_PAGE = ("concat('https://shop.example.com/c', cast(c_custkey as string)) as url",
                "concat('<html lang=\"en\"><body><p>Write to ', lower(replace(c_name, '#', 'x')), '@mail.example.com or Sales', "
                "cast(c_custkey % 40 as string), '@Example.COM</p><a href=\"https://www.facebook.com/shop', cast(c_custkey % 30 as string), "
                "'\">f</a><p>tel +380 (44) ', cast(c_custkey % 90 + 1000 as string), '-12-34, id ', cast(c_custkey as string), "
                "'x</p></body></html>') as html")
SQL_CONTACTS = """WITH hits AS (
  SELECT 'email' AS kind, lower(replace(c_name, '#', 'x')) || '@mail.example.com' AS value, c_custkey FROM customer UNION ALL
  SELECT 'email', 'sales' || (c_custkey % 40) || '@example.com', c_custkey FROM customer UNION ALL
  SELECT 'social', 'https://www.facebook.com/shop' || (c_custkey % 30), c_custkey FROM customer UNION ALL
  SELECT 'phone', '+38044' || (c_custkey % 90 + 1000) || '1234', c_custkey FROM customer)"""


def _contact_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.contacts(web.page_table(texts_of(spark, sf_dir, "customer", *CONTACT_PAGE)))


@query("contacts", SQL_CONTACTS + " SELECT kind, value, 'https://shop.example.com/c' || c_custkey AS url FROM hits")
def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contact_hits(spark, sf_dir).select("kind", "value", "url")


@query("two_source", SQL_CONTACTS + " SELECT kind, value, count(*) AS pages FROM hits GROUP BY ALL HAVING count(*) >= 2")
def two_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.two_source(_contact_hits(spark, sf_dir))


@query("crawl_summary", SQL_CONTACTS + """, d AS (SELECT DISTINCT kind, value FROM hits)
  SELECT (SELECT count(*) FROM customer WHERE c_custkey % 10 <> 3) AS pages_fetched, (SELECT count(*) FROM customer WHERE c_custkey % 10 = 3) AS errors,
  count(*) FILTER (kind = 'email') AS emails, count(*) FILTER (kind = 'social') AS socials, count(*) FILTER (kind = 'phone') AS phones FROM d""")
def crawl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derived(spark, sf_dir, "customer", "case when c_custkey % 10 = 3 then 404 else 200 end as status")
    return web.crawl_summary(log, _contact_hits(spark, sf_dir))


@query("document_emails", f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(
    regexp_extract_all(text, '{fx.EMAIL}'), lambda e: lower(e)))), ' ') AS emails FROM documents
  WHERE regexp_matches(text, '{fx.EMAIL}')""")
def document_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", web.emails(F.col("text"), F.lit(None)).alias("e"))
    return found.filter(F.size("e") > 0).select("doc_id", F.array_join("e", " ").alias("emails"))


@query("document_phones")
def document_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(web.phones(F.col("text"))).alias("phone"))


@query("blocked_fetches", """SELECT c_custkey % 8 AS k, count(*) FILTER (c_custkey % 8 < 4) AS blocked, count(*) FILTER (c_custkey % 8 < 5) AS company_blocked
  FROM customer GROUP BY 1""")
def blocked_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derived(spark, sf_dir, "customer", "c_custkey % 8 as k",
                  "element_at(array(401, 403, 429, 451, 999, 200, 404, 503), cast(c_custkey % 8 + 1 as int)) as status")
    return log.groupBy("k").agg(F.count_if(web.is_blocked(F.col("status"))).alias("blocked"),
                                F.count_if(web.is_blocked(F.col("status"), True)).alias("company_blocked"))


# --------------------------------------------------------------- structured data
JSONLD_PAGE = ("concat('https://shop.example.com/c', cast(c_custkey as string)) as url",
               "concat('<html><script type=\"application/ld+json\">', case c_custkey % 8 "
               "when 0 then concat('{\"@type\":[\"Corporation\",\"Thing\"],\"name\":\"', c_name, '\",\"telephone\":\"+1\"}') "
               "when 1 then concat('{\"@type\":\"Person\",\"legalName\":\"', c_name, '\"}') "
               "when 2 then concat('[{\"@type\":\"Product\",\"name\":\"', c_name, '\"},{\"@type\":\"Event\",\"name\":\"E', cast(c_custkey as string), '\"}]') "
               "when 3 then concat('{\"@graph\":[{\"@type\":\"Place\",\"name\":\"', c_name, '\"},{\"@type\":\"X\"}],\"name\":\"G\"}') "
               "when 4 then '{broken' "
               "when 6 then concat('[[{\"@graph\":[{\"@graph\":[{\"@graph\":[[{\"@type\":\"Person\",\"name\":\"', c_name, '\"}]],\"name\":\"Deep\"}]}]}], 7]') "
               "when 7 then concat('{\"@type\":\"WebPage\",\"mainEntity\":{\"name\":\"unlisted\"},\"name\":\"', c_name, '\"}') "
               "else concat('{\"@type\":\"Offer\",\"name\":\"', c_name, '\",\"url\":\"https://x.y/', cast(c_custkey as string), '\"}') end, "
               "'</script></html>') as html")


@query("jsonld_entities", """SELECT url, entity, title, value FROM (SELECT 'https://shop.example.com/c' || c_custkey AS url, unnest(CASE c_custkey % 8
    WHEN 0 THEN [{'entity': 'organization', 'title': c_name, 'value': 'telephone=+1'}]
    WHEN 1 THEN [{'entity': 'person', 'title': c_name, 'value': ''}]
    WHEN 2 THEN [{'entity': 'product', 'title': c_name, 'value': ''}, {'entity': 'event', 'title': 'E' || c_custkey, 'value': ''}]
    WHEN 3 THEN [{'entity': 'place', 'title': c_name, 'value': ''}, {'entity': 'thing', 'title': 'G', 'value': ''}]
    WHEN 4 THEN [] WHEN 6 THEN [{'entity': 'person', 'title': c_name, 'value': ''}, {'entity': 'thing', 'title': 'Deep', 'value': ''}]
    WHEN 7 THEN [{'entity': 'webpage', 'title': c_name, 'value': ''}] ELSE [{'entity': 'product', 'title': c_name, 'value': 'url=https://x.y/' || c_custkey}] END, recursive := true)
  FROM customer)""")
def jsonld_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = web.jsonld_entities(texts_of(spark, sf_dir, "customer", *JSONLD_PAGE))
    pairs = F.transform(F.map_entries("value"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select(F.col("source_url").alias("url"), "entity", "title", F.array_join(F.array_sort(pairs), " ").alias("value"))


OG_PAGE = ("concat('https://shop.example.com/p', cast(p_partkey as string)) as url",
           "concat('<html><meta ', case p_partkey % 4 when 0 then concat('property=\"og:title\" content=\"', p_name, ' &amp; co\"') "
           "when 1 then concat('content=\"', p_name, '\" property=\"og:title\"') when 2 then concat('name=''og:title'' x content=''', p_name, '''') "
           "else 'property=\"og:url\" content=\"u\"' end, '><meta property=\"og:type\" content=\"', case when p_partkey % 3 = 0 then 'website' else 'article' end, "
           "'\"><div itemscope itemtype=\"https://schema.org/Product\"><b itemprop=\"name\"> ', p_brand, ' </b></div></html>') as html")


@query("og_and_microdata", """SELECT 'https://shop.example.com/p' || p_partkey AS url, CASE WHEN p_partkey % 3 = 0 THEN 'organization' ELSE 'web_page' END AS entity,
    CASE p_partkey % 4 WHEN 0 THEN p_name || ' & co' ELSE p_name END AS title FROM part WHERE p_partkey % 4 < 3 UNION ALL
  SELECT 'https://shop.example.com/p' || p_partkey, 'product', p_brand FROM part""")
def og_and_microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.structured_entities(texts_of(spark, sf_dir, "part", *OG_PAGE)).select(
        F.col("source_url").alias("url"), "entity", "title")


# --------------------------------------------------------------- robots, sitemaps, crawl
ROBOTS_BODY = ("concat('# rules\nUser-Agent: *\nDisallow: /EN/1 # part\nDisallow:\nAllow: /x\nUser-agent: other\nDisallow: /\n"
               "Sitemap: https://', site, '/sitemap.xml\nuser-agent: TallygraphBot/1.0\nDisallow: /', substr(site, 1, 1), '\nDisallow: /es/', substr(site, length(site) - 1, 1), '\n')")


def _robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "pages").select(urls.reg_domain(urls.netloc(F.col("url"))).alias("site")).distinct()
    return sites.selectExpr("site", f"{ROBOTS_BODY} as body")


@query("robots_rules", f"""WITH s AS (SELECT DISTINCT {SQL_DOMAIN} AS site FROM pages)
  SELECT site, '/en/1 /' || left(site, 1) || ' /es/' || substr(site, length(site) - 1, 1) AS rules,
    'https://' || site || '/sitemap.xml' AS sitemaps FROM s""")
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _robots(spark, sf_dir).select(
        "site", F.array_join(web.robots_rules(F.col("body"), AGENT), " ").alias("rules"),
        F.array_join(web.robots_sitemaps(F.col("body")), " ").alias("sitemaps"))


@query("robots_blocked", rf"""WITH p AS (SELECT url, {SQL_DOMAIN} AS site, lower(regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1)) AS path FROM pages)
  SELECT url, site, starts_with(path, '/en/1') OR starts_with(path, '/' || left(site, 1))
    OR starts_with(path, '/es/' || substr(site, length(site) - 1, 1)) AS blocked FROM p""")
def robots_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.robots_blocked(table(spark, sf_dir, "pages"), _robots(spark, sf_dir), AGENT)


SITEMAP = ("concat('shop', cast(c_custkey % 20 as string), '.com') as site",
           "concat('https://shop', cast(c_custkey % 20 as string), '.com/sitemap', cast(c_custkey as string), '.xml') as url",
           "concat('<urlset><url><loc> https://www.Shop', cast(c_custkey % 20 as string), '.com/en/p', cast(c_custkey % 100 as string), '/ </loc></url>"
           "<url><loc>https://shop', cast(c_custkey % 20 as string), '.com/de/x</loc></url><url><loc>https://else.com/y</loc></url>"
           "<url><loc>https://shop', cast(c_custkey % 20 as string), '.com/about#a</loc></url></urlset>') as body")


@query("sitemap_urls", """SELECT DISTINCT 'shop' || (c_custkey % 20) || '.com' AS site, 'https://www.shop' || (c_custkey % 20) || '.com/en/p' || (c_custkey % 100) AS link FROM customer
  UNION ALL SELECT DISTINCT 'shop' || (c_custkey % 20) || '.com', 'https://shop' || (c_custkey % 20) || '.com/about' FROM customer
  UNION ALL SELECT DISTINCT 'shop' || (c_custkey % 20) || '.com', 'https://shop' || (c_custkey % 20) || '.com/de/x' FROM customer WHERE c_custkey % 20 % 2 = 1""")
def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = texts_of(spark, sf_dir, "customer", *SITEMAP)
    langs = derived(spark, sf_dir, "customer", SITEMAP[0], "case when c_custkey % 20 % 2 = 0 then 'en' end as lang").distinct()
    return web.sitemap_urls(bodies, langs)


@query("sitemap_sizes", """SELECT 'firm' || s_suppkey || '.com' AS site, 'https://firm' || s_suppkey || '.com/' || CASE s_suppkey % 3 WHEN 0 THEN 'b' ELSE 'a' END || '.xml' AS sitemap_url,
  CASE s_suppkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 2 END AS urls FROM supplier""")
def sitemap_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First map empty for every third site; an index with one child for every other third."""
    base = "concat('https://firm', cast(s_suppkey as string), '.com/')"
    suppliers = table(spark, sf_dir, "supplier")
    candidates = suppliers.selectExpr("concat('firm', cast(s_suppkey as string), '.com') as site",
                                      f"posexplode(array(concat({base}, 'a.xml'), concat({base}, 'b.xml'))) as (ord, url)")
    maps = (f"inline(array(struct(concat({base}, 'a.xml') as url, case s_suppkey % 3 when 0 then '<urlset/>' when 1 then "
            f"concat('<SitemapIndex><loc>', {base}, 'c.xml</loc></SitemapIndex>') else '<loc>u</loc><loc>v</loc>' end as body), "
            f"struct(concat({base}, 'b.xml') as url, '<loc>x</loc><loc>y</loc>' as body), "
            f"struct(concat({base}, 'c.xml') as url, '<loc>x</loc>' as body)))")
    return web.sitemap_sizes(candidates, suppliers.selectExpr(maps))


SQL_BFS = """WITH RECURSIVE e AS (SELECT DISTINCT o_orderpriority AS site, 'p' || (o_custkey % 200) AS url, 'p' || (o_orderkey % 200) AS link FROM orders),
  l0 AS (SELECT DISTINCT site, 'p0' AS url, 0::BIGINT AS ord, 0 AS level FROM e)""" + "".join(f""",
  c{i} AS (SELECT e.site, e.link AS url, min(l.ord) AS parent FROM l{i - 1} l JOIN e ON e.site = l.site AND e.url = l.url
    WHERE {' AND '.join(f'NOT EXISTS (SELECT 1 FROM l{j} v WHERE v.site = e.site AND v.url = e.link)' for j in range(i))} GROUP BY ALL),
  l{i} AS (SELECT site, url, row_number() OVER (PARTITION BY site ORDER BY parent, url) - 1
    + (SELECT count(*) FROM ({' UNION ALL '.join(f'SELECT site FROM l{j}' for j in range(i))}) n WHERE n.site = c{i}.site) AS ord, {i} AS level FROM c{i})"""
    for i in range(1, 12)) + " SELECT site, url, ord, level FROM (" + " UNION ALL ".join(
    f"SELECT * FROM l{i}" for i in range(12)) + ") WHERE ord < 25"


@query("bfs_order", SQL_BFS)
def bfs_order_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = derived(spark, sf_dir, "orders", "o_orderpriority as site", "concat('p', cast(o_custkey % 200 as string)) as url",
                    "concat('p', cast(o_orderkey % 200 as string)) as link")
    seeds = edges.select("site").distinct().select("site", F.lit("p0").alias("url"), F.lit(0).cast("bigint").alias("ord"))
    return bfs_order(edges, seeds, fx.PAGE_CAP)


@query("text_functions", """SELECT p_partkey, p_name || ' & "' || p_brand || '" <' || p_type || '>' AS plain FROM part""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "part", "p_partkey",
                  "concat(p_name, ' &amp; &quot;', p_brand, '&quot; &lt;', p_type, '&gt;') as raw")
    return raw.select("p_partkey", text.unescape(F.col("raw")).alias("plain"))
