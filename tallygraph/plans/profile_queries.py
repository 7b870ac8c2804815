"""Queries over captured profile pages and registry texts, and over numbers and dates in text.

The pages are written from table rows by SQL text, so the expected values are
known from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.functions import keys, numbers, urls
from tallygraph.operators import profiles
from tallygraph.plans.registry import derived, query, spread, table, texts_of


# --------------------------------------------------------------- numbers and dates
@query("human_numbers", """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_partkey * 1000 WHEN 1 THEN p_partkey * 1000000 + 500000
  WHEN 2 THEN 1000 + p_partkey % 1000 WHEN 3 THEN (p_partkey % 90 + 1) * 1000000000 WHEN 4 THEN (p_partkey * 10 + 5) WHEN 5 THEN NULL
  WHEN 6 THEN p_partkey * 1000 + 500 ELSE 1234567 END AS n FROM part""")
def human_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "cast(p_partkey as string)"
    raw = (f"case p_partkey % 8 when 0 then concat(' ', {k}, 'K ') when 1 then concat({k}, ',5 млн') "
           "when 2 then concat('1 ', lpad(cast(p_partkey % 1000 as string), 3, '0'), ' subscribers') "
           f"when 3 then concat(cast(p_partkey % 90 + 1 as string), ' billion') when 4 then concat({k}, '.5') when 5 then 'n/a' "
           f"when 6 then concat({k}, '.5 тис.') else '1,234,567' end as raw")
    return derived(spark, sf_dir, "part", "p_partkey", raw).select("p_partkey", numbers.human_number(F.col("raw")).alias("n"))


@query("money_numbers", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE o_totalprice END AS n FROM orders""")
def money_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = "cast(o_totalprice as decimal(18,2))"
    whole, cents = f"substring_index(cast({amount} as string), '.', 1)", f"substring_index(cast({amount} as string), '.', -1)"

    def grouped(sep: str) -> str:
        return f"regexp_replace(regexp_replace(lpad({whole}, 9, ' '), '(...)(...)(...)', '$1{sep}$2{sep}$3'), '^[ {sep}]+', '')"

    raw = (f"case o_orderkey % 5 when 0 then concat({grouped(' ')}, ',', {cents}, ' грн') "
           f"when 1 then concat({grouped('.')}, ',', {cents}) when 2 then concat({grouped(',')}, '.', {cents}) "
           f"when 3 then concat({whole}, '.', {cents}) else '1,234,567' end as raw")
    return derived(spark, sf_dir, "orders", "o_orderkey", raw).select("o_orderkey", numbers.money_number(F.col("raw")).alias("n"))


@query("installs_and_sizes", """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_partkey * 1000 WHEN 1 THEN p_partkey * 1000000000 ELSE p_partkey END AS installs,
  CASE p_partkey % 4 WHEN 0 THEN (p_partkey + 1) * 1024 WHEN 1 THEN (p_partkey + 1) * 1048576 WHEN 2 THEN round(1.5 * 1073741824)::BIGINT ELSE NULL END AS size_bytes,
  CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 1000 + 1) || '.0 MB' ELSE '2.50 GB' END AS size_text FROM part""")
def installs_and_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "cast(p_partkey as string)"
    raw = derived(spark, sf_dir, "part", "p_partkey",
                  f"case p_partkey % 3 when 0 then concat({k}, ',000+') when 1 then concat({k}, 'B+') else concat({k}, ' +') end as installs",
                  "case p_partkey % 4 when 2 then '1,5' else cast(p_partkey + 1 as string) end as n",
                  "element_at(array('КБ', 'MB', 'gb', 'px'), cast(p_partkey % 4 + 1 as int)) as unit",
                  "case when p_partkey % 2 = 0 then (p_partkey % 1000 + 1) * 1048576 else 2684354560L end as bytes")
    return raw.select("p_partkey", numbers.installs_number(F.col("installs")).alias("installs"),
                      numbers.size_to_bytes(F.col("n"), F.col("unit")).alias("size_bytes"),
                      numbers.human_size(F.col("bytes")).alias("size_text"))


@query("dates_mixed", """WITH o AS (SELECT o_orderkey, o_orderdate AS d FROM orders)
  SELECT o_orderkey, strftime(d, '%Y%m%d')::INT AS iso_ymd, strftime(d, '%Y-%m-%d') AS iso,
    CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE strftime(d, '%Y%m%d')::INT END AS month_ymd,
    CASE WHEN o_orderkey % 3 = 2 THEN 'no date here' ELSE strftime(d, '%Y-%m-%d') END AS month_iso,
    strftime(d, '%Y-%m-%d') AS flex, date_diff('day', DATE '1992-01-01', d::DATE) AS days FROM o""")
def dates_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = "element_at(array('січ.', 'лют.', 'бер.', 'квіт.', 'трав.', 'черв.', 'лип.', 'серп.', 'вер.', 'жовт.', 'лист.', 'груд.'), month(o_orderdate))"
    layouts = " ".join(f"when {i} then date_format(o_orderdate, \"{p}\")" for i, p in enumerate(
        ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy"]))
    raw = derived(spark, sf_dir, "orders", "o_orderkey", "concat('on ', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z') as iso",
                  f"case o_orderkey % 3 when 0 then date_format(o_orderdate, 'MMM d, yyyy') when 1 then concat(day(o_orderdate), ' ', {stem}, ' ', year(o_orderdate)) "
                  "else 'no date here, sorry' end as named", f"case o_orderkey % 4 {layouts} end as flex")
    iso, named = numbers.iso_date(F.col("iso")), numbers.month_name_date(F.col("named"))
    flex = numbers.flex_date(F.col("flex"))
    return raw.select("o_orderkey", iso["ymd"].alias("iso_ymd"), iso["iso"].alias("iso"), named["ymd"].alias("month_ymd"),
                      named["iso"].alias("month_iso"), F.date_format(flex, "yyyy-MM-dd").alias("flex"),
                      numbers.days_left(F.to_timestamp(F.to_date(flex)), F.lit("1992-01-01").cast("timestamp")).alias("days"))


@query("numeric_test", """SELECT c_custkey, c_custkey % 5 IN (0, 1) AS is_number FROM customer""")
def numeric_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ("case c_custkey % 5 when 0 then cast(cast(c_acctbal as decimal(18,2)) as string) when 1 then ' 1e3' "
           "when 2 then c_name when 3 then '' else null end as raw")
    return derived(spark, sf_dir, "customer", "c_custkey", raw).select("c_custkey", numbers.is_number(F.col("raw")).alias("is_number"))


# --------------------------------------------------------------- company registry
REGISTRY = """concat(case when c_custkey % 3 = 0 then '' else concat('Код ЄДРПОУ: ', lpad(cast(c_custkey as string), 8, '3'), '. ') end,
  'Статутний капітал: ', cast(c_custkey % 900 + 100 as string), ' 000,00 грн. ',
  case when c_custkey % 2 = 0 then 'Товариство з обмеженою відповідальністю "Мрія". ' else 'Limited Liability Company Dream. ' end,
  'КВЕД 64.19 — Інші види грошового посередництва', '\n', 'Дата реєстрації: 0', cast(c_custkey % 9 + 1 as string), '.02.2001 \n',
  'Керівник: ', case when c_custkey % 4 = 0 then 'Частка Власника' else 'Іваненко Петро' end, '\n',
  'Кінцевий бенефіціарний власник: Шевченко Тарас Григорович\n',
  'Засновники ТОВ Сонце', ' — ', cast(c_custkey % 99 + 1 as string), ',5 %;\n', 'Коваль Олена - 12 %\n', 'просто слова 40 %')"""


def _registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two captured texts per company; the second one knows a code but says little else."""
    people = spread(table(spark, sf_dir, "customer"))
    full = people.selectExpr("c_custkey as company_id", "'card' as source", "1 as source_order", f"{REGISTRY} as text")
    brief = people.selectExpr("c_custkey as company_id", "'mirror' as source", "2 as source_order",
                              "concat('USREOU ', lpad(cast(c_custkey as string), 8, '7'), ', Коваль Олена - 90 %') as text")
    return full.unionByName(brief)


@query("registry_facts", """SELECT c_custkey AS company_id, CASE WHEN c_custkey % 3 = 0 THEN lpad(c_custkey::VARCHAR, 8, '7') ELSE lpad(c_custkey::VARCHAR, 8, '3') END AS code,
  CASE WHEN c_custkey % 900 + 100 >= 100 THEN (c_custkey % 900 + 100) * 1000.0 END::DOUBLE AS capital,
  CASE WHEN c_custkey % 2 = 0 THEN 'Товариство з обмеженою відповідальністю' ELSE 'Limited Liability Company' END AS ownership,
  '64.19' AS activity, 'Інші види грошового посередництва' AS activity_text, '0' || (c_custkey % 9 + 1) || '.02.2001' AS registered,
  CASE WHEN c_custkey % 4 <> 0 THEN 'Іваненко Петро' END AS director, 2 AS founders, 1 AS beneficiaries, 2 AS sources_tried,
  true AS found_fact, true AS found FROM customer""")
def registry_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.registry_merge(_registry_rows(spark, sf_dir))


@query("registry_owners", """SELECT c_custkey AS company_id, 'beneficiary' AS kind, 'Шевченко Тарас Григорович' AS name, NULL::DOUBLE AS share FROM customer UNION ALL
  SELECT c_custkey, 'founder', 'ТОВ Сонце', (c_custkey % 99 + 1) + 0.5 FROM customer WHERE c_custkey % 99 + 1 < 100 UNION ALL
  SELECT c_custkey, 'founder', 'Коваль Олена', 12.0 FROM customer""")
def registry_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.registry_owners(_registry_rows(spark, sf_dir))


@query("registry_snippets", """SELECT c_custkey AS company_id, 2 AS source_order, md5('[mirror] USREOU ' || lpad(c_custkey::VARCHAR, 8, '7') || ', Коваль Олена - 90 %' || repeat(' text of ' || c_name, 200)) AS snippet FROM customer
  UNION ALL SELECT c_custkey, 10 + i, md5('[archive] ' || c_name || i) FROM customer, (VALUES (0), (1), (2), (3), (4), (5)) v(i)""")
def registry_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources of a company, more than a report would show, and texts longer than it would."""
    brief = _registry_rows(spark, sf_dir).filter("source = 'mirror'") \
        .join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"), "c_name"), "company_id") \
        .select("company_id", "source_order", "source", F.concat("text", F.repeat(F.concat(F.lit(" text of "), "c_name"), 200)).alias("text"))
    more = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"), "c_name", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")) \
        .select("company_id", (F.col("i") + 10).alias("source_order"), F.lit("archive").alias("source"), F.concat("c_name", F.col("i").cast("string")).alias("text"))
    return profiles.registry_snippets(brief.unionByName(more)).select("company_id", "source_order", F.md5("snippet").alias("snippet"))


@query("person_names", """SELECT c_custkey, c_custkey % 5 IN (0, 1) AS is_person FROM customer""")
def person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ("case c_custkey % 5 when 0 then 'Іваненко Петро Олексійович' when 1 then 'Mary O’neil-smith' when 2 then concat('Client ', c_name) "
           "when 3 then 'Власник Пакету' else 'one two' end as name")
    return derived(spark, sf_dir, "customer", "c_custkey", raw).select("c_custkey", keys.is_person_name(F.col("name")).alias("is_person"))


# --------------------------------------------------------------- social channels
SOCIAL_URL = """element_at(array(concat('t.me/s/@chan', cast(p_partkey as string)), concat('https://www.youtube.com/@tube', cast(p_partkey as string)),
  concat('https://instagram.com/i', cast(p_partkey as string)), concat('https://www.tiktok.com/@t', cast(p_partkey as string)),
  concat('https://fb.com/f', cast(p_partkey as string)), concat('https://t.me/help', cast(p_partkey as string), '_bot'),
  concat('https://example.com/x', cast(p_partkey as string))), cast(p_partkey % 7 + 1 as int))"""
SOCIAL_PAGE = """concat('<html><head><meta property="og:title" content="', p_name, ' &amp; Co"><meta property="og:description" content="',
  case p_partkey % 7 when 2 then concat(cast(p_partkey % 900 + 1 as string), ',123 Followers, 5 Following, ', cast(p_partkey % 50 as string), ' Posts')
  when 4 then concat('Page. ', cast(p_partkey % 90 + 1 as string), '.5K people follow this') else 'none' end, '"></head><body>',
  repeat('<p>lorem ipsum</p>', 200), case p_partkey % 7 when 0 then concat('<div class="tgme_page_title" dir="auto"> <span dir="auto"><b>', p_brand, '</b> news</span></div><div class="tgme_page_extra">',
    cast(p_partkey % 900 + 1 as string), ' 456 subscribers</div>')
  when 1 then concat('<script>{"subscriberCountText":{"accessibility":1,"simpleText":"', cast(p_partkey % 90 + 1 as string), '.25M subscribers"},"videosCountText":{"runs":[{"text":"',
    cast(p_partkey % 900 + 1 as string), ' videos"}]}}</script>')
  when 3 then concat('<script>{"followerCount": ', cast(p_partkey as string), ',"heartCount":77}</script>') else 'hello' end, '</body></html>')"""


def _social(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.social_profiles(texts_of(
        spark, sf_dir, "part", f"{SOCIAL_URL} as url", "case when p_partkey % 11 = 10 then 403 else 200 end as status", f"{SOCIAL_PAGE} as html"))


SQL_SOCIAL = """WITH p AS (SELECT *, p_partkey % 7 AS k, p_partkey % 11 <> 10 AS open FROM part), s AS (SELECT
  CASE k WHEN 0 THEN 'https://t.me/s/@chan' || p_partkey WHEN 1 THEN 'https://www.youtube.com/@tube' || p_partkey WHEN 2 THEN 'https://instagram.com/i' || p_partkey
    WHEN 3 THEN 'https://www.tiktok.com/@t' || p_partkey WHEN 4 THEN 'https://fb.com/f' || p_partkey WHEN 5 THEN 'https://t.me/help' || p_partkey || '_bot'
    ELSE 'https://example.com/x' || p_partkey END AS url,
  CASE k WHEN 0 THEN 'telegram' WHEN 1 THEN 'youtube' WHEN 2 THEN 'instagram' WHEN 3 THEN 'tiktok' WHEN 4 THEN 'facebook' WHEN 5 THEN 'telegram' ELSE 'unknown' END AS platform,
  CASE WHEN k = 5 THEN 'bot' ELSE 'social-channel' END AS entity_class,
  CASE k WHEN 0 THEN 'chan' || p_partkey WHEN 1 THEN '@tube' || p_partkey WHEN 5 THEN 'help' || p_partkey || '_bot' END AS handle,
  open AS found, NOT open AS blocked, CASE WHEN open THEN CASE k WHEN 0 THEN p_brand || ' news' ELSE p_name || ' & Co' END END AS title,
  CASE WHEN open THEN CASE k WHEN 0 THEN (p_partkey % 900 + 1) * 1000 + 456 WHEN 1 THEN (p_partkey % 90 + 1) * 1000000 + 250000
    WHEN 2 THEN (p_partkey % 900 + 1) * 1000 + 123 WHEN 3 THEN p_partkey WHEN 4 THEN (p_partkey % 90 + 1) * 1000 + 500 END END AS subscribers,
  CASE WHEN open THEN CASE k WHEN 1 THEN p_partkey % 900 + 1 WHEN 2 THEN p_partkey % 50 WHEN 3 THEN 77 END END AS posts,
  open AND k = 6 AS needs_review FROM p)"""


@query("social_profiles", SQL_SOCIAL + " SELECT * FROM s")
def social_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _social(spark, sf_dir).drop("snippet")


@query("social_summary", SQL_SOCIAL + """ SELECT count(*) AS targets, count(*) FILTER (found) AS found, count(*) FILTER (blocked) AS blocked,
  sum(coalesce(subscribers, 0))::BIGINT AS subscribers_total FROM s""")
def social_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.social_summary(_social(spark, sf_dir))


@query("target_lists", """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'a.com/' || s_suppkey || ' t.me/b i.com/c' WHEN s_suppkey % 3 = 1 THEN 'x.com/1 t.me/b i.com/c' ELSE 't.me/b i.com/c' END AS social,
  CASE WHEN s_suppkey % 2 = 0 THEN 'https://linkedin.com/company/l' || s_suppkey ELSE 'slug-' || s_suppkey END AS company,
  CASE WHEN s_suppkey % 3 = 0 THEN 'a.com/' || s_suppkey || ' t.me/b play.example/' || s_suppkey WHEN s_suppkey % 3 = 1 THEN 'x.com/1 play.example/' || s_suppkey ELSE 'play.example/' || s_suppkey END AS apps FROM supplier""")
def target_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "supplier", "s_suppkey",
                  "case s_suppkey % 3 when 0 then concat('[\"a.com/', cast(s_suppkey as string), '\",\" t.me/b \",\"t.me/b\"]') when 1 then 'x.com/1' end as listed",
                  "concat('{\"instagram\":[\"i.com/c\"],\"telegram\":[\"t.me/b\"]', case when s_suppkey % 2 = 0 then concat(',\"linkedin\":[\"https://linkedin.com/company/l', "
                  "cast(s_suppkey as string), '\"]') else '' end, '}') as networks",
                  "'t.me/b' as single", "concat('slug-', cast(s_suppkey as string)) as company",
                  "concat('play.example/', cast(s_suppkey as string)) as android")
    social = profiles.social_targets(F.col("listed"), F.col("networks"), F.col("single"))
    company = profiles.company_targets(F.lit(None).cast("string"), F.col("networks"), F.col("single"), F.col("company"))
    apps = profiles.app_targets(F.col("listed"), F.col("android"))
    return raw.select("s_suppkey", F.array_join(social, " ").alias("social"), F.array_join(company, " ").alias("company"),
                      F.array_join(apps, " ").alias("apps"))


# --------------------------------------------------------------- company pages
COMPANY_PAGE = """concat('<html><head><meta property="og:title" content="', s_name, ' | LinkedIn"><meta property="og:description" content="',
  case s_suppkey % 3 when 0 then concat('Followers ', s_name, ' | ', cast(s_suppkey + 12 as string), ' 224 на LinkedIn. Добрий банк | Банківська ліценз №', cast(s_suppkey as string), ' від 2011 р.')
  when 1 then concat(s_name, ' | ', cast(s_suppkey + 1 as string), ',500 followers') else 'Plain text.' end, '"></head><body>',
  case when s_suppkey % 2 = 0 then concat('<div data-test-id="about-us__industry"><dt>I</dt><dd class="x"> Banking &amp;  Co </dd></div>',
    '<div data-test-id="about-us__website"><dd><a href="u"> https://firm', cast(s_suppkey as string), '.com <i>ext</i></a></dd></div>',
    '<div data-test-id="about-us__foundedOn"><dd>', cast(1900 + s_suppkey % 100 as string), '</dd></div>',
    '<div data-test-id="about-us__size"><dd>51-200</dd></div><div data-test-id="about-us__headquarters"><dd>Kyiv</dd></div>',
    '<div data-test-id="about-us__organizationType"><dd>Private</dd></div><div data-test-id="about-us__specialties"><dd>a, b</dd></div>')
  else concat('<script>{"numberOfEmployees":{"value":', cast(s_suppkey as string), '},"industryName":"Retail","websiteUrl":"https://linkedin.com/x","website":"https://w', cast(s_suppkey as string),
    '.com","foundedOn":{"year":1', cast(100 + s_suppkey % 900 as string), '},"staffCountRange":{"start":11,"end":50},"companyType":{"localizedName":"Public"},"specialities":["x"," y "],',
    '"streetAddress":"Main ', cast(s_suppkey as string), '","addressLocality":"Lviv","addressRegion":"Lviv","addressCountry":"UA"}</script>') end, '</body></html>')"""


@query("company_profiles", """SELECT 'https://www.linkedin.com/company/firm' || s_suppkey AS url, 'firm' || s_suppkey AS handle, s_suppkey % 9 = 8 AS blocked, s_suppkey % 9 <> 8 AS found,
  CASE WHEN s_suppkey % 9 <> 8 THEN s_name END AS title,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE s_suppkey % 3 WHEN 0 THEN (s_suppkey + 12) * 1000 + 224 WHEN 1 THEN (s_suppkey + 1) * 1000 + 500 END END AS followers,
  CASE WHEN s_suppkey % 9 <> 8 AND s_suppkey % 2 = 1 THEN s_suppkey END AS employees,
  CASE WHEN s_suppkey % 9 <> 8 AND s_suppkey % 3 = 0 THEN 'Банківська ліценз №' || s_suppkey || ' від 2011 р' END AS license_text,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'Kyiv' ELSE 'Main ' || s_suppkey || ', Lviv, UA' END END AS headquarters,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'Banking & Co' ELSE 'Retail' END END AS industry,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'https://firm' || s_suppkey || '.com' ELSE 'https://w' || s_suppkey || '.com' END END AS website,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN 1900 + s_suppkey % 100 WHEN 1100 + s_suppkey % 900 >= 1700 THEN 1100 + s_suppkey % 900 END END AS founded,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'Private' ELSE 'Public' END END AS company_type,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'a, b' ELSE 'x, y' END END AS specialties,
  CASE WHEN s_suppkey % 9 <> 8 THEN CASE WHEN s_suppkey % 2 = 0 THEN '51-200' ELSE '11-50 employees' END END AS company_size,
  s_suppkey % 9 <> 8 AND s_suppkey % 3 = 2 AND s_suppkey % 2 = 0 AS needs_review FROM supplier""")
def company_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = texts_of(spark, sf_dir, "supplier", "case when s_suppkey % 2 = 0 then concat('linkedin.com/school/firm', cast(s_suppkey as string), '?x=1') "
                       "else concat('firm', cast(s_suppkey as string)) end as url",
                       "case when s_suppkey % 9 = 8 then 999 else 200 end as status", f"{COMPANY_PAGE} as html")
    return profiles.company_profiles(captured).select(
        "url", "handle", "blocked", "found", "title", "followers", "employees", F.col("license").alias("license_text"), "headquarters",
        "industry", "website", "founded", "company_type", "specialties", "company_size", "needs_review")


# --------------------------------------------------------------- store apps
IOS_BODY = """case when p_partkey % 3 = 0 and cc = 'ua' then '{"resultCount":0,"results":[]}' else concat('{"resultCount":1,"results":[{"trackName":"', p_name, '","sellerName":"', p_brand,
  '","averageUserRating":', cast(p_partkey % 5 as string), '.456,"userRatingCount":', cast(p_partkey as string), ',"version":"', cast(p_partkey as string), '.1","currentVersionReleaseDate":"2026-07-04T10:00:00Z",',
  case when p_partkey % 2 = 0 then '"formattedPrice":"$1",' else '"price":0.0,' end, '"primaryGenreName":"Finance","fileSizeBytes":"160731136","contentAdvisoryRating":"4+","languageCodesISO2A":["EN","UK"]}]}') end"""
ANDROID_PAGE = """concat('<html><script type="application/ld+json">', case when p_partkey % 4 = 3 then '[[{"@type":"WebPage","name":"page","isPartOf":{"@graph":[{"mainEntity":' else '' end, '{"@type":"SoftwareApplication","name":"', p_name, '","author":{"@type":"Person","name":"', p_brand, '"},"aggregateRating":{"ratingValue":"4.',
  cast(p_partkey % 10 as string), '56","ratingCount":"1,', lpad(cast(p_partkey % 1000 as string), 3, '0'), '"},"offers":[{"price":"', case when p_partkey % 2 = 0 then '0' else '2.5' end, '","priceCurrency":"USD"}],"applicationCategory":"FINANCE"}', case when p_partkey % 4 = 3 then '}]}}], 1]' else '' end, '</script>',
  '<div>', cast(p_partkey % 90 + 1 as string), 'M+</div><div class="x">Downloads</div><div>Updated on</div><div>Jun 30, 2026</div>[[["2.', cast(p_partkey as string), '.6"]],[[[35 <div>Size: 45 MB</div>Rated for ', cast(p_partkey % 18 as string), '+</html>')"""


def _apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread(table(spark, sf_dir, "part"))
    country = F.explode(F.array(F.lit("ua"), F.lit("us"))).alias("cc")
    ios = part.filter("p_partkey % 2 = 0").select("*", country).selectExpr(
        "concat('https://apps.apple.com/ua/app/id', cast(p_partkey + 1000 as string)) as url", "cc as country", f"{IOS_BODY} as body")
    android = part.filter("p_partkey % 2 = 1").selectExpr(
        "concat('https://play.google.com/store/apps/details?id=com.app.p', cast(p_partkey as string), '&gl=ua') as url", f"{ANDROID_PAGE} as html")
    return profiles.ios_apps(ios).unionByName(profiles.android_apps(android))


SQL_APPS = """WITH a AS (SELECT 'ios' AS platform, (p_partkey + 1000)::VARCHAR AS app_id, CASE WHEN p_partkey % 3 = 0 THEN 'us' ELSE 'ua' END AS country, p_name AS title, p_brand AS developer,
    round(p_partkey % 5 + 0.456, 2)::DOUBLE AS rating, p_partkey AS reviews_count, p_partkey || '.1' AS version, 20260704 AS version_date, NULL::BIGINT AS installs,
    '$1' AS price, 'Finance' AS genre, 160731136 AS size_bytes, '153.3 MB' AS size_text, '4+' AS content_rating, 'EN UK' AS languages
  FROM part WHERE p_partkey % 2 = 0 UNION ALL
  SELECT 'android', 'com.app.p' || p_partkey, 'UA', p_name, p_brand, round(4 + (p_partkey % 10) / 10.0 + 0.056, 2)::DOUBLE, 1000 + p_partkey % 1000, '2.' || p_partkey || '.6', 20260630,
    (p_partkey % 90 + 1) * 1000000, CASE WHEN p_partkey % 2 = 0 THEN 'Free' ELSE '2.5 USD' END, 'FINANCE', 45 * 1048576, '45 MB', (p_partkey % 18) || '+', NULL FROM part WHERE p_partkey % 2 = 1)"""


@query("apps", SQL_APPS + " SELECT * FROM a")
def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apps(spark, sf_dir).select(
        "platform", "app_id", "country", "title", "developer", "rating", "reviews_count", "version", "version_date", "installs",
        "price", "genre", "size_bytes", "size_text", "content_rating", F.array_join("languages", " ").alias("languages"))


@query("apps_found", SQL_APPS + " SELECT count(*) AS apps, true AS found FROM a")
def apps_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.apps_found(_apps(spark, sf_dir))


@query("store_targets", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ios' WHEN 3 THEN NULL ELSE 'android' END AS store, CASE p_partkey % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'US' WHEN 2 THEN 'US' END AS country,
  CASE p_partkey % 4 WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN 'com.x.y' || p_partkey END AS app_id FROM part""")
def store_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "cast(p_partkey as string)"
    raw = derived(spark, sf_dir, "part", "p_partkey",
                  f"case p_partkey % 4 when 0 then concat('https://apps.apple.com/de/app/x/id', {k}) when 1 then concat('https://play.google.com/store/apps/details?id=com.x.y', {k}) "
                  f"when 2 then concat('com.bare.pkg', {k}) else concat('https://example.com/', {k}) end as url")
    u = F.col("url")
    return raw.select("p_partkey", urls.store_of(u).alias("store"), urls.store_country(u).alias("country"), urls.store_app_id(u).alias("app_id"))
