"""Profiles read from captured pages: company registry text, social channels,
company pages and store apps.  One projection per kind; unknown stays null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions import numbers, text, urls
from tallygraph.functions.keys import is_person_name
from tallygraph.functions.text import blank_to_null, extract, first_match, let, strip
from tallygraph.operators.positions import first_per_group
from tallygraph.sources import web

FACTS = ["code", "capital", "ownership", "activity", "activity_text", "registered", "director"]


# ---------------------------------------------------------------- company registry
def registry_fields(rows: DataFrame) -> DataFrame:
    """Facts found in each captured registry text, null where the text does not say."""
    t = F.col("text")
    capital = numbers.money_number(extract(t, fx.REGISTRY_CAPITAL))
    director = first_match(t, fx.REGISTRY_DIRECTOR)
    return rows.select(
        "*", first_match(t, fx.REGISTRY_CODE).alias("code"),
        F.when(capital.between(*fx.CAPITAL_RANGE), capital).alias("capital"),
        first_match(t, fx.REGISTRY_OWNERSHIP).alias("ownership"),
        extract(t, fx.REGISTRY_ACTIVITY, 1, "").alias("activity"),
        F.left(strip(extract(t, fx.REGISTRY_ACTIVITY, 2, "")), F.lit(80)).alias("activity_text"),
        first_match(t, fx.REGISTRY_DATE).alias("registered"),
        F.when(is_person_name(director), director).alias("director"))


def clean_owner(name: Column) -> Column:
    n = F.regexp_replace(name, f"(?iu){fx.OWNER_PREFIX}", "")
    n = strip(F.regexp_replace(n, f"(?iu){fx.OWNER_SUFFIX}", ""))
    n = F.regexp_replace(n, rf"{fx.WS}{{2,}}", " ")
    return F.regexp_replace(n, "^[ \\-–—:]+|[ \\-–—:]+$", "")


def registry_owners(rows: DataFrame) -> DataFrame:
    """(company_id, kind, name, share): beneficiaries and founders, one row per name.

    The first source, and the first place in it, gives the share.
    """
    def owner(kind: str, raw: Column, share: Column) -> Column:
        def judged(o: Column) -> Column:
            person = is_person_name(o["name"])
            named = person | o["name"].rlike(f"(?iu){fx.COMPANY_NAME}")
            good = person if kind == "beneficiary" else (
                (F.char_length(o["name"]) >= 4) & (o["share"] <= 100) & named)
            return F.when(good, o)
        row = F.struct(F.lit(kind).alias("kind"), clean_owner(raw).alias("name"), share.alias("share"))
        return let(row, judged)

    t = F.col("text")
    benef = F.transform(text.extract_all(t, fx.BENEFICIARY, 1, "iu"),
                        lambda n: owner("beneficiary", n, F.lit(None).cast("double")))
    found = F.transform(F.arrays_zip(text.extract_all(t, fx.FOUNDER, 1).alias("n"),
                                     text.extract_all(t, fx.FOUNDER, 2).alias("s")),
                        lambda z: owner("founder", z["n"], numbers.money_number(z["s"])))
    kept = (rows.select("company_id", "source_order",
                        F.posexplode(F.array_compact(F.concat(benef, found))).alias("pos", "o"))
            .select("company_id", "source_order", "pos", "o.kind", "o.name", "o.share"))
    return kept.groupBy("company_id", "kind", "name").agg(
        F.min_by("share", F.struct("source_order", "pos")).alias("share"))


def registry_merge(rows: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """First known value of every fact over the ordered sources of a company.

    ``given`` (company_id, given_code) are codes known beforehand.  ``found``
    also counts a given code, ``found_fact`` only what the sources say.
    """
    known = registry_fields(rows)
    owners = registry_owners(rows).groupBy("company_id").agg(
        F.count_if(F.col("kind") == "founder").alias("founders"),
        F.count_if(F.col("kind") == "beneficiary").alias("beneficiaries"))
    first = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("source_order"))).alias(f) for f in FACTS]
    merged = known.groupBy("company_id").agg(*first, F.count_distinct("source").alias("sources_tried"))
    merged = merged.join(owners, "company_id", "left")
    if given is not None:
        merged = merged.join(given, "company_id", "left")
    else:
        merged = merged.withColumn("given_code", F.lit(None).cast("string"))
    n_found, n_benef = F.coalesce("founders", F.lit(0)), F.coalesce("beneficiaries", F.lit(0))
    fact = F.col("code").isNotNull() | F.col("capital").isNotNull() | (n_found > 0) | (n_benef > 0)
    return merged.select(
        "company_id", F.coalesce(blank_to_null(F.col("given_code")), "code").alias("code"), *FACTS[1:],
        n_found.alias("founders"), n_benef.alias("beneficiaries"), "sources_tried",
        fact.alias("found_fact"), (fact | (F.coalesce("given_code", F.lit("")) != "")).alias("found"))


def registry_snippets(rows: DataFrame, cap: int | None = None, limit: int = 0) -> DataFrame:
    """Source texts of a company with the source name; the first ``limit``, ``cap`` characters each, if given."""
    named = rows.filter(F.col("text") != "").select(
        "company_id", "source_order",
        F.concat(F.lit("["), "source", F.lit("] "), F.left("text", F.lit(cap)) if cap else F.col("text")).alias("snippet"))
    return first_per_group(named, ["company_id"], ["source_order"], limit)


# ---------------------------------------------------------------- social channels
def _count(source: Column, pattern: str, flags: str = "iu") -> Column:
    return numbers.human_number(extract(source, pattern, 1, flags))


def _long(source: Column, pattern: str) -> Column:
    return extract(source, pattern, 1, "").try_cast("bigint")


def social_profiles(captured: DataFrame, cap: int | None = None) -> DataFrame:
    """One row per captured social page (url, status, html), routed by platform.

    Counts are looked for in the whole visible text; ``cap`` cuts the ``snippet`` that is shown.
    """
    url = F.when(F.col("url").rlike("(?i)^https?://"), F.col("url")) \
        .otherwise(F.concat(F.lit("https://"), "url"))
    html = F.when(F.col("status") == 200, F.coalesce("html", F.lit(""))).otherwise("")
    read = captured.select(url.alias("url"), urls.platform_of(F.col("url")).alias("platform"),
                           web.is_blocked(F.col("status")).alias("blocked"), html.alias("html"))
    read = read.withColumn("snippet", text.visible_text(F.col("html")))
    page, snippet, platform = F.col("html"), F.col("snippet"), F.col("platform")

    tg_handle = blank_to_null(F.regexp_replace(F.regexp_extract("url", fx.TELEGRAM_HANDLE, 1), "^@+", ""))
    tg_name = text.unescape(strip(F.regexp_replace(extract(page, fx.TELEGRAM_TITLE, 1, "s"), "<[^>]+>", "")))
    og_title = blank_to_null(text.meta_property(page, "og:title"))
    tg_title = F.coalesce(blank_to_null(tg_name), F.when(~og_title.rlike("(?i)^telegram"), og_title))
    tg_extra = text.visible_text(F.coalesce(extract(page, fx.TELEGRAM_EXTRA, 1, "s"), F.lit("")))
    tg_subs = numbers.human_number(F.coalesce(extract(tg_extra, fx.TELEGRAM_COUNT),
                                              extract(snippet, fx.TELEGRAM_COUNT)))
    yt_raw = F.coalesce(*[extract(F.col("url"), p, 1, "") for p in fx.YOUTUBE_HANDLES])
    yt_handle = F.try_url_decode(F.replace(yt_raw, F.lit("+"), F.lit("%2B")))
    yt_subs = numbers.human_number(F.coalesce(*[extract(page, p, 1, "i") for p in fx.YOUTUBE_SUBSCRIBERS]))
    yt_posts = numbers.human_number(F.coalesce(extract(page, fx.YOUTUBE_VIDEOS_JSON, 1, "i"),
                                               extract(snippet, fx.YOUTUBE_VIDEOS_TEXT, 1, "i")))
    about = F.coalesce(text.meta_property(page, "og:description"), F.lit(""))
    tiktok_subs = F.coalesce(_long(page, fx.TIKTOK_FOLLOWERS), _count(about, fx.FOLLOWERS))
    fb_subs = _count(F.concat_ws(" ", about, snippet), fx.FACEBOOK_FOLLOWERS)

    handle = F.when(platform == "telegram", tg_handle).when(platform == "youtube", yt_handle)
    shown = (F.when(platform == "telegram", tg_title).otherwise(og_title))
    subs = (F.when(platform == "telegram", tg_subs).when(platform == "youtube", yt_subs)
            .when(platform == "instagram", _count(about, fx.FOLLOWERS))
            .when(platform == "tiktok", tiktok_subs).when(platform == "facebook", fb_subs))
    posts = (F.when(platform == "youtube", yt_posts).when(platform == "instagram", _count(about, fx.POSTS))
             .when(platform == "tiktok", F.coalesce(_long(page, fx.TIKTOK_HEARTS), _long(page, fx.TIKTOK_VIDEOS))))
    rows = read.select("url", "platform", "blocked", handle.alias("handle"), F.left(shown, F.lit(200)).alias("title"),
                       subs.alias("subscribers"), posts.alias("posts"),
                       (F.left("snippet", F.lit(cap)) if cap else F.col("snippet")).alias("snippet"))
    bot = (platform == "telegram") & F.coalesce(F.lower("handle").endswith("bot"), F.lit(False))
    found = F.col("title").isNotNull()
    return rows.select(
        "url", "platform", F.when(bot, "bot").otherwise("social-channel").alias("entity_class"), "handle",
        found.alias("found"), "blocked", "title", "subscribers", "posts",
        (found & F.col("subscribers").isNull() & ~bot).alias("needs_review"), "snippet")


def social_summary(profiles: DataFrame) -> DataFrame:
    return profiles.agg(F.count(F.lit(1)).alias("targets"), F.count_if("found").alias("found"),
                        F.count_if("blocked").alias("blocked"),
                        F.sum(F.coalesce("subscribers", F.lit(0))).alias("subscribers_total"))


def _listed(col: Column) -> Column:
    """A list given as JSON text, as one bare url, or not at all."""
    bare = F.when(strip(col) != "", F.array(col)).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.from_json(col, "array<string>"), bare, F.array().cast("array<string>"))


def _kept(items: Column, pattern: str, cap: int | None) -> Column:
    clean = F.filter(F.transform(items, strip), lambda u: u.isNotNull() & (u != "") & u.rlike(pattern))
    unique = F.array_distinct(clean)
    return F.slice(unique, 1, cap) if cap else unique


def social_targets(listed: Column, networks: Column, single: Column) -> Column:
    """Up to eight distinct addresses: the list, then per network, then the single url."""
    nets = F.from_json(networks, "map<string,array<string>>")
    groups = [F.coalesce(F.try_element_at(nets, F.lit(n)), F.array().cast("array<string>"))
              for n in fx.SOCIAL_NETWORKS]
    return _kept(F.concat(_listed(listed), *groups, F.array(single)), r"[A-Za-z0-9]\.[A-Za-z]", fx.SOCIAL_TARGETS)


def company_targets(listed: Column, networks: Column, *singles: Column) -> Column:
    """The one company address: first company link or bare slug of all that were given."""
    nets = F.from_json(networks, "map<string,array<string>>")
    own = F.coalesce(F.try_element_at(nets, F.lit("linkedin")), F.array().cast("array<string>"))
    return _kept(F.concat(_listed(listed), own, F.array(*singles)),
                 r"(?i)linkedin\.com|^[A-Za-z0-9][A-Za-z0-9\-_%]*$", 1)


def app_targets(listed: Column, *singles: Column) -> Column:
    return _kept(F.concat(_listed(listed), F.array(*singles)), ".", None)


# ---------------------------------------------------------------- company pages
def _json_first(html: Column, patterns: list[str]) -> Column:
    return text.unescape(F.coalesce(*[strip(extract(html, p, 1, "")) for p in patterns]), nbsp=True)


def _address(html: Column) -> Column:
    parts = [text.unescape(blank_to_null(strip(extract(html, rf'"{k}"\s*:\s*"([^"]*)"', 1, ""))), nbsp=True)
             for k in fx.COMPANY_ADDRESS]
    return blank_to_null(F.array_join(F.array_distinct(F.array_compact(F.array(*parts))), ", "))


def _website(html: Column) -> Column:
    block = extract(html, fx.COMPANY_WEBSITE_BLOCK, 1, "s")
    shown = text.squeeze(F.regexp_replace(text.unescape(block, nbsp=True), "<[^>]+>", " "))
    shown = F.regexp_extract(shown, rf"^({fx.NOT_WS}+)", 1)
    good = shown.rlike("(?i)^https?://") & ~shown.contains(fx.COMPANY_SITE)
    raw = [extract(html, p, 1, "") for p in fx.COMPANY_WEBSITE]
    other = F.coalesce(*[F.when(~r.contains(fx.COMPANY_SITE), text.unescape(strip(r), nbsp=True)) for r in raw])
    return F.coalesce(F.when(good, shown), other)


def _year(col: Column) -> Column:
    y = col.try_cast("int")
    return F.when(y.between(*fx.FOUNDED_RANGE), y)


def _specialties(html: Column) -> Column:
    about = F.left(text.about_field(html, "specialties"), F.lit(600))
    lists = []
    for p in fx.COMPANY_SPECIALTIES:
        items = F.transform(text.extract_all(extract(html, p, 1, ""), '"([^"]+)"'), strip)
        joined = F.array_join(F.filter(items, lambda x: x != ""), ", ")
        lists.append(blank_to_null(F.left(text.unescape(joined, nbsp=True), F.lit(600))))
    return F.coalesce(about, *lists)


def _company_size(html: Column) -> Column:
    start = extract(html, fx.COMPANY_SIZE_RANGE, 1, "")
    both = F.concat(start, F.lit("-"), extract(html, fx.COMPANY_SIZE_RANGE, 2, ""), F.lit(" employees"))
    open_ = F.concat(extract(html, fx.COMPANY_SIZE_START, 1, ""), F.lit("+ employees"))
    shown = [F.concat(F.regexp_replace(extract(html, p, 1, "iu"), rf"{fx.WS}+", ""), F.lit(" employees"))
             for p in fx.COMPANY_SIZE_TEXT]
    return F.coalesce(F.left(text.about_field(html, "size"), F.lit(120)), both, open_, *shown)


def company_profiles(captured: DataFrame) -> DataFrame:
    """One row per captured public company page (url, status, html)."""
    html = F.when(F.col("status") == 200, F.coalesce("html", F.lit(""))).otherwise("")
    read = captured.select(urls.company_url(F.col("url")).alias("url"), urls.company_handle(F.col("url")).alias("handle"),
                           web.is_blocked(F.col("status"), True).alias("blocked"), html.alias("html"))
    page = F.col("html")
    read = read.withColumn("about", F.coalesce(text.meta_property(page, "og:description", True), F.lit("")))
    about = F.col("about")
    followers = F.coalesce(*[F.nullif(numbers.human_number(extract(s, fx.COMPANY_FOLLOWERS)), F.lit(0))
                             for s in (about, page)])
    employees = F.coalesce(*[extract(page, p, 1, "").try_cast("bigint") for p in fx.COMPANY_EMPLOYEES])
    trim = "^[ .|]+|[ .|]+$"
    license_ = blank_to_null(F.regexp_replace(
        F.coalesce(*[extract(about, p, 1, "") for p in fx.COMPANY_LICENSE]), trim, ""))
    body = F.regexp_replace(F.regexp_replace(about, f"(?iu){fx.COMPANY_PREFIX}", ""), trim, "")
    title = strip(F.regexp_replace(text.meta_property(page, "og:title", True),
                                   rf"{fx.WS}*\|{fx.WS}*LinkedIn{fx.WS}*$", ""))
    rows = read.select(
        "url", "handle", "blocked", F.left(blank_to_null(title), F.lit(200)).alias("title"),
        followers.alias("followers"), employees.alias("employees"),
        blank_to_null(F.left(body, F.lit(600))).alias("description"), license_.alias("license"),
        F.coalesce(_address(page), text.about_field(page, "headquarters")).alias("headquarters"),
        F.coalesce(F.left(text.about_field(page, "industry"), F.lit(200)),
                   _json_first(page, fx.COMPANY_INDUSTRY)).alias("industry"),
        _website(page).alias("website"),
        F.coalesce(_year(F.regexp_extract(text.about_field(page, "foundedOn"), "([0-9]{4})", 1)),
                   *[_year(extract(page, p, 1, "")) for p in fx.COMPANY_FOUNDED]).alias("founded"),
        F.coalesce(F.left(text.about_field(page, "organizationType"), F.lit(120)),
                   _json_first(page, fx.COMPANY_TYPE)).alias("company_type"),
        _specialties(page).alias("specialties"), _company_size(page).alias("company_size"),
        _count(page, fx.COMPANY_FOLLOWING).alias("following"))
    found = F.col("title").isNotNull()
    return rows.select("*", found.alias("found"),
                       (found & F.col("followers").isNull() & F.col("employees").isNull()).alias("needs_review"))


# ---------------------------------------------------------------- store apps
APP_COLUMNS = ["platform", "app_id", "country", "url", "found", "source", "title", "developer", "rating",
               "reviews_count", "version", "version_date", "version_date_iso", "installs", "installs_text",
               "price", "genre", "size_bytes", "size_text", "content_rating", "languages"]


def _app_rows(df: DataFrame) -> DataFrame:
    found = F.col("rating").isNotNull() | F.col("reviews_count").isNotNull() | \
        (F.coalesce("version", F.lit("")) != "")
    return df.withColumn("found", found).select(*APP_COLUMNS)


def ios_apps(lookups: DataFrame) -> DataFrame:
    """Store lookup answers (url, country, body): the asked country first, then us."""
    asked = urls.store_country(F.col("url"))
    turn = F.when(F.col("country") == asked, 0).when(F.col("country") == "us", 1)
    parsed = lookups.select("url", "country", turn.alias("turn"), F.try_parse_json("body").alias("j")) \
        .filter(F.col("turn").isNotNull())
    hits = parsed.filter(F.try_variant_get("j", "$.resultCount", "bigint") > 0) \
        .select("url", "country", "turn", F.try_variant_get("j", "$.results[0]", "variant").alias("r"))

    def get(name: str, kind: str = "string") -> Column:
        value = F.try_variant_get("r", f"$.{name}", kind)
        return blank_to_null(value) if kind == "string" else value

    day = numbers.iso_date(F.coalesce(get("currentVersionReleaseDate"), get("releaseDate")))
    size = get("fileSizeBytes").try_cast("bigint")
    fields = hits.select(
        "url", "turn", "country", get("trackName").alias("title"),
        F.coalesce(get("sellerName"), get("artistName")).alias("developer"),
        F.bround(get("averageUserRating", "double"), 2).alias("rating"),
        get("userRatingCount", "double").cast("bigint").alias("reviews_count"), get("version").alias("version"),
        day["ymd"].alias("version_date"), day["iso"].alias("version_date_iso"),
        F.coalesce(get("formattedPrice"), F.when(get("price", "double") == 0, "Free")).alias("price"),
        get("primaryGenreName").alias("genre"), size.alias("size_bytes"), numbers.human_size(size).alias("size_text"),
        F.coalesce(get("contentAdvisoryRating"), get("trackContentRating")).alias("content_rating"),
        get("languageCodesISO2A", "array<string>").alias("languages"))
    names = [c for c in fields.columns if c not in ("url", "turn")]
    best = fields.groupBy("url").agg(F.min_by(F.struct(*names), "turn").alias("a")).select("url", "a.*")
    asked_rows = lookups.select("url").distinct().withColumn("asked", asked)
    return _app_rows(asked_rows.join(best, "url", "left").select(
        F.lit("ios").alias("platform"), urls.store_app_id(F.col("url")).alias("app_id"),
        F.coalesce("country", "asked").alias("country"), "url",
        F.when(F.col("country").isNotNull(), "itunes-api").alias("source"),
        *[n for n in names if n != "country"],
        F.lit(None).cast("bigint").alias("installs"), F.lit(None).cast("string").alias("installs_text")))


def _is_app(v: Column) -> Column:
    """An object that calls itself an application, or has a rating whatever it is."""
    fields = v.try_cast("map<string,variant>")
    kind = F.coalesce(blank_to_null(F.try_variant_get(v, "$.@type", "string")), F.try_variant_get(v, "$.type", "string"), F.lit(""))
    return F.coalesce(F.map_contains_key(fields, "aggregateRating"), F.lit(False)) | (fields.isNotNull() & kind.contains("Application"))


def _first_node(nodes: Column, read) -> Column:
    return F.get(F.filter(F.transform(nodes, read), lambda x: x.isNotNull()), F.lit(0))


def _node_text(*paths: str):
    return lambda v: F.coalesce(*[blank_to_null(F.try_variant_get(v, p, "string")) for p in paths])


def android_apps(captured: DataFrame) -> DataFrame:
    """Captured store pages (url, html): JSON-LD first, then patterns over the page."""
    html = F.coalesce("html", F.lit(""))
    read = captured.select("url", html.alias("html"), text.visible_text(html).alias("shown"),
                           web.jsonld_first(html, _is_app).alias("nodes"))
    page, shown, nodes = F.col("html"), F.col("shown"), F.col("nodes")

    def price(v: Column) -> Column:
        amount = F.coalesce(_node_text("$.offers[0].price", "$.offers.price")(v))
        unit = F.coalesce(_node_text("$.offers[0].priceCurrency", "$.offers.priceCurrency")(v), F.lit(""))
        return F.when(amount.isin("0", "0.0"), "Free").otherwise(F.concat(amount, F.lit(" "), unit))

    def reviews(v: Column) -> Column:
        n = _node_text("$.aggregateRating.ratingCount", "$.aggregateRating.reviewCount")(v)
        return F.replace(n, F.lit(","), F.lit("")).try_cast("double").cast("bigint")

    rating_ld = _first_node(nodes, lambda v: F.bround(
        F.try_variant_get(v, "$.aggregateRating.ratingValue", "string").try_cast("double"), 2))
    rating_rx = extract(page, fx.APP_RATING, 1, "").try_cast("double")
    counts = []
    for p in fx.APP_REVIEWS:
        raw = extract(page, p, 1, "iu")
        n = F.when(raw.rlike("[KMBkmb]"), numbers.installs_number(raw)) \
            .otherwise(F.regexp_replace(raw, "[^0-9]", "").try_cast("bigint"))
        counts.append(F.nullif(n, F.lit(0)))
    installs_text = F.coalesce(*[strip(extract(page, p, 1, "")) for p in fx.APP_INSTALLS],
                               strip(extract(shown, fx.APP_INSTALLS_TEXT, 1, "i")))
    named = numbers.month_name_date(F.coalesce(*[extract(page, p, 1, "") for p in fx.APP_UPDATED]))
    exact = numbers.iso_date(extract(page, fx.APP_UPDATED_ISO, 1, ""))
    size = [(extract(page, p, 1, ""), extract(page, p, 2, "")) for p in fx.APP_SIZE]
    size.append((extract(shown, fx.APP_SIZE_TEXT, 1, ""), extract(shown, fx.APP_SIZE_TEXT, 2, "")))
    size_n, size_u = F.coalesce(*[n for n, _ in size]), F.coalesce(*[u for _, u in size])
    return _app_rows(read.select(
        F.lit("android").alias("platform"), urls.store_app_id(F.col("url")).alias("app_id"),
        urls.store_country(F.col("url")).alias("country"), "url",
        F.when(page != "", "play-jsonld").alias("source"),
        _first_node(nodes, _node_text("$.name")).alias("title"),
        _first_node(nodes, _node_text("$.author.name", "$.author")).alias("developer"),
        F.coalesce(rating_ld, F.when((rating_rx > 0) & (rating_rx <= 5), F.bround(rating_rx, 2))).alias("rating"),
        F.coalesce(_first_node(nodes, reviews), *counts).alias("reviews_count"),
        F.coalesce(*[extract(page, p, 1, "") for p in fx.APP_VERSION]).alias("version"),
        F.coalesce(named["ymd"], exact["ymd"]).alias("version_date"),
        F.when(named["ymd"].isNotNull(), named["iso"]).otherwise(exact["iso"]).alias("version_date_iso"),
        numbers.installs_number(installs_text).alias("installs"), installs_text.alias("installs_text"),
        _first_node(nodes, price).alias("price"),
        F.coalesce(_first_node(nodes, _node_text("$.applicationCategory", "$.genre")),
                   *[extract(page, p, 1, "") for p in fx.APP_GENRE]).alias("genre"),
        numbers.size_to_bytes(size_n, size_u).alias("size_bytes"),
        F.concat_ws(" ", size_n, size_u).alias("size_text_raw"),
        F.coalesce(_first_node(nodes, _node_text("$.contentRating")),
                   *[strip(extract(page, p, 1, "")) for p in fx.APP_CONTENT_RATING]).alias("content_rating"),
        F.lit(None).cast("array<string>").alias("languages"))
        .withColumn("size_text", blank_to_null(F.col("size_text_raw"))).drop("size_text_raw"))


def apps_found(apps: DataFrame) -> DataFrame:
    return apps.agg(F.count(F.lit(1)).alias("apps"), F.coalesce(F.bool_or("found"), F.lit(False)).alias("found"))
