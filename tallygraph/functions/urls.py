"""URL helpers: ``Column -> Column``.

The registered domain is the last two host labels; there is no public-suffix
list, so ``a.co.uk`` gives ``co.uk``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygraph import fixed as fx
from tallygraph.functions.text import blank_to_null, contains_any, let, strip

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_PARAMS = r"(?s)^((?:.*/)?[^/;]*);[^/]*$"


def _tidy(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(_tidy(url), _PARTS, group)


def _parts(url: Column) -> Column:
    """Scheme, network part with slashes, host part, path, path without params, query."""
    return let(_tidy(url), lambda u: F.struct(
        F.lower(F.regexp_extract(u, _PARTS, 1)).alias("scheme"), F.regexp_extract(u, _PARTS, 2).alias("net"),
        F.regexp_extract(u, _PARTS, 3).alias("netloc"), F.regexp_extract(u, _PARTS, 4).alias("full_path"),
        F.regexp_replace(F.regexp_extract(u, _PARTS, 4), _PARAMS, "$1").alias("path"),
        F.regexp_extract(u, _PARTS, 5).alias("query")))


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def netloc(url: Column) -> Column:
    return _part(url, 3)


def path(url: Column) -> Column:
    """Path without the ``;params`` of its last segment."""
    return F.regexp_replace(_part(url, 4), _PARAMS, "$1")


def query(url: Column) -> Column:
    return _part(url, 5)


def _suffix(query_: Column) -> Column:
    return F.when(query_ != "", F.concat(F.lit("?"), query_)).otherwise("")


def normalize_url(url: Column) -> Column:
    """No fragment or params, lower scheme and host, one trailing slash off, https by default."""
    def build(p: Column) -> Column:
        path_ = (F.when(p["path"] == "", "/").when(p["path"] == "/", "/")
                 .otherwise(F.regexp_replace(p["path"], "/$", "")))
        return F.concat(F.coalesce(blank_to_null(p["scheme"]), F.lit("https")), F.lit("://"),
                        F.lower(p["netloc"]), path_, _suffix(p["query"]))
    return let(_parts(url), build)


def with_scheme(url: Column) -> Column:
    u = strip(F.coalesce(url, F.lit("")))
    return (F.when(u == "", "").when(u.rlike("(?i)^https?://"), u)
            .otherwise(F.concat(F.lit("https://"), u)))


def drop_fragment(url: Column) -> Column:
    """Without fragment; a URL that had one also gets a lower-case scheme."""
    def build(p: Column) -> Column:
        head = F.when(p["scheme"] != "", F.concat(p["scheme"], F.lit(":"))).otherwise("")
        return F.concat(head, p["net"], p["full_path"], _suffix(p["query"]))
    return let(url, lambda u: F.when(u.contains("#"), let(_parts(u), build)).otherwise(u))


def normalize_url_strict(url: Column) -> Column:
    """No whitespace, control characters, fragment or trailing slashes; https by default."""
    u = F.regexp_replace(F.coalesce(url, F.lit("")), rf"{fx.WS}|[\x00-\x1f]", "")
    return F.regexp_replace(drop_fragment(with_scheme(u)), "/+$", "")


def origin(url: Column) -> Column:
    return F.regexp_extract(url, "(?i)^(https?://[^/]+)", 1)


def host(url: Column) -> Column:
    """Host without user and port, lower case."""
    return F.lower(F.regexp_extract(netloc(url), r"^(?:.*@)?([^:@]*)", 1))


def reg_domain(host_: Column, strip_www: bool = False) -> Column:
    h = F.regexp_extract(F.lower(F.coalesce(host_, F.lit(""))), "^([^:]*)", 1)
    if strip_www:
        h = F.regexp_replace(F.regexp_replace(h, r"^www\.", ""), r"\.{2,}", ".")
        h = F.regexp_replace(h, r"^\.|\.$", "")
    return F.when(h.contains("."), F.regexp_extract(h, r"([^.]*\.[^.]*)$", 1)).otherwise(h)


def first_segment(path_: Column) -> Column:
    """First path segment in lower case, null for the root."""
    return F.lower(blank_to_null(F.regexp_extract(path_, "^/*([^/]*)", 1)))


def path_lang(path_: Column) -> Column:
    seg = first_segment(path_)
    return F.when(seg.isin(fx.LANGUAGES), seg)


def section_key(url: Column) -> Column:
    return F.coalesce(first_segment(path(url)), F.lit(fx.HOME_SECTION))


def section_label(section: Column) -> Column:
    return (F.when(section == fx.HOME_SECTION, fx.HOME_LABEL)
            .otherwise(F.translate(section, "-_", "  ")))


def _normal_segments(parts: Column) -> Column:
    """Remove ``.`` and resolve ``..`` over an array of path segments."""
    def step(acc: Column, seg: Column) -> Column:
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(seg == "..", up).when(seg == ".", acc).otherwise(F.concat(acc, F.array(seg)))

    done = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.get(parts, F.size(parts) - 1)
    return F.when(last.isin(".", ".."), F.concat(done, F.array(F.lit("")))).otherwise(done)


def _join_path(base_path: Column, ref_path: Column) -> Column:
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    relative = let(F.concat(folder, ref_path), lambda j: F.concat(
        F.regexp_extract(j, "^(/?)", 1), F.regexp_replace(F.regexp_replace(j, "/{2,}", "/"), "^/", "")))
    return F.when(ref_path.startswith("/"), ref_path).otherwise(relative)


def _walk(path_: Column) -> Column:
    """Path with dot segments resolved and a leading slash."""
    clean = F.when(path_.rlike(r"(^|/)\.{1,2}(/|$)"),
                   F.array_join(_normal_segments(F.split(path_, "/")), "/")).otherwise(path_)
    return let(clean, lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))


def _resolve(base: Column, ref: Column, href: Column) -> Column:
    """Absolute URL of a link from the parts of the page URL and of the link."""
    site = F.concat(base["scheme"], F.lit("://"), base["netloc"])
    foreign = (ref["scheme"] != "") & (ref["scheme"] != base["scheme"])
    tail = _suffix(ref["query"])
    same_page = F.concat(base["full_path"], F.when(ref["query"] != "", tail).otherwise(_suffix(base["query"])))
    return (F.when(foreign, F.regexp_replace(_tidy(href), "(?s)#.*$", ""))
            .when(ref["net"] != "", F.concat(base["scheme"], F.lit(":"), ref["net"], ref["full_path"], tail))
            .when(ref["full_path"] == "", F.concat(site, same_page))
            .otherwise(F.concat(site, let(_join_path(base["full_path"], ref["full_path"]), _walk), tail)))


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` seen on page ``base``; the fragment is dropped."""
    return let(_parts(base), lambda b: let(_parts(href), lambda r: _resolve(b, r, href)))


def resolve_links(base: Column, hrefs: Column) -> Column:
    """Array of absolute links; the page URL is taken apart once for all of them."""
    return let(_parts(base), lambda b: F.transform(
        hrefs, lambda h: let(_parts(h), lambda r: _resolve(b, r, h))))


def is_followed(href: Column) -> Column:
    """Page hrefs that are links to documents, not anchors, mail, phones or scripts."""
    skipped = F.lit(False)
    for prefix in fx.SKIPPED_HREFS:
        skipped = skipped | href.startswith(prefix)
    return href.isNotNull() & (href != "") & ~skipped


def ignore_reason(url: Column) -> Column:
    """First ignored path part, else social, else file, else null."""
    def named(p: Column) -> Column:
        reason = F.when(p.contains(fx.IGNORED_PATHS[0]), fx.IGNORED_PATHS[0].strip("/"))
        for part in fx.IGNORED_PATHS[1:]:
            reason = reason.when(p.contains(part), part.strip("/"))
        return (reason.when(url.rlike(f"(?i){fx.IGNORED_SOCIAL}"), "social")
                .when(p.rlike(f"(?i){fx.IGNORED_FILES}"), "file"))

    return let(F.lower(F.coalesce(blank_to_null(path(url)), F.lit("/"))), named)


def platform_of(url: Column) -> Column:
    def named(h: Column) -> Column:
        (name, hosts), *rest = fx.PLATFORM_HOSTS
        platform = F.when(contains_any(h, hosts), name)
        for name, hosts in rest:
            platform = platform.when(contains_any(h, hosts), name)
        return platform.otherwise("unknown")

    full = F.when(url.rlike("(?i)^https?://"), url).otherwise(F.concat(F.lit("https://"), url))
    return let(F.lower(netloc(full)), named)


def store_of(url: Column) -> Column:
    """ios or android by host, android for a bare package id, else null."""
    h = F.lower(netloc(url))
    return (F.when(contains_any(h, ["apple.com", "itunes.apple"]), "ios")
            .when(contains_any(h, ["play.google", "market.android"]), "android")
            .when(strip(url).rlike(fx.APP_PACKAGE), "android"))


def store_country(url: Column) -> Column:
    ios = F.coalesce(blank_to_null(F.regexp_extract(url, r"apps\.apple\.com/([a-z]{2})/", 1)),
                     F.lit("us"))
    android = F.upper(F.coalesce(blank_to_null(F.regexp_extract(url, r"[?&]gl=([A-Za-z]{2})", 1)),
                                 F.lit("US")))
    return F.when(store_of(url) == "ios", ios).when(store_of(url) == "android", android)


def store_app_id(url: Column) -> Column:
    ios = F.coalesce(blank_to_null(F.regexp_extract(url, r"/id([0-9]+)", 1)),
                     blank_to_null(F.regexp_extract(url, r"[?&]id=([0-9]+)", 1)))
    android = blank_to_null(F.regexp_extract(url, r"[?&]id=([\p{L}\p{N}_.\-]+)", 1))
    return F.when(store_of(url) == "ios", ios).when(store_of(url) == "android", android)


def company_handle(url: Column) -> Column:
    u = strip(F.coalesce(url, F.lit("")))
    bare = (u != "") & ~u.rlike(r"(?i)linkedin\.com") & ~u.contains("/") & ~u.contains(" ")
    return F.when(bare, u).otherwise(
        blank_to_null(F.regexp_extract(u, f"(?i){fx.COMPANY_HANDLE}", 1)))


def company_url(url: Column) -> Column:
    """Canonical company page from a bare slug or a company, school or showcase link."""
    handle = company_handle(url)
    return (F.when(handle.isNotNull(), F.concat(F.lit(fx.COMPANY_URL), handle))
            .otherwise(with_scheme(url)))
